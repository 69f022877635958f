"""Tables written by the sinks and read back."""

import uuid

from pyspark.sql import functions as F

from snapledger.plans import manifest
from snapledger.queries.registry import Tables, query
from snapledger.session import shared_dir
from snapledger.sources import scans, sinks


@query(
    "committed_snapshot",
    """
    select o_orderkey as roll_id, o_orderstatus as state_cd, cast(o_custkey % 5 as integer) as ac_no,
      case when o_orderkey % 4 = 0 then 'second' else 'first' end as v from orders
    """,
)
def committed_snapshot(spark, sf_dir):
    """A load of all documents, a re-load of a quarter of them, and a third load that never committed."""
    o = Tables(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("roll_id"), F.col("o_orderstatus").alias("state_cd"),
        (F.col("o_custkey") % 5).cast("int").alias("ac_no"),
    )
    root = f"{shared_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    again = o.filter("roll_id % 4 = 0")
    sinks.write_batch(root, 1, o, {"roll": o.withColumn("v", F.lit("first"))}, {})
    sinks.write_batch(root, 2, again, {"roll": again.withColumn("v", F.lit("second"))}, {})
    sinks.write_table(again.withColumn("v", F.lit("lost")), root, "roll", 3, sinks.AREA)
    return sinks.read_facts(spark, root, "roll", "roll_id bigint, state_cd string, ac_no int, v string")


@query(
    "result_documents",
    """
    select o_orderkey as roll_id, 'roll' as line, cast(null as integer) as serial_no, o_orderpriority as language_code,
      cast(o_totalprice as double) as net_total, o_orderstatus = 'O' as reconciles, null as l_partkey from orders
    union all
    select l_orderkey, 'elector', l_linenumber, null, null, null, l_partkey from lineitem
    """,
)
def result_documents(spark, sf_dir):
    t = Tables(spark, sf_dir)
    key = F.col("o_orderkey").alias("roll_id")
    context = t.orders.select(key, F.col("o_orderpriority").alias("language_code"))
    summary = t.orders.select(key, F.col("o_totalprice").cast("double").alias("net_total"))
    recon = t.orders.select(key, (F.col("o_orderstatus") == "O").alias("reconciles"))
    electors = t.lineitem.select(F.col("l_orderkey").alias("roll_id"), F.col("l_linenumber").cast("int").alias("serial_no"), "l_partkey")
    docs = sinks.result_documents(context, summary, recon, electors)
    return docs.select("roll_id", "line", "serial_no", "context.language_code", "summary.net_total", "recon.reconciles", "elector.l_partkey")


STAMP = "timestamp '2026-01-01 00:00:00'"
JOB = {
    "state_cd": "concat('S', cast(o_custkey % 7 as varchar(3)))", "ac_no": "cast(o_custkey % 90 as int)", "year": "cast(extract(year from o_orderdate) as int)",
    "roll_type": "o_orderstatus", "language": "o_orderpriority", "part_no": "cast(o_orderkey as int)",
}
#: Of each table: its rows from the given tables, and how those of later versions (run 2 and 3) differ.
FOUND = {
    "state": ("nation", "n_nationkey", {"state_cd": "cast(n_nationkey as varchar(9))", "state_name": "concat(n_name, ' ', cast(run as varchar(1)))"}),
    "district": ("supplier", "s_suppkey", {"state_cd": "cast(s_nationkey as varchar(9))", "district_cd": "cast(s_suppkey as varchar(9))", "district_name": "concat('d', cast(run as varchar(1)))"}),
    "ac": ("customer", "c_custkey", {"state_cd": "cast(c_nationkey as varchar(9))", "ac_no": "cast(c_custkey as int)", "ac_name": "concat(c_name, ' ', cast(run as varchar(1)))",
                                     "category": "case when run = 2 then null else c_mktsegment end"}),
    "crawl_log": ("part", "p_partkey", {"scope": "concat('s:', cast(p_partkey as varchar(9)))", "status": "case when run = 1 then 'error' else 'ok' end",
                                        "error": "case when run = 1 then 'x' end", "count": "cast(p_partkey % 9 as int)"}),
    "ac_availability": ("customer", "c_custkey", {"state_cd": "cast(c_nationkey as varchar(9))", "ac_no": "cast(c_custkey as int)", "parts_count": "cast(c_custkey % 11 + run as int)"}),
    "download_job": ("orders", "o_orderkey", JOB | {"status": "case run when 1 then 'pending' when 2 then null else 'verified' end", "attempts": "cast(case when run > 1 then run end as int)",
                                                    "last_error": "case when run = 2 then 'e' end"}),
}
#: The rows that a run touches.
RUNS = {1: "k % 5 <> 4", 2: "k % 3 = 0", 3: "k % 4 = 1"}


def _manifest_sql(name: str, as_of: int) -> str:
    source, key, columns = FOUND[name]
    _, keys, _, filled = manifest.TABLES[name]
    values = [c for c in columns if c not in keys]
    runs = " union all ".join(f"select {n} as run, * from (select *, {key} as k from {source}) t where {w}" for n, w in RUNS.items() if n <= as_of)
    fold = ", ".join(f"{'arg_max' if c in filled else 'arg_max_null'}({c}, run) as {c}" for c in values)
    text = " || '|' || ".join(f"coalesce(cast({c} as varchar), '-')" for c in (*keys, *values))
    return (f"select '{name}' as table_name, {as_of} as as_of, {text} as content from (select {', '.join(keys)}, {fold} from "
            f"(select run, {', '.join(f'{e} as {c}' for c, e in columns.items())} from ({runs}) r) x group by {', '.join(keys)}) y")


@query("manifest_tables", " union all ".join(_manifest_sql(name, n) for name in FOUND for n in (2, 3)))
def manifest_tables(spark, sf_dir):
    """Six tables written, written again in two more versions with compactions between, and read as of the last two."""
    t, root = Tables(spark, sf_dir), f"{shared_dir(spark)}/manifest-{uuid.uuid4().hex}"
    for run, touched in RUNS.items():
        rows = {}
        for name, (source, key, columns) in FOUND.items():
            own = getattr(t, source).withColumn("k", F.col(key)).filter(touched).withColumn("run", F.lit(run))
            rows[name] = own.select(*[F.expr(e).alias(c) for c, e in columns.items()])
        manifest.write(spark, root, run, rows)
        if run == 2:
            manifest.write(spark, root, run, rows)  # a replay
            manifest.compact(spark, root, 2)
    manifest.compact(spark, root, 3, keep_from=2)
    out = None
    for name, (_, _, columns) in FOUND.items():
        _, keys, _, _ = manifest.TABLES[name]
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in (*keys, *[c for c in columns if c not in keys])])
        for as_of in (2, 3):
            found = manifest.read(spark, root, name, as_of).select(F.lit(name).alias("table_name"), F.lit(as_of).alias("as_of"), text.alias("content"))
            out = found if out is None else out.unionByName(found)
    return out


@query(
    "token_table",
    """
    select user_id as image_id, count(*) as tokens, min(event_id) as first_token, cast(sum(floor(value * 100)) as bigint) as x_sum
    from events where event_id % 3 <> 0 group by 1
    """,
)
def token_table(spark, sf_dir):
    """A token table written and read again for one of its two engines."""
    e = Tables(spark, sf_dir).events
    where = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    e.select(
        F.col("user_id").cast("string").alias("image_id"), F.col("event_id").cast("int").alias("tok_no"),
        F.when(F.col("event_id") % 3 == 0, "script").otherwise("latin").alias("engine"), F.col("value").alias("x"), F.lit(0.0).alias("y"),
        F.lit(0.0).alias("x2"), F.lit(0.0).alias("y2"), F.col("event_type").alias("text"), F.lit(1.0).alias("conf"),
    ).write.parquet(where)
    found = scans.read_tokens(spark, where, "latin").groupBy(F.col("image_id").cast("bigint").alias("image_id"))
    return found.agg(F.count("*").alias("tokens"), F.min("tok_no").cast("bigint").alias("first_token"), F.sum(F.floor(F.col("x") * 100)).alias("x_sum"))
