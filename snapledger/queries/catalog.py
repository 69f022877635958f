"""Catalog records, label resolution, audits and file checks."""

from pyspark.sql import functions as F

from snapledger.operators import quality, resolve
from snapledger.queries.registry import Tables, query
from snapledger.queries.scalars import pick_one
from snapledger.sources import scans

LABEL = pick_one(
    "c_custkey", "concat(cast(c_nationkey as varchar(9)), ' - anything')", "lower(n_name)",
    "concat('99 - ', n_name)", "n_name", "'nowhere'",
)
NAMED = pick_one("c_custkey", "lower(n_name)", "'S07'", "'unknown'", "n_name")


@query(
    "resolve_label",
    f"""
    with l as (select c_custkey, {LABEL} as label, {NAMED} as asked from customer join nation on n_nationkey = c_nationkey),
    p as (select *, try_cast(nullif(regexp_extract(label, '^(\\d+)\\s*-\\s*', 1), '') as integer) as no,
            lower(trim(regexp_replace(label, '^\\d+\\s*-\\s*', ''))) as nm from l)
    select c_custkey, coalesce(a.n_nationkey, b.n_nationkey) as n_nationkey, coalesce(a.n_name, b.n_name) as n_name,
      coalesce(cast(c.n_nationkey as varchar), case when asked = 'S07' then asked end) as resolved_cd
    from p left join nation a on a.n_nationkey = no left join nation b on lower(b.n_name) = nm
      left join nation c on lower(c.n_name) = lower(asked)
    """,
)
def resolve_label(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nation = t.nation.select("n_nationkey", "n_name", F.lit(1).alias("scope"))
    asked = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.expr(LABEL).alias("label"), F.expr(NAMED).alias("asked"), F.lit(1).alias("scope")
    )
    found = resolve.by_number_or_name(asked, nation, ["scope"], "label", "n_nationkey", "n_name", ["n_nationkey", "n_name"])
    states = t.nation.select(F.col("n_name").alias("state_name"), F.col("n_nationkey").cast("string").alias("state_cd"))
    return resolve.name_to_code(found, states, "asked").select("c_custkey", "n_nationkey", "n_name", "resolved_cd")


RECORD = """case c_custkey % 5
    when 0 then to_json(named_struct('asmblyNo', c_custkey, 'asmblyName', c_name, 'category', c_mktsegment))
    when 1 then to_json(named_struct('asmblyNo', '', 'acNo', c_custkey, 'acName', c_name, 'acType', 'SC'))
    when 2 then to_json(named_struct('acNumber', cast(c_custkey as string), 'asmblyName', '', 'constituencyName', c_name))
    when 3 then to_json(named_struct('asmblyName', c_name, 'acId', 'i1'))
    else to_json(named_struct('asmblyNo', cast(null as string), 'acNo', 'x', 'acName', c_name)) end"""


@query(
    "catalog_pick",
    """
    select c_custkey, cast(case when c_custkey % 5 < 3 then c_custkey end as integer) as ac_no, c_name as ac_name,
      case when c_custkey % 5 = 3 then 'i1' else '' end as ac_id,
      case c_custkey % 5 when 0 then c_mktsegment when 1 then 'SC' end as category,
      c_custkey % 5 >= 3 as rejected
    from customer
    """,
)
def catalog_pick(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    raw = c.select(F.col("c_custkey").cast("string").alias("state_cd"), F.expr(RECORD).alias("raw"))
    rows, rejects = scans.catalog_areas(raw)
    out = rows.withColumn("rejected", F.lit(False)).unionByName(rejects.withColumn("rejected", F.lit(True)))
    return out.select(
        F.col("state_cd").cast("bigint").alias("c_custkey"), "ac_no", "ac_name", "ac_id", "category", "rejected"
    )


RULES = {
    "orders": {
        "price >= 0": "o_totalprice >= 0", "status": "o_orderstatus in ('O', 'P')",
        "priority shape": "o_orderpriority rlike '^[0-9]-[A-Z]+$'",
    },
    "lineitem": {
        "line >= 1": "l_linenumber >= 1", "discount": "l_discount between 0 and 0.05",
        "returned only when final": "l_returnflag <> 'R' or l_linestatus = 'F'",
    },
    "customer": {"balance": "case when c_custkey % 3 = 0 then null else c_acctbal end >= 1000"},
    "documents": {"length": "n_chars = length(text)", "lang": "lang in ('en', 'fr')"},
    "events": {"value": "value < 100"},
}


def _audit_sql(table, rules):
    return " union all ".join(
        f"select '{table}' as table_name, '{rule}' as rule, count(*) filter (where not coalesce({e.replace(' rlike ', ' ~ ') if '^' in e else e}, true)) "
        f"as violations from {table}" for rule, e in rules.items()
    )


@query(
    "constraint_audit",
    " union all ".join(_audit_sql(t, r) for t, r in RULES.items()).replace(
        "o_orderpriority ~ ", "regexp_matches(o_orderpriority, "
    ).replace("[A-Z]+$', true", "[A-Z]+$'), true"),
)
def constraint_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.union_audits([quality.check_audit(getattr(t, n), n, r) for n, r in RULES.items()])


UNIQUE = [
    ("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("customer", ["c_name"]),
    ("events", ["event_id"]), ("events", ["user_id"]), ("documents", ["text"]), ("part", ["p_name", "p_brand"]),
    ("conversations", ["conv_id", "turn"]),
]


@query(
    "unique_audit",
    " union all ".join(
        f"select '{t}' as table_name, 'unique({', '.join(k)})' as rule, count(*) as violations from "
        f"(select {', '.join(k)} from {t} where {' and '.join(c + ' is not null' for c in k)} "
        f"group by {', '.join(k)} having count(*) > 1)" for t, k in UNIQUE
    ),
)
def unique_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.union_audits([quality.unique_audit(getattr(t, n), n, k) for n, k in UNIQUE])


REFERENCES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"), ("documents", "doc_id", "labels", "doc_id"),
    ("events", "user_id", "supplier", "s_suppkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey"),
]


@query(
    "fk_audit",
    " union all ".join(
        f"select '{c}' as table_name, '{f} references {pk}' as rule, count(*) as violations from {c} "
        f"where {f} is not null and {f} not in (select {pk} from {p} where {pk} is not null)"
        for c, f, p, pk in REFERENCES
    ),
)
def fk_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.union_audits(
        [quality.reference_audit(getattr(t, c), c, f, getattr(t, p), pk) for c, f, p, pk in REFERENCES]
    )


@query(
    "file_integrity",
    """
    with f as (select page_id, case when page_id % 17 = 0 then null when page_id % 19 = 0 then ' ' || html else html end
                 as h, url from pages)
    select page_id, case when h is null then 'missing' when substr(h, 1, 9) <> '<!DOCTYPE' then 'bad_header'
      when not contains(right(h, 64), '</html>') then 'truncated' when not contains(url, '#') and page_id % 3 = 0
      then 'unreadable' else 'ok' end as verdict, strlen(h) as bytes, sha256(h) as sha256
    from f
    """,
)
def file_integrity(spark, sf_dir):
    content = F.expr(
        "cast(case when page_id % 17 = 0 then null when page_id % 19 = 0 then concat(' ', html) else html end as binary)"
    )
    pages = F.expr("case when not contains(url, '#') and page_id % 3 = 0 then 0 else 2 end")
    files = Tables(spark, sf_dir).pages.select("page_id", content.alias("content"), pages.alias("pages"))
    return files.select(
        "page_id",
        quality.file_verdict(F.col("content"), F.col("pages"), "<!DOCTYPE", "</html>", 64).alias("verdict"),
        F.octet_length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"),
    )


@query(
    "content_dedupe",
    "select sha256(text) as content_sha256, min(doc_id) as kept_id, count(*) as copies from documents group by 1",
)
def content_dedupe(spark, sf_dir):
    return quality.distinct_contents(Tables(spark, sf_dir).documents, "text", "doc_id")


@query(
    "roll_dedupe",
    """
    select o_custkey, o_orderstatus, case when o_orderkey % 2 = 0 then o_orderpriority end as revision,
      min(o_orderkey) as kept from orders group by 1, 2, 3
    """,
)
def roll_dedupe(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_custkey", "o_orderstatus", F.expr("case when o_orderkey % 2 = 0 then o_orderpriority end").alias("revision"),
        F.col("o_orderkey").alias("kept"),
    )
    return quality.distinct_rolls(o, ["o_custkey", "o_orderstatus", "revision"], "kept")


@query(
    "cross_table_guard",
    """
    select 'section' as kind, l_orderkey as k, l_linenumber as n from lineitem join orders on o_orderkey = l_orderkey
      where l_linenumber is not null and not exists
        (select 1 from part where p_partkey = o_custkey and p_size % 7 + 1 = l_linenumber)
    union all
    select 'confidence', l_orderkey, l_linenumber from lineitem where l_returnflag = 'A' and l_discount <> 0.05
    """,
)
def cross_table_guard(spark, sf_dir):
    t = Tables(spark, sf_dir)
    entries = t.lineitem.select(F.col("l_orderkey").alias("roll_id"), F.col("l_linenumber").alias("section_no"))
    rolls = t.orders.select(F.col("o_orderkey").alias("roll_id"), F.col("o_custkey").alias("part_id"))
    sections = t.part.select(F.col("p_partkey").alias("part_id"), (F.col("p_size") % 7 + 1).alias("section_no"))
    stray = quality.sections_in_part(entries, rolls, sections)
    placements = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "A", "epic").otherwise("fuzzy").alias("match_method"),
        F.when(F.col("l_discount") == 0.05, F.lit(1)).otherwise(F.lit(0)).alias("match_confidence"),
    )
    unsure = quality.key_matches_certain(placements)
    return stray.select(F.lit("section").alias("kind"), F.col("roll_id").alias("k"), F.col("section_no").alias("n")).unionByName(
        unsure.select(F.lit("confidence").alias("kind"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))
    )


@query(
    "child_lookup",
    """
    with s as (select p_brand, p_size, min(p_partkey) as section_id from part group by 1, 2)
    select l_orderkey, l_linenumber, l_partkey, section_id from lineitem join part on p_partkey = l_partkey
      left join s on s.p_brand = part.p_brand and s.p_size = nullif(l_quantity::int % 40, 0)
    """,
)
def child_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    sections = t.part.groupBy("p_brand", "p_size").agg(F.min("p_partkey").alias("section_id"))
    asked = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand", (F.col("l_quantity").cast("int") % 40).alias("no")
    )
    sections = sections.withColumnRenamed("p_size", "no")
    return resolve.child_by_number(asked, sections, "p_brand", "no", "section_id").drop("p_brand", "no")
