"""Ledger state and progress, on events: the document is the user, order is (ts, event_id)."""

from pyspark.sql import functions as F

from snapledger.operators import manifest, merge
from snapledger.queries.registry import Tables, query

STATUS = "case event_type when 'purchase' then 'verified' when 'error' then 'failed' else 'pending' end"
STAGE = "case event_type when 'view' then 'extracted' when 'purchase' then 'done' when 'click' then 'archived' end"
ERROR = "case event_type when 'error' then concat('e', cast(event_id as varchar(20))) when 'purchase' then '' end"
COUNT = "case when event_id % 3 = 0 then cast(event_id % 1000 as int) end"
ARCHIVE = "case when event_type = 'click' and event_id % 2 = 0 then concat('a/', cast(event_id as varchar(20))) end"
STAMPS = {"status": STATUS, "stage": STAGE, "error": ERROR, "elector_count": COUNT, "archive_uri": ARCHIVE}
SEQ = ("ts", "event_id")
LATEST_SQL = "\n".join(
    f"{',' if i else ''} {'nullif(' if k == 'error' else ''}"
    f"arg_max({k}, (ts, event_id)) filter (where {k} is not null){chr(44) + chr(32) + chr(39) * 2 + ')' if k == 'error' else ''} as {k}"
    for i, k in enumerate(STAMPS)
)
EVENTS_SQL = f"select user_id, ts, event_id, event_type, {', '.join(f'{v} as {k}' for k, v in STAMPS.items())} from events"


def _events(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("user_id", "ts", "event_id", "event_type", *[F.expr(v).alias(k) for k, v in STAMPS.items()])


def _latest(spark, sf_dir):
    return manifest.latest_state(_events(spark, sf_dir), ["user_id"], SEQ, list(STAMPS), ["error"])


@query("latest_state", f"select user_id, {LATEST_SQL} from ({EVENTS_SQL}) e group by user_id")
def latest_state(spark, sf_dir):
    return _latest(spark, sf_dir)


@query("attempts", "select user_id, count(*) filter (where event_type = 'click') as attempts from events group by 1")
def attempts(spark, sf_dir):
    return manifest.attempts(Tables(spark, sf_dir).events, ["user_id"], F.col("event_type") == "click")


@query(
    "resume_set",
    f"""
    with l as (select user_id, {LATEST_SQL} from ({EVENTS_SQL}) e group by user_id)
    select user_id, stage, case when elector_count % 2 = 0 then 'load' else 'rejected' end as gate
    from l where status = 'verified' and stage is distinct from 'archived' and stage is distinct from 'done'
    union all
    select user_id, stage, 'forced' from l where status = 'verified'
    """,
)
def resume_set(spark, sf_dir):
    jobs = _latest(spark, sf_dir)
    todo = manifest.resume_set(jobs).filter(~F.col("stage").eqNullSafe("archived"))
    gated = manifest.qc_gate(todo.withColumn("reconciles", F.col("elector_count") % 2 == 0), required=True)
    forced = manifest.resume_set(jobs, force=True).withColumn("gate", F.lit("forced"))
    return gated.select("user_id", "stage", "gate").unionByName(forced.select("user_id", "stage", "gate"))


@query(
    "retention_gate",
    f"""
    with l as (select user_id, {LATEST_SQL} from ({EVENTS_SQL}) e group by user_id)
    select user_id, stage, archive_uri from l where stage in ('archived', 'done') and archive_uri is not null
    """,
)
def retention_gate(spark, sf_dir):
    return manifest.clearable(_latest(spark, sf_dir)).select("user_id", "stage", "archive_uri")


@query(
    "group_progress",
    f"""
    with e as ({EVENTS_SQL})
    select user_id, count(*) as total, cast(sum(case when status = 'verified' then 1 else 0 end) as bigint) as verified,
      cast(sum(case when status = 'failed' then 1 else 0 end) as bigint) as failed from e group by 1
    """,
)
def group_progress(spark, sf_dir):
    return manifest.group_progress(_events(spark, sf_dir), ["user_id"])


@query(
    "stage_histogram",
    f"select user_id, coalesce(stage, '(none)') as stage, count(*) as n from ({EVENTS_SQL}) e group by 1, 2",
)
def stage_histogram(spark, sf_dir):
    return manifest.stage_histogram(_events(spark, sf_dir), keys=["user_id"])


@query(
    "job_stats",
    """
    select 'status' as kind, o_orderstatus as a, null as b, count(*) as parts from orders group by 2
    union all select 'group', o_orderpriority, cast(year(o_orderdate) as varchar), count(*) from orders group by 2, 3
    union all select 'ready', cast(o_custkey as varchar), null, null
      from (select distinct o_custkey from orders where o_orderstatus = 'F')
    """,
)
def job_stats(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y"), "o_custkey")
    none = F.lit(None).cast("string")
    by_status = manifest.counts_by(o, ["o_orderstatus"])
    by_group = manifest.counts_by(o, ["o_orderpriority", "y"])
    ready = o.filter("o_orderstatus = 'F'").select("o_custkey").distinct()
    return (
        by_status.select(F.lit("status").alias("kind"), F.col("o_orderstatus").alias("a"), none.alias("b"), "parts")
        .unionByName(by_group.select(F.lit("group").alias("kind"), F.col("o_orderpriority").alias("a"),
                                     F.col("y").cast("string").alias("b"), "parts"))
        .unionByName(ready.select(F.lit("ready").alias("kind"), F.col("o_custkey").cast("string").alias("a"),
                                  none.alias("b"), F.lit(None).cast("bigint").alias("parts")))
    )


@query(
    "run_tally",
    """
    select case when o_orderpriority = '5-LOW' then 'skipped' when o_orderstatus = 'F' then 'done' else 'failed' end
      as outcome, count(*) as n from orders group by 1
    """,
)
def run_tally(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return manifest.run_tally(o, F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") == "F")


@query(
    "availability_menu",
    """
    with o as (select c_nationkey, o_orderkey, year(o_orderdate) as y, o_orderstatus, o_orderpriority
               from orders join customer on c_custkey = o_custkey)
    select c_nationkey, string_agg(distinct cast(y as varchar), ',' order by cast(y as varchar)) as years,
      string_agg(distinct o_orderstatus, ',' order by o_orderstatus) as roll_types,
      string_agg(distinct o_orderpriority, ',' order by o_orderpriority) as languages,
      count(distinct o_orderkey) as parts_count from o group by 1
    """,
)
def availability_menu(spark, sf_dir):
    t = Tables(spark, sf_dir)
    offers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_nationkey", "o_orderkey", F.year("o_orderdate").alias("y"), "o_orderstatus", "o_orderpriority"
    )
    menus = {"years": "y", "roll_types": "o_orderstatus", "languages": "o_orderpriority"}
    return manifest.availability(offers, ["c_nationkey"], menus, "o_orderkey")


@query(
    "delivery_summary",
    """
    select l_orderkey, count(*) as parts, count(*) filter (where l_returnflag <> 'N') as requested,
      count(*) filter (where l_linestatus = 'F') as downloaded,
      count(*) filter (where l_linestatus = 'F' and l_returnflag <> 'N') as verified,
      count(*) filter (where l_linestatus = 'F' and l_returnflag <> 'N')
        = count(*) filter (where l_returnflag <> 'N') as ok
    from lineitem group by 1
    """,
)
def delivery_summary(spark, sf_dir):
    asked, got = F.col("l_returnflag") != "N", F.col("l_linestatus") == "F"
    return manifest.delivery_summary(Tables(spark, sf_dir).lineitem, ["l_orderkey"], asked, got, asked & got)


@query(
    "crawl_latest",
    """
    select event_type, user_id % 10 as region, arg_max(event_id, (ts, event_id)) as last_id,
      arg_max(case when value > 50 then 'ok' else 'error' end, (ts, event_id)) as status,
      arg_max(case when value > 50 then '' else cast(event_id as varchar) end, (ts, event_id)) as error
    from events group by 1, 2
    """,
)
def crawl_latest(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    good = F.col("value") > 50
    log = e.select(
        "event_type", (F.col("user_id") % 10).alias("region"), "ts", "event_id", F.col("event_id").alias("last_id"),
        F.when(good, "ok").otherwise("error").alias("status"),
        F.when(good, "").otherwise(F.col("event_id").cast("string")).alias("error"),
    )
    return manifest.latest_per_scope(log, ["event_type", "region"], ["ts", "event_id"], ["last_id", "status", "error"])


KEY_PART = "case when o_orderkey % 50 = 0 then null else o_orderpriority end"


@query(
    "insert_absent",
    f"""
    with o as (select o_custkey, {KEY_PART} as pr, o_orderkey, o_orderdate from orders),
    old as (select o_custkey, pr, min(o_orderkey) as o_orderkey from o
            where o_orderdate < timestamp '1997-01-01' and pr is not null group by 1, 2),
    new as (select * from o where o_orderdate >= timestamp '1997-01-01')
    select 'old' as src, * from old
    union all select 'new', o_custkey, pr, o_orderkey from new where pr is null
    union all select 'new', o_custkey, pr, min(o_orderkey) from new where pr is not null
      and not exists (select 1 from old where old.o_custkey = new.o_custkey and old.pr = new.pr) group by 2, 3
    """,
)
def insert_absent(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_custkey", F.expr(KEY_PART).alias("pr"), "o_orderkey", "o_orderdate")
    cutoff = F.lit("1997-01-01").cast("timestamp_ntz")
    old = o.filter((F.col("o_orderdate") < cutoff) & F.col("pr").isNotNull()).groupBy("o_custkey", "pr").agg(
        F.min("o_orderkey").alias("o_orderkey")
    ).withColumn("src", F.lit("old"))
    new = o.filter(F.col("o_orderdate") >= cutoff).drop("o_orderdate").withColumn("src", F.lit("new"))
    merged, _ = merge.insert_absent(old, new, ["o_custkey", "pr"], ["o_orderkey"])
    return merged.select("src", "o_custkey", "pr", "o_orderkey")


@query(
    "upsert_policy",
    """
    select o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) as first_priority,
      arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as last_status,
      arg_max(o_totalprice, (o_orderdate, o_orderkey)) filter (where o_orderkey % 3 = 0) as last_price
    from orders group by 1
    """,
)
def upsert_policy(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("first_priority"),
        F.col("o_orderstatus").alias("last_status"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).alias("last_price"),
    )
    return merge.upsert(
        o, ["o_custkey"], F.struct("o_orderdate", "o_orderkey"), last=["last_status"], first=["first_priority"],
        last_filled=["last_price"],
    )


@query(
    "anti_semi_lookup",
    """
    select 'without_orders' as kind, c_custkey as k from customer
      where not exists (select 1 from orders where o_custkey = c_custkey)
    union all select 'with_urgent', c_custkey from customer
      where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')
    union all select 'to_do', o_orderkey from orders
      where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = 'F')
    """,
)
def anti_semi_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    buyers = t.orders.select(F.col("o_custkey").alias("k"), "o_orderpriority")
    customers = t.customer.select(F.col("c_custkey").alias("k"))
    orders = t.orders.select(F.col("o_orderkey").alias("k"))
    done = t.lineitem.filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("k"))
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), "k")
    return (
        tag(manifest.outstanding(customers, buyers, ["k"]), "without_orders")
        .unionByName(tag(customers.join(buyers.filter("o_orderpriority = '1-URGENT'"), "k", "left_semi"), "with_urgent"))
        .unionByName(tag(manifest.outstanding(orders, done, ["k"]), "to_do"))
    )


@query(
    "set_difference",
    """
    select l_orderkey, l_linenumber from (
      select distinct l_orderkey, l_linenumber from lineitem where l_returnflag <> 'N'
      except select l_orderkey, l_linenumber from lineitem where l_linestatus = 'F')
    """,
)
def set_difference(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    keys = ["l_orderkey", "l_linenumber"]
    listed = li.filter("l_returnflag <> 'N'").select(*keys).distinct()
    return manifest.outstanding(listed, li.filter("l_linestatus = 'F'"), keys)


@query(
    "ordered_topn",
    """
    with k as (select o_orderkey, o_custkey, case when o_orderkey % 10 = 0 then null else o_orderdate end as d from orders),
    r as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by d desc nulls last, o_orderkey)
          as n from k)
    select o_custkey, o_orderkey, n from r where n <= 3
    union all
    (select -1, o_orderkey, null from k order by d asc nulls last, o_orderkey limit 25)
    """,
)
def ordered_topn(spark, sf_dir):
    from pyspark.sql import Window

    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", "o_custkey", F.expr("case when o_orderkey % 10 = 0 then null else o_orderdate end").alias("d")
    )
    newest = Window.partitionBy("o_custkey").orderBy(F.col("d").desc_nulls_last(), "o_orderkey")
    per_key = o.withColumn("n", F.row_number().over(newest).cast("bigint")).filter("n <= 3").select("o_custkey", "o_orderkey", "n")
    oldest = o.orderBy(F.col("d").asc_nulls_last(), "o_orderkey").limit(25)
    return per_key.unionByName(
        oldest.select(F.lit(-1).cast("bigint").alias("o_custkey"), "o_orderkey", F.lit(None).cast("bigint").alias("n"))
    )


@query(
    "correlated_counts",
    """
    select r_regionkey, r_name, (select count(*) from nation where n_regionkey = r_regionkey) as nations,
      (select count(*) from customer join nation on n_nationkey = c_nationkey where n_regionkey = r_regionkey
         and c_acctbal > 9990) as rich_customers,
      (select count(*) from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
         where n_regionkey = r_regionkey) as orders
    from region
    """,
)
def correlated_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nation = t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    customer = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return manifest.child_counts(
        t.region, "r_regionkey", nations=nation, rich_customers=customer.filter("c_acctbal > 9990"), orders=orders
    )


@query(
    "manifest_stats",
    """
    select 'customers' as metric, count(*) as n from customer union all select 'orders', count(*) from orders
    union all select 'events', count(*) from events
    union all select 'failed:' || event_type || ':' || user_id, count(*) from events where event_type = 'error'
      group by event_type, user_id
    """,
)
def manifest_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("metric"), "n")
    failed = t.events.filter("event_type = 'error'").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    scope = F.concat(F.lit("failed:"), "event_type", F.lit(":"), F.col("user_id").cast("string"))
    return (
        one(t.customer, "customers").unionByName(one(t.orders, "orders")).unionByName(one(t.events, "events"))
        .unionByName(failed.select(scope.alias("metric"), "n"))
    )


@query("first_areas", "select distinct o_custkey % 97 as ac_no from orders where o_orderstatus = 'P' order by 1 limit 20")
def first_areas(spark, sf_dir):
    """The first twenty areas that have documents left, in order."""
    o = Tables(spark, sf_dir).orders.filter("o_orderstatus = 'P'").select((F.col("o_custkey") % 97).alias("ac_no"))
    return manifest.first_areas(o, n=20)
