"""Streams over the given tables, drained once and read back."""

import uuid

from pyspark.sql import functions as F

from snapledger.queries import identity as persons
from snapledger.queries import ledger
from snapledger.queries.registry import Tables, query
from snapledger.session import cut, shared_dir
from snapledger.streaming import ledger as stream


def _folder(spark):
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


@query(
    "stream_latest",
    f"select user_id, {ledger.LATEST_SQL} from ({ledger.EVENTS_SQL}) e group by user_id",
)
def stream_latest(spark, sf_dir):
    schema = Tables(spark, sf_dir).events.schema
    events = stream.read_stream(spark, f"{sf_dir}/events.parquet", schema).select(
        "user_id", "ts", "event_id", *[F.expr(v).alias(k) for k, v in ledger.STAMPS.items()]
    )
    out = _folder(spark)
    stream.run_latest_state(
        events, ["user_id"], ledger.SEQ, list(ledger.STAMPS), f"{out}/state", f"{out}/checkpoint", ["error"]
    )
    return stream.read_latest_state(spark, f"{out}/state", ["user_id"])


@query(
    "stream_identity",
    f"""
    with {persons.ENTRY_SQL}
    select sha256('key|' || k) as person_id, k as epic_no,
      arg_min(nm, (o_orderdate, l_linenumber, l_orderkey, nm)) as canonical_name, count(*) as placements
    from e where k is not null group by k
    """,
)
def stream_identity(spark, sf_dir):
    """The registry over documents that arrive era by era, each era in several files and a micro-batch of its own."""
    t = Tables(spark, sf_dir)
    rolls = t.orders.select(F.col("o_orderkey").alias("roll_id"), F.col("o_orderdate").alias("ingest_seq"))
    entries = t.lineitem.select(
        F.col("l_orderkey").alias("roll_id"), F.col("l_linenumber").alias("serial_no"),
        F.expr(persons.KEY).alias("epic_no"), F.expr(persons.NAME).alias("full_name"),
    ).join(rolls, "roll_id")
    entries = cut(entries)
    out, year = _folder(spark), F.year("ingest_seq")
    registry = "person_id string, epic_no string, first_roll_id bigint"
    prepare = lambda df: df.withColumn("serial_no", F.struct("serial_no", "roll_id", "full_name"))
    for start in sorted(r[0] for r in rolls.select(F.year("ingest_seq") - F.year("ingest_seq") % 2).distinct().collect()):
        entries.filter((year >= start) & (year < start + 2)).repartition(3).write.mode("append").parquet(f"{out}/in")
        stream.run_identity(stream.read_stream(spark, f"{out}/in", entries.schema), out, f"{out}/checkpoint", registry, prepare, every=2)
    found = stream.read_identity(spark, out, registry)
    return found["person"].join(found["placement"].groupBy("person_id").agg(F.count("*").alias("placements")), "person_id")


LATE = "event_id % 5 = 0"


@query(
    "stream_attempts",
    f"""
    with half as (select min(ts) + (max(ts) - min(ts)) / 2 as h from events),
    first as (select e.* from events e, half where ts < h and not {LATE}),
    mark as (select max(ts) - interval 3 day as w from first),
    counted as (select user_id, event_type from first union all
      select user_id, event_type from events, half, mark where (ts >= h or {LATE}) and ts >= w)
    select user_id, count(*) filter (where event_type = 'click') as attempts from counted group by 1
    """,
)
def stream_attempts(spark, sf_dir):
    """Attempts from events that arrive twice or late: each counts once, and those over three days late do not count."""
    e = Tables(spark, sf_dir).events.withColumn("ts", F.col("ts").cast("timestamp"))
    ends = e.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    half = ends.select((F.col("a") + (F.col("b") - F.col("a")) / 2).alias("h")).first()["h"]
    before, out = F.col("ts") < F.lit(half), _folder(spark)
    first = e.filter(before & ~F.expr(LATE))
    recent = first.filter(F.col("event_id") % 3 == 0)
    for part in (first.unionByName(recent), e.filter(~before | F.expr(LATE)).unionByName(recent)):
        part.repartition(2).write.mode("append").parquet(f"{out}/in")
        events = stream.read_stream(spark, f"{out}/in", e.schema)
        stream.run_attempts(events, ["user_id"], "event_id", "ts", "3 days", F.col("event_type") == "click", f"{out}/counts", f"{out}/checkpoint")
    return stream.read_latest_state(spark, f"{out}/counts", ["user_id"])
