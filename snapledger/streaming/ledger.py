"""The ledger and the identity registry as incremental jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators import identity
from snapledger.operators.manifest import latest_state
from snapledger.session import cut, scratch
from snapledger.sources.versions import Versions


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A parquet file, or the parquet files of a folder, as a stream; the checkpoint remembers which were read.

    Only a pattern may match a single file as well as a folder, so the path is given as one, its own signs escaped.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = path.rstrip("/")
    at = max(i for i, c in enumerate(path) if c.isalnum())
    return reader.parquet("".join(f"[{c}]" if i == at else f"\\{c}" if c in "[]{}*?\\" else c for i, c in enumerate(path)))


#: Micro-batches between two compactions of a table that a stream writes.
EVERY = 8


def _tidy(tables: Sequence[Versions], batch: int, every: int) -> None:
    """Compacts up to the batch before, which is done for good: the running one may have to be replayed."""
    if batch and batch % every == 0:
        for table in tables:
            table.compact(batch - 1)


def run_latest_state(
    events: DataFrame, keys: Sequence[str], seq: Sequence[str], stamped: Sequence[str], sink: str, checkpoint: str,
    clearable: Sequence[str] = (), every: int = EVERY,
) -> None:
    """Running state per key, until the source is drained.

    The state is ``max_by`` per field, so neither order nor repetition of events matters and no
    watermark is needed: the outcome equals the batch job over the same events. Each micro-batch
    writes the full state of the keys it touched as a version of the table at ``sink``.
    """
    state = latest_state(events, keys, seq, stamped, clearable)
    _drain(state, Versions(events.sparkSession, sink, state.schema, keys), checkpoint, every)


def _drain(updates: DataFrame, table: Versions, checkpoint: str, every: int) -> None:
    """Writes the updates of each micro-batch as a version, until the source is drained."""
    def load(df: DataFrame, batch: int) -> None:
        _tidy([table], batch, every)
        table.write(df, batch)

    query = (
        updates.writeStream.outputMode("update")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_latest_state(spark: SparkSession, sink: str, keys: Sequence[str], as_of: int | None = None) -> DataFrame:
    """Latest written state of each key, or that as of a micro-batch."""
    written = spark.read.option("recursiveFileLookup", "true").parquet(sink).schema
    return Versions(spark, sink, written, keys).read(as_of)


def run_attempts(
    events: DataFrame, keys: Sequence[str], event_id: str, ts: str, lateness: str, is_attempt, sink: str, checkpoint: str,
    every: int = EVERY,
) -> None:
    """``count_attempts`` until the source is drained; each micro-batch writes the counts that it changed."""
    counts = count_attempts(events, keys, event_id, ts, lateness, is_attempt)
    _drain(counts, Versions(events.sparkSession, sink, counts.schema, keys), checkpoint, every)


def count_attempts(
    events: DataFrame, keys: Sequence[str], event_id: str, ts: str, lateness: str, is_attempt
) -> DataFrame:
    """Streaming attempt counter. Unlike a state, a count must see each event once, so repeats
    within ``lateness`` are dropped; events later than that are lost, which is the contract."""
    unique = events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([event_id])
    return unique.groupBy(*keys).agg(F.count_if(is_attempt).alias("attempts"))


def run_identity(
    entries: DataFrame, root: str, checkpoint: str, registry_schema: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, buckets: int = 16, every: int = EVERY,
) -> None:
    """Registers unseen keys and places the entries of every new batch of documents.

    ``entries``: roll_id, serial_no, epic_no, full_name, ingest_seq (after ``prepare``, which is read twice, so it gives the same
    rows each time). The registry is dealt into buckets
    by key: a micro-batch reads those that its keys fall into, once, and writes its new keys only.
    """
    spark = entries.sparkSession
    registry = _registry(spark, root, registry_schema, buckets)

    def load(df: DataFrame, batch: int) -> None:
        with scratch(spark):
            register(df, batch)

    def register(df: DataFrame, batch: int) -> None:
        rows = prepare(df)
        touched = [r[0] for r in rows.filter("epic_no is not null").select(registry.bucket_of()).distinct().collect()]
        known = registry.read(batch - 1, touched).select("epic_no", F.col("person_id").alias("__known"))
        met = cut(rows.filter("epic_no is not null").join(known, "epic_no", "left"))
        fresh = identity.new_keys(met.filter("__known is null"))
        placed = met.select(
            F.coalesce("__known", identity.person_id("epic_no")).alias("person_id"), "roll_id", "serial_no",
            F.lit("epic").alias("match_method"), F.lit("1.000").cast("decimal(4,3)").alias("match_confidence"),
        )
        placements = Versions(spark, f"{root}/placement", placed.schema)
        _tidy([registry, placements], batch, every)
        registry.write(fresh, batch)
        placements.write(placed, batch)

    query = (
        entries.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _registry(spark: SparkSession, root: str, registry_schema: str, buckets: int) -> Versions:
    return Versions(spark, f"{root}/registry", f"{registry_schema}, canonical_name string", ["epic_no"], buckets=buckets)


def read_identity(spark: SparkSession, root: str, registry_schema: str, buckets: int = 16) -> dict[str, DataFrame]:
    """person, person_epic and placement as ``run_identity`` left them."""
    known = _registry(spark, root, registry_schema, buckets).read()
    placed = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/placement").schema
    return {
        "person": known.select("person_id", "epic_no", "canonical_name"),
        "person_epic": known.drop("canonical_name"),
        "placement": Versions(spark, f"{root}/placement", placed).read(),
    }
