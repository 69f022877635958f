"""The document ledger: latest state, progress, what is left to do, what may be cleared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.groupwise import lookup
from snapledger.operators.merge import upsert

READY = "verified"


def latest_state(
    events: DataFrame, keys: Sequence[str], seq: Sequence[str], stamped: Sequence[str], clearable: Sequence[str] = (),
) -> DataFrame:
    """Last value of each stamped field per key. A null leaves the old value, '' clears it.

    Events whose key has a null part match no document and change nothing.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    out = upsert(events.filter(whole), keys, F.struct(*seq), last_filled=stamped)
    return out.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in clearable})


def apply_events(jobs: DataFrame, events: DataFrame, keys: Sequence[str], seq: Sequence[str],
                 stamped: Sequence[str], clearable: Sequence[str] = ()) -> DataFrame:
    """Known jobs with their latest state; events of unknown jobs are ignored."""
    state = latest_state(events, keys, seq, stamped, clearable)
    return lookup(jobs, state, keys, stamped)


def attempts(events: DataFrame, keys: Sequence[str], is_attempt: Column) -> DataFrame:
    return events.groupBy(*keys).agg(F.count_if(is_attempt).alias("attempts"))


def resume_set(jobs: DataFrame, status: str = "status", stage: str = "stage", force: bool = False) -> DataFrame:
    """Ready jobs that are not done (all ready ones when forced)."""
    ready = jobs.filter(F.col(status) == READY)
    return ready if force else ready.filter(~F.col(stage).eqNullSafe("done"))


def qc_gate(jobs: DataFrame, reconciles: str = "reconciles", required: bool = False) -> DataFrame:
    """``gate``: load, load_flagged (does not reconcile) or rejected (does not, but must)."""
    good = F.coalesce(F.col(reconciles), F.lit(False))
    return jobs.withColumn(
        "gate", F.when(good, "load").otherwise(F.lit("rejected" if required else "load_flagged"))
    )


def clearable(jobs: DataFrame, stage: str = "stage", archive: str = "archive_uri") -> DataFrame:
    """Jobs whose local file may go: loaded and archived, never only one of the two."""
    return jobs.filter(F.col(stage).isin("archived", "done") & F.col(archive).isNotNull())


def latest_per_scope(log: DataFrame, scope: Sequence[str], seq: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Latest log row per scope, nulls included."""
    return upsert(log, scope, F.struct(*seq), last=fields)


def group_progress(jobs: DataFrame, keys: Sequence[str], status: str = "status") -> DataFrame:
    return jobs.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.sum(F.when(F.col(status) == "verified", 1).otherwise(0)).alias("verified"),
        F.sum(F.when(F.col(status) == "failed", 1).otherwise(0)).alias("failed"),
    )


def counts_by(jobs: DataFrame, keys: Sequence[str], name: str = "parts") -> DataFrame:
    return jobs.groupBy(*keys).agg(F.count("*").alias(name))


def stage_histogram(jobs: DataFrame, stage: str = "stage", keys: Sequence[str] = ()) -> DataFrame:
    return jobs.groupBy(*keys, F.coalesce(F.col(stage), F.lit("(none)")).alias("stage")).agg(F.count("*").alias("n"))


def run_tally(jobs: DataFrame, done_before: Column, succeeded: Column, force: bool = False) -> DataFrame:
    """done / failed / skipped counts; work done before is skipped unless forced."""
    outcome = F.when(succeeded, "done").otherwise("failed")
    if not force:
        outcome = F.when(F.coalesce(done_before, F.lit(False)), "skipped").otherwise(outcome)
    return jobs.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def child_counts(parents: DataFrame, key: str, **children: DataFrame) -> DataFrame:
    """Parents with the number of rows each child table has for them, zero included."""
    out = parents
    for name, child in children.items():
        counted = child.groupBy(key).agg(F.count("*").alias(name))
        out = lookup(out, counted, [key], [name]).withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return out


def outstanding(listed: DataFrame, verified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Listed parts that are not verified (or, with deliveries as the second side, undelivered)."""
    return listed.join(verified.select(*keys).distinct(), list(keys), "left_anti")


def availability(
    offers: DataFrame, keys: Sequence[str], menus: dict[str, str], part: str, sep: str = ","
) -> DataFrame:
    """Sorted distinct menu values per area (as joined text) and the number of distinct parts.

    Menus are enumerations of a few values each; the sets are merged before the shuffle.
    """
    sets = [
        F.concat_ws(sep, F.array_sort(F.collect_set(F.col(c).cast("string")))).alias(n) for n, c in menus.items()
    ]
    menu = offers.select(*keys, *menus.values()).distinct().groupBy(*keys).agg(*sets)
    parts = offers.select(*keys, part).distinct().groupBy(*keys).agg(F.count(part).alias("parts_count"))
    return lookup(menu, parts, keys, ["parts_count"])


def delivery_summary(
    parts: DataFrame, keys: Sequence[str], requested: Column, downloaded: Column, verified: Column
) -> DataFrame:
    out = parts.groupBy(*keys).agg(
        F.count("*").alias("parts"),
        F.count_if(requested).alias("requested"),
        F.count_if(downloaded).alias("downloaded"),
        F.count_if(verified).alias("verified"),
    )
    return out.withColumn("ok", F.col("verified") == F.col("requested"))


def latest_publication(rolls: DataFrame, keys: Sequence[str], published: str = "date_of_publication") -> DataFrame:
    return rolls.groupBy(*keys).agg(F.max(published).alias("latest_publication"), F.count("*").alias("rolls"))


def first_areas(jobs: DataFrame, area: str = "ac_no", n: int | None = None) -> DataFrame:
    """Distinct areas in order, the first ``n`` of them when the work is bounded."""
    areas = jobs.select(area).distinct().orderBy(area)
    return areas if n is None else areas.limit(n)
