"""Extracted entries against the totals that a document prints about itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.groupwise import lookup

COUNTS = (
    "cards_printed", "deletions", "additions", "modifications",
    "live_cards", "live_male", "live_female", "live_third_gender",
)

NETS = ("net_male", "net_female", "net_third_gender")


def entry_counts(entries: DataFrame, key: str = "roll_id", status: str = "entry_status") -> DataFrame:
    """One aggregate over the entries; a missing status counts as live."""
    s = F.coalesce(F.col(status), F.lit("active"))
    live = s != "deleted"
    return entries.groupBy(key).agg(
        F.count("*").alias("cards_printed"),
        F.count_if(s == "deleted").alias("deletions"),
        F.count_if(s == "added").alias("additions"),
        F.count_if(s == "modified").alias("modifications"),
        F.count_if(live).alias("live_cards"),
        F.count_if(live & (F.col("gender") == "Male")).alias("live_male"),
        F.count_if(live & (F.col("gender") == "Female")).alias("live_female"),
        F.count_if(live & (F.col("gender") == "ThirdGender")).alias("live_third_gender"),
    )


def counted(rolls: DataFrame, entries: DataFrame, key: str, status: str) -> DataFrame:
    """Every roll with its counts; a roll without entries has zeros."""
    out = lookup(rolls, entry_counts(entries, key, status), [key], COUNTS)
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in COUNTS})


def _agrees(printed: Column, found: Column) -> Column:
    """A total that is not printed cannot disagree."""
    return F.coalesce(printed == found, F.lit(True))


def roll_reconciliation(
    rolls: DataFrame, entries: DataFrame, summary: DataFrame, cover: DataFrame, key: str = "roll_id",
    status: str = "entry_status",
) -> DataFrame:
    """The analyst view: counts per roll, printed totals and a verdict that is never null.

    Entries are aggregated before the 1:1 tables are joined, so the joins see one row per roll.
    """
    out = counted(rolls.select(key), entries, key, status)
    printed = summary.withColumnsRenamed({"net_total": "summary_net_total"})
    out = lookup(out, printed, [key], ["summary_net_total", *NETS])
    out = lookup(out, cover.withColumnRenamed("net_total", "cover_net_total"), [key], ["cover_net_total"])
    return judged(out)


def judged(out: DataFrame) -> DataFrame:
    """Rolls with counts and all printed totals (``summary_net_total``, ``cover_net_total``, NETS) and the verdict in their place."""
    total, cover_total = F.col("summary_net_total"), F.col("cover_net_total")
    verdict = (
        (F.col("live_cards") == total)
        & (cover_total.isNull() | (cover_total == total))
        & _agrees(F.col("net_male"), F.col("live_male"))
        & _agrees(F.col("net_female"), F.col("live_female"))
        & _agrees(F.col("net_third_gender"), F.col("live_third_gender"))
    )
    return out.withColumns(
        {
            "has_summary": total.isNotNull(),
            "cover_matches_summary": cover_total == total,
            "reconciles": F.coalesce(verdict, F.lit(False)),
        }
    ).drop(*NETS)


CHECKS = {
    "net_total": "live_cards",
    "net_male": "live_male",
    "net_female": "live_female",
    "net_third_gender": "live_third_gender",
    "additions_total": "additions",
    "deletions_total": "deletions",
}


def reconcile(
    rolls: DataFrame, entries: DataFrame, summary: DataFrame, key: str = "roll_id", status: str = "status",
) -> DataFrame:
    """Counts, a map of single checks and the overall verdict (all checks and a printed total)."""
    out = lookup(counted(rolls.select(key), entries, key, status), summary, [key], list(CHECKS))
    pairs: list[Column] = []
    for printed, found in CHECKS.items():
        pairs += [F.lit(printed.removesuffix("_total") if "net" not in printed else printed),
                  _agrees(F.col(printed), F.col(found))]
    pairs += [F.lit("has_summary"), F.col("net_total").isNotNull()]
    out = out.withColumn("checks", F.create_map(*pairs))
    return out.withColumn("reconciles", F.forall(F.map_values("checks"), lambda ok: ok))


def component_identity(
    rows: DataFrame, summary: DataFrame, key: str = "roll_id", ordinal: str = "row_ordinal",
    measures: Sequence[tuple[str, str]] = (
        ("male", "net_male"), ("female", "net_female"), ("third_gender", "net_third_gender"), ("total", "net_total"),
    ),
) -> DataFrame:
    """NET = I + II - III + IV per measure; ``*_holds`` is null where a side is missing."""
    sign = F.when(F.col(ordinal) == "III", -1).when(F.col(ordinal).isin("I", "II", "IV"), 1)
    sums = rows.groupBy(key).agg(*[F.sum(F.col(m) * sign).alias(f"{m}_sum") for m, _ in measures])
    out = lookup(sums, summary, [key], [net for _, net in measures])
    return out.withColumns({f"{m}_holds": F.col(f"{m}_sum") == F.col(net) for m, net in measures})
