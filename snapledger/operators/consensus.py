"""Competing reads of one record: consensus, scores, votes and hold-out splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.groupwise import first_by, lookup


def disagreements(first: DataFrame, second: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Both reads side by side (``a_*``, ``b_*``) with the array of fields that differ."""
    a = first.select(key, *[F.col(f).alias(f"a_{f}") for f in fields])
    b = second.select(key, *[F.col(f).alias(f"b_{f}") for f in fields])
    differ = F.array_compact(
        F.array(*[F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.lit(f)) for f in fields])
    )
    return a.join(b, key).withColumn("differ", differ)


def to_escalate(first: DataFrame, second: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Records for the third reader; filter the input of the expensive reader with it."""
    return disagreements(first, second, key, fields).filter(F.size("differ") > 0).select(key)


def consensus(
    first: DataFrame, second: DataFrame, third: DataFrame | None, key: str, fields: Sequence[str]
) -> DataFrame:
    """Agreed value, else the third reader's, else the first's with the field flagged."""
    both = disagreements(first, second, key, fields)
    if third is None:
        third = first.sparkSession.createDataFrame([], first.select(key, *fields).schema)
    c = third.select(key, F.lit(True).alias("__read"), *[F.col(f).alias(f"c_{f}") for f in fields])
    out = lookup(both, c, [key], ["__read", *[f"c_{f}" for f in fields]])
    read = F.coalesce("__read", F.lit(False))
    agree = {f: ~F.array_contains("differ", F.lit(f)) for f in fields}
    return out.select(
        key,
        *[
            F.when(agree[f], F.col(f"a_{f}")).when(read, F.col(f"c_{f}")).otherwise(F.col(f"a_{f}")).alias(f)
            for f in fields
        ],
        F.when(read, F.array().cast("array<string>")).otherwise(F.col("differ")).alias("flagged"),
        F.size("differ").alias("n_differ"),
    )


def escalation_rate(first: DataFrame, second: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Share of fields that need a third read."""
    d = disagreements(first, second, key, fields)
    return d.agg(
        F.count("*").alias("records"), F.sum(F.size("differ")).cast("bigint").alias("escalated"),
    ).withColumn("escalated_rate", F.round(F.col("escalated") / (F.col("records") * len(fields)), 6))


def field_scores(pred: DataFrame, truth: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Per field: records, exact matches, edit distance and reference length (at least 1 each)."""
    p = pred.select(key, *[F.col(f).alias(f"p_{f}") for f in fields])
    t = truth.select(key, *[F.col(f).alias(f"t_{f}") for f in fields])
    sums = []
    for f in fields:
        a, b = F.coalesce(f"p_{f}", F.lit("")), F.coalesce(f"t_{f}", F.lit(""))
        sums += [
            F.count_if(a == b).alias(f"e_{f}"),
            F.sum(F.levenshtein(a, b)).cast("bigint").alias(f"d_{f}"),
            F.sum(F.greatest(F.length(b), F.lit(1))).cast("bigint").alias(f"n_{f}"),
        ]
    totals = t.join(p, key).agg(F.count("*").alias("records"), *sums)
    rows = [
        F.struct(F.lit(f).alias("field"), F.col(f"e_{f}").alias("exact"), F.col(f"d_{f}").alias("edits"),
                 F.col(f"n_{f}").alias("chars"))
        for f in fields
    ]
    return totals.select("records", F.explode(F.array(*rows)).alias("r")).select("records", "r.*")


def char_accuracy(scores: DataFrame) -> DataFrame:
    """1 - edits / characters over all fields, and the mean of the exact rates."""
    return scores.agg(
        F.round(1 - F.sum("edits") / F.greatest(F.sum("chars"), F.lit(1)), 6).alias("char_accuracy"),
        F.round(F.avg(F.col("exact") / F.col("records")), 6).alias("avg_field_accuracy"),
    )


def line_scores(df: DataFrame, pred: str, truth: str, parts: int, sep: str = " | ") -> DataFrame:
    """Scores of whole joined lines: the prediction is trimmed for the distance, parts are padded."""
    p, t = F.col(pred), F.col(truth)
    quoted = r"\Q" + sep + r"\E"
    at = lambda c, i: F.btrim(F.coalesce(F.get(F.split(c, quoted), F.lit(i)), F.lit("")))
    return df.agg(
        F.count("*").alias("records"),
        F.sum(F.levenshtein(F.btrim(p), t)).cast("bigint").alias("edits"),
        F.greatest(F.sum(F.length(t)), F.lit(1)).cast("bigint").alias("chars"),
        *[F.count_if(at(p, i) == at(t, i)).alias(f"exact_{i}") for i in range(parts)],
    )


def positional_scores(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """Characters equal at their position, reference length and exact lines."""
    same = F.size(
        F.filter(
            F.zip_with(F.split(F.col(pred), ""), F.split(F.col(truth), ""), lambda a, b: a == b),
            lambda hit: F.coalesce(hit, F.lit(False)),
        )
    )
    ok = F.when((F.col(pred) == "") | (F.col(truth) == ""), 0).otherwise(same)
    return df.agg(
        F.sum(ok).cast("bigint").alias("chars_ok"),
        F.sum(F.length(truth)).cast("bigint").alias("chars"),
        F.count_if(F.col(pred) == F.col(truth)).alias("exact"),
        F.count("*").alias("records"),
    )


def best_checkpoint(evals: DataFrame, keys: Sequence[str], score: str, epoch: str) -> DataFrame:
    """Epoch with the highest score; of equal scores the later epoch."""
    top = F.max(F.struct(F.col(score).alias("s"), F.col(epoch).alias("e")))
    return evals.groupBy(*keys).agg(top.alias("__t")).select(
        *keys, F.col("__t.e").alias("best_epoch"), F.col("__t.s").alias("best_score")
    )


def mode_vote(votes: DataFrame, keys: Sequence[str], value: str, tie: Column | None = None) -> DataFrame:
    """Most frequent value per key; ``tie`` orders equal counts (default: the lowest value)."""
    counted = votes.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("votes"))
    return first_by(counted, keys, [F.col("votes").desc(), tie if tie is not None else F.col(value).asc()])


def trainable(samples: DataFrame, flag: str = "flag", excluded: str = "no_stamp_exclude") -> DataFrame:
    """All samples but those flagged as excluded; an absent flag keeps the sample."""
    return samples.filter(~F.col(flag).eqNullSafe(excluded))


def clean(samples: DataFrame, uncertain: str = "uncertain", review: str = "review") -> DataFrame:
    return samples.filter(~F.coalesce(F.col(uncertain), F.lit(False)) & ~F.coalesce(F.col(review), F.lit(False)))


def holdout(pool: DataFrame, candidates: DataFrame, key: str, n: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(validation, training): ``n`` candidates in a seeded hash order, and the rest of the pool.

    The order is a top-k, so only ``n`` rows per task travel.
    """
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    val = candidates.orderBy(order, key).limit(n)
    return val, pool.join(val.select(key), key, "left_anti")
