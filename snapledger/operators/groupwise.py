"""Group values next to their rows, without pulling a whole group into one window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dealt(side: DataFrame) -> DataFrame:
    """``side`` of a join that has a row for each document, person or profile: both sides are dealt by key, always.

    Whether a side is gathered on the driver and sent to all is decided by the size of its files times the share of its columns by
    type. Written tables of few distinct values or of many empty columns come out up to a hundred times too small in that, so a
    side that grows with the input could outgrow the driver.
    """
    return side.hint("merge")


#: Rows that a table may be sent with.
FEW = 1 << 17


def sized(side: DataFrame) -> DataFrame:
    """A written ``side`` that is dealt if it is counted to be more than FEW rows; else Spark may choose."""
    return side if side.count() <= FEW else dealt(side)


def attach(df: DataFrame, keys: Sequence[str], null_safe: bool = False, **aggs: Column) -> DataFrame:
    """Each row of ``df`` with aggregates of its group.

    A whole-partition window would sort one group inside one task. Here the aggregate is
    partial before its shuffle, and the join back is one that AQE may broadcast (measured size)
    or split (skewed key). Null keys get nulls unless ``null_safe``.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return lookup(df, totals, keys, list(aggs), null_safe)


def lookup(
    df: DataFrame, side: DataFrame, keys: Sequence[str], cols: Sequence[str], null_safe: bool = False, grows: bool = False
) -> DataFrame:
    """Left join of ``cols`` from ``side``, whose ``keys`` are unique; names stay those of ``df``. ``grows``: see ``dealt``."""
    renamed = side.select(*[F.col(k).alias(f"__{k}") for k in keys], *cols)
    renamed = dealt(renamed) if grows else renamed
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__{k}")) if null_safe else F.col(k) == F.col(f"__{k}")
        on = same if on is None else on & same
    return df.join(renamed, on, "left").drop(*[f"__{k}" for k in keys])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the first in ``order``.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle, so a key
    that holds a third of the rows sends one row per map task.
    """
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
