"""Ordered scans (carry forward, lag / lead, running sum) that survive one huge group.

A window over ``(keys) order by (order)`` sorts a whole group in one task. Each function here
takes ``block``: a column that never decreases along the order within a key (a page range, an
hour). Rows are scanned per ``(keys, block)``; one summary row per block is scanned per key; and
the two results are joined. The answer equals the plain window. Blocks with more than TARGET rows
are cut further along the order, so no task scans many more than that, however the rows lie.
``keys`` must be non-null, ``order`` total within a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.operators.groupwise import lookup

BLOCK = "__block"
#: Rows of a block, about, and marks that are drawn from as many rows to place its cuts.
TARGET, MARKS = 1 << 20, 64


def _order(order: Sequence[str]) -> Column:
    return F.struct(*order)


def bounded(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column) -> DataFrame:
    """``df`` with BLOCK: (the given block, its part), in order; a part has about TARGET rows at most.

    Counts per key and block, with marks at rows that a hash of key and order draws, so at the same ones whenever it runs.
    Blocks that are too large are cut at every MARKS-th mark; these few cuts are joined to their rows.
    """
    rows = df.withColumn("__whole", block)
    drawn = F.pmod(F.xxhash64(*keys, *order), F.lit(max(1, TARGET // MARKS))) == 0
    counts = rows.groupBy(*keys, "__whole").agg(
        F.count("*").alias("__n"), F.array_sort(F.collect_list(F.when(drawn, _order(order)))).alias("__marks"))
    places = F.when(F.size("__marks") > MARKS, F.sequence(F.lit(MARKS), F.size("__marks") - 1, F.lit(MARKS)))
    cuts = counts.filter(F.col("__n") > TARGET).select(*keys, "__whole", F.transform(places, lambda i: F.get("__marks", i)).alias("__cuts"))
    out = lookup(rows, cuts, [*keys, "__whole"], ["__cuts"])
    part = F.coalesce(F.size(F.filter("__cuts", lambda c: c <= _order(order))), F.lit(0))
    return out.withColumn(BLOCK, F.struct("__whole", F.greatest(part, F.lit(0)).alias("part"))).drop("__whole", "__cuts")


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, block: Column, name: str
) -> DataFrame:
    """Last non-null ``value`` up to and including the current row."""
    rows = bounded(df, keys, order, block).withColumn("__v", value)
    per_block = [*keys, BLOCK]
    last = F.max_by("__v", F.when(F.col("__v").isNotNull(), _order(order)))
    blocks = rows.groupBy(*per_block).agg(last.alias("__last"))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*per_block, F.last("__last", ignorenulls=True).over(before).alias("__in"))
    upto = Window.partitionBy(*per_block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("__own", F.last("__v", ignorenulls=True).over(upto))
    out = lookup(local, carried, per_block, ["__in"])
    return out.withColumn(name, F.coalesce("__own", "__in")).drop("__v", "__own", "__in", BLOCK)


def _neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, Column], block: Column, step: int
) -> DataFrame:
    per_block = [*keys, BLOCK]
    rows = bounded(df, keys, order, block).withColumn("__v", F.struct(*[c.alias(n) for n, c in cols.items()]))
    edge = F.max_by("__v", _order(order)) if step > 0 else F.min_by("__v", _order(order))
    ends = rows.groupBy(*per_block).agg(edge.alias("__edge"))
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    inside = Window.partitionBy(*per_block).orderBy(*order)
    edges = ends.select(*per_block, F.lag("__edge", step).over(along).alias("__in"))
    local = rows.withColumn("__own", F.lag("__v", step).over(inside))
    out = lookup(local, edges, per_block, ["__in"])
    near = F.coalesce("__own", "__in")
    return out.withColumns({n: near[n] for n in cols}).drop("__v", "__own", "__in", BLOCK)


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, **cols: Column
) -> DataFrame:
    """``lag`` of several columns at once."""
    return _neighbour(df, keys, order, cols, block, 1)


def following(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, **cols: Column
) -> DataFrame:
    """``lead`` of several columns at once."""
    return _neighbour(df, keys, order, cols, block, -1)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, block: Column, name: str
) -> DataFrame:
    """Sum of ``value`` from the start of the group to the current row (bigint)."""
    per_block = [*keys, BLOCK]
    rows = bounded(df, keys, order, block).withColumn("__v", value.cast("bigint"))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*per_block).agg(F.sum("__v").alias("__sum"))
    offsets = sums.select(*per_block, F.sum("__sum").over(before).alias("__in"))
    upto = Window.partitionBy(*per_block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("__own", F.sum("__v").over(upto))
    out = lookup(local, offsets, per_block, ["__in"])
    total = F.coalesce("__in", F.lit(0)) + F.coalesce("__own", F.lit(0))
    return out.withColumn(name, total).drop("__v", "__own", "__in", BLOCK)


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, name: str) -> DataFrame:
    """Number of each row within its key, from 1: counts per block give the offset, rows are numbered within their block."""
    return running_sum(df, keys, order, F.lit(1), block, name)


def gap_sessions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], new_when: Column, block: Column, name: str
) -> DataFrame:
    """Session number from 1: a row for which ``new_when`` holds (or is null: the first) opens one."""
    opens = F.coalesce(new_when, F.lit(True)).cast("int")
    return running_sum(df, keys, order, opens, block, name)


def order_statistic(
    df: DataFrame, keys: Sequence[str], value: str, rank: Column, width: float, name: str
) -> DataFrame:
    """Exact value at zero-based ``rank`` (a column over ``__n``, the group's row count) per key.

    Counts per (key, value) are merged before the shuffle; a coarse pass over value ranges of
    ``width`` finds the one range holding the rank, and only that range is sorted.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__c"))
    counts = bounded(counts, keys, [value], F.floor(F.col(value) / F.lit(float(width))))
    coarse = counts.groupBy(*keys, BLOCK).agg(F.sum("__c").alias("__s"))
    # one row per value range: few enough to scan per key
    along = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    target = (
        coarse.withColumn("__before", F.coalesce(F.sum("__s").over(along), F.lit(0)))
        .withColumn("__n", F.sum("__s").over(Window.partitionBy(*keys)))
        .withColumn("__rank", rank.cast("bigint"))
        .filter("__before <= __rank and __rank < __before + __s")
        .select(*keys, BLOCK, "__before", "__rank")
    )
    fine = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.join(target, [*keys, BLOCK])
        .withColumn("__upto", F.col("__before") + F.sum("__c").over(fine))
        .filter("__upto > __rank")
        .groupBy(*keys)
        .agg(F.min(value).alias(name))
    )


def upper_median(df: DataFrame, keys: Sequence[str], value: str, width: float, name: str) -> DataFrame:
    """``sorted(values)[n // 2]``: of two middle values the upper one, never their mean."""
    return order_statistic(df, keys, value, F.floor(F.col("__n") / 2), width, name)
