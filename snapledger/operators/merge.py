"""Insert-if-absent and upsert with a policy per column, as plain DataFrame merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.groupwise import first_by


def not_yet_in(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key ``old`` lacks. A null in the key matches nothing, so such rows stay."""
    return new.join(old.select(*keys).distinct(), list(keys), "left_anti")


def insert_absent(
    old: DataFrame, new: DataFrame, keys: Sequence[str], arrival: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(merged table, rows really inserted). Old rows win; of equal new keys the first to arrive.

    Keys with a null part are distinct from each other: they are never de-duplicated. They take
    their own branch, so the de-duplication never gathers all of them in one group.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    order = [F.col(c).asc_nulls_last() for c in (arrival or new.columns)]
    unique = first_by(new.filter(whole), list(keys), order)
    fresh = not_yet_in(unique, old, keys).unionByName(new.filter(~whole))
    return old.unionByName(fresh, allowMissingColumns=True), fresh


def upsert(
    rows: DataFrame, keys: Sequence[str], seq: Column, last: Sequence[str] = (), first: Sequence[str] = (),
    last_filled: Sequence[str] = (),
) -> DataFrame:
    """All versions of each key folded into one row.

    ``first`` columns keep the earliest version's value, nulls included; ``last`` columns take
    the latest one's; ``last_filled`` the latest non-null one. ``seq`` must be unique per key.
    ``rows`` is the old table united with the changes. One aggregate, partial before the shuffle.
    """
    at = F.struct(seq)
    aggs = []
    if first:
        aggs.append(F.min_by(F.struct(*first), at).alias("__first"))
    if last:
        aggs.append(F.max_by(F.struct(*last), at).alias("__last"))
    for c in last_filled:
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c))
    out = rows.groupBy(*keys).agg(*aggs)
    picked = [F.col(f"__first.{c}").alias(c) for c in first] + [F.col(f"__last.{c}").alias(c) for c in last]
    return out.select(*keys, *picked, *last_filled)
