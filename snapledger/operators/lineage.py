"""Area lineage across eras: closure of the predecessor graph, and classes of its edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.operators.groupwise import lookup
from snapledger.session import cut


def closure(
    edges: DataFrame, seeds: DataFrame, src: str = "successor_ac_id", dst: str = "predecessor_ac_id",
    node: str = "ac_id",
) -> DataFrame:
    """Every node that ``seeds`` (``root``, ``node``) reach along ``src -> dst``, seeds included.

    Set semantics: a pair is kept once, so cycles end. Each round doubles the length of the paths that are followed, so
    rounds grow with the logarithm of the depth; its two tables are written to the shared folder, which keeps the plan short
    and survives lost executors. Null targets (a new area has no predecessor) end a walk.
    """
    hops = cut(edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias(node), F.col(dst).alias("__to")).distinct())
    seen = cut(seeds.select("root", node).distinct())
    count = seen.count()
    while True:
        reached = seen.join(hops, node).select("root", F.col("__to").alias(node))
        seen = cut(seen.unionByName(reached).distinct())
        before, count = count, seen.count()
        if count == before:
            return seen
        further = hops.join(hops.select(F.col(node).alias("__to"), F.col("__to").alias("__next")), "__to").select(node, F.col("__next").alias("__to"))
        hops = cut(hops.unionByName(further).distinct())


def change_class(
    edges: DataFrame, pred: str = "predecessor_ac_id", succ: str = "successor_ac_id",
    pred_no=None, succ_no=None, pred_home=None, succ_home=None,
) -> DataFrame:
    """Class of each edge from its degrees (and number and home of both ends, where given)."""
    out_degree = edges.filter(F.col(pred).isNotNull()).groupBy(pred).agg(F.count(succ).alias("__out"))
    in_degree = edges.filter(F.col(succ).isNotNull()).groupBy(succ).agg(F.count(pred).alias("__in"))
    rows = lookup(lookup(edges, out_degree, [pred], ["__out"]), in_degree, [succ], ["__in"])
    label = F.when(F.col(pred).isNull(), "new").when(F.col(succ).isNull(), "abolished")
    if pred_home is not None:
        label = label.when(pred_home != succ_home, "rehomed")
    label = label.when(F.col("__out") > 1, "split").when(F.col("__in") > 1, "merge")
    if pred_no is not None:
        label = label.when(pred_no != succ_no, "renumber")
    return rows.withColumn("change_class", label.otherwise("unchanged")).drop("__out", "__in")


def rolls_of(areas: DataFrame, parts: DataFrame, rolls: DataFrame) -> DataFrame:
    """All rolls of a set of areas (``root``, ``ac_id``), newest first."""
    return (
        areas.join(parts.select("part_id", "ac_id"), "ac_id")
        .join(rolls, "part_id")
        .orderBy("root", F.col("date_of_publication").desc_nulls_last(), "roll_id")
    )


def inherit(
    areas: DataFrame, edges: DataFrame, key: Sequence[str], era: str, eras: Sequence[str], cols: Sequence[str],
) -> DataFrame:
    """``areas`` with nulls of ``cols`` filled along lineage, and the successors that no row shows yet.

    ``edges``: ``predecessor_<key>`` and ``<key>``. Era by era in the order of time an area takes the value that its
    predecessors hold, if those that hold one agree; so a renumbered or re-homed area and the parts of a split one inherit,
    and a merged one only what is not in question. One aggregate and one join for each era; only edges into it take part.
    """
    told = edges.filter(" and ".join(f"{k} is not null" for k in key)).select(*key).distinct()
    known = areas.unionByName(told.join(areas.select(*key), list(key), "left_anti"), allowMissingColumns=True)
    done = None
    for name in eras:
        own = known.filter(F.col(era) == name)
        if done is not None:
            before = done.select(*[F.col(k).alias(f"predecessor_{k}") for k in key], *cols)
            held = edges.filter(F.col(era) == name).join(before, [f"predecessor_{k}" for k in key])
            agreed = [F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c)).alias(f"__{c}") for c in cols]
            own = lookup(own, held.groupBy(*key).agg(*agreed), key, [f"__{c}" for c in cols])
            own = own.withColumns({c: F.coalesce(c, f"__{c}") for c in cols}).drop(*[f"__{c}" for c in cols])
        done = cut(own) if done is None else done.unionByName(cut(own))
    others = known.filter(~F.coalesce(F.col(era).isin(*eras), F.lit(False)))
    return others if done is None else done.unionByName(others)


def era_scoped(rolls: DataFrame, area: Sequence[str], era: str = "era_name") -> DataFrame:
    """Areas under their era-scoped keys: an area seen in two eras is two rows, linked by lineage."""
    return rolls.groupBy(era, *area).agg(F.count("*").alias("rolls"))
