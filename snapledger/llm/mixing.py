"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each source has a word budget. Complete epochs of it come first; the rest of the budget goes to its documents in the order of
exponential keys, ``-ln(u) / weight``, so that a document of higher quality weight comes sooner. The cut in that order is
found by narrowing: sizes are summed over bins of the key, then over finer bins of the one bin that holds the cut, so only
the few documents of the last bin are ever sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.storage import stored

BINS = 1024
#: At most so many times the source's own size.
REPEATS = 3
#: Weights of a document by its quality label: 1, 0, and none.
QUALITY = (2.0, 0.5, 1.0)
WORD = r"[^\x20\x09-\x0D]+"
_U = float(1 << 48)


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exponential_key(doc_id: Column, text: Column, weight: Column) -> Column:
    """An exponential variable of rate ``weight``; its randomness is md5 of the document, so reruns agree."""
    name = F.md5(F.concat_ws(":", F.lit("mix"), doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    u = (F.conv(F.substring(name, 1, 12), 16, 10).cast("double") + 0.5) / _U
    return -F.log(u) / weight


def measured(df: DataFrame, quality: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, key and place (of the key, from 0 to 1), and the columns of ``keep`` as a struct ``kept``."""
    kept = [F.struct(*(F.col(c) for c in keep)).alias("kept")] if keep else []
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size_of(F.col(text_col)).alias("size"),
                     exponential_key(F.col(id_col), F.col(text_col), F.lit(1.0)).alias("unit"), *kept)
    best = quality.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    weight = F.when(F.col("quality") == 1, QUALITY[0]).when(F.col("quality") == 0, QUALITY[1]).otherwise(QUALITY[2])
    key = F.col("unit") / weight
    return rows.join(best, "doc_id", "left").select("doc_id", "source", "size", key.alias("key"), (1 - F.exp(-key)).alias("place"), *(["kept"] if keep else []))


def targets(rows: DataFrame) -> DataFrame:
    """of (the source), source_size, target, epochs, rest: one row per source.

    Sources by code point, null last, weigh 1, 2, 3, repeating. The targets are the level of water poured into vessels of
    width weight and volume REPEATS times the size, all words in all: sources by the level at which they are full, the first
    ones full, the others at one level. One task holds one row per source; a source is a dataset, not a document.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.select("*", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("rank"), F.sum("source_size").over(Window.partitionBy()).alias("total"))
    vessels = ranked.select("source", "source_size", "rank", "total", ((F.col("rank") - 1) % 3 + 1).alias("weight"), (REPEATS * F.col("source_size")).alias("most"))
    vessels = vessels.withColumn("full", F.col("most") / F.col("weight"))
    order = Window.orderBy("full", "rank")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    width = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = ((F.col("total") - before) / width).alias("level")
    levels = vessels.select("*", level).withColumn("level", F.max(F.when(F.col("level") < F.col("full"), F.col("level"))).over(Window.partitionBy()))
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    aimed = levels.select(F.col("source").alias("of"), "source_size", target.alias("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return aimed.select("*", epochs.alias("epochs"), (F.floor("target") - epochs * F.col("source_size")).cast("long").alias("rest"))


def _bin(level: int) -> Column:
    """The bin of a key, within its bin of the level before."""
    scaled = F.col("place") * float(BINS ** (level - 1))
    return F.least(F.lit(BINS - 1), F.floor((scaled - F.floor(scaled)) * BINS)).cast("int") if level > 1 else F.least(F.lit(BINS - 1), F.floor(F.col("place") * BINS)).cast("int")


def _own() -> Column:
    return F.col("source").eqNullSafe(F.col("of"))


def _narrow(rows: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """``plan`` with the bin of this level in which the source's budget ends (cut), and the words before it (before)."""
    sums = rows.groupBy("source", _bin(level).alias("bin")).agg(F.sum("size").alias("words"))
    running = sums.select("*", F.sum("words").over(Window.partitionBy("source").orderBy("bin")).alias("until"))
    over = running.join(plan, _own()).where(F.col("before") + F.col("until") > F.col("rest"))
    first = over.groupBy("source").agg(F.min("bin").alias(f"cut{level}"), F.min_by(F.col("before") + F.col("until") - F.col("words"), "bin").alias("words_before"))
    out = plan.join(first, _own(), "left")
    return out.select(*(c for c in plan.columns if c != "before"), f"cut{level}", F.coalesce("words_before", "before").alias("before"))


def planned(rows: DataFrame) -> DataFrame:
    """Targets and cuts of all sources: a small table, one row per source."""
    plan = stored(_narrow(rows, targets(rows).withColumn("before", F.lit(0).cast("long")), 1))
    inside = rows.join(plan, _own()).where(_bin(1) == F.col("cut1")).select("source", "size", "place")
    return stored(_narrow(inside, plan, 2))


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and taken: the words that the mix takes from each.

    A document is taken ``epochs`` times; once more if it stands before the cut in key order, and in part if the budget ends
    within it, so that each source's words are its target, rounded down.
    """
    both = rows.join(plan, _own()).drop("of")
    first, second = F.coalesce("cut1", F.lit(-1)), F.coalesce("cut2", F.lit(-1))
    whole = (_bin(1) < first) | ((_bin(1) == first) & (_bin(2) < second))
    last = (_bin(1) == first) & (_bin(2) == second)
    rest = both.where(~last).withColumn("part", F.when(whole, F.col("size")).otherwise(0))
    order = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    sorted_ = both.where(last).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    cut = sorted_.withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("ahead")))).drop("ahead")
    return rest.unionByName(cut).withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long")).drop("before", "cut1", "cut2", "rest")


def mix(df: DataFrame, quality: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per input row.

    ``quality`` (doc_id, quality): of several labels the highest counts; none weighs as unlabelled. A null or empty text has
    size 0 and takes nothing; documents without a source are a source of their own, the last; repeated rows are documents of
    their own with equal keys, the cut falls on one of them; other columns are left out; an empty table gives no rows. Keys
    come from md5 of id and text, so reruns agree.
    """
    rows = stored(measured(df, quality))
    return taken(rows, planned(rows)).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""
with quality as (select doc_id, max(quality) quality from labels where doc_id is not null group by 1),
rows_ as (
  select d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+')) size,
    (('0x' || md5(concat_ws(':', 'mix', cast(d.doc_id as varchar), md5(coalesce(d.text, ''))))[1:12])::ubigint::double + 0.5) / {_U} u,
    case quality when 1 then {QUALITY[0]} when 0 then {QUALITY[1]} else {QUALITY[2]} end w
  from documents d left join quality using (doc_id)),
sources as (select source, sum(size)::bigint source_size, sum(sum(size)) over ()::bigint total, row_number() over (order by source nulls last) rank from rows_ group by source),
vessels as (select *, (rank - 1) % 3 + 1 weight, {REPEATS} * source_size most from sources),
levels as (
  select *, most / weight as "full", (total - coalesce(sum(most) over (order by most / weight, rank rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by most / weight, rank rows between current row and unbounded following) level from vessels),
aimed as (
  select source, source_size, least(most::double, coalesce((max(case when level < "full" then level end) over ()) * weight, 0.0)) target from levels),
budgets as (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint epochs from aimed),
ordered as (
  select r.*, b.source_size, b.target, b.epochs, floor(b.target)::bigint - b.epochs * b.source_size rest,
    coalesce(sum(size) over (partition by r.source order by -ln(u) / w, r.doc_id nulls last, size rows between unbounded preceding and 1 preceding), 0)::bigint ahead
  from rows_ r join budgets b on r.source is not distinct from b.source)
select doc_id, size::bigint size, source_size, target, (epochs * size + greatest(0, least(size, rest - ahead)))::bigint taken from ordered
"""
