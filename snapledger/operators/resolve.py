"""Lookups: labels to catalog rows, names to codes, dates to eras, optional links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions.text import as_col, code_shaped, group, strip, to_int
from snapledger.operators.groupwise import lookup


def by_number_or_name(
    labels: DataFrame, catalog: DataFrame, scope: Sequence[str], label: str, number: str, name: str,
    cols: Sequence[str],
) -> DataFrame:
    """``12 - Foo`` or ``Foo`` -> catalog columns, within ``scope`` (for example one state).

    The leading number decides; only where it finds nothing does the case-insensitive name.
    Of several rows with one name the lowest number is taken.
    """
    head = r"^(\d+)\s*-\s*"
    asked = labels.withColumns(
        {
            "__no": to_int(group(label, head)),
            "__name": F.lower(strip(F.regexp_replace(as_col(label), head, ""))),
        }
    )
    found = F.struct(F.lit(1).alias("hit"), *cols)
    by_no = catalog.select(*scope, F.col(number).cast("int").alias("__no"), found.alias("__by_no"))
    by_name = (
        catalog.groupBy(*scope, F.lower(F.col(name)).alias("__name"))
        .agg(F.min_by(found, F.col(number)).alias("__by_name"))
    )
    out = lookup(asked, by_no, [*scope, "__no"], ["__by_no"])
    out = lookup(out, by_name, [*scope, "__name"], ["__by_name"])
    hit = F.coalesce("__by_no", "__by_name")
    return out.withColumns({c: hit[c] for c in cols}).drop("__no", "__name", "__by_no", "__by_name")


def name_to_code(
    asked: DataFrame, states: DataFrame, name: str, state_name: str = "state_name", state_cd: str = "state_cd",
    out: str = "resolved_cd",
) -> DataFrame:
    """Case-insensitive name -> code; input that already looks like a code stands for itself."""
    side = states.groupBy(F.lower(F.col(state_name)).alias("__low")).agg(F.min(state_cd).alias("__code"))
    found = lookup(asked.withColumn("__low", F.lower(F.col(name))), side, ["__low"], ["__code"])
    itself = F.when(code_shaped(name), F.col(name))
    return found.withColumn(out, F.coalesce("__code", itself)).drop("__low", "__code")


def era_of(df: DataFrame, eras: DataFrame, date: str, keep: Sequence[str] = ("era_name",)) -> DataFrame:
    """The era with ``from <= date < to`` (an open ``to`` never ends); null outside all eras.

    Eras are few, one for each redrawing of boundaries, and become one array, a scalar subquery. So rows neither move nor meet
    on a key of a few values. A date in several eras gives a row for each.
    """
    listed = eras.agg(F.array_sort(F.collect_list(F.struct("effective_from", "effective_to", *keep)))).scalar()
    when = F.col(date).cast("date")
    fits = F.filter("__eras", lambda e: (e["effective_from"] <= when) & (e["effective_to"].isNull() | (when < e["effective_to"])))
    found = F.transform(fits, lambda e: F.struct(*[e[k].alias(k) for k in keep]))
    return df.withColumn("__eras", listed).select(*df.columns, F.inline_outer(found))


def child_by_number(
    df: DataFrame, children: DataFrame, parent: str, number: str, child_id: str
) -> DataFrame:
    """Id of a numbered child of ``parent``; null when the number is absent, zero or unknown."""
    asked = df.withColumn("__no", F.nullif(F.col(number), F.lit(0)))
    side = children.select(parent, F.col(number).alias("__no"), child_id)
    return lookup(asked, side, [parent, "__no"], [child_id]).drop("__no")


def override(
    cards: DataFrame, fixes: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Non-empty fields of a re-read replace those of the card."""
    side = fixes.select(*keys, *[F.col(f).alias(f"__fix_{f}") for f in fields])
    out = lookup(cards, side, keys, [f"__fix_{f}" for f in fields])
    return out.withColumns(
        {f: F.coalesce(F.nullif(F.col(f"__fix_{f}"), F.lit("")), F.col(f)) for f in fields}
    ).drop(*[f"__fix_{f}" for f in fields])


def has_supplement(rolls: DataFrame, entries: DataFrame, key: str = "roll_id", status: str = "status") -> DataFrame:
    """Rolls with ``has_supplement``: a non-zero change total, or any added or modified entry."""
    moved = entries.groupBy(key).agg(F.bool_or(F.col(status).isin("added", "modified")).alias("__moved"))
    printed = F.lit(False)
    for c in ("additions_total", "deletions_total", "num_modifications"):
        printed = printed | (F.coalesce(F.col(c), F.lit(0)) != 0)
    out = lookup(rolls, moved, [key], ["__moved"], grows=True)
    return out.withColumn("has_supplement", printed | F.coalesce("__moved", F.lit(False))).drop("__moved")


def supplement_link(
    entries: DataFrame, rolls: DataFrame, key: str = "roll_id", status: str = "status",
    link: str = "linked_supplement_no",
) -> DataFrame:
    """Supplement that an added or modified entry belongs to (its own number, 1 when unread)."""
    out = lookup(entries, rolls.filter("has_supplement"), [key], ["has_supplement"], grows=True)
    moved = F.col("has_supplement") & F.col(status).isin("added", "modified")
    number = F.coalesce("supplement_no", F.lit(1)) if "supplement_no" in entries.columns else F.lit(1)
    return out.withColumn(link, F.when(moved, number)).drop("has_supplement")


def defaults(chain: dict[str, Sequence[Column]]) -> dict[str, Column]:
    """Default chains as columns: the first value that is neither null nor ''."""
    return {n: F.coalesce(*[F.when(c.cast("string") != "", c) for c in cols]) for n, cols in chain.items()}


def section_rows(df: DataFrame, keys: Sequence[str], sections: str = "sections") -> DataFrame:
    """One row per numbered section; a document without a list has the one section 1."""
    only = F.array(F.struct(F.lit(1).alias("section_no"), F.lit(None).cast("string").alias("section_name")))
    listed = F.when(F.size(F.col(sections)) > 0, F.col(sections)).otherwise(only)
    return (
        df.select(*keys, F.explode(listed).alias("__s"))
        .select(*keys, "__s.section_no", "__s.section_name")
        .filter("section_no is not null and section_no <> 0")
    )
