"""Labelled pages -> records: the summary table and the cover form.

All labels of a page are found in one aggregate over its tokens, the values next to them in a
second one; no pairs of tokens are ever formed, and both are partial before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions import fixed, values
from snapledger.functions.text import after_colon, contains_any, despace, filled, group, strip, to_int
from snapledger.operators.groupwise import lookup
from snapledger.session import cut

IMAGE = "image_id"


def label_rows(tokens: DataFrame, labels: dict[str, str], keys: Sequence[str] = (IMAGE,)) -> DataFrame:
    """One row per image and label found: the token ``at`` (x, y, h, text) that carries its needle.

    An exact match (spaces and case aside) comes before a containing one, then the topmost.
    Tokens without any label are dropped before they are grouped.
    """
    wanted = {name: re.sub(r"\s+", "", needle).lower() for name, needle in labels.items()}
    flat = F.col("__flat")
    named = tokens.withColumn("__flat", F.lower(despace("text"))).filter(contains_any(flat, list(wanted.values())))
    hits = [
        F.when(F.contains(flat, F.lit(needle)), F.struct(F.lit(name).alias("label"), (flat != needle).alias("partial")))
        for name, needle in wanted.items()
    ]
    rows = named.select(
        *keys, "x", "y", "tok_no", "text", _height().alias("h"), F.explode(F.array_compact(F.array(*hits))).alias("__hit")
    )
    token, rank = F.struct("x", "y", "h", "text"), F.struct("__hit.partial", "y", "tok_no")
    return rows.groupBy(*keys, F.col("__hit.label").alias("label")).agg(F.min_by(token, rank).alias("at"))


def _wide(rows: DataFrame, keys: Sequence[str], value: str, names: Sequence[str]) -> DataFrame:
    """Label rows -> one row per image with a column per label; an image has as many rows as labels."""
    found = F.map_from_entries(F.collect_list(F.struct("label", value)))
    folded = rows.groupBy(*keys).agg(found.alias("__m"))
    return folded.select(*keys, *[F.try_element_at("__m", F.lit(n)).alias(n) for n in names])


def find_labels(tokens: DataFrame, labels: dict[str, str], keys: Sequence[str] = (IMAGE,)) -> DataFrame:
    """One row per image that has any label; column ``name`` is the token of that label, or null."""
    return _wide(label_rows(tokens, labels, keys), keys, "at", list(labels))


def _height() -> Column:
    """Token height, at least 12; an unknown or zero height counts as 12."""
    h = F.coalesce(F.nullif(F.col("y2") - F.col("y"), F.lit(0.0)), F.lit(fixed.LEAST_LABEL_HEIGHT))
    return F.greatest(h, F.lit(fixed.LEAST_LABEL_HEIGHT))


def label_values(
    tokens: DataFrame, right: dict[str, str], under: dict[str, str], keys: Sequence[str] = (IMAGE,),
    tolerance: float = fixed.RIGHT_TOLERANCE, max_gap: float = fixed.BELOW_TO,
) -> DataFrame:
    """Values printed right of / below their labels; text after a colon where there is one.

    Right: the nearest token on the label's row. Below: the first one within ``max_gap`` label
    heights. A label without a token to its right may carry the value itself, after its own colon.
    Tokens and labels meet in bands of y, so a token meets the labels near it, not all of its image.
    """
    labels = cut(label_rows(tokens, {**right, **under}, keys))
    lower = F.col("label").isin(*under) if under else F.lit(False)
    h, y = F.col("at.h"), F.col("at.y")
    ranged = labels.withColumns({
        "__below": lower, "__lo": F.when(lower, y + fixed.BELOW_FROM * h).otherwise(y - tolerance * h),
        "__hi": F.when(lower, y + max_gap * h).otherwise(y + tolerance * h)})
    # a label reaches over a range of y; bands are as high as the largest range of its kind, so it lies in two of them at most
    span = F.col("__hi") - F.col("__lo")
    largest = ranged.agg(F.struct(F.max(F.when(~F.col("__below"), span)).alias("right"), F.max(F.when(F.col("__below"), span)).alias("below"))).scalar()

    def band(v: Column, kind: str) -> Column:
        return F.floor(v / F.greatest(F.col("__largest")[kind], F.lit(1.0)))

    def bands(kind: str) -> Column:
        return F.array_distinct(F.array(band(F.col("__lo"), kind), band(F.col("__hi"), kind)))

    placed = ranged.withColumn("__largest", largest).withColumn("__band", F.explode(F.when(F.col("__below"), bands("below")).otherwise(bands("right"))))
    both = F.array(F.struct(F.lit(False).alias("below"), band(F.col("y"), "right").alias("band")), F.struct(F.lit(True).alias("below"), band(F.col("y"), "below").alias("band")))
    near = tokens.select(*keys, "x", "y", "tok_no", "text").withColumn("__largest", largest)
    near = near.select(*keys, "x", "y", "tok_no", "text", F.inline(both).alias("__below", "__band"))
    others = near.join(placed.drop("__lo", "__hi", "__largest"), [*keys, "__below", "__band"])
    at, dx, dy = F.col("at"), F.col("x") - F.col("at.x"), F.col("y") - F.col("at.y")
    is_below = F.col("__below")
    on_row = ~is_below & (F.abs(dy) < tolerance * at["h"]) & (F.col("x") > at["x"] + fixed.RIGHT_OFFSET)
    beneath = (
        is_below & (F.col("y") > at["y"] + fixed.BELOW_FROM * at["h"]) & (F.col("y") < at["y"] + max_gap * at["h"])
        & (dx < fixed.BELOW_WIDTH * at["h"])
    )
    order = F.struct(F.when(is_below, F.col("y")).otherwise(F.col("x")), "x", "tok_no")
    near = others.filter(on_row | beneath).groupBy(*keys, "label").agg(F.min_by("text", order).alias("__v"))
    found = lookup(labels, near, [*keys, "label"], ["__v"])
    own = F.when(~lower & F.contains(F.col("at.text"), F.lit(":")), F.col("at.text"))
    found = found.withColumn("value", filled(after_colon(F.coalesce("__v", own))))
    names = [*right, *under]
    return lookup(tokens.select(*keys).distinct(), _wide(found, keys, "value", names), keys, names)


def nearest(x: Column, headers: Sequence[tuple[str, Column]]) -> Column:
    """Name of the header nearest in x; absent headers do not count, the earlier one wins a tie."""
    spans = F.array(*[
        F.when(hx.isNotNull(), F.struct(F.abs(hx - x).alias("d"), F.lit(i).alias("i"), F.lit(name).alias("name")))
        for i, (name, hx) in enumerate(headers)
    ])
    return F.array_min(F.array_compact(spans))["name"]


def parse_summary(tokens: DataFrame) -> DataFrame:
    """Summary page: net totals, additions, deletions and modifications, read by position."""
    low = F.col("__low")
    marks = []
    for head, name in fixed.SUMMARY_HEADS:
        marks.append(F.min_by("x", F.when(F.ltrim(low).startswith(head), F.struct("y", "tok_no"))).alias(f"__x_{name}"))
    for row, labels in fixed.SUMMARY_ROWS.items():
        marks.append(F.min_by("y", F.when(contains_any(low, labels), F.col("tok_no"))).alias(f"__y_{row}"))
    marks.append(F.min_by("y", F.when(F.contains(low, F.lit("modification")), F.col("tok_no"))).alias("__y_mod"))
    anchors = tokens.withColumn("__low", F.lower("text")).groupBy(IMAGE).agg(*marks)
    names = [c for c in anchors.columns if c != IMAGE]
    digits = strip("text")
    numbers = lookup(tokens.withColumn("__n", to_int(digits)).filter(digits.rlike(r"^\d{1,5}$")), anchors, [IMAGE], names)
    col = nearest(F.col("x"), [(name, F.col(f"__x_{name}")) for _, name in fixed.SUMMARY_HEADS])
    numbers = numbers.withColumn("__col", col)

    def read(row: str, name: str) -> Column:
        hit = (F.abs(F.col("y") - F.col(f"__y_{row}")) < fixed.SUMMARY_ROW_TOLERANCE) & (F.col("__col") == name)
        return F.max_by("__n", F.when(hit, F.col("tok_no")))

    changed = (F.abs(F.col("y") - F.col("__y_mod")) < fixed.MODIFICATION_REACH) & (F.length(digits) <= 4)
    totals = numbers.groupBy(IMAGE).agg(
        *[read("net", name).alias(name) for _, name in fixed.SUMMARY_HEADS],
        read("add", "net_total").alias("additions_total"),
        read("del", "net_total").alias("deletions_total"),
        F.max(F.when(changed, F.col("__n"))).alias("num_modifications"),
    )
    cols = [c for c in totals.columns if c != IMAGE]
    return lookup(tokens.select(IMAGE).distinct(), totals, [IMAGE], cols)


def elector_table(tokens: DataFrame) -> DataFrame:
    """The count table of a cover: the first number row under its headers, by nearest header."""
    flat, names = F.col("__flat"), [n for options in fixed.COUNT_HEADS.values() for n in options]
    token = F.struct("x", "y", _height().alias("h"))
    named = tokens.withColumn("__flat", F.lower(despace("text"))).filter(flat.isin(names))
    heads = named.groupBy(IMAGE).agg(
        *[F.min_by(token, F.when(flat.isin(*options), F.struct("y", "tok_no"))).alias(f"__h_{c}")
          for c, options in fixed.COUNT_HEADS.items()]
    )
    of = lambda f: [F.col(f"__h_{c}")[f] for c in fixed.COUNT_HEADS]
    heads = heads.select(
        IMAGE, *[F.col(f"__h_{c}.x").alias(f"__x_{c}") for c in fixed.COUNT_HEADS],
        F.greatest(*of("y")).alias("__base"), F.least(*of("h")).alias("__row_h"),
    )
    cols = [c for c in heads.columns if c != IMAGE]
    numbers = lookup(tokens.filter(strip("text").rlike(r"^\d{1,6}$")), heads, [IMAGE], cols)
    in_reach = (F.col("y") > F.col("__base")) & (F.col("y") < F.col("__base") + fixed.COUNT_ROWS * F.col("__row_h"))
    numbers = numbers.filter(in_reach)
    first = numbers.groupBy(IMAGE).agg(F.min("y").alias("__first"))
    row = lookup(numbers, first, [IMAGE], ["__first"]).filter(
        F.abs(F.col("y") - F.col("__first")) < fixed.COUNT_ROW * F.col("__row_h")
    )
    row = row.withColumn("__col", nearest(F.col("x"), [(c, F.col(f"__x_{c}")) for c in fixed.COUNT_HEADS]))
    number = to_int(strip("text"))
    return row.groupBy(IMAGE).agg(
        *[F.min_by(number, F.when(F.col("__col") == c, F.col("tok_no"))).alias(c) for c in fixed.COUNT_HEADS]
    )


def section_list(tokens: DataFrame, heads: DataFrame) -> DataFrame:
    """``{no}-{name}`` tokens under the section header; a page prints a handful of them."""
    near = lookup(tokens, heads, [IMAGE], ["sections_head"])
    h = F.col("sections_head")
    inside = (
        (F.col("y") > h["y"]) & (F.col("y") < h["y"] + fixed.SECTIONS_DOWN * h["h"]) & (F.col("x") < h["x"] + fixed.SECTIONS_RIGHT * h["h"])
    )
    pattern = r"^(\d+)\s*-\s*(.+)"
    text = strip("text")
    rows = near.filter(inside & text.rlike(pattern)).select(
        IMAGE, "tok_no",
        F.struct(to_int(group(text, pattern, 1)).alias("section_no"), strip(group(text, pattern, 2)).alias("section_name"))
        .alias("s"),
    )
    listed = F.array_sort(F.collect_list(F.struct("tok_no", "s")))
    return rows.groupBy(IMAGE).agg(F.transform(listed, lambda t: t["s"]).alias("sections"))


def parse_cover(tokens: DataFrame) -> DataFrame:
    """Cover page: identity, revision, area, station, sections and the count table."""
    lines = find_labels(tokens, fixed.COVER_LINES)
    found = lookup(label_values(tokens, fixed.COVER_RIGHT, fixed.COVER_BELOW), lines, [IMAGE], list(fixed.COVER_LINES))
    found = lookup(found, elector_table(tokens), [IMAGE], list(fixed.COUNT_HEADS))
    found = lookup(found, section_list(tokens, lines), [IMAGE], ["sections"])
    title, ac, pc = values.roll_title("title.text"), values.constituency("ac.text"), values.constituency("pc.text")
    numbered = r"^(\d+)\s*-\s*(.+)"
    first_int = lambda c, p=r"(\d+)": to_int(group(c, p))
    aux = F.coalesce("aux_a", "aux_b")
    out = {
        "state_name": title["state_name"],
        "year_of_revision": F.coalesce(title["year"], first_int("year_of_revision", r"(\d{4})")),
        **{c: F.col(c) for c in ("qualifying_date", "type_of_revision", "date_of_publication", "date_of_updation",
                                 "roll_identification")},
        "ac_no": ac["no"],
        "ac_name": ac["name"],
        "ac_reservation": ac["reservation"],
        "pc_no": pc["no"],
        "pc_name": pc["name"],
        "part_no": first_int(F.substring_index(F.col("part.text"), ":", -1)),
        **{c: F.col(c) for c in ("district_name", "main_town_or_village", "post_office", "police_station",
                                 "tehsil_mandal", "block", "taluk")},
        "pin_code": group(despace("pin_code"), r"(\d{6})"),
        "polling_station_no": to_int(group("station", numbered, 1)),
        "polling_station_name": F.coalesce(strip(group("station", numbered, 2)), F.col("station")),
        "polling_station_address": F.col("polling_station_address"),
        "polling_station_type": F.when(
            F.lower("polling_station_type").rlike("male|female|general"), F.col("polling_station_type")
        ),
        "num_auxiliary_stations": first_int(aux),
        "sections": F.col("sections"),
        **{c: F.col(c) for c in fixed.COUNT_HEADS},
    }
    return found.select(IMAGE, *[c.alias(n) for n, c in out.items()])


def nearest_columns(
    tokens: DataFrame, heads: dict[str, Column], keys: Sequence[str] = (IMAGE,), name: str = "column_name"
) -> DataFrame:
    """Tokens with the name of the column whose header is nearest in x.

    The header of a column is the topmost token its predicate accepts; a group has one row of
    header positions, so each token is compared with a handful of numbers, not with tokens.
    """
    at = tokens.groupBy(*keys).agg(
        *[F.min_by("x", F.when(hit, F.struct("y", "tok_no"))).alias(f"__x_{n}") for n, hit in heads.items()]
    )
    cols = [f"__x_{n}" for n in heads]
    return lookup(tokens, at, keys, cols).withColumn(
        name, nearest(F.col("x"), [(n, F.col(f"__x_{n}")) for n in heads])
    ).drop(*cols)
