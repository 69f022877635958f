"""Layout tokens -> cards: columns, anchors, card intervals, serial grid.

Input: ``tokens(image_id, tok_no, x, y, x2, y2, text[, engine])``. ``tok_no`` keeps the reading
order of the engine and settles every tie. Interval and nearest joins are never evaluated as
pairs: cards of a column tile it without overlap, so the card of a token is simply the last
anchor at or above it, which is one ordered scan over tokens and anchors together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions import fixed, values
from snapledger.functions.text import after_colon, contains_any, group, strip, strip_label, to_int, without_blanks
from snapledger.operators.groupwise import attach, first_by, lookup
from snapledger.operators.ordered import carry_forward, following, gap_sessions, previous, upper_median
from snapledger.session import cut

IMAGE = "image_id"
ROWS_PER_BLOCK = 4096.0  # pixels of height per scan block; a page is lower, so one block per image


def y_block(y: str = "y", height: float = ROWS_PER_BLOCK) -> Column:
    return F.floor(F.col(y) / F.lit(height))


def columns_of(tokens: DataFrame, parts: int = 3) -> DataFrame:
    """Tokens with ``col`` (0-based equal columns of the image width; the last where there is no width), ``cw`` and ``x0``."""
    sized = attach(tokens, [IMAGE], __width=F.max("x2"))
    cw = F.col("__width") / parts
    return (
        sized.withColumn("cw", cw)
        .withColumn("col", F.least(F.lit(parts - 1), F.floor(F.try_divide("x", "cw")).cast("int")))
        .withColumn("x0", F.col("col") * F.col("cw"))
        .drop("__width")
    )


def anchors_of(tokens: DataFrame, text: str = "text") -> DataFrame:
    """Tokens carrying a document key in the right half of their column; one per card."""
    key = group(without_blanks(text), f"({fixed.KEY_ANYWHERE})")
    return (
        tokens.withColumn("epic_no", key)
        .filter(F.col("epic_no").isNotNull() & (F.col("x") - F.col("x0") > fixed.ANCHOR_SIDE * F.col("cw")))
        .select(IMAGE, "col", F.col("tok_no").alias("anchor"), F.col("y").alias("ay"), "x0", "cw", "epic_no")
    )


def spaced(anchors: DataFrame, block_height: float = ROWS_PER_BLOCK) -> DataFrame:
    """Anchors with ``next_y``, the y of the anchor below in their column (null for the last)."""
    return following(anchors, [IMAGE, "col"], ["ay", "anchor"], y_block("ay", block_height), next_y=F.col("ay"))


def card_heights(anchors: DataFrame, dpi: int = 200, block_height: float = ROWS_PER_BLOCK) -> DataFrame:
    """Per image the upper median of positive gaps between (spaced) anchors of a column, or a default."""
    gaps = anchors.select(IMAGE, (F.col("next_y") - F.col("ay")).alias("gap")).filter("gap > 0")
    median = upper_median(gaps, [IMAGE], "gap", block_height / 16, "card_h")
    default = F.lit(float(round(fixed.CARD_HEIGHT_AT_200_DPI * dpi / 200)))
    images = anchors.select(IMAGE).distinct()
    return lookup(images, median, [IMAGE], ["card_h"]).withColumn("card_h", F.coalesce("card_h", default))


def card_intervals(anchors: DataFrame, heights: DataFrame) -> DataFrame:
    """(Spaced) anchors with their half-open interval [top, bottom) and the image's card height."""
    sized = lookup(anchors, heights, [IMAGE], ["card_h"])
    pad = F.floor(fixed.CARD_PAD * F.col("card_h"))
    return sized.withColumn("top", F.col("ay") - pad).withColumn(
        "bottom", F.coalesce("next_y", F.col("ay") + F.col("card_h")) - pad
    ).drop("next_y")


def tokens_in_cards(
    tokens: DataFrame, cards: DataFrame, share: float = fixed.TEXT_SIDE, block_height: float = ROWS_PER_BLOCK
) -> DataFrame:
    """Tokens in the left ``share`` of their column, with the card whose interval holds them.

    An as-of join: anchors and tokens go through one carry-forward per (image, column), ordered
    by position, anchors before tokens at the same one.
    """
    card = F.struct("anchor", "ay", "top", "bottom", "card_h")
    marks = cards.select(
        IMAGE, "col", F.col("top").alias("pos"), F.lit(0).alias("kind"), F.col("anchor").alias("tok_no"),
        card.alias("card"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"),
        F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("x0"),
        F.lit(None).cast("double").alias("cw"),
    )
    left = tokens.filter((F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x0") + share * F.col("cw")))
    points = left.select(
        IMAGE, "col", F.col("y").alias("pos"), F.lit(1).alias("kind"), "tok_no",
        F.lit(None).cast(marks.schema["card"].dataType).alias("card"), "x", "y", "text", "x0", "cw",
    )
    both = marks.unionByName(points)
    held = carry_forward(
        both, [IMAGE, "col"], ["pos", "kind", "tok_no"], F.col("card"), y_block("pos", block_height), "__card"
    )
    hit = (F.col("kind") == 1) & (F.col("pos") >= F.col("__card.top")) & (F.col("pos") < F.col("__card.bottom"))
    return held.filter(hit).select(
        IMAGE, "col", "tok_no", "x", "y", "text", "x0", "cw", "__card.anchor", "__card.ay", "__card.card_h"
    )


def card_parts(tokens: DataFrame, dpi: int = 200, share: float = fixed.TEXT_SIDE) -> tuple[DataFrame, DataFrame]:
    """(cards with intervals, tokens in cards) of one engine's tokens.

    Anchors, cards and placed tokens are each read several times by what follows, so each is
    written once to the shared folder; this runs jobs.
    """
    placed = columns_of(tokens)
    anchors = cut(spaced(anchors_of(placed)))
    cards = cut(card_intervals(anchors, card_heights(anchors, dpi)))
    return cards, cut(tokens_in_cards(placed, cards, share))


def _last(value: Column, order: Column) -> Column:
    """Value of the last token that gives one."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def serials(held: DataFrame, fused_is_deletion: bool = False) -> DataFrame:
    """Serial and deletion reason on the anchor's line, per card; later tokens overwrite.

    A letter set apart from the digits is a deletion reason. A fused letter is noise for the one
    engine and a reason for the other.
    """
    order = F.struct("tok_no") if fused_is_deletion else F.struct("y", "tok_no")
    near = F.abs(F.col("y") - F.col("ay")) < fixed.SAME_LINE * F.col("card_h")
    text = strip("text")
    numbered = near & text.rlike(fixed.SERIAL_TOKEN)
    apart = F.upper(group(text, r"^([A-Za-z])\s*\d" if fused_is_deletion else r"^([A-Za-z])\s+\d"))
    letter = F.when(numbered & apart.isin(*fixed.REASONS), apart)
    if not fused_is_deletion:
        bare = F.upper(text)
        in_box = near & ~numbered & bare.isin(*fixed.REASONS) & (F.col("x") - F.col("x0") < fixed.SERIAL_BOX * F.col("cw"))
        letter = F.coalesce(letter, F.when(in_box, bare))
    serial = F.when(numbered, to_int(group(text, r"(\d{1,4})")))
    return held.groupBy(IMAGE, "anchor").agg(
        _last(serial, order).alias("serial_no"), _last(letter, order).alias("deletion_reason_code")
    )


def token_roles(held: DataFrame) -> DataFrame:
    """Tokens of a card with the field they open: name, relation, house, age, or null (continuation).

    Noise lines, serials and bare reason letters are dropped.
    """
    low = F.ltrim(F.lower(F.col("text")))
    near = F.abs(F.col("y") - F.col("ay")) < fixed.SAME_LINE * F.col("card_h")
    noise = contains_any(low, fixed.NOISE_ANYWHERE)
    for head in fixed.NOISE_HEADS:
        noise = noise | low.startswith(head)
    serial = near & strip("text").rlike(fixed.SERIAL_TOKEN)
    bare = near & F.upper(strip("text")).isin(*fixed.REASONS) & (F.col("x") - F.col("x0") < fixed.SERIAL_BOX * F.col("cw"))
    relation = F.lit(None).cast("string")
    for head, name in reversed(fixed.RELATION_LABELS):
        relation = F.when(low.startswith(head), name).otherwise(relation)
    role = (
        F.when(low.startswith("name"), "name")
        .when(relation.isNotNull(), "relation")
        .when(low.startswith("house"), "house")
        .when(low.startswith("age") | F.contains(low, F.lit("gender")), "age")
    )
    return held.filter(~(noise | serial | bare)).withColumns(
        {"role": role, "relation_type": F.when(role == "relation", relation)}
    )


def label_fields(held: DataFrame) -> DataFrame:
    """Label state machine per card: a label opens a field, the lines after it continue it.

    A repeated label overwrites; nothing continues an empty field. Token order is (y, tok_no).
    """
    card = [IMAGE, "anchor"]
    roles = token_roles(held)
    upto = Window.partitionBy(*card).orderBy("y", "tok_no").rowsBetween(Window.unboundedPreceding, 0)
    runs = roles.withColumn("run", F.count("role").over(upto)).filter("run > 0")
    line = F.struct("y", "tok_no", F.col("text").alias("t"))
    field = runs.groupBy(*card, "run").agg(
        F.max("role").alias("role"),
        F.max("relation_type").alias("relation_type"),
        F.max(F.when(F.col("role").isNotNull(), F.col("text"))).alias("head"),
        # the lines of one field of one card: they are the value itself
        F.array_sort(F.collect_list(F.when(F.col("role").isNull(), line))).alias("more"),
    )
    base = strip_label("head")
    whole = F.concat_ws(" ", F.array(base), F.transform("more", lambda m: m["t"]))
    field = field.withColumns(
        {
            "value": F.when(base == "", "").otherwise(whole),
            "age": F.when(F.col("role") == "age", values.age_in("head")),
            "gender": F.when(F.col("role") == "age", values.gender_in("head")),
        }
    )
    of = lambda role, c="value": _last(F.when(F.col("role") == role, F.col(c)), F.struct("run"))
    return field.groupBy(*card).agg(
        of("name").alias("full_name"),
        of("relation", "relation_type").alias("relation_type"),
        of("relation").alias("relation_name"),
        of("house").alias("house_number"),
        of("age", "age").alias("age"),
        of("age", "gender").alias("gender"),
    )


def grid_rows(cards: DataFrame, block_height: float = ROWS_PER_BLOCK) -> DataFrame:
    """Cards with ``grid_row``: a gap of half a card height to the card before opens a new row."""
    order = ["ay", "col", "anchor"]
    block = y_block("ay", block_height)
    spaced = previous(cards, [IMAGE], order, block, __prev=F.col("ay"))
    opens = F.col("__prev").isNull() | (F.col("ay") - F.col("__prev") >= fixed.ROW_GAP * F.col("card_h"))
    return gap_sessions(spaced, [IMAGE], order, opens, block, "grid_row").drop("__prev")


def serial_votes(rows: DataFrame) -> DataFrame:
    """Per grid row the bases (serial - column) with most votes, in order of first appearance."""
    voted = rows.filter("serial_no is not null").withColumn("base", F.col("serial_no") - F.col("col"))
    counted = voted.groupBy(IMAGE, "grid_row", "base").agg(
        F.count("*").alias("votes"), F.min(F.struct("ay", "col", "anchor")).alias("seen")
    )
    topped = counted.groupBy(IMAGE, "grid_row").agg(F.max("votes").alias("top"))
    best = lookup(counted, topped, [IMAGE, "grid_row"], ["top"]).filter("votes = top")
    return best.groupBy(IMAGE, "grid_row").agg(  # the tied bases of one row
        F.transform(F.array_sort(F.collect_list(F.struct("seen", "base"))), lambda w: w["base"]).alias("winners")
    )


#: Links that one step composes.
LINKS = 64


def _through(step: int):
    """What a link makes of the base before it: its option nearest to the expected one, the first of equals, decides."""
    def through(state, link):
        expected = state["b"] + (step * (link["r"] - state["r"])).cast("int")
        near = F.array_min(F.transform(link["options"], lambda o, i: F.struct(F.abs(o - expected).alias("d"), i.alias("i"))))
        return F.get(link["outs"], near["i"])

    return through


def fold_rows(rows: DataFrame, keys: list[str], step: int) -> DataFrame:
    """Base ``b`` of each row (``keys``, ``at``, ``options``): of its options the one nearest to the base before + step for each row since.

    ``at`` counts from 0 or more; the first row of a key has one option. A run of rows is a function: it maps the option that
    its first row takes to the base of its last. Such functions compose, so LINKS rows become one link, LINKS links the next,
    up to one link per key; then the bases that come in are handed down again. No list is longer than LINKS, and the number
    of rounds is the logarithm of the longest key.
    """
    state = "struct<r:bigint,b:int>"
    through = _through(step)
    outs = F.transform("options", lambda o: F.struct(F.col("at").cast("bigint").alias("r"), o.cast("int").alias("b")))
    link = F.struct(F.col("at").cast("bigint").alias("r"), F.transform("options", lambda o: o.cast("int")).alias("options"), outs.alias("outs"))
    levels = [cut(rows.select(*keys, F.col("at").cast("bigint").alias("at"), link.alias("link")))]
    groups = []
    last = levels[0].agg(F.max("at")).first()[0] or 0
    while last > 0:
        group = levels[-1].groupBy(*keys, F.floor(F.col("at") / LINKS).alias("at")).agg(F.array_sort(F.collect_list(F.struct("at", "link"))).alias("links"))
        group = cut(group.withColumn("links", F.transform("links", lambda x: F.struct(x["link"]["r"].alias("r"), x["link"]["options"].alias("options"),
                                                                                         x["link"]["outs"].alias("outs"), x["at"].alias("at")))))
        rest = F.slice("links", 2, LINKS)
        whole = F.transform(F.get("links", F.lit(0))["outs"], lambda out: F.aggregate(rest, out, through))
        first = F.get("links", F.lit(0))
        groups.append(group)
        levels.append(cut(group.select(*keys, "at", F.struct(first["r"].alias("r"), first["options"].alias("options"), whole.alias("outs")).alias("link"))))
        last //= LINKS
    entering = levels[-1].select(*keys, "at", F.lit(None).cast(state).alias("before"))
    for group in reversed(groups):
        both = group.join(entering, [*keys, "at"])
        start = F.struct(F.array().cast(f"array<struct<at:bigint,before:{state}>>").alias("done"), F.col("before").alias("state"))
        walked = F.aggregate("links", start, lambda acc, x: F.struct(
            F.concat(acc["done"], F.array(F.struct(x["at"].alias("at"), acc["state"].alias("before")))).alias("done"), through(acc["state"], x).alias("state")))
        entering = both.select(*keys, F.inline(walked["done"]))
    settled = levels[0].join(entering, [*keys, "at"])
    return settled.select(*keys, "at", through(F.col("before"), F.col("link"))["b"].alias("b"))


def serial_bases(rows: DataFrame, step: int = 3, rows_per_block: int = 1024) -> DataFrame:
    """Base of every grid row: the majority, else on a tie the one nearest to the row before + step.

    The first row of an image that has votes takes its first winner. A row without votes continues
    its predecessor. Rows before the first vote have no base.
    """
    votes = cut(serial_votes(rows))
    all_rows = rows.select(IMAGE, "grid_row").distinct()
    image_block = F.floor(F.col("grid_row") / rows_per_block)
    firsts = votes.groupBy(IMAGE).agg(F.min("grid_row").alias("__first"))
    voted = lookup(votes, firsts, [IMAGE], ["__first"])
    options = F.when(F.col("grid_row") == F.col("__first"), F.slice("winners", 1, 1)).otherwise(F.col("winners"))
    folded = fold_rows(voted.select(IMAGE, F.col("grid_row").alias("at"), options.alias("options")), [IMAGE], step)
    known = folded.select(IMAGE, F.col("at").alias("grid_row"), "b")
    anchored = lookup(all_rows, known, [IMAGE, "grid_row"], ["b"])
    last = F.when(F.col("b").isNotNull(), F.struct(F.col("grid_row").alias("r"), "b"))
    carried = carry_forward(anchored, [IMAGE], ["grid_row"], last, image_block, "__k")
    base = F.col("__k.b") + (step * (F.col("grid_row") - F.col("__k.r"))).cast("int")
    return carried.select(IMAGE, "grid_row", base.alias("base"))


def vote_serials(cards: DataFrame, block_height: float = ROWS_PER_BLOCK) -> DataFrame:
    """Cards whose serials are corrected by the grid; cards that stay without one are dropped."""
    rows = cut(grid_rows(cut(cards), block_height))
    based = lookup(rows, serial_bases(rows), [IMAGE, "grid_row"], ["base"])
    voted = F.when(F.col("base").isNotNull(), F.col("base") + F.col("col")).otherwise(F.col("serial_no"))
    return based.withColumn("serial_no", voted).filter("serial_no is not null").drop("base")


def section_headers(tokens: DataFrame) -> DataFrame:
    """Topmost section header of each image ('' where there is none)."""
    flat = without_blanks(F.lower(F.col("text")))
    header = flat.startswith(fixed.SECTION_HEAD) | contains_any(flat, fixed.SECTION_LISTS)
    top = F.min_by("text", F.when(header, F.struct("y", "tok_no")))
    return tokens.groupBy(IMAGE).agg(F.coalesce(top, F.lit("")).alias("section_header"))


def parse_cards(tokens: DataFrame, fixes: DataFrame | None = None, dpi: int = 200) -> DataFrame:
    """Card rows of every image. ``fixes``: re-read fields of deleted cards, by image and key."""
    cards, held = card_parts(tokens, dpi)
    keys = [IMAGE, "anchor"]
    fields = ["full_name", "relation_type", "relation_name", "house_number", "gender"]
    rows = lookup(cards, serials(held), keys, ["serial_no", "deletion_reason_code"])
    rows = lookup(rows, label_fields(held), keys, [*fields, "age"])
    rows = rows.withColumns(
        {
            **{f: F.coalesce(f, F.lit("")) for f in fields},
            "deleted_watermark": F.col("deletion_reason_code").isNotNull(),
            "deletion_reason_code": F.coalesce("deletion_reason_code", F.lit("")),
        }
    ).withColumn("marker_box", F.col("deletion_reason_code"))
    if fixes is not None:
        from snapledger.operators.resolve import override

        reread = override(
            rows.filter("deleted_watermark"), fixes, [IMAGE, "epic_no"],
            ["full_name", "relation_type", "relation_name", "house_number"],
        )
        rows = rows.filter("not deleted_watermark").unionByName(reread)
    return vote_serials(rows).select(
        IMAGE, "serial_no", "marker_box", "epic_no", "full_name", "relation_type", "relation_name", "house_number",
        "age", "gender", "deleted_watermark", "deletion_reason_code", "col", F.col("ay").alias("y"),
    )


def parse_script_cards(tokens: DataFrame, latin: str = "latin", script: str = "script", dpi: int = 200) -> DataFrame:
    """Two engines over one image: digits and keys from ``latin``, names and labels from ``script``."""
    cards, held = card_parts(tokens.filter(F.col("engine") == latin), dpi)
    text = strip("text")
    number = to_int(group(text, r"(\d{1,3})"))
    labelled = F.contains(F.col("text"), F.lit(fixed.SCRIPT_AGE))
    plain = ~labelled & number.between(10, 120) & (F.col("y") > F.col("ay") + fixed.SCRIPT_AGE_BELOW * F.col("card_h"))
    ages = held.groupBy(IMAGE, "anchor").agg(
        F.coalesce(
            _last(F.when(labelled, number), F.struct("tok_no")),
            F.min_by(F.when(plain, number), F.when(plain, F.struct("tok_no"))),
        ).alias("age")
    )
    # script tokens are placed in the columns and cards of the latin engine
    width = tokens.filter(F.col("engine") == latin).groupBy(IMAGE).agg((F.max("x2") / 3).alias("cw"))
    native = lookup(tokens.filter(F.col("engine") == script), width, [IMAGE], ["cw"])
    native = native.filter("cw is not null").withColumn(
        "col", F.least(F.lit(2), F.floor(F.try_divide("x", "cw")).cast("int"))
    ).withColumn("x0", F.col("col") * F.col("cw"))
    lines = tokens_in_cards(native, cards, fixed.SCRIPT_TEXT_SIDE)
    order = F.struct("y", "tok_no")

    value = after_colon("text")
    relation = F.lit(None).cast("string")
    for word, name in reversed(fixed.SCRIPT_RELATION):
        relation = F.when(F.contains(F.col("text"), F.lit(word)), name).otherwise(relation)
    gender = F.lit(None).cast("string")
    for word, name in fixed.SCRIPT_GENDER:
        gender = F.when(F.contains(F.col("text"), F.lit(word)), name).otherwise(gender)
    name = F.when(contains_any("text", fixed.SCRIPT_NAME) & (value != ""), value)
    fields = lines.groupBy(IMAGE, "anchor").agg(
        F.min_by(name, F.when(name.isNotNull(), order)).alias("full_name"),
        _last(relation, order).alias("relation_type"),
        _last(F.when(relation.isNotNull(), value), order).alias("relation_name"),
        _last(F.when(contains_any("text", fixed.SCRIPT_HOUSE), value), order).alias("house_number"),
        _last(gender, order).alias("gender"),
    )
    keys = [IMAGE, "anchor"]
    names = ["full_name", "relation_type", "relation_name", "house_number", "gender"]
    rows = lookup(cards, serials(held, fused_is_deletion=True), keys, ["serial_no", "deletion_reason_code"])
    rows = lookup(lookup(rows, ages, keys, ["age"]), fields, keys, names)
    return rows.filter("serial_no is not null").select(
        IMAGE, "serial_no", F.lit("").alias("marker_box"), "epic_no",
        *[F.coalesce(f, F.lit("")).alias(f) for f in names], "age",
        F.col("deletion_reason_code").isNotNull().alias("deleted_watermark"),
        F.coalesce("deletion_reason_code", F.lit("")).alias("deletion_reason_code"), "col", F.col("ay").alias("y"),
    )


def strips_of(tokens: DataFrame, pages: DataFrame) -> DataFrame:
    """Strip rows with their section headers. ``pages``: image_id, roll_id, page, band[, failed]."""
    out = lookup(pages, section_headers(tokens), [IMAGE], ["section_header"])
    return out.withColumn("section_header", F.coalesce("section_header", F.lit("")))


def cards_in_strips(cards: DataFrame, strips: DataFrame) -> DataFrame:
    """Parsed cards with the roll, page, region and supplement of their strip, as assembly reads them."""
    place = ["roll_id", "page", "band_no", "region", "supplement_no"]
    out = cards.join(strips.select(IMAGE, *place), IMAGE)
    blank = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    return out.select(
        "roll_id", F.col("page").alias("source_page"), "band_no", F.struct("y", "col").alias("pos"), "region",
        "supplement_no", "serial_no", "epic_no", "full_name", blank("relation_type"), blank("relation_name"),
        blank("house_number"), F.nullif("age", F.lit(0)).alias("age"), blank("gender"), blank("marker_box"),
        "deleted_watermark", blank("deletion_reason_code"),
    )
