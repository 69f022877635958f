"""Raw card reads -> one classified card per (roll, serial)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.functions import cards, values
from snapledger.operators.groupwise import attach, first_by
from snapledger.operators.ordered import carry_forward, positions
from snapledger.session import cut

PAGES_PER_BLOCK, SERIALS_PER_BLOCK = 64, 65_536


def parse_strips(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON payload of a strip -> header and card list. Text that is no JSON is a failed strip;
    a value of the wrong type is only a null field."""
    df = payloads.withColumn("__p", F.from_json(F.col(payload), schemas.STRIP_PAYLOAD))
    empty = F.col("__p.section_header").isNull() & F.col("__p.cards").isNull()
    bad = F.col(payload).isNull() | (empty & F.get_json_object(payload, "$").isNull())
    old = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in payloads.columns else F.lit(False)
    return df.withColumns(
        {"section_header": F.col("__p.section_header"), "cards": F.col("__p.cards"), "failed": old | bad}
    ).drop("__p", payload)


def carry_region(
    strips: DataFrame,
    keys: tuple[str, ...] = ("roll_id",),
    order: tuple[str, ...] = ("page", "band_no"),
    header: str = "section_header",
    failed: str | None = "failed",
    block=None,
) -> DataFrame:
    """Region and supplement of every strip, carried over strips without a header.

    The carried value is a struct, so that a main-roll header also clears the supplement.
    A failed strip neither changes nor ends what is carried.
    """
    named = values.region(header)
    supplement = F.when(named.isin("additions", "deletions"), values.supplement_no(header))
    state = F.struct(named.alias("region"), supplement.alias("supplement_no"))
    ok = named.isNotNull()
    if failed:
        ok = ok & ~F.coalesce(F.col(failed), F.lit(False))
    block = F.floor(F.col(order[0]) / PAGES_PER_BLOCK) if block is None else block
    out = carry_forward(strips, keys, order, F.when(ok, state), block, "__state")
    return out.withColumns(
        {
            "region": F.coalesce(F.col("__state.region"), F.lit("main_roll")),
            "supplement_no": F.col("__state.supplement_no"),
        }
    ).drop("__state")


def band_number(band: str = "band"):
    return F.when(F.col(band) == "top", 0).otherwise(1)


def explode_cards(strips: DataFrame) -> DataFrame:
    """Strips with a region -> one row per card, typed; a bad serial stays as null ``serial_no``."""
    good = strips.filter(~F.coalesce(F.col("failed"), F.lit(False)))
    rows = good.select(
        "roll_id", F.col("page").alias("source_page"), "band_no", "region", "supplement_no",
        F.posexplode("cards").alias("pos", "card"),
    )
    return rows.select(
        "roll_id", "source_page", "band_no", "pos", "region", "supplement_no", *cards.coerced("card")
    )


def split_malformed(cards_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable cards, rejects)."""
    return cards_df.filter("serial_no is not null"), cards_df.filter("serial_no is null")


def best_reads(
    cards_df: DataFrame,
    keys: tuple[str, ...] = ("roll_id", "serial_no"),
    arrival: tuple[str, ...] = ("source_page", "band_no", "pos"),
    score=None,
) -> DataFrame:
    """One read per key: the most complete one, the first to arrive among equals."""
    score = cards.card_completeness() if score is None else score
    return first_by(cards_df, list(keys), [score.desc(), *[F.col(c).asc() for c in arrival]])


def guard_sections(
    cards_df: DataFrame, key: str = "roll_id", serial: str = "serial_no", region: str = "region"
) -> DataFrame:
    """Supplement cards inside the main roll's serial span belong to the main roll.

    The cards are read for the span and for the answer, so they are written once before.
    """
    cards_df = cut(cards_df)
    in_main = F.when(F.col(region) == "main_roll", F.col(serial))
    spanned = attach(cards_df, [key], __main_max=F.max(in_main))
    strayed = F.col(region).isin("additions", "deletions") & (F.col(serial) <= F.col("__main_max"))
    return spanned.withColumn(region, F.when(strayed, "main_roll").otherwise(F.col(region))).drop("__main_max")


def classify(cards_df: DataFrame) -> DataFrame:
    """Status, reason, section and supplement of a card, then its structural flags and confidence."""
    out = cards_df.withColumn("__s", cards.inferred_status())
    section = F.col("section_no") if "section_no" in cards_df.columns else F.lit(None).cast("int")
    out = out.withColumns(
        {
            "status": F.col("__s.status"),
            "deletion_reason_code": F.col("__s.reason"),
            "section_no": F.coalesce("__s.section_no", section),
            "supplement_no": F.coalesce("__s.supplement_no", "supplement_no"),
        }
    ).drop("__s")
    return out.withColumn("flags", cards.flags()).withColumn("confidence", cards.confidence("flags"))


def assemble(cards_df: DataFrame) -> DataFrame:
    """All steps, from typed reads to final cards (unordered; order by roll and serial on output)."""
    cleaned = cards_df.withColumns(cards.normalised())
    return classify(guard_sections(best_reads(cleaned)))


def numbered(electors: DataFrame, key: str = "roll_id", serial: str = "serial_no", name: str = "ordinal") -> DataFrame:
    """Entries with their place in print order, from 1; no task holds a whole roll (serials are printed from 1 on)."""
    return positions(electors, [key], [serial], F.floor(F.col(serial) / SERIALS_PER_BLOCK), name)


def in_order(electors: DataFrame, key: str = "roll_id", serial: str = "serial_no") -> DataFrame:
    """Entries in print order, for output only: a range-partitioned sort, one huge roll spans many tasks."""
    return electors.orderBy(key, serial)
