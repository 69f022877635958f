"""One document batch end to end: payloads -> cards -> assembled entries -> checks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions import values
from snapledger.operators import assemble, layout, quality, reconcile
from snapledger.operators.groupwise import lookup
from snapledger.session import cut


class RollBatch(NamedTuple):
    context: DataFrame
    electors: DataFrame
    summary: DataFrame
    recon: DataFrame
    rejected: DataFrame
    failed: DataFrame


def with_context(files: DataFrame, name: str = "source_pdf_filename") -> DataFrame:
    """Documents with what their file name says."""
    return files.select("*", *values.file_context(name))


def enrich_context(context: DataFrame, cover: DataFrame) -> DataFrame:
    """Area and part from the cover, only where the file name gave none."""
    side = cover.withColumnsRenamed({"ac_no": "__ac", "part_no": "__part"})
    out = lookup(context, side, ["roll_id"], ["__ac", "__part"])
    return out.withColumns(
        {
            "ac_no": F.coalesce("ac_no", F.nullif("__ac", F.lit(0))),
            "part_no": F.coalesce("part_no", F.nullif("__part", F.lit(0))),
        }
    ).drop("__ac", "__part")


def enrich_summary(summary: DataFrame, cover: DataFrame) -> DataFrame:
    """Last serial from the cover, unless it is zero or absent."""
    side = cover.withColumnRenamed("ending_serial_no", "__end")
    out = lookup(summary.drop("ending_serial_no"), side, ["roll_id"], ["__end"])
    return out.withColumn("ending_serial_no", F.nullif("__end", F.lit(0))).drop("__end")


def first_voter_pages(strips: DataFrame, pages: int | None) -> DataFrame:
    """Only the first ``pages`` voter pages (they start at page 3); None keeps all."""
    return strips if pages is None else strips.filter(F.col("page") < 3 + pages)


def run_rolls(
    context: DataFrame, payloads: DataFrame, summary: DataFrame, cover: DataFrame | None = None,
    max_voter_pages: int | None = None,
) -> RollBatch:
    """One plan for any number of documents at once.

    Typed cards and assembled entries are each written once to the shared folder: every later
    step reads them, and none parses or assembles again. ``payloads``: roll_id, page, band, payload (JSON text of a strip). A strip that cannot be
    read is listed in ``failed``; a card without a usable serial goes to ``rejected``.
    """
    strips = assemble.parse_strips(first_voter_pages(payloads, max_voter_pages))
    strips = strips.withColumn("band_no", assemble.band_number())
    tagged = assemble.carry_region(strips, order=("page", "band_no"))
    return _finish(context, strips, cut(assemble.explode_cards(tagged)), summary, cover)


def run_tokens(
    context: DataFrame, tokens: DataFrame, pages: DataFrame, summary: DataFrame, cover: DataFrame | None = None,
    max_voter_pages: int | None = None, dpi: int = 200,
) -> RollBatch:
    """The same from layout tokens. ``pages``: image_id, roll_id, page, band of the voter strips."""
    wanted = first_voter_pages(pages, max_voter_pages)
    kept = tokens.join(wanted.select("image_id"), "image_id", "left_semi")
    strips = layout.strips_of(kept, wanted).withColumn("band_no", assemble.band_number())
    if "failed" not in strips.columns:
        strips = strips.withColumn("failed", F.lit(False))
    tagged = assemble.carry_region(strips, order=("page", "band_no"))
    cards = cut(layout.cards_in_strips(layout.parse_cards(kept, dpi=dpi), tagged))
    return _finish(context, strips, cards, summary, cover)


def _finish(context, strips, cards, summary, cover) -> RollBatch:
    usable, rejected = assemble.split_malformed(cards)
    electors = cut(assemble.assemble(usable))
    if cover is not None:
        context, summary = enrich_context(context, cover), enrich_summary(summary, cover)
    recon = reconcile.reconcile(context, electors, summary)
    return RollBatch(context, electors, summary, recon, rejected, quality.failed_strips(strips))
