"""Rows by whether their key stands in a list, without shuffling most rows: a Bloom filter of the list goes before the exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.storage import stored

#: Bits of a filter for each key of the list, and of the whole filter at most: 8 MB are sent to the tasks, however long the list is.
EACH, MOST = 16, 1 << 26
#: Bits of one row of a filter, as the bitmap functions have them.
BUCKET = 32_768


def _place(key: Column, bits: int) -> Column:
    """1 to ``bits``; null keys have a place too."""
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(bits).cast("long")) + 1


def divided(rows: DataFrame, key: str, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` may stand in the only column of ``listed`` (written; long), and those whose key surely doesn't.

    No row is in both or in neither. An exact join on the former settles the rest; a list too long for the filter sends more
    rows there, never fewer. Nulls count as a key.
    """
    bits = min(MOST, max(BUCKET, EACH * listed.count()))
    place = _place(F.col(listed.columns[0]), bits)
    placed = listed.select(F.bitmap_bucket_number(place).alias("filter_bucket"), F.bitmap_bit_position(place).alias("position"))
    marks = F.broadcast(stored(placed.groupBy("filter_bucket").agg(F.bitmap_construct_agg("position").alias("filter_bits"))))
    own = _place(F.col(key), bits)
    position = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substr("filter_bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = (F.bitmap_bucket_number(own) == F.col("filter_bucket")) & (F.getbit(byte, (position % 8).cast("int")) == 1)
    return rows.join(marks, marked, "left_semi"), rows.join(marks, marked, "left_anti")


def listed_only(rows: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """The rows whose ``key`` stands in the only column of ``listed`` (written; long, no nulls)."""
    maybe, _ = divided(rows, key, listed)
    return maybe.join(listed.toDF("listed_key"), F.col(key) == F.col("listed_key"), "left_semi")
