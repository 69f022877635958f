"""Findings in texts: lists of (kind, start, end, score) and the digests that queries derive from them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def found_array(rows: list[list[tuple]]) -> pa.Array:
    """Findings of many texts as an Arrow column."""
    return pa.array([[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in row] for row in rows], _ARROW)


def ordered(found: list[tuple], kinds: tuple[str, ...]) -> list[tuple]:
    """By start, then kind as listed, then end."""
    return sorted(found, key=lambda x: (x[1], kinds.index(x[0]), x[2]))


def count_of(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def scores(found: str, kinds: tuple[str, ...]) -> Column:
    """The scores of the findings of ``kinds``, joined by commas, in the order of ``listed``."""
    own = F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda x: x["score"].cast("string")), ",")


def listed(found: str, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the findings of ``kinds``, joined by commas, in the order of the list."""
    own = F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
