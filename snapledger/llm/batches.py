"""Arrow batches of text in bounded slices, and words of many texts at once in numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``most`` bytes; one longer row is a run of its own."""
    rows = batch.num_rows
    if batch.nbytes <= most:
        if rows:
            yield batch
        return
    sizes = np.zeros(rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += lengths(column)
        else:
            sizes += column.nbytes // max(1, rows)
    run = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    for start, end in zip(starts, np.append(starts[1:], rows), strict=True):
        yield batch.slice(int(start), int(end - start))


def give_back() -> None:
    """Memory that is free in this worker back to the system, where the C library can: a worker outlives its task and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 for null."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def over_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on bounded slices of ``df``'s Arrow batches."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                yield work(part)

    return df.mapInArrow(run, schema)


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, a null text as the empty one; other columns never clash with results."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column without nulls, and the offset at which each begins (one more than texts)."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1 + column.offset)[column.offset:].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z of UTF-8 bytes as a-z."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """``base`` to the powers 0 to at least ``n``, modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) <= n:
        size = 1 << max(10, int(n).bit_length())
        with np.errstate(over="ignore"):
            known = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]))
        _POWERS[base] = known
    return known


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``data[start:end]``; the runs are in order, none is empty, and gaps are left out."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    if int(sizes.sum()) != len(data):
        keep = np.zeros(len(data) + 1, np.int8)
        keep[starts] += 1
        keep[ends] -= 1
        data = data[np.cumsum(keep[:-1]).astype(bool)]
    place = np.arange(len(data)) - np.repeat(begin, sizes)
    with np.errstate(over="ignore"):
        terms = (data.astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[place]
        return mix(np.add.reduceat(terms, begin) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of other than white space, A-Z lowered) of all texts in order, and the number of words of each text."""
    data, offsets = utf8(column)
    data = lower_ascii(data)
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return hash_runs(data, starts, ends), counts


class Slots:
    """An open-addressing table of 64-bit keys other than 0, for whole arrays at once; callers keep their values by slot."""

    def __init__(self, size: int):
        self.keys = np.zeros(size, np.uint64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(8)).astype(np.int64) & (len(self.keys) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it isn't kept."""
        slot, mask = self._home(keys), len(self.keys) - 1
        kept = self.keys[slot]
        out = np.where(kept == keys, slot, -1)
        open_ = np.flatnonzero((kept != keys) & (kept != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            kept = self.keys[slot[open_]]
            hit = kept == keys[open_]
            out[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (kept != 0)]
        return out

    def insert(self, keys: np.ndarray) -> np.ndarray:
        """The slots given to distinct keys that aren't kept yet."""
        slot, open_, mask = self._home(keys), np.arange(len(keys)), len(self.keys) - 1
        while len(open_):
            at = slot[open_]
            self.keys[at] = np.where(self.keys[at] == 0, keys[open_], self.keys[at])
            open_ = open_[self.keys[at] != keys[open_]]
            slot[open_] = (slot[open_] + 1) & mask
        return slot
