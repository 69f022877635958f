"""Packing examples into sequences: vector bin packing by the dot-product heuristic.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. Whole sequences are cut off each long example
first. What is left of the examples waits in a window; a sequence takes, again and again, the waiting rest that fits and
whose demand has the largest dot product with what the sequence has left. When none fits, it takes the head of a rest that
fills it. Rests flow through the tasks that tokenize them, so nothing is shuffled and a task holds one window only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import slices
from snapledger.llm.tokens import encoding

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([(name.split()[0], pa.int64()) for name in PIECES.split(", ")])
WINDOW = 2048


class Packer:
    """Pieces of one task: ``add`` examples, then ``close``; rows gather in ``rows``."""

    def __init__(self, first_sequence: int, size: int, segments: int, loss: int):
        self.sequence, self.size, self.segments, self.loss = first_sequence, size, segments, loss
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []
        self.tokens = np.zeros(2 * WINDOW, np.int64)
        self.bearing = np.zeros(2 * WINDOW, np.int64)
        self.count = 0
        self.bin: list[tuple] = []
        self.left = np.array([size, segments, loss], np.int64)

    def _emit(self, pieces: list[tuple]) -> None:
        """One sequence of the pieces (doc, start, ids, tokens of the example, first loss-bearing token)."""
        at = 0
        for doc, start, ids, total, _ in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, at))
            at += len(ids)
        self.sequence += 1

    def add(self, doc: int | None, ids: np.ndarray, bearing_from: int = 0) -> None:
        """``bearing_from``: tokens of the example from this one on bear loss."""
        total, at = len(ids), 0
        while total - at >= self.size and min(self.size, total - max(at, bearing_from)) <= self.loss:
            self._emit([(doc, at, ids[at:at + self.size], total, bearing_from)])
            at += self.size
        while at < total:  # more than one only where the loss limit is under the token limit
            take = min(total - at, self.size, max(bearing_from - at, 0) + self.loss)
            self._wait((doc, at, ids[at:at + take].copy(), total, bearing_from))
            at += take
            if self.count == 2 * WINDOW:
                self._fill(WINDOW)

    def _wait(self, piece: tuple) -> None:
        if len(self.waiting) == self.count:
            self.waiting.append(piece)
        else:
            self.waiting[self.count] = piece
        self.tokens[self.count], self.bearing[self.count] = len(piece[2]), self._bearing(piece)
        self.count += 1

    @staticmethod
    def _bearing(piece: tuple) -> int:
        _, start, ids, _, first = piece
        return max(0, start + len(ids) - max(start, first))

    def _take(self, k: int) -> None:
        """Put a waiting piece into the open sequence; the last one takes its place."""
        self.bin.append(self.waiting[k])
        self.left -= (self.tokens[k], 1, self.bearing[k])
        self.count -= 1
        self.waiting[k], self.tokens[k], self.bearing[k] = self.waiting[self.count], self.tokens[self.count], self.bearing[self.count]

    def _shut(self) -> None:
        self._emit(self.bin)
        self.bin, self.left = [], np.array([self.size, self.segments, self.loss], np.int64)

    def _fill(self, down_to: int) -> None:
        while self.count > down_to:
            tokens, bearing = self.tokens[:self.count], self.bearing[:self.count]
            if not self.left[0] or not self.left[1]:
                self._shut()
                continue
            share = self.left / (self.size, self.segments, self.loss)
            fits = (tokens <= self.left[0]) & (bearing <= self.left[2])
            value = np.where(fits, tokens * (share[0] / self.size) + share[1] / self.segments + bearing * (share[2] / self.loss), -1.0)
            best = int(np.argmax(value))
            if value[best] >= 0:
                self._take(best)
                continue
            k = int(np.argmax(tokens))  # none fits: cut the longest
            doc, start, ids, total, first = self.waiting[k]
            head = int(min(self.left[0], max(first - start, 0) + self.left[2]))
            if head <= 0:
                self._shut()
                continue
            head = min(head, len(ids))
            rest = (doc, start + head, ids[head:], total, first)
            self.waiting[k] = (doc, start, ids[:head], total, first)
            self.tokens[k], self.bearing[k] = head, self._bearing(self.waiting[k])
            self._take(k)
            if len(rest[2]):
                self._wait(rest)

    def close(self) -> None:
        """Place all that waits; the last sequence is cut at powers of two, at which none is padded."""
        self._fill(0)
        last, self.bin = self.bin, []
        length = sum(len(p[2]) for p in last)
        if length == self.size:
            self._emit(last)
            return
        for power in [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]:
            own = []
            while power:
                doc, start, ids, total, first = last.pop(0)
                if len(ids) > power:
                    last.insert(0, (doc, start + power, ids[power:], total, first))
                    ids = ids[:power]
                own.append((doc, start, ids, total, first))
                power -= len(ids)
            self._emit(own)

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) or [()] * len(_SCHEMA)
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], _SCHEMA)


def pack(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", unmasked_col: str | None = None,
    size: int = 1024, segments: int = 256, loss: int | None = None,
) -> DataFrame:
    """Pieces of all examples, each with its place in a sequence.

    ``tokenizer``: path of a byte-level BPE file. An example is its text's ids and then id 0. ``unmasked_col``: the number of
    tokens before the first loss-bearing one (default none); ``loss``: at most so many loss-bearing tokens in a sequence
    (default ``size``). A null or empty text is the id 0 alone; repeated rows are examples of their own; a null id stays
    null; other columns are left out; an empty table gives no pieces. ``sequence_id`` is unique over all tasks and the same
    when a task is run again. All sequences are full but those that close a task, whose lengths are powers of two, and those
    that reach the segment or the loss limit.
    """
    loss = loss or size
    unmasked = F.lit(0) if unmasked_col is None else F.coalesce(F.col(unmasked_col), F.lit(0))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), unmasked.cast("long").alias("unmasked"))

    def run(batches):
        packer = Packer(TaskContext.get().partitionId() << 36, size, segments, loss)
        with encoding(tokenizer) as encoder:
            for batch in batches:
                for part in slices(batch, 2 << 20):
                    ids, counts = encoder.encode(part.column(1))
                    at = 0
                    for doc, count, first in zip(part.column(0).to_pylist(), counts.tolist(), part.column(2).to_pylist(), strict=True):
                        packer.add(doc, np.append(ids[at:at + count], np.int32(0)), first)
                        at += count
                    yield packer.batch()
        packer.close()
        yield packer.batch()

    return rows.mapInArrow(run, PIECES)
