"""Ids of a byte-level BPE tokenizer for many texts at once.

A pre-token never crosses from other characters to white space, so a text may be cut before each run of white space and the
pieces encoded alone. A special token that a text holds literally is one id, as by the tokenizer itself. Pieces recur, so their ids are kept in a bounded table per task; only new ones reach the tokenizer.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa

from snapledger.llm.batches import _SPACE, Slots, give_back, hash_runs, utf8

MOST_PIECES = 1 << 20


class Encoder:
    """Ids by the tokenizer file at ``path``, with at most MOST_PIECES pieces kept (then it begins anew)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)  # in a byte-level vocabulary each character stands for one byte
        self.clear(4 * MOST_PIECES)

    def clear(self, size: int) -> None:
        self.slots = Slots(size)
        self.start, self.size = np.zeros(size, np.int32), np.zeros(size, np.int32)
        self.ids, self.used, self.pieces = np.zeros(1 << 16, np.int32), 0, 0

    def close(self) -> None:
        """Give back the tokenizer and the table; the encoder can't be used any more."""
        self.tokenizer = None
        self.clear(1)
        give_back()

    def _insert(self, hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Distinct hashes that aren't kept yet."""
        slots = self.slots.insert(hashes)
        self.start[slots], self.size[slots] = start, size
        self.pieces += len(hashes)

    def _keep(self, ids: np.ndarray) -> int:
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)])
        self.ids[at:self.used] = ids
        return at

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        """Encode the given distinct pieces: those that begin with white space and end with none in one go."""
        last = data[ends - 1]
        joined = _SPACE[data[starts]] & ~_SPACE[last] & ~_maybe_space(data, ends)
        whole = np.flatnonzero(joined)
        for lo in range(0, len(whole), 20_000):
            part = whole[lo:lo + 20_000]
            text = b"".join(data[s:e].tobytes() for s, e in zip(starts[part], ends[part], strict=True)).decode()
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(ends[part] - starts[part])) + 1
            begin = np.concatenate([[0], cuts[:-1]])
            self._insert(hashes[part], (self._keep(ids) + begin).astype(np.int32), (cuts - begin).astype(np.int32))
        for k in np.flatnonzero(~joined):
            ids = self.tokenizer.encode(data[starts[k]:ends[k]].tobytes().decode(), add_special_tokens=False).ids
            self._insert(hashes[k:k + 1], np.array([self._keep(np.array(ids, np.int32))], np.int32), np.array([len(ids)], np.int32))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and the number of ids of each."""
        data, offsets = utf8(column)
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(texts, np.int64)
        space = _SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1] & ~_maybe_space(data, np.arange(1, len(data)))
        cut[offsets] = True
        at = np.flatnonzero(cut)
        starts, ends = at[:-1], at[1:]
        hashes = hash_runs(data, starts, ends) | np.uint64(1)
        slots = self.slots.find(hashes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            new = new[np.sort(first)]
            if self.pieces and self.pieces + len(new) > MOST_PIECES or 2 * len(new) > len(self.start):
                _, first = np.unique(hashes, return_index=True)
                new = np.sort(first)
                self.clear(max(4 * MOST_PIECES, 1 << (2 * len(new)).bit_length()))  # one text may hold more pieces than are kept
            self._learn(data, starts[new], ends[new], hashes[new])
            slots = self.slots.find(hashes)
        sizes = self.size[slots].astype(np.int64)
        shift = np.repeat(self.start[slots] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        ids = self.ids[shift + np.arange(len(shift))]
        piece_end = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(piece_end[np.searchsorted(starts, offsets)])


def _maybe_space(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place could be white space outside ASCII, judged by its lead byte."""
    tail = data[ends - 1] >= 128
    lead2 = (data[np.maximum(ends - 2, 0)] == 0xC2) & (ends >= 2)
    lead3 = np.isin(data[np.maximum(ends - 3, 0)], np.array([0xE1, 0xE2, 0xE3], np.uint8)) & (ends >= 3)
    return tail & (lead2 | lead3)


@contextmanager
def encoding(path: str) -> Iterator[Encoder]:
    """An encoder for one task. What it holds is given back at the end: the worker lives on, and other work needs the memory."""
    own = Encoder(path)
    try:
        yield own
    finally:
        own.close()
