"""Sets of word shingles as 64-bit hashes, and their b-bit MinHash signatures, for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from snapledger.llm.batches import mix, words


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, sorted within each, and their number for each text.

    A text of fewer words than ``width`` has its whole sequence as one shingle; a text without words has none.
    """
    word, counts = words(column)
    ends = np.cumsum(counts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    texts = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(word)) - np.repeat(ends - counts, counts)
    value = np.zeros(max(0, len(word) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word[j:j + len(value)])
        full = np.flatnonzero(place[:len(value)] + width <= counts[texts[:len(value)]])
        owner, shingle = texts[full], value[full]
        if len(short):
            extra = []
            for k in short.tolist():
                one = np.uint64(counts[k])
                for w in word[ends[k] - counts[k]:ends[k]]:
                    one = mix(one * np.uint64(0x9E3779B97F4A7C15) + w[None])[0]
                extra.append(one)
            owner, shingle = np.concatenate([owner, short]), np.concatenate([shingle, np.array(extra, np.uint64)])
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    owner, shingle = owner[new], shingle[new]
    return shingle, np.bincount(owner, minlength=len(counts))


def signatures(shingle: np.ndarray, counts: np.ndarray, symbols: int) -> np.ndarray:
    """For each non-empty set, ``symbols`` bytes: the low 8 bits of the smallest shingle under as many hash functions."""
    own = np.flatnonzero(counts)
    out = np.zeros((len(counts), symbols), np.uint8)
    if not len(own):
        return out
    starts = (np.cumsum(counts) - counts)[own]
    seeds = mix(np.arange(1, symbols + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        for k in range(symbols):
            least = np.minimum.reduceat((shingle ^ seeds[k]) * (seeds[k] | np.uint64(1)) ^ (shingle >> np.uint64(k % 23 + 7)), starts)
            out[own, k] = mix(least) & np.uint64(255)
    return out
