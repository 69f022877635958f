"""Alignment of two tokenizers over the same bytes, and how many documents hold each linked pair of ids.

Both tokenizers cut a text before white space that follows other characters, so it falls into segments whose tokens, groups
and links depend on the segment alone. Segments recur; each worker keeps what it found of them in a bounded table.

An id of A and the id of B with the same bytes are an identity pair. They are looked up in an array made from the two
vocabularies and counted in a vector as long as A's vocabulary. Only the other pairs, which come from irregular groups, are
shuffled: each block of texts sends each of them once, with the number of its documents.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import _SPACE, SLICE_BYTES, Slots, hash_runs, slices, utf8
from snapledger.llm.storage import stored
from snapledger.llm.tokens import _maybe_space

MOST_SEGMENTS = 1 << 18
LEARNED_AT_ONCE = 20_000
_SIZES = ("n_a", "n_b", "n_groups", "n_links")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others moved up from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(moved)}


class Aligner:
    """Tokens, groups and links of segments by the tokenizer files at ``path_a`` (byte-level BPE) and ``path_b`` (pieces)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet, vocabulary = byte_alphabet(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(alphabet[c] for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        special = [self.b.is_control(k) or self.b.is_unknown(k) for k in range(len(pieces))]
        self.b_bytes = [b"" if odd else bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
                        for k, (p, odd) in enumerate(zip(pieces, special, strict=True))]
        self.a_size, self.b_size = (np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        named = {x: k for k, x in enumerate(self.b_bytes) if x and self.b.is_byte(k)} | {x: k for k, x in enumerate(self.b_bytes) if x and not self.b.is_byte(k)}
        self.same = np.array([named.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        # white space that no piece of B holds behind another character: before it both tokenizers cut
        behind = {after for p in self.b_bytes for before, after in zip(p, p[1:]) if after != 32 or before != 32}
        self.cuts = _SPACE & ~np.isin(np.arange(256), list(behind))
        self.clear(MOST_SEGMENTS)

    def clear(self, most: int) -> None:
        self.most, self.used = most, 0
        self.slots = Slots(1 << (4 * most - 1).bit_length())
        self.number = np.zeros(len(self.slots.keys), np.int32)
        self.good = np.zeros(most, bool)
        self.sizes = np.zeros((most, 4), np.int64)
        self.first, self.links = np.zeros(most + 1, np.int64), np.zeros((1 << 16, 3), np.int64)
        self.spelled: list[bytes] = []

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and of B of segments joined; an ``a`` before them takes the space that B adds."""
        a = np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode("a" + text, num_threads=1), np.int64)
        return a, b[np.searchsorted(np.cumsum(self.b_size[b]), 2) + 1:]

    def _learn(self, parts: list[bytes]) -> None:
        """Keep segments that follow one another: their groups end where tokens of both end."""
        whole = b"".join(parts)
        a, b = self._ids(whole.decode())
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != whole or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != whole:
            if len(parts) > 1:
                for part in parts:
                    self._learn([part])
            else:
                self._keep(np.zeros((1, 4), np.int64), np.zeros((0, 3), np.int64), np.zeros(1, np.int64), [b""], False)
            return
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cut = np.intersect1d(a_end, b_end, assume_unique=True)
        a_to, b_to = np.searchsorted(a_end, cut) + 1, np.searchsorted(b_end, cut) + 1
        a_n, b_n = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        end = np.searchsorted(cut, np.cumsum([len(p) for p in parts])) + 1  # groups up to each segment's end
        begin = np.concatenate([[0], end[:-1]])
        total = np.cumsum(np.column_stack([a_n, b_n, np.ones(len(cut), np.int64), a_n * b_n]), axis=0)
        sizes = np.diff(np.concatenate([np.zeros((1, 4), np.int64), total])[np.concatenate([[0], end])], axis=0)
        # a group's pairs of ids with how often both meet: the distinct ids of each side by their counts
        groups = np.arange(len(cut))
        width = np.int64(max(len(self.a_bytes), len(self.b_bytes)))
        a_key, a_often = np.unique(np.repeat(groups, a_n) * width + a, return_counts=True)
        b_key, b_often = np.unique(np.repeat(groups, b_n) * width + b, return_counts=True)
        a_group, b_group = a_key // width, b_key // width
        b_first, b_many = np.searchsorted(b_group, groups), np.bincount(b_group, minlength=len(cut))
        many = b_many[a_group]
        left = np.repeat(np.arange(len(a_key)), many)
        right = np.repeat(b_first[a_group] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
        links = np.column_stack([a_key[left] % width, b_key[right] % width, a_often[left] * b_often[right]])
        ends = np.searchsorted(a_group[left], end)
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        lo = zip([0, *a_to[:-1].tolist()], a_to.tolist(), [0, *b_to[:-1].tolist()], b_to.tolist(), strict=True)
        text = [",".join(a_text[i:j]) + "|" + ",".join(b_text[k:m]) for i, j, k, m in lo]
        self._keep(sizes, links, ends, [";".join(text[i:j]).encode() for i, j in zip(begin.tolist(), end.tolist(), strict=True)], True)

    def _keep(self, sizes, links, ends, spelled, good: bool) -> None:
        n, held = len(sizes), int(self.first[self.used])
        if held + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros((max(len(self.links), len(links)), 3), np.int64)])
        self.links[held:held + len(links)] = links
        self.first[self.used + 1:self.used + n + 1] = held + ends
        self.sizes[self.used:self.used + n], self.good[self.used:self.used + n] = sizes, good
        self.spelled += spelled
        self.used += n

    def segments(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the segments of all texts (none is empty) in order, and how many each text has."""
        data, offsets = utf8(column)
        space = _SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = self.cuts[data[1:]] & ~space[:-1]
        at = np.flatnonzero(cut)
        cut[at[_maybe_space(data, at)]] = False
        cut[offsets] = True
        at = np.flatnonzero(cut)
        starts, ends = at[:-1], at[1:]
        hashes = np.concatenate([hash_runs(data[starts[k]:ends[m - 1]], starts[k:m] - starts[k], ends[k:m] - starts[k]) for k, m in _windows(starts, ends)]) | np.uint64(1)
        slot = self.slots.find(hashes)
        new = np.flatnonzero(slot < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            new = new[np.sort(first)]
            if self.used + len(new) > self.most:
                _, first = np.unique(hashes, return_index=True)
                new = np.sort(first)
                self.clear(max(MOST_SEGMENTS, len(new)))  # one slice of texts may hold more than are kept
            tail = data[ends[new] - 1]
            apart = _SPACE[tail] | _maybe_space(data, ends[new])
            order = np.concatenate([new[~apart], new[apart]])
            together = int((~apart).sum())
            for lo, hi in [*((k, min(k + LEARNED_AT_ONCE, together)) for k in range(0, together, LEARNED_AT_ONCE)), *((k, k + 1) for k in range(together, len(order)))]:
                self._learn([data[starts[k]:ends[k]].tobytes() for k in order[lo:hi]])
            self.number[self.slots.insert(hashes[order])] = np.arange(self.used - len(order), self.used)
            slot = self.slots.find(hashes)
        return self.number[slot], np.diff(np.searchsorted(starts, offsets))


def _windows(starts: np.ndarray, ends: np.ndarray):
    """Runs of segments of about SLICE_BYTES, so that a very long text is hashed in parts."""
    run = (ends - starts[0]) // SLICE_BYTES
    edges = np.concatenate([[0], np.flatnonzero(run[1:] != run[:-1]) + 1, [len(starts)]])
    return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of the two files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as their lowest bytes, then their second ones and so on; mostly zeros at the end."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_FIRST = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, often binary, a long, b long, docs long"
_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: int, **columns) -> pa.RecordBatch:
    """The given columns of _FIRST; the others are null."""
    fields = [x.split() for x in _FIRST.split(", ")]
    return pa.record_batch([pa.array(columns[n], _TYPES[t]) if n in columns else pa.nulls(rows, _TYPES[t]) for n, t in fields], [n for n, _ in fields])


def _linked(path_a: str, path_b: str):
    """Rows of three kinds: documents with their pairs, pairs of a block with a count, identity pairs (no block) with a count."""
    def work(batches):
        own = aligner(path_a, path_b)
        identity = np.zeros(len(own.a_bytes), np.int64)
        block = (TaskContext.get().partitionId()) << 32
        for batch in batches:
            for part in slices(batch):
                yield from block_rows(own, part, block, identity)
                block += 1
        held = np.flatnonzero(identity)
        yield _batch(len(held), a=held, docs=identity[held])

    return work


def block_rows(own: Aligner, part: pa.RecordBatch, block: int, identity: np.ndarray):
    """The documents of one slice (doc_id, text behind a space or null) and its irregular pairs; adds to ``identity``."""
    texts = part.column(1)
    given = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
    sizes, spelled = np.zeros((part.num_rows, 4), np.int64), [""] * part.num_rows
    pairs, often = [b""] * part.num_rows, [b""] * part.num_rows
    vocabulary = len(own.a_bytes)
    if len(given):
        segment, counts = own.segments(texts.drop_null())
        text = np.repeat(np.arange(len(given)), counts)
        bad = np.zeros(len(given), bool)
        bad[text[~own.good[segment]]] = True
        ends = np.cumsum(counts)
        for k in np.flatnonzero(~bad).tolist():
            mine = segment[ends[k] - counts[k]:ends[k]]
            sizes[given[k]] = own.sizes[mine].sum(axis=0)
            spelled[given[k]] = hashlib.sha256(b";".join(map(own.spelled.__getitem__, mine.tolist()))).hexdigest()
        use = ~bad[text]
        most = np.int64(own.used + 1)
        key, times = np.unique(text[use] * most + segment[use], return_counts=True)
        text, segment = key // most, key % most
        many = own.first[segment + 1] - own.first[segment]
        at = np.repeat(own.first[segment] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
        text, a, b, weight = np.repeat(text, many), own.links[at, 0], own.links[at, 1], own.links[at, 2] * np.repeat(times, many)
        plain = own.same[a] == b
        irregular, place = np.unique(a[~plain] << 32 | b[~plain], return_inverse=True)
        code = a.copy()
        code[~plain] = vocabulary + place
        key, place = np.unique(text << 40 | code, return_inverse=True)
        weight = np.bincount(place, weights=weight, minlength=len(key)).astype(np.int64)
        text, code = key >> 40, key & ((1 << 40) - 1)
        identity += np.bincount(code[code < vocabulary], minlength=vocabulary)
        edge = np.searchsorted(text, np.arange(len(given) + 1))
        for k, (lo, hi) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            pairs[given[k]], often[given[k]] = _planes(np.diff(code[lo:hi], prepend=0)), _planes(weight[lo:hi])
        docs = np.bincount(code[code >= vocabulary] - vocabulary, minlength=len(irregular))
        yield _batch(len(irregular), block=np.full(len(irregular), block), a=irregular >> 32, b=irregular & 0xFFFFFFFF, docs=docs)
    yield _batch(part.num_rows, block=np.full(part.num_rows, block), doc_id=part.column(0), groups_sha256=spelled, pairs=pairs, often=often, **{n: sizes[:, k] for k, n in enumerate(_SIZES)})


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(identity: np.ndarray, highest: np.ndarray):
    """The documents of a block with the counts of their pairs; ``highest`` has the largest count of each id of A."""
    def work(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        a, b, n = (pairs.column(c).to_numpy() for c in ("a", "b", "n"))
        order = np.lexsort((b, a))
        count = np.concatenate([identity, n[order]])
        best = np.concatenate([identity == highest, n[order] == highest[a[order]]])
        sums = np.zeros((docs.num_rows, 2), np.int64)
        for k, (codes, often) in enumerate(zip(docs.column("pairs").to_pylist(), docs.column("often").to_pylist(), strict=True)):
            if codes:
                code, times = np.cumsum(_numbers(codes)), _numbers(often)
                sums[k] = times[best[code]].sum(), (times * count[code]).sum()
        own = docs.select(["doc_id", *_SIZES]).append_column("n_best", pa.array(sums[:, 0])).append_column("count_sum", pa.array(sums[:, 1]))
        return own.append_column("groups_sha256", docs.column("groups_sha256"))

    return work


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Tokens, groups and links are those of a space and the text; a pair of ids counts once for each row that links it, repeated
    rows each. A null or empty text, or one that a tokenizer doesn't give back byte by byte (B's space sign as a character),
    has no tokens: zeros and an empty hash. Other columns are left out; an empty table gives no rows.

    Blocks are slices of about 4 MB of text, so tasks are bounded by bytes and a pair that all documents hold is one row a
    block. The identity counts and the highest count of each id of A come through the driver: two vectors of A's vocabulary.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.when(F.length(text_col) > 0, F.concat(F.lit(" "), F.col(text_col).cast("string"))).alias("text"))
    found = stored(rows.mapInArrow(_linked(path_a, path_b), _FIRST))
    vocabulary = len(aligner(path_a, path_b).a_bytes)
    identity, highest = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
    for a, n in found.where("block is null").groupBy("a").agg(F.sum("docs")).toLocalIterator():
        identity[a] = highest[a] = n
    pairs = found.where("block is not null and a is not null")
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("docs").alias("n")))
    for a, n in counts.groupBy("a").agg(F.max("n")).toLocalIterator():
        highest[a] = max(highest[a], n)
    counted = pairs.select("block", "a", "b").join(counts, ["a", "b"]).select(F.col("block").alias("of"), "a", "b", "n")
    docs = found.where("block is not null and a is null").select("block", "doc_id", *_SIZES, "groups_sha256", "pairs", "often")
    return docs.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(_scored(identity, highest), OUT)
