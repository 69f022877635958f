"""Repeated passages by relative Lempel-Ziv parsing against an index of all blocks of documents.

A document's windows of WINDOW words fall into phrases: the runs of windows that share the same smallest hashed sequence of
ANCHOR words. Equal windows have equal anchors, wherever they stand. The index holds, for each anchor in each block of
documents, its phrase and the first document of it. A document is parsed greedily against the index of every block: its
factors are the longest runs of windows that are copied from one earlier document, phrase by phrase. Where a phrase isn't
found whole, since its anchor also stands in other phrases, a factor begins or ends within it; its windows are then looked up
one by one. So no window that stands earlier is missed, and only windows at the borders of factors are ever shuffled alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.batches import _SPACE, SLICE_BYTES, hash_runs, mix, slices, utf8
from snapledger.llm.storage import discard, stored

WINDOW, ANCHOR = 20, 8
#: Bytes of text in a block, about.
BLOCK = 1 << 20
REACH = WINDOW - ANCHOR + 1
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: The id of rows without one: later than all others.
LAST = np.iinfo(np.int64).max


class Parsed:
    """Words, windows and phrases of the texts of a slice."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = utf8(texts)
        inside = ~_SPACE[self.data]
        cut = np.zeros(len(self.data) + 1, bool)
        cut[self.offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:-1]
        last[:-1] &= ~inside[1:] | cut[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.edges = np.searchsorted(self.starts, self.offsets)  # the first word of each text
        word = np.concatenate([np.zeros(0, np.uint64), *(self._hashed(k, k + step) for k, step in self._parts())])
        self._windows(word)

    def _parts(self):
        """Runs of words of about SLICE_BYTES, so that a very long text is hashed in parts."""
        if not len(self.starts):
            return []
        run = self.ends // SLICE_BYTES
        edges = np.concatenate([[0], np.flatnonzero(run[1:] != run[:-1]) + 1, [len(run)]])
        return zip(edges[:-1].tolist(), np.diff(edges).tolist(), strict=True)

    def _hashed(self, low: int, high: int) -> np.ndarray:
        start = self.starts[low]
        return hash_runs(self.data[start:self.ends[high - 1]], self.starts[low:high] - start, self.ends[low:high] - start)

    def _windows(self, word: np.ndarray) -> None:
        def joined(left, right, step):
            return mix(left[:max(0, len(right) - step)] * _GOLD + right[step:])

        n = len(word)
        with np.errstate(over="ignore"):
            two = joined(word, word, 1)
            four = joined(two, two, 2)
            eight = joined(four, four, 4)
            twenty = joined(joined(eight, eight, 8), four, 16)
        text = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))
        at = np.flatnonzero(text[:len(twenty)] == text[n - len(twenty):]) if n >= WINDOW else np.zeros(0, np.int64)
        self.window, self.at, self.text = twenty[at], at, text[at]
        anchor = np.zeros(len(at), np.int64)
        if len(at):
            near = np.lib.stride_tricks.sliding_window_view(eight, REACH)
            for low in range(0, len(at), 1 << 18):
                anchor[low:low + (1 << 18)] = near[at[low:low + (1 << 18)]].argmin(axis=1)
            anchor += at
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.text[1:] != self.text[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(at))
        self.phrase_of = np.cumsum(new) - 1
        self.anchor = eight[anchor[begin]]
        with np.errstate(over="ignore"):
            self.phrase = mix((self.window[begin] * _GOLD + self.window[end - 1]) * _GOLD + (end - begin).astype(np.uint64) if len(begin) else self.window[begin])
        self.phrase_text = self.text[begin]


def least_by(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, the smallest value of each, and the place of each row's key."""
    keys, place = np.unique(key, return_inverse=True)
    least = np.full(len(keys), LAST, np.int64)
    np.minimum.at(least, place, value)
    return keys, least, place


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _packed(table) -> bytes:
    """Rows as compressed Arrow bytes, so that a block of texts is written and shuffled small."""
    sink = pa.BufferOutputStream()
    table = pa.Table.from_batches([table]) if isinstance(table, pa.RecordBatch) else table
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _opened(packed: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed).read_all().combine_chunks().to_batches()[0]


def _blocks(batches):
    """A row with the texts of each block."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, BLOCK):
            yield pa.record_batch([pa.array([block], pa.int64()), pa.array([_packed(part)], pa.binary())], ["block", "texts"])
            block += 1


def _index(batches):
    """Rows of the index from the texts of blocks: each anchor with its phrase (of several, two) and its first document."""
    for batch in batches:
        for block, texts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = _opened(texts.as_py())
            parsed = Parsed(part.column(1))
            anchors, place = np.unique(parsed.anchor, return_inverse=True)
            phrase = (parsed.phrase >> np.uint64(32)).astype(np.int64)
            low, high, doc = np.full(len(anchors), LAST, np.int64), np.zeros(len(anchors), np.int64), np.full(len(anchors), LAST, np.int64)
            np.minimum.at(low, place, phrase)
            np.maximum.at(high, place, phrase)
            np.minimum.at(doc, place, _ids(part.column(0))[parsed.phrase_text])
            two = low != high
            anchors, phrase, doc = np.concatenate([anchors, anchors[two]]), np.concatenate([low, high[two]]), np.concatenate([doc, doc[two]])
            yield pa.record_batch([pa.array(np.full(len(anchors), block)), pa.array(anchors.view(np.int64)), pa.array(phrase.astype(np.uint32).view(np.int32)), pa.array(doc)], ["block", "anchor", "phrase", "doc"])


def _judged(parsed: Parsed, doc: np.ndarray, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each window the first document known so far that holds it, and whether other blocks must be asked for it."""
    own = doc[parsed.text]
    _, least, place = least_by(parsed.window, own)
    source = least[place]
    if not answers.num_rows:
        return source, np.zeros(len(source), bool)
    anchor = answers.column("anchor").to_numpy().view(np.uint64)
    order = np.argsort(anchor, kind="stable")
    anchor, several, first = anchor[order], answers.column("several").to_numpy(zero_copy_only=False)[order], answers.column("least").to_numpy()[order]
    at = np.minimum(np.searchsorted(anchor, parsed.anchor), len(anchor) - 1)
    known = anchor[at] == parsed.anchor
    one = (known & ~several[at])[parsed.phrase_of]
    source[one] = np.minimum(source[one], first[at][parsed.phrase_of][one])
    return source, (known & several[at])[parsed.phrase_of]


OUT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:int,end:int,source:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source", pa.int64())]))
_NAMES = ["doc_id", "n_words", "n_removed", "kept", "spans"]


def _answers(part: pa.RecordBatch, parsed: Parsed, doc: np.ndarray, source: np.ndarray, rows: np.ndarray) -> list[pa.Array]:
    """The columns of OUT for the texts numbered ``rows``."""
    # a window also stands earlier if its own document has it before
    key = np.lexsort((parsed.at, parsed.window, parsed.text))
    again = np.zeros(len(key), bool)
    if len(key) > 1:
        same = (parsed.window[key][1:] == parsed.window[key][:-1]) & (parsed.text[key][1:] == parsed.text[key][:-1])
        again[key[1:]] = same
    marked = (source < doc[parsed.text]) | again
    words = len(parsed.starts)
    cover = np.zeros(words + WINDOW + 1, np.int32)
    np.add.at(cover, parsed.at[marked], 1)
    np.add.at(cover, parsed.at[marked] + WINDOW, -1)
    removed = np.cumsum(cover)[:words] > 0
    counts = np.diff(parsed.edges)
    gone = np.diff(np.concatenate([[0], np.cumsum(removed)])[parsed.edges])
    # kept words with one space behind each but a text's last
    keep = np.zeros(len(parsed.data) + 1, np.int32)
    starts, ends = parsed.starts[~removed], parsed.ends[~removed]
    after = ends < np.repeat(parsed.offsets[1:], counts - gone)
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends + after, -1)
    own = np.cumsum(keep[:-1]) > 0
    spaced = np.where(_SPACE[parsed.data], np.uint8(32), parsed.data)[own]
    size = np.concatenate([[0], np.cumsum(own)])[parsed.offsets]
    # factors: runs of marked windows with one source
    at, text, origin = parsed.at[marked], parsed.text[marked], np.minimum(source, doc[parsed.text])[marked]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1]) | (origin[1:] != origin[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))[:len(begin)] - 1
    factor_text, base = text[begin], parsed.edges[text[begin]]
    factors = pa.StructArray.from_arrays([pa.array((at[begin] - base).astype(np.int32)), pa.array((at[end] + WINDOW - base).astype(np.int32)),
                                          pa.array(origin[begin], mask=origin[begin] == LAST)], ["start", "end", "source"])
    offsets = np.searchsorted(factor_text, np.arange(len(counts) + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), factors).take(pa.array(rows))
    kept = [spaced[size[k]:size[k + 1]].tobytes().rstrip(b" ").decode() for k in rows.tolist()]
    return [part.column(0).take(pa.array(rows)), pa.array(counts[rows]), pa.array(gone[rows]), pa.array(kept, pa.string()), spans.cast(_SPANS)]


_SECOND = f"{OUT}, block long, texts binary, seen long, window long, first long"
_EXTRA = ["block", "texts", "seen", "window", "first"]


def _whole_phrases(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """A block after the first lookup: finished documents; the others as packed texts; their windows that must be looked up alone."""
    part = _opened(texts.column("texts")[0].as_py())
    block, doc, parsed = texts.column("block")[0].as_py(), _ids(part.column(0)), Parsed(part.column(1))
    source, ask = _judged(parsed, doc, answers)
    open_ = np.zeros(part.num_rows, bool)
    open_[parsed.text[ask]] = True
    done = np.flatnonzero(~open_)
    out = [pa.record_batch([*_answers(part, parsed, doc, source, done), pa.array(np.full(len(done), block)), pa.nulls(len(done), pa.binary()), *[pa.nulls(len(done), pa.int64())] * 3], _NAMES + _EXTRA)]
    if open_.any():
        rest = part.take(pa.array(np.flatnonzero(open_)))
        mine = open_[parsed.text]
        held = pa.table({"source": source[mine]})
        out.append(pa.record_batch([*_empty(1), pa.array([block]), pa.array([_packed(rest)], pa.binary()), pa.array([0]), *[pa.nulls(1, pa.int64())] * 2], _NAMES + _EXTRA))
        out.append(pa.record_batch([*_empty(1), pa.array([block]), pa.array([_packed(held)], pa.binary()), pa.array([1]), *[pa.nulls(1, pa.int64())] * 2], _NAMES + _EXTRA))
        window, least, _ = least_by(parsed.window[ask], source[ask])
        n = len(window)
        out.append(pa.record_batch([*_empty(n), pa.array(np.full(n, block)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.array(window.view(np.int64)), pa.array(least)], _NAMES + _EXTRA))
    return pa.Table.from_batches(out)


def _empty(n: int) -> list[pa.Array]:
    return [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string(), _SPANS)]


def _borders(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The open documents of a block after the lookup of their single windows."""
    packed = {k: _opened(x) for k, x in zip(texts.column("seen").to_pylist(), texts.column("texts").to_pylist(), strict=True)}
    part, source = packed[0], packed[1].column(0).to_numpy().copy()
    doc, parsed = _ids(part.column(0)), Parsed(part.column(1))
    if answers.num_rows:
        window = answers.column("window").to_numpy().view(np.uint64)
        order = np.argsort(window)
        window, first = window[order], answers.column("least").to_numpy()[order]
        at = np.minimum(np.searchsorted(window, parsed.window), len(window) - 1)
        source = np.where(window[at] == parsed.window, np.minimum(source, first[at]), source)
    return pa.Table.from_batches([pa.record_batch(_answers(part, parsed, doc, source, np.arange(part.num_rows)), _NAMES)])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the text that stays, words joined by one space), spans.

    Words are runs of other than white space, unchanged. A word goes if a window of 20 words that covers it also starts
    earlier: in a document of smaller id, or before in the same row. Rows of one id are not earlier than one another, rows
    with a null id come after all others. ``spans`` are the factors: runs of words copied from one ``source`` (its id; the
    document's own for a passage that it repeats itself, null without id). A null or empty text has no words. Other columns
    are left out; an empty table gives no rows. Windows are compared by hashes of 64 bits.

    A block is about BLOCK bytes of text. Both lookups are windows over one exchange whose rows under a key are two a block at most,
    however many documents share a passage; the texts are shuffled once as compressed blocks, those still open once more. Two
phrases of one anchor are told apart by 32 bits of their hashes.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blocks = stored(rows.mapInArrow(_blocks, "block long, texts binary"))
    key = Window.partitionBy("anchor")
    index = blocks.mapInArrow(_index, "block long, anchor long, phrase int, doc long").select(
        F.col("block").alias("of"), "anchor", (F.min("phrase").over(key) != F.max("phrase").over(key)).alias("several"), F.min("doc").over(key).alias("least"),
        (F.min("block").over(key) != F.max("block").over(key)).alias("shared"))
    index = index.where("shared").select("of", "anchor", "several", "least").distinct()
    first = stored(blocks.groupBy("block").cogroup(index.groupBy("of")).applyInArrow(_whole_phrases, _SECOND))
    discard(blocks)
    key = Window.partitionBy("window")
    windows = first.where("window is not null").select(F.col("block").alias("of"), "window", F.min("first").over(key).alias("least"), F.count("*").over(key).alias("n")).where("n > 1")
    open_ = first.where("seen is not null").select("block", "texts", "seen")
    second = open_.groupBy("block").cogroup(windows.drop("n").groupBy("of")).applyInArrow(_borders, OUT)
    return first.where("n_words is not null").select(*_NAMES).unionByName(second)


#: Each window's first place by its words, spelled out.
SQL = """
with worded as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') s from (select doc_id, w, unnest(range(1, len(w) - 18)) i from worded where len(w) >= 20)),
again as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) k from windows) where k > 1),
gone as (select doc_id, list(distinct p) places from (select doc_id, unnest(range(i, i + 20)) p from again) group by 1)
select d.doc_id, len(w)::bigint n_words, coalesce(len(places), 0)::bigint n_removed,
  sha256(array_to_string(list_filter(w, lambda x, k: not coalesce(list_contains(places, k), false)), ' ')) kept_sha256
from worded d left join gone g on g.doc_id = d.doc_id
"""
