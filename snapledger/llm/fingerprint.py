"""Document fingerprints by locally consistent parsing.

A text's characters are its names of level 0. On each level runs of one name become one symbol; deterministic coin tossing
(the lowest bit in which a symbol differs from the one before, a few times over) turns symbols into small labels that depend
on a few neighbours only; phrases begin at local maxima of the labels, and a phrase's name is a hash of its symbols. So equal
substrings get equal phrases, but for a few at their ends, wherever they stand. The fingerprint is the name of the whole text
and the smallest hashes of the names of its phrases from level 2 up, a sample by which two texts' likeness is estimated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import hash_runs, mix, slices, texts_of

KEPT = 64
FROM_LEVEL = 2
SLICE = 1 << 20
ROUNDS = 3


def _toss_table() -> np.ndarray:
    """The label of every two different labels under 128 of neighbours: own label first."""
    a, b = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    d = a ^ b
    low = np.zeros_like(d)
    for bit in range(6, -1, -1):
        low[(d >> bit) & 1 == 1] = bit
    return (2 * low + ((a >> low) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small labels, different for neighbours; ``first``: where texts begin."""
    differ = np.empty_like(symbols)
    differ[1:] = symbols[1:] ^ symbols[:-1]
    differ[first] = 1
    low = differ & (~differ + np.uint64(1))
    bit = np.maximum((low.astype(np.float64).view(np.int64) >> 52) - 1023, 0).astype(np.uint64)
    label = (2 * bit + (symbols >> bit & np.uint64(1))).astype(np.int16)
    for _ in range(ROUNDS):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ 1
        label = _TOSS[(label << 7) + before].astype(np.int16)
    return label


def phrases(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The whole name of each text (0 if empty), and the owners and hashes of all phrases from FROM_LEVEL up."""
    whole = np.zeros(len(texts), np.uint64)
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    owners, hashes, level = [], [], 0
    while len(names):
        level += 1
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        run = np.diff(np.append(at, len(names))).astype(np.uint64)
        symbol, owner = names[at], owner[at]
        with np.errstate(over="ignore"):
            symbol = np.where(run > 1, mix(symbol * np.uint64(0x9E3779B97F4A7C15) + run), symbol)
        starts = np.ones(len(symbol), bool)
        starts[1:] = owner[1:] != owner[:-1]
        label = _labels(symbol, np.flatnonzero(starts))
        begin = starts.copy()
        # a phrase begins at a local maximum, but not at a text's last symbol
        begin[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~starts[2:]
        begin_at = np.flatnonzero(begin)
        names, owner = hash_runs(symbol, begin_at, np.append(begin_at[1:], len(symbol))), owner[begin_at]
        if level >= FROM_LEVEL:
            owners.append(owner)
            hashes.append(mix(names + np.uint64(level)))
        alone = np.ones(len(names), bool)
        alone[1:] &= owner[1:] != owner[:-1]
        alone[:-1] &= owner[1:] != owner[:-1]
        if alone.any():
            with np.errstate(over="ignore"):
                whole[owner[alone]] = mix(names[alone] + np.uint64(level << 8))
            names, owner = names[~alone], owner[~alone]
    return whole, np.concatenate(owners) if owners else np.zeros(0, np.int64), np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)


def fingerprints(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The whole name of each text and its KEPT smallest phrase hashes (32 bits)."""
    whole, owner, hashed = phrases(texts)
    keys = np.unique((owner.astype(np.uint64) << np.uint64(32)) | (hashed >> np.uint64(32)))
    ends = np.searchsorted(keys, np.arange(1, len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    short = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return whole, [short[s:min(e, s + KEPT)] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def spelled(whole: np.uint64, kept: np.ndarray) -> str:
    """A fingerprint as text; that of an empty text is empty."""
    return f"{int(whole):016x}{kept.astype('>u4').tobytes().hex()}" if whole else ""


def likeness(whole_a, a: np.ndarray, whole_b, b: np.ndarray) -> float:
    """1 for equal texts, else the share of common ones among the smallest phrase hashes of both."""
    if whole_a == whole_b:
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    distinct = np.concatenate([[True], ~twice]) if len(both) else np.zeros(0, bool)
    n = min(KEPT, int(distinct.sum()))
    if not n:
        return 0.0
    edge = both[distinct][n - 1]
    return float((both[1:][twice] <= edge).sum() / n)


def edited(text: str, following: str) -> str:
    """``text`` with the latter half of its characters replaced by as many of ``following``, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches):
    """Answers for rows (block, tail, doc_id, text) in order; the row after each of a block is the next document."""
    columns = [x.split()[0] for x in OUT.split(", ")]
    held: tuple | None = None  # the last row, which waits for the next
    ids, texts, follow = [], [], []

    def answers():
        made = [edited(t, n) for t, n in zip(texts, follow, strict=True)]
        place: dict[str, int] = {}
        for t in (*texts, *follow, *made):
            place.setdefault(t, len(place))
        whole, kept = fingerprints(list(place))
        rows = []
        for doc, text, after, change in zip(ids, texts, follow, made, strict=True):
            a, b, c = place[text], place[change], place[after]
            rows.append((doc, len(text), hashlib.sha256(change.encode("utf-8", "surrogatepass")).hexdigest(), spelled(whole[a], kept[a]), spelled(whole[b], kept[b]),
                         likeness(whole[a], kept[a], whole[b], kept[b]), likeness(whole[a], kept[a], whole[c], kept[c])))
        out = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], columns)
        ids.clear(), texts.clear(), follow.clear()
        return out

    for batch in batches:
        for part in slices(batch, SLICE):
            for block, tail, doc, text in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                if held and held[0] == block and not held[1]:
                    ids.append(held[2]), texts.append(held[3]), follow.append(text)
                held = (block, tail, doc, text)
            if ids:
                yield answers()


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next smaller id, after the last (null ids come last) the first; equal ids stand in
    order of their texts; a document alone is its own next. A null text is empty, and an empty text's fingerprint is empty;
    other columns are left out; an empty table gives no rows.

    Documents are dealt into as many ranges of ids as the session shuffles into, cut at ids that exist, so the head of each
    range is known and sent to the range before as well: each text is shuffled once, and tasks read sorted rows one by one.
    """
    spark, rows = df.sparkSession, texts_of(df, id_col, text_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = rows.agg(F.max("doc_id").alias("top"), F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 100 * parts).alias("cuts")).first()
    cuts = sorted({c for c in bounds["cuts"] or [] if c < bounds["top"]})
    last = len(cuts)
    block = F.aggregate(F.lit(cuts), F.lit(0), lambda n, c: n + (c < F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))).cast("int")) if cuts else F.lit(0)
    placed = rows.withColumn("block", block)
    head = F.array_contains(F.lit(cuts), F.col("doc_id")) if cuts else F.lit(False)
    places = F.array_compact(F.array(
        F.struct("block", F.lit(False).alias("tail")),
        F.when(head, F.struct((F.col("block") + 1).alias("block"), F.lit(True).alias("tail"))),
        F.when(F.lit(bounds["top"] is None) | (F.col("doc_id") == bounds["top"]), F.struct(F.lit(0).alias("block"), F.lit(True).alias("tail"))),
    ))
    dealt = placed.select(F.explode(places).alias("p"), "doc_id", "text").select("p.block", "p.tail", "doc_id", "text")
    ordered = dealt.repartition(last + 1, "block").sortWithinPartitions("block", "tail", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.mapInArrow(_compare, OUT)
