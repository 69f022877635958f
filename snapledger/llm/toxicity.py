"""Toxicity: class-conditional Kneser-Ney models of characters.

A toxic and an ordinary model give each character a probability after the five before it. Counts of six characters belong to
a class; its five-character level holds continuation counts (after how many different characters they stand) of that class;
both back off to four-character continuation counts that the classes share and that come from all documents, labelled or not.
So an expression that was never labelled is no evidence. A text is judged by its log-likelihood ratio per character, over the
whole text and over its best windows of several widths; a logistic fit on rows left out of the counts turns that into a score.

The classes are learned from at most about LEARNED labelled rows each, those whose ids have the smallest hashes; all other texts
add to the shared counts, for which the distinct sequences of five characters are enough. All levels that belong to six
characters hold the third to the fifth of them, so counts are dealt by these three and each part of the model is computed on
its own. A sequence that no labelled text holds has the same probability in both models but for what its shorter levels
differ, so only sequences, continuations and contexts of labelled texts are kept: this is exact, and bounds the model by LEARNED.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import Slots, mix, slices, texts_of
from snapledger.llm.language import held_out

ORDER = 6
DISCOUNT = 0.75
#: Learn a class from about so many labelled rows.
LEARNED = 1 << 15
#: Parts that counts are dealt into; entries that a task gathers before it merges them, and that it keeps merged.
PARTS, GATHERED, MERGED = 1024, 1 << 21, 1 << 20
#: Fit the score on about so many labelled rows that are left out of the counts (those whose ids have the smallest hashes).
FITTED = 40_000
WINDOWS = (8, 12, 16, 32, 64)
SLICE = 1 << 20
#: A sequence's key is the sum of its characters' terms by place; parts of it lack the terms of the characters they lack.
_TERMS = mix(np.arange(1, ORDER + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BUCKET_BITS = 30


def _term(codes: np.ndarray, place: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (codes + np.uint64(1)) * _TERMS[place]


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of all texts, whether the sequence of six from each lies in one text, and where each text begins.

    Texts are lower-cased, stand between spaces, and have ASCII white space as a space; every other character stands for itself.
    A text with under six characters gets spaces after it.
    """
    padded = [f" {t.lower()} ".ljust(ORDER) for t in texts]
    sizes = np.array([len(t) for t in padded], np.int64)
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[(codes >= 9) & (codes <= 13)] = 32
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    return codes, left[:len(codes) - ORDER + 1] >= ORDER, np.cumsum(sizes) - sizes


def _keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The key of the sequence from each character, the terms of its first and last, and its bucket by the third to fifth."""
    n = len(codes) - ORDER + 1
    middle = _term(codes[2:n + 2], 2) + _term(codes[3:n + 3], 3) + _term(codes[4:n + 4], 4)
    first, last = _term(codes[:n], 0), _term(codes[5:n + 5], 5)
    return first + _term(codes[1:n + 1], 1) + middle + last, first, last, (mix(middle) >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)


def count_sequences(rows: DataFrame) -> DataFrame:
    """(part, sequence, ends, toxic, plain): how often a sequence of six stands in texts of either class, from each task.

    ``rows``: text, and toxic 1, 0 or null. ``ends``: its first, second and last character. Texts without a class give their
    distinct sequences of five with both counts 0. Each task adds up its own counts before it hands them on; those of several
    tasks are still to be added up.
    """
    schema, parts = ["part", "sequence", "ends", "toxic", "plain"], PARTS

    def count(batches):
        gathered: list[tuple] = []
        size = 0

        def merged():
            keys, at, place = np.unique(np.concatenate([g[1] for g in gathered]), return_index=True, return_inverse=True)
            return (np.concatenate([g[0] for g in gathered])[at], keys, np.concatenate([g[2] for g in gathered])[at],
                    *(np.bincount(place, np.concatenate([g[k] for g in gathered])).astype(np.int32) for k in (3, 4)))

        def batch_of(found):
            return pa.record_batch([pa.array((found[0] * parts >> _BUCKET_BITS).astype(np.int64)), pa.array(found[1].view(np.int64)), pa.array(found[2]), *(pa.array(c.astype(np.int64)) for c in found[3:])], schema)

        for batch in batches:
            for part in slices(batch, SLICE):
                codes, inside, starts = sequences(part.column(0).to_pylist())
                if not len(inside):
                    continue
                value, first, _, bucket = _keys(codes)
                kind = part.column(1).fill_null(2).to_numpy(zero_copy_only=False).astype(np.int64)
                kind = np.repeat(kind, np.diff(np.append(starts, len(codes))))[:len(value)]
                for k in range(3):
                    own = np.flatnonzero(inside & (kind == k))
                    keys, at, n = np.unique(value[own] - first[own] if k == 2 else value[own], return_index=True, return_counts=True)
                    at = own[at]
                    ends = (codes[at] << np.uint64(42) | codes[at + 1] << np.uint64(21) | codes[at + 5]).astype(np.int64)
                    gathered.append((bucket[at], keys, ends, (n * (k == 1)).astype(np.int32), (n * (k == 0)).astype(np.int32)))
                    size += len(keys)
                if size > GATHERED:
                    gathered = [merged()]
                    if len(gathered[0][0]) > MERGED:
                        yield batch_of(gathered.pop())
                    size = sum(len(g[0]) for g in gathered)
        if gathered:
            yield batch_of(merged())

    return rows.mapInArrow(count, ", ".join(f"{c} long" for c in schema))


def models(sequence: np.ndarray, ends: np.ndarray, toxic: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and log-likelihood ratios: of sequences of six and five characters, and what backing off adds after five and four.

    Takes all counts of some middles, each sequence once; those with both counts 0 are sequences of five of other texts.
    """
    own, ends = toxic + plain > 0, ends.astype(np.uint64)
    others, other_ends = sequence[~own], ends[~own]
    sequence, toxic, plain, ends = sequence[own], toxic[own], plain[own], ends[own]
    low = np.uint64((1 << 21) - 1)
    before5, at_before5 = np.unique(sequence - _term(ends & low, 5), return_inverse=True)
    fives, ends = np.concatenate([sequence - _term(ends >> np.uint64(42), 0), others]), np.concatenate([ends, other_ends])
    second, last = _term(ends >> np.uint64(21) & low, 1), _term(ends & low, 5)
    five, one, at_five = np.unique(fives, return_index=True, return_inverse=True)
    at_five = at_five[:len(sequence)]
    before4, at_before4 = np.unique(five - last[one], return_inverse=True)
    four, at, at_four = np.unique(five - second[one], return_index=True, return_inverse=True)
    _, at_before3 = np.unique(four - last[one][at], return_inverse=True)
    ways = np.bincount(at_four)
    shared = ((ways + 0.1) / (np.bincount(at_before3, ways)[at_before3] + 6.4))[at_four]
    logs = []
    for n in (toxic, plain):
        ways5 = np.bincount(at_five, n > 0, len(five))
        all4, kinds4 = np.bincount(at_before4, ways5), np.bincount(at_before4, ways5 > 0)
        rest4 = np.where(all4 > 0, DISCOUNT * kinds4 / np.maximum(all4, 1), 1.0)
        p5 = np.maximum(ways5 - DISCOUNT, 0) / np.maximum(all4, 1)[at_before4] + rest4[at_before4] * shared
        all5, kinds5 = np.bincount(at_before5, n), np.bincount(at_before5, n > 0)
        rest5 = np.where(all5 > 0, DISCOUNT * kinds5 / np.maximum(all5, 1), 1.0)
        p6 = np.maximum(n - DISCOUNT, 0) / np.maximum(all5, 1)[at_before5] + rest5[at_before5] * p5[at_five]
        logs.append([np.log(x) for x in (rest4, p5, rest5, p6)])
    rest4, p5, rest5, p6 = (a - b for a, b in zip(*logs, strict=True))
    levels = [(sequence, p6, np.arange(len(sequence))), (five, p5, at_five), (before5, rest5, at_before5), (before4, rest4, at_before4[at_five])]
    held = [np.bincount(at, minlength=len(k)) > 0 for k, _, at in levels]
    return np.concatenate([k[h] for (k, _, _), h in zip(levels, held, strict=True)]), np.concatenate([v[h] for (_, v, _), h in zip(levels, held, strict=True)]).astype(np.float32)


class Model:
    """Log-likelihood ratios by key, ready to be looked up."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.slots = Slots(1 << max(6, (3 * len(keys) // 2).bit_length()))
        self.values = np.zeros(len(self.slots.keys), np.float32)
        self.values[self.slots.insert(keys)] = values

    def _of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.slots.find(keys)
        return at, np.where(at >= 0, self.values[at], 0)

    def odds(self, codes: np.ndarray) -> np.ndarray:
        """The log-likelihood ratio of the last character of the sequence from each character."""
        six, first, last, _ = _keys(codes)
        six, place = np.unique(six, return_inverse=True)
        at = np.zeros(len(six), np.int64)
        at[place] = np.arange(len(place))
        first, last = first[at], last[at]
        at, found = self._of(six)
        new = np.flatnonzero(at < 0)
        five = six[new] - first[new]
        at, short = self._of(five)
        shorter = np.flatnonzero(at < 0)
        short[shorter] = self._of(five[shorter] - last[new[shorter]])[1]
        found[new] = self._of(six[new] - last[new])[1] + short
        return found[place].astype(float)


_MODELS: dict[int, Model] = {}


def model_of(sent) -> Model:
    """The worker's copy of the model that a broadcast holds, in place of any other."""
    if sent.value[0] not in _MODELS:
        _MODELS.clear()
        _MODELS[sent.value[0]] = Model(*sent.value[1:])
    return _MODELS[sent.value[0]]


def learn(classed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the model of ``classed`` (text, toxic; the rows with a class are bounded)."""
    dealt = count_sequences(classed).repartition("part")
    summed = dealt.groupBy("part", "sequence").agg(F.any_value("ends").alias("ends"), F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))

    def build(table):
        keys, values = models(table["sequence"].to_numpy().view(np.uint64), *(table[c].to_numpy() for c in ("ends", "toxic", "plain")))
        return pa.table([pa.array(keys.view(np.int64)), pa.array(values)], ["key", "value"])

    found = summed.groupBy("part").applyInArrow(build, "key long, value float").toArrow()
    return found["key"].to_numpy().view(np.uint64), found["value"].to_numpy()


def features(texts: list[str], model: Model) -> np.ndarray:
    """Log-likelihood ratio per character of each whole text, the logarithm of its length, and its best window of each width."""
    if not texts:
        return np.zeros((0, 2 + len(WINDOWS)))
    codes, inside, starts = sequences(texts)
    odds = np.where(inside, model.odds(codes), 0)
    running = np.concatenate([[0.0], np.cumsum(odds)])
    counts = np.add.reduceat(inside.astype(np.int64), starts)
    out = np.zeros((len(texts), 2 + len(WINDOWS)))
    out[:, 0] = (running[starts + counts] - running[starts]) / counts
    out[:, 1] = np.log(counts)
    last = np.repeat(starts + counts, np.diff(np.append(starts, len(inside))))
    for k, width in enumerate(WINDOWS):
        fits = np.arange(len(inside)) + width <= last
        window = np.full(len(inside), -np.inf)
        window[fits] = (running[np.flatnonzero(fits) + width] - running[np.flatnonzero(fits)]) / width
        best = np.maximum.reduceat(window, starts)
        out[:, 2 + k] = np.where(counts >= width, best, out[:, 0])
    return out


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic fit with a small ridge, the constant last, for features as they are."""
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return np.append(np.zeros(x.shape[1]), np.log(rate / (1 - rate)) - 1e-9)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    ridge = np.append(np.full(x.shape[1], 1.0), 1e-6)
    weights = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        gradient = z.T @ (p - y) + ridge * weights
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    scaled = weights[:-1] / spread
    return np.append(scaled, weights[-1] - scaled @ mean)


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher: toxic likelier) and predicted.

    ``labels`` (doc_id, toxic): rows whose id is null or held out, or whose label is null, teach nothing; an id with several
    labels counts as toxic if one is. Empty and null texts get the score of a text of spaces; without labels of both classes
    every text gets the rate of toxic labels (under 0.5 if there is none). Repeated rows are each answered; other columns are
    left out; an empty table gives no rows.
    """
    rows = texts_of(df, id_col, text_col)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"), 5, 0)).withColumn("fitted", held_out(F.col("doc_id"), 5, 4))
    span = 1 << 30
    near = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    total = {(r["fitted"], r["toxic"]): r["count"] for r in known.groupBy("fitted", "toxic").count().collect()}
    fitted = sum(n for (fold, _), n in total.items() if fold)
    used = F.lit(False)
    for (fold, kind), n in total.items():
        share = FITTED / fitted if fold else LEARNED / n
        used = used | ((F.col("fitted") == fold) & (F.col("toxic") == kind) & (near < int(span * min(1.0, share))))
    # about 2 * LEARNED + FITTED rows, so this side is small whatever the input
    bounded = F.broadcast(known.where(used))
    classed = rows.join(bounded, "doc_id", "left").select("text", F.when(~F.col("fitted"), F.col("toxic")).alias("toxic"))
    model = df.sparkSession.sparkContext.broadcast((uuid.uuid4().int, *learn(classed)))
    names = [f"x{k}" for k in range(2 + len(WINDOWS))]

    def measured(batches):
        own = model_of(model)
        for batch in batches:
            for part in slices(batch, SLICE):
                x = features(part.column(0).to_pylist(), own)
                yield pa.record_batch([*(pa.array(c) for c in x.T), part.column(1)], [*names, "toxic"])

    left_out = rows.join(F.broadcast(known.where(used & F.col("fitted"))), "doc_id").select("text", "toxic")
    fitted = left_out.mapInArrow(measured, ", ".join(f"{n} double" for n in names) + ", toxic int").toPandas()
    weights = logistic(fitted[names].to_numpy(float), fitted["toxic"].to_numpy(float))

    def scored(batches):
        own = model_of(model)
        for batch in batches:
            for part in slices(batch, SLICE):
                x = features(part.column(1).to_pylist(), own)
                value = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -500, 500)))
                yield pa.record_batch([part.column(0), pa.array(value)], ["doc_id", "score"])

    return rows.mapInArrow(scored, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
