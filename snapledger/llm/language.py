"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from a bounded sample of labelled documents, added up by Spark; the matrix of log-probabilities (languages x
buckets, both bounded) is broadcast, and every whole text is scored in numpy batches that gather its columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import mix, slices

UNKNOWN = "und"
BUCKETS = 1 << 16
ORDER = 4
SMOOTHING = 0.5
#: Learn from about so many documents of a language (those whose ids have the smallest hashes).
PER_LANGUAGE = 4000
SLICE = 1 << 19
#: More languages than this are none; so the matrix that is broadcast has a bound (256 kB a language).
MOST_LANGUAGES = 1024
#: Log-probabilities gathered at a time, whatever the number of languages.
GATHERED = 1 << 20


def grams(texts: list[str]) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Where each text begins, and for each order the buckets of the n-grams from every character and which of them lie in one text.

    Texts are lower-cased and stand between spaces, so that none is empty.
    """
    padded = [f" {t.lower()} " for t in texts]
    sizes = np.array([len(t) for t in padded], np.int64)
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))

    def orders():
        value = np.zeros(len(codes), np.uint64)
        with np.errstate(over="ignore"):
            for n in range(1, ORDER + 1):
                value = value[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:]
                yield (mix(value + np.uint64(n << 56)) >> np.uint64(48)).astype(np.int64), left[:len(value)] >= n

    return np.cumsum(sizes) - sizes, orders()


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of ``rows`` (text, lang; none null) and the matrix of log-probabilities, a row for each bucket."""
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"{len(langs)} languages, {MOST_LANGUAGES} at most")
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    span = 1 << 30
    take = F.lit(0)
    for lang in langs:
        share = min(span, int(span * min(1.0, PER_LANGUAGE / sizes[lang])))
        take = F.when(F.col("lang") == lang, F.lit(share)).otherwise(take)
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < take).select("text", "lang")
    number = {lang: k for k, lang in enumerate(langs)}

    def count(batches):
        total = np.zeros(len(langs) * BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, SLICE):
                texts = part.column(0).to_pylist()
                base = np.array([number[x] for x in part.column(1).to_pylist()], np.int64) * BUCKETS
                starts, orders = grams(texts)
                owner = None
                for buckets, valid in orders:
                    if owner is None:
                        owner = np.repeat(base, np.diff(np.append(starts, len(buckets))))
                    total += np.bincount((owner[:len(buckets)] + buckets)[valid], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], ["slot", "n"])

    counts = sample.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    table = np.full(len(langs) * BUCKETS, SMOOTHING)
    table[counts["slot"].to_numpy()] += counts["n"].to_numpy()
    table = table.reshape(len(langs), BUCKETS)
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()


def score(texts: list[str], matrix: np.ndarray) -> np.ndarray:
    """The log-likelihood of each text in each language: the columns of its n-grams, gathered piece by piece and added up."""
    starts, orders = grams(texts)
    total, piece = np.zeros((len(texts), matrix.shape[1])), max(1, GATHERED // matrix.shape[1])
    for buckets, valid in orders:
        at = np.flatnonzero(valid)
        for low in range(0, len(at), piece):
            own = at[low:low + piece]
            text = np.searchsorted(starts, own, side="right") - 1
            first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            total[text[first]] += np.add.reduceat(matrix[buckets[own]], first, axis=0, dtype=np.float64)
    return total


def predict(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language of each text and its posterior; ``und`` and 0 for a text that is null or has no letter."""
    names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
    own = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    if langs and own:
        values = score([texts[k] for k in own], matrix)
        best[own] = 1 / np.exp(values - values.max(axis=1, keepdims=True)).sum(axis=1)
        for k, top in zip(own, values.argmax(axis=1).tolist(), strict=True):
            names[k] = langs[top]
    return names, best


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def _learned(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> Callable[[list[str | None]], tuple[list[str], np.ndarray]]:
    """What predicts texts, learned from the rows of ``df`` that teach."""
    known = df.where(~held_out(F.col(id_col), 4, 2) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    langs, matrix = learn(known.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")))
    shared = df.sparkSession.sparkContext.broadcast(matrix)
    return lambda texts: predict(texts, langs, shared.value)


def predicted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Column:
    """``identify`` as a column over the rows of ``df``: a struct of lang_pred and score. Only the texts reach Python."""
    found = _learned(df, id_col, text_col, lang_col)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [found(part.column(0).to_pylist()) for part in slices(pa.record_batch([column], ["text"]), SLICE)]
            names, best = [n for part in parts for n in part[0]], np.concatenate([np.zeros(0), *(part[1] for part in parts)])
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(best)], ["lang_pred", "score"])

    # not deterministic for Spark: else it would run once for a filter on the result and once more for the result
    return F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()(F.col(text_col).cast("string"))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred and score (posterior of that language, 0 to 1).

    Learns from rows with a text and a language whose id isn't held out. A text that is null or has no letter is ``und`` with
    score 0, so is every text when nothing can be learned; ties go to the first language by code point. Repeated rows are each
    answered; a null id is not held out; other columns are left out; an empty table gives no rows.
    """
    found = _learned(df, id_col, text_col, lang_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, SLICE):
                names, best = found(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(names, pa.string()), pa.array(best)], ["doc_id", "lang_pred", "score"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    answers = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return answers.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
