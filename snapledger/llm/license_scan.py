"""Licence scan by a positional rare-token index, in DataFrame operations only.

The index holds the words of each licence notice that are rarest over all documents, with their places in the notice. A file
looks up all of them that it holds; each pair of a place in the file and one in a notice votes for the offset between them,
and the offset with most votes aligns the notice. A label is given when enough words align and all key phrases of the notice
stand in the file.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.licences import PHRASES, TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII other than digits and lower-case letters (texts are lower-cased before).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of each notice that the index holds, and votes that align a notice.
INDEXED, VOTES = 12, 2


def plain_words(text: str) -> list[str]:
    return [w for w in re.split(BETWEEN, text.translate(str.maketrans(UPPER, LOWER))) if w]


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), lambda w: w != "")


def places(words: Column, spaced: Column, phrase: list[str]) -> Column:
    """Where the words of ``phrase`` stand one after the other; only texts that hold the phrase are searched."""
    def here(w, i):
        fits = w == phrase[0]
        for j, other in enumerate(phrase[1:], 1):
            fits = fits & F.coalesce(F.get(words, i + j) == other, F.lit(False))
        return F.when(fits, i.cast("long"))

    none = F.array().cast("array<bigint>")
    return F.when(F.contains(spaced, F.lit(f" {' '.join(phrase)} ")), F.filter(F.transform(words, here), lambda i: i.isNotNull())).otherwise(none)


def document_frequency(rows: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of rows, and of rows that hold each word of ``vocabulary`` (which bounds what the driver gets)."""
    held = rows.select(F.explode(F.array_append(F.array_intersect(F.lit(vocabulary), "words"), F.lit(""))).alias("word"))
    found = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return found.pop("", 0), found


def build_index(notices: list[list[str]], files: int, frequency: dict[str, int]) -> tuple[list[str], list[tuple[str, int, int]]]:
    """Indexed words, rarest over all files first, and postings (word, notice, place)."""
    def idf(word):
        return math.log((files + 1) / (frequency.get(word, 0) + 1))

    postings = []
    for k, notice in enumerate(notices):
        rare = sorted(set(notice), key=lambda w: (-idf(w), w))[:INDEXED]
        postings += [(w, k, i) for i, w in enumerate(notice) if w in rare]
    return sorted({p[0] for p in postings}, key=lambda w: (-idf(w), w)), postings


def find_licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, letters and all beyond ASCII. Base: places of ``phrases``. ``score``: the largest share of a
    verified notice's indexed places that align, at least 0.5 where a base phrase stands. A null or empty text has no words and
    empty labels; repeated rows are each answered; a null id stays null; other columns are left out; an empty table gives no
    rows. The text itself is never shuffled.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), word_array(F.col(text_col)).alias("words"))
    notices = [plain_words(text) for _, text, _ in templates]
    files, frequency = document_frequency(rows, sorted({w for n in notices for w in n}))
    indexed, postings = build_index(notices, files, frequency)
    spaced = rows.select("doc_id", "words", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("spaced"))

    def verified(k: int) -> Column:
        held = [F.contains("spaced", F.lit(f" {' '.join(plain_words(p))} ")) for p in templates[k][2]]
        fits = held[0]
        for other in held[1:]:
            fits = fits & other
        return F.when(fits, F.lit(k))

    looked_up = spaced.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"),
        F.array_intersect(F.lit(indexed), "words").alias("rare"),
        F.array_compact(F.array(*(verified(k) for k in range(len(templates))))).alias("verified"),
        *(places(F.col("words"), F.col("spaced"), p.split(" ")).alias(f"base_{k}") for k, (p, _) in enumerate(phrases)),
    )
    base = [f"base_{k}" for k in range(len(phrases))]
    starts = F.flatten(F.array(*base))
    doc = F.struct(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_distinct(F.array_compact(F.array(*(F.when(F.size(b) > 0, F.lit(label)) for b, (_, label) in zip(base, phrases, strict=True))))).alias("base_labels"),
        "verified",
    )
    at = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("place"))), lambda x: F.array_contains("rare", x["word"]))
    # only files in which some notice's key phrases stand can get a label, so only those look up places
    numbered = looked_up.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc"), F.when(F.size("verified") > 0, at).alias("hits"))
    hits = numbered.select("row", "doc", F.explode_outer("hits").alias("hit"))
    index = spark.createDataFrame(postings, "word string, notice int, spot int")
    votes = hits.select("row", "doc", "hit.word", "hit.place").join(F.broadcast(index), "word", "left")  # bounded by the notices
    aligned = votes.groupBy("row", "notice", (F.col("place") - F.col("spot")).alias("offset")).agg(F.count("notice").alias("votes"), F.first("doc").alias("doc"))
    sizes = [sum(p[1] == k for p in postings) for k in range(len(templates))]
    fits = F.array_contains("doc.verified", F.col("notice")) & (F.col("votes") >= VOTES)
    labelled = aligned.groupBy("row").agg(
        F.first("doc").alias("doc"), F.collect_set(F.when(fits, F.get(F.lit([t[0] for t in templates]), F.col("notice")))).alias("more"),
        F.max(F.when(fits, F.col("votes") / F.get(F.lit(sizes), F.col("notice")))).alias("share"))
    return labelled.select(
        "doc.doc_id", "doc.n_words", "doc.n_base", "doc.first_word", "doc.last_word",
        F.array_join(F.array_sort("doc.base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("doc.base_labels", "more")), ",").alias("labels"),
        F.least(F.lit(1.0), F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("doc.n_base") > 0, 0.5).otherwise(0.0))).alias("score"))
