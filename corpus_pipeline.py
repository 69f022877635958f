"""A training corpus in five stages, each written as Parquet and read again by the next.

``run(spark, sf_dir)`` applies STAGES to ``documents``. Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of documents. Extra columns are left out; an empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm import language, members, minhash, mixing, packing, pii
from snapledger.llm.storage import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Below this posterior a text's language is not accepted.
LEAST_LANGUAGE = 0.5
#: Near duplicates: word shingles of this width with a similarity of so many percent.
SHINGLE, PERCENT = 5, 80
TOKENIZER = "byte_bpe_50k.json"
#: Between the last character of a word and white space.
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, with it as their ``lang``; texts that are null or without letters go."""
    docs = docs.select(*COLUMNS)
    found = docs.withColumn("found", language.predicted(docs))
    kept = found.where((F.col("found.lang_pred") != language.UNKNOWN) & (F.col("found.score") >= LEAST_LANGUAGE))
    return kept.select("doc_id", "text", F.col("found.lang_pred").alias("lang"), "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest id.

    Rows of one id and one text are one document; of the texts under one id, those kept are the ones that their group keeps;
    rows with a null id are kept where their group has no other id, once for each text.
    """
    docs = docs.select(*COLUMNS)
    found = minhash.link_documents(docs, words=SHINGLE, percent=PERCENT)
    # ids of which other than one row is kept; most texts surely have another id and stay where they are
    odd = stored(found.groupBy(F.col("doc_id").alias("id")).agg(F.count_if("kept").alias("n")).where("n != 1"))
    maybe, others = members.divided(docs, "doc_id", odd.select("id"))
    same, repeated = F.col("doc_id").eqNullSafe(F.col("id")), odd.where("n > 1")
    once = others.unionByName(maybe.join(odd, same, "left_anti"))
    if repeated.isEmpty():
        return once
    return once.unionByName(maybe.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by placeholders."""
    masked = docs.select(*COLUMNS).withColumn("text", pii.masked(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _head(text: Column, words: Column) -> Column:
    """A text up to the end of so many words: cut at word ends, white space as it is."""
    return F.array_join(F.slice(F.split(text, WORD_END, words + 1), F.lit(1), words), "")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: repeated for complete epochs, left out where it takes none.

    Where a source's budget ends within a document, its text up to the end of its last word taken stands for it, white space as
    it is. The mix is found without texts; they meet it once, under a hash of the whole row. Equal rows are one document that
    is taken as often as all of them together.
    """
    row = F.md5(F.concat_ws("|", *(F.coalesce(F.md5(F.col(c).cast("string")), F.lit("")) for c in COLUMNS)))
    named = docs.select(*COLUMNS, row.alias("row"))
    rows = stored(mixing.measured(named, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=("row",)))
    found = mixing.taken(rows, mixing.planned(rows)).where("taken > 0")
    copies, part = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    mixed = stored(found.groupBy("kept.row").agg(F.sum(copies).cast("int").alias("copies"), F.max(part).alias("part"), F.count("*").alias("n")))
    repeated = mixed.where("n > 1")
    met = named.join(mixed.where("n = 1"), "row")
    if not repeated.isEmpty():
        met = met.unionByName(named.join(repeated, "row").dropDuplicates(["row"]))
    words = F.concat(F.array_repeat(F.lit(0), F.col("copies")), F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<int>")))
    taken = met.withColumn("words", F.explode(words))
    whole = F.col("words") == 0
    text = F.when(whole, F.col("text")).otherwise(_head(F.col("text"), F.col("words")))
    return taken.select("doc_id", text.alias("text"), "lang", "source", F.when(whole, F.col("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as pieces of sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: Models and hashes have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; the last one's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
