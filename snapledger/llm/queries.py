"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
import public_tokenizers

from snapledger.llm import alignment, embeddings, fingerprint, language, license_scan, minhash, mixing, packing, pii, secret_scan, spans, substrings, toxicity, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _span_digest(found: DataFrame, base: tuple[str, ...], kinds: tuple[str, ...]) -> DataFrame:
    return found.select(
        "doc_id", *(spans.count_of("found", k).alias(f"n_{k}") for k in base),
        F.sha2(spans.listed("found", base), 256).alias("base_sha256"), spans.listed("found", kinds).alias("spans"),
        spans.scores("found", kinds).alias("scores"),
    )


@query
def op1_secrets(spark, folder):
    """Secrets in every document."""
    return _span_digest(secret_scan.find_secrets(table(spark, folder, "documents")), secret_scan.BASE_KINDS, secret_scan.KINDS)


@query
def op6_pii(spark, folder):
    """Personal data in every document."""
    return _span_digest(pii.find_pii(table(spark, folder, "documents")), pii.BASE_KINDS, pii.KINDS)


@query
def op9_packing(spark, folder):
    """All documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_language(spark, folder):
    """The language of every document."""
    return language.identify(table(spark, folder, "documents"))


@query
def op10_toxicity(spark, folder):
    """How likely every document is toxic."""
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_licenses(spark, folder):
    """Licences of every document."""
    return license_scan.find_licences(table(spark, folder, "documents"))


@query
def op5_mixing(spark, folder):
    """Words that the mix takes from every document."""
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLE["op5_mixing"] = mixing.SQL


@query
def op3_minhash(spark, folder):
    """Near duplicates among all documents."""
    return minhash.link_documents(table(spark, folder, "documents"), words=4)


ORACLE["op3_minhash"] = minhash.SQL


@query
def op4_fingerprints(spark, folder):
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint.fingerprint_documents(table(spark, folder, "documents"))


@query
def op8_embeddings(spark, folder):
    """Near duplicates among all embeddings."""
    return embeddings.link_embeddings(table(spark, folder, "embeddings"))


ORACLE["op8_embeddings"] = embeddings.SQL


@query
def op13_spelling(spark, folder):
    """Spelling variants among the words of all documents."""
    return variants.group_variants(table(spark, folder, "documents"))


ORACLE["op13_spelling"] = variants.SQL


@query
def op12_alignment(spark, folder):
    """Two tokenizers aligned over all documents."""
    return alignment.align(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_substrings(spark, folder):
    """Passages that repeat across or within documents, removed."""
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op11_substrings"] = substrings.SQL
