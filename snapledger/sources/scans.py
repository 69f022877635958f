"""Reading sources with declared schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.functions import fixed
from snapledger.functions.text import strip


def picked(raw: Column, *keys: str) -> Column:
    """First key of a raw JSON record whose value is present, non-null and not ''."""
    return F.coalesce(*[F.nullif(F.get_json_object(raw, f"$.{k}"), F.lit("")) for k in keys])


def _fields(record: str, keys: dict[str, list[str]]) -> dict[str, Column]:
    return {name: picked(F.col(record), *names) for name, names in keys.items()}


def catalog_states(raw: DataFrame, record: str = "raw") -> DataFrame:
    """State records with varying key names -> typed rows; the raw record is kept."""
    f = _fields(record, fixed.CATALOG_STATE)
    f["state_name"] = F.coalesce(f["state_name"], F.lit(fixed.UNNAMED))
    return raw.select(*[c.alias(n) for n, c in f.items()], F.col(record).alias("raw"))


def catalog_districts(raw: DataFrame, record: str = "raw") -> DataFrame:
    f = _fields(record, fixed.CATALOG_DISTRICT)
    f["district_name"] = F.coalesce(f["district_name"], F.lit(fixed.UNNAMED))
    return raw.select("state_cd", *[c.alias(n) for n, c in f.items()], F.col(record).alias("raw"))


def catalog_areas(raw: DataFrame, record: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(area rows, records without a usable number)."""
    f = _fields(record, fixed.CATALOG_AREA)
    f["ac_no"] = f["ac_no"].try_cast("int")
    f["ac_id"] = F.coalesce(f["ac_id"], F.lit(""))
    rows = raw.select("state_cd", *[c.alias(n) for n, c in f.items()], F.col(record).alias("raw"))
    return rows.filter("ac_no is not null"), rows.filter("ac_no is null")


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """One JSON record per line, as text in ``raw`` (key names vary, so no schema fits)."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def read_files(spark: SparkSession, path: str, glob: str = "*", with_content: bool = True) -> DataFrame:
    """Documents as binary, with size and content hash.

    Drop ``content`` right after the verdict: the hash and the flags are all that later steps
    need, and the bytes then never enter a shuffle.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    hashed = files.withColumn("sha256", F.sha2("content", 256))
    return hashed if with_content else hashed.drop("content")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Labelled samples, one JSON record per line."""
    return spark.read.schema(schemas.SAMPLES).json(path)


def read_labels(
    spark: SparkSession, path: str, pattern: str = "^[a-z0-9]{6}$", columns: Sequence[str] = ("file", "label")
) -> tuple[DataFrame, DataFrame]:
    """CSV of (file, label) -> (valid rows, rejected rows). Header and blank lines are neither."""
    file, label = columns
    rows = spark.read.schema(f"{file} string, {label} string").option("mode", "PERMISSIVE").csv(path)
    rows = rows.select(strip(file).alias(file), F.lower(strip(label)).alias(label))
    rows = rows.filter(F.col(file).isNotNull() & (F.lower(F.col(file)) != "file"))
    good = F.coalesce(F.col(label).rlike(pattern), F.lit(False))
    return rows.filter(good), rows.filter(~good)


def read_tokens(spark: SparkSession, path: str, engine: str | None = None) -> DataFrame:
    """Token table; the engine filter reaches the parquet scan."""
    tokens = spark.read.schema(schemas.TOKENS).parquet(path)
    return tokens if engine is None else tokens.filter(F.col("engine") == engine)


def reasons(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.REASONS.items()), "code string, description string")


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.STATE_NAMES.items()), "state_cd string, state_name string")


def eras(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(fixed.ERAS, "era_name string, f string, t string")
    return rows.select("era_name", F.to_date("f").alias("effective_from"), F.to_date("t").alias("effective_to"))


def from_payload(pages: DataFrame, fields: str, payload: str = "payload") -> DataFrame:
    """JSON text of summary or cover pages -> typed columns next to the page's keys.

    ``fields`` is one of the ``*_PAYLOAD`` shapes; text that is no JSON gives nulls.
    """
    keys = [c for c in pages.columns if c != payload]
    return pages.withColumn("__p", F.from_json(F.col(payload), fields)).select(*keys, "__p.*")
