"""The tables of the manifest, kept as versions: what was found of areas, which crawls ran, what there is to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.sources.versions import Versions

# The manifest's tables. name -> (columns, keys, columns that keep their first value, columns that keep their
# last value that isn't null); the others take their last value.
TABLES: dict[str, tuple[str, tuple[str, ...], tuple[str, ...], tuple[str, ...]]] = {
    "state": ("state_cd string, state_name string, state_type string, raw string, fetched_at timestamp", ("state_cd",), (), ()),
    "district": ("state_cd string, district_cd string, district_name string, raw string, fetched_at timestamp", ("state_cd", "district_cd"), (), ()),
    "ac": (
        "state_cd string, ac_no int, ac_name string, ac_id string, district_cd string, category string, raw string, fetched_at timestamp",
        ("state_cd", "ac_no"), (), (),
    ),
    "crawl_log": ("scope string, status string, count int, error string, updated_at timestamp", ("scope",), (), ()),
    "ac_availability": (
        "state_cd string, ac_no int, years array<int>, roll_types array<string>, languages array<string>, parts_count int, updated_at timestamp",
        ("state_cd", "ac_no"), (), (),
    ),
    "download_job": (
        "state_cd string, district_cd string, ac_no int, year int, roll_type string, language string, part_no int, station_name string, "
        "status string, attempts int, last_error string, expected_count int, pdf_sha256 string, file_path string, bytes bigint, "
        "page_count int, created_at timestamp, updated_at timestamp",
        ("state_cd", "ac_no", "year", "roll_type", "language", "part_no"), ("created_at",),
        ("district_cd", "station_name", "status", "attempts", "last_error", "expected_count", "pdf_sha256", "file_path", "bytes", "page_count", "updated_at"),
    ),
}


def table(spark: SparkSession, root: str, name: str) -> Versions:
    schema, keys, first, filled = TABLES[name]
    names = [f.strip().split(" ")[0] for f in schema.split(", ")]
    last = [c for c in names if c not in (*keys, *first, *filled)]
    return Versions(spark, f"{root}/{name}", schema, keys, last=last, first=first, last_filled=filled)


def write(spark: SparkSession, root: str, version: int, rows: dict[str, DataFrame]) -> None:
    """What a run found, a version of each table given; a replay of the run replaces it."""
    for name, df in rows.items():
        found = table(spark, root, name)
        have = set(df.columns)
        found.write(df.selectExpr(*[c if c in have else f"cast(null as {f.dataType.simpleString()}) as {c}" for f in found.schema.fields for c in (f.name,)]), version)


def read(spark: SparkSession, root: str, name: str, as_of: int | None = None) -> DataFrame:
    """A table as it was after a version; the last one unless given."""
    return table(spark, root, name).read(as_of)


def compact(spark: SparkSession, root: str, upto: int | None = None, keep_from: int | None = None) -> None:
    for name in TABLES:
        table(spark, root, name).compact(upto, keep_from)
