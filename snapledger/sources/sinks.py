"""Append-only tables in a shared folder, made visible by a commit.

Every load has a batch number. Rows carry it, a replayed batch replaces only its own rows, and
readers see a document through the last batch that committed it: a load that dies half way is
never visible, and a document is never half replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.operators.groupwise import dealt, lookup
from snapledger.operators.merge import upsert

AREA = ("state_cd", "ac_no")
COMMITS = "_commits"


def write_table(df: DataFrame, root: str, table: str, batch: int, partition: Sequence[str] = ()) -> None:
    """The rows of one batch, in place of all that the batch held before, also if there are none now.

    A table laid out by ``partition`` is rebalanced by it, which gives few files of even size and splits a huge partition; all
    others are written as they come, since a shuffle of whole rows would only even out files.
    """
    (
        (df.hint("rebalance", *partition) if partition else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition)
        .parquet(f"{root}/{table}/batch={batch}")
    )


def write_batch(root: str, batch: int, rolls: DataFrame, facts: dict[str, DataFrame], plain: dict[str, DataFrame]) -> None:
    """All tables of a batch, then its commit. ``facts`` are laid out by area.

    A replay withdraws the batch's commit first, so that no reader sees it half replaced.
    """
    done = rolls.select("roll_id").distinct()
    write_table(done.limit(0), root, COMMITS, batch)
    for table, df in facts.items():
        write_table(df, root, table, batch, AREA)
    for table, df in plain.items():
        write_table(df, root, table, batch)
    write_table(done, root, COMMITS, batch)


def read_table(spark: SparkSession, root: str, table: str, schema: str | None = None) -> DataFrame:
    """All rows of a table with their ``batch``, committed or not; a table that was never written has none.

    ``schema``: the declared one of the warehouse unless given, so that empty tables and partition values keep their types.
    """
    declared = f"{schema or schemas.WAREHOUSE[table]}, batch int"
    try:
        found = spark.read.schema(declared).parquet(f"{root}/{table}")
        return found.select(*found.columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], declared)


def commits(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """(roll_id, batch) of all commits, ``roll_id`` typed as in ``like``."""
    return read_table(spark, root, COMMITS, f"roll_id {like.schema['roll_id'].dataType.simpleString()}")


def read_facts(spark: SparkSession, root: str, table: str, schema: str | None = None, keep_batch: bool = False) -> DataFrame:
    """Rows of committed documents, each from its last batch; area filters prune folders."""
    rows = read_table(spark, root, table, schema)
    last = commits(spark, root, rows).groupBy("roll_id").agg(F.max("batch").alias("batch"))
    found = rows.join(dealt(last), ["roll_id", "batch"], "left_semi")
    return found if keep_batch else found.drop("batch")


def read_rows(spark: SparkSession, root: str, table: str, before: int | None = None) -> DataFrame:
    """Rows of all committed batches (of those before ``before``, for a load that may be a replay)."""
    batches, rows = read_table(spark, root, COMMITS, "roll_id string"), read_table(spark, root, table)
    if before is not None:
        batches, rows = batches.filter(F.col("batch") < before), rows.filter(F.col("batch") < before)
    return rows.join(batches.select("batch").distinct(), "batch", "left_semi").drop("batch")


# dimension -> (keys, columns whose last value counts, columns whose first value stays)
DIMENSIONS: dict[str, tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]] = {
    "state": (("state_cd",), ("state_name",), ()),
    "district": (("state_cd", "district_name"), (), ("district_cd",)),
    "parliamentary_constituency": (("state_cd", "pc_no"), ("pc_name",), ()),
    "assembly_constituency": (
        ("state_cd", "era_name", "ac_no"), ("ac_name",), ("district_name", "pc_no", "reservation_status"),
    ),
    "part": (
        ("state_cd", "era_name", "ac_no", "part_no"), (),
        ("main_town_or_village", "post_office", "police_station", "tehsil_mandal", "block", "taluk", "pin_code",
         "polling_station_no", "polling_station_name", "polling_station_address", "polling_station_type",
         "num_auxiliary_stations"),
    ),
    "section": (("state_cd", "era_name", "ac_no", "part_no", "section_no"), (), ("section_name",)),
}


def read_dimension(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A dimension folded from all committed batches under its column policy."""
    keys, last, first = DIMENSIONS[table]
    rows = read_table(spark, root, table)
    rows = rows.join(dealt(commits(spark, root, rows)), ["roll_id", "batch"], "left_semi")
    if not last and not first:
        return rows.select(*keys).distinct()
    return upsert(rows, keys, F.struct("batch", "roll_id"), last=last, first=first)


def result_documents(context: DataFrame, summary: DataFrame, recon: DataFrame, electors: DataFrame) -> DataFrame:
    """The lines of each roll's document, alike for rolls of any size.

    One line ``roll`` with context, summary and recon, and one line ``elector`` for each elector; so no task holds a whole roll.
    """
    struct = lambda df: F.struct(*[c for c in df.columns if c != "roll_id"])
    heads = context.select("roll_id", F.lit("roll").alias("line"), F.lit(None).cast(electors.schema["serial_no"].dataType).alias("serial_no"),
                           struct(context).alias("context"))
    heads = lookup(heads, summary.select("roll_id", struct(summary).alias("summary")), ["roll_id"], ["summary"])
    heads = lookup(heads, recon.select("roll_id", struct(recon).alias("recon")), ["roll_id"], ["recon"])
    cards = [c for c in electors.columns if c not in ("roll_id", "serial_no")]
    lines = electors.select("roll_id", F.lit("elector").alias("line"), "serial_no", F.struct(*cards).alias("elector"))
    return heads.unionByName(lines, allowMissingColumns=True)


def write_documents(documents: DataFrame, path: str) -> None:
    """JSON lines in the order of rolls, each roll's own line first, then its electors by serial; a huge roll spans files."""
    order = [F.col("roll_id"), F.col("line").desc(), F.col("serial_no").asc_nulls_last()]
    documents.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").json(path)
