"""A run over one state: what is left to do, the gate, the load and the ledger events it causes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.functions import values
from snapledger.operators import manifest, resolve
from snapledger.operators.groupwise import lookup
from snapledger.plans import rolls, warehouse
from snapledger.session import cut
from snapledger.sources import sinks

STAMPED = ["status", "stage", "error", "reconciles", "elector_count", "archive_uri"]


def ledger(jobs: DataFrame, events: DataFrame) -> DataFrame:
    """Jobs with their latest status and stage; '' in an error clears it."""
    return manifest.apply_events(jobs, events, schemas.JOB_KEY, ["seq"], STAMPED, ["error"])


def state_code(spark: SparkSession, states: DataFrame, asked: str) -> DataFrame:
    """One row with the code for a state name or code (null when unknown)."""
    return resolve.name_to_code(spark.createDataFrame([(asked,)], "asked string"), states, "asked").select("resolved_cd")


def todo(jobs: DataFrame, state_cd: str, areas: list[int] | None = None, force: bool = False) -> DataFrame:
    """Ready documents of a state that are not done yet, in area and part order."""
    ready = manifest.resume_set(jobs.filter(F.col("state_cd") == state_cd), force=force)
    if areas is not None:
        ready = ready.filter(F.col("ac_no").isin(areas))
    return ready.orderBy("ac_no", "part_no")


def run_state(
    spark: SparkSession, root: str, batch: int, jobs: DataFrame, payloads: DataFrame, summary: DataFrame,
    cover: DataFrame, eras: DataFrame, require_reconcile: bool = False, archive: bool = True,
) -> DataFrame:
    """Assembles, gates and loads the documents of ``jobs`` (with ``roll_id``); returns their new events.

    The caller appends the events to the ledger after the load: a run that dies before leaves its
    documents ready, and repeating the batch replaces only its own rows.
    """
    context = jobs.select(
        "roll_id", F.col("language").alias("language_code"), "state_cd", "ac_no", "part_no", "roll_type",
        F.col("file_name").alias("source_pdf_filename"), F.col("pdf_sha256").alias("source_pdf_sha256"),
    )
    wanted = context.select("roll_id")
    keep = lambda df: df.join(wanted, "roll_id", "left_semi")
    result = rolls.run_rolls(context, keep(payloads), keep(summary), keep(cover))
    verdicts = result.recon.select("roll_id", "reconciles", F.col("cards_printed").cast("int").alias("elector_count"))
    known = lookup(jobs, verdicts, ["roll_id"], ["reconciles", "elector_count"])
    gated = cut(manifest.qc_gate(known, required=require_reconcile))
    accepted = gated.filter("gate <> 'rejected'").select("roll_id")
    allowed = lambda df: df.join(accepted, "roll_id", "left_semi")
    warehouse.load(
        spark, root, batch,
        result._replace(context=allowed(result.context), electors=allowed(result.electors), summary=allowed(result.summary)),
        cover, eras,
    )
    uri = values.storage_key("state_cd", "ac_no", "file_name")
    passed = F.col("gate") != "rejected"
    def step(stage: str, error: str | None = None, archived=None):
        no_uri = F.lit(None).cast("string")
        return F.struct(
            F.lit(stage).alias("stage"), F.lit(error).cast("string").alias("error"),
            (no_uri if archived is None else archived).alias("archive_uri"),
        )

    steps = F.array_compact(
        F.array(
            step("extracted", ""),
            F.when(~passed, step("failed", "reconcile failed")),
            F.when(passed, step("loaded")),
            F.when(passed & F.lit(archive), step("archived", archived=uri)),
            F.when(passed, step("done")),
        )
    )
    events = gated.select(*schemas.JOB_KEY, "reconciles", "elector_count", F.posexplode(steps).alias("step", "s"))
    return events.select(
        (F.lit(batch).cast("bigint") * 10 + F.col("step")).alias("seq"), *schemas.JOB_KEY, F.lit("stage").alias("event"),
        F.lit(None).cast("string").alias("status"), "s.stage", "s.error", "reconciles", "elector_count", "s.archive_uri",
    )


def append_events(events: DataFrame, root: str, batch: int) -> None:
    sinks.write_table(events, root, "job_events", batch)


def read_events(spark: SparkSession, root: str) -> DataFrame:
    return sinks.read_table(spark, root, "job_events", schemas.JOB_EVENTS).drop("batch")
