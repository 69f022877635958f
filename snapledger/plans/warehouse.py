"""A batch of documents -> geography, snapshot, checksum and identity tables.

Numbers of areas, parts and sections are those of an era, the regime of boundaries that a document was published under. So the
era is part of their keys; what is one area on the ground under two eras is two rows, and lineage tells of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.functions import values
from snapledger.functions.text import as_col, filled
from snapledger.operators import identity, lineage as lineages, reconcile, resolve
from snapledger.operators.groupwise import dealt, lookup
from snapledger.plans.rolls import RollBatch
from snapledger.session import cut, scratch
from snapledger.sources import sinks

#: The era of documents that fall into none of the eras given; their areas stay apart from all others.
NO_ERA = "none"
PART = ("state_cd", "era_name", "ac_no", "part_no")

COVER_COLUMNS = [f.strip().split(" ")[0] for f in schemas.COVER_PAYLOAD.replace("<section_no:int,section_name:string>", "").split(", ")]


def placed(context: DataFrame, cover: DataFrame) -> DataFrame:
    """Documents with their place: default chains over context, cover and fixed names."""
    side = cover.select("roll_id", *[F.col(c).alias(f"c_{c}") for c in COVER_COLUMNS])
    docs = lookup(context, side, ["roll_id"], [f"c_{c}" for c in COVER_COLUMNS], grows=True)
    code = F.coalesce(F.nullif("state_cd", F.lit("")), F.lit("S00"))
    zero = lambda c: F.nullif(as_col(c), F.lit(0))
    ac_no = F.coalesce(zero("ac_no"), zero("c_ac_no"))
    docs = docs.withColumns(
        {
            "state_cd": code,
            "state_name": F.coalesce(filled("c_state_name"), values.state_name(code), code),
            "__ac": ac_no,
            "ac_no": F.coalesce(ac_no, F.lit(0)),
            "part_no": F.coalesce(zero("part_no"), zero("c_part_no"), F.lit(1)),
            "roll_type": F.coalesce(F.nullif("roll_type", F.lit("")), F.lit("FinalRoll")),
            "language_code": F.coalesce(F.nullif("language_code", F.lit("")), F.lit("ENG")),
            "district_name": F.coalesce(filled("c_district_name"), F.lit("UNKNOWN")),
            "pc_no": F.when(F.col("c_pc_no") >= 1, F.col("c_pc_no")),
            "pc_name": F.coalesce(filled("c_pc_name"), F.lit("UNKNOWN")),
        }
    )
    return docs.withColumn(
        "ac_name", F.coalesce(filled("c_ac_name"), F.concat(F.lit("AC "), F.col("__ac").cast("string")), F.lit("AC UNKNOWN"))
    ).drop("__ac")


def dated(docs: DataFrame, eras: DataFrame) -> DataFrame:
    """Documents with their dates and the era that their publication (else qualifying date, else revision year) falls in."""
    docs = docs.withColumns(
        {
            "qualifying_date": values.iso_date("c_qualifying_date"),
            "date_of_publication": values.iso_date("c_date_of_publication"),
            "date_of_updation": values.iso_date("c_date_of_updation"),
            "year_of_revision": F.coalesce("c_year_of_revision", F.lit(0)),
        }
    )
    year_start = F.when(F.col("year_of_revision") > 0, F.make_date("year_of_revision", F.lit(1), F.lit(1)))
    docs = docs.withColumn("__at", F.coalesce("date_of_publication", "qualifying_date", year_start))
    return resolve.era_of(docs, eras, "__at").drop("__at").withColumn("era_name", F.coalesce("era_name", F.lit(NO_ERA)))


def geography(docs: DataFrame) -> dict[str, DataFrame]:
    """Rows that a batch contributes to each dimension (folded by policy when read)."""
    part = list(PART)
    sections = resolve.section_rows(docs.withColumn("sections", F.col("c_sections")), ["roll_id", *part])
    cover = lambda c: F.col(f"c_{c}").alias(c)
    return {
        "state": docs.select("roll_id", "state_cd", "state_name"),
        "district": docs.select("roll_id", "state_cd", "district_name", _given(docs, "district_cd", "string")),
        "parliamentary_constituency": docs.filter("pc_no is not null").select("roll_id", "state_cd", "pc_no", "pc_name"),
        "assembly_constituency": docs.select(
            "roll_id", "state_cd", "era_name", "ac_no", "ac_name", "district_name", "pc_no",
            values.reservation("c_ac_reservation").alias("reservation_status"),
        ),
        "part": docs.select(
            "roll_id", *part, *[cover(c) for c in ("main_town_or_village", "post_office", "police_station",
                                                  "tehsil_mandal", "block", "taluk", "pin_code", "polling_station_no",
                                                  "polling_station_name", "polling_station_address")],
            values.station_type("c_polling_station_type").alias("polling_station_type"),
            F.coalesce("c_num_auxiliary_stations", F.lit(0)).alias("num_auxiliary_stations"),
        ),
        "section": sections,
    }


def _given(docs: DataFrame, name: str, kind: str):
    """A column that the context may lack."""
    return (F.col(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)


def roll_rows(docs: DataFrame, revision_no: int | None = 1) -> DataFrame:
    """The rows of ``dated`` documents."""
    return docs.select(
        "roll_id", *PART, F.concat_ws("/", *PART).alias("part_id"), "year_of_revision", "qualifying_date", F.col("c_type_of_revision").alias("type_of_revision"), "date_of_publication",
        "date_of_updation", F.col("c_roll_identification").alias("roll_identification"), "roll_type",
        F.lit(revision_no).cast("int").alias("revision_no"), "language_code", _given(docs, "total_pages", "int"),
        "source_pdf_filename", "source_pdf_sha256",
    )


def load(
    spark: SparkSession, root: str, batch: int, result: RollBatch, cover: DataFrame, eras: DataFrame,
    summary_rows: DataFrame | None = None, lineage: DataFrame | None = None, fuzzy: bool = False,
) -> None:
    """Writes all tables of a batch and commits its documents. Re-running a batch replaces what it wrote.

    ``eras`` don't overlap. ``summary_rows``: the component rows of printed totals, ``lineage``: edges between areas of two
    eras, both by the declared columns. The context may also bring ``district_cd`` and ``total_pages``, entries ``marker_box``. With
    ``fuzzy``, entries without a key are placed with persons of their area who were known before the batch, where they match.
    """
    with scratch(spark):
        _write(spark, root, batch, result, cover, eras, summary_rows, lineage, fuzzy)


def _write(spark, root, batch, result, cover, eras, summary_rows, lineage, fuzzy) -> None:
    docs = cut(dated(placed(result.context, cover), eras))
    rolls = roll_rows(docs)
    area = docs.select("roll_id", *PART)
    flagged = resolve.has_supplement(result.summary, result.electors)
    # what is looked up by document follows in one plan: entries are dealt by document once
    linked = lookup(resolve.supplement_link(result.electors, flagged), area, ["roll_id"], list(PART), grows=True)
    listed = geography(docs)
    place = list(PART)
    known = listed["section"].unionByName(sinks.read_rows(spark, root, "section", batch)).select(*place, "section_no")
    # written, so that its size is known before entries would be dealt for it
    known = cut(known.distinct().withColumn("__known", F.lit(True)))
    linked = lookup(linked, known, [*place, "section_no"], ["__known"])
    electors = cut(linked.select(
        "roll_id", *PART, F.when(F.col("__known"), F.col("section_no")).alias("section_no"),
        "serial_no", "epic_no", F.coalesce(F.nullif("full_name", F.lit("")), F.lit("UNKNOWN")).alias("full_name"),
        "relation_type", "relation_name", "house_number", "age", "gender", F.lit(True).alias("photo_present"),
        F.coalesce("status", F.lit("active")).alias("entry_status"), "deletion_reason_code",
        F.col("linked_supplement_no").alias("supplement_no"),
        F.nullif(_given(linked, "marker_box", "string"), F.lit("")).alias("modification_marker_raw"),
        "source_page", "confidence", "flags",
    ))
    read = electors.filter("supplement_no is not null").select("roll_id", "supplement_no").distinct()
    # a change that only the totals tell of is taken to be of supplement 1, and marked
    unread = flagged.filter("has_supplement").join(dealt(read), "roll_id", "left_anti").select("roll_id", F.lit(1).alias("supplement_no"))
    read, unread = read.withColumn("inferred", F.lit(False)), unread.withColumn("inferred", F.lit(True))
    supplements = lookup(
        read.unionByName(unread), docs.withColumnRenamed("c_type_of_revision", "type_of_revision"), ["roll_id"], ["type_of_revision"], grows=True,
    ).select("roll_id", "supplement_no", "type_of_revision", "inferred")
    counts = ["starting_serial_no", "ending_serial_no", "net_male", "net_female", "net_third_gender", "net_total"]
    # the sequence of a document is its batch, then its id: what tier-1 identity calls "first"; here the batch is one
    earlier = sinks.read_rows(spark, root, "person_epic", batch)
    persons = cut(identity.new_keys(electors, earlier, seq="roll_id"))
    fresh = persons.drop("canonical_name")
    sinks.write_batch(
        root, batch, docs,
        facts={"roll": rolls, "elector": electors},
        plain={
            **listed,
            "supplement": supplements,
            "summary": result.summary,
            "summary_row": _declared(spark, "summary_row", summary_rows).join(dealt(docs.select("roll_id")), "roll_id", "left_semi"),
            "ac_lineage": _declared(spark, "ac_lineage", lineage),
            "cover_count": docs.select("roll_id", *[F.col(f"c_{c}").alias(c) for c in counts]),
            "person": persons.drop("first_roll_id"),
            "person_epic": fresh,
            "placement": identity.place(electors, earlier.unionByName(fresh)),
            "placement_fuzzy": _tier2(spark, root, batch, electors) if fuzzy else _declared(spark, "placement_fuzzy", None),
        },
    )


def _declared(spark: SparkSession, table: str, df: DataFrame | None) -> DataFrame:
    """``df`` in the declared columns of ``table``; none: no rows."""
    empty = spark.createDataFrame([], schemas.WAREHOUSE[table])
    return empty if df is None else df.select(*[F.col(f.name).cast(f.dataType) for f in empty.schema.fields])


def areas(spark: SparkSession, root: str, eras: list[str]) -> DataFrame:
    """Areas of all eras, those first told of by lineage included, with what they inherit where their own documents are silent.

    ``eras``: the names in the order of time; few, one for each redrawing of boundaries.
    """
    rows = sinks.read_dimension(spark, root, "assembly_constituency")
    edges = sinks.read_rows(spark, root, "ac_lineage").distinct()
    return lineages.inherit(rows, edges, ["state_cd", "era_name", "ac_no"], "era_name", eras, ["district_name", "pc_no", "reservation_status"])


def _tier2(spark: SparkSession, root: str, batch: int, electors: DataFrame) -> DataFrame:
    """Placements of the batch's entries without a key, by the last profile of each person known before it."""
    held = sinks.read_rows(spark, root, "placement", batch).select("person_id", "roll_id", "serial_no")
    fields = {"name": "full_name", "relation": "relation_name", "house": "house_number", "age": "age"}
    block = ["state_cd", "ac_no"]
    earlier = sinks.read_table(spark, root, "elector").filter(F.col("batch") < batch)
    seen = earlier.join(held, ["roll_id", "serial_no"]).select("person_id", *block, *fields.values(), F.struct("batch", "roll_id", "serial_no").alias("at"))
    persons = seen.groupBy("person_id").agg(F.max_by(F.struct(*block, *fields.values()), "at").alias("p")).select("person_id", "p.*")
    named = electors.filter("epic_no is null and full_name <> 'UNKNOWN'")
    return identity.place_fuzzy(named, persons, block, fields).select("person_id", "roll_id", F.col("serial_no").cast("int").alias("serial_no"), "match_method", "match_confidence")


def register_views(spark: SparkSession, root: str) -> None:
    """The two analyst views over the committed tables, for ``spark.sql``."""
    fact = lambda t: sinks.read_facts(spark, root, t)
    rolls, electors = fact("roll"), fact("elector")
    reconcile.roll_reconciliation(rolls, electors, fact("summary"), fact("cover_count")).createOrReplaceTempView(
        "v_roll_reconciliation"
    )
    persons = sinks.read_rows(spark, root, "person")
    written = lambda t: sinks.read_table(spark, root, t)
    dated = sinks.read_facts(spark, root, "roll", keep_batch=True)
    placements = written("placement").unionByName(written("placement_fuzzy"))
    identity.latest_current(persons, placements, written("elector"), dated).createOrReplaceTempView("v_person_current")
