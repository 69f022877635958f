"""Sources, sinks, the state run, streams and the extractor hook."""

import json

import pytest
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.operators import identity, manifest, quality
from snapledger.plans import batches, constraints, rolls, warehouse
from snapledger.sources import extractors, scans, sinks
from snapledger.sources.versions import Versions
from snapledger.streaming import ledger as stream
from tests import fixtures as fx


def test_files(spark, tmp_path):
    for name, body in {"a": b"%PDF-1.4 x\n%%EOF\n", "b": b"<html>", "c": b"%PDF-1.4 cut", "d": b"%PDF-" + b"%%EOF" + b" " * 2000}.items():
        (tmp_path / f"{name}.pdf").write_bytes(body)
    files = scans.read_files(spark, str(tmp_path), "*.pdf").withColumn("name", F.regexp_extract("path", r"(\w)\.pdf$", 1))
    pages = F.when(F.col("name") == "a", 3)
    got = {r.name: r.v for r in files.select("name", quality.file_verdict(F.col("content"), pages).alias("v")).collect()}
    assert got == {"a": "ok", "b": "bad_header", "c": "truncated", "d": "truncated"}
    none = files.select(quality.file_verdict(F.lit(None).cast("binary"), F.lit(1)).alias("v")).first().v
    assert none == "missing"
    assert files.filter("name = 'a'").select(quality.file_verdict(F.col("content"), F.lit(0)).alias("v")).first().v == "unreadable"


def test_labels_and_samples(spark, tmp_path):
    (tmp_path / "l.csv").write_text("file,label\n\na.png, AB12cd \nb.png,short\nc.png,abc-12\n")
    good, bad = scans.read_labels(spark, str(tmp_path / "l.csv"))
    assert [tuple(r) for r in good.collect()] == [("a.png", "ab12cd")] and bad.count() == 2
    (tmp_path / "s.jsonl").write_text('{"crop":"c1","uncertain":false,"age":3}\n{"crop":"c2","flag":"x","uncertain":true}\n')
    assert [(r.crop, r.flag, r.age) for r in scans.read_samples(spark, str(tmp_path / "s.jsonl")).orderBy("crop").collect()] == [("c1", None, 3), ("c2", "x", None)]


def test_catalog(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"stateCd":"S01","stateNameEn":"Foo"}\n{"stateCd":"S02","stateName":""}\n')
    got = {r.state_cd: r.state_name for r in scans.catalog_states(scans.read_json_records(spark, str(tmp_path / "r.json"))).collect()}
    assert got == {"S01": "Foo", "S02": "(unknown)"}
    raw = spark.createDataFrame([("S01", '{"districtCode":"d","districtName":"N"}')], "state_cd string, raw string")
    assert tuple(scans.catalog_districts(raw).first())[:3] == ("S01", "d", "N")
    assert scans.states(spark).count() == 36 and scans.reasons(spark).count() == 5 and scans.eras(spark).count() == 1


COVER = "roll_id string, " + schemas.COVER_PAYLOAD


def cover(spark, rolls_=("r1", "r2"), **kw):
    base = {"state_name": "Foo", "ac_no": 7, "ac_name": "North", "ac_reservation": "SCHEDULED TRIBE", "pc_no": 3, "pc_name": "West",
            "date_of_publication": "01-02-2026", "year_of_revision": 2026, "net_total": 6, "block": "B",
            "sections": [{"section_no": 7, "section_name": "East"}]} | kw
    data = [json.dumps({"roll_id": r} | base) for r in rolls_]
    df = spark.createDataFrame([(d,) for d in data], "j string")
    return df.select(F.from_json("j", COVER).alias("r")).select("r.*")


def jobs(spark, ids=("r1", "r2")):
    data = [(r, "S07", 7, 2026, "FinalRoll", "ENG", i + 1, f"{r}.pdf", f"sha-{r}", "verified", None) for i, r in enumerate(ids)]
    return spark.createDataFrame(data, "roll_id string, state_cd string, ac_no int, year int, roll_type string, language string, part_no int, file_name string, pdf_sha256 string, status string, stage string")


def run(spark, root, batch, ids, summary, **kw):
    payloads = spark.createDataFrame([s for r in ids for s in fx.good_roll(r)], fx.PAYLOADS)
    return batches.run_state(spark, root, batch, jobs(spark, ids), payloads, spark.createDataFrame(summary, fx.SUMMARY),
                             cover(spark, ids), scans.eras(spark), **kw)


def test_state_run(spark, tmp_path, rows):
    root = str(tmp_path / "w")
    good = [fx.good_summary("r1"), fx.good_summary("r2", net_male=9)]
    events = run(spark, root, 1, ("r1", "r2"), good, require_reconcile=True)
    batches.append_events(events, root, 1)
    known = jobs(spark).drop("stage", "status")
    marks = spark.createDataFrame([(0, "S07", 7, 2026, "FinalRoll", "ENG", p, "verified") for p in (1, 2)], "seq bigint, state_cd string, ac_no int, year int, roll_type string, language string, part_no int, status string")
    log = batches.read_events(spark, root).unionByName(marks, allowMissingColumns=True)
    state = {r.roll_id: r for r in batches.ledger(known, log).collect()}
    assert (state["r1"].stage, state["r1"].error, state["r1"].elector_count, state["r1"].archive_uri) == ("done", None, 8, "S07/7/r1.pdf")
    assert (state["r2"].stage, state["r2"].error) == ("failed", "reconcile failed")
    left = batches.todo(batches.ledger(known, log), "S07", [7])
    assert [r.roll_id for r in left.collect()] == ["r2"]
    assert [r.roll_id for r in manifest.clearable(batches.ledger(known, log)).collect()] == ["r1"]

    electors = sinks.read_facts(spark, root, "elector")
    assert electors.count() == 8 and electors.filter("entry_status = 'added' and supplement_no = 2").count() == 2
    assert electors.filter("serial_no = 6").first().section_no == 7
    roll = sinks.read_facts(spark, root, "roll").first()
    assert roll.part_id == "S07/2008 Delimitation/7/1" and roll.era_name == "2008 Delimitation" and str(roll.date_of_publication) == "2026-02-01"
    ac = sinks.read_dimension(spark, root, "assembly_constituency").first()
    assert (ac.ac_name, ac.reservation_status) == ("North", "ST")

    # the same batch again, then a later batch that also loads r2 and renames the area
    before = rows(electors)
    run(spark, root, 1, ("r1", "r2"), good, require_reconcile=True)
    assert rows(sinks.read_facts(spark, root, "elector")) == before
    payloads = spark.createDataFrame(fx.good_roll("r2"), fx.PAYLOADS)
    batches.run_state(spark, root, 2, jobs(spark, ("r1", "r2")).filter("roll_id = 'r2'"), payloads, spark.createDataFrame(good, fx.SUMMARY),
                      cover(spark, ("r2",), ac_name="Renamed", ac_reservation="SC"), scans.eras(spark))
    assert sinks.read_facts(spark, root, "elector").count() == 16
    ac = sinks.read_dimension(spark, root, "assembly_constituency").first()
    assert (ac.ac_name, ac.reservation_status) == ("Renamed", "ST")        # the name is overwritten, the rest keeps its first value
    assert sinks.read_rows(spark, root, "person").count() == 8            # the second roll repeats the keys
    assert sinks.read_facts(spark, root, "placement").count() == 16

    warehouse.register_views(spark, root)
    view = {r.roll_id: r for r in spark.sql("select * from v_roll_reconciliation").collect()}
    assert view["r1"].reconciles and not view["r2"].reconciles
    current = spark.sql("select * from v_person_current").collect()
    assert len(current) == 8 and {r.latest_roll_id for r in current} == {"r2"}
    assert {r.lifecycle_status for r in current} == {"active", "deceased", "shifted_out"}


def test_one_number_in_two_eras_stays_two_areas(spark, tmp_path, rows):
    root, ids = str(tmp_path / "w"), ("r1", "r2", "r3")
    eras = spark.createDataFrame([("old", "2008-02-19", "2026-01-15"), ("new", "2026-01-15", None)], "era_name string, effective_from string, effective_to string")
    eras = eras.withColumns({c: F.col(c).cast("date") for c in ("effective_from", "effective_to")})
    dates = {"r1": "01-01-2026", "r2": "01-02-2026", "r3": None}
    covers = [cover(spark, (r,), date_of_publication=d, year_of_revision=None, ac_reservation="SC" if r == "r1" else None) for r, d in dates.items()]
    context = jobs(spark, ids).select("roll_id", "state_cd", "ac_no", F.lit(1).alias("part_no"), "roll_type", F.col("language").alias("language_code"),
                                      F.col("file_name").alias("source_pdf_filename"), F.col("pdf_sha256").alias("source_pdf_sha256"))
    payloads = spark.createDataFrame([s for r in ids for s in fx.good_roll(r)], fx.PAYLOADS)
    result = rolls.run_rolls(context, payloads, spark.createDataFrame([fx.good_summary(r) for r in ids], fx.SUMMARY))
    lineage = spark.createDataFrame([("S07", "old", 7, "S07", "new", 8, "renumber"), ("S07", "old", 7, "S07", "new", 7, "split")], schemas.WAREHOUSE["ac_lineage"])
    warehouse.load(spark, root, 1, result, covers[0].unionByName(covers[1]).unionByName(covers[2]), eras, lineage=lineage)
    assert rows(sinks.read_facts(spark, root, "roll").select("roll_id", "part_id")) == [("r1", "S07/old/7/1"), ("r2", "S07/new/7/1"), ("r3", "S07/none/7/1")]
    for table, n in (("assembly_constituency", 3), ("part", 3), ("section", 3)):
        assert sinks.read_dimension(spark, root, table).count() == n, table
    assert sinks.read_facts(spark, root, "elector").select("roll_id", "era_name").distinct().count() == 3
    found = {(r.era_name, r.ac_no): r for r in warehouse.areas(spark, root, ["old", "new"]).collect()}
    assert {k: r.reservation_status for k, r in found.items()} == {("old", 7): "SC", ("new", 7): "SC", ("new", 8): "SC", ("none", 7): None}
    assert found["new", 8].ac_name is None                                    # known from lineage only
    tables = {t: sinks.read_dimension(spark, root, t) if t in sinks.DIMENSIONS else sinks.read_table(spark, root, t) for t in schemas.WAREHOUSE}
    broken = {(r.table_name, r.rule): r.violations for r in constraints.audit(tables).collect() if r.violations}
    assert broken == {("ac_lineage", "(state_cd, era_name, ac_no) references (state_cd, era_name, ac_no)"): 1}
    assert sinks.read_facts(spark, root, "elector").filter("serial_no = 3").first().modification_marker_raw == "#"
    assert rows(sinks.read_facts(spark, root, "supplement").select("supplement_no", "inferred").distinct()) == [(1, False), (2, False)]


def test_entries_without_a_key_are_placed_by_their_fields(spark, tmp_path):
    root = str(tmp_path / "w")
    context = jobs(spark).select("roll_id", "state_cd", "ac_no", F.lit(1).alias("part_no"), "roll_type", F.col("language").alias("language_code"),
                                 F.col("file_name").alias("source_pdf_filename"), F.col("pdf_sha256").alias("source_pdf_sha256"))
    named = {1: "Anna Example", 2: "Bert Sample", 3: "Clara Instance"}
    for batch, roll in ((1, "r1"), (2, "r2")):
        cards = [fx.card(n, name, **({} if batch == 1 or n == 3 else {"epic_no": ""})) for n, name in named.items()]
        payloads = spark.createDataFrame([fx.strip(roll, 3, "top", "", cards)], fx.PAYLOADS)
        result = rolls.run_rolls(context.filter(F.col("roll_id") == roll), payloads, spark.createDataFrame([fx.good_summary(roll)], fx.SUMMARY))
        warehouse.load(spark, root, batch, result, cover(spark, (roll,)), scans.eras(spark), fuzzy=True)
    found = sinks.read_facts(spark, root, "placement_fuzzy").join(sinks.read_rows(spark, root, "person"), "person_id").collect()
    assert {(r.roll_id, r.serial_no, r.canonical_name, r.match_method, float(r.match_confidence)) for r in found} == {
        ("r2", 1, "Anna Example", "fuzzy", 1.0), ("r2", 2, "Bert Sample", "fuzzy", 1.0)}
    warehouse.register_views(spark, root)
    assert {r.name: r.latest_roll_id for r in spark.sql("select * from v_person_current").collect()} == {n: "r2" for n in named.values()}


def test_documents_are_not_gathered_on_the_driver(spark, tmp_path, monkeypatch):
    """Files of documents are small for their rows, so no plan of a load or a reader may send a side by document to all."""
    plans, root = [], str(tmp_path / "w")
    seen = lambda write: lambda df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k))[1]
    monkeypatch.setattr(warehouse, "cut", seen(warehouse.cut))
    monkeypatch.setattr(sinks, "write_table", seen(sinks.write_table))
    context = jobs(spark).select("roll_id", "state_cd", "ac_no", F.lit(1).alias("part_no"), "roll_type", F.col("language").alias("language_code"),
                                 F.col("file_name").alias("source_pdf_filename"), F.col("pdf_sha256").alias("source_pdf_sha256"))
    electors = spark.createDataFrame([(r, n, f"K{n}", f"N{n}") for r in ("r1", "r2") for n in (1, 2)], "roll_id string, serial_no int, epic_no string, full_name string")
    absent = {c: F.lit(None).cast(t) for c, t in {
        "relation_type": "string", "relation_name": "string", "house_number": "string", "age": "int", "gender": "string", "status": "string", "supplement_no": "int",
        "deletion_reason_code": "string", "section_no": "int", "source_page": "int", "confidence": "double", "flags": "array<string>"}.items()}
    # tables that were written, as the estimates go by files
    table = lambda df, name: (df.write.parquet(str(tmp_path / name)), spark.read.parquet(str(tmp_path / name)))[1]
    summary = spark.createDataFrame([fx.good_summary(r) for r in ("r1", "r2")], fx.SUMMARY)
    result = rolls.RollBatch(*(table(df, n) for n, df in (("c", context), ("e", electors.withColumns(absent)), ("s", summary))), None, None, None)
    printed = spark.createDataFrame([("r1", "I")], "roll_id string, row_ordinal string")
    printed = printed.withColumns({f: F.lit(None) for f in ("row_label", "roll_type_label", "roll_identification", "supplement_no", "male", "female", "third_gender", "total")})
    warehouse.load(spark, root, 1, result, table(cover(spark), "v"), scans.eras(spark), printed)
    warehouse.register_views(spark, root)
    readers = [spark.table("v_person_current"), sinks.read_facts(spark, root, "roll"), sinks.read_dimension(spark, root, "assembly_constituency")]
    assert [r.count() for r in readers] == [2, 2, 1] and len(plans) > 15
    plans += [r._jdf.queryExecution().executedPlan().toString() for r in readers]
    sent = [line for p in plans for line in p.splitlines() if "BroadcastHashJoin [" in line and "roll_id#" in line.split("]")[0]]
    assert not sent, sent


def test_uncommitted_rows_are_invisible(spark, tmp_path):
    root = str(tmp_path / "w")
    df = spark.createDataFrame([("r1", "S01", 1, 5)], "roll_id string, state_cd string, ac_no int, v int")
    shape = "roll_id string, state_cd string, ac_no int, v int"
    got = lambda: [r.v for r in sinks.read_facts(spark, root, "f", shape).collect()]
    assert got() == []                                                            # never written
    sinks.write_batch(root, 1, df, {"f": df}, {})
    sinks.write_table(df.withColumn("v", F.lit(9)), root, "f", 2, sinks.AREA)     # a load that died before its commit
    assert got() == [5]
    sinks.write_batch(root, 2, df, {"f": df.withColumn("v", F.lit(6))}, {})
    assert got() == [6]


def test_a_replay_leaves_none_of_its_earlier_rows(spark, tmp_path):
    root, shape = str(tmp_path / "w"), "roll_id string, state_cd string, ac_no int, v int"
    df = spark.createDataFrame([("r1", "01", 1, 5), ("r1", "02", 1, 6), ("r2", None, 1, 7)], shape)
    got = lambda: sorted((r.roll_id, r.state_cd, r.v) for r in sinks.read_facts(spark, root, "f", shape).collect())
    sinks.write_batch(root, 1, df, {"f": df}, {})
    assert got() == [("r1", "01", 5), ("r1", "02", 6), ("r2", None, 7)]
    sinks.write_batch(root, 1, df, {"f": df.filter("state_cd = '01'")}, {})
    assert got() == [("r1", "01", 5)]
    sinks.write_batch(root, 1, df, {"f": df.limit(0)}, {})
    assert got() == []


def test_an_empty_first_batch_blocks_no_later_one(spark, tmp_path):
    root = str(tmp_path / "w")
    wrong = [fx.good_summary("r1", net_male=9)]
    run(spark, root, 1, ("r1",), wrong, require_reconcile=True)
    for table in schemas.WAREHOUSE:
        assert sinks.read_table(spark, root, table).count() == 0
    run(spark, root, 2, ("r1",), [fx.good_summary("r1")], require_reconcile=True)
    assert sinks.read_facts(spark, root, "elector").count() == 8


def test_declared_schemas_are_those_written(spark, tmp_path):
    root = str(tmp_path / "w")
    run(spark, root, 1, ("r1",), [fx.good_summary("r1")])
    kinds = lambda df: {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for table in schemas.WAREHOUSE:
        assert kinds(spark.read.parquet(f"{root}/{table}")) == kinds(sinks.read_table(spark, root, table)), table


def test_documents(spark, tmp_path):
    payloads = spark.createDataFrame(fx.good_roll("r1"), fx.PAYLOADS)
    context = spark.createDataFrame([("r1", "S01"), ("r0", "S01")], "roll_id string, state_cd string")
    b = rolls.run_rolls(context, payloads, spark.createDataFrame([fx.good_summary("r1")], fx.SUMMARY))
    docs = sinks.result_documents(b.context, b.summary, b.recon, b.electors)
    got = {(r.roll_id, r.line, r.serial_no): r for r in docs.collect()}
    assert sorted(k for k in got if k[1] == "elector") == [("r1", "elector", n) for n in range(1, 9)]
    assert got["r1", "roll", None].recon.reconciles and got["r1", "elector", 1].recon is None and got["r0", "roll", None].elector is None
    sinks.write_documents(docs, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == 10


def test_stream_state_equals_batch(spark, tmp_path, rows):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id", F.col("event_type").alias("status"))
    ev.repartition(5).write.parquet(str(tmp_path / "in"))
    ev.limit(50).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))     # repeated events
    src = stream.read_stream(spark, str(tmp_path / "in"), ev.schema, files_per_batch=1)
    stream.run_latest_state(src, ["user_id"], ["ts", "event_id"], ["status"], str(tmp_path / "s"), str(tmp_path / "c"))
    want = manifest.latest_state(ev, ["user_id"], ["ts", "event_id"], ["status"])
    assert rows(stream.read_latest_state(spark, str(tmp_path / "s"), ["user_id"])) == rows(want)


def test_stream_attempts(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.union(ev).coalesce(1).write.parquet(str(tmp_path / "in"))
    src = stream.read_stream(spark, str(tmp_path / "in"), ev.schema)
    out = stream.count_attempts(src, ["user_id"], "event_id", "ts", "60 days", F.col("event_type") == "click")
    q = out.writeStream.outputMode("complete").format("memory").queryName("att").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = {r.user_id: r.attempts for r in manifest.attempts(ev, ["user_id"], F.col("event_type") == "click").collect()}
    assert {r.user_id: r.attempts for r in spark.table("att").collect()} == want


def test_stream_identity_equals_batch(spark, tmp_path, rows):
    data = [(f"r{q}", s, f"K{(q * 5 + s * 3) % 11}" if s % 4 else None, f"n{q}-{s}", q) for q in range(4) for s in range(1, 9)]
    df = spark.createDataFrame(data, "roll_id string, serial_no int, epic_no string, full_name string, ingest_seq int")
    import time
    for q in range(4):
        df.filter(f"ingest_seq = {q}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    root, schema = str(tmp_path / "w"), "person_id string, epic_no string, first_roll_id string"
    src = stream.read_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    stream.run_identity(src, root, str(tmp_path / "c"), schema)
    stream.run_identity(stream.read_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1), root, str(tmp_path / "c"), schema)
    found = stream.read_identity(spark, root, schema)
    persons, registry = identity.register(df)
    assert rows(found["person"]) == rows(persons)
    assert rows(found["person_epic"]) == rows(registry)
    assert rows(found["placement"]) == rows(identity.place(df, registry))


def folders(path):
    return sorted((p.parent.name, p.name) for p in path.glob("version=*/base=*"))


def test_versions_fold_replay_and_compact(spark, tmp_path, rows):
    table = Versions(spark, str(tmp_path / "t"), "k int, a string, b string, c string", ["k"], last=["a"], first=["b"], last_filled=["c"], buckets=4)
    frame = lambda *r: spark.createDataFrame(list(r), table.schema)
    assert table.read().count() == 0 and table.folders() == []
    table.write(frame((1, "a1", "b1", "c1"), (2, "a1", None, None)), 1)
    table.write(frame((9, "wrong", None, None)), 2)
    table.write(frame((1, "a2", "b2", None), (2, None, "b2", "c2")), 2)                  # a replay replaces the version
    second = [(1, "a2", "b1", "c1"), (2, None, None, "c2")]
    assert rows(table.read(1)) == [(1, "a1", "b1", "c1"), (2, "a1", None, None)] and rows(table.read()) == rows(frame(*second))
    table.compact(2)
    table.compact(2)
    assert rows(table.read()) == rows(frame(*second)) and folders(tmp_path / "t") == [("version=2", "base=1")]
    with pytest.raises(ValueError, match="compacted"):
        table.write(frame(), 2)
    with pytest.raises(ValueError, match="compacted"):
        table.read(1)
    table.write(frame((3, "a3", None, None)), 3)
    table.compact(3, keep_from=2)
    assert rows(table.read(2)) == rows(frame(*second)) and table.read().count() == 3
    bucket = {r.k: r.b for r in table.read().select("k", table.bucket_of().alias("b")).collect()}
    assert {r.k for r in table.read(buckets=[bucket[3]]).collect()} == {k for k, b in bucket.items() if b == bucket[3]}
    plan = table.read(buckets=[bucket[3]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan
    (tmp_path / "t" / "version=3" / "base=1" / "_SUCCESS").unlink()                      # a base that was never finished
    assert rows(table.read(2)) == rows(frame(*second))


def test_rows_of_a_version_without_keys_stand_side_by_side(spark, tmp_path, rows):
    table = Versions(spark, str(tmp_path / "t"), "v int")
    for n in range(5):
        table.write(spark.createDataFrame([(n,), (7,)], "v int"), n)
        if n % 2:
            table.compact(n - 1)
    assert sorted(r.v for r in table.read().collect()) == [0, 1, 2, 3, 4, 7, 7, 7, 7, 7]
    assert len(folders(tmp_path / "t")) == 3


def test_folders_of_a_stream_are_bounded(spark, tmp_path, rows):
    df = spark.createDataFrame([(f"r{q}", s, f"K{q}-{s}", "n", q) for q in range(9) for s in range(2)], "roll_id string, serial_no int, epic_no string, full_name string, ingest_seq int")
    root, schema, inbox = str(tmp_path / "w"), "person_id string, epic_no string, first_roll_id string", str(tmp_path / "in [1]")
    for q in range(9):
        df.filter(f"ingest_seq = {q}").coalesce(1).write.mode("append").parquet(inbox)
        stream.run_identity(stream.read_stream(spark, inbox, df.schema), root, str(tmp_path / "c"), schema, buckets=2, every=3)
    assert stream.read_identity(spark, root, schema, buckets=2)["person"].count() == 18
    for name in ("registry", "placement"):
        assert len(folders(tmp_path / "w" / name)) <= 5


def test_a_replayed_micro_batch_does_not_see_its_own_output(spark, tmp_path, rows):
    df = spark.createDataFrame([("r1", 1, "K1", "n", 1), ("r1", 2, "K2", "n", 1)], "roll_id string, serial_no int, epic_no string, full_name string, ingest_seq int")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    root, schema = str(tmp_path / "w"), "person_id string, epic_no string, first_roll_id string"
    for attempt in ("a", "b"):  # another checkpoint: the first batch runs again over the same folder
        stream.run_identity(stream.read_stream(spark, str(tmp_path / "in"), df.schema), root, str(tmp_path / attempt), schema)
    found = stream.read_identity(spark, root, schema)
    assert found["person"].count() == 2 and found["placement"].count() == 2


@extractors.register("echo")
def echo(upper=False):
    def read(page):
        if page["page"] == 2:
            raise RuntimeError("unreadable")
        return {"section_header": page["text"].upper() if upper else page["text"], "cards": []}
    return read


@extractors.register("blank")
def blank(**_):
    return lambda page: None


def test_extractors(spark):
    pages = spark.createDataFrame([("r", i, "top", "x", lang) for i, lang in ((1, "ENG"), (2, "ENG"), (3, "TEL"), (4, None))], "roll_id string, page int, band string, text string, language_code string")
    got = {r.page: r for r in extractors.extract(pages, "echo", upper=True).collect()}
    assert json.loads(got[1].payload)["section_header"] == "X"
    assert got[2].failed and got[2].payload is None and got[2].error == "RuntimeError: unreadable"
    routed = {r.page: r.payload for r in extractors.extract_by_language(pages, {"ENG": "echo"}, "blank").collect()}
    assert routed[3] == routed[4] == "{}" and "x" in routed[1]
    with pytest.raises(ValueError, match="blank, echo"):
        extractors.get_extractor("none")
