import json

import pytest
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.operators import assemble, reconcile
from snapledger.sources import scans
from snapledger.plans.rolls import enrich_context, run_rolls
from tests import fixtures as fx


@pytest.fixture(scope="module")
def batch(spark):
    payloads = spark.createDataFrame(fx.good_roll("r1") + fx.good_roll("r2"), fx.PAYLOADS)
    context = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "roll_id string")
    summary = spark.createDataFrame(
        [fx.good_summary("r1"), fx.good_summary("r2", net_male=9), fx.good_summary("r3", net_male=0, net_female=0,
         net_third_gender=0, net_total=0, additions_total=0, deletions_total=0)], fx.SUMMARY)
    return run_rolls(context, payloads, summary)


def test_cards(batch):
    got = {r.serial_no: r for r in batch.electors.filter("roll_id = 'r1'").collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [got[i].status for i in range(1, 9)] == [
        "active", "deleted", "modified", "active", "active", "added", "added", "deleted"]
    assert got[3].epic_no == "ABC0000003"          # the more complete read wins
    assert got[4].region == "main_roll" and got[4].supplement_no == 9   # a wrong header inside the main roll's span
    assert got[6].section_no == 7 and got[6].supplement_no == 2
    assert got[7].region == "additions" and got[7].supplement_no == 2   # carried over the failed strip
    assert got[8].deletion_reason_code == "S" and got[8].supplement_no is None
    assert got[2].deletion_reason_code == "E"


def test_rejects_and_failures(batch):
    assert batch.rejected.filter("roll_id = 'r1'").count() == 1
    assert [r.failed_strip for r in batch.failed.filter("roll_id = 'r1'").collect()] == ["p5/bot"]


def test_checks(batch):
    got = {r.roll_id: r for r in batch.recon.collect()}
    assert got["r1"].reconciles and all(got["r1"].checks.values())
    assert not got["r2"].reconciles
    assert [k for k, v in got["r2"].checks.items() if not v] == ["net_male"]
    assert got["r3"].cards_printed == 0 and got["r3"].reconciles


def test_first_arrival_wins_a_tie(spark):
    rows = [("r", 1, 3, 1, 0, "late"), ("r", 1, 3, 0, 1, "second"), ("r", 1, 3, 0, 0, "first")]
    df = spark.createDataFrame(rows, "roll_id string, serial_no int, source_page int, band_no int, pos int, t string")
    assert assemble.best_reads(df, score=F.lit(1)).first().t == "first"


def test_best_reads_is_idempotent(spark, batch, rows):
    once = batch.electors
    again = assemble.best_reads(once)
    assert rows(again.select("roll_id", "serial_no", "epic_no")) == rows(once.select("roll_id", "serial_no", "epic_no"))


def test_guard_without_main_roll_changes_nothing(spark):
    df = spark.createDataFrame([("r", 1, "additions"), ("r", 2, "deletions")], "roll_id string, serial_no int, region string")
    assert {r.region for r in assemble.guard_sections(df).collect()} == {"additions", "deletions"}


def test_added_card_keeps_stamp_but_loses_reason(spark):
    card = fx.card(1, deleted_watermark=True, deletion_reason_code="E")
    payload = spark.createDataFrame([fx.strip("r", 3, "top", "List of Additions 1", [card])], fx.PAYLOADS)
    out = run_rolls(payload.select("roll_id"), payload, spark.createDataFrame([], fx.SUMMARY)).electors.first()
    assert out.status == "added" and out.deleted_watermark and out.deletion_reason_code is None


def test_view_and_checks_agree_where_they_overlap(spark):
    rolls = spark.createDataFrame([("a",), ("b",), ("c",)], "roll_id string")
    entries = spark.createDataFrame(
        [("a", "active", "Male"), ("a", None, "Female"), ("b", "deleted", "Male")], "roll_id string, entry_status string, gender string")
    summary = spark.createDataFrame([fx.good_summary("a", net_male=1, net_female=1, net_third_gender=0, net_total=2,
                                     additions_total=0, deletions_total=0)], fx.SUMMARY)
    cover = spark.createDataFrame([("a", 3), ("c", 1)], "roll_id string, net_total int")
    view = {r.roll_id: r for r in reconcile.roll_reconciliation(rolls, entries, summary, cover).collect()}
    checks = {r.roll_id: r for r in reconcile.reconcile(rolls, entries, summary, status="entry_status").collect()}
    assert checks["a"].reconciles and not view["a"].reconciles and view["a"].cover_matches_summary is False
    assert view["b"].cover_matches_summary is None and not view["b"].has_summary and not checks["b"].reconciles
    assert view["a"].live_cards == checks["a"].live_cards == 2


def test_context_is_enriched_only_where_empty(spark):
    context = spark.createDataFrame([("a", 5, None), ("b", None, 2)], "roll_id string, ac_no int, part_no int")
    cover = spark.createDataFrame([("a", 7, 8), ("b", 0, 9)], "roll_id string, ac_no int, part_no int")
    got = {r.roll_id: (r.ac_no, r.part_no) for r in enrich_context(context, cover).collect()}
    assert got == {"a": (5, 8), "b": (None, 2)}


def test_component_identity(spark):
    part = spark.createDataFrame(
        [("a", "I", 5, 5), ("a", "II", 2, 2), ("a", "III", 1, 1), ("a", "IV", -1, -1)],
        "roll_id string, row_ordinal string, male int, total int")
    summary = spark.createDataFrame([("a", 5, 6)], "roll_id string, net_male int, net_total int")
    r = reconcile.component_identity(part, summary, measures=(("male", "net_male"), ("total", "net_total"))).first()
    assert r.male_sum == 5 and r.male_holds and not r.total_holds


def test_odd_payloads(spark):
    """Wrong types null one field, an empty object is an empty strip, other text is a failure."""
    odd = {"section_header": "", "cards": [fx.card(1, age="45"), fx.card(2, age=45.5, serial_no=" 2 "), {"serial_no": None}, fx.card(3)]}
    df = spark.createDataFrame([("r", 3, "top", json.dumps(odd)), ("r", 4, "top", "{}"), ("r", 5, "top", '{"section_header": "x'), ("r", 6, "top", None)], fx.PAYLOADS)
    strips = assemble.parse_strips(df)
    assert {r.page: r.failed for r in strips.collect()} == {3: False, 4: False, 5: True, 6: True}
    out = run_rolls(df.select("roll_id").distinct(), df, spark.createDataFrame([], fx.SUMMARY))
    assert sorted((r.serial_no, r.age) for r in out.electors.collect()) == [(1, None), (2, None), (3, 30)]
    assert out.rejected.count() == 1


def test_summary_and_cover_payloads(spark):
    pages = spark.createDataFrame([("r", '{"net_total": 5, "net_male": null}'), ("q", "oops")], "roll_id string, payload string")
    got = {r.roll_id: r.net_total for r in scans.from_payload(pages, schemas.SUMMARY_PAYLOAD).collect()}
    assert got == {"r": 5, "q": None}
    cover = spark.createDataFrame([("r", '{"sections": [{"section_no": 1}], "ac_no": 4}')], "roll_id string, payload string")
    r = scans.from_payload(cover, schemas.COVER_PAYLOAD).first()
    assert r.ac_no == 4 and r.sections[0].section_no == 1


def test_first_voter_pages_only(spark):
    df = spark.createDataFrame(fx.good_roll("r1"), fx.PAYLOADS)
    out = run_rolls(df.select("roll_id").distinct(), df, spark.createDataFrame([], fx.SUMMARY), max_voter_pages=1)
    assert [r.serial_no for r in assemble.in_order(out.electors).collect()] == [1, 2, 3, 4]
