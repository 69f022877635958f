"""Card, summary and cover pages from tokens."""

import random

import pytest
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.operators import forms, layout
from snapledger.plans.rolls import run_tokens
from snapledger.queries import pages
from tests import fixtures as fx


class Page:
    def __init__(self, image="a", engine="latin"):
        self.image, self.engine, self.rows = image, engine, []

    def put(self, x, y, text, w=50.0, h=12.0, engine=None):
        self.rows.append((self.image, len(self.rows), engine or self.engine, float(x), float(y), float(x + w), float(y + h), text, 0.9))
        return self

    def df(self, spark):
        return spark.createDataFrame(self.rows, schemas.TOKENS)


def card_page():
    p = Page()
    p.put(0, 10, "ListofAdditions 2(..)", 1200)
    serial = {(0, 0): "1", (0, 1): None, (0, 2): "3", (1, 0): "4", (1, 1): "S  5", (1, 2): "S06",
              (2, 0): "1", (2, 1): "8", (2, 2): "9", (3, 0): None, (3, 1): None, (3, 2): None}
    for r in range(4):
        for c in range(3):
            x, y, n = c * 400, 100 + 200 * r, 1 + 3 * r + c
            if serial[r, c]:
                p.put(x + 10, y, serial[r, c])
            p.put(x + 250, y, f"ABC 00000{n:02d}")
            p.put(x + 10, y + 40, f"Name : P{n}").put(x + 10, y + 60, "Kumar")
            p.put(x + 10, y + 80, "Wifes Name: W" if n % 2 else "Fathers Name :")
            p.put(x + 10, y + 90, "tail")
            p.put(x + 10, y + 100, "House Number : 1").put(x + 10, y + 110, "Section No 1 as on 2026")
            p.put(x + 10, y + 120, f"Age : 4{n % 10} Gender : Female")
    p.put(400 + 100, 700, "E")  # bare reason letter in the box of card 11
    return p


@pytest.fixture(scope="module")
def parsed(spark):
    return {r.epic_no: r for r in layout.parse_cards(card_page().df(spark)).collect()}


def test_cards_and_grid(parsed):
    assert len(parsed) == 12
    assert all(int(k[3:]) == r.serial_no for k, r in parsed.items())   # misread and missing serials restored
    stamped = {k: r.deletion_reason_code for k, r in parsed.items() if r.deleted_watermark}
    assert stamped == {"ABC0000005": "S", "ABC0000011": "E"}            # a fused letter is no deletion


def test_label_state_machine(parsed):
    r = parsed["ABC0000001"]
    assert (r.full_name, r.relation_type, r.relation_name, r.house_number, r.age, r.gender) == (
        "P1 Kumar", "Husband", "W tail", "1", 41, "Female")
    r = parsed["ABC0000002"]
    assert (r.relation_type, r.relation_name) == ("Father", "")         # nothing continues an empty field


def test_tokens_end_to_end(spark):
    """Two overlapping strips of one page: the carried header makes the cards additions."""
    tokens = card_page().df(spark)
    tokens = tokens.unionByName(tokens.filter("y < 250 and y > 50").withColumn("image_id", F.lit("b")))
    pages = spark.createDataFrame([("a", "r1", 3, "top"), ("b", "r1", 3, "bot")], "image_id string, roll_id string, page int, band string")
    out = run_tokens(spark.createDataFrame([("r1",)], "roll_id string"), tokens, pages, spark.createDataFrame([], fx.SUMMARY))
    got = {r.serial_no: r for r in out.electors.collect()}
    assert sorted(got) == list(range(1, 13)) and got[1].status == "added" and got[1].supplement_no == 2
    assert got[5].deleted_watermark and got[5].deletion_reason_code is None and got[2].relation_name is None


def test_fixes_replace_only_stamped_cards(spark):
    fixes = spark.createDataFrame(
        [("a", "ABC0000005", "New", "", "", "9"), ("a", "ABC0000001", "No", "", "", "")],
        "image_id string, epic_no string, full_name string, relation_type string, relation_name string, house_number string")
    got = {r.epic_no: r for r in layout.parse_cards(card_page().df(spark), fixes).collect()}
    assert got["ABC0000005"].full_name == "New" and got["ABC0000005"].relation_name == "W tail"
    assert got["ABC0000001"].full_name == "P1 Kumar"


def test_default_height_for_a_lone_card(spark):
    p = Page().put(0, 0, "wide", 1200).put(250, 100, "ABC0000001")
    placed = layout.columns_of(p.df(spark))
    assert layout.card_heights(layout.spaced(layout.anchors_of(placed)), dpi=300).first().card_h == round(219 * 300 / 200)


@pytest.mark.parametrize("seed", range(2))
def test_grid_fold_equals_a_loop(spark, seed):
    """Base of each row by a plain loop over the rows in order."""
    rnd = random.Random(seed)
    cards, want = [], {}
    for image in ("p", "q"):
        prev = None
        for row in range(40):
            serials = [(c, rnd.choice([None, row * 3 + c, row * 3 + c + rnd.randrange(3)])) for c in range(3) if rnd.random() < 0.8]
            serials = serials or [(0, None)]
            if row < 3:
                serials = [(c, None) for c, _ in serials]
            votes = {}
            for c, s in serials:
                cards.append((image, c, row * 10 + c, float(row), row + 1, s))
                if s is not None:
                    votes[s - c] = votes.get(s - c, 0) + 1
            best = [b for b in votes if votes[b] == max(votes.values())]
            if best:
                base = best[0] if len(best) == 1 or prev is None else min(best, key=lambda b: abs(b - prev - 3))
            else:
                base = None if prev is None else prev + 3
            want[image, row + 1] = prev = base
    df = spark.createDataFrame(cards, "image_id string, col int, anchor int, ay double, grid_row bigint, serial_no int")
    got = {(r.image_id, r.grid_row): r.base for r in layout.serial_bases(df, rows_per_block=4).collect()}
    assert got == want


def test_two_engines(spark):
    p = Page().put(0, 0, "x", 1200)
    for i, y in ((1, 100), (2, 300)):
        p.put(10, y, f"S{i}" if i == 2 else "1").put(250, y, f"ABC000000{i}").put(10, y + 120, "45").put(10, y + 140, "99")
        p.put(10, y + 40, f"పేరు : N{i}", engine="script").put(10, y + 60, "భర్త పేరు: H", engine="script")
        p.put(230, y + 80, "ఇంటి సంఖ్య : 7", engine="script").put(10, y + 130, "స్త్రీ", engine="script")
    got = {r.serial_no: r for r in layout.parse_script_cards(p.df(spark)).collect()}
    assert sorted(got) == [1, 2]
    assert (got[1].full_name, got[1].relation_type, got[1].relation_name, got[1].house_number, got[1].age, got[1].gender) == (
        "N1", "Husband", "H", "7", 45, "Female")
    assert not got[1].deleted_watermark and got[2].deletion_reason_code == "S"   # fused letter counts here


def test_summary(spark):
    p = Page()
    p.put(300, 10, "Male").put(400, 10, "Female").put(500, 10, "Third Gender").put(600, 10, "Total")
    p.put(0, 100, "List of Additions").put(600, 104, "12").put(300, 90, "7")
    p.put(0, 200, "List of Deletions").put(601, 200, "3")
    p.put(0, 300, "Net Elector in this Roll (I+II-III+IV)").put(310, 300, "500").put(405, 301, "400").put(498, 302, "1").put(610, 303, "900").put(612, 304, "901")
    p.put(0, 500, "NUMBER OF MODIFICATIONS").put(0, 560, "4").put(50, 590, "17").put(0, 640, "99")
    r = forms.parse_summary(p.df(spark)).first()
    assert (r.net_male, r.net_female, r.net_third_gender, r.net_total) == (500, 400, 1, 901)  # the later token overwrites
    assert (r.additions_total, r.deletions_total, r.num_modifications) == (12, 3, 17)


def test_summary_without_headers(spark):
    r = forms.parse_summary(Page().put(0, 100, "Net Elector").put(50, 100, "9").df(spark)).first()
    assert r.net_total is None and r.additions_total is None


def test_cover(spark):
    p = Page()
    p.put(0, 0, "ELECTORAL ROLL 2026 S07 Somewhere")
    p.put(0, 40, "No. Name of Assembly Constituency :: 12-North (SC)").put(0, 60, "Parliamentary Constituency : 3-West(GEN)")
    p.put(600, 40, "Part No. : 34")
    p.put(0, 100, "Year of Revision").put(200, 101, ": 2025").put(300, 100, "far")
    p.put(0, 120, "Qualifying Date").put(200, 120, "01-01-2026")
    p.put(0, 140, "Date of Publication :02-02-2026")
    p.put(0, 160, "Roll Identification").put(5, 176, "Basic roll")
    p.put(0, 200, "Block").put(200, 200, "B1").put(0, 230, "1-Block1")
    p.put(0, 260, "Pin Code").put(200, 260, "12 34 56")
    p.put(0, 300, "No and Name of Polling Station").put(0, 316, "7 - School").put(0, 360, "Type of Polling Station").put(200, 360, "General")
    p.put(0, 400, "Number of Auxiliary Polling Stations").put(300, 400, "2")
    p.put(0, 450, "No and name of sections in the part").put(0, 470, "1-East").put(0, 485, "2 - West side").put(0, 540, "3-too far")
    for x, t in ((0, "Starting"), (100, "Ending"), (200, "Male"), (300, "Female"), (400, "Third Gender"), (500, "Total")):
        p.put(x, 600, t)
    for x, t in ((2, "1"), (102, "100"), (203, "50"), (301, "40"), (402, "0"), (502, "90"), (505, "91")):
        p.put(x, 620, t)
    r = forms.parse_cover(p.df(spark)).first()
    assert (r.year_of_revision, r.state_name) == (2026, "Somewhere")
    assert (r.ac_no, r.ac_name, r.ac_reservation, r.pc_no, r.pc_name, r.part_no) == (12, "North", "SC", 3, "West", 34)
    assert (r.qualifying_date, r.date_of_publication, r.roll_identification) == ("01-01-2026", "02-02-2026", "Basic roll")
    assert (r.block, r.pin_code, r.polling_station_no, r.polling_station_name) == ("B1", "123456", 7, "School")
    assert (r.polling_station_type, r.num_auxiliary_stations) == ("General", 2)
    assert [tuple(s) for s in r.sections] == [(1, "East"), (2, "West side")]
    assert (r.starting_serial_no, r.ending_serial_no, r.net_male, r.net_female, r.net_third_gender, r.net_total) == (
        1, 100, 50, 40, 0, 90)                                            # the first token of a column wins


def test_a_fold_of_tied_rows_equals_the_loop(spark, rows):
    import random
    rnd = random.Random(3)
    data = {}
    for image, n in (("a", 1), ("b", 64), ("c", 65), ("d", 5000), ("e", 300)):
        at = sorted(rnd.sample(range(2 * n), n))
        data[image] = [(r, [rnd.randrange(40) + 3 * r for _ in range(1 if k == 0 or rnd.random() < 0.02 else rnd.choice([1, 2, 3]) if image == "e" else 3)]) for k, r in enumerate(at)]
    want = []
    for image, links in data.items():
        before = None
        for r, options in links:
            expected = None if before is None else before[1] + 3 * (r - before[0])
            base = options[0] if expected is None else min((abs(o - expected), i, o) for i, o in enumerate(options))[2]
            want.append((image, r, base))
            before = (r, base)
    frame = spark.createDataFrame([(i, r, o) for i, links in data.items() for r, o in links], "image_id string, at long, options array<int>")
    assert rows(layout.fold_rows(frame, ["image_id"], 3)) == sorted(want, key=repr)
    assert layout.fold_rows(frame.limit(0), ["image_id"], 3).count() == 0


def test_a_million_rows_that_all_tie(spark):
    """Two bases tie in every row; the first row takes the first one, and every row after it the one that continues it."""
    frame = spark.range(1_000_000).selectExpr("'i' as image_id", "id as at", "case when id = 0 then array(5) else array(cast(3 * id + 900 as int), cast(3 * id + 5 as int)) end as options")
    found = layout.fold_rows(frame, ["image_id"], 3)
    assert found.filter("b = 3 * at + 5").count() == 1_000_000


def test_rendered_tokens_are_dealt_by_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(pages, "ROWS", 10)
    customers = spark.range(95, numPartitions=1).select(F.col("id").alias("c_custkey"))
    tokens = pages._tokens(customers, "c_custkey div 30", [("0", "10", "'a'"), ("5", "10", "if(c_custkey % 2 = 0, 'b', null)")])
    assert tokens.rdd.getNumPartitions() == 10 and tokens.count() == 95 + 48
    placed = tokens.select("image_id", F.spark_partition_id().alias("task")).distinct()
    assert placed.count() == placed.select("image_id").distinct().count() == 4
    assert pages._tokens(customers.limit(0), "c_custkey", [("0", "10", "'a'")]).count() == 0
