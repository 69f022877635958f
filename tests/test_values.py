"""Golden values of the normalisers, one case per quirk."""

import pytest
from pyspark.sql import functions as F

from snapledger.functions import cards, text, values


def one(spark, expression, **row):
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in row.items()))
    return df.select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "fn, raw, want",
    [
        ("relation", " Father's Name", "Father"),
        ("relation", "wife", "Other"),
        ("relation", "", None),
        ("relation", "  ", "Other"),
        ("gender", "Fe male", "Female"),
        ("gender", "Third  Gender", "ThirdGender"),
        ("gender", "o", "ThirdGender"),
        ("gender", "x", None),
        ("key", " abc 123 ", "ABC123"),
        ("reason", "E/S/R", None),
        ("reason", "Q", "Q"),
        ("reservation", "SCHEDULED TRIBE", "ST"),
        ("reservation", "Scheduled Caste", "SC"),
        ("reservation", "general", "GEN"),
        ("reservation", "", None),
        ("station_type", None, "General"),
        ("station_type", "Female only", "Female"),
        ("roll_type", "SIR FinalRoll - 2026", "SIR_FinalRoll"),
        ("roll_type", "Supplement-2 2026", "Supplement"),
        ("roll_year", "Roll 2026", 2026),
        ("language_code", " malayalam", "MAL"),
        ("part_in_file", "x-12-WI.PDF", 12),
        ("region", "List of  Additions 1", "additions"),
        ("region", "SectionNo and Name", "main_roll"),
        ("region", "", None),
        ("supplement_no", "List of Additions 3 (..)", 3),
        ("supplement_no", "ListofAdditions3", None),
        ("age_in", "Age : 45 Gender", 45),
        ("gender_in", "Gender: Transgender", "ThirdGender"),
        ("gender_in", "Female / Male", "Female"),
    ],
)
def test_value(spark, fn, raw, want):
    assert one(spark, getattr(values, fn)("c"), c=raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("01-02-2026", "2026-02-01"), ("01/2/2026", "2026-02-01"), ("2026-02-01", "2026-02-01"),
        ("13-13-2026", None), ("1-2-2026", None), ("n/a", None), (None, None), ("31-02-2026", None),
    ],
)
def test_iso_date(spark, raw, want):
    assert one(spark, values.iso_date("c").cast("string"), c=raw) == want


def test_file_context(spark):
    name = "2026-EROLLGEN-S07-12-SIR-FinalRoll-Revision1-ENG-34-WI.pdf"
    row = spark.createDataFrame([(name,), ("x.pdf",)], "n string").select(*values.file_context("n")).collect()
    assert tuple(row[0]) == ("S07", 12, "ENG", 34, "SIR_FinalRoll")
    assert tuple(row[1]) == (None,) * 5


def test_constituency_and_title(spark):
    r = one(spark, values.constituency("c"), c="Assembly Constituency :: 12-Some Place (sc)")
    assert tuple(r) == (12, "Some Place", "SC")
    assert tuple(one(spark, values.constituency("c"), c="PC: 3 - Other")) == (3, "Other", None)
    assert tuple(one(spark, values.roll_title("c"), c="ELECTORAL ROLL 2026S07Somewhere")) == (2026, "Somewhere")


def test_labels(spark):
    assert one(spark, text.strip_label("c"), c="Wifes Name X") == "X"
    assert one(spark, text.strip_label("c"), c="Name : A : B") == "A : B"
    assert one(spark, text.strip_tags("c"), c="<p>a</p>&nbsp;b") == "a  b"
    assert one(spark, text.untagged("c", ["a"])[0], c="<s_a> x\ny </s_a>") == "x\ny"


def test_pages(spark):
    kinds = spark.range(1, 6).select(values.page_kind("id", F.lit(5)).alias("k")).collect()
    assert [r.k for r in kinds] == ["cover", "skipped", "voter", "voter", "summary"]
    assert one(spark, values.page_kind("c", F.lit(2)), c=1) == "error"
    assert one(spark, values.page_bands(F.lit(50.0), F.lit(100.0)), c=1) == ["top", "bot"]


def test_page_bands_at_their_borders(spark):
    at = lambda y, height: one(spark, values.page_bands(F.lit(y), F.lit(height)), c=1)
    assert at(110.0, 200.0) == ["bot"] and at(109.99, 200.0) == ["top", "bot"]
    assert at(96.0, 200.0) == ["top", "bot"] and at(95.99, 200.0) == ["top"]


CARD = "region string, marker_box string, deleted_watermark boolean, deletion_reason_code string, supplement_no int"


@pytest.mark.parametrize(
    "card, want",
    [
        (("main_roll", "", False, None, 9), ("active", None, None, None)),
        (("main_roll", "E", False, None, 9), ("deleted", "E", None, None)),
        (("main_roll", "", True, None, 9), ("deleted", None, None, None)),
        (("main_roll", "#/1", False, None, 9), ("modified", None, None, 9)),
        (("main_roll", "#", True, "S", 9), ("deleted", "S", None, None)),
        (("additions", "12", False, "S", 9), ("added", None, 12, 9)),
        (("additions", "١", False, None, 9), ("added", None, None, 9)),
        (("deletions", "M", False, None, 9), ("deleted", "M", None, 9)),
        ((None, "E", True, "S", 9), ("active", None, None, None)),
    ],
)
def test_status(spark, card, want):
    got = spark.createDataFrame([card], CARD).select(cards.inferred_status().alias("s")).first().s
    assert tuple(got) == want


def test_flags(spark):
    df = spark.createDataFrame(
        [("ABC1234567", 40, "Male", "x"), ("abc", 130, "male", ""), (None, None, None, None)],
        "epic_no string, age int, gender string, full_name string",
    )
    out = df.select(cards.flags().alias("f"), cards.confidence(cards.flags()).alias("c")).collect()
    assert out[0].f == [] and out[0].c == 1.0
    assert out[1].f == ["epic_format", "age_range", "gender_enum", "missing_name"] and out[1].c == 0.0
    assert out[2].f == ["missing_name"] and out[2].c == 0.75
