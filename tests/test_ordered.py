"""Blocked scans equal plain windows, with blocks far smaller than the groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from snapledger.operators import ordered


@pytest.fixture(scope="module")
def df(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(5)}", i, rnd.choice([None, None, rnd.randrange(9)]),
             float(rnd.randrange(40)) / 4) for i in rnd.sample(range(4000), 600)]
    return spark.createDataFrame(rows, "k string, o int, v int, g double").cache()



def block():
    return F.floor(F.col("o") / 64)


def test_carry_forward(df, rows):
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.carry_forward(df, ["k"], ["o"], F.col("v"), block(), "c").select("k", "o", "c")
    assert rows(got) == rows(df.select("k", "o", F.last("v", True).over(w)))


def test_neighbours(df, rows):
    w = Window.partitionBy("k").orderBy("o")
    got = ordered.previous(df, ["k"], ["o"], block(), a=F.col("v"), b=F.col("g")).select("k", "o", "a", "b")
    assert rows(got) == rows(df.select("k", "o", F.lag("v").over(w), F.lag("g").over(w)))
    got = ordered.following(df, ["k"], ["o"], block(), a=F.col("v")).select("k", "o", "a")
    assert rows(got) == rows(df.select("k", "o", F.lead("v").over(w)))


def test_running_sum(df, rows):
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.running_sum(df, ["k"], ["o"], F.coalesce("v", F.lit(0)), block(), "s").select("k", "o", "s")
    assert rows(got) == rows(df.select("k", "o", F.sum(F.coalesce("v", F.lit(0))).over(w)))


@pytest.mark.parametrize("width", [0.5, 3.0, 1000.0])
def test_upper_median(df, width):
    got = {r.k: r.m for r in ordered.upper_median(df, ["k"], "g", width, "m").collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r.k, []).append(r.g)
    assert got == {k: sorted(v)[len(v) // 2] for k, v in values.items()}


def test_upper_median_of_even_count(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 10)], "k string, g double")
    assert ordered.upper_median(df, ["k"], "g", 1.0, "m").first().m == 3.0


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(ordered, "TARGET", 256)
    monkeypatch.setattr(ordered, "MARKS", 16)


@pytest.fixture(scope="module")
def heavy(spark):
    """A key with a third of the rows, all in one block of the order."""
    return spark.range(12_000).selectExpr("case when id % 3 = 0 then 'hot' else concat('k', id % 40) end as k", "case when id % 3 = 0 then id else id * 100 end as o",
                                          "case when id % 5 = 0 then id end as v").repartition(5).cache()


def day():
    return F.floor(F.col("o") / 100_000)


def test_no_block_is_much_larger_than_the_target(heavy, small):
    found = ordered.bounded(heavy, ["k"], ["o"], day())
    sizes = found.groupBy("k", ordered.BLOCK).agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi")).orderBy("k", "lo").collect()
    assert max(r.n for r in sizes) <= 2 * 256 and sum(r.n for r in sizes) == 12_000
    for a, b in zip(sizes, sizes[1:]):
        assert a.k != b.k or (a.hi < b.lo and a[ordered.BLOCK] < b[ordered.BLOCK])     # blocks follow the order
    plan = ordered.carry_forward(heavy, ["k"], ["o"], F.col("v"), day(), "c")
    rows = plan.groupBy("k", F.floor(F.col("o") / 100_000)).count().agg(F.max("count")).first()[0]
    assert rows >= 4_000                                                              # the block that was given holds them all


def test_scans_of_a_heavy_block_equal_plain_windows(heavy, rows, small):
    along = Window.partitionBy("k").orderBy("o")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.carry_forward(heavy, ["k"], ["o"], F.col("v"), day(), "c").select("k", "o", "c")
    assert rows(got) == rows(heavy.select("k", "o", F.last("v", True).over(upto)))
    got = ordered.previous(heavy, ["k"], ["o"], day(), a=F.col("v")).select("k", "o", "a")
    assert rows(got) == rows(heavy.select("k", "o", F.lag("v").over(along)))
    got = ordered.following(heavy, ["k"], ["o"], day(), a=F.col("o")).select("k", "o", "a")
    assert rows(got) == rows(heavy.select("k", "o", F.lead("o").over(along)))
    got = ordered.gap_sessions(heavy, ["k"], ["o"], F.col("v").isNotNull(), day(), "s").select("k", "o", "s")
    assert rows(got) == rows(heavy.select("k", "o", F.sum(F.col("v").isNotNull().cast("int")).over(upto).cast("bigint")))


def test_median_of_a_range_with_many_values(heavy, small):
    got = {r.k: r.m for r in ordered.upper_median(heavy, ["k"], "o", 1e9, "m").collect()}
    values = {}
    for r in heavy.collect():
        values.setdefault(r.k, []).append(r.o)
    assert got == {k: sorted(v)[len(v) // 2] for k, v in values.items()}


def test_positions(heavy, rows, small):
    got = ordered.positions(heavy, ["k"], ["o"], day(), "n").select("k", "o", "n")
    assert rows(got) == rows(heavy.select("k", "o", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("bigint")))
