"""Merge, lookup, identity, lineage, ledger and audit operators on small tables."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from snapledger.functions import values
from snapledger.operators import consensus, identity, layout, lineage, manifest, merge, quality, resolve
from snapledger.plans import constraints
from snapledger.sources import sinks
from snapledger.sources.versions import Versions


def test_insert_absent_twice_adds_nothing(spark, rows):
    old = spark.createDataFrame([(1, "a", "old")], "k int, p string, v string")
    new = spark.createDataFrame([(1, "a", "new"), (2, "b", "x"), (2, "b", "y"), (3, None, "n"), (3, None, "n")], "k int, p string, v string")
    merged, fresh = merge.insert_absent(old, new, ["k", "p"])
    assert rows(merged) == [(1, "a", "old"), (2, "b", "x"), (3, None, "n"), (3, None, "n")]
    whole = new.filter("p is not null")
    assert merge.insert_absent(merged, whole, ["k", "p"])[1].count() == 0


def test_upsert_policies(spark):
    df = spark.createDataFrame(
        [(1, 1, None, "a", "x"), (1, 2, "n2", "b", None), (1, 3, "n3", None, None)], "k int, seq int, f string, l string, z string")
    r = merge.upsert(df, ["k"], F.col("seq"), last=["l"], first=["f"], last_filled=["z"]).first()
    assert (r.f, r.l, r.z) == (None, None, "x")   # first keeps a null, last takes one, last_filled skips it


def test_resolve(spark):
    catalog = spark.createDataFrame([("S1", 1, "Foo"), ("S1", 2, "Bar"), ("S2", 1, "Baz")], "s string, no int, name string")
    labels = spark.createDataFrame([("S1", "1 - any"), ("S1", "bar"), ("S1", "9 - FOO"), ("S2", "Bar"), ("S1", "")], "s string, l string")
    got = {(r.s, r.l): r.no for r in resolve.by_number_or_name(labels, catalog, ["s"], "l", "no", "name", ["no"]).collect()}
    assert got == {("S1", "1 - any"): 1, ("S1", "bar"): 2, ("S1", "9 - FOO"): 1, ("S2", "Bar"): None, ("S1", ""): None}
    states = spark.createDataFrame([("Goa", "S05")], "state_name string, state_cd string")
    asked = spark.createDataFrame([("gOA",), ("S99",), ("nowhere",)], "a string")
    assert {r.a: r.resolved_cd for r in resolve.name_to_code(asked, states, "a").collect()} == {"gOA": "S05", "S99": "S99", "nowhere": None}


def test_eras(spark):
    d = dt.date
    eras = spark.createDataFrame([("old", d(1976, 1, 1), d(2008, 2, 19)), ("new", d(2008, 2, 19), None)], "era_name string, effective_from date, effective_to date")
    df = spark.createDataFrame([(d(2008, 2, 18),), (d(2008, 2, 19),), (d(2999, 1, 1),), (d(9999, 12, 31),), (d(1900, 1, 1),), (None,)], "at date")
    got = {r["at"]: r.era_name for r in resolve.era_of(df, eras, "at").collect()}
    assert list(got.values()).count(None) == 2 and got[d(2008, 2, 18)] == "old" and got[d(2008, 2, 19)] == got[d(2999, 1, 1)] == "new"


def test_sections_default(spark):
    df = spark.createDataFrame([("a", None), ("b", []), ("c", [(0, "z"), (2, "y"), (None, "x")])],
                               "k string, sections array<struct<section_no:int,section_name:string>>")
    got = sorted((r.k, r.section_no, r.section_name) for r in resolve.section_rows(df, ["k"]).collect())
    assert got == [("a", 1, None), ("b", 1, None), ("c", 2, "y")]


ENTRY = "roll_id string, serial_no int, epic_no string, full_name string, ingest_seq int"


def entries(spark, seed=3):
    rnd = random.Random(seed)
    data = [(f"r{q}", s, rnd.choice([None, *[f"K{i}" for i in range(12)]]), f"n{q}-{s}", q) for q in range(6) for s in range(1, 9)]
    return spark.createDataFrame(data, ENTRY)


def test_identity_batch(spark):
    df = entries(spark)
    persons, registry = identity.register(df)
    placed = identity.place(df, registry)
    first = {}
    for r in df.orderBy("ingest_seq", "serial_no").collect():
        if r.epic_no is not None:
            first.setdefault(r.epic_no, (r.full_name, r.roll_id))
    assert {r.epic_no: r.canonical_name for r in persons.collect()} == {k: v[0] for k, v in first.items()}
    assert {r.epic_no: r.first_roll_id for r in registry.collect()} == {k: v[1] for k, v in first.items()}
    assert placed.count() == df.filter("epic_no is not null").count()


@pytest.mark.parametrize("cuts", [[2], [1, 3, 4], [5]])
def test_identity_in_any_split_equals_batch(spark, rows, cuts):
    df = entries(spark)
    want = identity.register(df)
    registry, persons, lo = None, None, 0
    for hi in [*cuts, 99]:
        p, k = identity.register(df.filter(f"ingest_seq >= {lo} and ingest_seq < {hi}"), registry)
        registry = k if registry is None else registry.unionByName(k)
        persons = p if persons is None else persons.unionByName(p)
        lo = hi
    assert rows(persons) == rows(want[0]) and rows(registry) == rows(want[1])


def test_merged_persons(spark):
    registry = spark.createDataFrame([("p1", "K1"), ("p2", "K2"), ("p3", "K3"), ("p4", "K4")], "person_id string, epic_no string")
    merges = spark.createDataFrame([("p3", "p2"), ("p2", "p1")], "person_id string, into_id string")
    got = {r.epic_no: r.person_id for r in identity.apply_merges(registry, identity.fold_chains(merges)).collect()}
    assert got == {"K1": "p1", "K2": "p1", "K3": "p1", "K4": "p4"}
    chain = spark.createDataFrame([(f"p{k}", f"p{k + 1}") for k in range(9)], "person_id string, into_id string")
    assert {r.into_id for r in identity.fold_chains(chain).collect()} == {"p9"}
    for loop in (["ab", "ba"], ["ab", "bc", "ca", "xa"]):
        with pytest.raises(ValueError):
            identity.fold_chains(spark.createDataFrame([tuple(e) for e in loop], "person_id string, into_id string"))


def test_key_twice_in_a_roll(spark):
    df = spark.createDataFrame([("r", 2, "K", "b", 1), ("r", 1, "K", "a", 1), ("r", 3, None, "c", 1)], ENTRY)
    assert [r.serial_no for r in identity.one_per_key(df).collect()] == [1]
    persons, registry = identity.register(df)
    assert persons.count() == 1 and identity.place(df, registry).count() == 2


def test_current_status_orders_unpublished_last(spark):
    d = dt.date
    persons = spark.createDataFrame([("p", None)], "person_id string, canonical_name string")
    rolls = spark.createDataFrame([("r1", "x", d(2020, 1, 1)), ("r2", "y", d(2021, 1, 1)), ("r3", "z", None)], "roll_id string, part_id string, date_of_publication date")
    e = spark.createDataFrame([("r1", 1, "K", "a", "active", None), ("r2", 1, "K", "b", "deleted", "S"), ("r3", 1, "K", "c", "active", None)],
                              "roll_id string, serial_no int, epic_no string, full_name string, entry_status string, deletion_reason_code string")
    placed = e.select(F.lit("p").alias("person_id"), "roll_id", "serial_no")
    r = identity.person_current(persons, placed, e, rolls).first()
    assert (r.latest_roll_id, r.name, r.lifecycle_status) == ("r2", "b", "shifted_out")


@pytest.mark.parametrize("threshold", [0.2, 0.333, 0.5, 0.55, 0.667, 1.0])
def test_similar_names_lose_no_match(spark, threshold):
    """Prefix-filtered best matches equal comparing every pair, on a small fixture."""
    rnd = random.Random(1)
    name = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randrange(3, 8)))
    left = [(rnd.choice("xy"), name()) for _ in range(60)]
    right = [(rnd.choice("xy"), name()) for _ in range(60)]
    grams = lambda s: {("  " + s + " ")[i:i + 3] for i in range(len(s) + 1)}
    want = {}
    for b, n in set(left):
        scored = [(-round(len(grams(n) & grams(m)) / len(grams(n) | grams(m)) + 1e-12, 3), m) for c, m in set(right) if c == b]
        scored = [s for s in scored if -s[0] >= threshold]
        if scored:
            want[b, n] = min(scored)[1]
    df = lambda data: spark.createDataFrame(data, "b string, n string")
    got = {(r.b, r.n): r.matched_name for r in identity.similar_names(df(left), df(right), ["b"], "n", threshold).collect()}
    assert got == want


def test_closure_ends_on_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", None), (None, "y"), ("c", "d")], "successor_ac_id string, predecessor_ac_id string")
    seeds = spark.createDataFrame([("a", "a"), ("x", "x")], "root string, ac_id string")
    got = sorted((r.root, r.ac_id) for r in lineage.closure(edges, seeds).collect())
    assert got == [("a", "a"), ("a", "b"), ("a", "c"), ("a", "d"), ("x", "x")]


def test_change_classes(spark):
    edges = spark.createDataFrame(
        [("1", "1"), ("2", "3"), ("4", "5"), ("4", "6"), ("7", "9"), ("8", "9"), (None, "10"), ("11", None), ("12", "12")],
        "predecessor_ac_id string, successor_ac_id string")
    home = F.when(F.col("predecessor_ac_id") == "12", "H1").otherwise("H")
    out = lineage.change_class(edges, pred_no=F.col("predecessor_ac_id"), succ_no=F.col("successor_ac_id"), pred_home=home, succ_home=F.lit("H"))
    got = {(r.predecessor_ac_id, r.successor_ac_id): r.change_class for r in out.collect()}
    assert got == {("1", "1"): "unchanged", ("2", "3"): "renumber", ("4", "5"): "split", ("4", "6"): "split", ("7", "9"): "merge",
                   ("8", "9"): "merge", (None, "10"): "new", ("11", None): "abolished", ("12", "12"): "rehomed"}


def test_null_keeps_and_empty_clears(spark):
    ev = spark.createDataFrame(
        [("a", 1, "failed", "e1"), ("a", 2, "done", None), ("b", 1, "failed", "e1"), ("b", 2, "done", ""), (None, 1, "x", "x")],
        "k string, seq int, stage string, error string")
    got = {r.k: (r.stage, r.error) for r in manifest.latest_state(ev, ["k"], ["seq"], ["stage", "error"], ["error"]).collect()}
    assert got == {"a": ("done", "e1"), "b": ("done", None)}


def test_gates(spark):
    jobs = spark.createDataFrame(
        [(1, "verified", None, True, None), (2, "verified", "done", False, "u"), (3, "pending", None, None, None),
         (4, "verified", "loaded", None, "u"), (5, "verified", "archived", True, None)],
        "id int, status string, stage string, reconciles boolean, archive_uri string")
    assert sorted(r.id for r in manifest.resume_set(jobs).collect()) == [1, 4, 5]
    assert sorted(r.id for r in manifest.resume_set(jobs, force=True).collect()) == [1, 2, 4, 5]
    assert [r.id for r in manifest.clearable(jobs).collect()] == [2]
    assert {r.id: r.gate for r in manifest.qc_gate(jobs, required=True).collect()} == {1: "load", 2: "rejected", 3: "rejected", 4: "rejected", 5: "load"}
    assert {r.gate for r in manifest.qc_gate(jobs).collect()} == {"load", "load_flagged"}


def test_audits(spark):
    state = spark.createDataFrame([("S01",), ("X1",), (None,)], "state_cd string")
    roll = spark.createDataFrame([("r1", "p", 2026, "FinalRoll", None, "ENG"), ("r2", "p", 2026, "FinalRoll", None, "ENG")],
                                 "roll_id string, part_id string, year_of_revision int, roll_type string, revision_no int, language_code string")
    elector = spark.createDataFrame(
        [("r1", 1, -1, "deleted", "E"), ("r1", 1, 5, "active", "E"), ("r9", 2, None, None, None)],
        "roll_id string, serial_no int, age int, entry_status string, deletion_reason_code string")
    found = {(r.table_name, r.rule): r.violations for r in constraints.audit({"state": state, "roll": roll, "elector": elector}).collect()}
    assert found["state", "code shape"] == 1
    assert found["roll", "unique(part_id, year_of_revision, roll_type, revision_no, language_code)"] == 1   # null equals null
    assert found["elector", "age >= 0"] == 1 and found["elector", "reason only when deleted"] == 1
    assert found["elector", "unique(roll_id, serial_no)"] == 1 and found["elector", "roll_id references roll_id"] == 1
    assert found["roll", "known roll type"] == 0


FIELDS = {"name": "name", "relation": "rel", "house": "house", "age": "age"}


def tier2(entry, person):
    def sim(a, b):
        if a is None or b is None:
            return 0
        x, y = ({("  " + t.lower() + " ")[i:i + 3] for i in range(len(t) + 1)} for t in (a, b))
        return (2000 * len(x & y) + len(x | y)) // (2 * len(x | y))
    score = 500 * sim(entry[2], person[1]) + 200 * sim(entry[3], person[2])
    score += 150_000 * (entry[4] is not None and entry[4] == person[3])
    years = None if entry[5] is None or person[4] is None else abs(entry[5] - person[4])
    return score + (0 if years is None else 150_000 if years <= 1 else 75_000 if years <= 2 else 0)


def test_tier2_takes_each_person_once_a_roll_best_first(spark, rows):
    rnd = random.Random(5)
    names = ["anna maria", "anna mary", "ana maria", "bert long", "bert lang", "carl"]
    some = lambda: (rnd.choice(names), rnd.choice(["otto", "otto", "olga", None]), rnd.choice(["1", "2", None]), rnd.choice([30, 31, 32, 40, None]))
    entries = [(roll, serial, *some()) for roll in ("r1", "r2") for serial in range(40)] + [("r1", 99, None, "x", "1", 30)]
    persons = [(f"p{k:02d}", *some()) for k in range(30)]
    prof = lambda t: "a|" + "|".join("" if x is None else str(x) for x in t)
    want, used = [], set()
    pairs = [(-tier2(e, p), prof(e[2:]), prof(p[1:]), e[1], p[0], e[0]) for e in entries if e[2] for p in persons]
    for score, _, _, serial, person, roll in sorted(pairs):
        if -score >= 750_000 and ("e", roll, serial) not in used and ("p", roll, person) not in used:
            used |= {("e", roll, serial), ("p", roll, person)}
            want.append((person, roll, serial, "fuzzy", round(-score / 1_000_000 + 1e-9, 3)))
    left = spark.createDataFrame(entries, "roll_id string, serial_no int, name string, rel string, house string, age int").withColumn("area", F.lit("a"))
    right = spark.createDataFrame(persons, "person_id string, name string, rel string, house string, age int").withColumn("area", F.lit("a"))
    got = [(*r[:4], float(r[4])) for r in identity.place_fuzzy(left, right, ["area"], FIELDS).collect()]
    assert sorted(got) == sorted(want) and len(want) > 20
    assert identity.place_fuzzy(left.withColumn("area", F.lit("b")), right, ["area"], FIELDS).count() == 0


def test_tier2_profiles_are_not_gathered_on_the_driver(spark, monkeypatch):
    """Files of profiles and pairs are small for their rows, so no side of them may be sent to all; equal texts of two profiles place once."""
    plans, cut = [], identity.cut
    monkeypatch.setattr(identity, "cut", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), cut(df))[1])
    shape = "name string, rel string, house string, age int"
    left = spark.createDataFrame([("r1", n, "anna maria", "otto", house, 30) for n, house in enumerate((None, "", "1"))], f"roll_id string, serial_no int, {shape}")
    right = spark.createDataFrame([(f"p{n}", "anna maria", "otto", house, 30) for n, house in enumerate((None, "", "1"))], f"person_id string, {shape}")
    left, right = (df.withColumn("area", F.lit("a")) for df in (left, right))
    got = {(r.serial_no, r.person_id) for r in identity.place_fuzzy(left, right, ["area"], FIELDS).collect()}
    assert got == {(0, "p0"), (1, "p1"), (2, "p2")}
    sent = [line for p in plans for line in p.splitlines() if re.search(r"BroadcastHashJoin \[([^\]]*[ \[])?(l|r|roll_id|__r_name)#", line)]
    assert len(plans) > 10 and not sent, sent


@pytest.mark.parametrize("threshold", (0.55, 0.6, 0.7, 0.75, 0.9))
def test_tier2_profiles_meet_by_more_than_their_names(spark, rows, threshold):
    rnd = random.Random(7)
    some = lambda: (rnd.choice(["anna maria", "anna mary", "ana maria", "bert"]), rnd.choice(["otto", "otta", "olga", "", None]),
                    rnd.choice(["1", " 1", "2", "", None]), rnd.choice([30, 31, 32, 33, None]))
    left, right = {some() for _ in range(150)}, {some() for _ in range(150)}
    shape = "area string, name string, rel string, house string, age int"
    entries, persons = (spark.createDataFrame([("a", *t) for t in side], shape) for side in (left, right))
    found = identity.profile_pairs(entries, persons, ["area"], FIELDS, round(threshold * 1_000_000))
    prof = lambda t: "a|" + "|".join("" if x is None else str(x) for x in t)
    bare = lambda t: (*t[:2], t[2] and t[2].strip(), t[3])
    scored = [(prof(e), prof(p), tier2((0, 0, *bare(e)), (0, *bare(p)))) for e in left for p in right]
    assert rows(found) == sorted((s for s in scored if s[2] >= threshold * 1_000_000), key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    met = [line for line in plan.splitlines() if "Join" in line and "= __r_name" in line and "__l_name" not in line]
    assert met and (threshold < 0.75 or all("= __house" in m or "= __age" in m for m in met))


def test_composite_references(spark, rows):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "a"), (1, None), (3, "z")], "k int, v string")
    parent = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (1, "b", 0), (None, "z", 0)], "p int, q string, o int")
    assert rows(quality.reference_orphans(child, ["k", "v"], parent, ["p", "q"])) == [(2, "a", 1), (3, "z", 1)]
    audit = quality.reference_audit(child, "c", ["k", "v"], parent, ["p", "q"]).first()
    assert tuple(audit) == ("c", "(k, v) references (p, q)", 2)
    assert quality.reference_audit(child.filter("k is null"), "c", ["k", "v"], parent, ["p", "q"]).first().violations == 0


def test_closure_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written, plain = [], lineage.cut
    monkeypatch.setattr(lineage, "cut", lambda df: written.append(1) or plain(df))
    edges = spark.range(1000).selectExpr("concat('a', id + 1) as successor_ac_id", "concat('a', id) as predecessor_ac_id")
    more = [("c1", "c2"), ("c2", "c1"), ("x", None), (None, "y")]
    edges = edges.unionByName(spark.createDataFrame(more, "successor_ac_id string, predecessor_ac_id string"))
    seeds = spark.createDataFrame([("r", "a1000"), ("c", "c1"), ("x", "x")], "root string, ac_id string")
    found = lineage.closure(edges, seeds).groupBy("root").count().collect()
    assert {r.root: r["count"] for r in found} == {"r": 1001, "c": 2, "x": 1}
    assert len(written) <= 2 * 12


def test_areas_inherit_along_lineage(spark):
    areas = spark.createDataFrame([("e1", 1, "x"), ("e1", 2, "y"), ("e1", 4, "x"), ("e2", 1, None), ("e2", 5, "own"), (None, 9, None)], "era string, no int, v string")
    edges = spark.createDataFrame([("e1", 1, "e2", 1), ("e1", 1, "e2", 2), ("e1", 2, "e2", 2), ("e1", 1, "e2", 3), ("e1", 4, "e2", 3), ("e1", 2, "e2", 5),
                                   ("e2", 1, "e3", 1), (None, None, "e3", 7), ("e2", 3, None, None)],
                                  "predecessor_era string, predecessor_no int, era string, no int")
    found = {(r.era, r.no): r.v for r in lineage.inherit(areas, edges, ["era", "no"], "era", ["e1", "e2", "e3"], ["v"]).collect()}
    assert found == {("e1", 1): "x", ("e1", 2): "y", ("e1", 4): "x", ("e2", 1): "x", ("e2", 2): None, ("e2", 3): "x", ("e2", 5): "own",
                     ("e3", 1): "x", ("e3", 7): None, (None, 9): None}


def test_every_declared_rule_parses(spark):
    for table, rules in constraints.CHECKS.items():
        for name, rule in rules.items():
            cols = constraints._columns(rule)
            assert cols, (table, name)
            text = {"row_ordinal", "code", "state_cd", "pin_code"} | {c for c in cols if c.endswith(("status", "type", "code", "method", "gender"))}
            df = spark.createDataFrame([], ", ".join(f"{c} {'string' if c in text else 'int'}" for c in sorted(cols)))
            assert quality.check_audit(df, table, {name: rule}).first().violations == 0


def test_consensus_without_third_reader(spark):
    schema = "k int, name string, age string"
    a = spark.createDataFrame([(1, "x", None), (2, "x", "4"), (3, None, None)], schema)
    b = spark.createDataFrame([(1, "x", None), (2, "y", "4"), (3, "", None)], schema)
    got = {r.k: (r.name, r.flagged) for r in consensus.consensus(a, b, None, "k", ["name", "age"]).collect()}
    assert got == {1: ("x", []), 2: ("x", ["name"]), 3: (None, ["name"])}
    third = spark.createDataFrame([(2, "z", "9"), (1, "q", "q")], schema)
    got = {r.k: (r.name, r.age, r.flagged) for r in consensus.consensus(a, b, third, "k", ["name", "age"]).collect()}
    assert got[2] == ("z", "4", []) and got[1] == ("x", None, [])
    assert sorted(r.k for r in consensus.to_escalate(a, b, "k", ["name", "age"]).collect()) == [2, 3]


def test_scores_by_hand(spark):
    p = spark.createDataFrame([(1, "kitten", ""), (2, "a", "x")], "k int, f string, g string")
    t = spark.createDataFrame([(1, "sitting", ""), (2, "a", "")], "k int, f string, g string")
    s = {r.field: tuple(r) for r in consensus.field_scores(p, t, "k", ["f", "g"]).collect()}
    assert s["f"] == (2, "f", 1, 3, 8) and s["g"] == (2, "g", 1, 1, 2)
    total = consensus.char_accuracy(consensus.field_scores(p, t, "k", ["f", "g"])).first()
    assert total.char_accuracy == 0.6 and total.avg_field_accuracy == 0.5
    r = consensus.positional_scores(spark.createDataFrame([("abcd", "abxdef"), ("", "ab")], "p string, t string"), "p", "t").first()
    assert tuple(r) == (3, 8, 0, 2)


def test_checkpoints_votes_and_holdout(spark):
    ev = spark.createDataFrame([("m", 1, 0.5), ("m", 2, 0.9), ("m", 3, 0.9), ("m", 4, 0.1)], "m string, e int, s double")
    assert consensus.best_checkpoint(ev, ["m"], "s", "e").first().best_epoch == 3
    v = spark.createDataFrame([("k", 2), ("k", 1), ("k", 2), ("k", 1), ("k", None)], "k string, v int")
    assert consensus.mode_vote(v, ["k"], "v").first().v == 1
    pool = spark.range(100).withColumnRenamed("id", "k")
    val, train = consensus.holdout(pool, pool.filter("k < 50"), "k", 10)
    picked = {r.k for r in val.collect()}
    assert len(picked) == 10 and max(picked) < 50 and picked.isdisjoint(r.k for r in train.collect()) and train.count() == 90
    s = spark.createDataFrame([(1, None, None, None), (2, "no_stamp_exclude", False, False), (3, "x", True, None)], "i int, flag string, uncertain boolean, review boolean")
    assert sorted(r.i for r in consensus.trainable(s).collect()) == [1, 3] and [r.i for r in consensus.clean(consensus.trainable(s)).collect()] == [1]


def test_an_image_without_width_ends_no_job(spark):
    tokens = spark.createDataFrame([("i", 1, 0.0, 0.0, 0.0, "x"), ("j", 1, 5.0, 9.0, 0.0, "y")], "image_id string, tok_no int, x double, x2 double, y double, text string")
    got = {r[layout.IMAGE]: r["col"] for r in layout.columns_of(tokens.withColumnRenamed("image_id", layout.IMAGE)).collect()}
    assert got == {"i": 2, "j": 1}


def test_a_null_status_is_active(spark):
    got = spark.createDataFrame([(None, None), ("deleted", None), ("kept", None)], "s string, r string").select(values.lifecycle("s", "r")).collect()
    assert [r[0] for r in got] == ["active", "removed", "active"]


def test_first_name_of_a_tie_is_the_smaller_one(spark, rows):
    seen = spark.createDataFrame([("k", 1, "r", 1, "b"), ("k", 1, "r", 1, "a"), ("k", 2, "q", 1, "A")], "epic_no string, ingest_seq int, roll_id string, serial_no int, full_name string").coalesce(1)
    assert rows(identity.first_appearances(seen)) == [("k", "a", "r")]


def test_a_registry_meets_one_row_per_key(spark, rows):
    seen = spark.createDataFrame([("1", "r", 1, "b"), ("1", "q", 2, "a"), ("1", "q", 2, "c"), ("7", "r", 2, "d")], "epic_no string, roll_id string, serial_no int, full_name string")
    assert rows(identity.first_appearances(seen, seq="roll_id")) == [("1", "a", "q"), ("7", "d", "r")]
    fresh = identity.new_keys(seen, spark.range(2).select(F.col("id").cast("string").alias("epic_no")), seq="roll_id")
    assert [(r.epic_no, r.canonical_name, r.first_roll_id) for r in fresh.collect()] == [("7", "d", "r")]
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("min(")


def test_latest_current(spark, rows):
    """Finding the latest placement before its entry gives what ``person_current`` gives over committed rows."""
    rolls = spark.createDataFrame([("r1", 1, "p1", None), ("r2", 2, "p2", "2020-01-01"), ("r3", 2, "p3", "2021-01-01")], "roll_id string, batch int, part_id string, date_of_publication string")
    rolls = rolls.withColumn("date_of_publication", F.col("date_of_publication").cast("date"))
    entries = spark.createDataFrame(
        [("r1", 1, 1, "A", "a", "active", None), ("r2", 1, 1, "A", "old", "deleted", "E"), ("r2", 2, 1, "A", "b", "deleted", "S"), ("r2", 2, 2, "A", "c", "active", None),
         ("r3", 1, 1, "A", "gone", "active", None), ("r1", 1, 2, "B", "d", "deleted", "E")],
        "roll_id string, batch int, serial_no int, epic_no string, full_name string, entry_status string, deletion_reason_code string")
    placements = entries.select(F.lower("epic_no").alias("person_id"), "roll_id", "batch", "serial_no")
    persons = spark.createDataFrame([("a", None), ("b", "named")], "person_id string, canonical_name string")
    counted = lambda df: df.join(rolls.select("roll_id", "batch"), ["roll_id", "batch"], "left_semi").drop("batch")
    want = identity.person_current(persons, counted(placements), counted(entries), rolls.drop("batch"))
    got = identity.latest_current(persons, placements, entries, rolls)
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 2


def test_plain_tables_are_written_as_they_come(spark, tmp_path):
    sinks.write_table(spark.range(9).repartition(3), str(tmp_path), "t", 1)
    assert len(list((tmp_path / "t" / "batch=1").glob("*.parquet"))) == 3


def test_versions_without_buckets_are_written_as_they_come(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"), "id bigint")
    table.write(spark.range(9).repartition(3), 0)
    table.write(spark.range(9, 12).repartition(2), 1)
    table.compact(1)
    assert len(list((tmp_path / "t" / "version=1" / "base=1").glob("*.parquet"))) >= 1
    table.write(spark.range(12, 21).repartition(3), 2)
    assert len(list((tmp_path / "t" / "version=2" / "base=0").glob("*.parquet"))) == 3
    assert sorted(r.id for r in table.read().collect()) == list(range(21))
