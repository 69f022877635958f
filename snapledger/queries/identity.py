"""Persons across documents: keys are parts or customers, documents are orders."""

from pyspark.sql import functions as F

from snapledger.operators import identity, lineage, manifest, resolve
from snapledger.queries.registry import Tables, query

KEY = "case when l_suppkey % 13 = 0 then null else concat('K', cast(l_partkey as varchar(20))) end"
NAME = "concat('n', cast(l_suppkey as varchar(20)))"


def _entries(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rolls = t.orders.select(F.col("o_orderkey").alias("roll_id"), F.col("o_orderdate").alias("ingest_seq"))
    entries = t.lineitem.select(
        F.col("l_orderkey").alias("roll_id"), F.col("l_linenumber").alias("serial_no"), F.expr(KEY).alias("epic_no"),
        F.expr(NAME).alias("full_name"),
    )
    return entries.join(rolls, "roll_id")


ENTRY_SQL = f"""
    e as (select l_orderkey, l_linenumber, {KEY} as k, {NAME} as nm, o_orderdate from lineitem
          join orders on o_orderkey = l_orderkey)
"""


@query(
    "identity_tier1",
    f"""
    with {ENTRY_SQL}
    select sha256('key|' || k) as person_id, k as epic_no,
      arg_min(nm, (o_orderdate, l_linenumber, l_orderkey, nm)) as canonical_name,
      arg_min(l_orderkey, (o_orderdate, l_linenumber, l_orderkey, nm)) as first_roll_id, count(*) as placements
    from e where k is not null group by k
    """,
)
def identity_tier1(spark, sf_dir):
    entries = _entries(spark, sf_dir).withColumn("serial_no", F.struct("serial_no", "roll_id", "full_name"))
    persons = identity.new_keys(entries)
    placements = identity.place(entries, persons).groupBy("person_id").agg(F.count("*").alias("placements"))
    return persons.join(placements, "person_id")


@query(
    "person_chain",
    f"""
    with {ENTRY_SQL},
    o as (select l_orderkey, k, min(l_linenumber) as serial_no from e where k is not null group by 1, 2),
    r as (select distinct k, cast(substr(k, 2) as bigint) as p from e where k is not null),
    f as (select r.k, min(a.p) as into_p from r join r a on a.p between r.p - r.p % 4 and r.p and
            not exists (select 1 from range(1, 4) d(i) where r.p - i >= a.p and not exists
              (select 1 from r b where b.p = r.p - i)) group by r.k)
    select sha256('key|K' || f.into_p) as person_id, count(*) as placements, count(distinct o.k) as keys,
      cast(sum(serial_no) as bigint) as serial_sum
    from o join f on f.k = o.k group by 1
    """,
)
def person_chain(spark, sf_dir):
    """Part k folds into part k - 1 of its block of four where both exist, so chains have up to three links."""
    entries = _entries(spark, sf_dir)
    _, registry = identity.register(entries)
    number = registry.select("person_id", F.expr("cast(substr(epic_no, 2) as bigint)").alias("p"))
    below = number.select(F.col("person_id").alias("into_id"), (F.col("p") + 1).alias("p"))
    merges = number.filter("p % 4 <> 0").join(below, "p").select("person_id", "into_id")
    folded = identity.apply_merges(registry, identity.fold_chains(merges))
    once = identity.one_per_key(entries, ties=["full_name"])
    placed = identity.place(once.withColumn("k", F.col("epic_no")), folded)
    keys = folded.groupBy("person_id").agg(F.count("*").alias("keys"))
    return placed.groupBy("person_id").agg(
        F.count("*").alias("placements"), F.sum("serial_no").alias("serial_sum")
    ).join(keys, "person_id")


STATUS = "case o_orderstatus when 'F' then 'deleted' when 'P' then 'modified' else 'active' end"
REASON = ("case when o_orderstatus <> 'F' then null when o_orderpriority = '1-URGENT' then 'E' "
          "when o_orderpriority = '2-HIGH' then 'S' when o_orderpriority = '3-MEDIUM' then 'R' "
          "when o_orderpriority = '5-LOW' then 'Q' end")
PUBLISHED = "case when o_orderkey % 10 = 0 then null else cast(o_orderdate as date) end"
SEEN_SQL = f"""
    s as (select o_custkey, o_orderkey, o_orderpriority, o_orderdate, {STATUS} as st, {REASON} as re,
          {PUBLISHED} as pub from orders)
"""


def _person_tables(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.withColumns({"st": F.expr(STATUS), "re": F.expr(REASON), "pub": F.expr(PUBLISHED)})
    rolls = o.select(F.col("o_orderkey").alias("roll_id"), F.col("o_orderpriority").alias("part_id"),
                     F.col("pub").alias("date_of_publication"))
    entries = o.select(
        F.col("o_orderkey").alias("roll_id"), F.lit(1).alias("serial_no"),
        F.col("o_custkey").cast("string").alias("epic_no"), F.lit("x").alias("full_name"),
        F.col("st").alias("entry_status"), F.col("re").alias("deletion_reason_code"),
    )
    persons = t.customer.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("canonical_name"))
    placements = o.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("roll_id"),
                          F.lit(1).alias("serial_no"))
    return persons, placements, entries, rolls


@query(
    "person_current",
    f"""
    with {SEEN_SQL},
    l as (select * from s join customer on c_custkey = o_custkey
          qualify row_number() over (partition by o_custkey order by pub desc nulls last, o_orderkey desc) = 1)
    select o_custkey as person_id, c_name as name, o_orderkey as latest_roll_id, o_orderpriority as latest_part_id,
      cast(pub as varchar) as latest_publication, st as entry_status, re as deletion_reason_code,
      case when st <> 'deleted' then 'active' when re = 'E' then 'deceased' when re = 'S' then 'shifted_out'
        when re = 'R' then 'removed_duplicate' when re = 'Q' then 'disqualified' when re = 'M' then 'removed_missing'
        else 'removed' end as lifecycle_status from l
    """,
)
def person_current(spark, sf_dir):
    out = identity.person_current(*_person_tables(spark, sf_dir))
    return out.drop("epic_no").withColumn("latest_publication", F.col("latest_publication").cast("string"))


@query(
    "person_timeline",
    f"""
    with {SEEN_SQL},
    p as (select *, lag(o_orderpriority) over w as pp, lag(st) over w as ps from s
          window w as (partition by o_custkey order by o_orderdate, o_orderkey))
    select o_custkey as person_id, o_orderkey as roll_id, pp as prev_place, ps as prev_status,
      coalesce(pp is not null and pp <> o_orderpriority, false) as moved,
      coalesce(ps is not null and ps <> st, false) as status_changed from p
    """,
)
def person_timeline(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    seen = o.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("roll_id"), "o_orderdate",
                    "o_orderpriority", F.expr(STATUS).alias("st"))
    month = F.date_trunc("month", "o_orderdate")
    out = identity.timeline(seen, ["person_id"], ["o_orderdate", "roll_id"], "o_orderpriority", "st", month)
    return out.select("person_id", "roll_id", "prev_place", "prev_status", "moved", "status_changed")


@query(
    "fuzzy_match",
    """
    with n as (select distinct p_brand, p_name, p_partkey % 2 as side from part),
    g as (select p_brand, p_name, side, list_distinct(list_transform(range(1, length(p_name) + 2),
            lambda i: substr('  ' || lower(p_name) || ' ', i, 3))) as t from n),
    s as (select l.p_brand, l.p_name, r.p_name as m, len(list_intersect(l.t, r.t)) as c, len(l.t) as a, len(r.t) as b
          from g l join g r on l.p_brand = r.p_brand and l.side = 1 and r.side = 0),
    b as (select p_brand, p_name, m, round(c / (a + b - c), 3) as score from s where round(c / (a + b - c), 3) >= 0.4
          qualify row_number() over (partition by p_brand, p_name order by round(c / (a + b - c), 3) desc, m) = 1)
    select p_partkey, m as matched_name, score from part left join b using (p_brand, p_name) where p_partkey % 2 = 1
    """,
)
def fuzzy_match(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_brand", "p_name")
    rows, persons = p.filter("p_partkey % 2 = 1"), p.filter("p_partkey % 2 = 0")
    return identity.fuzzy_match(rows, persons, ["p_brand"], "p_name", 0.4).select("p_partkey", "matched_name", "score")


TIER2 = {
    "area": "cast(floor(p_partkey / 2) as int) % 4", "name": "case when p_partkey % 6 = 1 then substr(p_name, 1, length(p_name) - 2) else p_name end",
    "relation": "case when p_partkey % 17 = 0 then null else p_type end", "house": "cast(p_size % 9 as varchar(9))", "age": "cast(p_partkey % 23 + 18 as int)",
}
TIER2_SQL = ", ".join(f"{e} as {c}" for c, e in TIER2.items())


def _rounds(n: int) -> str:
    """Greedy assignment: again and again the pairs that come first for their entry and their person."""
    text = ""
    for k in range(n):
        text += f""",
    f{k} as materialized (select * from p{k} qualify row_number() over (partition by roll_id, serial_no order by score desc, l, r, serial_no, person_id) = 1
      and row_number() over (partition by roll_id, person_id order by score desc, l, r, serial_no, person_id) = 1),
    p{k + 1} as materialized (select p.* from p{k} p where not exists (select 1 from f{k} f where f.roll_id = p.roll_id and f.serial_no = p.serial_no)
      and not exists (select 1 from f{k} f where f.roll_id = p.roll_id and f.person_id = p.person_id))"""
    return text + "\n    select * from (" + " union all ".join(f"select * from f{k}" for k in range(n)) + ")"


@query(
    "fuzzy_placements",
    f"""
    with d as (select p_partkey, p_partkey % 5 as roll_id, p_partkey % 2 as side, {TIER2_SQL} from part),
    g as (select *, area || '|' || name || '|' || coalesce(relation, '') || '|' || house || '|' || age as prof,
        list_distinct(list_transform(range(1, length(name) + 2), lambda i: substr('  ' || lower(name) || ' ', i, 3))) as tn,
        list_distinct(list_transform(range(1, length(relation) + 2), lambda i: substr('  ' || lower(relation) || ' ', i, 3))) as tr from d),
    c as (select a.roll_id, a.p_partkey as serial_no, b.p_partkey as person_id, a.prof as l, b.prof as r, len(list_intersect(a.tn, b.tn)) as cn,
        len(a.tn) + len(b.tn) as un, len(list_intersect(a.tr, b.tr)) as cr, len(a.tr) + len(b.tr) as ur, a.house = b.house as same, abs(a.age - b.age) as years
      from g a join g b on a.area = b.area and a.side = 1 and b.side = 0),
    p0 as materialized (select roll_id, serial_no, person_id, l, r, 500 * ((2000 * cn + un - cn) // (2 * (un - cn))) + 200 * coalesce((2000 * cr + ur - cr) // (2 * (ur - cr)), 0)
        + case when same then 150000 else 0 end + case when years <= 1 then 150000 when years <= 2 then 75000 else 0 end as score from c
      where score >= 750000){_rounds(16)}
    """.replace("select * from (select * from f0", "select person_id, roll_id, serial_no, 'fuzzy' as match_method, cast(round(score / 1000000, 3) as varchar) as match_confidence from (select * from f0"),
)
def fuzzy_placements(spark, sf_dir):
    """Odd parts as entries without a key, even ones as persons, matched over four fields, each person once a roll."""
    d = Tables(spark, sf_dir).part.select("p_partkey", (F.col("p_partkey") % 5).alias("roll_id"), *[F.expr(e).alias(c) for c, e in TIER2.items()])
    entries = d.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "serial_no")
    persons = d.filter("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "person_id")
    found = identity.place_fuzzy(entries, persons, ["area"], {c: c for c in ("name", "relation", "house", "age")})
    return found.withColumn("match_confidence", F.col("match_confidence").cast("double").cast("string"))


# area lineage drawn from orders: area c of era y comes from area (c - c % 7) of era y - 1; a few
# orders make an edge back, so that the graph has cycles
EDGE = ("concat(cast(o_custkey as varchar(20)), '@', cast(year(o_orderdate) as varchar(9)))",
        "case when o_orderkey % 97 = 0 then null when o_orderkey % 41 = 0 then "
        "concat(cast(o_custkey as varchar(20)), '@', cast(year(o_orderdate) as varchar(9))) else "
        "concat(cast(o_custkey - o_custkey % 7 as varchar(20)), '@', cast(year(o_orderdate) - 1 as varchar(9))) end")
EDGE_SQL = f"e as (select distinct {EDGE[0]} as succ, {EDGE[1]} as pred from orders)"


def _edges(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select(F.expr(EDGE[0]).alias("successor_ac_id"), F.expr(EDGE[1]).alias("predecessor_ac_id")).distinct()


@query(
    "lineage_closure",
    f"""
    with recursive {EDGE_SQL},
    l as (select distinct succ as root, succ as ac_id from e where succ like '%@1998'
          union select l.root, e.pred from l join e on e.succ = l.ac_id where e.pred is not null)
    select root, ac_id from l
    """,
)
def lineage_closure(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    roots = edges.filter(F.col("successor_ac_id").endswith("@1998")).select(
        F.col("successor_ac_id").alias("root"), F.col("successor_ac_id").alias("ac_id")
    )
    return lineage.closure(edges, roots)


@query(
    "lineage_class",
    f"""
    with {EDGE_SQL},
    d as (select *, count(pred) over (partition by succ) as ins, count(succ) over (partition by pred) as outs from e)
    select succ as successor_ac_id, pred as predecessor_ac_id,
      case when pred is null then 'new' when succ is null then 'abolished' when outs > 1 then 'split'
        when ins > 1 then 'merge' when split_part(pred, '@', 1) <> split_part(succ, '@', 1) then 'renumber'
        else 'unchanged' end as change_class from d
    """,
)
def lineage_class(spark, sf_dir):
    number = lambda c: F.substring_index(F.col(c), "@", 1)
    return lineage.change_class(
        _edges(spark, sf_dir), pred_no=number("predecessor_ac_id"), succ_no=number("successor_ac_id")
    ).select("successor_ac_id", "predecessor_ac_id", "change_class")


# eras of two years each, taken from the order dates themselves; the latest one is open
@query(
    "era_lookup",
    """
    with y as (select distinct year(o_orderdate) - year(o_orderdate) % 2 as a from orders),
    e as (select 'era ' || a as era_name, make_date(a, 2, 19) as f,
            case when exists (select 1 from y z where z.a = y.a + 2) then make_date(a + 2, 2, 19) end as t from y)
    select o_orderkey, era_name from orders left join e on f <= o_orderdate::date and
      (t is null or o_orderdate::date < t)
    """,
)
def era_lookup(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return resolve.era_of(o, _eras(o), "o_orderdate").select("o_orderkey", "era_name")


def _eras(o):
    y = F.year("o_orderdate")
    starts = o.select((y - y % 2).alias("a")).distinct()
    later = starts.select((F.col("a") - 2).alias("a"), F.lit(True).alias("ends"))
    return starts.join(later, "a", "left").select(
        F.concat(F.lit("era "), F.col("a").cast("string")).alias("era_name"),
        F.make_date("a", F.lit(2), F.lit(19)).alias("effective_from"),
        F.when(F.col("ends"), F.make_date(F.col("a") + 2, F.lit(2), F.lit(19))).alias("effective_to"),
    )


@query(
    "era_latest",
    """
    with o as (select c_nationkey, o_orderkey, case when o_orderkey % 10 = 0 then null else cast(o_orderdate as date) end
               as pub from orders join customer on c_custkey = o_custkey)
    select c_nationkey, cast(max(pub) as varchar) as latest_publication, count(*) as rolls from o group by 1
    """,
)
def era_latest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    published = o.select("c_nationkey", F.expr(PUBLISHED).cast("string").alias("date_of_publication"))
    return manifest.latest_publication(published, ["c_nationkey"])


@query(
    "era_scope",
    """
    with y as (select distinct year(o_orderdate) - year(o_orderdate) % 2 as a from orders),
    e as (select 'era ' || a as era_name, make_date(a, 2, 19) as f,
            case when exists (select 1 from y z where z.a = y.a + 2) then make_date(a + 2, 2, 19) end as t from y)
    select era_name, o_custkey, count(*) as rolls from orders left join e on f <= o_orderdate::date and
      (t is null or o_orderdate::date < t) group by 1, 2
    """,
)
def era_scope(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lineage.era_scoped(resolve.era_of(o, _eras(o), "o_orderdate"), ["o_custkey"])


@query(
    "lineage_rolls",
    f"""
    with recursive {EDGE_SQL},
    l as (select distinct succ as root, succ as ac_id from e where succ like '%@1998'
          union select l.root, e.pred from l join e on e.succ = l.ac_id where e.pred is not null)
    select root, ac_id, o_orderkey as roll_id, cast(cast(o_orderdate as date) as varchar) as date_of_publication
    from l join orders on {EDGE[0]} = l.ac_id
    """,
)
def lineage_rolls(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    parts = o.select(F.col("o_orderkey").alias("part_id"), F.expr(EDGE[0]).alias("ac_id"))
    rolls = o.select(F.col("o_orderkey").alias("part_id"), F.col("o_orderkey").alias("roll_id"),
                     F.col("o_orderdate").cast("date").cast("string").alias("date_of_publication"))
    return lineage.rolls_of(lineage_closure(spark, sf_dir), parts, rolls).select(
        "root", "ac_id", "roll_id", "date_of_publication"
    )
