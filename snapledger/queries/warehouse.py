"""The warehouse end to end: loads of orders as documents and lineitem as entries, a replay, and what readers see.

Batch 1 loads every third document and is replayed with half of them; batch 2 loads all others and some of batch 1 anew.
Numbers of areas are redrawn with each era.
"""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapledger import schemas
from snapledger.operators import quality, reconcile
from snapledger.operators.groupwise import first_by
from snapledger.plans import warehouse
from snapledger.plans.rolls import RollBatch
from snapledger.queries.assembly import COVER_TOTAL, COUNTED, PRINTED
from snapledger.queries.identity import _eras
from snapledger.queries.registry import Tables, query
from snapledger.session import cut, shared_dir
from snapledger.sources import sinks

FIRST, REPLAYED, SECOND = "o_orderkey % 3 = 0", "o_orderkey % 6 = 0", "(o_orderkey % 3 <> 0 or o_orderkey % 12 = 0)"
CONTEXT = {
    "roll_id": "cast(o_orderkey as varchar(20))", "state_cd": "concat('S0', cast(o_custkey % 3 + 1 as varchar(1)))",
    "ac_no": "cast(o_custkey % 5 + 1 as int)", "part_no": "cast(o_custkey % 4 + 1 as int)",
}
PUBLISHED = "case when o_orderkey % 10 = 0 then null else cast(o_orderdate as date) end"
PC_NO = "case when extract(year from o_orderdate) < 1998 and o_custkey % 7 < 3 then cast(o_custkey % 5 % 2 + 1 as int) end"
ENTRY = {
    "roll_id": "cast(l_orderkey as varchar(20))", "serial_no": "l_linenumber",
    "epic_no": "case when l_suppkey % 13 = 0 then null else concat('K', cast(l_partkey as varchar(20))) end",
    "gender": "case l_suppkey % 4 when 0 then 'Male' when 1 then 'Female' when 2 then 'ThirdGender' end",
    "status": "case l_returnflag when 'R' then 'deleted' when 'A' then 'added' else case when l_linenumber % 4 = 0 then 'modified' "
              "when l_linenumber % 5 = 0 then null else 'active' end end",
    "deletion_reason_code": "case when l_returnflag = 'R' then case l_suppkey % 6 when 0 then 'E' when 1 then 'S' when 2 then 'R' "
                            "when 3 then 'Q' when 4 then 'M' end end",
    "section_no": "cast(l_linenumber % 4 as int)",
}
_ROOTS: dict[tuple[str, str], str] = {}


def _cover(docs):
    """Documents' printed covers: the few fields given, all others null."""
    shape = StructType.fromDDL(schemas.COVER_PAYLOAD)
    given = {
        "date_of_publication": F.date_format(F.expr(PUBLISHED), "dd-MM-yyyy"), "pc_no": F.expr(PC_NO), "pc_name": F.lit("West"),
        "sections": F.from_json(F.lit('[{"section_no":1,"section_name":"a"},{"section_no":2,"section_name":"b"}]'), shape["sections"].dataType),
        "net_total": F.col("cover_total").cast("int"),
    }
    return docs.select("roll_id", *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])


def _lineage(spark, sf_dir):
    """An area is drawn from the next number of the era before; number 3 takes in number 1 as well."""
    o = Tables(spark, sf_dir).orders
    starts = o.select((F.year("o_orderdate") - F.year("o_orderdate") % 2).alias("a")).distinct().filter("a > 1994")
    states, numbers = F.array(*[F.lit(f"S0{n}") for n in (1, 2, 3)]), F.sequence(F.lit(1), F.lit(5))
    drawn = starts.withColumn("state_cd", F.explode(states)).withColumn("ac_no", F.explode(numbers))
    drawn = drawn.withColumn("from", F.explode(F.when(F.col("ac_no") == 3, F.array(F.lit(4), F.lit(1))).otherwise(F.array(F.col("ac_no") % 5 + 1))))
    return drawn.select(
        F.col("state_cd").alias("predecessor_state_cd"), F.concat(F.lit("era "), F.col("a") - 2).alias("predecessor_era_name"),
        F.col("from").alias("predecessor_ac_no"), "state_cd", F.concat(F.lit("era "), F.col("a")).alias("era_name"), "ac_no",
        F.when(F.col("ac_no") == 3, "merge").otherwise("renumber").alias("change_type"),
    )


def _loaded(spark, sf_dir):
    """The folder of the loaded warehouse; one load serves all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _ROOTS:
        return _ROOTS[key]
    t, root = Tables(spark, sf_dir), f"{shared_dir(spark)}/warehouse-{uuid.uuid4().hex}"
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag")
    once = first_by(lines, ["l_orderkey", "l_linenumber"], [F.col("l_suppkey"), F.col("l_partkey"), F.col("l_returnflag")])
    once = once.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    entries = once.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", *[F.expr(e).alias(c) for c, e in ENTRY.items()], F.concat(F.lit("#"), F.col("l_linenumber")).alias("marker_box"),
    )
    alike = {
        **{c: F.lit(None).cast("string") for c in ("relation_type", "relation_name", "house_number")}, "age": F.lit(None).cast("int"),
        "supplement_no": F.lit(None).cast("int"), "source_page": F.lit(3), "confidence": F.lit(1.0), "flags": F.array().cast("array<string>"),
    }
    entries = cut(entries)
    live = entries.withColumn("entry_status", F.coalesce("status", F.lit("active"))).groupBy("roll_id").agg(*[F.count_if(F.expr(e)).alias(c) for c, e in COUNTED.items()])
    docs = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", *[F.expr(e).alias(c) for c, e in CONTEXT.items()]).join(live, "roll_id", "left").na.fill(0, list(COUNTED))
    docs = cut(docs.select("*", *[F.expr(e).cast("int").alias(c) for c, e in PRINTED.items()], F.expr(COVER_TOTAL).alias("cover_total")))
    eras, lineage = _eras(t.orders), _lineage(spark, sf_dir)

    def load(batch, chosen, letter):
        own = docs.filter(chosen)
        context = own.select(
            *CONTEXT, F.lit("FinalRoll").alias("roll_type"), F.lit("ENG").alias("language_code"), F.lit("x.pdf").alias("source_pdf_filename"),
            F.col("roll_id").alias("source_pdf_sha256"), F.lit(12).alias("total_pages"),
        )
        named = entries.filter(chosen).withColumns({"full_name": F.concat(F.lit(letter), F.col("l_suppkey")), **alike})
        summary = own.select("roll_id", *PRINTED, F.lit(0).alias("num_modifications"), F.lit(None).cast("int").alias("ending_serial_no"))
        parts = F.array(*[F.struct(F.lit(n).alias("row_ordinal"), F.expr(e).alias("total")) for n, e in (("I", "live + deleted - added"), ("II", "added"), ("III", "deleted"), ("IV", "0L"))])
        rows = own.select("roll_id", F.inline(parts))
        missing = {c: F.lit(None) for c in ("row_label", "roll_type_label", "roll_identification", "supplement_no", "male", "female", "third_gender")}
        result = RollBatch(context, named, summary, None, None, None)
        warehouse.load(spark, root, batch, result, _cover(own), eras, rows.withColumns(missing), lineage)

    load(1, FIRST, "n")
    load(1, REPLAYED, "n")
    load(2, SECOND, "m")
    _ROOTS[key] = root
    return root


LOADED_SQL = f"""
    li as (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_suppkey, l_partkey, l_returnflag) = 1),
    x as (select {", ".join(f"{e} as {c}" for c, e in ENTRY.items())}, l_orderkey, l_suppkey from li),
    o as (select *, {", ".join(f"{e} as {c}" for c, e in CONTEXT.items())}, {PUBLISHED} as pub from orders),
    eras as (with y as (select distinct year(o_orderdate) - year(o_orderdate) % 2 as a from orders)
      select 'era ' || a as era_name, a, make_date(a, 2, 19) as f,
        case when exists (select 1 from y z where z.a = y.a + 2) then make_date(a + 2, 2, 19) end as t from y),
    d as (select o.*, coalesce(era_name, 'none') as era_name from o left join eras on f <= pub and (t is null or pub < t)),
    b as (select *, 1 as batch, 'n' as letter from d where {REPLAYED} union all select *, 2, 'm' from d where {SECOND}),
    v as (select * from b qualify row_number() over (partition by roll_id order by batch desc) = 1),
    e as (select b.batch, x.* replace (coalesce(x.status, 'active') as status), b.letter || x.l_suppkey as full_name from b join x on x.roll_id = b.roll_id),
    k as (select v.o_orderkey as roll_no, v.roll_id, count(e.roll_id) as cards_printed,
        {", ".join(f"count(*) filter (where {s.replace('entry_status', 'e.status')}) as {c}" for c, s in COUNTED.items())},
        count(*) filter (where e.status = 'modified') as modified
      from v left join e on e.roll_id = v.roll_id and e.batch = v.batch group by 1, 2),
    s as (select *, {", ".join(f"{s.replace('roll_id', 'roll_no')} as {c}" for c, s in PRINTED.items())}, {COVER_TOTAL.replace('roll_id', 'roll_no')} as cover_total from k)
"""


@query(
    "warehouse_reconciliation",
    f"""
    with {LOADED_SQL}
    select roll_id, cards_printed, deleted as deletions, added as additions, modified as modifications, live as live_cards, male as live_male,
      female as live_female, third as live_third_gender, net_total as summary_net_total, cover_total as cover_net_total,
      net_total is not null as has_summary, cover_total = net_total as cover_matches_summary,
      coalesce(live = net_total and (cover_total is null or cover_total = net_total) and (net_male is null or male = net_male)
        and (net_female is null or female = net_female) and (net_third_gender is null or third = net_third_gender), false) as reconciles
    from s
    """,
)
def warehouse_reconciliation(spark, sf_dir):
    warehouse.register_views(spark, _loaded(spark, sf_dir))
    return spark.table("v_roll_reconciliation")


@query(
    "warehouse_persons",
    f"""
    with {LOADED_SQL},
    named as (select epic_no, arg_min(full_name, (batch, roll_id, serial_no)) as name from e where epic_no is not null group by 1)
    select sha256('key|' || e.epic_no) as person_id, e.epic_no, n.name, e.roll_id as latest_roll_id,
      concat_ws('/', v.state_cd, v.era_name, v.ac_no, v.part_no) as latest_part_id, cast(v.pub as varchar) as latest_publication,
      e.status as entry_status, e.deletion_reason_code,
      case when e.status <> 'deleted' then 'active' when e.deletion_reason_code = 'E' then 'deceased' when e.deletion_reason_code = 'S' then 'shifted_out'
        when e.deletion_reason_code = 'R' then 'removed_duplicate' when e.deletion_reason_code = 'Q' then 'disqualified'
        when e.deletion_reason_code = 'M' then 'removed_missing' else 'removed' end as lifecycle_status
    from e join v on v.roll_id = e.roll_id and v.batch = e.batch join named n on n.epic_no = e.epic_no
    qualify row_number() over (partition by e.epic_no order by v.pub desc nulls last, e.roll_id desc, e.serial_no desc) = 1
    """,
)
def warehouse_persons(spark, sf_dir):
    warehouse.register_views(spark, _loaded(spark, sf_dir))
    return spark.table("v_person_current").withColumn("latest_publication", F.col("latest_publication").cast("string"))


def _inherited(rounds: int) -> str:
    """Areas filled era by era: the value that their predecessors agree on."""
    text = ""
    for n in range(1, rounds + 1):
        text += f""",
    r{n} as (select a.state_cd, a.era_name, a.ac_no, a.era_rank, a.ac_name, coalesce(a.pc_no, case when a.era_rank = {n} then g.pc_no end) as pc_no
      from r{n - 1} a left join (select h.state_cd, h.era_name, h.ac_no, case when min(p.pc_no) = max(p.pc_no) then min(p.pc_no) end as pc_no
        from edges h join r{n - 1} p on p.state_cd = h.state_cd and p.era_name = h.before and p.ac_no = h.from_no group by 1, 2, 3) g
      using (state_cd, era_name, ac_no))"""
    return text


@query(
    "warehouse_areas",
    f"""
    with {LOADED_SQL},
    own as (select state_cd, era_name, ac_no, arg_min(coalesce({PC_NO}, -1), (batch, roll_id)) as pc, count(distinct roll_id) as rolls from b
      join (select roll_id as rid, max(batch) over (partition by roll_id) as last from b) l on rid = roll_id group by 1, 2, 3),
    numbers as (select 'S0' || s as state_cd, n as ac_no from range(1, 4) a(s), range(1, 6) c(n)),
    edges as (select state_cd, ac_no, 'era ' || a as era_name, 'era ' || (a - 2) as before, unnest(case when ac_no = 3 then [4, 1] else [ac_no % 5 + 1] end) as from_no
      from numbers, eras where a > 1994),
    r0 as (select n.state_cd, n.era_name, n.ac_no, coalesce((a - 1994) // 2, -1) as era_rank, case when pc is not null then 'AC ' || n.ac_no end as ac_name, nullif(pc, -1) as pc_no
      from (select state_cd, era_name, ac_no from own union select state_cd, era_name, ac_no from edges) n
      left join own using (state_cd, era_name, ac_no) left join eras using (era_name)){_inherited(3)}
    select state_cd, era_name, cast(ac_no as integer) as ac_no, ac_name, cast(pc_no as integer) as pc_no, coalesce(seen, 0) as rolls, coalesce(parts, 0) as parts from r3
    left join (select state_cd, era_name, ac_no, count(*) as seen, count(distinct part_no) as parts from v group by 1, 2, 3) using (state_cd, era_name, ac_no)
    """,
)
def warehouse_areas(spark, sf_dir):
    """Areas of all eras under their own numbers, with what they inherit and how many documents and parts they have."""
    root = _loaded(spark, sf_dir)
    eras = [r["era_name"] for r in _eras(Tables(spark, sf_dir).orders).orderBy("effective_from").collect()]
    rolls = sinks.read_facts(spark, root, "roll").groupBy("state_cd", "era_name", "ac_no").agg(
        F.count("*").alias("rolls"), F.count_distinct("part_id").alias("parts"))
    found = warehouse.areas(spark, root, eras).join(rolls, ["state_cd", "era_name", "ac_no"], "left").na.fill(0, ["rolls", "parts"])
    return found.select("state_cd", "era_name", "ac_no", "ac_name", "pc_no", "rolls", "parts")


@query(
    "warehouse_components",
    f"""
    with {LOADED_SQL}
    select roll_id, cast(live as bigint) as total_sum, live = net_total as total_holds from s
    """,
)
def warehouse_components(spark, sf_dir):
    """The loaded component rows of printed totals against the net that is printed."""
    root = _loaded(spark, sf_dir)
    rows, summary = sinks.read_facts(spark, root, "summary_row"), sinks.read_facts(spark, root, "summary")
    return reconcile.component_identity(rows, summary, measures=(("total", "net_total"),)).select("roll_id", "total_sum", "total_holds")


CHILD = {
    "s": "case when l_suppkey % 7 = 0 then null else l_suppkey end", "n": "case when l_partkey % 11 = 0 then null else l_linenumber end",
    "era": "case when l_quantity > 40 then 'era 1996' else 'era 1998' end",
}
PARENT = {"s": "s_suppkey", "n": "s_nationkey % 7 + 1", "era": "case when s_suppkey % 2 = 0 then 'era 1996' else 'era 1998' end"}


@query(
    "fk_composite",
    f"""
    with c as (select {", ".join(f"{e} as {c}" for c, e in CHILD.items())} from lineitem),
    p as (select {", ".join(f"{e} as {c}" for c, e in PARENT.items())} from supplier)
    select s, n, era, count(*) as rows from c where s is not null and n is not null and not exists
      (select 1 from p where p.s = c.s and p.n = c.n and p.era = c.era) group by 1, 2, 3
    """,
)
def fk_composite(spark, sf_dir):
    """References of three columns, one the era, that have no target; a null in any column exempts the row."""
    t = Tables(spark, sf_dir)
    child = t.lineitem.select(*[F.expr(e).alias(c) for c, e in CHILD.items()])
    parent = t.supplier.select(*[F.expr(e).alias(c) for c, e in PARENT.items()])
    return quality.reference_orphans(child, list(CHILD), parent, list(PARENT))
