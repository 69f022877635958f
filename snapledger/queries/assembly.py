"""Reads -> cards -> reconciliation, on orders (documents) and lineitem (entries)."""

from pyspark.sql import functions as F

from snapledger.functions import cards, values
from snapledger.operators import assemble, reconcile, resolve
from snapledger.plans import rolls as rolls_plan
from snapledger.queries.registry import Tables, query

ENTRY = {
    "roll_id": "l_orderkey",
    "entry_status": "case l_returnflag when 'R' then 'deleted' when 'A' then 'added' "
                    "else case when l_linenumber % 4 = 0 then 'modified' when l_linenumber % 5 = 0 then null "
                    "else 'active' end end",
    "gender": "case l_suppkey % 4 when 0 then 'Male' when 1 then 'Female' when 2 then 'ThirdGender' end",
}
ENTRY_SQL = "select " + ", ".join(f"{v} as {k}" for k, v in ENTRY.items()) + " from lineitem"

# printed totals: right for most documents, off by one, or not printed, by document number
PRINTED = {
    "net_total": "case when roll_id % 16 = 1 then null when roll_id % 8 = 0 then live + 1 else live end",
    "net_male": "case when roll_id % 6 = 5 then null else male end",
    "net_female": "case when roll_id % 9 = 4 then female + 1 else female end",
    "net_third_gender": "third",
    "additions_total": "case when roll_id % 7 = 3 then added + 1 when roll_id % 7 = 4 then null else added end",
    "deletions_total": "case when roll_id % 11 = 6 then deleted - 1 else deleted end",
}
COVER_TOTAL = "case when roll_id % 5 = 0 then null when roll_id % 8 = 3 then live + 1 else live end"
COUNTED = {
    "live": "entry_status <> 'deleted'", "male": "entry_status <> 'deleted' and gender = 'Male'",
    "female": "entry_status <> 'deleted' and gender = 'Female'",
    "third": "entry_status <> 'deleted' and gender = 'ThirdGender'",
    "added": "entry_status = 'added'", "deleted": "entry_status = 'deleted'",
}
BASE_SQL = f"""
    e as (select roll_id, coalesce(entry_status, 'active') as entry_status, gender from ({ENTRY_SQL}) x),
    k as (select o_orderkey as roll_id, count(e.roll_id) as cards_printed,
            {", ".join(f"count(*) filter (where {v}) as {k}" for k, v in COUNTED.items())},
            count(*) filter (where entry_status = 'modified') as modified
          from orders left join e on e.roll_id = o_orderkey group by o_orderkey),
    s as (select *, {", ".join(f"{v} as {k}" for k, v in PRINTED.items())}, {COVER_TOTAL} as cover_total from k)
"""


def _documents(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rolls = t.orders.select(F.col("o_orderkey").alias("roll_id"))
    entries = t.lineitem.select(*[F.expr(v).alias(k) for k, v in ENTRY.items()])
    status = F.coalesce("entry_status", F.lit("active"))
    counted = entries.withColumn("entry_status", status).groupBy("roll_id").agg(
        *[F.count_if(F.expr(v)).alias(k) for k, v in COUNTED.items()]
    )
    found = rolls.join(counted, "roll_id", "left").na.fill(0)
    printed = found.select("roll_id", *[F.expr(v).alias(k) for k, v in PRINTED.items()], F.expr(COVER_TOTAL).alias("cover_total"))
    return rolls, entries, printed


@query(
    "recon_view",
    f"""
    with {BASE_SQL}
    select roll_id, cards_printed, deleted as deletions, added as additions, modified as modifications,
      live as live_cards, male as live_male, female as live_female, third as live_third_gender,
      net_total as summary_net_total, cover_total as cover_net_total, net_total is not null as has_summary,
      cover_total = net_total as cover_matches_summary,
      coalesce(live = net_total and (cover_total is null or cover_total = net_total)
        and (net_male is null or male = net_male) and (net_female is null or female = net_female)
        and (net_third_gender is null or third = net_third_gender), false) as reconciles
    from s
    """,
)
def recon_view(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rolls = t.orders.select(F.col("o_orderkey").alias("roll_id"))
    counts = reconcile.counted(rolls, t.lineitem.select(*[F.expr(v).alias(k) for k, v in ENTRY.items()]), "roll_id", "entry_status")
    # what the documents print is made from the counts themselves, so all comes from one aggregate over the entries
    named = {"live": "live_cards", "male": "live_male", "female": "live_female", "third": "live_third_gender"}
    known = counts.withColumns({k: F.col(v) for k, v in named.items()})
    totals = {c: F.expr(PRINTED[c]) for c in reconcile.NETS} | {"summary_net_total": F.expr(PRINTED["net_total"]), "cover_net_total": F.expr(COVER_TOTAL)}
    out = reconcile.judged(known.withColumns(totals).drop(*named))
    return out


CHECK_NAMES = ("net_total", "net_male", "net_female", "net_third_gender", "additions", "deletions", "has_summary")


@query(
    "recon_checks",
    f"""
    with {BASE_SQL},
    c as (select roll_id, coalesce(net_total = live, true) as ok_net_total,
        coalesce(net_male = male, true) as ok_net_male, coalesce(net_female = female, true) as ok_net_female,
        coalesce(net_third_gender = third, true) as ok_net_third_gender,
        coalesce(additions_total = added, true) as ok_additions,
        coalesce(deletions_total = deleted, true) as ok_deletions, net_total is not null as ok_has_summary from s)
    select *, {" and ".join(f"ok_{c}" for c in CHECK_NAMES)} as reconciles from c
    """,
)
def recon_checks(spark, sf_dir):
    rolls, entries, summary = _documents(spark, sf_dir)
    out = reconcile.reconcile(rolls, entries, summary, status="entry_status")
    return out.select("roll_id", *[F.col("checks")[c].alias(f"ok_{c}") for c in CHECK_NAMES], "reconciles")


@query(
    "component_identity",
    """
    with r as (select l_suppkey, case l_linenumber % 4 when 0 then 'I' when 1 then 'II' when 2 then 'III' else 'IV' end
                 as ordinal, cast(l_quantity as bigint) as q from lineitem),
    s as (select l_suppkey as roll_id, cast(sum(case ordinal when 'III' then -q else q end) as bigint) as total_sum
          from r group by 1)
    select roll_id, total_sum, total_sum = case when roll_id % 5 = 0 then total_sum + 1 when roll_id % 7 = 0 then null
      else total_sum end as total_holds from s
    """,
)
def component_identity(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    ordinal = "case l_linenumber % 4 when 0 then 'I' when 1 then 'II' when 2 then 'III' else 'IV' end"
    rows = li.select(
        F.col("l_suppkey").alias("roll_id"), F.expr(ordinal).alias("row_ordinal"),
        F.col("l_quantity").cast("bigint").alias("total"),
    )
    net = "sum(case row_ordinal when 'III' then -total else total end)"
    summary = rows.groupBy("roll_id").agg(F.expr(net).alias("n")).select(
        "roll_id",
        F.expr("case when roll_id % 5 = 0 then n + 1 when roll_id % 7 = 0 then null else n end").alias("net_total"),
    )
    out = reconcile.component_identity(rows, summary, measures=(("total", "net_total"),))
    return out.select("roll_id", "total_sum", "total_holds")


READ = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_discount", "l_tax", "l_shipdate",
        "l_quantity", "l_extendedprice")
ARRIVAL = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag")
SCORE_SQL = ("(case when l_returnflag <> 'N' then 1 else 0 end + case when l_discount <> 0 then 1 else 0 end "
             "+ case when l_tax <> 0 then 1 else 0 end)")


def _best(li):
    score = cards.completeness([F.nullif("l_returnflag", F.lit("N"))], ["l_discount", "l_tax"])
    return assemble.best_reads(li.select(*READ), ("l_orderkey", "l_linenumber"), ARRIVAL, score).withColumn(
        "score", score
    )


BEST_SQL = f"""
    select *, {SCORE_SQL} as score from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
                               order by {SCORE_SQL} desc, {", ".join(ARRIVAL)}) = 1
"""


@query("dedupe_best_read", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, score from ({BEST_SQL}) b")
def dedupe_best_read(spark, sf_dir):
    best = _best(Tables(spark, sf_dir).lineitem)
    return best.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "score")


REGION = "case l_returnflag when 'A' then 'additions' when 'R' then 'deletions' else 'main_roll' end"


@query(
    "section_guard",
    f"""
    with b as (select l_orderkey, l_linenumber, {REGION} as region from ({BEST_SQL}) x),
    m as (select *, max(case when region = 'main_roll' then l_linenumber end) over (partition by l_orderkey) as top
          from b)
    select l_orderkey, l_linenumber, case when region <> 'main_roll' and l_linenumber <= top then 'main_roll'
      else region end as region from m
    """,
)
def section_guard(spark, sf_dir):
    best = _best(Tables(spark, sf_dir).lineitem).select("l_orderkey", "l_linenumber", F.expr(REGION).alias("region"))
    return assemble.guard_sections(best, "l_orderkey", "l_linenumber")


HEADER = (
    "case when role = 'system' then concat('List of Additions ', cast(turn + conv_id % 3 as varchar(9)), ' (..)') "
    "when role = 'user' and conv_id % 3 = 0 and turn % 4 = 2 then 'Section No and Name 1-Block' "
    "when role = 'assistant' and conv_id % 2 = 1 and turn % 4 = 1 then 'List of Deletions 2' else '' end"
)


@query(
    "carry_forward",
    f"""
    with h as (select conv_id, turn, lower({HEADER}) as h, turn % 5 = 4 as failed from conversations),
    r as (select *, case when failed then null when contains(h, 'addition') then
             concat('additions|', regexp_extract(h, 'additions?\\s+(\\d+)', 1))
             when contains(h, 'deletion') then 'deletions|' when contains(h, 'section no') then 'main_roll|' end as st
          from h),
    c as (select conv_id, turn, coalesce(last_value(st ignore nulls) over (partition by conv_id order by turn
             rows between unbounded preceding and current row), 'main_roll|') as st from r)
    select conv_id, turn, split_part(st, '|', 1) as region,
      try_cast(nullif(split_part(st, '|', 2), '') as integer) as supplement_no from c
    """,
)
def carry_forward(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    strips = c.select("conv_id", "turn", F.expr(HEADER).alias("section_header"), (F.col("turn") % 5 == 4).alias("failed"))
    out = assemble.carry_region(strips, ("conv_id",), ("turn",))
    return out.select("conv_id", "turn", "region", "supplement_no")


# one strip per turn: three cards, of which one has a broken serial on some turns
PAYLOAD = """to_json(named_struct('section_header', {header}, 'cards', array(
    named_struct('serial_no', cast(turn * 3 + 1 as string), 'full_name', concat(' ', role, ' '), 'age', turn * 7 % 3,
                 'epic_no', '  ', 'gender', 'm', 'deleted_watermark', true),
    named_struct('serial_no', case when turn % 3 = 0 then 'x' else cast(turn * 3 + 2 as string) end,
                 'full_name', text, 'age', 40, 'epic_no', ' ab 12 ', 'gender', '', 'deleted_watermark', false),
    named_struct('serial_no', cast(turn * 3 + 3 as string), 'full_name', cast(null as string), 'age', 0,
                 'epic_no', cast(null as string), 'gender', ' F', 'deleted_watermark', cast(null as boolean)))))"""


@query(
    "card_coerce",
    f"""
    with c as (
      select conv_id, turn, 0 as pos, turn * 3 + 1 as serial_no, md5(role) as name_md5, nullif(turn * 7 % 3, 0) as age,
        null as epic_no, 'm' as gender, true as stamp from conversations
      union all
      select conv_id, turn, 1, case when turn % 3 = 0 then null else turn * 3 + 2 end,
        md5(trim(text, (' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)))), 40, 'ab 12', null, false
        from conversations
      union all select conv_id, turn, 2, turn * 3 + 3, md5(''), null, null, 'F', false from conversations)
    select conv_id, turn, cast(pos as integer) as pos, cast(serial_no as integer) as serial_no, name_md5,
      cast(age as integer) as age, epic_no, gender, stamp,
      count(*) filter (where serial_no is null) over (partition by conv_id) as rejected from c
    """,
)
def card_coerce(spark, sf_dir):
    from snapledger.operators.groupwise import attach

    c = Tables(spark, sf_dir).conversations
    strips = assemble.parse_strips(c.select("conv_id", "turn", F.expr(PAYLOAD.format(header="role")).alias("payload")))
    rows = strips.select("conv_id", "turn", F.posexplode("cards").alias("pos", "card"))
    typed = rows.select("conv_id", "turn", "pos", *cards.coerced("card"))
    counted = attach(typed, ["conv_id"], rejected=F.count_if(F.col("serial_no").isNull()))
    return counted.select(
        "conv_id", "turn", "pos", "serial_no", F.md5("full_name").alias("name_md5"), "age", "epic_no", "gender",
        F.col("deleted_watermark").alias("stamp"), "rejected",
    )


@query(
    "page_bands",
    """
    with p as (select event_id, user_id, value as y, cast(1 + event_id % 9 as integer) as page from events),
    k as (select *, case when page = 1 then 'cover' when page = 9 then 'summary' when page = 2 then 'skipped'
                    else 'voter' end as kind from p),
    b as (select *, 'top' as band, 0 as ord from k where y < 200.0 * 0.55
          union all select *, 'bot', 1 from k where y >= 200.0 * 0.48)
    select event_id, kind, band, copies from (
      select *, count(*) over (partition by event_id) as copies,
             row_number() over (partition by event_id order by ord) as rn from b) where rn = 1
    """,
)
def page_bands(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    pages = e.select("event_id", F.col("value").alias("y"), (1 + F.col("event_id") % 9).cast("int").alias("page"))
    read = pages.select(
        "event_id", values.page_kind("page", F.lit(9)).alias("kind"),
        F.explode(values.page_bands("y", F.lit(200.0))).alias("band"),
    ).withColumn("band_no", assemble.band_number())
    from snapledger.operators.groupwise import attach

    one = assemble.best_reads(read, ("event_id",), ("band_no",), F.lit(0))
    copies = read.groupBy("event_id").agg(F.count("*").alias("copies"))
    return one.join(copies, "event_id").select("event_id", "kind", "band", "copies")


@query(
    "has_supplement",
    """
    with r as (select o_orderkey, nullif(o_orderkey % 3, 0) as additions_total from orders),
    m as (select l_orderkey, bool_or(l_returnflag = 'A') as moved from lineitem group by 1),
    h as (select o_orderkey, coalesce(additions_total, 0) <> 0 or coalesce(moved, false) as has_supplement
          from r left join m on l_orderkey = o_orderkey)
    select l_orderkey, count(*) as entries, count(*) filter (where has_supplement and l_returnflag = 'A') as linked,
      cast(sum(case when has_supplement and l_returnflag = 'A' then l_linenumber end) as bigint) as number_sum,
      bool_and(has_supplement) as has_supplement
    from lineitem join h on o_orderkey = l_orderkey group by 1
    """,
)
def has_supplement(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rolls = t.orders.select(
        F.col("o_orderkey").alias("roll_id"), F.nullif(F.col("o_orderkey") % 3, F.lit(0)).alias("additions_total"),
        F.lit(0).alias("deletions_total"), F.lit(None).cast("int").alias("num_modifications"),
    )
    entries = t.lineitem.select(
        F.col("l_orderkey").alias("roll_id"), F.col("l_linenumber").alias("supplement_no"),
        F.when(F.col("l_returnflag") == "A", "added").otherwise("active").alias("status"),
    )
    flagged = resolve.has_supplement(rolls, entries)
    linked = resolve.supplement_link(entries, flagged)
    per_roll = linked.groupBy("roll_id").agg(
        F.count("*").alias("entries"), F.count("linked_supplement_no").alias("linked"),
        F.sum("linked_supplement_no").alias("number_sum"),
    )
    return per_roll.join(flagged.select("roll_id", "has_supplement"), "roll_id").withColumnRenamed(
        "roll_id", "l_orderkey"
    )


@query(
    "failed_list",
    """
    select user_id, 'p' || event_id || '/' || case when event_id % 2 = 0 then 'top' else 'bot' end as failed_strip,
      count(*) over (partition by user_id) as n_failed
    from events where event_type = 'error'
    """,
)
def failed_list(spark, sf_dir):
    from snapledger.operators.groupwise import attach
    from snapledger.operators.quality import failed_strips

    e = Tables(spark, sf_dir).events
    strips = e.select(
        "user_id", "event_id", F.when(F.col("event_id") % 2 == 0, "top").otherwise("bot").alias("band"),
        (F.col("event_type") == "error").alias("failed"),
    )
    return attach(failed_strips(strips, "user_id", "event_id"), ["user_id"], n_failed=F.count("*"))


@query(
    "roll_assembly",
    f"""
    with h as (select conv_id, turn, lower({HEADER}) as h from conversations),
    r as (select *, case when contains(h, 'addition') then 'additions' when contains(h, 'deletion') then 'deletions'
             when contains(h, 'section no') then 'main_roll' end as st from h),
    g as (select conv_id, turn, coalesce(last_value(st ignore nulls) over (partition by conv_id order by turn
             rows between unbounded preceding and current row), 'main_roll') as region from r),
    c as (select conv_id, turn * 3 + 1 as serial, region, true as stamp, 'Male' as gender from g
          union all select conv_id, turn * 3 + 2, region, false, null from g where turn % 3 <> 0
          union all select conv_id, turn * 3 + 3, region, false, 'Female' from g),
    m as (select *, max(case when region = 'main_roll' then serial end) over (partition by conv_id) as top from c),
    s as (select *, case when region = 'main_roll' or serial <= top then case when stamp then 'deleted' else 'active' end
             when region = 'additions' then 'added' else 'deleted' end as status from m),
    k as (select conv_id, count(*) as cards_printed, count(*) filter (where status = 'deleted') as deletions,
            count(*) filter (where status = 'added') as additions, 0::bigint as modifications,
            count(*) filter (where status <> 'deleted') as live_cards,
            count(*) filter (where status <> 'deleted' and gender = 'Male') as live_male,
            count(*) filter (where status <> 'deleted' and gender = 'Female') as live_female,
            0::bigint as live_third_gender from s group by 1),
    n as (select conv_id, cast(count(*) as integer) as net_total, cast(count(*) filter (where turn > 1) as integer)
            as additions_total from conversations group by 1)
    select cast(k.conv_id as varchar) as roll_id, k.* exclude (conv_id), net_total, additions_total,
      live_cards = net_total and additions = additions_total as reconciles
    from k join n on n.conv_id = k.conv_id
    """,
)
def roll_assembly(spark, sf_dir):
    """The whole chain: payloads -> cards -> assembled cards -> checks per document."""
    from snapledger.plans.rolls import run_rolls

    c = Tables(spark, sf_dir).conversations
    strips = c.select(
        F.col("conv_id").cast("string").alias("roll_id"), F.col("turn").cast("int").alias("page"),
        F.lit("top").alias("band"), F.expr(PAYLOAD.format(header=HEADER)).alias("payload"),
    )
    unread = F.lit(None).cast("int")
    summary = strips.groupBy("roll_id").agg(
        F.count("*").cast("int").alias("net_total"), F.count_if(F.col("page") > 1).cast("int").alias("additions_total")
    ).select("*", *[unread.alias(n) for n in ("net_male", "net_female", "net_third_gender", "deletions_total", "num_modifications")])
    recon = run_rolls(summary.select("roll_id"), strips, summary).recon
    return recon.drop("checks", "net_male", "net_female", "net_third_gender", "deletions_total")


@query(
    "enrich_context",
    """
    select o_orderkey as roll_id, case when o_custkey % 3 = 0 then nullif(o_custkey % 5, 0) else o_custkey % 7 end as ac_no,
      case when o_orderkey % 4 = 0 then nullif(o_orderkey % 3, 0) else o_orderkey % 9 end as part_no from orders
    """,
)
def enrich_context(spark, sf_dir):
    """Area and part from the cover where the file name gave none; a zero on the cover is none."""
    o = Tables(spark, sf_dir).orders
    context = o.select(F.col("o_orderkey").alias("roll_id"), F.expr("case when o_custkey % 3 <> 0 then o_custkey % 7 end").alias("ac_no"),
                       F.expr("case when o_orderkey % 4 <> 0 then o_orderkey % 9 end").alias("part_no"))
    cover = o.select(F.col("o_orderkey").alias("roll_id"), (F.col("o_custkey") % 5).alias("ac_no"), (F.col("o_orderkey") % 3).alias("part_no"))
    return rolls_plan.enrich_context(context, cover)


@query(
    "ordered_electors",
    """
    select o_orderstatus as roll_id, o_orderkey as serial_no, row_number() over (partition by o_orderstatus order by o_orderkey) as ordinal from orders
    """,
)
def ordered_electors(spark, sf_dir):
    """The place of each entry within its roll; three rolls hold all entries."""
    o = Tables(spark, sf_dir).orders.select(F.col("o_orderstatus").alias("roll_id"), F.col("o_orderkey").alias("serial_no"))
    return assemble.numbered(o)
