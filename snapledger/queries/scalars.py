"""Normalisers and parsers over whole tables; raw variants are built from the columns at hand."""

from pyspark.sql import functions as F

from snapledger.functions import cards, fixed, text, values
from snapledger.operators import resolve
from snapledger.queries.registry import Tables, query

BLANKS_SQL = "(' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


def pick_one(key: str, *options: str | None):
    """SQL (valid in both engines) choosing one of ``options`` (SQL texts) by key modulo their number."""
    whens = " ".join(f"when {i} then {o if o is not None else 'null'}" for i, o in enumerate(options))
    return f"(case {key} % {len(options)} {whens} end)"


STATUS_OF_ORDER = "case o_orderstatus when 'F' then 'deleted' when 'P' then 'modified' else 'active' end"
REASON_OF_ORDER = (
    "case when o_orderkey % 7 = 0 then null when o_orderpriority = '1-URGENT' then 'E' "
    "when o_orderpriority = '2-HIGH' then 'S' when o_orderpriority = '3-MEDIUM' then 'R' "
    "when o_orderpriority = '5-LOW' then 'Q' else 'M' end"
)


@query(
    "lifecycle_status",
    f"""
    with e as (select o_orderkey, {STATUS_OF_ORDER} as s, {REASON_OF_ORDER} as r from orders)
    select o_orderkey, case when s <> 'deleted' then 'active' when r = 'E' then 'deceased'
           when r = 'S' then 'shifted_out' when r = 'R' then 'removed_duplicate'
           when r = 'Q' then 'disqualified' when r = 'M' then 'removed_missing' else 'removed' end
           as lifecycle_status,
           case r when 'E' then 'Expired' when 'S' then 'Shifted / Change of Residence'
           when 'R' then 'Duplicate' when 'M' then 'Missing' when 'Q' then 'Disqualified' end as reason_text
    from e
    """,
)
def lifecycle_status(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    coded = o.select("o_orderkey", F.expr(STATUS_OF_ORDER).alias("s"), F.expr(REASON_OF_ORDER).alias("r"))
    reasons = F.create_map(*[F.lit(v) for kv in fixed.REASONS.items() for v in kv])
    return coded.select(
        "o_orderkey", values.lifecycle("s", "r").alias("lifecycle_status"),
        F.try_element_at(reasons, F.col("r")).alias("reason_text"),
    )


RAW = {
    "rel": pick_one("c_custkey", "'Father''s Name'", "' HUSBAND'", "'mother'", "'wife'", "''", None),
    "gen": pick_one("c_custkey", "' M '", "'Fe male'", "'Third Gender'", "'TG'", "'x'", "'O'", None),
    "doc": "concat('  ', lower(c_name), ' ab ')",
    "rea": pick_one("c_custkey", "' E '", "'E/S/R'", "'Q'", "''", None),
    "res": pick_one(
        "c_custkey", "'General'", "'SCHEDULED TRIBE'", "' st'", "'SC'", "'Scheduled Caste'", "'x'", "''", None
    ),
    "sta": pick_one("c_custkey", "'Male booth'", "' FEMALE'", "''", "'abc'", None),
    "lab": pick_one(
        "c_custkey", "concat('Name : ', c_name)", "concat('Fathers Name ', c_name)", "c_name", "concat('a:b:', c_name)"
    ),
    "htm": "concat('<b>', c_name, '</b>&nbsp;<i x=1>y</i> ')",
    "num": pick_one("c_custkey", "cast(c_custkey as string)", "c_name", "''", "' 12 '"),
    "cod": pick_one("c_custkey", "'S07'", "'U1'", "'X07'", "'s07'", None),
}
RAW_SQL = ", ".join(f"{v} as {k}" for k, v in RAW.items())
LABELS_SQL = (
    r"'^\s*(house\s*numbe?r?|name|fathers?\s*name|mothers?\s*name|husbands?\s*name|wifes?\s*name|others?)\s*'"
)


@query(
    "normalize_scalars",
    f"""
    with r as (select c_custkey, {RAW_SQL.replace('as string', 'as varchar')} from customer),
    s as (select *, lower(trim(rel, {BLANKS_SQL})) as lr, replace(lower(trim(gen, {BLANKS_SQL})), ' ', '') as lg,
                 upper(trim(res, {BLANKS_SQL})) as ur, lower(trim(sta, {BLANKS_SQL})) as ls from r)
    select c_custkey,
      case when rel is null or rel = '' then null when starts_with(lr, 'father') then 'Father'
           when starts_with(lr, 'husband') then 'Husband' when starts_with(lr, 'mother') then 'Mother'
           else 'Other' end as relation,
      case when lg in ('male', 'm') then 'Male' when lg in ('female', 'f') then 'Female'
           when contains(lg, 'third') or lg in ('tg', 'o') then 'ThirdGender' end as gender,
      replace(upper(trim(doc, {BLANKS_SQL})), ' ', '') as doc_key,
      case when trim(rea, {BLANKS_SQL}) in ('E', 'S', 'R', 'M', 'Q') then rea end as reason,
      case when starts_with(ur, 'GEN') then 'GEN' when contains(ur, 'SCHEDULED CASTE') then 'SC'
           when contains(ur, 'SCHEDULED TRIBE') then 'ST' when starts_with(ur, 'SC') then 'SC'
           when starts_with(ur, 'ST') then 'ST' end as reservation,
      case when starts_with(ls, 'male') then 'Male' when starts_with(ls, 'female') then 'Female'
           else 'General' end as station_type,
      case when contains(lab, ':') then trim(substr(lab, strpos(lab, ':') + 1), {BLANKS_SQL})
           else trim(regexp_replace(lab, {LABELS_SQL}, '', 'i'), {BLANKS_SQL}) end as label_value,
      regexp_replace(lab, '\\s+', '', 'g') as despaced,
      trim(replace(regexp_replace(htm, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), {BLANKS_SQL}) as plain,
      try_cast(trim(num, {BLANKS_SQL}) as integer) as safe_int,
      nullif(num, '') as safe_text,
      coalesce(regexp_full_match(cod, '[SU][0-9]{{2}}'), false) as code_shaped
    from s
    """,
)
def normalize_scalars(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    raw = c.select("c_custkey", "c_name", *[F.expr(v).alias(k) for k, v in RAW.items()])
    return raw.select(
        "c_custkey",
        values.relation("rel").alias("relation"),
        values.gender("gen").alias("gender"),
        values.key("doc").alias("doc_key"),
        values.reason("rea").alias("reason"),
        values.reservation("res").alias("reservation"),
        values.station_type("sta").alias("station_type"),
        text.strip_label("lab").alias("label_value"),
        text.despace("lab").alias("despaced"),
        text.strip_tags("htm").alias("plain"),
        text.to_int(text.strip("num")).alias("safe_int"),
        F.nullif("num", F.lit("")).alias("safe_text"),
        text.code_shaped("cod").alias("code_shaped"),
    )


FILE = (
    "concat('2026-', " + pick_one("o_orderkey", "'EROLLGEN'", "'erollgen'", "'OTHER'") + ", '-S', "
    "lpad(cast(o_orderkey % 30 as varchar(9)), 2, '0'), '-', cast(o_custkey as varchar(20)), '-', "
    + pick_one("o_custkey", "'SIR-FinalRoll-Revision1'", "'FinalRoll'", "'SIR-DraftRoll'", "'x-draftroll'")
    + ", '-', " + pick_one("o_orderkey", "'ENG'", "'hi'", "'TAM'", "'TELU'") + ", '-', "
    "cast(o_orderkey as varchar(20)), '-WI', " + pick_one("o_orderkey", "'.pdf'", "'.PDF'", "'.png'", "'.pdf'", "''") + ")"
)
FILE_RX = r"EROLLGEN-([SU]\d{2})-(\d+)-.*?-([A-Z]{2,3})-(\d+)-WI"


@query(
    "filename_context",
    f"""
    with f as (select o_orderkey, o_custkey, {FILE} as n from orders)
    select o_orderkey,
      upper(nullif(regexp_extract(n, '{FILE_RX}', 1, 'i'), '')) as state_cd,
      try_cast(nullif(regexp_extract(n, '{FILE_RX}', 2, 'i'), '') as integer) as ac_no,
      upper(nullif(regexp_extract(n, '{FILE_RX}', 3, 'i'), '')) as language_code,
      try_cast(nullif(regexp_extract(n, '{FILE_RX}', 4, 'i'), '') as integer) as part_no,
      case when contains(n, 'DraftRoll') then 'SIR_DraftRoll'
           when contains(n, 'FinalRoll') and contains(n, 'SIR') then 'SIR_FinalRoll'
           when contains(n, 'FinalRoll') then 'FinalRoll' end as roll_type,
      try_cast(nullif(regexp_extract(n, '-(\\d+)-WI\\.pdf$', 1, 'i'), '') as integer) as file_part_no,
      concat('S01/', o_custkey, '/', n) as storage_key
    from f
    """,
)
def filename_context(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    named = o.select("o_orderkey", "o_custkey", F.expr(FILE).alias("n"))
    return named.select(
        "o_orderkey", *values.file_context("n"), values.part_in_file("n").alias("file_part_no"),
        values.storage_key(F.lit("S01"), "o_custkey", "n").alias("storage_key"),
    )


LABEL = pick_one(
    "o_orderkey", "'SIR FinalRoll - 2026'", "'Supplement-2 2026'", "'Draft Roll 2025 '", "'FinalRoll'",
    "concat('Roll of ', cast(1990 + o_custkey % 30 as varchar(9)))",
)
CONS = pick_one(
    "o_orderkey", "concat('Assembly Constituency :: ', cast(o_custkey as varchar(9)), '-AREA NORTH (sc)')",
    "concat('No: ', cast(o_custkey as varchar(9)), ' - Area South ')", "'no value'",
)
TITLE = pick_one("o_orderkey", "'ELECTORAL ROLL 2026S07 Somewhere '", "'Electoralroll 2025 u01Isle'", "'ROLL 2026'")
LANG = pick_one("o_orderkey", "' english'", "'MALAYALAM'", "'hi'")


@query(
    "label_parse",
    f"""
    with r as (select o_orderkey, o_orderpriority, {LABEL} as l, {CONS} as c, {TITLE} as t, {LANG} as g from orders),
    s as (select *, trim(regexp_replace(l, '\\s*-?\\s*\\d{{4}}\\s*$', ''), {BLANKS_SQL}) as b,
                 split_part(c, ':', -1) as tail from r)
    select o_orderkey,
      try_cast(nullif(regexp_extract(l, '(\\d{{4}})', 1), '') as integer) as roll_year,
      case when contains(lower(b), 'supplement') then 'Supplement' else regexp_replace(b, '\\s+', '_', 'g') end
        as roll_type,
      upper(substr(trim(g, {BLANKS_SQL}), 1, 3)) as language_code,
      try_cast(nullif(regexp_extract(o_orderpriority, '^(\\d+)\\s*-\\s*(.+)$', 1), '') as integer) as no,
      nullif(regexp_extract(o_orderpriority, '^(\\d+)\\s*-\\s*(.+)$', 2), '') as name,
      try_cast(coalesce(nullif(regexp_extract(tail, '(\\d+)\\s*-\\s*(.+?)\\s*\\(([A-Za-z]+)\\)', 1), ''),
               nullif(regexp_extract(tail, '(\\d+)\\s*-\\s*(.+)$', 1), '')) as integer) as cons_no,
      trim(coalesce(nullif(regexp_extract(tail, '(\\d+)\\s*-\\s*(.+?)\\s*\\(([A-Za-z]+)\\)', 2), ''),
               nullif(regexp_extract(tail, '(\\d+)\\s*-\\s*(.+)$', 2), ''))) as cons_name,
      upper(nullif(regexp_extract(tail, '(\\d+)\\s*-\\s*(.+?)\\s*\\(([A-Za-z]+)\\)', 3), '')) as cons_res,
      try_cast(nullif(regexp_extract(t, 'electoral\\s*roll\\s*(\\d{{4}})\\s*[su]\\d{{2}}\\s*(.+)', 1, 'i'), '')
        as integer) as title_year,
      trim(nullif(regexp_extract(t, 'electoral\\s*roll\\s*(\\d{{4}})\\s*[su]\\d{{2}}\\s*(.+)', 2, 'i'), ''))
        as title_state
    from s
    """,
)
def label_parse(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = o.select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.expr(LABEL).alias("l"), F.expr(CONS).alias("c"),
        F.expr(TITLE).alias("t"), F.expr(LANG).alias("g"),
    )
    cons, title = values.constituency("c"), values.roll_title("t")
    return raw.select(
        "o_orderkey", values.roll_year("l").alias("roll_year"), values.roll_type("l").alias("roll_type"),
        values.language_code("g").alias("language_code"), *text.numbered_name("o_orderpriority"),
        cons["no"].alias("cons_no"), cons["name"].alias("cons_name"), cons["reservation"].alias("cons_res"),
        title["year"].alias("title_year"), title["state_name"].alias("title_state"),
    )


def _dates(engine: str) -> str:
    fmt = {
        "spark": lambda p: f"date_format(o_orderdate, '{p}')",
        "duck": lambda p: "strftime(o_orderdate, '%s')" % p.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d"),
    }[engine]
    return pick_one(
        "o_orderkey", fmt("dd-MM-yyyy"), fmt("dd/MM/yyyy"), fmt("yyyy-MM-dd"), fmt("yyyy/MM/dd"),
        f"concat('13-13-', {fmt('yyyy')})", "'n/a'", "''", None, f"concat({fmt('dd')}, '-7-', {fmt('yyyy')})",
    )


@query(
    "date_normalize",
    f"""
    with d as (select o_orderkey, replace({_dates('duck')}, '/', '-') as d from orders)
    select o_orderkey, cast(coalesce(
        case when regexp_matches(d, '^[0-9]{{2}}-') then try_strptime(d, '%d-%m-%Y') end,
        case when regexp_matches(d, '^[0-9]{{4}}-') then try_strptime(d, '%Y-%m-%d') end)::date as varchar) as iso
    from d
    """,
)
def date_normalize(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = o.select("o_orderkey", F.expr(_dates("spark")).alias("d"))
    return raw.select("o_orderkey", values.iso_date("d").cast("string").alias("iso"))


@query(
    "tag_sequence",
    f"""
    with q as (select doc_id, concat('<s_text>', coalesce(text, ''), '</s_text><s_lang>', coalesce(lang, ''),
                 '</s_lang><s_none></s_none>') as seq, lang, source from documents)
    select doc_id, md5(trim(regexp_extract(seq, '(?s)<s_text>(.*?)</s_text>', 1), {BLANKS_SQL})) as text_md5,
      trim(regexp_extract(seq, '(?s)<s_lang>(.*?)</s_lang>', 1), {BLANKS_SQL}) as lang,
      trim(regexp_extract(seq, '(?s)<s_none>(.*?)</s_none>', 1), {BLANKS_SQL}) as none,
      trim(regexp_extract(seq, '(?s)<s_gone>(.*?)</s_gone>', 1), {BLANKS_SQL}) as gone,
      concat(coalesce(lang, ''), ' | ', '', ' | ', coalesce(source, '')) as line
    from q
    """,
)
def tag_sequence(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    nothing = F.lit(None).cast("string")
    seq = d.withColumn("seq", text.tagged({"text": F.col("text"), "lang": F.col("lang"), "none": nothing}))
    parsed, lang, none, gone = text.untagged("seq", ["text", "lang", "none", "gone"])
    return seq.select(
        "doc_id", F.md5(parsed).alias("text_md5"), lang, none, gone,
        text.joined([F.col("lang"), nothing, F.col("source")]).alias("line"),
    )


CARD = {
    "region": "case l_returnflag when 'A' then 'additions' when 'R' then 'deletions' else 'main_roll' end",
    "marker_box": pick_one("l_linenumber", "'E'", "'#/1'", "''", "' 12 '", "'x'", None),
    "deleted_watermark": "l_linestatus = 'F' and l_linenumber = 2",
    "deletion_reason_code": "case when l_suppkey % 7 = 0 then 'S' end",
    "supplement_no": "cast(l_linenumber as int)",
}


@query(
    "status_infer",
    f"""
    with c as (select l_orderkey, l_linenumber, l_partkey, {", ".join(f"{v} as {k}" for k, v in CARD.items())}
               from lineitem),
    b as (select *, coalesce(trim(marker_box, {BLANKS_SQL}), '') as box from c),
    w as (select *, coalesce(deletion_reason_code, case when box in ('E','S','R','M','Q') then box end) as why from b),
    s as (select *, case
        when region = 'main_roll' and (deleted_watermark or why is not null) then 'deleted'
        when region = 'deletions' then 'deleted'
        when region = 'main_roll' and contains(box, '#') then 'modified'
        when region = 'additions' then 'added' else 'active' end as status from w)
    select l_orderkey, l_linenumber, l_partkey, status, case when status = 'deleted' then why end as reason,
      case when status = 'added' and regexp_full_match(box, '[0-9]+') then cast(box as integer) end as section_no,
      case when region in ('additions', 'deletions') or status = 'modified' then supplement_no end as supplement_no
    from s
    """,
)
def status_infer(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    raw = li.select("l_orderkey", "l_linenumber", "l_partkey", *[F.expr(v).alias(k) for k, v in CARD.items()])
    return raw.withColumn("s", cards.inferred_status()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "s.status", "s.reason", "s.section_no", "s.supplement_no"
    )


PERSON = {
    "epic_no": pick_one(
        "c_custkey", "concat('ABC', lpad(cast(c_custkey as varchar(9)), 7, '0'))", "c_name", "''", None
    ),
    "age": "cast(floor(c_acctbal / 50) as int)",
    "gender": pick_one("c_custkey", "'Male'", "'Female'", "'ThirdGender'", "'female'", "''", None),
    "full_name": pick_one("c_custkey", "c_name", "c_name", "''", "c_name", None),
}


@query(
    "validate_flags",
    f"""
    with p as (select c_custkey, {", ".join(f"{v} as {k}" for k, v in PERSON.items())} from customer),
    f as (select c_custkey, coalesce(epic_no <> '' and not regexp_matches(epic_no, '^[A-Z]{{3}}[0-9]{{7}}$'), false)
        as f1, coalesce(not (age between 0 and 120), false) as f2,
        coalesce(gender <> '' and gender not in ('Male', 'Female', 'ThirdGender'), false) as f3,
        coalesce(full_name, '') = '' as f4 from p)
    select c_custkey, concat_ws(',', case when f1 then 'epic_format' end, case when f2 then 'age_range' end,
        case when f3 then 'gender_enum' end, case when f4 then 'missing_name' end) as flags,
      greatest(0.0::double, 1.0::double - 0.25 * (f1::int + f2::int + f3::int + f4::int)) as confidence
    from f
    """,
)
def validate_flags(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    raw = c.select("c_custkey", *[F.expr(v).alias(k) for k, v in PERSON.items()])
    return raw.withColumn("f", cards.flags()).select(
        "c_custkey", F.concat_ws(",", "f").alias("flags"), cards.confidence("f").alias("confidence")
    )


@query(
    "enrich_defaults",
    """
    select d.doc_id, case when d.doc_id % 3 = 0 then 'S07' else 'S00' end as state_cd,
      case when d.doc_id % 5 = 0 then d.lang when d.doc_id % 3 = 0 then 'Haryana' else 'S00' end as state_name,
      cast(case when d.doc_id % 4 = 0 then d.doc_id else l.quality end as bigint) as ac_no,
      coalesce(cast(l.toxic as bigint), 1) as part_no,
      case when d.source = 'src1' then 'DraftRoll' else 'FinalRoll' end as roll_type,
      'AC ' || coalesce(cast(case when d.doc_id % 4 = 0 then d.doc_id else l.quality end as varchar), 'UNKNOWN') as ac_name,
      case when d.lang = 'de' then 'UNKNOWN' else d.lang end as district_name
    from documents d left join labels l on d.doc_id = l.doc_id
    """,
)
def enrich_defaults(spark, sf_dir):
    from snapledger.operators.groupwise import lookup

    t = Tables(spark, sf_dir)
    docs = lookup(t.documents.select("doc_id", "lang", "source"), t.labels, ["doc_id"], ["quality", "toxic"])
    by = lambda n, value: F.when(F.col("doc_id") % n == 0, value)
    code = by(3, F.lit("S07"))
    docs = docs.withColumns(resolve.defaults({"state_cd": [code, F.lit("S00")]}))
    ac_no = [by(4, F.col("doc_id")), F.col("quality").cast("bigint")]
    out = docs.withColumns(
        resolve.defaults(
            {
                "state_name": [by(5, F.col("lang")), values.state_name("state_cd"), F.col("state_cd")],
                "ac_no": ac_no,
                "part_no": [F.col("toxic").cast("bigint"), F.lit(1).cast("bigint")],
                "roll_type": [F.when(F.col("source") == "src1", "DraftRoll"), F.lit("FinalRoll")],
                "ac_name": [F.concat(F.lit("AC "), F.coalesce(*ac_no).cast("string")), F.lit("AC UNKNOWN")],
                "district_name": [F.when(F.col("lang") == "de", "").otherwise(F.col("lang")), F.lit("UNKNOWN")],
            }
        )
    )
    return out.drop("lang", "source", "quality", "toxic")


@query(
    "section_rows",
    """
    with n as (select doc_id, cast(doc_id % 4 as integer) as k, source from documents),
    listed as (select doc_id, cast(i as integer) as section_no, concat(source, '-', cast(i as varchar)) as section_name
               from n, unnest(range(0, k)) as u(i))
    select * from listed where section_no <> 0
    union all select doc_id, 1, null from n where k = 0
    """,
)
def section_rows(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    item = lambda i: F.struct(
        i.cast("int").alias("section_no"), F.concat("source", F.lit("-"), i.cast("string")).alias("section_name")
    )
    k = (F.col("doc_id") % 4).cast("int")
    listed = d.withColumn("sections", F.when(k > 0, F.transform(F.sequence(F.lit(0), k - 1), item)))
    return resolve.section_rows(listed, ["doc_id"])


@query(
    "language_scope",
    """
    with l as (select c_custkey, list_filter([case when c_custkey % 3 = 0 then 'English' end, upper(c_mktsegment),
        case when c_custkey % 2 = 0 then 'ENGLISH (2)' end], lambda x: x is not null) as a from customer)
    select c_custkey, list_aggregate(a, 'string_agg', ',') as all_languages, a[1] as first_language,
      list_aggregate(case when len(list_filter(a, lambda x: contains(lower(x), 'english'))) > 0
        then list_filter(a, lambda x: contains(lower(x), 'english')) else a[1:1] end, 'string_agg', ',') as english
    from l
    """,
)
def language_scope(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    offered = c.withColumn("a", F.expr(
        "array_compact(array(case when c_custkey % 3 = 0 then 'English' end, upper(c_mktsegment), "
        "case when c_custkey % 2 = 0 then 'ENGLISH (2)' end))"
    ))
    scoped = lambda mode: F.concat_ws(",", values.scope_languages("a", mode))
    return offered.select(
        "c_custkey", scoped("all").alias("all_languages"), scoped("first").alias("first_language"),
        scoped("english").alias("english"),
    )
