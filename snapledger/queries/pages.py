"""Pages rendered as tokens from the given tables and parsed back: the parse must return the columns.

A page holds 30 customers in a grid of three columns; every tenth card has no serial, some cards are
stamped, names wrap over two lines, and noise lines stand between the fields.
"""

from html.parser import HTMLParser

from pyspark.sql import functions as F

from snapledger.functions import fixed
from snapledger.operators import forms, layout
from snapledger.queries.registry import Tables, query
from snapledger.sources import extractors

CELL = """
    c as (select *, c_custkey // 30 as image, c_custkey % 30 // 3 as r, c_custkey % 3 as k from customer)
"""
STAMP = "c_custkey % 13 = 4 and c_custkey % 10 <> 5"
HOUSE = "case when c_custkey % 4 = 0 then '' else concat('H ', cast(c_nationkey as varchar(9))) end"


#: Customers that one task renders, about.
ROWS = 20_000


def _tokens(df, image, rows, engine="'latin'"):
    """``rows``: (x, y, text) SQL texts; the order of the list is the reading order."""
    cells = ", ".join(
        f"struct({i} as n, cast({x} as double) as x, cast({y} as double) as y, {t} as text, "
        f"{e[0] if e else engine} as engine)" for i, (x, y, t, *e) in enumerate(rows)
    )
    # a row becomes some twenty tokens, so files of a few megabytes are dealt out by their rows first, those of a page together
    tasks = -(-df.count() // ROWS) or 1
    dealt = df.withColumn("image_id", F.expr(image)).repartition(tasks, "image_id")
    tokens = dealt.select("image_id", "c_custkey", F.expr(f"inline(array({cells}))"))
    return tokens.filter("text is not null").select(
        "image_id", (F.col("c_custkey") * 100 + F.col("n")).alias("tok_no"), "engine", "x", "y",
        F.when(F.col("text") == "WIDE", 1200.0).otherwise(F.col("x") + 50).alias("x2"), (F.col("y") + 12).alias("y2"),
        "text",
    )


def _cells(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.withColumns({"r": F.expr("c_custkey % 30 div 3"), "k": F.expr("c_custkey % 3")})


@query(
    "token_cards",
    f"""
    with {CELL}
    select image as image_id, cast(c_custkey % 30 + 1 as integer) as serial_no,
      concat('ABC', lpad(cast(c_custkey as varchar), 7, '0')) as epic_no, concat(c_name, ' Jr') as full_name,
      case when k = 0 then 'Husband' when k = 1 then 'Father' else 'Mother' end as relation_type,
      c_mktsegment as relation_name, {HOUSE} as house_number, cast(18 + c_custkey % 80 as integer) as age,
      case when c_custkey % 2 = 0 then 'Female' else 'Male' end as gender, {STAMP} as deleted_watermark,
      case when {STAMP} then 'S' else '' end as deletion_reason_code
    from c
    """,
)
def token_cards(spark, sf_dir):
    y = "100 + 200 * r"
    rows = [
        ("0", "10", "case when c_custkey % 30 = 0 then 'WIDE' end"),
        ("400 * k + 10", y, "case when c_custkey % 10 = 5 then null "
                            f"when {STAMP} then concat('S  ', cast(c_custkey % 30 + 1 as string)) "
                            "else cast(c_custkey % 30 + 1 as string) end"),
        ("400 * k + 250", y, "concat('ABC ', lpad(cast(c_custkey as string), 7, '0'))"),
        ("400 * k + 10", f"{y} + 40", "concat('Name : ', c_name)"),
        ("400 * k + 10", f"{y} + 60", "'Jr'"),
        ("400 * k + 10", f"{y} + 80",
         "concat(case k when 0 then 'Wifes Name: ' when 1 then 'Fathers Name ' else 'Mothers Name:' end, c_mktsegment)"),
        ("400 * k + 10", f"{y} + 90", "'Section No 1 as on 01-01-2026'"),
        ("400 * k + 10", f"{y} + 100", f"concat('House Number : ', {HOUSE})"),
        ("400 * k + 10", f"{y} + 120",
         "concat('Age : ', cast(18 + c_custkey % 80 as string), ' Gender : ', if(c_custkey % 2 = 0, 'Female', 'Male'))"),
    ]
    tokens = layout.cut(_tokens(_cells(spark, sf_dir), "c_custkey div 30", rows))
    return layout.parse_cards(tokens).drop("marker_box", "col", "y")


@query(
    "token_script_cards",
    f"""
    with {CELL}
    select image as image_id, cast(c_custkey % 30 + 1 as integer) as serial_no, c_name as full_name, 'Husband' as relation_type,
      c_mktsegment as relation_name, concat('H', c_nationkey) as house_number, cast(18 + c_custkey % 80 as integer) as age,
      case when c_custkey % 2 = 0 then 'Female' else 'Male' end as gender, {STAMP} as deleted_watermark
    from c where c_custkey % 10 <> 5
    """,
)
def token_script_cards(spark, sf_dir):
    y, script = "100 + 200 * r", "'script'"
    name, house = fixed.SCRIPT_NAME[1], fixed.SCRIPT_HOUSE[0]
    husband, (female, _), (male, _) = fixed.SCRIPT_RELATION[0][0], *fixed.SCRIPT_GENDER[:2]
    rows = [
        ("0", "10", "case when c_custkey % 30 = 0 then 'WIDE' end"),
        ("400 * k + 10", y, "case when c_custkey % 10 = 5 then null else "
                            f"concat(if({STAMP}, 'M', ''), cast(c_custkey % 30 + 1 as string)) end"),
        ("400 * k + 250", y, "concat('ABC', lpad(cast(c_custkey as string), 7, '0'))"),
        ("400 * k + 10", f"{y} + 110", "cast(18 + c_custkey % 80 as string)"),
        ("400 * k + 10", f"{y} + 40", f"concat('{name} : ', c_name)", script),
        ("400 * k + 10", f"{y} + 60", f"concat('{husband} : ', c_mktsegment)", script),
        ("400 * k + 220", f"{y} + 80", f"concat('{house}: H', cast(c_nationkey as string))", script),
        ("400 * k + 10", f"{y} + 120", f"if(c_custkey % 2 = 0, '{female}', '{male}')", script),
    ]
    tokens = layout.cut(_tokens(_cells(spark, sf_dir), "c_custkey div 30", rows))
    return layout.parse_script_cards(tokens).drop("marker_box", "epic_no", "deletion_reason_code", "col", "y")


@query(
    "token_summary",
    """
    select c_custkey as image_id, cast(c_custkey % 1000 as integer) as net_male,
      cast(case when c_custkey % 7 = 0 then null else c_nationkey end as integer) as net_female,
      cast(c_custkey % 3 as integer) as net_third_gender, cast(c_custkey % 5000 as integer) as net_total,
      cast(c_custkey % 50 as integer) as additions_total,
      cast(case when c_custkey % 5 <> 0 then c_custkey % 60 end as integer) as deletions_total,
      cast(greatest(c_custkey % 70, 3) as integer) as num_modifications
    from customer
    """,
)
def token_summary(spark, sf_dir):
    text = lambda e: f"cast({e} as string)"
    rows = [
        ("300", "10", "'Male'"), ("400", "10", "'FEMALE'"), ("500", "10", "'Third Gender'"), ("600", "10", "'Total'"),
        ("600", "90", "'Total'"),
        ("0", "100", "'II. List of Additions'"), ("598", "104", text("c_custkey % 50")), ("300", "96", "'7'"),
        ("0", "200", "case when c_custkey % 5 <> 0 then 'List of Deletions' end"), ("610", "200", text("c_custkey % 60")),
        ("0", "300", "'Net Elector in this Roll after this Revision'"), ("310", "300", text("c_custkey % 1000")),
        ("405", "301", "case when c_custkey % 7 <> 0 then cast(c_nationkey as string) end"),
        ("497", "302", text("c_custkey % 3")), ("620", "303", "'99999'"), ("640", "304", text("c_custkey % 5000")),
        ("0", "600", "'NUMBER OF MODIFICATIONS'"), ("100", "650", text("c_custkey % 70")), ("160", "660", "'3'"),
        ("100", "900", "'9999'"),
    ]
    return forms.parse_summary(_tokens(Tables(spark, sf_dir).customer, "c_custkey", rows))


@query(
    "token_cover",
    """
    select c_custkey as image_id, cast(2000 + c_custkey % 30 as integer) as year_of_revision,
      case when c_custkey % 3 <> 0 then c_mktsegment end as state_name, cast(c_custkey % 400 as integer) as ac_no,
      c_name as ac_name, case when c_custkey % 2 = 0 then 'SC' end as ac_reservation, cast(c_nationkey as integer) as pc_no,
      cast(c_custkey % 90 as integer) as part_no, '01-01-2026' as qualifying_date,
      concat('Basic ', c_mktsegment) as roll_identification, concat('B', c_nationkey) as block,
      cast(7 as integer) as polling_station_no, c_name as polling_station_name,
      concat('1-', c_mktsegment, ',2-', 'West side') as sections, cast(c_custkey % 900 as integer) as net_male,
      cast(c_custkey % 999 as integer) as net_total
    from customer
    """,
)
def token_cover(spark, sf_dir):
    text = lambda e: f"cast({e} as string)"
    year = text("2000 + c_custkey % 30")
    rows = [
        ("0", "0", f"if(c_custkey % 3 <> 0, concat('ELECTORAL ROLL ', {year}, ' S07 ', c_mktsegment), 'COVER')"),
        ("0", "40", f"concat('Assembly Constituency :: ', {text('c_custkey % 400')}, '-', c_name, if(c_custkey % 2 = 0, ' (sc)', ''))"),
        ("0", "60", f"concat('Parliamentary Constituency : ', {text('c_nationkey')}, '-West(GEN)')"),
        ("600", "40", f"concat('Part No. : ', {text('c_custkey % 90')})"),
        ("0", "100", "'Year of Revision'"), ("200", "101", f"concat(': ', {year})"), ("300", "100", "'far'"),
        ("0", "120", "'Qualifying Date'"), ("200", "120", "'01-01-2026'"),
        ("0", "160", "'Roll Identification'"), ("5", "176", "concat('Basic ', c_mktsegment)"),
        ("0", "200", "'Block'"), ("200", "200", f"concat('B', {text('c_nationkey')})"), ("0", "230", "'1-Block1'"),
        ("0", "300", "'No and Name of Polling Station'"), ("0", "316", "concat('7 - ', c_name)"),
        ("0", "450", "'No and name of sections in the part'"), ("0", "470", "concat('1-', c_mktsegment)"),
        ("0", "485", "'2 - West side'"), ("0", "560", "'3-too far'"),
        ("200", "600", "'Male'"), ("500", "600", "'Total'"),
        ("203", "620", text("c_custkey % 900")), ("502", "620", text("c_custkey % 999")), ("505", "620", "'91'"),
    ]
    found = forms.parse_cover(layout.cut(_tokens(Tables(spark, sf_dir).customer, "c_custkey", rows)))
    section = F.transform("sections", lambda s: F.concat_ws("-", s["section_no"].cast("string"), s["section_name"]))
    return found.select(
        "image_id", "year_of_revision", "state_name", "ac_no", "ac_name", "ac_reservation", "pc_no", "part_no",
        "qualifying_date", "roll_identification", "block", "polling_station_no", "polling_station_name",
        F.concat_ws(",", section).alias("sections"), "net_male", "net_total",
    )


@extractors.register("title")
def title(**_):
    import re

    pattern = re.compile(r"<title>(.*?)</title>", re.S)

    def read(page):
        if "</html>" not in page["html"]:
            raise ValueError("page is cut")
        return {"section_header": pattern.search(page["html"]).group(1), "cards": []}

    return read


@query(
    "reader_hook",
    """
    select page_id, not contains(html, '</html>') as failed, case when contains(html, '</html>') then
      md5(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) end as title_md5,
      case when not contains(html, '</html>') then 'ValueError: page is cut' end as error
    from pages
    """,
)
def reader_hook(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages.select("page_id", "html")
    out = extractors.extract(pages, "title", keep=("page_id",))
    return out.select(
        "page_id", "failed", F.md5(F.get_json_object("payload", "$.section_header")).alias("title_md5"), "error"
    )


class _Tags(HTMLParser):
    """Depth of the tags that are open at once, and the targets of links."""

    VOID = {"meta", "br", "img", "hr", "input", "link"}

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.depth = self.deepest = 0
        self.links: set[str] = set()

    def handle_starttag(self, tag, attrs):
        if tag not in self.VOID:
            self.depth += 1
            self.deepest = max(self.deepest, self.depth)
        if tag == "a":
            self.links |= {value for name, value in attrs if name == "href" and value is not None}

    def handle_endtag(self, tag):
        self.depth -= 1


def _parsed(html: str) -> _Tags:
    if "</html>" not in html:
        raise ValueError("page is cut")
    tags = _Tags()
    tags.feed(html)
    return tags


@extractors.register("tag_depth", batched=True)
def depth(**_):
    return lambda pages: [{"section_header": f"depth {_parsed(p['html']).deepest}"} for p in pages]


@extractors.register("links", batched=True)
def links(**_):
    return lambda pages: [{"section_header": f"links {len(_parsed(p['html']).links)}"} for p in pages]


LANGUAGE = r"://[^/]+/([a-z]{2})(?:[/?#]|$)"


@query(
    "language_routes",
    f"""
    with p as (select page_id, nullif(regexp_extract(url, '{LANGUAGE}', 1), '') as language_code,
        contains(html, '</html>') as ok, regexp_replace(html, '(?s)<(script|style)>.*?</(script|style)>', '<script></script>', 'g') as h from pages),
    t as (select *, list_filter(regexp_extract_all(h, '<(/?[a-zA-Z][a-zA-Z0-9]*)', 1), lambda x: x not in ('meta', 'br', 'img', 'hr', 'input', 'link')) as tags from p),
    d as (select *, list_reduce(list_prepend({{'at': 0, 'top': 0}}, list_transform(tags, lambda x: {{'at': case when x[1] = '/' then -1 else 1 end, 'top': 0}})),
        lambda a, x: {{'at': a.at + x.at, 'top': greatest(a.top, a.at + x.at)}}).top as deepest,
        len(list_distinct(regexp_extract_all(h, '<a [^>]*href="([^"]*)"', 1))) as links from t)
    select page_id, language_code, not ok as failed, case when not ok then null when language_code in ('en', 'de') then 'depth ' || deepest
      else 'links ' || links end as found from d
    """,
)
def language_routes(spark, sf_dir):
    """Pages of two languages through one engine, all others through another; both parse the whole page."""
    pages = Tables(spark, sf_dir).pages.select("page_id", F.nullif(F.regexp_extract("url", LANGUAGE, 1), F.lit("")).alias("language_code"), "html")
    out = extractors.extract_by_language(pages, {"en": "tag_depth", "de": "tag_depth"}, "links", keep=("page_id", "language_code"))
    return out.select("page_id", "language_code", "failed", F.get_json_object("payload", "$.section_header").alias("found"))


HEADER = ("case when c_custkey % 7 = 3 then concat('  Section No and Name ', c_name) when c_custkey % 11 = 5 then 'List of Additions 2' "
          "when c_custkey % 13 = 1 then 'LIST  OF DELETIONS' else c_name end")


@query(
    "section_headers",
    f"""
    with t as (select c_custkey // 12 as image_id, c_custkey as tok_no, c_custkey * 37 % 101 as y, {HEADER} as text from customer),
    f as (select *, lower(regexp_replace(text, '\\s+', '', 'g')) as flat from t)
    select image_id, coalesce(arg_min(text, (y, tok_no)) filter (where starts_with(flat, 'sectionnoandname')
      or contains(flat, 'listofadditions') or contains(flat, 'listofdeletions')), '') as section_header from f group by 1
    """,
)
def section_headers(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    tokens = c.select(F.expr("c_custkey div 12").alias("image_id"), F.col("c_custkey").alias("tok_no"), (F.col("c_custkey") * 37 % 101).alias("y"), F.expr(HEADER).alias("text"))
    return layout.section_headers(tokens)
