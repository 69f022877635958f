"""Layout operators on events: the image is the user, y the second, x the value."""

from pyspark.sql import functions as F

from snapledger.operators import forms, layout
from snapledger.queries.registry import Tables, query
from snapledger.queries.scalars import pick_one

DAY = 86400.0
Y = "cast(timestampdiff(SECOND, timestamp_ntz '2024-01-01 00:00:00', ts) as double)"
TOKEN_SQL = """
    t as (select user_id as image_id, event_id as tok_no, value as x, cast(event_id % 3 as integer) as col, event_type,
      cast(date_diff('second', timestamp '2024-01-01 00:00:00', ts) as double) as y from events)
"""


def _tokens(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select(
        F.col("user_id").alias("image_id"), F.col("event_id").alias("tok_no"), F.col("value").alias("x"),
        (F.col("event_id") % 3).cast("int").alias("col"), "event_type", F.expr(Y).alias("y"),
    )


def _anchors(tokens):
    return tokens.filter("event_type = 'signup'").select(
        "image_id", "col", F.col("tok_no").alias("anchor"), F.col("y").alias("ay"), F.lit(0.0).alias("x0"),
        F.lit(200.0).alias("cw"), F.lit("k").alias("epic_no"),
    )


HEIGHT_SQL = f"""
    {TOKEN_SQL},
    a as (select *, y - lag(y) over (partition by image_id, col order by y, tok_no) as gap from t
          where event_type = 'signup'),
    h as (select image_id, coalesce(list(gap order by gap) filter (where gap > 0)
            [count(*) filter (where gap > 0) // 2 + 1], 219.0) as card_h from a group by 1)
"""


@query("upper_median", f"with {HEIGHT_SQL} select image_id, card_h from h")
def upper_median(spark, sf_dir):
    return layout.card_heights(layout.spaced(_anchors(_tokens(spark, sf_dir)), DAY), block_height=DAY)


@query(
    "interval_join",
    f"""
    with {HEIGHT_SQL},
    i as (select a.image_id, a.col, a.tok_no as anchor, a.y - floor(0.15 * card_h) as lo,
            coalesce(lead(a.y) over (partition by a.image_id, a.col order by a.y, a.tok_no), a.y + card_h)
              - floor(0.15 * card_h) as hi
          from a join h on h.image_id = a.image_id)
    select t.image_id, t.tok_no, i.anchor from t join i on i.image_id = t.image_id and i.col = t.col
      and t.y >= i.lo and t.y < i.hi where t.event_type <> 'signup' and t.x >= 0 and t.x < 100
    """,
)
def interval_join(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    anchors = layout.cut(layout.spaced(_anchors(tokens), DAY))
    cards = layout.cut(layout.card_intervals(anchors, layout.card_heights(anchors, block_height=DAY)))
    points = tokens.filter("event_type <> 'signup'").select(
        "*", F.lit(0.0).alias("x0"), F.lit(200.0).alias("cw"), F.col("event_type").alias("text")
    )
    return layout.tokens_in_cards(points, cards, 0.5, DAY).select("image_id", "tok_no", "anchor")


ROW_SQL = f"""
    {TOKEN_SQL},
    g as (select *, y - lag(y) over (partition by image_id order by y, col, tok_no) as gap from t),
    r as (select *, cast(sum(case when gap is null or gap >= 3600 then 1 else 0 end) over
            (partition by image_id order by y, col, tok_no) as bigint) as grid_row from g)
"""


def _grid(spark, sf_dir):
    cards = _tokens(spark, sf_dir).select(
        "image_id", "col", F.col("tok_no").alias("anchor"), F.col("y").alias("ay"), F.lit(7200.0).alias("card_h")
    )
    return layout.grid_rows(cards, DAY)


@query("gap_rows", f"with {ROW_SQL} select image_id, tok_no, grid_row from r")
def gap_rows(spark, sf_dir):
    return _grid(spark, sf_dir).select("image_id", F.col("anchor").alias("tok_no"), "grid_row")


SERIAL = "case when {a} % 4 = 0 then null else cast(grid_row * 3 + col + case when {a} % 5 < 2 then 1 else 0 end as int) end"


@query(
    "serial_vote",
    f"""
    with recursive {ROW_SQL},
    c as (select *, {SERIAL.format(a='tok_no')} as serial_no from r),
    v as (select image_id, grid_row, serial_no - col as base, count(*) as votes, min((y, col, tok_no)) as seen from c
          where serial_no is not null group by 1, 2, 3),
    w as (select image_id, grid_row, list(base order by seen) as winners from (
            select *, max(votes) over (partition by image_id, grid_row) as top from v) where votes = top group by 1, 2),
    q as (select distinct c.image_id, c.grid_row, winners from c left join w
            on w.image_id = c.image_id and w.grid_row = c.grid_row),
    f as (select image_id, grid_row, winners[1] as base from q where grid_row = 1
          union all
          select q.image_id, q.grid_row, case when q.winners is null then f.base + 3
              when len(q.winners) = 1 or f.base is null then q.winners[1]
              else list_sort(list_transform(q.winners, lambda x, i: {{'d': abs(x - (f.base + 3)), 'i': i, 'x': x}}))[1].x
            end
          from f join q on q.image_id = f.image_id and q.grid_row = f.grid_row + 1)
    select c.image_id, c.tok_no, cast(coalesce(f.base + c.col, c.serial_no) as integer) as serial_no from c
      join f on f.image_id = c.image_id and f.grid_row = c.grid_row where coalesce(f.base + c.col, c.serial_no) is not null
    """,
)
def serial_vote(spark, sf_dir):
    rows = layout.cut(_grid(spark, sf_dir).withColumn("serial_no", F.expr(SERIAL.format(a="anchor"))))
    based = layout.lookup(rows, layout.serial_bases(rows), ["image_id", "grid_row"], ["base"])
    serial = F.coalesce(F.col("base") + F.col("col"), F.col("serial_no"))
    return based.select("image_id", F.col("anchor").alias("tok_no"), serial.alias("serial_no")).filter(
        "serial_no is not null"
    )


HEADS = ("click", "view", "error", "purchase")


@query(
    "nearest_column",
    f"""
    with {TOKEN_SQL},
    h as (select image_id, {", ".join(f"arg_min(x, (y, tok_no)) filter (where event_type = '{n}') as {n}" for n in HEADS)}
          from t group by 1)
    select t.image_id, t.tok_no, list_sort(list_filter([{", ".join(
        f"case when h.{n} is not null then {{'d': abs(h.{n} - x), 'i': {i}, 'n': '{n}'}} end" for i, n in enumerate(HEADS)
    )}], lambda s: s is not null))[1].n as column_name
    from t join h on h.image_id = t.image_id where event_type = 'signup'
    """,
)
def nearest_column(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    heads = {n: F.col("event_type") == n for n in HEADS}
    out = forms.nearest_columns(tokens, heads, ["image_id"])
    return out.filter("event_type = 'signup'").select("image_id", "tok_no", "column_name")


TEXT = pick_one(
    "event_id", "event_type", "concat(' ', upper(event_type), ' : ', cast(event_id as varchar(20)))",
    "concat('x', event_type)", "cast(event_id as varchar(20))",
)
HIGH = 36000.0


def _label_sql(kind, needle):
    near = {
        "right": f"abs(t.y - l.y) < 0.6 * {HIGH} and t.x > l.x + 5",
        "below": f"t.y > l.y + 0.6 * {HIGH} and t.y < l.y + 2.2 * {HIGH} and t.x < l.x + 8 * {HIGH}",
    }[kind]
    order = {"right": "(t.x, t.tok_no)", "below": "(t.y, t.x, t.tok_no)"}[kind]
    own = "case when contains(l.text, ':') then l.text end" if kind == "right" else "null"
    return f"""
      (select l.image_id, nullif(trim(case when contains(v, ':') then substr(v, strpos(v, ':') + 1) else v end), '') as v
       from (select l.image_id, coalesce(arg_min(t.text, {order}) filter (where {near}), any_value({own})) as v
             from (select image_id, arg_min({{'x': x, 'y': y, 'text': text}}, (flat <> '{needle}', y, tok_no)) as s
                   from t where contains(flat, '{needle}') group by 1) g,
               lateral (select g.image_id, s.x as x, s.y as y, s.text as text) l
             join t on t.image_id = l.image_id group by 1) l)
    """


@query(
    "label_lookup",
    f"""
    with t as (select user_id as image_id, event_id as tok_no, value as x, {TEXT} as text,
        lower(regexp_replace({TEXT}, '\\s+', '', 'g')) as flat,
        cast(date_diff('second', timestamp '2024-01-01 00:00:00', ts) as double) as y from events)
    select u.image_id, a.v as error, b.v as click, c.v as under_view
    from (select distinct image_id from t) u left join {_label_sql('right', 'error')} a on a.image_id = u.image_id
      left join {_label_sql('right', 'click')} b on b.image_id = u.image_id
      left join {_label_sql('below', 'view')} c on c.image_id = u.image_id
    """,
)
def label_lookup(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    tokens = e.select(
        F.col("user_id").alias("image_id"), F.col("event_id").alias("tok_no"), F.col("value").alias("x"),
        F.expr(TEXT).alias("text"), F.expr(Y).alias("y"),
    ).withColumn("y2", F.col("y") + HIGH)
    return forms.label_values(tokens, {"error": "error", "click": "c lick"}, {"under_view": "view"})
