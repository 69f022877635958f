"""Two perturbed reads of the same records, with whole texts and whole tables."""

from pyspark.sql import functions as F

from snapledger.operators import consensus, resolve
from snapledger.queries.registry import Tables, query

FIELDS = ("name", "relation_type", "relation_name", "house_number")
TRUTH = {"name": "p_name", "relation_type": "p_brand", "relation_name": "p_type", "house_number": "cast(p_size as varchar(9))"}
FIRST = {
    "name": "case when p_partkey % 5 = 0 then replace(p_name, 'e', 'a') else p_name end",
    "relation_type": "case when p_partkey % 7 = 0 then '' else p_brand end",
    "relation_name": "p_type",
    "house_number": "case when p_partkey % 4 = 0 then null else cast(p_size as varchar(9)) end",
}
SECOND = {
    "name": "case when p_partkey % 3 = 0 then concat(p_name, 's') else p_name end",
    "relation_type": "p_brand",
    "relation_name": "case when p_partkey % 6 = 0 then lower(p_type) else p_type end",
    "house_number": "case when p_partkey % 8 = 0 then null else cast(p_size as varchar(9)) end",
}
THIRD_KEPT = "p_partkey % 10 <> 9"


def _read(spark, sf_dir, fields):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", *[F.expr(v).alias(k) for k, v in fields.items()])


def _cols(tag, fields):
    return ", ".join(f"{v} as {tag}_{k}" for k, v in fields.items())


READS_SQL = (
    f"r as (select p_partkey, {THIRD_KEPT} as third, {_cols('a', FIRST)}, {_cols('b', SECOND)}, {_cols('t', TRUTH)} from part)"
)


@query(
    "reader_consensus",
    f"""
    with {READS_SQL},
    d as (select *, {", ".join(f"a_{f} is distinct from b_{f} as x_{f}" for f in FIELDS)} from r)
    select p_partkey, {", ".join(f"case when x_{f} and third then t_{f} else a_{f} end as {f}" for f in FIELDS)},
      case when third and ({" or ".join(f"x_{f}" for f in FIELDS)}) then '' else
        concat_ws(',', {", ".join(f"case when x_{f} then '{f}' end" for f in FIELDS)}) end as flagged,
      cast({" + ".join(f"x_{f}::int" for f in FIELDS)} as integer) as n_differ
    from d
    """,
)
def reader_consensus(spark, sf_dir):
    first, second = _read(spark, sf_dir, FIRST), _read(spark, sf_dir, SECOND)
    asked = consensus.to_escalate(first, second, "p_partkey", FIELDS)
    third = _read(spark, sf_dir, TRUTH).filter(THIRD_KEPT).join(asked, "p_partkey", "left_semi")
    out = consensus.consensus(first, second, third, "p_partkey", FIELDS)
    return out.withColumn("flagged", F.concat_ws(",", "flagged"))


@query(
    "escalation_rate",
    f"""
    with {READS_SQL},
    d as (select {" + ".join(f"(a_{f} is distinct from b_{f})::int" for f in FIELDS)} as n from r)
    select count(*) as records, cast(sum(n) as bigint) as escalated, round(sum(n) / (count(*) * 4), 6) as escalated_rate from d
    """,
)
def escalation_rate(spark, sf_dir):
    return consensus.escalation_rate(_read(spark, sf_dir, FIRST), _read(spark, sf_dir, SECOND), "p_partkey", FIELDS)


@query(
    "extraction_scores",
    f"""
    with {READS_SQL} """ + " union all ".join(
        f"select count(*) as records, '{f}' as field, count(*) filter (where coalesce(a_{f}, '') = t_{f}) as exact, "
        f"cast(sum(levenshtein(coalesce(a_{f}, ''), t_{f})) as bigint) as edits, "
        f"cast(sum(greatest(length(t_{f}), 1)) as bigint) as chars from r" for f in FIELDS
    ),
)
def extraction_scores(spark, sf_dir):
    return consensus.field_scores(_read(spark, sf_dir, FIRST), _read(spark, sf_dir, TRUTH), "p_partkey", FIELDS)


@query(
    "char_accuracy",
    f"""
    with {READS_SQL}, s as (""" + " union all ".join(
        f"select count(*) as records, count(*) filter (where coalesce(a_{f}, '') = t_{f}) as exact, "
        f"cast(sum(levenshtein(coalesce(a_{f}, ''), t_{f})) as bigint) as edits, "
        f"cast(sum(greatest(length(t_{f}), 1)) as bigint) as chars from r" for f in FIELDS
    ) + ") select round(1 - sum(edits) / greatest(sum(chars), 1), 6) as char_accuracy, "
        "round(avg(exact / records), 6) as avg_field_accuracy from s",
)
def char_accuracy(spark, sf_dir):
    return consensus.char_accuracy(extraction_scores(spark, sf_dir))


LINE = "concat_ws(' | ', {0})"


@query(
    "line_scores",
    f"""
    with {READS_SQL}, l as (select
      ' ' || {" || ' | ' || ".join(f"coalesce(a_{f}, '')" for f in FIELDS)} as p, {" || ' | ' || ".join(f"t_{f}" for f in FIELDS)} as t from r)
    select count(*) as records, cast(sum(levenshtein(trim(p), t)) as bigint) as edits,
      greatest(cast(sum(length(t)) as bigint), 1) as chars,
      {", ".join(f"count(*) filter (where trim(coalesce(split_part(p, ' | ', {i + 1}), '')) = trim(split_part(t, ' | ', {i + 1}))) as exact_{i}" for i in range(4))}
    from l
    """,
)
def line_scores(spark, sf_dir):
    from snapledger.functions.text import joined

    p = Tables(spark, sf_dir).part
    lines = p.select(
        F.concat(F.lit(" "), joined([F.expr(FIRST[f]) for f in FIELDS])).alias("p"),
        joined([F.expr(TRUTH[f]) for f in FIELDS]).alias("t"),
    )
    return consensus.line_scores(lines, "p", "t", 4)


@query(
    "positional_scores",
    """
    with r as (select p_name as t, case when p_partkey % 5 = 0 then replace(p_name, 'e', 'aa')
                 when p_partkey % 7 = 0 then '' else p_name end as p from part)
    select cast(sum(len(list_filter(range(1, least(length(p), length(t)) + 1), lambda i: substr(p, i, 1) = substr(t, i, 1))))
        as bigint) as chars_ok, cast(sum(length(t)) as bigint) as chars, count(*) filter (where p = t) as exact,
      count(*) as records from r
    """,
)
def positional_scores(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        F.col("p_name").alias("t"),
        F.expr("case when p_partkey % 5 = 0 then replace(p_name, 'e', 'aa') when p_partkey % 7 = 0 then '' "
               "else p_name end").alias("p"),
    )
    return consensus.positional_scores(p, "p", "t")


@query(
    "best_checkpoint",
    """
    select l_suppkey, arg_max(l_linenumber, (l_discount, l_linenumber)) as best_epoch, max(l_discount) as best_score
    from lineitem group by 1
    """,
)
def best_checkpoint(spark, sf_dir):
    return consensus.best_checkpoint(Tables(spark, sf_dir).lineitem, ["l_suppkey"], "l_discount", "l_linenumber")


@query(
    "mode_vote",
    """
    with c as (select l_partkey, l_linenumber, count(*) as votes from lineitem group by 1, 2)
    select * from c qualify row_number() over (partition by l_partkey order by votes desc, l_linenumber) = 1
    """,
)
def mode_vote(spark, sf_dir):
    return consensus.mode_vote(Tables(spark, sf_dir).lineitem, ["l_partkey"], "l_linenumber")


FLAG = "case when doc_id % 9 = 0 then 'no_stamp_exclude' when doc_id % 2 = 0 then 'x' end"


@query(
    "holdout_split",
    f"""
    with s as (select d.doc_id, {FLAG.replace('doc_id', 'd.doc_id')} as flag, l.quality = 0 as uncertain, l.toxic = 1 as review
               from documents d left join labels l on l.doc_id = d.doc_id),
    pool as (select * from s where flag is distinct from 'no_stamp_exclude'),
    val as (select doc_id from pool where not coalesce(uncertain, false) and not coalesce(review, false)
            order by md5('0|' || doc_id), doc_id limit 40)
    select doc_id, 'val' as split from val
    union all select doc_id, 'train' from pool where doc_id not in (select doc_id from val)
    """,
)
def holdout_split(spark, sf_dir):
    from snapledger.operators.groupwise import lookup

    t = Tables(spark, sf_dir)
    docs = lookup(t.documents.select("doc_id", F.expr(FLAG).alias("flag")), t.labels, ["doc_id"], ["quality", "toxic"])
    samples = docs.select("doc_id", "flag", (F.col("quality") == 0).alias("uncertain"), (F.col("toxic") == 1).alias("review"))
    pool = consensus.trainable(samples)
    val, train = consensus.holdout(pool, consensus.clean(pool), "doc_id", 40)
    return val.select("doc_id", F.lit("val").alias("split")).unionByName(
        train.select("doc_id", F.lit("train").alias("split"))
    )


@query(
    "read_override",
    f"""
    with {READS_SQL}
    select p_partkey, coalesce(case when p_partkey % 2 = 0 then nullif(b_name, '') end, a_name) as name,
      coalesce(case when p_partkey % 2 = 0 then nullif(b_relation_type, '') end, a_relation_type) as relation_type from r
    """,
)
def read_override(spark, sf_dir):
    first, second = _read(spark, sf_dir, FIRST), _read(spark, sf_dir, SECOND)
    fields = ["name", "relation_type"]
    out = resolve.override(first, second.filter("p_partkey % 2 = 0"), ["p_partkey"], fields)
    return out.select("p_partkey", *fields)
