"""Audits: every rule becomes one row (table, rule, violations)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT = ("table_name", "rule", "violations")


def check_audit(df: DataFrame, table: str, rules: dict[str, str]) -> DataFrame:
    """All CHECK rules of a table in one pass. A rule that is unknown (null) holds."""
    named = {f"r{i}": rule for i, rule in enumerate(rules)}
    counted = df.agg(
        *[F.count_if(~F.coalesce(F.expr(rules[rule]), F.lit(True))).alias(c) for c, rule in named.items()]
    )
    stacked = F.explode(
        F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(c).alias("violations")) for c, rule in named.items()])
    )
    return counted.select(stacked.alias("v")).select(F.lit(table).alias("table_name"), "v.rule", "v.violations")


def unique_audit(df: DataFrame, table: str, key: Sequence[str], nulls_equal: bool = False) -> DataFrame:
    """Number of key values that occur more than once. Nulls are distinct unless declared equal."""
    rows = df
    if not nulls_equal:
        for k in key:
            rows = rows.filter(F.col(k).isNotNull())
    repeated = rows.groupBy(*key).agg(F.count("*").alias("__n")).filter("__n > 1")
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(f"unique({', '.join(key)})").alias("rule"), "violations"
    )


def reference_orphans(
    child: DataFrame, fk: str | Sequence[str], parent: DataFrame, parent_key: str | Sequence[str]
) -> DataFrame:
    """Values of a reference, of one column or several, that have no target, and the ``rows`` that hold each.

    A null in any column exempts the row. Counted per value first, so a hot value is one row in the join.
    """
    fk, parent_key = ([k] if isinstance(k, str) else list(k) for k in (fk, parent_key))
    whole = child.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(fk)]).dropna()
    held = whole.groupBy(*whole.columns).agg(F.count("*").alias("rows"))
    targets = parent.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(parent_key)]).dropna().distinct()
    orphans = held.join(targets, held.columns[:-1], "left_anti")
    return orphans.withColumnsRenamed({f"__k{i}": c for i, c in enumerate(fk)})


def reference_audit(
    child: DataFrame, table: str, fk: str | Sequence[str], parent: DataFrame, parent_key: str | Sequence[str]
) -> DataFrame:
    """Number of rows whose reference has no target."""
    named = [k if isinstance(k, str) else f"({', '.join(k)})" for k in (fk, parent_key)]
    orphans = reference_orphans(child, fk, parent, parent_key)
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(f"{named[0]} references {named[1]}").alias("rule"), "violations"
    )


def union_audits(audits: Sequence[DataFrame]) -> DataFrame:
    out = audits[0]
    for a in audits[1:]:
        out = out.unionByName(a)
    return out


def sections_in_part(entries: DataFrame, rolls: DataFrame, sections: DataFrame) -> DataFrame:
    """Entries whose section does not exist in the part of their roll."""
    placed = entries.filter("section_no is not null").join(rolls.select("roll_id", "part_id"), "roll_id")
    return placed.join(sections.select("part_id", "section_no").distinct(), ["part_id", "section_no"], "left_anti")


def key_matches_certain(placements: DataFrame) -> DataFrame:
    """Placements made by key whose confidence is not 1."""
    return placements.filter((F.col("match_method") == "epic") & ~F.col("match_confidence").eqNullSafe(F.lit(1)))


def file_verdict(
    content: Column, pages: Column, header: str = "%PDF-", trailer: str = "%%EOF", tail: int = 1024
) -> Column:
    """Why a file is not intact: missing, bad_header, truncated or unreadable; 'ok' otherwise."""
    size = F.octet_length(content)
    start = F.greatest(size - F.lit(tail - 1), F.lit(1))
    end = F.decode(F.substring(content, start, F.lit(tail)), "ISO-8859-1")
    head = F.decode(F.substring(content, 1, len(header)), "ISO-8859-1")
    return (
        F.when(content.isNull(), "missing")
        .when(head != header, "bad_header")
        .when(~F.contains(end, F.lit(trailer)), "truncated")
        .when(F.coalesce(pages, F.lit(0)) < 1, "unreadable")
        .otherwise("ok")
    )


def distinct_contents(files: DataFrame, content: str, id_col: str) -> DataFrame:
    """One row per distinct content: its hash, the first id and how many files carry it.

    Only hash and id are shuffled, never the content, and they are merged before the shuffle.
    """
    return files.groupBy(F.sha2(F.col(content), 256).alias("content_sha256")).agg(
        F.min(id_col).alias("kept_id"), F.count("*").alias("copies")
    )


def distinct_rolls(rolls: DataFrame, key: Sequence[str], seq: str = "ingest_seq") -> DataFrame:
    """One roll per natural key (nulls equal), the first that was ingested."""
    from snapledger.operators.groupwise import first_by

    return first_by(rolls, key, [F.col(seq).asc()])


def failed_strips(strips: DataFrame, key: str = "roll_id", page: str = "page", band: str = "band",
                  failed: str = "failed") -> DataFrame:
    """One row per failed strip, labelled ``p{page}/{band}``; long form, so no list can outgrow a task."""
    label = F.concat(F.lit("p"), F.col(page).cast("string"), F.lit("/"), F.col(band))
    return strips.filter(F.col(failed)).select(key, label.alias("failed_strip"))
