"""String helpers shared by the normalisers; all built-in expressions, so codegen stays whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapledger.functions import fixed

BLANKS = " \t\n\r\f\x0b"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of ASCII white space, not only blanks."""
    return F.btrim(as_col(c), F.lit(BLANKS))


def filled(c: Column | str) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def truthy(c: Column | str) -> Column:
    """Text that is neither null nor empty."""
    return F.coalesce(as_col(c) != "", F.lit(False))


def group(c: Column | str, pattern: str, k: int = 1) -> Column:
    """Regex group ``k``; null (not '') when the pattern does not match."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, k), F.lit(""))


def to_int(c: Column | str) -> Column:
    return as_col(c).try_cast("int")


def despace(c: Column | str) -> Column:
    """Text without any ASCII white space (a character map: far cheaper than a pattern)."""
    return F.translate(as_col(c), BLANKS, "")


def without_blanks(c: Column | str) -> Column:
    return F.replace(as_col(c), F.lit(" "), F.lit(""))


def after_colon(c: Column | str) -> Column:
    """Text after the first colon, the whole text when there is none."""
    c = as_col(c)
    return strip(F.when(F.contains(c, F.lit(":")), F.regexp_replace(c, r"(?s)^[^:]*:", "")).otherwise(c))


def strip_label(c: Column | str) -> Column:
    """Text after the first colon, else the text without a known leading label."""
    c = as_col(c)
    return F.when(F.contains(c, F.lit(":")), after_colon(c)).otherwise(
        strip(F.regexp_replace(c, fixed.LABEL_PREFIX, ""))
    )


def strip_tags(c: Column | str) -> Column:
    """Markup tags and hard blanks become blanks."""
    return strip(F.replace(F.regexp_replace(as_col(c), "<[^>]+>", " "), F.lit("&nbsp;"), F.lit(" ")))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither null nor ''."""
    return F.coalesce(*[F.nullif(as_col(c), F.lit("")) for c in cols])


def contains_any(c: Column | str, needles: Sequence[str]) -> Column:
    """One alternation, so that a computed ``c`` is evaluated once even where a filter inlines it."""
    return as_col(c).rlike("|".join(rf"\Q{needle}\E" for needle in needles))


def code_shaped(c: Column | str) -> Column:
    return F.coalesce(as_col(c).rlike(fixed.STATE_CODE_SHAPE), F.lit(False))


def numbered_name(c: Column | str, number: str = "no", name: str = "name") -> list[Column]:
    """``{no} - {name}`` -> two columns; both null when the text has another form."""
    pattern = r"^(\d+)\s*-\s*(.+)$"
    return [to_int(group(c, pattern, 1)).alias(number), strip(group(c, pattern, 2)).alias(name)]


def tagged(values: dict[str, Column]) -> Column:
    """Fields -> one tagged sequence; a null field is written as an empty one."""
    parts = []
    for field, value in values.items():
        parts += [F.lit(f"<s_{field}>"), F.coalesce(value.cast("string"), F.lit("")), F.lit(f"</s_{field}>")]
    return F.concat(*parts)


def untagged(c: Column | str, fields: Sequence[str]) -> list[Column]:
    """One tagged sequence -> its fields, '' where a tag is missing."""
    c = F.coalesce(as_col(c), F.lit(""))
    return [strip(F.regexp_extract(c, f"(?s)<s_{f}>(.*?)</s_{f}>", 1)).alias(f) for f in fields]


def joined(values: Sequence[Column], sep: str = " | ") -> Column:
    """Fields in one line; nulls keep their place."""
    return F.concat_ws(sep, *[F.coalesce(v.cast("string"), F.lit("")) for v in values])
