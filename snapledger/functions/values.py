"""Normalisers for single values: codes, enumerations, dates, numbers."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapledger.functions import fixed
from snapledger.functions.text import as_col, filled, group, strip, to_int, truthy, without_blanks


def relation(c: Column | str) -> Column:
    low = F.lower(strip(c))
    return (
        F.when(~truthy(c), None)
        .when(low.startswith("father"), "Father")
        .when(low.startswith("husband"), "Husband")
        .when(low.startswith("mother"), "Mother")
        .otherwise("Other")
    )


def gender(c: Column | str) -> Column:
    low = without_blanks(F.lower(strip(c)))
    return (
        F.when(low.isin("male", "m"), "Male")
        .when(low.isin("female", "f"), "Female")
        .when(F.contains(low, F.lit("third")) | low.isin("tg", "o"), "ThirdGender")
    )


def key(c: Column | str) -> Column:
    """Document key: stripped, upper case, without blanks."""
    return without_blanks(F.upper(strip(c)))


def reason(c: Column | str) -> Column:
    """Reason code, null unless it is one of the known letters."""
    c = as_col(c)
    return F.when(strip(c).isin(*fixed.REASONS), c)


def iso_date(c: Column | str) -> Column:
    """DD-MM-YYYY, DD/MM/YYYY or YYYY-MM-DD -> date; anything else, month 13 included, -> null."""
    dashed = F.replace(as_col(c), F.lit("/"), F.lit("-"))
    return F.coalesce(
        F.when(dashed.rlike("^[0-9]{2}-"), F.try_to_date(dashed, "dd-M-yyyy")),
        F.when(dashed.rlike("^[0-9]{4}-"), F.try_to_date(dashed, "yyyy-M-d")),
    )


def reservation(c: Column | str) -> Column:
    """GEN / SC / ST. The spelled-out names are tested before the two-letter prefixes."""
    up = F.upper(strip(c))
    return (
        F.when(up.startswith("GEN"), "GEN")
        .when(F.contains(up, F.lit("SCHEDULED CASTE")), "SC")
        .when(F.contains(up, F.lit("SCHEDULED TRIBE")), "ST")
        .when(up.startswith("SC"), "SC")
        .when(up.startswith("ST"), "ST")
    )


def station_type(c: Column | str) -> Column:
    low = F.lower(strip(c))
    return F.when(low.startswith("male"), "Male").when(low.startswith("female"), "Female").otherwise("General")


def roll_year(label: Column | str) -> Column:
    return to_int(group(label, r"(\d{4})"))


def roll_type(label: Column | str) -> Column:
    """Roll label without its trailing year, as a type token; any supplement -> Supplement."""
    base = strip(F.regexp_replace(as_col(label), r"\s*-?\s*\d{4}\s*$", ""))
    return F.when(F.contains(F.lower(base), F.lit("supplement")), "Supplement").otherwise(
        F.regexp_replace(base, r"\s+", "_")
    )


def language_code(name: Column | str) -> Column:
    return F.upper(F.substring(strip(name), 1, 3))


def scope_languages(langs: Column | str, mode: str) -> Column:
    """``all`` keeps the list, ``first`` its head, ``english`` the English ones or else its head."""
    langs = as_col(langs)
    head = F.slice(langs, 1, 1)
    if mode == "first":
        return head
    if mode == "english":
        english = F.filter(langs, lambda x: F.contains(F.lower(x), F.lit("english")))
        return F.when(F.size(english) > 0, english).otherwise(head)
    return langs


def file_context(name: Column | str) -> list[Column]:
    """File name -> state, area, language, part and roll type (nulls where the name says nothing)."""
    name = as_col(name)
    draft, final = F.contains(name, F.lit("DraftRoll")), F.contains(name, F.lit("FinalRoll"))
    return [
        F.upper(group(name, fixed.FILE_NAME, 1)).alias("state_cd"),
        to_int(group(name, fixed.FILE_NAME, 2)).alias("ac_no"),
        F.upper(group(name, fixed.FILE_NAME, 3)).alias("language_code"),
        to_int(group(name, fixed.FILE_NAME, 4)).alias("part_no"),
        F.when(draft, "SIR_DraftRoll")
        .when(final & F.contains(name, F.lit("SIR")), "SIR_FinalRoll")
        .when(final, "FinalRoll")
        .alias("roll_type"),
    ]


def part_in_file(name: Column | str) -> Column:
    return to_int(group(name, fixed.PART_IN_FILE))


def constituency(line: Column | str) -> Column:
    """``...: {no}-{NAME}({RES})`` -> struct(no, name, reservation); the bracket is optional."""
    tail = F.substring_index(as_col(line), ":", -1)
    pattern = r"(\d+)\s*-\s*(.+?)\s*(?:\(([A-Za-z]+)\)|$)"
    return F.struct(
        to_int(group(tail, pattern, 1)).alias("no"),
        strip(group(tail, pattern, 2)).alias("name"),
        F.upper(group(tail, pattern, 3)).alias("reservation"),
    )


def roll_title(title: Column | str) -> Column:
    return F.struct(
        to_int(group(title, fixed.ROLL_TITLE, 1)).alias("year"),
        strip(group(title, fixed.ROLL_TITLE, 2)).alias("state_name"),
    )


def age_in(line: Column | str) -> Column:
    return to_int(group(F.lower(as_col(line)), r"age\s*[:.]?\s*(\d{1,3})"))


def gender_in(line: Column | str) -> Column:
    """Leftmost gender word of a line."""
    word = group(F.lower(as_col(line)), r"(female|male|third\s*gender|transgender)")
    return (
        F.when(word == "female", "Female")
        .when(word == "male", "Male")
        .when(word.isNotNull(), "ThirdGender")
    )


def lifecycle(status: Column | str, reason_code: Column | str) -> Column:
    """Status of an entry as a life event; a deletion without a known reason is just 'removed', none is active."""
    status, reason_code = as_col(status), as_col(reason_code)
    out = F.when(F.coalesce(status, F.lit("active")) != "deleted", "active")
    for code, meaning in fixed.LIFECYCLE.items():
        out = out.when(reason_code == code, meaning)
    return out.otherwise("removed")


def region(header: Column | str) -> Column:
    """Region named by a strip header; null when there is no header."""
    flat = without_blanks(F.lower(as_col(header)))
    return (
        F.when(F.contains(flat, F.lit("addition")), "additions")
        .when(F.contains(flat, F.lit("deletion")), "deletions")
        .when(F.contains(flat, F.lit("sectionno")), "main_roll")
    )


def supplement_no(header: Column | str) -> Column:
    return to_int(group(F.lower(as_col(header)), r"additions?\s+(\d+)"))


def page_kind(page: Column | str, pages: Column | str) -> Column:
    """1 cover, 2 skipped, last summary, the rest voter pages; under three pages is an error."""
    page, pages = as_col(page), as_col(pages)
    return (
        F.when(pages < fixed.FIRST_VOTER_PAGE, "error")
        .when(page == 1, "cover")
        .when(page == pages, "summary")
        .when(page == 2, "skipped")
        .otherwise("voter")
    )


def page_bands(y: Column | str, height: Column | str) -> Column:
    """Bands a position lies in; the two overlap, so it may be in both.

    Their borders are fractions of whole numbers: as a double, 0.55 of 200 would lie above 110.
    """
    y, height = as_col(y), as_col(height)
    top, bottom = (Fraction(str(part)) for part in (fixed.TOP_BAND_END, fixed.BOTTOM_BAND_START))
    return F.array_compact(
        F.array(
            F.when(y < height * top.numerator / top.denominator, "top"),
            F.when(y >= height * bottom.numerator / bottom.denominator, "bot"),
        )
    )


def storage_key(state: Column | str, area: Column | str, file: Column | str) -> Column:
    return F.concat_ws("/", as_col(state), as_col(area).cast("string"), as_col(file))


def state_name(code: Column | str) -> Column:
    """Name of a state code from the fixed list (36 entries, so a literal map)."""
    pairs = [F.lit(v) for item in fixed.STATE_NAMES.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), as_col(code))


def clean_or(c: Column | str, *fallbacks: Column) -> Column:
    """First filled text of a default chain."""
    return F.coalesce(filled(c), *fallbacks)
