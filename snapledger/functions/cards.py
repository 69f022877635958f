"""Rules on one card row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapledger.functions import fixed, values
from snapledger.functions.text import as_col, filled, strip, to_int, truthy


def coerced(card: Column | str) -> list[Column]:
    """Raw payload card (a struct) -> typed columns. ``serial_no`` is null when it is malformed."""
    card = as_col(card)
    return [
        to_int(strip(card["serial_no"])).alias("serial_no"),
        filled(card["epic_no"]).alias("epic_no"),
        F.coalesce(strip(card["full_name"]), F.lit("")).alias("full_name"),
        filled(card["relation_type"]).alias("relation_type"),
        filled(card["relation_name"]).alias("relation_name"),
        filled(card["house_number"]).alias("house_number"),
        F.nullif(card["age"], F.lit(0)).alias("age"),
        filled(card["gender"]).alias("gender"),
        filled(card["marker_box"]).alias("marker_box"),
        F.coalesce(card["deleted_watermark"], F.lit(False)).alias("deleted_watermark"),
        filled(card["deletion_reason_code"]).alias("deletion_reason_code"),
    ]


def normalised() -> dict[str, Column]:
    """The four fields that are cleaned before reads are compared."""
    return {
        "relation_type": values.relation("relation_type"),
        "gender": values.gender("gender"),
        "epic_no": F.when(truthy("epic_no"), values.key("epic_no")).otherwise(F.col("epic_no")),
        "deletion_reason_code": values.reason("deletion_reason_code"),
    }


def completeness(texts: list[Column | str], numbers: list[Column | str] = ()) -> Column:
    """How many fields carry something: '' , 0 and null do not count."""
    score = F.lit(0)
    for c in texts:
        score = score + truthy(c).cast("int")
    for c in numbers:
        score = score + F.coalesce(as_col(c) != 0, F.lit(False)).cast("int")
    return score


def card_completeness() -> Column:
    return completeness(["epic_no", "full_name", "relation_name", "house_number", "gender"], ["age"])


def inferred_status(
    region: Column | str = "region",
    marker: Column | str = "marker_box",
    stamp: Column | str = "deleted_watermark",
    reason: Column | str = "deletion_reason_code",
    supplement: Column | str = "supplement_no",
) -> Column:
    """struct(status, reason, section_no, supplement_no) that region, marker, stamp and reason imply.

    ``section_no`` and ``supplement_no`` are null where the rule finds none; the caller keeps
    its old value then.
    """
    region, reason, supplement = as_col(region), as_col(reason), as_col(supplement)
    box = F.coalesce(strip(marker), F.lit(""))
    letter = F.when(box.isin(*fixed.REASONS), box)
    why = F.coalesce(F.nullif(reason, F.lit("")), letter)
    in_main, in_add, in_del = region == "main_roll", region == "additions", region == "deletions"
    struck = in_main & (F.coalesce(as_col(stamp), F.lit(False)) | why.isNotNull())
    status = (
        F.when(struck | in_del, "deleted")
        .when(in_main & F.contains(box, F.lit("#")), "modified")
        .when(in_add, "added")
        .otherwise("active")
    )
    return F.struct(
        status.alias("status"),
        F.when(status == "deleted", why).alias("reason"),
        F.when((status == "added") & box.rlike("^[0-9]+$"), to_int(box)).alias("section_no"),
        F.when(in_add | in_del | (status == "modified"), supplement).alias("supplement_no"),
    )


def flags(
    key: Column | str = "epic_no",
    age: Column | str = "age",
    gender: Column | str = "gender",
    name: Column | str = "full_name",
) -> Column:
    """Names of the structural rules a card breaks."""
    key, age, gender = as_col(key), as_col(age), as_col(gender)
    return F.array_compact(
        F.array(
            F.when(truthy(key) & ~key.rlike(fixed.KEY_SHAPE), "epic_format"),
            F.when(~age.between(0, 120), "age_range"),
            F.when(truthy(gender) & ~gender.isin(*fixed.GENDERS), "gender_enum"),
            F.when(~truthy(name), "missing_name"),
        )
    )


def confidence(flag_list: Column | str) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.lit(1.0) - F.size(as_col(flag_list)) * 0.25), 3)
