"""Declared rules of the domain tables, as Spark SQL over their columns."""

from __future__ import annotations

from snapledger.functions import fixed


def _in(column: str, options) -> str:
    return f"{column} in ({', '.join(repr(o) for o in options)})"


def _not_negative(*columns: str) -> dict[str, str]:
    return {f"{c} >= 0": f"{c} >= 0" for c in columns}


AREA = ("state_cd", "era_name", "ac_no")
PART = (*AREA, "part_no")

# The CHECK rules, unique keys and references of the domain tables.
NET = ("net_male", "net_female", "net_third_gender", "net_total")

CHECKS: dict[str, dict[str, str]] = {
    "deletion_reason": {"known code": _in("code", fixed.REASONS)},
    "state": {"code shape": f"state_cd rlike '{fixed.STATE_CODE_SHAPE}'"},
    "parliamentary_constituency": {
        "pc_no >= 1": "pc_no >= 1", "known reservation": _in("reservation_status", fixed.RESERVATIONS),
    },
    "assembly_constituency": {
        "ac_no >= 1": "ac_no >= 1", "known reservation": _in("reservation_status", fixed.RESERVATIONS),
    },
    "part": {
        "part_no >= 1": "part_no >= 1",
        "pin shape": f"pin_code rlike '{fixed.PIN_SHAPE}'",
        "polling_station_no >= 1": "polling_station_no >= 1",
        "known station type": _in("polling_station_type", fixed.STATION_TYPES),
        **_not_negative("num_auxiliary_stations"),
    },
    "section": {"section_no >= 1": "section_no >= 1"},
    "roll": {
        "known roll type": _in("roll_type", fixed.ROLL_TYPES),
        "language shape": f"language_code rlike '{fixed.LANGUAGE_SHAPE}'",
        "total_pages >= 1": "total_pages >= 1",
    },
    "supplement": {"supplement_no >= 1": "supplement_no >= 1"},
    "elector": {
        "serial_no >= 1": "serial_no >= 1",
        "known relation": _in("relation_type", fixed.RELATIONS),
        **_not_negative("age"),
        "known gender": _in("gender", fixed.GENDERS),
        "known status": _in("entry_status", fixed.STATUSES),
        "source_page >= 1": "source_page >= 1",
        "reason only when deleted": "deletion_reason_code is null or entry_status = 'deleted'",
    },
    "summary": _not_negative(*NET, "num_modifications"),
    "ac_lineage": {"known change": _in("change_type", fixed.CHANGES)},
    "summary_row": {
        "known ordinal": _in("row_ordinal", ("I", "II", "III", "IV")),
        "total adds up": "total = male + female + third_gender",
        **{f"{c} >= 0 unless IV": f"row_ordinal = 'IV' or {c} is null or {c} >= 0"
           for c in ("male", "female", "third_gender")},
    },
    "cover_count": {
        "starting_serial_no >= 1": "starting_serial_no >= 1",
        **_not_negative(*NET),
        "serials in order": "ending_serial_no >= starting_serial_no",
    },
    "placement": {
        "known method": _in("match_method", ("epic", "fuzzy", "manual")),
        "confidence between 0 and 1": "match_confidence between 0 and 1",
    },
    "job": {"known status": _in("status", fixed.JOB_STATUSES)},
}

# table -> unique keys; True: nulls count as equal
UNIQUE: dict[str, list[tuple[tuple[str, ...], bool]]] = {
    "state": [(("state_cd",), False)],
    "district": [(("state_cd", "district_name"), False)],
    "parliamentary_constituency": [(("state_cd", "pc_no"), False)],
    "assembly_constituency": [(AREA, False)],
    "part": [(PART, False)],
    "section": [((*PART, "section_no"), False)],
    "roll": [
        (("part_id", "year_of_revision", "roll_type", "revision_no", "language_code"), True),
        (("source_pdf_sha256",), False),
    ],
    "supplement": [(("roll_id", "supplement_no"), False)],
    "elector": [(("roll_id", "serial_no"), False)],
    "summary": [(("roll_id",), False)],
    "summary_row": [(("roll_id", "row_ordinal"), False)],
    "cover_count": [(("roll_id",), False)],
    "person": [(("epic_no",), False)],
    "person_epic": [(("epic_no",), False)],
    "placement": [(("roll_id", "serial_no"), False)],
    "job": [(("state_cd", "ac_no", "year", "roll_type", "language", "part_no"), False)],
}

# table -> columns that are never null
REQUIRED: dict[str, tuple[str, ...]] = {
    "state": ("state_cd", "state_name"),
    "district": ("state_cd", "district_name"),
    "parliamentary_constituency": ("state_cd", "pc_no", "pc_name"),
    "assembly_constituency": (*AREA, "ac_name"),
    "part": (*PART, "num_auxiliary_stations"),
    "section": (*PART, "section_no"),
    "ac_lineage": ("change_type",),
    "roll": ("roll_id", "part_id", "year_of_revision", "roll_type", "language_code"),
    "supplement": ("roll_id", "supplement_no"),
    "elector": ("roll_id", "serial_no", "full_name", "photo_present", "entry_status"),
    "summary": ("roll_id",),
    "summary_row": ("roll_id", "row_ordinal"),
    "cover_count": ("roll_id",),
    "person_epic": ("person_id", "epic_no"),
    "placement": ("person_id", "roll_id", "serial_no", "match_method"),
}

# (child, column or columns, parent, its column or columns)
REFERENCES: list[tuple[str, str | tuple[str, ...], str, str | tuple[str, ...]]] = [
    ("assembly_constituency", ("state_cd", "district_name"), "district", ("state_cd", "district_name")),
    ("assembly_constituency", ("state_cd", "pc_no"), "parliamentary_constituency", ("state_cd", "pc_no")),
    ("part", AREA, "assembly_constituency", AREA),
    ("section", PART, "part", PART),
    ("roll", PART, "part", PART),
    ("elector", (*PART, "section_no"), "section", (*PART, "section_no")),
    ("elector", ("roll_id", "supplement_no"), "supplement", ("roll_id", "supplement_no")),
    ("summary_row", ("roll_id", "supplement_no"), "supplement", ("roll_id", "supplement_no")),
    ("placement", ("roll_id", "serial_no"), "elector", ("roll_id", "serial_no")),
    ("ac_lineage", AREA, "assembly_constituency", AREA),
    ("ac_lineage", tuple(f"predecessor_{c}" for c in AREA), "assembly_constituency", AREA),
    ("district", "state_cd", "state", "state_cd"),
    ("parliamentary_constituency", "state_cd", "state", "state_cd"),
    ("assembly_constituency", "state_cd", "state", "state_cd"),
    ("roll", "era_name", "era", "era_name"),
    ("supplement", "roll_id", "roll", "roll_id"),
    ("elector", "roll_id", "roll", "roll_id"),
    ("elector", "deletion_reason_code", "deletion_reason", "code"),
    ("summary", "roll_id", "roll", "roll_id"),
    ("summary_row", "roll_id", "summary", "roll_id"),
    ("cover_count", "roll_id", "roll", "roll_id"),
    ("person_epic", "person_id", "person", "person_id"),
    ("person_epic", "first_roll_id", "roll", "roll_id"),
    ("placement", "person_id", "person", "person_id"),
    ("placement", "roll_id", "roll", "roll_id"),
]


def audit(tables: dict) -> "DataFrame":  # noqa: F821
    """All declared rules over whichever domain tables are given."""
    from snapledger.operators import quality

    found = []
    for name, df in tables.items():
        rules = {n: e for n, e in CHECKS.get(name, {}).items() if all(w in df.columns for w in _columns(e))}
        rules |= {f"{c} not null": f"{c} is not null" for c in REQUIRED.get(name, ()) if c in df.columns}
        if rules:
            found.append(quality.check_audit(df, name, rules))
        for key, nulls_equal in UNIQUE.get(name, []):
            if set(key) <= set(df.columns):
                found.append(quality.unique_audit(df, name, key, nulls_equal))
    for child, fk, parent, parent_key in REFERENCES:
        columns = [(fk,) if isinstance(fk, str) else fk, (parent_key,) if isinstance(parent_key, str) else parent_key]
        if child in tables and parent in tables and {*columns[0]} <= {*tables[child].columns} and {*columns[1]} <= {*tables[parent].columns}:
            found.append(quality.reference_audit(tables[child], child, fk, tables[parent], parent_key))
    return quality.union_audits(found)


def _columns(expression: str) -> set[str]:
    """Column names in one of the rules above: its bare words that are not SQL words or quoted text."""
    import re

    bare = re.sub(r"'[^']*'", " ", expression)
    return set(re.findall(r"[a-z_]+", bare)) - {"in", "is", "null", "or", "and", "between", "rlike"}
