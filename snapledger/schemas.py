"""Declared shapes of the roll domain (DDL strings; Spark parses them where used)."""

CARD_FIELDS = (
    "serial_no string, marker_box string, epic_no string, full_name string, relation_type string, "
    "relation_name string, house_number string, age int, gender string, deleted_watermark boolean, "
    "deletion_reason_code string"
)

STRIP_PAYLOAD = f"section_header string, cards array<struct<{CARD_FIELDS}>>"

TOKENS = (
    "image_id string, tok_no int, engine string, x double, y double, x2 double, y2 double, "
    "text string, conf double"
)

SUMMARY_PAYLOAD = (
    "net_male int, net_female int, net_third_gender int, net_total int, additions_total int, "
    "deletions_total int, num_modifications int"
)

COVER_PAYLOAD = (
    "state_name string, year_of_revision int, qualifying_date string, type_of_revision string, "
    "date_of_publication string, date_of_updation string, roll_identification string, ac_no int, "
    "ac_name string, ac_reservation string, pc_no int, pc_name string, part_no int, "
    "district_name string, main_town_or_village string, post_office string, police_station string, "
    "tehsil_mandal string, block string, taluk string, pin_code string, polling_station_no int, "
    "polling_station_name string, polling_station_address string, polling_station_type string, "
    "num_auxiliary_stations int, sections array<struct<section_no:int,section_name:string>>, "
    "starting_serial_no int, ending_serial_no int, net_male int, net_female int, "
    "net_third_gender int, net_total int"
)

JOB_KEY = ("state_cd", "ac_no", "year", "roll_type", "language", "part_no")
JOB_EVENTS = (
    "seq bigint, ts timestamp, state_cd string, ac_no int, year int, roll_type string, "
    "language string, part_no int, event string, status string, stage string, error string, "
    "reconciles boolean, elector_count int, archive_uri string"
)

SAMPLES = (
    "crop string, flag string, uncertain boolean, review boolean, name string, "
    "relation_type string, relation_name string, house_number string, age int, gender string"
)

#: Numbers of areas are those of an era: one number in two eras is two areas.
_AREA = "state_cd string, era_name string, ac_no int"
_PART = f"{_AREA}, part_no int"
#: The tables that a load writes; each also has the number of its batch.
WAREHOUSE = {
    "state": "roll_id string, state_cd string, state_name string",
    "district": "roll_id string, state_cd string, district_name string, district_cd string",
    "parliamentary_constituency": "roll_id string, state_cd string, pc_no int, pc_name string",
    "assembly_constituency": (
        f"roll_id string, {_AREA}, ac_name string, district_name string, pc_no int, reservation_status string"
    ),
    "ac_lineage": (
        "predecessor_state_cd string, predecessor_era_name string, predecessor_ac_no int, state_cd string, era_name string, "
        "ac_no int, change_type string"
    ),
    "part": (
        f"roll_id string, {_PART}, main_town_or_village string, post_office string, police_station string, "
        "tehsil_mandal string, block string, taluk string, pin_code string, polling_station_no int, "
        "polling_station_name string, polling_station_address string, polling_station_type string, num_auxiliary_stations int"
    ),
    "section": f"roll_id string, {_PART}, section_no int, section_name string",
    "roll": (
        f"roll_id string, {_PART}, part_id string, year_of_revision int, qualifying_date date, "
        "type_of_revision string, date_of_publication date, date_of_updation date, roll_identification string, "
        "roll_type string, revision_no int, language_code string, total_pages int, source_pdf_filename string, "
        "source_pdf_sha256 string"
    ),
    "elector": (
        f"roll_id string, {_PART}, section_no int, serial_no int, epic_no string, full_name string, relation_type string, "
        "relation_name string, house_number string, age int, gender string, photo_present boolean, entry_status string, "
        "deletion_reason_code string, supplement_no int, modification_marker_raw string, source_page int, confidence double, "
        "flags array<string>"
    ),
    "supplement": "roll_id string, supplement_no int, type_of_revision string, inferred boolean",
    "summary": f"roll_id string, {SUMMARY_PAYLOAD}, ending_serial_no int",
    "summary_row": (
        "roll_id string, row_ordinal string, row_label string, roll_type_label string, roll_identification string, "
        "supplement_no int, male int, female int, third_gender int, total int"
    ),
    "cover_count": (
        "roll_id string, starting_serial_no int, ending_serial_no int, net_male int, net_female int, "
        "net_third_gender int, net_total int"
    ),
    "person": "person_id string, epic_no string, canonical_name string",
    "person_epic": "person_id string, epic_no string, first_roll_id string",
    "placement": (
        "person_id string, roll_id string, serial_no int, match_method string, match_confidence decimal(4,3)"
    ),
    "placement_fuzzy": (
        "person_id string, roll_id string, serial_no int, match_method string, match_confidence decimal(4,3)"
    ),
}
