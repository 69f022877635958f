"""Small synthetic documents; nothing here describes a real person."""

import json


def card(serial, name="A", **kw):
    base = {"serial_no": serial, "full_name": name, "marker_box": "", "epic_no": f"ABC{int(serial):07d}" if str(serial).isdigit() else "",
            "relation_type": "Father", "relation_name": "B", "house_number": "1", "age": 30, "gender": "Male",
            "deleted_watermark": False, "deletion_reason_code": ""}
    return base | kw


def strip(roll, page, band, header, cards):
    return (roll, page, band, json.dumps({"section_header": header, "cards": cards}))


PAYLOADS = "roll_id string, page int, band string, payload string"


def good_roll(roll="r1"):
    """Main roll 1-5 (2 deleted, 3 modified), additions 6-7, deletion 8."""
    return [
        strip(roll, 3, "top", "Section No and Name 1-Block", [card(1), card(2, marker_box="E"), card(3, marker_box="#")]),
        strip(roll, 3, "bot", "List of Additions 9", [card(3, epic_no="", marker_box="#"), card(4, gender="Female"), card("x")]),
        strip(roll, 4, "top", "Section No and Name 2-Other", [card(5)]),
        strip(roll, 5, "top", "List of Additions 2 (..)", [card(6, marker_box="7", gender="Female")]),
        (roll, 5, "bot", "{not json"),
        strip(roll, 6, "top", "", [card(7, gender="TG")]),
        strip(roll, 6, "bot", "List of Deletions", [card(8, deletion_reason_code="S")]),
    ]


SUMMARY = (
    "roll_id string, net_male int, net_female int, net_third_gender int, net_total int, additions_total int, "
    "deletions_total int, num_modifications int"
)


def good_summary(roll="r1", **kw):
    row = {"net_male": 3, "net_female": 2, "net_third_gender": 1, "net_total": 6, "additions_total": 2,
           "deletions_total": 2, "num_modifications": 1} | kw
    return (roll, *row.values())
