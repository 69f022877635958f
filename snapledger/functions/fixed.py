"""Codes, names, labels and patterns whose exact spelling decides the results."""

# Deletion reason codes and their meaning.
REASONS = {
    "E": "Expired",
    "S": "Shifted / Change of Residence",
    "R": "Duplicate",
    "M": "Missing",
    "Q": "Disqualified",
}

# Lifecycle status of a deleted entry by reason code.
LIFECYCLE = {
    "E": "deceased",
    "S": "shifted_out",
    "R": "removed_duplicate",
    "Q": "disqualified",
    "M": "removed_missing",
}

# Accepted enumerations.
GENDERS = ["Male", "Female", "ThirdGender"]
RELATIONS = ["Father", "Husband", "Mother", "Other"]
STATUSES = ["active", "deleted", "added", "modified"]
ROLL_TYPES = ["SIR_FinalRoll", "SIR_DraftRoll", "FinalRoll", "DraftRoll", "Supplement"]
RESERVATIONS = ["GEN", "SC", "ST"]
STATION_TYPES = ["General", "Male", "Female"]
CHANGES = ["unchanged", "renumber", "split", "merge", "new", "abolished", "rehomed"]
JOB_STATUSES = ["pending", "fetching", "fetched", "verified", "failed", "skipped"]
STAGES = ["pending", "extracted", "loaded", "archived", "done", "failed"]

# The one delimitation era known so far (name, from, to).
ERAS = [("2008 Delimitation", "2008-02-19", None)]

# State code -> state name.
STATE_NAMES = {
    "S01": "Andhra Pradesh",
    "S02": "Arunachal Pradesh",
    "S03": "Assam",
    "S04": "Bihar",
    "S05": "Goa",
    "S06": "Gujarat",
    "S07": "Haryana",
    "S08": "Himachal Pradesh",
    "S09": "Jammu and Kashmir",
    "S10": "Karnataka",
    "S11": "Kerala",
    "S12": "Madhya Pradesh",
    "S13": "Maharashtra",
    "S14": "Manipur",
    "S15": "Meghalaya",
    "S16": "Mizoram",
    "S17": "Nagaland",
    "S18": "Odisha",
    "S19": "Punjab",
    "S20": "Rajasthan",
    "S21": "Sikkim",
    "S22": "Tamil Nadu",
    "S23": "Tripura",
    "S24": "Uttar Pradesh",
    "S25": "West Bengal",
    "S26": "Chhattisgarh",
    "S27": "Jharkhand",
    "S28": "Uttarakhand",
    "S29": "Telangana",
    "U01": "Andaman and Nicobar Islands",
    "U02": "Chandigarh",
    "U03": "Dadra and Nagar Haveli and Daman and Diu",
    "U05": "Delhi",
    "U06": "Lakshadweep",
    "U07": "Puducherry",
    "U08": "Ladakh",
}

# Printed relation labels, in the order they are tried.
RELATION_LABELS = [
    ("husband", "Husband"),
    ("wife", "Husband"),
    ("father", "Father"),
    ("mother", "Mother"),
    ("other", "Other"),
]

# Labels of one Indic script (name, relation, house, age, gender).
SCRIPT_NAME = ["ఓటరు పేరు", "పేరు"]
SCRIPT_RELATION = [("భర్త", "Husband"), ("తండ్రి", "Father"), ("తల్లి", "Mother")]
SCRIPT_HOUSE = ["ఇంటి సంఖ్య"]
SCRIPT_AGE = "వయస"
SCRIPT_GENDER = [("స్త్రీ", "Female"), ("పురుషుడు", "Male"), ("మహిళ", "Female")]

# Patterns.
KEY_SHAPE = "^[A-Z]{3}[0-9]{7}$"
KEY_ANYWHERE = "[A-Z]{3}[0-9]{7}"
STATE_CODE_SHAPE = "^[SU][0-9]{2}$"
LANGUAGE_SHAPE = "^[A-Z]{2,3}$"
PIN_SHAPE = "^[0-9]{6}$"
FILE_NAME = r"(?i)EROLLGEN-([SU]\d{2})-(\d+)-.*?-([A-Z]{2,3})-(\d+)-WI"
PART_IN_FILE = r"(?i)-(\d+)-WI\.pdf$"
ROLL_TITLE = r"(?i)electoral\s*roll\s*(\d{4})\s*[su]\d{2}\s*(.+)"
SERIAL_TOKEN = r"^[A-Za-z]?\s*\d{1,4}$"
LABEL_PREFIX = (
    r"(?i)^\s*(house\s*numbe?r?|name|fathers?\s*name|mothers?\s*name|"
    r"husbands?\s*name|wifes?\s*name|others?)\s*"
)

# Page geometry (share of page height where each overlapping band starts / ends).
TOP_BAND_END = 0.55
BOTTOM_BAND_START = 0.48
FIRST_VOTER_PAGE = 3
CARD_HEIGHT_AT_200_DPI = 219

# Layout thresholds, as shares of a card height, a column width or a label height.
ANCHOR_SIDE = 0.5  # an anchor lies right of this share of its column
TEXT_SIDE = 0.5  # card text lies left of this share of its column
SCRIPT_TEXT_SIDE = 0.6  # the same for the script engine
CARD_PAD = 0.15  # a card starts this much above its anchor
SAME_LINE = 0.35  # tokens this near to the anchor are on its line
SERIAL_BOX = 0.35  # a bare reason letter lies left of this share of the column
ROW_GAP = 0.5  # a gap of this much opens a new grid row
SCRIPT_AGE_BELOW = 0.4  # an unlabelled age lies this much below the anchor
RIGHT_TOLERANCE = 0.6  # a value right of a label differs by less than this in y
BELOW_FROM, BELOW_TO, BELOW_WIDTH = 0.6, 2.2, 8  # a value below a label: from, to, and how far right
SECTIONS_DOWN, SECTIONS_RIGHT = 6, 12  # the section list under its header
COUNT_ROWS, COUNT_ROW = 3, 1.2  # the count table under its header: reach, and height of one row

# Layout distances in pixels.
LEAST_LABEL_HEIGHT = 12.0
RIGHT_OFFSET = 5
SUMMARY_ROW_TOLERANCE = 15.0
MODIFICATION_REACH = 120.0

# Texts that mark noise lines and section headers of a card strip.
NOISE_ANYWHERE = ["as on", "#/#"]
NOISE_HEADS = ["parliamentary", "section no", "assembly", "part no"]
SECTION_HEAD = "sectionnoand"
SECTION_LISTS = ["listofaddition", "listofdeletion"]

# Headers and row labels of the summary page.
SUMMARY_HEADS = [("male", "net_male"), ("female", "net_female"), ("third", "net_third_gender"), ("total", "net_total")]
SUMMARY_ROWS = {
    "net": ["net elector", "i+ii", "i+ll", "after this revision"],
    "add": ["list of additions"],
    "del": ["list of deletions"],
}

# Cover labels whose value stands to their right.
COVER_RIGHT = {
    "year_of_revision": "yearofrevision",
    "qualifying_date": "qualifyingdate",
    "date_of_publication": "dateofpublication",
    "date_of_updation": "dateofupdation",
    "type_of_revision": "typeofrevision",
    "main_town_or_village": "maintownorvillage",
    "post_office": "postoffice",
    "police_station": "policestation",
    "block": "block",
    "tehsil_mandal": "tehsil",
    "taluk": "taluk",
    "district_name": "district",
    "pin_code": "pincode",
    "polling_station_type": "typeofpollingstation",
    "aux_a": "auxiliarypolling",
    "aux_b": "stationsinthispart",
}
# Cover labels whose value stands below them.
COVER_BELOW = {
    "roll_identification": "rollidentification",
    "station": "nameofpollingstation",
    "polling_station_address": "addressofpollingstation",
}
# Cover lines that carry label and value together.
COVER_LINES = {
    "title": "electoralroll",
    "ac": "assemblyconstituency",
    "pc": "parliamentaryconstituency",
    "part": "partno",
    "sections_head": "sectionsinthepart",
}
# Headers of the count table on a cover.
COUNT_HEADS = {
    "starting_serial_no": ["starting"],
    "ending_serial_no": ["ending"],
    "net_male": ["male"],
    "net_female": ["female"],
    "net_third_gender": ["thirdgender", "third"],
    "net_total": ["total"],
}

# Names under which catalog records carry a field, in order of preference.
CATALOG_STATE = {"state_cd": ["stateCd"], "state_name": ["stateName", "stateNameEn"], "state_type": ["stateType"]}
CATALOG_DISTRICT = {
    "district_cd": ["districtCd", "districtCode"],
    "district_name": ["districtValue", "districtName", "districtNameEn"],
}
CATALOG_AREA = {
    "ac_no": ["asmblyNo", "acNo", "acNumber"],
    "ac_name": ["asmblyName", "acName", "constituencyName"],
    "ac_id": ["acId", "asmblyId"],
    "district_cd": ["districtCd", "districtCode"],
    "category": ["category", "reservationStatus", "acType"],
}
UNNAMED = "(unknown)"
