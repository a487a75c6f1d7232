"""Values that the checks' SQL goes by, stated on their own: the jobs under test don't read them."""

from __future__ import annotations


def literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def rows(table) -> str:
    return ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in table)


# Fixed values.
URINE_SIGNS = [
    *((i, 1) for i in (40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428)),
    *((i, 1) for i in (40086, 40096, 40651, 226559, 226560, 226561, 226584, 226563, 226564, 226565)),
    *((i, 1) for i in (226567, 226557, 226558, 227489)),
    (227488, -1),
]

_SETTINGS = [
    223849, 445, 448, 449, 450, 1340, 1486, 1600, 224687, 639, 654, 681, 682, 683, 684, 224685, 224684, 224686,
    218, 436, 535, 444, 224697, 224695, 224696, 224746, 224747, 221, 1, 1211, 1655, 2000, 226873, 224738, 224419,
    224750, 227187, 543, 5865, 5866, 224707, 224709, 224705, 224706, 60, 437, 505, 506, 686, 220339, 224700, 3459,
    501, 502, 503, 224702, 223, 667, 668, 669, 670, 671, 672, 224701,
]
_OXYGEN = {
    226732: [
        "Nasal cannula", "Face tent", "Aerosol-cool", "Trach mask ", "High flow neb", "Non-rebreather", "Venti mask ",
        "Medium conc mask ", "T-piece", "High flow nasal cannula", "Ultrasonic neb", "Vapomist",
    ],
    467: [
        "Cannula", "Nasal Cannula", "Face Tent", "Aerosol-Cool", "Trach Mask", "Hi Flow Neb", "Non-Rebreather",
        "Venti Mask", "Medium Conc Mask", "Vapotherm", "T-Piece", "Hood", "Hut", "TranstrachealCat", "Heated Neb",
        "Ultrasonic Neb",
    ],
}
#: (code, text wanted, text not wanted, flag)
VENT_MEANINGS = [
    *((i, None, None, "ventilated") for i in _SETTINGS),
    (720, None, "Other/Remarks", "ventilated"),
    (223848, None, "Other", "ventilated"),
    (467, "Ventilator", None, "ventilated"),
    *((code, text, None, "oxygen") for code, texts in _OXYGEN.items() for text in texts),
    (640, "Extubated", None, "extubated"),
    (640, "Self Extubation", None, "extubated"),
    (640, "Self Extubation", None, "by patient"),
    *((i, None, None, "read") for i in (720, 223848, 467, 226732, 640, 468, 469, 470, 471, 227287, 223834)),
]

#: (code, vital, above, below, up to, shift, divisor)
VITAL_RANGES = [
    *((i, "heartrate", 0, 300, None, 0, 1) for i in (211, 220045)),
    *((i, "sysbp", 0, 400, None, 0, 1) for i in (51, 442, 455, 6701, 220179, 220050)),
    *((i, "diasbp", 0, 300, None, 0, 1) for i in (8368, 8440, 8441, 8555, 220180, 220051)),
    *((i, "meanbp", 0, 300, None, 0, 1) for i in (456, 52, 6702, 443, 220052, 220181, 225312)),
    *((i, "resprate", 0, 70, None, 0, 1) for i in (615, 618, 220210, 224690)),
    *((i, "tempc", 70, 120, None, 32, 1.8) for i in (223761, 678)),
    *((i, "tempc", 10, 50, None, 0, 1) for i in (223762, 676)),
    *((i, "spo2", 0, None, 100, 0, 1) for i in (646, 220277)),
    *((i, "glucose", 0, None, None, 0, 1) for i in (807, 811, 1529, 3745, 3744, 225664, 220621, 226537)),
]

_LOW, _HIGH = -1e300, 1e300
#: (part, place among its bands, measure, low, low included, high, high included, score)
SCORE_BANDS = [
    ("preiculos", 1, "preiculos", _LOW, True, 612, False, 5),
    ("preiculos", 2, "preiculos", 612, True, 17820, False, 3),
    ("preiculos", 3, "preiculos", 17820, True, 86400, False, 0),
    ("preiculos", 4, "preiculos", 86400, True, 1122480, False, 1),
    ("age", 1, "age", _LOW, True, 24, False, 0),
    ("age", 2, "age", 24, True, 53, True, 3),
    ("age", 3, "age", 53, False, 77, True, 6),
    ("age", 4, "age", 77, False, 89, True, 9),
    ("age", 5, "age", 90, True, _HIGH, True, 7),
    ("gcs", 1, "mingcs", _LOW, True, 7, True, 10),
    ("gcs", 2, "mingcs", 7, False, 14, False, 4),
    ("gcs", 3, "mingcs", 14, True, 14, True, 3),
    ("heartrate", 1, "heartrate_max", 125, False, _HIGH, True, 6),
    ("heartrate", 2, "heartrate_min", _LOW, True, 33, False, 4),
    ("heartrate", 3, "heartrate_max", 107, True, 125, True, 3),
    ("heartrate", 4, "heartrate_max", 89, True, 106, True, 1),
    ("meanbp", 1, "meanbp_min", _LOW, True, 20.65, False, 4),
    ("meanbp", 2, "meanbp_min", 20.65, True, 51, False, 3),
    ("meanbp", 3, "meanbp_max", 143.44, False, _HIGH, True, 3),
    ("meanbp", 4, "meanbp_min", 51, True, 61.33, False, 2),
    ("resprate", 1, "resprate_min", _LOW, True, 6, False, 10),
    ("resprate", 2, "resprate_max", 44, False, _HIGH, True, 9),
    ("resprate", 3, "resprate_max", 30, False, 44, True, 6),
    ("resprate", 4, "resprate_max", 22, False, 30, True, 1),
    ("resprate", 5, "resprate_min", 6, True, 13, False, 1),
    ("temp", 1, "tempc_max", 39.88, False, _HIGH, True, 6),
    ("temp", 2, "tempc_min", 33.22, True, 35.93, True, 4),
    ("temp", 3, "tempc_max", 33.22, True, 35.93, True, 4),
    ("temp", 4, "tempc_min", _LOW, True, 33.22, False, 3),
    ("temp", 5, "tempc_min", 35.93, False, 36.39, True, 2),
    ("temp", 6, "tempc_max", 36.89, True, 39.88, True, 2),
    ("urineoutput", 1, "urineoutput", _LOW, True, 671.09, False, 10),
    ("urineoutput", 2, "urineoutput", 6896.80, False, _HIGH, True, 8),
    ("urineoutput", 3, "urineoutput", 671.09, True, 1426.99, True, 5),
    ("urineoutput", 4, "urineoutput", 1427.00, True, 2544.14, True, 1),
    ("mechvent", 1, "mechvent", 1, True, 1, True, 9),
    ("electivesurgery", 1, "electivesurgery", 1, True, 1, True, 0),
]
SCORED = sorted({row[2] for row in SCORE_BANDS})
#: part: (measure that must be known, score outside the bands, measures whose middle is the value there)
SCORE_PARTS = {
    "preiculos": ("preiculos", 2, None, None),
    "age": ("age", 0, None, None),
    "gcs": ("mingcs", 0, None, None),
    "heartrate": ("heartrate_max", 0, "heartrate_min", "heartrate_max"),
    "meanbp": ("meanbp_min", 0, "meanbp_min", "meanbp_max"),
    "resprate": ("resprate_min", 0, "resprate_min", "resprate_max"),
    "temp": ("tempc_max", 0, "tempc_min", "tempc_max"),
    "urineoutput": ("urineoutput", 0, None, None),
    "mechvent": ("mechvent", 0, None, None),
    "electivesurgery": ("electivesurgery", 6, None, None),
}

PRESSURE_CODES = [224631, 224965, 224966, 224967, 224968, 224969, 224970, 224971, 227618, 227619, 551, 552, 553]
#: Text patterns of pressure injury stages.
PRESSURE_TEXTS = [
    ("Unable%", 1),
    ("Red%", 1),
    ("Other/Remarks", 1),
    ("Deep Tiss Injury", 1),
    ("Deep tissue injury", 1),
    ("Intact,Color Chg", 1),
    ("Part%", 2),
    ("Through Dermis", 2),
    ("Full thickness skin loss that may extend down to underlying fascia; ulcer may have tunneling or undermining", 3),
    ("Full Thickness", 3),
    ("Full thickness skin loss with damage to muscle, bone, or supporting structures; tunneling or undermining may be present", 4),
    ("Through Fascia", 4),
    ("To Bone", 4),
]

URINE_CODES = [
    40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096, 40651, 226559,
    226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558,
]
WEIGHT_CODES = [
    762, 763, 3580, 3693, 224639, 226512, 3581, 226531, 3582,
]
CHRONIC_KIDNEY = [
    "585", "5851", "5852", "5853", "5854", "5855", "5856", "5859", "7925", "V420", "V451", "V4511", "V4512",
    "V560", "V561", "V562", "V5631", "V5632", "V568",
]
PREGNANCY_GROUPS = [
    180, 181, 182, 183, 184, 185, 186, 187, 188, 190, 191, 192, 193, 194, 195, 196,
]
#: Hemoglobin under which anemia is severe, moderate and mild.
ANEMIA_BELOW = {
    "to_4_years": (7, 9.9, 10.9),
    "to_11_years": (8, 10.9, 11.4),
    "to_14_years_or_women": (8, 10.9, 11.9),
    "pregnant": (7, 9.9, 10.9),
    "men": (8, 10.9, 12.9),
}

ETHNICITIES = [
    ("ASIAN%", "ASIAN"),
    ("BLACK%", "BLACK"),
    ("HISPANIC%", "HISPANIC/LATINO"),
    ("SOUTH AMERICAN", "HISPANIC/LATINO"),
    ("WHITE%", "WHITE"),
    ("UNABLE TO OBTAIN", "UNKNOWN"),
    ("UNKNOWN/NOT SPECIFIED", "UNKNOWN"),
    ("PATIENT DECLINED TO ANSWER", "UNKNOWN"),
]
ADMISSION_PLACES = [
    ("CLINIC REFERRAL/PREMATURE", "CLINIC REFERRAL"),
    ("PHYS REFERRAL/NORMAL DELI", "PHYS REFERRAL"),
    ("TRANSFER FROM HOSP/EXTRAM", "TRANSFER FROM HOSP"),
]


def ethnicity_of(column: str) -> str:
    known = f"(VALUES {rows(ETHNICITIES)}) AS known(pattern, name)"
    return f"coalesce((SELECT max(name) FROM {known} WHERE {column} LIKE pattern), 'OTHER')"


#: Texts of the generated pressure injury view: each listed one, patterns filled in.
PRESSURE_VALUES = [
    text.replace("Unable%", "Unable to assess").replace("Red%", "Red, Unbroken").replace("Part%", "Partial thickness")
    for text, _ in PRESSURE_TEXTS
]
