"""Code lists, unit conversions and band tables. Results depend on each of them."""

# --- measurement codes -------------------------------------------------------------------------

# Urine output volumes; the first line and a half are the older charting system.
URINE_OUTPUT = [
    40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096, 40651,
    226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558,
]
GU_IRRIGANT_IN = 227488
GU_IRRIGANT_OUT = 227489

# Vital signs: (concept, codes, low (exclusive), high, high inclusive).
VITALS = [
    ("heartrate", [211, 220045], 0.0, 300.0, False),
    ("sysbp", [51, 442, 455, 6701, 220179, 220050], 0.0, 400.0, False),
    ("diasbp", [8368, 8440, 8441, 8555, 220180, 220051], 0.0, 300.0, False),
    ("meanbp", [456, 52, 6702, 443, 220052, 220181, 225312], 0.0, 300.0, False),
    ("resprate", [615, 618, 220210, 224690], 0.0, 70.0, False),
    ("tempf", [223761, 678], 70.0, 120.0, False),
    ("tempc", [223762, 676], 10.0, 50.0, False),
    ("spo2", [646, 220277], 0.0, 100.0, True),
    ("glucose", [807, 811, 1529, 3745, 3744, 225664, 220621, 226537], 0.0, None, False),
]
VITAL_NAMES = ["heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2", "glucose"]

# Body weight by unit of the code.
WEIGHT_KG = [762, 763, 3580, 3693, 224639, 226512]
WEIGHT_LB = [3581, 226531]
WEIGHT_OZ = [3582]
KG_PER_LB = 0.45359237
KG_PER_OZ = 0.0283495231
NOT_WEIGHT_UNITS = ["cm", "cmH20"]

# Laboratory and charted measurements.
CREATININE = 50912
HEMOGLOBIN_LAB = [50811, 51222]
HEMOGLOBIN_CHART = [814, 220228]

# Coma score parts over both charting systems, and the texts that stand for an intubated patient.
GCS_VERBAL = [723, 223900]
GCS_MOTOR = [454, 223901]
GCS_EYES = [184, 220739]
GCS_INTUBATED = [(723, "1.0 ET/Trach"), (223900, "No Response-ETT")]

# Mechanical ventilation: settings that mean it whatever their value.
VENT_SETTINGS = [
    223849,
    445, 448, 449, 450, 1340, 1486, 1600, 224687,
    639, 654, 681, 682, 683, 684, 224685, 224684, 224686,
    218, 436, 535, 444, 224697, 224695, 224696, 224746, 224747,
    221, 1, 1211, 1655, 2000, 226873, 224738, 224419, 224750, 227187,
    543,
    5865, 5866, 224707, 224709, 224705, 224706,
    60, 437, 505, 506, 686, 220339, 224700,
    3459,
    501, 502, 503, 224702,
    223, 667, 668, 669, 670, 671, 672,
    224701,
]
VENT_TYPE = (720, "Other/Remarks")  # any other value means ventilation
VENT_MODE = (223848, "Other")  # likewise
O2_DEVICE = 467
O2_DEVICE_VENTILATOR = "Ventilator"
O2_DEVICE_OXYGEN = [
    "Cannula", "Nasal Cannula", "Face Tent", "Aerosol-Cool", "Trach Mask", "Hi Flow Neb",
    "Non-Rebreather", "Venti Mask", "Medium Conc Mask", "Vapotherm", "T-Piece", "Hood", "Hut",
    "TranstrachealCat", "Heated Neb", "Ultrasonic Neb",
]
O2_DEVICES = 226732
O2_DEVICES_OXYGEN = [
    "Nasal cannula", "Face tent", "Aerosol-cool", "Trach mask ", "High flow neb", "Non-rebreather",
    "Venti mask ", "Medium conc mask ", "T-piece", "High flow nasal cannula", "Ultrasonic neb",
    "Vapomist",
]
O2_FLOW = [468, 469, 470, 471, 227287, 223834]  # charted with the devices, set no flag
EXTUBATION = 640
EXTUBATED = "Extubated"
SELF_EXTUBATED = "Self Extubation"
EXTUBATION_PROCEDURES = [227194, 225468, 225477]
SELF_EXTUBATION_PROCEDURE = 225468

# Pressure injury stage, charted.
PRESSURE_INJURY = [
    224631, 224965, 224966, 224967, 224968, 224969, 224970, 224971, 227618, 227619, 551, 552, 553,
]
# (stage, prefixes, exact texts); any other text is stage 0.
PRESSURE_INJURY_STAGES = [
    (
        1,
        ["Unable", "Red"],
        ["Other/Remarks", "Deep Tiss Injury", "Deep tissue injury", "Intact,Color Chg"],
    ),
    (2, ["Part"], ["Through Dermis"]),
    (
        3,
        [],
        [
            "Full thickness skin loss that may extend down to underlying fascia; ulcer may have "
            "tunneling or undermining",
            "Full Thickness",
        ],
    ),
    (
        4,
        [],
        [
            "Full thickness skin loss with damage to muscle, bone, or supporting structures; "
            "tunneling or undermining may be present",
            "Through Fascia",
            "To Bone",
        ],
    ),
]

# --- diagnosis codes ---------------------------------------------------------------------------

ACUTE_KIDNEY_ICD9 = ["5845", "5846", "5847", "5848", "5849"]
CHRONIC_KIDNEY_ICD9 = [
    "585", "5851", "5852", "5853", "5854", "5855", "5856", "5859", "7925", "V420", "V451", "V4511",
    "V4512", "V560", "V561", "V562", "V5631", "V5632", "V568",
]
ANEMIA_CCS = [59, 60]
PRESSURE_INJURY_CCS = [199]
PREGNANCY_CCS = [180, 181, 182, 183, 184, 185, 186, 187, 188, 190, 191, 192, 193, 194, 195, 196]

# --- severity score ----------------------------------------------------------------------------

# Per component: (column that must be known, score otherwise, [(condition, score, worst value)]).
# The first condition that holds decides.
OASIS_BANDS = {
    "preiculos": ("preiculos", 2, [
        ("preiculos < 612", 5, "preiculos"),
        ("preiculos < 17820", 3, "preiculos"),
        ("preiculos < 86400", 0, "preiculos"),
        ("preiculos < 1122480", 1, "preiculos"),
    ]),
    "age": ("age", 0, [
        ("age < 24", 0, "age"),
        ("age <= 53", 3, "age"),
        ("age <= 77", 6, "age"),
        ("age <= 89", 9, "age"),
        ("age >= 90", 7, "age"),
    ]),
    "gcs": ("mingcs", 0, [
        ("mingcs <= 7", 10, "mingcs"),
        ("mingcs < 14", 4, "mingcs"),
        ("mingcs = 14", 3, "mingcs"),
    ]),
    "heartrate": ("heartrate_max", 0, [
        ("heartrate_max > 125", 6, "heartrate_max"),
        ("heartrate_min < 33", 4, "heartrate_min"),
        ("heartrate_max >= 107 AND heartrate_max <= 125", 3, "heartrate_max"),
        ("heartrate_max >= 89 AND heartrate_max <= 106", 1, "heartrate_max"),
    ]),
    "meanbp": ("meanbp_min", 0, [
        ("meanbp_min < 20.65", 4, "meanbp_min"),
        ("meanbp_min < 51", 3, "meanbp_min"),
        ("meanbp_max > 143.44", 3, "meanbp_max"),
        ("meanbp_min >= 51 AND meanbp_min < 61.33", 2, "meanbp_min"),
    ]),
    "resprate": ("resprate_min", 0, [
        ("resprate_min < 6", 10, "resprate_min"),
        ("resprate_max > 44", 9, "resprate_max"),
        ("resprate_max > 30", 6, "resprate_max"),
        ("resprate_max > 22", 1, "resprate_max"),
        ("resprate_min < 13", 1, "resprate_min"),
    ]),
    "temp": ("tempc_max", 0, [
        ("tempc_max > 39.88", 6, "tempc_max"),
        ("tempc_min >= 33.22 AND tempc_min <= 35.93", 4, "tempc_min"),
        ("tempc_max >= 33.22 AND tempc_max <= 35.93", 4, "tempc_max"),
        ("tempc_min < 33.22", 3, "tempc_min"),
        ("tempc_min > 35.93 AND tempc_min <= 36.39", 2, "tempc_min"),
        ("tempc_max >= 36.89 AND tempc_max <= 39.88", 2, "tempc_max"),
    ]),
    "urineoutput": ("urineoutput", 0, [
        ("urineoutput < 671.09", 10, "urineoutput"),
        ("urineoutput > 6896.80", 8, "urineoutput"),
        ("urineoutput >= 671.09 AND urineoutput <= 1426.99", 5, "urineoutput"),
        ("urineoutput >= 1427.00 AND urineoutput <= 2544.14", 1, "urineoutput"),
    ]),
    "mechvent": ("mechvent", 0, [("mechvent = 1", 9, "mechvent")]),
    "electivesurgery": ("electivesurgery", 6, [("electivesurgery = 1", 0, "electivesurgery")]),
}
# Worst value where no condition holds: the middle of the two extremes, else the value itself.
OASIS_MIDPOINTS = {
    "heartrate": ("heartrate_min", "heartrate_max"),
    "meanbp": ("meanbp_min", "meanbp_max"),
    "resprate": ("resprate_min", "resprate_max"),
    "temp": ("tempc_min", "tempc_max"),
}
OASIS_LOGIT = (-6.1746, 0.1275)

# --- anemia: hemoglobin below (severity 3, 2, 1) -----------------------------------------------

ANEMIA_LIMITS = {
    "to_4_years": (7, 9.9, 10.9),
    "to_11_years": (8, 10.9, 11.4),
    "to_14_years_or_women": (8, 10.9, 11.9),
    "pregnant": (7, 9.9, 10.9),
    "men": (8, 10.9, 12.9),
}

# --- demographics ------------------------------------------------------------------------------

# (bucket, prefixes, exact texts); any other text is OTHER.
ETHNICITY = [
    ("ASIAN", ["ASIAN"], []),
    ("BLACK", ["BLACK"], []),
    ("HISPANIC/LATINO", ["HISPANIC"], ["SOUTH AMERICAN"]),
    ("WHITE", ["WHITE"], []),
    ("UNKNOWN", [], ["UNABLE TO OBTAIN", "UNKNOWN/NOT SPECIFIED", "PATIENT DECLINED TO ANSWER"]),
]
ADMISSION_LOCATION = [
    ("CLINIC REFERRAL", [], ["CLINIC REFERRAL/PREMATURE"]),
    ("PHYS REFERRAL", [], ["PHYS REFERRAL/NORMAL DELI"]),
    ("TRANSFER FROM HOSP", [], ["TRANSFER FROM HOSP/EXTRAM"]),
]

# Length of a year in days, as each job divides by it.
YEAR_AGES = 365.2425
YEAR_DEMOGRAPHICS = 365.25
YEAR_SEVERITY = 365.242
