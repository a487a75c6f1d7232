"""Bands at every boundary, categories, code sets and unit conversion."""

import pytest
from pyspark.sql import functions as F

from wardframe.functions import codes as C
from wardframe.operators import rules
from wardframe.plans import anemia, severity
from wardframe.plans.kidney import WEIGHT_UNITS

EPS = 1e-6

# value (or min, max) -> score, on and around every boundary
SCORES = {
    "preiculos": [(611, 5), (612, 3), (17819, 3), (17820, 0), (86399, 0), (86400, 1),
                  (1122479, 1), (1122480, 2)],
    "age": [(23, 0), (24, 3), (53, 3), (54, 6), (77, 6), (78, 9), (89, 9), (90, 7)],
    "mingcs": [(7.0, 10), (7.5, 4), (13.9, 4), (14.0, 3), (15.0, 0)],
    "urineoutput": [(671.09 - EPS, 10), (671.09, 5), (1426.99, 5), (1426.995, 0), (1427.0, 1),
                    (2544.14, 1), (2544.14 + EPS, 0), (6896.80, 0), (6896.80 + EPS, 8)],
    "mechvent": [(1, 9), (0, 0)],
    "electivesurgery": [(1, 0), (0, 6)],
    "heartrate": [((60, 88), 0), ((60, 89), 1), ((60, 106), 1), ((60, 106.5), 0), ((60, 107), 3),
                  ((60, 125), 3), ((60, 125 + EPS), 6), ((33, 88), 0), ((33 - EPS, 88), 4)],
    "meanbp": [((20.65 - EPS, 90), 4), ((20.65, 90), 3), ((51 - EPS, 90), 3), ((51, 90), 2),
               ((61.33 - EPS, 90), 2), ((61.33, 90), 0), ((70, 143.44), 0), ((70, 143.44 + EPS), 3)],
    "resprate": [((6 - EPS, 10), 10), ((6, 20), 1), ((13, 22), 0), ((13, 22 + EPS), 1),
                 ((13, 30 + EPS), 6), ((13, 44), 6), ((13, 44 + EPS), 9)],
    "tempc": [((36.5, 36.8), 0), ((36.5, 36.89), 2), ((36.5, 39.88), 2), ((36.5, 39.88 + EPS), 6),
              ((36.39, 36.5), 2), ((35.93 + EPS, 36.5), 2), ((35.93, 36.5), 4), ((33.22, 36.5), 4),
              ((33.22 - EPS, 36.5), 3), ((33.22 - EPS, 35.0), 4)],
}
SCORE_OF = {"mingcs": "gcs", "tempc": "temp"}
BASE = {
    "preiculos": 90000, "age": 20, "mingcs": 15.0, "urineoutput": 3000.0, "mechvent": 0,
    "electivesurgery": 1, "heartrate_min": 60.0, "heartrate_max": 80.0, "meanbp_min": 80.0,
    "meanbp_max": 90.0, "resprate_min": 15.0, "resprate_max": 18.0, "tempc_min": 36.5,
    "tempc_max": 36.7,
}


@pytest.fixture(scope="module")
def scored(spark):
    rows = []
    for name, cases in SCORES.items():
        for at, (value, score) in enumerate(cases):
            row = dict(BASE, case=f"{name}:{at}", want=score)
            if isinstance(value, tuple):
                row[f"{name}_min"], row[f"{name}_max"] = map(float, value)
            else:
                row[name] = value
            rows.append(row)
    rows.append(dict({k: None for k in BASE}, case="none:0", want=0))
    ints = ("preiculos", "age", "mechvent", "electivesurgery")
    ddl = ", ".join(f"{k} {'bigint' if k in ints else 'double'}" for k in BASE)
    cohort = spark.createDataFrame(rows, f"{ddl}, case string, want int").select(
        "*",
        F.lit(1).alias("subject_id"),
        F.lit(1).alias("hadm_id"),
        F.col("case").alias("icustay_id"),
        F.lit("adult").alias("icustay_age_group"),
        F.lit(0).alias("hospital_expire_flag"),
        F.lit(0).alias("icustay_expire_flag"),
    )
    wants = {r["case"]: r["want"] for r in rows}
    got = {r["icustay_id"]: r for r in severity.oasis_score(cohort).collect()}
    return wants, got


def test_every_band_boundary(scored):
    wants, got = scored
    for case, want in wants.items():
        name = case.split(":")[0]
        if name != "none":
            assert got[case][f"{SCORE_OF.get(name, name)}_score"] == want, case


def test_worst_value_is_what_triggered_or_the_middle(scored):
    _, got = scored
    assert got["heartrate:0"]["heartrate"] == 74  # (60 + 88) / 2
    assert got["heartrate:5"]["heartrate"] == 125
    assert got["resprate:0"]["resprate"] == pytest.approx(6)
    assert got["tempc:9"]["temp"] == 35.0


def test_unknown_parts_score_null_and_count_zero(scored):
    _, got = scored
    row = got["none:0"]
    assert all(row[f"{n}_score"] is None for n in C.OASIS_BANDS)
    assert row["oasis"] == 0
    assert row["oasis_prob"] == pytest.approx(1 / (1 + 2.718281828459045**6.1746))


def test_anemia_bands(spark):
    cases = [
        (4.9, "F", False, 6.9, 3), (4.9, "F", False, 7.0, 2), (4.9, "M", False, 9.9, 1),
        (4.9, "M", False, 10.9, 0), (5.0, "M", False, 7.9, 3), (11.9, "M", False, 10.9, 1),
        (11.9, "M", False, 11.4, 0), (14.9, "M", False, 11.8, 1), (14.9, "M", False, 11.9, 0),
        (30.0, "F", False, 11.8, 1), (30.0, "F", True, 7.0, 2), (30.0, "F", True, 10.9, 0),
        (15.0, "M", False, 12.8, 1), (15.0, "M", False, 12.9, 0), (15.0, "M", False, 7.9, 3),
        # facts that contradict
        (-1.5, "F", False, 9.0, None), (30.0, "X", False, 9.0, None), (30.0, None, False, 9.0, None),
        (30.0, "F", False, 0.0, None), (4.0, "F", True, 9.0, None), (11.0, "F", True, 9.0, None),
        (30.0, "M", True, 9.0, None), (12.0, "M", True, 11.8, 1),
    ]
    rows = [(i, i, *c[:4]) for i, c in enumerate(cases)]
    df = spark.createDataFrame(
        rows,
        "subject_id int, hadm_id int, age double, gender string, is_pregnant boolean, hgb double",
    )
    hgb = df.select("subject_id", "hadm_id", F.lit("2024-01-01").cast("timestamp_ntz").alias("charttime"), "hgb")
    keys = ["subject_id", "hadm_id"]
    got = anemia.anemia_severity(
        hgb, df.select(*keys, "age"), df.select(*keys, "is_pregnant"), df.select("subject_id", "gender")
    )
    assert {r["hadm_id"]: r["anemia_severity"] for r in got.collect()} == {
        i: c[4] for i, c in enumerate(cases)
    }
    assert anemia.quarantined(got).count() == sum(c[4] is None for c in cases)


def test_categories(spark):
    texts = {
        "Unable to assess": 1, "Other/Remarks": 1, "Deep tissue injury": 1, "Red, unbroken": 1,
        "Intact,Color Chg": 1, "Partial thickness": 2, "Through Dermis": 2, "Full Thickness": 3,
        C.PRESSURE_INJURY_STAGES[2][2][0]: 3, C.PRESSURE_INJURY_STAGES[3][2][0]: 4, "To Bone": 4,
        "Through Fascia": 4, "red": 0, "Healed": 0,
    }
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "value string")
    got = df.select("value", rules.categorize("value", C.PRESSURE_INJURY_STAGES, 0).alias("s"))
    assert {r["value"]: r["s"] for r in got.collect()} == {**texts, None: 0}


def test_code_flag_ignores_null_codes(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (3, None)], "k int, c string")
    got = rules.code_flag(df, ["k"], "c", ["a"])
    assert {r["k"]: r["label"] for r in got.collect()} == {1: True, 2: False, 3: None}


def test_units(spark):
    df = spark.createDataFrame(
        [(762, 80.0, None), (3581, 100.0, 0), (3582, 1000.0, 2), (762, 70.0, 1), (99, 5.0, None)],
        "itemid int, valuenum double, error int",
    )
    got = rules.normalize_units(df, WEIGHT_UNITS).collect()
    assert sorted(round(r["value_norm"], 6) for r in got) == [28.349523, 45.359237, 80.0]
    vital = spark.createDataFrame(
        [(223761, 98.6, None), (223761, 120.0, None), (220277, 100.0, None), (220277, 100.1, None),
         (220045, 0.0, None), (220045, 299.9, None), (220621, 9999.0, None)],
        "itemid int, valuenum double, error int",
    )
    got = severity.vital_series(vital).collect()
    assert sorted((r["concept"], round(r["value_norm"], 6)) for r in got) == [
        ("glucose", 9999.0), ("heartrate", 299.9), ("spo2", 100.0), ("tempc", 37.0),
    ]
    kept = rules.normalize_units(vital, severity.VITAL_UNITS, keep_out_of_range=True)
    assert kept.count() == 7 and kept.where("concept IS NULL").count() == 3
