"""Concept tables on hand-made series: window ends, ties, episodes, three-valued stages."""

import itertools
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardframe.plans import anemia, demographics, kidney, severity, ventilation

T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


STAY = "subject_id int, hadm_id int, icustay_id int"


@pytest.fixture(scope="module")
def stays(spark):
    return spark.createDataFrame(
        [(1, 1, 1, T0, at(72)), (2, 2, 2, T0, at(72))],
        f"{STAY}, intime timestamp_ntz, outtime timestamp_ntz",
    )


def settings(spark, rows):
    return spark.createDataFrame(
        [(1, at(h), *flags) for h, *flags in rows],
        "icustay_id int, charttime timestamp_ntz, mechvent int, oxygentherapy int, extubated int, "
        "selfextubated int",
    )


def episodes(df):
    return [
        (r["ventnum"], (r["starttime"] - T0) / timedelta(hours=1), r["duration_hours"])
        for r in ventilation.vent_durations(df).orderBy("ventnum").collect()
    ]


def test_ventilation_pause_and_extubation(spark):
    vent, out, oxygen, none = (1, 0, 0, 0), (0, 0, 1, 0), (0, 1, 0, 0), (0, 0, 0, 0)
    # exactly eight hours is no new episode, more is
    assert episodes(settings(spark, [(0, *vent), (8, *vent), (16.5, *vent), (17, *vent)])) == [
        (1, 0, 8.0), (2, 16.5, 0.5),
    ]
    # ventilation right after an extubation is a new episode
    assert episodes(settings(spark, [(0, *vent), (2, *out), (3, *vent), (4, *vent)])) == [
        (1, 0, 2.0), (2, 3, 1.0),
    ]
    # oxygen without ventilation ends one; flagless rows do nothing
    assert episodes(
        settings(spark, [(0, *vent), (1, *none), (2, *vent), (3, *oxygen), (4, *vent), (5, *vent)])
    ) == [(1, 0, 2.0), (2, 4, 1.0)]
    # zero length, or never ventilated: no episode
    assert episodes(settings(spark, [(0, *vent), (1, *oxygen), (2, *out), (3, *out)])) == []
    # a row that is both ventilated and extubated at once stays in its episode
    assert episodes(settings(spark, [(0, *vent), (1, 1, 0, 1, 0), (2, *vent), (3, *vent)])) == [
        (1, 0, 1.0), (2, 2, 1.0),
    ]


def test_vent_settings_codes(spark):
    charts = spark.createDataFrame(
        [
            (1, at(0), 720, "Other/Remarks", None), (1, at(1), 720, "CMV", 0),
            (1, at(2), 467, "Cannula", None), (1, at(3), 467, "Ventilator", None),
            (1, at(4), 640, "Self Extubation", None), (1, at(5), 459, "9", None),
            (1, at(6), 445, "9", 1), (1, at(7), 445, None, None), (None, at(8), 445, "9", None),
            (1, at(9), 470, "4", None),
        ],
        "icustay_id int, charttime timestamp_ntz, itemid int, value string, error int",
    )
    procedures = spark.createDataFrame(
        [(1, at(4), 225468), (1, at(10), 227194), (1, at(11), 1)],
        "icustay_id int, starttime timestamp_ntz, itemid int",
    )
    got = ventilation.vent_settings(charts, procedures).orderBy("charttime", "mechvent").collect()
    assert [((r["charttime"] - T0).seconds // 3600, *tuple(r)[2:]) for r in got] == [
        (0, 0, 0, 0, 0), (1, 1, 0, 0, 0), (2, 0, 1, 0, 0), (3, 1, 0, 0, 0), (4, 0, 0, 1, 1),
        (9, 0, 0, 0, 0), (10, 0, 0, 1, 0),
    ]


def test_first_day_is_inclusive_at_both_ends(spark, stays):
    outputs = spark.createDataFrame(
        [(1, 1, 1, at(h), item, v) for h, item, v in
         [(0, 40055, 1.0), (24, 227488, 10.0), (24.01, 40055, 100.0), (-0.01, 40055, 100.0),
          (5, 227488, -3.0), (6, 1, 50.0)]],
        f"{STAY}, charttime timestamp_ntz, itemid int, value double",
    )
    got = severity.urine_first_day(stays, outputs).collect()
    assert [(r["icustay_id"], r["urineoutput"]) for r in got] == [(1, -12.0)]


def test_vitals_keep_stays_without_usable_readings(spark, stays):
    charts = spark.createDataFrame(
        [(1, 1, 1, at(1), 678, 100.4, None), (1, 1, 1, at(2), 676, 39.0, 0), (1, 1, 1, at(3), 678, 69.0, None),
         (1, 1, 1, at(4), 211, 80.0, 1), (2, 2, 2, at(1), 211, 0.0, None)],
        f"{STAY}, charttime timestamp_ntz, itemid int, valuenum double, error int",
    )
    got = {r["icustay_id"]: r for r in severity.vitals_first_day(stays, charts).collect()}
    assert got[1]["tempc_min"] == pytest.approx(38.0) and got[1]["tempc_mean"] == pytest.approx(38.5)
    assert got[1]["heartrate_max"] is None and got[2]["heartrate_max"] is None


@pytest.mark.parametrize(
    "readings,want",
    [
        ([(1, 454, 4, ""), (1, 723, 3, ""), (1, 184, 2, "")], (9, 4, 3, 2, 0)),
        ([(1, 454, 4, "")], (13, 4, None, None, 0)),  # defaults for what is missing
        ([(1, 723, 1, "1.0 ET/Trach")], (15, None, 0, None, 1)),
        # taken from less than six hours before; six hours exactly is too old
        ([(1, 454, 2, ""), (6.9, 184, 1, "")], (8, 2, None, 1, 0)),
        ([(1, 454, 5, ""), (7, 184, 1, "")], (12, None, None, 1, 0)),
        # intubated before: missing verbal means 15, a verbal score drops the earlier parts
        ([(1, 723, 1, "1.0 ET/Trach"), (1, 454, 1, ""), (2, 184, 1, "")], (15, 1, 0, None, 1)),
        ([(1, 723, 1, "1.0 ET/Trach"), (1, 454, 1, ""), (2, 723, 1, "")], (11, 1, 1, None, 0)),
    ],
)
def test_coma_score(spark, stays, readings, want):
    charts = spark.createDataFrame(
        [(1, at(h), item, float(v), text, None) for h, item, v, text in readings],
        "icustay_id int, charttime timestamp_ntz, itemid int, valuenum double, value string, error int",
    )
    got = {r["icustay_id"]: tuple(r)[3:] for r in severity.gcs_first_day(stays, charts).collect()}
    assert got[1] == want
    assert got[2] == (None,) * 5


LABS = "row_id int, subject_id int, hadm_id int, charttime timestamp_ntz, creatinine double"


@pytest.fixture(scope="module")
def labs(spark):
    rows = [(1, -24, 4.0), (2, 0, 2.0), (3, 0, 1.0), (4, 24, 3.0), (5, 24.01, 0.1), (6, -24.01, 9.0)]
    return spark.createDataFrame([(i, 1, 1, at(h), v) for i, h, v in rows], LABS)


@pytest.mark.parametrize(
    "method,want", [("nadir", 1.0), ("maximum", 4.0), ("median", 2.0), ("first", 4.0)]
)
def test_baseline(spark, labs, method, want):
    admissions = spark.createDataFrame(
        [(1, 1, T0)], "subject_id int, hadm_id int, admittime timestamp_ntz"
    )
    got = kidney.creatinine_baseline(labs, admissions, method).collect()
    assert [r["baseline"] for r in got] == [want]  # 1, 2, 3, 4: the lower median is 2
    with pytest.raises(ValueError):
        kidney.creatinine_baseline(labs, admissions, "mode")


def test_increase_window_ends_at_48_hours(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, at(0), 1.0), (2, 1, 1, at(48), 1.5), (3, 1, 1, at(48.01), 1.5)], LABS
    )
    got = {r["row_id"]: r["increase"] for r in kidney.creatinine_increase(df).collect()}
    assert got == {1: 0.0, 2: 0.5, 3: 0.0}


def test_stage_logic_over_missing_evidence(spark):
    """NULL never fires and never blocks, over every mix of creatinine, baseline and urine."""
    labs, base, urine, want = [], [], [], {}
    values = itertools.product([None, 1.0, 4.5], [None, 1.0], [None, 0.2, 0.4, 0.9])
    for k, (cr, baseline, rate) in enumerate(values):
        if cr is None and rate is None:
            continue
        if cr is not None:
            labs.append((k, k, k, at(30), cr))
        if baseline is not None:
            base.append((k, k, baseline))
        if rate is not None:
            urine.append((k, k, at(30), at(6), at(18), at(24), 60, 60, 60, rate, rate, rate))
        stage = 0
        if cr is not None and baseline is not None and cr >= 3 * baseline:
            stage = 3
        if rate is not None:
            # 24 h: covered only after more than 23 h; 12 h and 6 h likewise
            stage = max(stage, 3 if rate < 0.3 else 2 if rate < 0.5 else 0)
        want[k] = stage
    cols = "subject_id int, hadm_id int"
    stats = spark.createDataFrame(
        urine,
        f"{cols}, charttime timestamp_ntz, first_24h timestamp_ntz, first_12h timestamp_ntz, "
        "first_6h timestamp_ntz, max_lag_6h bigint, max_lag_12h bigint, max_lag_24h bigint, "
        "max_wnrate_6h double, max_wnrate_12h double, max_wnrate_24h double",
    )
    increases = kidney.creatinine_increase(spark.createDataFrame(labs, LABS))
    baselines = spark.createDataFrame(base, f"{cols}, baseline double")
    got = kidney.aki_stages(increases, baselines, stats).collect()
    assert {r["hadm_id"]: r["aki_risk"] for r in got} == want


def test_coverage_is_strict_and_density_bounded(spark):
    cols = "subject_id int, hadm_id int"
    rows = [
        (1, at(5), 5399, 0.4), (2, at(5.01), 5399, 0.4), (3, at(5.01), 5400, 0.4),
        (4, at(5.01), None, 0.4), (5, at(5.01), 60, 0.5),
    ]
    stats = spark.createDataFrame(
        [(h, h, t, T0, T0, T0, gap, gap, gap, r, r, r) for h, t, gap, r in rows],
        f"{cols}, charttime timestamp_ntz, first_6h timestamp_ntz, first_12h timestamp_ntz, "
        "first_24h timestamp_ntz, max_lag_6h bigint, max_lag_12h bigint, max_lag_24h bigint, "
        "max_wnrate_6h double, max_wnrate_12h double, max_wnrate_24h double",
    )
    increases = kidney.creatinine_increase(spark.createDataFrame([], LABS))
    got = kidney.aki_stages(increases, spark.createDataFrame([], f"{cols}, baseline double"), stats)
    assert {r["hadm_id"]: r["aki_risk"] for r in got.collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0}


def test_weights_drop_unknown_units(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, at(0), 762, 80.0, "kg", None), (2, 1, 1, at(1), 3581, 220.0, "lb", None),
         (3, 1, 1, at(2), 762, 170.0, "cm", None), (4, 1, 1, at(3), 762, 81.0, None, None),
         (5, 1, 1, at(4), 762, 82.0, "kg", 1), (6, 1, None, at(5), 762, 82.0, "kg", None)],
        "row_id int, subject_id int, hadm_id int, charttime timestamp_ntz, itemid int, "
        "valuenum double, valueuom string, error int",
    )
    got = {r["row_id"]: round(r["median3"], 3) for r in kidney.patient_weights(df).collect()}
    assert got == {1: 80.0, 2: 80.0}
    kept = kidney.patient_weights(df, keep_null_uom=True)
    assert {r["row_id"] for r in kept.collect()} == {1, 2, 4}


def test_hemoglobin_rounds_halves_up_and_merges_sources(spark):
    schema = "subject_id int, hadm_id int, charttime timestamp_ntz, itemid int, valuenum double, error int"
    labs = spark.createDataFrame(
        [(1, 1, T0, 50811, 9.25, None), (1, 1, T0, 50811, 9.25, None), (1, 1, T0, 51222, 0.0, None)], schema
    )
    charts = spark.createDataFrame(
        [(1, 1, T0, 814, 9.3, None), (1, 1, T0, 814, 8.0, 1), (1, 1, T0, 220228, 7.04, 0)], schema
    )
    assert [r["hgb"] for r in anemia.hgb_series(labs).collect()] == [9.3, 9.3]
    both = sorted(r["hgb"] for r in anemia.hgb_series(labs, charts).collect())
    assert both == [7.0, 9.3]


def test_adults_from_their_birthday_on(spark):
    people = spark.createDataFrame(
        [(1, datetime(2009, 1, 1)), (2, datetime(2009, 1, 2)), (3, datetime(2009, 1, 1, 1))],
        "subject_id int, dob timestamp_ntz",
    )
    stays = spark.createDataFrame(
        [(i, i, T0) for i in (1, 2, 3)], "subject_id int, hadm_id int, admittime timestamp_ntz"
    )
    assert [r["hadm_id"] for r in anemia.adults(stays, people).collect()] == [1]


def test_primary_diagnosis_shares(spark):
    diag = spark.createDataFrame(
        [(1, 1, 1, "a"), (2, 2, 1, "b"), (3, 3, 1, "a"), (3, 3, 2, "b"), (4, 4, 1, "a")],
        "subject_id int, hadm_id int, seq_num int, icd9_code string",
    )
    ccs = spark.createDataFrame([(1, "one", "a"), (2, "two", "b")], "ccs_id int, ccs_name string, icd9_code string")
    cohort = diag.where("hadm_id < 4").select("subject_id", "hadm_id")
    got = demographics.ccs_primary_distribution(diag, ccs, cohort).collect()
    assert {r["ccs_name"]: (r["n"], round(r["percent"], 3)) for r in got} == {
        "one": (2, 0.667), "two": (1, 0.333),
    }


def test_the_score_deals_each_key_out_once(spark):
    """Without any broadcast: stays by admission and patient, events once by stay, and the episodes' own two."""
    from wardframe.checks.concept_queries import oasis_score
    from wardframe.checks.role_views import Roles

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = oasis_score(Roles(spark, "/root/testdata/sf0.001", staged=True))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan)) <= 10


def test_first_day_keeps_stays_without_events(spark):
    stays = spark.createDataFrame([(1, 10, 100, T0), (2, 20, 200, T0)], "subject_id int, hadm_id int, icustay_id int, intime timestamp_ntz")
    chart = spark.createDataFrame(
        [(1, 10, 100, T0, 211, None, 80.0, None), (9, 10, 100, T0, 211, None, 90.0, None), (9, 90, 100, T0, 454, None, 3.0, None), (1, 10, 100, T0, 211, None, 70.0, 1)],
        "subject_id int, hadm_id int, icustay_id int, charttime timestamp_ntz, itemid int, value string, valuenum double, error int",
    )
    none = spark.createDataFrame([], "subject_id int, hadm_id int, icustay_id int, charttime timestamp_ntz, itemid int, value double")
    episodes = spark.createDataFrame([], "icustay_id int, starttime timestamp_ntz, endtime timestamp_ntz")
    got = {r["icustay_id"]: r for r in severity.first_day(stays, chart, none, episodes).collect()}
    # vital signs go by the whole key of a stay, the coma score by its number alone, as in the single jobs
    assert got[100]["heartrate_max"] == 80.0 and got[100]["gcsmotor"] == 3.0 and got[100]["vent"] == 0
    assert got[200]["heartrate_max"] is None and got[200]["mingcs"] is None and got[200]["vent"] == 0 and len(got) == 2
