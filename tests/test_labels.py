"""Label jobs on a hand-made cohort, and against their window-and-outer-join form."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W, functions as F

from wardframe.operators.cohort import exclude_present_on_admission, first_onset
from wardframe.plans import labels as L

ADMIT = datetime(2024, 1, 1)
H = lambda hours: ADMIT + timedelta(hours=hours)
KEYS = ["subject_id", "hadm_id"]


def make_spec(spark, stages, notes, icd=(), adults=None, hours=48):
    hadms = {r[1] for r in [*stages, *notes, *icd] if r[1] is not None}
    keyed = "subject_id int, hadm_id int"
    adm = spark.createDataFrame([(h, h, ADMIT) for h in hadms], f"{keyed}, admittime timestamp_ntz")
    return L.ConditionSpec(
        "test",
        spark.createDataFrame(stages, f"{keyed}, charttime timestamp_ntz, stage int"),
        "stage",
        spark.createDataFrame(notes, f"{keyed}, timestamp timestamp_ntz, label boolean"),
        spark.createDataFrame(list(icd), f"{keyed}, label boolean"),
        adm,
        adm.select(*KEYS).where(F.col("hadm_id").isin(list(adults or hadms))),
        hours,
    )


@pytest.fixture(scope="module")
def spec(spark):
    stages = [
        (1, 1, H(48), 1), (1, 1, H(90), 2),  # on admission: the end of 48 h counts
        (2, 2, H(48.01), 1), (2, 2, H(60), 3), (2, 2, H(70), 2), (2, 2, H(80), 3),
        (3, 3, H(10), 0), (3, 3, H(100), 0),
        (4, 4, H(60), 2), (4, 4, H(60), 3),  # one instant, two stages: the higher counts
        (5, 5, None, 3), (5, 5, H(50), 0),  # no time: not a stage
        (6, None, H(50), 3), (7, 7, H(55), 1),
    ]
    notes = [
        (1, 1, H(60), True), (2, 2, H(50), False), (2, 2, H(52), True), (3, 3, H(1), True),
        (3, 3, H(70), True), (4, 4, H(49), True), (5, 5, H(80), False), (7, 7, H(54), True),
        (8, None, H(60), True),
    ]
    icd = [(1, 1, True), (5, 5, False), (3, 3, True)]
    return make_spec(spark, stages, notes, icd, adults=[1, 2, 3, 4, 5])


def keyed(df, *cols):
    return {r["hadm_id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_evidence(spec):
    assert keyed(L.note_evidence(spec), "label") == {1: True, 2: True, 4: True, 5: False, 7: True}
    assert keyed(L.note_evidence(spec, acquired=False), "label")[3] is True
    assert keyed(L.table_evidence(spec), "label") == {2: True, 3: False, 4: True, 5: False, 7: True}
    assert keyed(L.table_evidence(spec, acquired=False), "label")[1] is True


def test_labels_and_cohorts(spec):
    labels = L.labels_of(spec)
    assert keyed(labels, "note_dx", "table_dx", "icd_dx") == {
        1: (True, False, True), 2: (True, True, False), 3: (False, False, True),
        4: (True, True, False), 5: (False, False, False),
    }
    assert set(keyed(L.case_cohort(labels), "subject_id")) == {1, 2, 4}
    any_time = L.labels_of(spec, acquired=False)
    assert set(keyed(L.control_cohort(any_time), "subject_id")) == {5}
    stats = {(r[0], r[1], r[2]): (r[3], r[4]) for r in L.label_distribution(labels).collect()}
    assert stats[(True, True, False)] == (2, 0.4)
    assert sum(n for n, _ in stats.values()) == 5


def test_onsets(spec, rows):
    assert rows(L.stage_onsets(spec), "hadm_id", "timestamp", "label") == sorted(
        [(1, H(48), 1), (1, H(90), 2), (2, H(48.01), 1), (2, H(60), 3), (4, H(60), 3), (7, H(55), 1)],
        key=repr,
    )
    assert rows(L.acquired_stage_onsets(spec), "hadm_id", "label") == [
        (2, 1), (2, 3), (4, 3), (7, 1),
    ]
    assert keyed(L.positive_note_onsets(spec), "timestamp") == {1: H(60), 2: H(52), 4: H(49), 7: H(54)}
    assert keyed(L.positive_table_onsets(spec), "timestamp") == {2: H(48.01), 4: H(60), 7: H(55)}
    # 7 is no adult
    assert keyed(L.positive_onsets(spec), "timestamp", "label") == {
        1: (H(60), 1), 2: (H(48.01), 1), 4: (H(49), 1),
    }


def test_against_windows_and_outer_joins(spark, rows):
    """The raw-stage aggregates equal running maxima with an outer-join exclusion."""
    rng = random.Random(3)
    stages = [
        (h, h, H(rng.randint(0, 120)), rng.choice([0, 0, 0, 1, 2, 3]))
        for h in range(60)
        for _ in range(rng.randint(1, 8))
    ]
    spec = make_spec(spark, stages, [(0, 0, H(60), True)])
    running = spec.stages.withColumn(
        "stage", F.max("stage").over(W.partitionBy(*KEYS).orderBy("charttime"))
    )
    early = (
        running.join(spec.admissions, KEYS)
        .where("stage >= 1 AND charttime <= admittime + INTERVAL 48 HOURS")
        .select(*KEYS).distinct().withColumn("x", F.lit(1))
    )
    kept = running.join(early, KEYS, "left").where("x IS NULL")
    onset = kept.where("stage >= 1").groupBy(*KEYS, "stage").agg(F.min("charttime"))
    assert rows(L.acquired_stage_onsets(spec), *KEYS, "label", "timestamp") == rows(onset)
    flag = kept.groupBy(*KEYS).agg((F.max("stage") >= 1).alias("label"))
    assert rows(L.table_evidence(spec)) == rows(flag)
    excluded = exclude_present_on_admission(
        running, running.where("stage >= 1"), spec.admissions, KEYS
    )
    assert rows(excluded, *KEYS, "charttime", "stage") == rows(kept, *KEYS, "charttime", "stage")
    assert rows(first_onset(running, KEYS, "charttime", "stage")) == rows(
        first_onset(spec.stages, KEYS, "charttime", "stage", running=False)
    )


def test_empty_input(spark):
    spec = make_spec(spark, [], [], [(1, 1, False)])
    assert keyed(L.labels_of(spec), "note_dx", "table_dx") == {1: (False, False)}
    assert L.positive_onsets(spec).count() == 0
