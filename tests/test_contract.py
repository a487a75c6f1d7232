"""The registered queries against their SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as contract
from wardframe.checks.all_queries import ORACLES, QUERIES
from wardframe.checks.compare import difference, duckdb_connection

SF = "/root/testdata/sf0.001"
# One query of each kind; `python -m wardframe.checks.compare` runs all of them.
SAMPLE = [
    "t3_asof_backward", "t3_asof_backward_null_keys_hot_keys", "t4_rolling_range_agg_null_keys_hot_keys", "t4_rolling_range_agg_hot_keys", "t8_sessionize_hot_keys",
    "c3_vent_durations_hot_keys", "c9_oasis_score", "c12_urine_stats", "c17_running_aki_stages",
    "c24_running_anemia_hot_keys", "d1_admission_demographics", "l5_label_distribution_anemia",
    "l7_acquired_stage_onsets_aki", "l9_positive_table_onsets_aki", "l10_positive_onsets_pi", "l12_control_cohort_aki",
    "c14_creatinine_baseline_median_hot_keys", "c8_first_day_concepts_hot_keys", "s2_load_catalog",
]


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_every_job_of_the_inventory_is_registered():
    ids = {re.match(r"([stcld]\d+)_", k).group(1) for k in QUERIES}
    wanted = [("s", 8), ("t", 17), ("c", 26), ("l", 12), ("d", 2)]
    assert ids == {f"{p}{i}" for p, n in wanted for i in range(1, n + 1)}


def test_entry(spark):
    onsets = contract.entry(spark)
    assert onsets.columns == ["subject_id", "hadm_id", "timestamp", "label"] and onsets.count() > 0


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_no_query_compares_nothing_with_nothing(folder):
    """Every statement has rows; the samples below hold the queries to them."""
    every = duckdb_connection(folder)
    assert [k for k, sql in ORACLES.items() if not every.execute(sql).fetchone()] == []


def test_kidney_labels_meet_admissions_that_are_excluded_and_that_are_not():
    every = duckdb_connection("/root/testdata/sf0.01")
    rows = {k: every.execute(ORACLES[k]).fetchall() for k in ("l6_stage_onsets_aki", "l7_acquired_stage_onsets_aki")}
    ill, acquired = ({r[:2] for r in rows[k]} for k in rows)
    assert acquired < ill and len(acquired) > 10 and len(ill - acquired) > 10
    assert {r[3] for r in rows["l7_acquired_stage_onsets_aki"]} == {1, 2, 3}


@pytest.mark.parametrize("key", SAMPLE)
def test_same_rows_as_sql(spark, con, key):
    df = contract.queries()[key](spark, SF)
    assert difference(df, con, contract.oracle_sql()[key]) is None
