"""Quantiles by rank against sorted lists."""

import math
import random

import pytest

from wardframe.operators.ranks import lower_quantile
from wardframe.operators.skew import HotKeys

KEYS = ["subject_id", "hadm_id"]


def made(seed):
    """A key with a third of the rows and few values, one with many values, NULL keys and NULL values."""
    rng = random.Random(seed)
    rows = [(1, 10, float(rng.randrange(5))) for _ in range(700)]
    rows += [(2, 20, rng.random()) for _ in range(500)]
    rows += [(None, 30, rng.choice([None, -0.0, 1.5, -7.25])) for _ in range(300)]
    rows += [(4, None, None) for _ in range(30)]
    rows += [(rng.randrange(5, 40), 1, rng.choice([None, 1.0, 2.0])) for _ in range(200)]
    rng.shuffle(rows)
    return rows


def plain(rows, q):
    lists = {}
    for s, h, v in rows:
        lists.setdefault((s, h), []).append(v)
    out = {}
    for key, values in lists.items():
        known = sorted(v for v in values if v is not None)
        out[key] = known[max(1, math.ceil(q * len(known))) - 1] if known else None
    return out


@pytest.fixture(scope="module")
def all_hot(spark):
    """Cut points of no importance here: only whose keys they are counts."""

    def make(rows):
        keys = sorted({r[:2] for r in rows}, key=repr)
        cuts = spark.createDataFrame([(*k, 9, []) for k in keys], "subject_id long, hadm_id long, _rows long, _cuts array<timestamp_ntz>")
        return HotKeys(tuple(KEYS), cuts, 10**9, 1)

    return make


@pytest.mark.parametrize("q", [0.5, 0.25, 0.9, 1.0, 0.001])
def test_ranks_of_hot_and_of_ordinary_keys(spark, all_hot, q):
    rows = made(int(q * 100))
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, v double").repartition(5)
    want = plain(rows, q)
    for heat in (None, all_hot(rows), all_hot([r for r in rows if r[0] in (None, 2)])):
        got = {(r["subject_id"], r["hadm_id"]): r["m"] for r in lower_quantile(df, KEYS, "v", q, "m", heat).collect()}
        assert got == want


def test_a_hot_key_is_neither_sorted_nor_held_whole(spark, all_hot):
    rows = [(1, 10, float(k % 3000)) for k in range(9000)]
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, v double").repartition(5)
    hot = lower_quantile(df, KEYS, "v", 0.5, "m", all_hot(rows))
    assert hot.collect()[0]["m"] == 1499.0
    plan = hot._jdf.queryExecution().optimizedPlan().toString()
    _, by_rank = plan.split("Union", 1)
    # The plain aggregate is there for ordinary keys alone.
    assert by_rank.count("percentile_disc") == 1 and "LeftAnti" in by_rank


def test_shares_out_of_range_are_refused(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "subject_id long, hadm_id long, v double")
    for q in (0, -1, 1.5):
        with pytest.raises(ValueError):
            lower_quantile(df, KEYS, "v", q)


def test_empty_table(spark, all_hot):
    df = spark.createDataFrame([], "subject_id long, hadm_id long, v double")
    assert lower_quantile(df, KEYS, "v").collect() == []
    assert lower_quantile(df, KEYS, "v", hot=all_hot([(1, 1, 0.0)])).collect() == []
