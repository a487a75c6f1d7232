"""Hot-key plans give the same rows as the plain window plans, and as brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardframe.operators import temporal as tp
from wardframe.operators.skew import (
    SLICE,
    join_one_per_key,
    measure_hot_keys,
    split_hot,
    with_slices,
    with_slices_of,
)

START = datetime(2024, 1, 1)
KEYS = ["subject_id", "hadm_id"]


def series(seed, n=600):
    """One key holds most rows, half of them in a short burst; instants repeat."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 1 if rng.random() < 0.7 else rng.randint(2, 20)
        minutes = rng.randint(0, 300) if rng.random() < 0.5 else rng.randint(0, 20 * 1440)
        value = None if rng.random() < 0.05 else float(rng.randint(0, 50))
        out.append((i, key, key * 10, START + timedelta(minutes=minutes), value, rng.randint(0, 1)))
    return out


@pytest.fixture(scope="module")
def data():
    return series(7)


@pytest.fixture(scope="module")
def events(spark, data):
    schema = "row_id long, subject_id long, hadm_id long, t timestamp_ntz, v double, f int"
    return spark.createDataFrame(data, schema).repartition(4).cache()


@pytest.fixture(scope="module")
def hot(events):
    return measure_hot_keys(events, KEYS, "t", max_rows=15, sliding_rows=15)


def test_only_large_keys_are_cut(events, hot):
    assert measure_hot_keys(events, KEYS, "t", max_rows=1000) is None
    cut = {r["subject_id"]: len(r["_cuts"]) for r in hot.cuts.collect()}
    assert 1 in cut and cut[1] > 10
    sizes = with_slices(events, "t", hot).groupBy(*KEYS, SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 40
    # rows of one instant share a slice, and slices follow time
    spans = with_slices(events, "t", hot).groupBy(*KEYS, "t").agg(F.countDistinct(SLICE).alias("n"))
    assert spans.where("n > 1").count() == 0


def test_sliding_frames_have_their_own_bound(events, hot):
    sliding_only = measure_hot_keys(events, KEYS, "t", max_rows=1000, sliding_rows=15)
    assert sliding_only.for_scans() is None
    assert hot.for_scans().cuts.count() == hot.cuts.count()
    plan = tp.running_max(events, KEYS, "t", "v", "m", sliding_only)
    assert sorted(r["m"] or -1 for r in plan.select("m").collect()) == sorted(
        r["m"] or -1 for r in tp.running_max(events, KEYS, "t", "v", "m").select("m").collect()
    )


def test_slices_of_several_times_count_the_cuts_before_each(events, hot):
    times = {"now": F.col("t"), "ago": F.col("t") - F.expr("INTERVAL 6 HOURS")}
    cuts = {(r["subject_id"], r["hadm_id"]): r["_cuts"] for r in hot.cuts.collect()}
    assert all(c == sorted(set(c)) and len(c) < 2**hot.bits for c in cuts.values())
    for r in with_slices_of(events, times, hot).collect():
        own = cuts.get((r["subject_id"], r["hadm_id"]), [])
        assert r["now"] == sum(c <= r["t"] for c in own)
        assert r["ago"] == sum(c <= r["t"] - timedelta(hours=6) for c in own)


@pytest.mark.parametrize("peers", [True, False])
@pytest.mark.parametrize("descending", [True, False])
def test_running(events, hot, rows, peers, descending):
    aggs = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v")}
    order = ["t"] if peers else ["t", "row_id"]
    if not peers:
        aggs["z"] = ("last", "v")
    plain = tp.running(events, KEYS, order, aggs, None, peers, descending)
    split = tp.running(events, KEYS, order, aggs, hot, peers, descending)
    assert rows(plain) == rows(split)


def test_ordinary_keys_stay_out_of_the_split_plan(events, hot):
    """Only the rows of hot keys are written down, and rows without a key are not lost."""
    ordinary, split = split_hot(events, hot)
    cut = {r["subject_id"] for r in hot.cuts.collect()}
    assert {r["subject_id"] for r in split.select("subject_id").distinct().collect()} == cut
    assert ordinary.count() + split.count() == events.count()
    unkeyed = events.withColumn("hadm_id", F.expr("CASE WHEN row_id % 5 > 0 THEN hadm_id END"))
    assert tp.running_max(unkeyed, KEYS, "t", "v", "m", hot).count() == events.count()


def test_running_max_against_brute_force(events, data, hot, rows):
    want = []
    for i, s, h, t, v, _ in data:
        seen = [r[4] for r in data if r[1] == s and r[3] <= t and r[4] is not None]
        want.append((i, max(seen, default=None)))
    got = tp.running_max(events, KEYS, "t", "v", "m", hot)
    assert rows(got, "row_id", "m") == sorted(want, key=repr)


def test_rolling_range(events, data, hot, rows):
    specs = {
        "s6": ("sum", "v", "6 HOURS"),
        "lo48": ("min", "v", "48 HOURS"),
        "hi6": ("max", "v", "6 HOURS"),
        "n1": ("count", "v", "1 HOURS"),
        "first6": ("first", "t", "6 HOURS"),
    }
    plain = rows(tp.rolling_range(events, KEYS, "t", specs))
    assert plain == rows(tp.rolling_range(events, KEYS, "t", specs, hot))
    want = []
    for i, s, h, t, v, f in data:
        def within(hours):
            return [
                r for r in data if r[1] == s and t - timedelta(hours=hours) <= r[3] <= t
            ]

        def vals(hours):
            return [r[4] for r in within(hours) if r[4] is not None]

        want.append(
            (i, s, h, t, v, f, sum(vals(6)) if vals(6) else None, min(vals(48), default=None),
             max(vals(6), default=None), len(vals(1)), min(r[3] for r in within(6)))
        )
    assert plain == sorted(want, key=repr)


@pytest.fixture(scope="module")
def unkeyed(events):
    """Most rows without an admission, so that (patient, NULL) is a hot key."""
    return events.withColumn("hadm_id", F.expr("CASE WHEN row_id % 4 = 0 THEN hadm_id END")).cache()


def test_null_keys_are_cut_like_others(unkeyed, rows):
    hot = measure_hot_keys(unkeyed, KEYS, "t", max_rows=15, sliding_rows=15)
    assert hot.cuts.where("hadm_id IS NULL").count() >= 1
    sizes = with_slices(unkeyed, "t", hot).groupBy(*KEYS, SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 40
    specs = {"s6": ("sum", "v", "6 HOURS"), "n48": ("count", "v", "48 HOURS")}
    jobs = [
        lambda h: tp.rolling_range(unkeyed, KEYS, "t", specs, h),
        lambda h: tp.running_max(unkeyed, KEYS, "t", "v", "m", h),
        lambda h: tp.lag_gap(unkeyed, KEYS, "t", ["row_id"], hot=h),
        lambda h: tp.rolling_median(unkeyed, KEYS, ["t", "row_id"], "v", hot=h),
        lambda h: tp.sessionize(unkeyed, KEYS, "t", "f", F.col("v").isNotNull(), F.col("v") > 10, h),
    ]
    for job in jobs:
        assert rows(job(None)) == rows(job(hot))
    assert tp.rolling_range(unkeyed, KEYS, "t", specs, hot).count() == unkeyed.count()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_matches_no_null_key(unkeyed, rows, how):
    hot = measure_hot_keys(unkeyed, KEYS, "t", max_rows=15, sliding_rows=15)
    left = unkeyed.where("f = 1").select(*KEYS, "t", F.col("row_id").alias("left_id"))
    right = unkeyed.where("f = 0").select(*KEYS, F.col("t").alias("rt"), "row_id", "v")
    plain = tp.asof_backward(left, right, KEYS, "t", "rt", ["row_id", "v"], how=how)
    assert rows(plain) == rows(tp.asof_backward(left, right, KEYS, "t", "rt", ["row_id", "v"], how=how, hot=hot))
    missing = plain.where("hadm_id IS NULL")
    assert missing.where("row_id IS NOT NULL").count() == 0
    assert missing.count() == (left.where("hadm_id IS NULL").count() if how == "left" else 0)


def test_every_key_may_be_hot(events, rows):
    """No number of hot keys or of slices is too many."""
    hot = measure_hot_keys(events, KEYS, "t", max_rows=1, sliding_rows=1)
    keys = events.groupBy(*KEYS).count().where("count > 1").count()
    assert hot.cuts.count() == keys > 10
    assert hot.cuts.agg(F.max(F.size("_cuts"))).first()[0] > 200
    specs = {"s6": ("sum", "v", "6 HOURS")}
    assert rows(tp.rolling_range(events, KEYS, "t", specs)) == rows(tp.rolling_range(events, KEYS, "t", specs, hot))


def test_a_folder_that_executors_cannot_share_is_an_error():
    from types import SimpleNamespace

    from wardframe.session import shared_folder

    def session(master, setting=None, given=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: given)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: setting), sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            shared_folder(session(master))
    assert shared_folder(session("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/wardframe-")
    assert shared_folder(session("yarn", None, "s3a://b/c")).startswith("s3a://b/c/wardframe-")
    assert shared_folder(session("local[4]"))


def test_rolling_range_first_needs_the_time(events):
    with pytest.raises(ValueError):
        tp.rolling_range(events, KEYS, "t", {"x": ("first", "v", "6 HOURS")})


def test_asof(events, data, hot, rows):
    left = events.where("f = 1").select(*KEYS, "t", F.col("row_id").alias("left_id"))
    right = events.where("f = 0").select(*KEYS, F.col("t").alias("rt"), "row_id", "v")
    for how in ("inner", "left"):
        plain = rows(tp.asof_backward(left, right, KEYS, "t", "rt", ["row_id", "v"], how=how))
        assert plain == rows(
            tp.asof_backward(left, right, KEYS, "t", "rt", ["row_id", "v"], how=how, hot=hot)
        )
    want = []
    for i, s, h, t, _, f in data:
        if f == 1:
            earlier = [r for r in data if r[1] == s and r[5] == 0 and r[3] <= t]
            best = max(earlier, key=lambda r: (r[3], r[0]), default=None)
            want.append((s, h, t, i, best and best[0], best and best[4]))
    assert plain == sorted(want, key=repr)


def test_previous_row_and_gaps(events, data, hot, rows):
    gaps = rows(tp.lag_gap(events, KEYS, "t", ["row_id"]))
    assert gaps == rows(tp.lag_gap(events, KEYS, "t", ["row_id"], hot=hot))
    args = (events, KEYS, "t", {"pv": "v"}, "6 HOURS", ["row_id"])
    near = rows(tp.prev_within(*args))
    assert near == rows(tp.prev_within(*args, hot=hot))
    want = []
    for i, s, h, t, v, f in data:
        earlier = [r for r in data if r[1] == s and (r[3], r[0]) < (t, i)]
        prev = max(earlier, key=lambda r: (r[3], r[0]), default=None)
        close = prev and prev[3] > t - timedelta(hours=6)
        want.append((i, s, h, t, v, f, prev[4] if close else None))
    assert near == sorted(want, key=repr)


@pytest.mark.parametrize("before,after", [(1, 1), (2, 3), (0, 2), (3, 0)])
def test_rolling_median(events, data, hot, rows, before, after):
    args = (events, KEYS, ["t", "row_id"], "v", before, after)
    plain = rows(tp.rolling_median(*args), "row_id", "median")
    # a sparse subset has slices with a single row and slices with none
    sparse = events.where("row_id % 7 = 0")
    assert plain == rows(tp.rolling_median(*args, hot=hot), "row_id", "median")
    assert rows(tp.rolling_median(sparse, *args[1:])) == rows(
        tp.rolling_median(sparse, *args[1:], hot=hot)
    )
    want = []
    for key in {r[1] for r in data}:
        ordered = sorted((r for r in data if r[1] == key), key=lambda r: (r[3], r[0]))
        for at, r in enumerate(ordered):
            near = ordered[max(0, at - before) : at + after + 1]
            vals = sorted(x[4] for x in near if x[4] is not None)
            want.append((r[0], vals[(len(vals) - 1) // 2] if vals else None))
    assert plain == sorted(want, key=repr)


def test_sessionize(events, hot, rows):
    args = (events, KEYS, "t", "f", F.col("v").isNotNull(), F.col("v") > 10)
    plain = rows(tp.sessionize(*args))
    assert plain and plain == rows(tp.sessionize(*args, hot=hot))


def test_join_one_per_key(spark, events, hot, rows):
    dim = events.select(*KEYS).distinct().withColumn("admittime", F.lit(START).cast("timestamp_ntz"))
    plain = rows(tp.within_anchor(events, dim, KEYS, "t", "admittime", "0 HOURS", "24 HOURS"), *events.columns, "admittime")
    split = tp.within_anchor(events, dim, KEYS, "t", "admittime", "0 HOURS", "24 HOURS", hot)
    assert plain == rows(split, *events.columns, "admittime")
    assert join_one_per_key(events, dim.where("subject_id > 1"), KEYS, "t", hot).count() == (
        events.where("subject_id > 1").count()
    )
