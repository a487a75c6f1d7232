"""The reusable operators on the event, order and line item tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardframe.checks import expected_values as V
from wardframe.checks.registry import in_list, query
from wardframe.checks.role_views import KEYS
from wardframe.functions import codes as C
from wardframe.operators.skew import measure_hot_keys
from wardframe.operators import rules, temporal as tp
from wardframe.operators.cohort import exclude_present_on_admission, first_onset
from wardframe.plans.kidney import WEIGHT_UNITS
from wardframe.plans.severity import vital_series

STAY = ["subject_id", "hadm_id", "icustay_id"]
EVENT = ["row_id", "subject_id", "hadm_id", "charttime", "value"]
BY_KEY = "PARTITION BY subject_id, hadm_id ORDER BY charttime"


@query(
    "t1_within_anchor_window",
    """SELECT e.row_id, e.subject_id, e.hadm_id, e.icustay_id, e.charttime, e.value, i.intime
    FROM fx_events e JOIN fx_icustays i
      ON e.subject_id = i.subject_id AND e.hadm_id = i.hadm_id AND e.icustay_id = i.icustay_id
    WHERE e.charttime BETWEEN i.intime AND i.intime + INTERVAL 1 DAY""",
    split=True,
)
def within_anchor_window(r):
    events = r.events.select("row_id", *STAY, "charttime", "value")
    stays = r.icustays.select(*STAY, "intime")
    return tp.within_anchor(
        events, stays, STAY, "charttime", "intime", None, "1 DAY", r.hot("icustay_id")
    ).select(*events.columns, "intime")


FLAGS = {"accepted": "A", "none": "N", "returned": "R"}
AGGS = {"min": "min", "max": "max", "mean": "avg"}


@query(
    "t2_pivot_agg",
    "SELECT l_suppkey, "
    + ", ".join(
        f"round({fn}(CASE WHEN l_returnflag = '{code}' THEN l_extendedprice END), 6) "
        f"AS {name}_{agg}"
        for name, code in FLAGS.items()
        for agg, fn in AGGS.items()
    )
    + " FROM lineitem GROUP BY l_suppkey",
)
def pivot_agg(r):
    return rules.pivot_agg(
        r.table("lineitem"), ["l_suppkey"], "l_returnflag", "l_extendedprice", FLAGS, list(AGGS)
    )


@query(
    "t3_asof_backward",
    """SELECT c.row_id AS creatinine_id, c.subject_id, c.hadm_id, c.charttime, c.creatinine,
      h.charttime AS hgb_time, h.hgb
    FROM fx_creatinine c ASOF JOIN fx_hgb h
      ON c.subject_id = h.subject_id AND c.hadm_id = h.hadm_id AND c.charttime >= h.charttime""",
    split=True,
)
def asof_backward(r):
    left = r.creatinine.withColumnRenamed("row_id", "creatinine_id")
    right = r.hgb.withColumnRenamed("charttime", "hgb_time")
    return tp.asof_backward(
        left, right, KEYS, "charttime", "hgb_time", ["hgb_time", "hgb"], hot=r.hot()
    )


@query(
    "t4_rolling_range_agg",
    f"""SELECT row_id, subject_id, hadm_id, charttime, value,
      round(sum(value) OVER ({BY_KEY} RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW), 6)
        AS sum_6h,
      min(value) OVER ({BY_KEY} RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND CURRENT ROW)
        AS min_48h,
      max(value) OVER ({BY_KEY} RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)
        AS max_24h,
      count(value) OVER ({BY_KEY} RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
        AS count_1h,
      first(charttime) OVER ({BY_KEY} RANGE BETWEEN INTERVAL 12 HOUR PRECEDING AND CURRENT ROW)
        AS first_12h
    FROM fx_events""",
    split=True,
)
def rolling_range_agg(r):
    specs = {
        "sum_6h": ("sum", "value", "6 HOURS"),
        "min_48h": ("min", "value", "48 HOURS"),
        "max_24h": ("max", "value", "24 HOURS"),
        "count_1h": ("count", "value", "1 HOURS"),
        "first_12h": ("first", "charttime", "12 HOURS"),
    }
    return tp.rolling_range(r.events.select(*EVENT), KEYS, "charttime", specs, r.hot())


#: Three rows in four without an admission: (patient, NULL) is a key of windows, and matches nothing in joins.
UNKEYED = "SELECT * REPLACE (CASE WHEN row_id % 4 = 0 THEN hadm_id END AS hadm_id)"


def _unkeyed(df):
    return df.withColumn("hadm_id", F.expr("CASE WHEN row_id % 4 = 0 THEN hadm_id END"))


@query(
    "t3_asof_backward_null_keys",
    f"""SELECT c.row_id AS creatinine_id, c.subject_id, c.hadm_id, c.charttime, c.creatinine, (
        SELECT max(h.charttime) FROM ({UNKEYED} FROM fx_hgb) h WHERE h.subject_id = c.subject_id
          AND h.hadm_id = c.hadm_id AND h.charttime <= c.charttime) AS hgb_time
    FROM ({UNKEYED} FROM fx_creatinine) c""",
    split=True,
)
def asof_backward_null_keys(r):
    left = _unkeyed(r.creatinine).withColumnRenamed("row_id", "creatinine_id")
    right = _unkeyed(r.hgb).withColumn("hgb_time", F.col("charttime")).drop("charttime")
    hot = measure_hot_keys(_unkeyed(r.events), KEYS, "charttime", r.max_rows, r.max_rows)
    return tp.asof_backward(left, right, KEYS, "charttime", "hgb_time", ["hgb_time"], how="left", hot=hot)


@query(
    "t4_rolling_range_agg_null_keys",
    f"""SELECT row_id, subject_id, hadm_id, charttime, value, (
        SELECT round(sum(e.value), 6) FROM ({UNKEYED} FROM fx_events) e
        WHERE e.subject_id = u.subject_id AND e.hadm_id IS NOT DISTINCT FROM u.hadm_id
          AND e.charttime <= u.charttime AND e.charttime >= u.charttime - INTERVAL 6 HOUR) AS sum_6h
    FROM ({UNKEYED} FROM fx_events) u""",
    split=True,
)
def rolling_range_agg_null_keys(r):
    events = _unkeyed(r.events.select(*EVENT))
    hot = measure_hot_keys(events, KEYS, "charttime", r.max_rows, r.max_rows)
    return tp.rolling_range(events, KEYS, "charttime", {"sum_6h": ("sum", "value", "6 HOURS")}, hot)


@query(
    "t5_rolling_rows_median",
    f"""SELECT row_id, subject_id, hadm_id, charttime, value,
      quantile_disc(value, 0.5) OVER ({BY_KEY}, row_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
        AS median
    FROM fx_events""",
    split=True,
)
def rolling_rows_median(r):
    events = r.events.select(*EVENT)
    return tp.rolling_median(events, KEYS, ["charttime", "row_id"], "value", hot=r.hot())


@query(
    "t6_lag_gap_seconds",
    f"""SELECT row_id, subject_id, hadm_id, charttime,
      CAST(floor(epoch(charttime)) - floor(epoch(lag(charttime) OVER ({BY_KEY}, row_id))) AS BIGINT)
        AS gap_seconds
    FROM fx_events""",
    split=True,
)
def lag_gap_seconds(r):
    events = r.events.select("row_id", *KEYS, "charttime")
    return tp.lag_gap(events, KEYS, "charttime", ["row_id"], hot=r.hot())


@query(
    "t7_running_max",
    f"""SELECT row_id, subject_id, hadm_id, charttime, value, max(value) OVER ({BY_KEY}) AS highest
    FROM fx_events""",
    split=True,
)
def running_max(r):
    events = r.events.select(*EVENT)
    return tp.running_max(events, KEYS, "charttime", "value", "highest", r.hot())


@query(
    "t8_sessionize",
    f"""SELECT subject_id, hadm_id,
      row_number() OVER (PARTITION BY subject_id, hadm_id ORDER BY grp) AS seq,
      starttime, endtime,
      round((floor(epoch(endtime)) - floor(epoch(starttime))) / 3600, 6) AS duration_hours
    FROM (SELECT subject_id, hadm_id, grp, min(charttime) AS starttime, max(charttime) AS endtime,
        bool_or(event_type = 'view') AS viewed
      FROM (SELECT *, sum(new) OVER ({BY_KEY}) AS grp
        FROM (SELECT *, CASE WHEN charttime > lag(charttime) OVER ({BY_KEY}, row_id)
            + INTERVAL 8 HOUR THEN 1 ELSE 0 END AS new FROM fx_events))
      WHERE event_type <> 'signup' GROUP BY subject_id, hadm_id, grp)
    WHERE starttime <> endtime AND viewed""",
    split=True,
)
def sessionize(r):
    hot = r.hot()
    events = tp.previous_row(
        r.events, KEYS, ["charttime", "row_id"], {"previous": "charttime"}, hot
    )
    late = F.col("charttime") > F.col("previous") + F.expr("INTERVAL 8 HOURS")
    kind = F.col("event_type")
    return tp.sessionize(
        events.withColumn("new", F.when(late, 1).otherwise(0)),
        KEYS,
        "charttime",
        "new",
        kind != "signup",
        kind == "view",
        hot,
    )


@query(
    "t9_interval_overlap_flag",
    """SELECT i.icustay_id, i.intime, max(CASE WHEN e.icustay_id IS NOT NULL THEN 1 ELSE 0 END)
      AS flag
    FROM fx_icustays i LEFT JOIN (
      SELECT icustay_id, charttime AS starttime, charttime + INTERVAL 2 HOUR AS endtime
      FROM fx_events WHERE event_type = 'error') e
      ON i.icustay_id = e.icustay_id AND ((e.starttime <= i.intime AND e.endtime >= i.intime)
        OR (e.starttime >= i.intime AND e.starttime <= i.intime + INTERVAL 1 DAY))
    GROUP BY i.icustay_id, i.intime""",
    split=True,
)
def interval_overlap_flag(r):
    episodes = r.of_type("error").select(
        "icustay_id",
        F.col("charttime").alias("starttime"),
        (F.col("charttime") + F.expr("INTERVAL 2 HOURS")).alias("endtime"),
    )
    stays = r.icustays.select("icustay_id", "intime")
    hot = r.hot("icustay_id")
    return tp.overlap_flag(stays, episodes, "icustay_id", "intime", "1 DAY", hot=hot)


@query(
    "t10_prev_within",
    f"""SELECT row_id, subject_id, hadm_id, charttime, value,
      CASE WHEN prev_time > charttime - INTERVAL 6 HOUR THEN prev END AS previous
    FROM (SELECT *, lag(value) OVER ({BY_KEY}, row_id) AS prev,
      lag(charttime) OVER ({BY_KEY}, row_id) AS prev_time FROM fx_events)""",
    split=True,
)
def prev_within(r):
    events = r.events.select(*EVENT)
    return tp.prev_within(
        events, KEYS, "charttime", {"previous": "value"}, "6 HOURS", ["row_id"], r.hot()
    )


@query(
    "t11_pick_row",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders) WHERE rn = 1""",
)
def pick_row(r):
    orders = r.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return tp.pick_row(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "t12_exclude_present_on_admission",
    """SELECT c.row_id, c.subject_id, c.hadm_id, c.charttime, c.creatinine
    FROM fx_creatinine c LEFT JOIN (
      SELECT DISTINCT p.subject_id, p.hadm_id FROM fx_creatinine p
      JOIN fx_admissions a ON p.subject_id = a.subject_id AND p.hadm_id = a.hadm_id
      WHERE p.creatinine > 2 AND p.charttime <= a.admittime + INTERVAL 48 HOUR) x
      ON c.subject_id = x.subject_id AND c.hadm_id = x.hadm_id
    WHERE x.hadm_id IS NULL""",
)
def exclude_poa(r):
    high = r.creatinine.where(F.col("creatinine") > 2)
    return exclude_present_on_admission(r.creatinine, high, r.admissions).select(
        "row_id", *KEYS, "charttime", "creatinine"
    )


PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"


@query(
    "t13_first_onset_per_level",
    f"""SELECT o_custkey, min(o_orderdate) AS "timestamp", level AS label
    FROM (SELECT o_custkey, o_orderdate,
        max({PRIORITY}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS level FROM orders)
    WHERE level >= 2 GROUP BY o_custkey, level""",
)
def first_onset_per_level(r):
    orders = r.table("orders").select("o_custkey", "o_orderdate", F.expr(PRIORITY).alias("level"))
    return first_onset(orders, ["o_custkey"], "o_orderdate", "level", 2, running=False)


@query(
    "t13_first_onset_of_running_levels",
    f"""SELECT o_custkey, min(o_orderdate) AS "timestamp", level AS label
    FROM (SELECT o_custkey, o_orderdate,
        max({PRIORITY}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS level FROM orders)
    WHERE level >= 1 GROUP BY o_custkey, level""",
)
def first_onset_of_running_levels(r):
    orders = r.table("orders").select("o_custkey", "o_orderdate", F.expr(PRIORITY).alias("level"))
    levels = tp.running_max(orders, ["o_custkey"], "o_orderdate", "level")
    return first_onset(levels, ["o_custkey"], "o_orderdate", "level")


PROMO_SIZES = [1, 5, 10, 15, 20]


@query(
    "t14_code_flag",
    f"""SELECT l_orderkey, bool_or(p_size IN ({in_list(PROMO_SIZES)})) AS label
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
)
def code_flag(r):
    sized = r.table("lineitem").join(
        r.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey"
    )
    return rules.code_flag(sized, ["l_orderkey"], "p_size", PROMO_SIZES)


QUANTITY_BANDS = [
    ("l_quantity > 45", 6, "l_quantity"),
    ("l_discount < 0.02", 4, "l_discount"),
    ("l_quantity >= 20 AND l_quantity <= 30", 3, "l_quantity"),
    ("l_tax >= 0.05 AND l_tax < 0.07", 1, "l_tax"),
]


@query(
    "t15_band",
    "SELECT l_quantity, l_discount, l_tax, CASE WHEN l_quantity IS NULL THEN NULL "
    + " ".join(f"WHEN {c} THEN {s}" for c, s, _ in QUANTITY_BANDS)
    + " ELSE 0 END AS score, round(CASE WHEN l_quantity IS NULL THEN NULL "
    + " ".join(f"WHEN {c} THEN {v}" for c, _, v in QUANTITY_BANDS)
    + " ELSE (l_discount + l_tax) / 2 END, 6) AS worst FROM lineitem",
)
def band(r):
    middle = (F.col("l_discount") + F.col("l_tax")) / 2
    return r.table("lineitem").select(
        "l_quantity",
        "l_discount",
        "l_tax",
        rules.band(QUANTITY_BANDS, 0, "l_quantity").alias("score"),
        rules.band_value(QUANTITY_BANDS, middle, "l_quantity").alias("worst"),
    )


@query(
    "t16_categorize",
    f"SELECT subject_id, hadm_id, {V.ethnicity_of('ethnicity')} AS ethnicity FROM fx_admissions",
)
def categorize(r):
    return r.admissions.select(
        *KEYS, rules.categorize("ethnicity", C.ETHNICITY, "OTHER").alias("ethnicity")
    )


@query(
    "t17_normalize_units",
    """SELECT row_id, itemid, concept, round(CASE WHEN itemid = 223761 THEN (valuenum - 32) / 1.8
      ELSE valuenum END, 6) AS value_norm
    FROM (SELECT *, CASE WHEN itemid = 220045 AND valuenum > 0 AND valuenum < 300 THEN 'heartrate'
        WHEN itemid = 220050 AND valuenum > 0 AND valuenum < 400 THEN 'sysbp'
        WHEN itemid = 220051 AND valuenum > 0 AND valuenum < 300 THEN 'diasbp'
        WHEN itemid = 220052 AND valuenum > 0 AND valuenum < 300 THEN 'meanbp'
        WHEN itemid = 220210 AND valuenum > 0 AND valuenum < 70 THEN 'resprate'
        WHEN itemid = 223761 AND valuenum > 70 AND valuenum < 120 THEN 'tempc'
        WHEN itemid = 223762 AND valuenum > 10 AND valuenum < 50 THEN 'tempc'
        WHEN itemid = 220277 AND valuenum > 0 AND valuenum <= 100 THEN 'spo2'
        WHEN itemid = 220621 AND valuenum > 0 THEN 'glucose' END AS concept
      FROM fx_vitals WHERE error IS DISTINCT FROM 1)
    WHERE concept IS NOT NULL""",
)
def normalize_units(r):
    return vital_series(r.vitals).select("row_id", "itemid", "concept", "value_norm")


@query(
    "t17_normalize_weights",
    """SELECT row_id, 'weight' AS concept, round(CASE itemid WHEN 3581 THEN valuenum * 0.45359237
      WHEN 3582 THEN valuenum * 0.0283495231 ELSE valuenum END, 6) AS value_norm
    FROM fx_weights WHERE error IS NULL OR error <> 1""",
)
def normalize_weights(r):
    return rules.normalize_units(r.weights, WEIGHT_UNITS).select("row_id", "concept", "value_norm")
