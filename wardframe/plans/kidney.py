"""Kidney injury: weights, urine rates, creatinine baselines and stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardframe.functions import codes as C
from wardframe.operators import temporal as tp
from wardframe.operators.cohort import KEYS
from wardframe.operators.ranks import lower_quantile
from wardframe.operators.rules import Unit, normalize_units, without_errors
from wardframe.operators.skew import HotKeys, join_one_per_key, keys_apart, not_null

WEIGHT_UNITS = [
    *[Unit(i, "weight") for i in C.WEIGHT_KG],
    *[Unit(i, "weight", factor=C.KG_PER_LB) for i in C.WEIGHT_LB],
    *[Unit(i, "weight", factor=C.KG_PER_OZ) for i in C.WEIGHT_OZ],
]

WINDOWS = ("6", "12", "24")  # hours
MAX_GAP_SECONDS = 5400
URINE_TIME = ["subject_id", "hadm_id", "charttime"]


def patient_weights(
    chartevents: DataFrame, hot: HotKeys | None = None, keep_null_uom: bool = False
) -> DataFrame:
    """Weight in kg and the lower median of it and its two neighbours."""
    unit = ~F.col("valueuom").isin(C.NOT_WEIGHT_UNITS)  # NULL for a NULL unit, which drops out
    if keep_null_uom:
        unit = F.col("valueuom").isNull() | unit
    usable = chartevents.where(F.col("valuenum").isNotNull() & unit & not_null(KEYS))
    weights = normalize_units(usable, WEIGHT_UNITS, out="weight").select(
        "row_id", *KEYS, "charttime", "weight"
    )
    return tp.rolling_median(
        weights, KEYS, ["charttime", "row_id"], "weight", out="median3", hot=hot
    )


def urine_volume(outputevents: DataFrame) -> DataFrame:
    """Urine per admission and instant."""
    return (
        outputevents.where(
            F.col("itemid").isin(C.URINE_OUTPUT)
            & not_null(KEYS)
            & without_errors("iserror")
        )
        .groupBy(*URINE_TIME)
        .agg(F.sum("value").alias("urine"))
    )


@keys_apart("urine", "weights", sliding=True)
def urine_stats(urine: DataFrame, weights: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Coverage, density and weight-normalised hourly rate over trailing 6, 12 and 24 hours.

    All windows share one partitioning and order, so without hot keys they run on one shuffle.
    """
    hourly = tp.rolling_range(urine, KEYS, "charttime", {"tot_1h": ("sum", "urine", "1 HOURS")}, hot)
    gaps = tp.lag_gap(hourly, KEYS, "charttime", out="gap", hot=hot)
    rated = tp.asof_backward(
        gaps,
        weights.select(*KEYS, F.col("charttime").alias("weight_time"), "row_id", "median3"),
        KEYS,
        "charttime",
        "weight_time",
        ["median3"],
        hot=hot,
    ).withColumn("rate", F.col("tot_1h") / F.nullif(F.col("median3"), F.lit(0.0)))
    specs = {}
    for h in WINDOWS:
        specs[f"first_{h}h"] = ("first", "charttime", f"{h} HOURS")
        specs[f"max_lag_{h}h"] = ("max", "gap", f"{h} HOURS")
        specs[f"max_wnrate_{h}h"] = ("max", "rate", f"{h} HOURS")
    columns = [f"{name}_{h}h" for name in ("first", "max_lag", "max_wnrate") for h in WINDOWS]
    return tp.rolling_range(rated, KEYS, "charttime", specs, hot).select(*URINE_TIME, *columns)


def creatinines(labevents: DataFrame) -> DataFrame:
    return labevents.where(
        (F.col("itemid") == C.CREATININE) & F.col("valuenum").isNotNull() & not_null(KEYS)
    ).select("row_id", *KEYS, "charttime", F.col("valuenum").alias("creatinine"))


def creatinine_baseline(
    creatinines: DataFrame,
    admissions: DataFrame,
    method: str = "median",
    window: str = "24 HOURS",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Baseline per admission from the labs within ``window`` of its start: nadir, maximum,
    median (lower) or first."""
    value = F.col("creatinine")
    methods = {
        "nadir": F.min(value),
        "maximum": F.max(value),
        "first": F.min_by(value, F.struct("charttime", "row_id")),
    }
    if method not in [*methods, "median"]:
        raise ValueError(f"unknown baseline method {method!r}: one of {sorted([*methods, 'median'])}")
    near = tp.within_anchor(
        creatinines,
        admissions.select(*KEYS, "admittime"),
        KEYS,
        "charttime",
        "admittime",
        f"-{window}",
        window,
        hot,
    )
    if method == "median":
        return lower_quantile(near, KEYS, "creatinine", 0.5, "baseline", hot)
    return near.groupBy(*KEYS).agg(methods[method].alias("baseline"))


def creatinine_increase(creatinines: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Creatinine with its rise above the lowest value of the trailing 48 hours."""
    lowest = tp.rolling_range(
        creatinines, KEYS, "charttime", {"lowest": ("min", "creatinine", "48 HOURS")}, hot
    )
    return lowest.withColumn("increase", F.col("creatinine") - F.col("lowest")).drop("lowest")


# Fixed values of the staging rules.
CREATININE_RATIOS = {"stage3_cr": 3.0, "stage2_cr": 2.0, "stage1_cr": 1.5}  # of the baseline
CREATININE_RISES = {"stage3_cr_inc": 0.5, "stage1_cr_inc": 0.3}  # mg/dL in 48 hours
CREATININE_SEVERE = 4.0
LOW_URINE_RATES = {"stage3_wnur": (24, 0.3), "stage2_wnur": (12, 0.5), "stage1_wnur": (6, 0.5)}
NO_URINE_HOURS = 12


def _covered(hours: int) -> Column:
    """The range is known over all but its last hour, without a gap of an hour and a half."""
    known_since = F.col(f"first_{hours}h") + tp.interval(f"{hours - 1} HOURS")
    return (F.col("charttime") > known_since) & (F.col(f"max_lag_{hours}h") < MAX_GAP_SECONDS)


def _aki_flags() -> dict[str, Column]:
    creatinine, rise = F.col("creatinine"), F.col("increase")
    low = {
        name: (F.col(f"max_wnrate_{h}h") < limit) & _covered(h)
        for name, (h, limit) in LOW_URINE_RATES.items()
    }
    none = (F.col(f"max_wnrate_{NO_URINE_HOURS}h") == 0.0) & _covered(NO_URINE_HOURS)
    low["stage3_wnur"] = low["stage3_wnur"] | none
    return {
        **{n: creatinine >= F.col("baseline") * ratio for n, ratio in CREATININE_RATIOS.items()},
        **{n: rise >= step for n, step in CREATININE_RISES.items()},
        "stage3_cr_thresh": creatinine >= CREATININE_SEVERE,
        **low,
    }


def aki_stages(
    increases: DataFrame,
    baseline: DataFrame,
    urine_stats: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Evidence flags and stage 0-3 per creatinine or urine instant.

    Flags stay NULL where their evidence is missing: NULL never fires and never blocks. The full
    join is on the instant too, so one busy admission spreads over the join's partitions.
    """
    labs = join_one_per_key(increases, baseline, KEYS, "charttime", hot, "left").select(
        *URINE_TIME, "creatinine", "baseline", "increase"
    )
    if urine_stats is None:
        missing = {f"{n}_{h}h": ty for h in WINDOWS for n, ty in
                   (("first", "timestamp_ntz"), ("max_lag", "bigint"), ("max_wnrate", "double"))}
        both = labs.withColumns({c: F.lit(None).cast(ty) for c, ty in missing.items()})
    else:
        both = labs.join(urine_stats, URINE_TIME, "full")
    flags = both.select(*URINE_TIME, *[c.alias(n) for n, c in _aki_flags().items()])
    risk = (
        F.when(
            F.col("stage3_cr")
            | F.col("stage3_wnur")
            | (F.col("stage3_cr_thresh") & F.col("stage3_cr_inc")),
            3,
        )
        .when(F.col("stage2_cr") | F.col("stage2_wnur"), 2)
        .when(F.col("stage1_cr") | F.col("stage1_wnur") | F.col("stage1_cr_inc"), 1)
        .otherwise(0)
    )
    return flags.withColumn("aki_risk", risk)


def running_aki_stages(stages: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    series = stages.select(*URINE_TIME, "aki_risk")
    return tp.running_max(series, KEYS, "charttime", "aki_risk", "aki_stage", hot).drop("aki_risk")


def crf_patients(diagnoses: DataFrame, codes=tuple(C.CHRONIC_KIDNEY_ICD9)) -> DataFrame:
    """Admissions with a chronic renal failure code."""
    return diagnoses.where(F.col("icd9_code").isin(list(codes))).select(*KEYS).distinct()


def acute_kidney_flag(
    diagnoses: DataFrame,
    codes=tuple(C.ACUTE_KIDNEY_ICD9),
    chronic=tuple(C.CHRONIC_KIDNEY_ICD9),
) -> DataFrame:
    """Any acute code, for admissions without a chronic one; both in one aggregate."""
    icd = F.col("icd9_code")
    return (
        diagnoses.groupBy(*KEYS)
        .agg(
            F.bool_or(icd.isin(list(codes))).alias("label"),
            F.bool_or(icd.isin(list(chronic))).alias("chronic"),
        )
        .where(~F.coalesce("chronic", F.lit(False)))
        .select(*KEYS, "label")
    )
