"""First-day aggregates per ICU stay and the severity score built on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardframe.functions import codes as C
from wardframe.operators import temporal as tp
from wardframe.operators.rules import (
    Unit,
    band,
    band_value,
    normalize_units,
    pivot_agg,
    without_errors,
)
from wardframe.operators.skew import HotKeys, keys_apart
from wardframe.plans.ventilation import vent_first_day

STAY = ["subject_id", "hadm_id", "icustay_id"]
DAY = "1 DAY"
GCS_REACH = "6 HOURS"  # how far back a missing part of the coma score is looked for

VITAL_UNITS = [
    Unit(itemid, "tempc", 32.0, 1.0, 1.8, low, high, closed)
    if name == "tempf"
    else Unit(itemid, name, low=low, high=high, closed=closed)
    for name, codes, low, high, closed in C.VITALS
    for itemid in codes
]


def _first_day(
    events: DataFrame, icustays: DataFrame, keys: list[str], hot: HotKeys | None
) -> DataFrame:
    anchors = icustays.select(*keys, "intime")
    return tp.within_anchor(events, anchors, keys, "charttime", "intime", None, DAY, hot)


def _urine_volumes(outputevents: DataFrame) -> DataFrame:
    codes = [*C.URINE_OUTPUT, C.GU_IRRIGANT_IN, C.GU_IRRIGANT_OUT]
    put_in = (F.col("itemid") == C.GU_IRRIGANT_IN) & (F.col("value") > 0)
    volume = F.when(put_in, -F.col("value")).otherwise(F.col("value"))
    return outputevents.where(F.col("itemid").isin(codes)).select(
        *STAY, "charttime", volume.alias("volume")
    )


def urine_first_day(
    icustays: DataFrame, outputevents: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Urine of the first day; irrigant put in counts negative. Stays without any drop out."""
    return (
        _first_day(_urine_volumes(outputevents), icustays, STAY, hot)
        .groupBy(*STAY)
        .agg(F.sum("volume").alias("urineoutput"))
    )


def vitals_first_day(
    icustays: DataFrame, chartevents: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Minimum, maximum and mean of eight vital signs in the first day.

    A stay whose readings are all out of range keeps its row, with NULLs.
    """
    readings = normalize_units(
        chartevents.select(*STAY, "charttime", "itemid", "valuenum", "error"),
        VITAL_UNITS,
        keep_out_of_range=True,
    ).select(*STAY, "charttime", "concept", "value_norm")
    return pivot_agg(
        _first_day(readings, icustays, STAY, hot),
        STAY,
        "concept",
        "value_norm",
        {v: v for v in C.VITAL_NAMES},
        ["min", "max", "mean"],
    )


def vital_series(chartevents: DataFrame) -> DataFrame:
    """All vital signs in range and in common units, in long form."""
    return normalize_units(chartevents, VITAL_UNITS)


GCS_PARTS = ["gcsmotor", "gcsverbal", "gcseyes"]
GCS_DEFAULTS = {"gcsmotor": 6.0, "gcsverbal": 5.0, "gcseyes": 4.0}
GCS_UNITS = [
    Unit(itemid, part)
    for part, codes in zip(GCS_PARTS, (C.GCS_MOTOR, C.GCS_VERBAL, C.GCS_EYES))
    for itemid in codes
]


def _points() -> Column:
    """The charted number; 0 for the speech of an intubated patient, who cannot speak."""
    item, value = F.col("itemid"), F.col("value")
    intubated = reduce(
        lambda a, b: a | b, [(item == code) & (value == text) for code, text in C.GCS_INTUBATED]
    )
    return F.when(intubated, 0.0).otherwise(F.col("valuenum"))


def _with_coma_score(readings: DataFrame) -> DataFrame:
    """``mingcs``, the parts and ``endotrachflag`` from the parts and, as ``prev_*``, those just before."""

    def summed(*sources: str):
        terms = [
            F.coalesce(*[F.col(f"{s}{p}") for s in sources], F.lit(GCS_DEFAULTS[p]))
            for p in GCS_PARTS
        ]
        return terms[0] + terms[1] + terms[2]

    verbal, prev_verbal = F.col("gcsverbal"), F.col("prev_gcsverbal")
    score = (
        F.when(verbal == 0, 15.0)
        .when(verbal.isNull() & (prev_verbal == 0), 15.0)
        .when(prev_verbal == 0, summed(""))
        .otherwise(summed("", "prev_"))
    )
    return readings.withColumns(
        {
            "mingcs": score,
            "endotrachflag": F.when(verbal == 0, 1).otherwise(0),
            **{p: F.coalesce(p, f"prev_{p}") for p in GCS_PARTS},
        }
    )


def gcs_first_day(
    icustays: DataFrame, chartevents: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Lowest coma score of the first day, missing parts taken from less than six hours before."""
    usable = chartevents.where(F.col("icustay_id").isNotNull()).select(
        "icustay_id", "charttime", "itemid", "error", _points().alias("points")
    )
    readings = normalize_units(usable, GCS_UNITS, value="points").select(
        "icustay_id", "charttime", "concept", "value_norm"
    )
    base = pivot_agg(
        _first_day(readings, icustays, ["icustay_id"], hot),
        ["icustay_id", "charttime"],
        "concept",
        "value_norm",
        {p: p for p in GCS_PARTS},
        ["max"],
    ).withColumnsRenamed({f"{p}_max": p for p in GCS_PARTS})
    paired = tp.prev_within(
        base, ["icustay_id"], "charttime", {f"prev_{p}": p for p in GCS_PARTS}, GCS_REACH, hot=hot
    )
    scored = _with_coma_score(paired).select(
        "icustay_id", "charttime", "mingcs", *GCS_PARTS, "endotrachflag"
    )
    lowest = tp.pick_row(scored, ["icustay_id"], ["mingcs", "charttime"]).drop("charttime")
    return icustays.select(*STAY).join(lowest, "icustay_id", "left").select(
        *STAY, "mingcs", *GCS_PARTS, "endotrachflag"
    )


VITAL_COLUMNS = [f"{v}_{agg}" for v in C.VITAL_NAMES for agg in ("min", "max", "mean")]
FIRST_DAY = ["urineoutput", "vent", *VITAL_COLUMNS, "mingcs", *GCS_PARTS, "endotrachflag"]


@keys_apart("icustays", "chartevents", "outputevents", "durations")
def first_day(
    icustays: DataFrame,
    chartevents: DataFrame,
    outputevents: DataFrame,
    durations: DataFrame,
    hot: HotKeys | None = None,
    every_stay: bool = True,
) -> DataFrame:
    """All first-day concepts of the stays in one pass: urine, ventilation, vital signs, coma score.

    Without ``every_stay``, stays without any event may be left out; ``oasis_cohort`` adds them anyway.
    Each event is looked up once, as (concept, unit, range), and meets its stay once; one aggregate per
    stay and instant and one per stay give all columns, on one partitioning by stay. The columns are those of
    the single jobs, which also do the work for hot stays (``hot`` is by ``icustay_id``).
    """
    if hot is not None:
        parts = [
            urine_first_day(icustays, outputevents, hot),
            vent_first_day(icustays, durations, hot),
            vitals_first_day(icustays, chartevents, hot),
            gcs_first_day(icustays, chartevents, hot),
        ]
        wide = icustays.select(*STAY)
        for part in parts:
            wide = wide.join(part.drop("subject_id", "hadm_id"), "icustay_id", "left")
        return wide.select(*STAY, *FIRST_DAY)

    charted = normalize_units(
        chartevents.select(*STAY, "charttime", "itemid", "error", _points().alias("points")),
        [*VITAL_UNITS, *GCS_UNITS],
        value="points",
    ).select(*STAY, "charttime", "concept", F.col("value_norm").alias("number"))
    urine = _urine_volumes(outputevents).select(
        *STAY, "charttime", F.lit("urine").alias("concept"), F.col("volume").alias("number")
    )
    spans = durations.select(
        "icustay_id", F.col("starttime").alias("charttime"), "endtime", F.lit("vent").alias("concept")
    )
    readings = charted.unionByName(urine).unionByName(spans, allowMissingColumns=True)
    events = readings.withColumnsRenamed({c: f"_{c}" for c in STAY})

    concept, t, start = F.col("concept"), F.col("charttime"), F.col("intime")
    coma, of_stay = concept.isin(GCS_PARTS), (F.col("subject_id") == F.col("_subject_id")) & (
        F.col("hadm_id") == F.col("_hadm_id")
    )
    in_day = t.between(start, start + tp.interval(DAY))
    covers = (concept == "vent") & (t <= start) & (F.col("endtime") >= start)
    meets = covers | (in_day & (coma | (concept == "vent") | of_stay))
    # A short list of stays is sent to the events, which then leave all but the first days behind.
    day = events.join(
        icustays.select(*STAY, "intime"), (F.col("icustay_id") == F.col("_icustay_id")) & meets
    )

    def of(name: str) -> Column:
        return F.when(concept == name, F.col("number"))

    instants = day.groupBy(*STAY, "charttime").agg(
        F.bool_or(coma).alias("_coma"),
        F.bool_or(concept == "vent").alias("_vent"),
        F.sum(of("urine")).alias("urine_sum"),
        *[F.max(of(p)).alias(p) for p in GCS_PARTS],
        *[
            fn(of(v)).alias(f"{v}_{name}")
            for v in C.VITAL_NAMES
            for name, fn in (("min", F.min), ("max", F.max), ("sum", F.sum), ("n", F.count))
        ],
    )
    # The coma readings just before, over rows that may hold other concepts only.
    before = {**{f"prev_{p}": p for p in GCS_PARTS}, "_prev_t": "charttime"}
    paired = tp.previous_row(instants, ["icustay_id"], ["charttime"], before, where=F.col("_coma"))
    near = F.col("_prev_t") > F.col("charttime") - tp.interval(GCS_REACH)
    paired = paired.withColumns({f"prev_{p}": F.when(near, F.col(f"prev_{p}")) for p in GCS_PARTS})
    lowest = F.struct("mingcs", *GCS_PARTS, "endotrachflag")
    found = (
        _with_coma_score(paired)
        .groupBy(*STAY)
        .agg(
            F.sum("urine_sum").alias("urineoutput"),
            F.max(F.col("_vent").cast("int")).alias("vent"),
            *[
                column.alias(f"{v}_{name}")
                for v in C.VITAL_NAMES
                for name, column in (
                    ("min", F.min(f"{v}_min")),
                    ("max", F.max(f"{v}_max")),
                    ("mean", F.sum(f"{v}_sum") / F.nullif(F.sum(f"{v}_n"), F.lit(0))),
                )
            ],
            F.min_by(lowest, F.when(F.col("_coma"), F.struct("mingcs", "charttime"))).alias("_low"),
        )
        .select("*", "_low.*")
        .select(*STAY, *FIRST_DAY)
    )
    if not every_stay:
        return found
    return (
        icustays.select(*STAY)
        .join(found.drop("subject_id", "hadm_id"), "icustay_id", "left")
        .withColumn("vent", F.coalesce("vent", F.lit(0)))
    )


def _first_surgical(services: DataFrame) -> DataFrame:
    """The earliest transfer to a surgical service per admission; it decides for each of its stays."""
    current = F.col("curr_service")
    surgical = services.where(F.lower(current).contains("surg") | (current == "ORTHO"))
    return surgical.groupBy("hadm_id").agg(F.min("transfertime").alias("_surgery"))


def _surgical() -> Column:
    return F.when(F.col("_surgery") < F.col("intime") + tp.interval(DAY), 1).otherwise(0)


def surgical_flag(icustays: DataFrame, services: DataFrame) -> DataFrame:
    """1 if a surgical service took over before the end of the first day."""
    return (
        icustays.select("icustay_id", "hadm_id", "intime")
        .join(_first_surgical(services), "hadm_id", "left")
        .select("icustay_id", _surgical().alias("surgical"))
    )


def oasis_cohort(
    icustays: DataFrame,
    admissions: DataFrame,
    patients: DataFrame,
    concepts: DataFrame,
    services: DataFrame,
) -> DataFrame:
    """One row per ICU stay with everything the score needs; all sides have one row per key.

    ``concepts`` has the columns of ``first_day``. What goes by admission is joined first, then by patient, then
    by stay, so that each key is dealt out once.
    """
    vital_columns = [
        f"{v}_{agg}" for v in ("heartrate", "meanbp", "resprate", "tempc") for agg in ("max", "min")
    ]
    stays = icustays.select(*STAY, "intime", "outtime")
    wide = (
        stays.join(
            admissions.select(
                "hadm_id",
                "admittime",
                "dischtime",
                "deathtime",
                "admission_type",
                "discharge_location",
                "hospital_expire_flag",
            ),
            "hadm_id",
        )
        .join(_first_surgical(services), "hadm_id", "left")
        .withColumn("surgical", _surgical())
        .join(patients.select("subject_id", "dob"), "subject_id")
        .join(
            concepts.select(
                "icustay_id", "mingcs", *vital_columns, "urineoutput", F.col("vent").alias("mechvent")
            ),
            "icustay_id",
            "left",
        )
        .withColumn("mechvent", F.coalesce("mechvent", F.lit(0)))
    )
    years = F.datediff("intime", "dob").cast("double") / C.YEAR_SEVERITY
    elective = (
        F.when((F.col("admission_type") == "ELECTIVE") & (F.col("surgical") == 1), 1)
        .when(F.col("admission_type").isNull() | F.col("surgical").isNull(), None)
        .otherwise(0)
    )
    age_group = F.when(years <= 1, "neonate").when(years <= 15, "middle").otherwise("adult")
    died_in_unit = (
        F.when(F.col("deathtime").between(F.col("intime"), F.col("outtime")), 1)
        .when(F.col("deathtime") <= F.col("intime"), 1)
        .when(
            (F.col("dischtime") <= F.col("outtime"))
            & (F.col("discharge_location") == "DEAD/EXPIRED"),
            1,
        )
        .otherwise(0)
    )
    return wide.select(
        *STAY,
        "intime",
        "outtime",
        "deathtime",
        tp.seconds_between(F.col("intime"), F.col("admittime")).alias("preiculos"),
        F.floor(years).alias("age"),
        "mingcs",
        *vital_columns,
        "mechvent",
        "urineoutput",
        elective.alias("electivesurgery"),
        age_group.alias("icustay_age_group"),
        died_in_unit.alias("icustay_expire_flag"),
        "hospital_expire_flag",
    )


def oasis_score(cohort: DataFrame) -> DataFrame:
    """Component values and scores, their sum, and the mortality probability."""
    columns = []
    for name, (known, default, rules) in C.OASIS_BANDS.items():
        if name in C.OASIS_MIDPOINTS:
            low, high = C.OASIS_MIDPOINTS[name]
            value = band_value(rules, (F.col(low) + F.col(high)) / 2, known)
        else:
            value = F.col(known)
        columns += [value.alias(name), band(rules, default, known).alias(f"{name}_score")]
    scored = cohort.select(
        *STAY, "icustay_age_group", "hospital_expire_flag", "icustay_expire_flag", *columns
    )
    scores = [F.coalesce(f"{name}_score", F.lit(0)) for name in C.OASIS_BANDS]
    intercept, slope = C.OASIS_LOGIT
    logit = F.lit(intercept) + F.lit(slope) * F.col("oasis")
    parts = [c for name in C.OASIS_BANDS for c in (name, f"{name}_score")]
    return (
        scored.withColumn("oasis", reduce(lambda a, b: a + b, scores))
        .withColumn("oasis_prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)))
        .select(
            *STAY,
            "icustay_age_group",
            "hospital_expire_flag",
            "icustay_expire_flag",
            "oasis",
            "oasis_prob",
            *parts,
        )
    )
