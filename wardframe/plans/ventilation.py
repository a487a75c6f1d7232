"""Mechanical ventilation: flags per instant, episodes, and the first-day flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardframe.functions import codes as C
from wardframe.operators import temporal as tp
from wardframe.operators.rules import without_errors
from wardframe.operators.skew import HotKeys, keys_apart

STAY = ["icustay_id"]
FLAGS = ["mechvent", "oxygentherapy", "extubated", "selfextubated"]
# Two rows can share an instant (chart and procedure); the flags then order them.
ORDER = ["charttime", *FLAGS]
MAX_PAUSE = "8 HOURS"


def _item(code: int, *values: str) -> Column:
    return (F.col("itemid") == code) & F.col("value").isin(list(values))


def vent_settings(chartevents: DataFrame, procedureevents: DataFrame) -> DataFrame:
    """0/1 flags per stay and instant; rows that set no flag stay, as zeros."""
    item, value = F.col("itemid"), F.col("value")
    vent_type, vent_type_none = C.VENT_TYPE
    vent_mode, vent_mode_none = C.VENT_MODE
    codes = [
        *C.VENT_SETTINGS, vent_type, vent_mode, C.O2_DEVICE, C.O2_DEVICES, *C.O2_FLOW, C.EXTUBATION,
    ]
    ventilated = (
        item.isin(C.VENT_SETTINGS)
        | ((item == vent_type) & (value != vent_type_none))
        | ((item == vent_mode) & (value != vent_mode_none))
        | _item(C.O2_DEVICE, C.O2_DEVICE_VENTILATOR)
    )
    oxygen = _item(C.O2_DEVICES, *C.O2_DEVICES_OXYGEN) | _item(C.O2_DEVICE, *C.O2_DEVICE_OXYGEN)
    conditions = {
        "mechvent": ventilated,
        "oxygentherapy": oxygen,
        "extubated": _item(C.EXTUBATION, C.EXTUBATED, C.SELF_EXTUBATED),
        "selfextubated": _item(C.EXTUBATION, C.SELF_EXTUBATED),
    }
    charted = (
        chartevents.where(
            item.isin(codes)
            & value.isNotNull()
            & F.col("icustay_id").isNotNull()
            & without_errors()
        )
        .groupBy("icustay_id", "charttime")
        .agg(*[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in conditions.items()])
    )
    procedures = procedureevents.where(
        item.isin(C.EXTUBATION_PROCEDURES) & F.col("icustay_id").isNotNull()
    ).select(
        "icustay_id",
        F.col("starttime").alias("charttime"),
        F.lit(0).alias("mechvent"),
        F.lit(0).alias("oxygentherapy"),
        F.lit(1).alias("extubated"),
        F.when(item == C.SELF_EXTUBATION_PROCEDURE, 1).otherwise(0).alias("selfextubated"),
    )
    return charted.unionByName(procedures).distinct()


@keys_apart("settings")
def vent_durations(settings: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Ventilation episodes per stay.

    A new one starts after an extubation, when oxygen is given without ventilation, or after more
    than eight hours without a ventilation setting.
    """
    vented, out = F.col("mechvent") == 1, F.col("extubated") == 1
    # "The previous ventilated row" and "the previous event" in one order of the stay: one sort.
    lagged = tp.previous_row(
        settings, STAY, ORDER, {"_vent_time": "charttime"}, hot, where=vented
    )
    lagged = tp.previous_row(
        lagged, STAY, ORDER, {"_extubated": "extubated"}, hot, where=vented | out
    )
    new = (
        F.when((vented | out) & (F.col("_extubated") == 1), 1)
        .when((F.col("mechvent") == 0) & (F.col("oxygentherapy") == 1), 1)
        .when(vented & (F.col("charttime") > F.col("_vent_time") + tp.interval(MAX_PAUSE)), 1)
        .otherwise(0)
    )
    return tp.sessionize(
        lagged.withColumn("_new", new), STAY, "charttime", "_new", vented | out, vented, hot
    ).withColumnRenamed("seq", "ventnum")


def vent_first_day(
    icustays: DataFrame, durations: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    stays = icustays.select("subject_id", "hadm_id", "icustay_id", "intime")
    flagged = tp.overlap_flag(stays, durations, "icustay_id", "intime", "1 DAY", "vent", hot)
    return flagged.select("subject_id", "hadm_id", "icustay_id", "vent")
