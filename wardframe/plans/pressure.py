"""Pressure injury: charted stage texts and the running stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardframe.functions import codes as C
from wardframe.operators import temporal as tp
from wardframe.operators.cohort import KEYS
from wardframe.operators.rules import categorize, without_errors
from wardframe.operators.skew import HotKeys, not_null


def pressure_injury_stages(chartevents: DataFrame) -> DataFrame:
    stage = categorize("value", C.PRESSURE_INJURY_STAGES, 0)
    return chartevents.where(F.col("itemid").isin(C.PRESSURE_INJURY) & without_errors()).select(
        *KEYS, "charttime", "value", stage.alias("pi_stage")
    )


def running_pi_stages(stages: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    series = stages.where(not_null(KEYS)).select(*KEYS, "charttime", "pi_stage")
    return tp.running_max(series, KEYS, "charttime", "pi_stage", hot=hot)
