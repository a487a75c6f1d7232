"""Present-on-admission exclusion and first onsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wardframe.operators.skew import not_null

KEYS = ["subject_id", "hadm_id"]


def on_admission(first_positive: str, hours: int) -> Column:
    """Was the first positive event at most ``hours`` after ``admittime`` (inclusive)?"""
    return F.col(first_positive) <= F.col("admittime") + F.make_dt_interval(hours=F.lit(hours))


def exclude_present_on_admission(
    df: DataFrame,
    positives: DataFrame,
    admissions: DataFrame,
    keys: Sequence[str] = tuple(KEYS),
    t: str = "charttime",
    hours: int = 48,
) -> DataFrame:
    """Drop every admission with a positive event up to ``hours`` after admission.

    The earliest positive event per admission decides, so the events shrink to one row per key
    before they meet the admissions, and to the excluded keys before they meet ``df``. Rows without a
    key belong to no admission and drop out.
    """
    keys = list(keys)
    df = df.where(not_null(keys))
    excluded = (
        positives.groupBy(*keys)
        .agg(F.min(t).alias("_first"))
        .join(admissions.select(*keys, "admittime"), keys)
        .where(on_admission("_first", hours))
        .select(*keys)
    )
    return df.join(excluded, keys, "left_anti")


def keep_acquired(
    per_admission: DataFrame, first_positive: str, admissions: DataFrame, hours: int
) -> DataFrame:
    """The same exclusion when ``per_admission`` already has one row per key."""
    joined = per_admission.join(admissions.select(*KEYS, "admittime"), KEYS, "left")
    early = F.coalesce(on_admission(first_positive, hours), F.lit(False))
    return joined.where(~early).drop("admittime")


def first_onset(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    level: str,
    min_level: int = 1,
    running: bool = True,
) -> DataFrame:
    """Earliest time of every level from ``min_level`` up.

    With ``running`` the levels are running maxima already. Otherwise they are raw, and a level
    counts only until a higher one is reached; that needs the first time of each raw level, not
    the running series, so the events are combined map-side and no key is gathered in one task.
    """
    keys = list(keys)
    reached = (
        df.where((F.col(level) >= min_level) & F.col(t).isNotNull())
        .groupBy(*keys, F.col(level).alias("label"))
        .agg(F.min(t).alias("timestamp"))
    )
    if not running:
        higher = W.partitionBy(*keys).orderBy(F.desc("label")).rowsBetween(W.unboundedPreceding, -1)
        reached = reached.withColumn("_higher", F.min("timestamp").over(higher)).where(
            F.col("_higher").isNull() | (F.col("timestamp") < F.col("_higher"))
        )
    return reached.select(*keys, "timestamp", "label")
