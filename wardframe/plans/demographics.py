"""Admission demographics and the distribution of primary diagnoses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from wardframe.functions import codes as C
from wardframe.operators.cohort import KEYS
from wardframe.operators.rules import categorize
from wardframe.operators.temporal import pick_row


def admission_demographics(
    patients: DataFrame, admissions: DataFrame, icustays: DataFrame, oasis: DataFrame
) -> DataFrame:
    """One row per admission with a scored ICU stay, described by its first one."""
    stay = [*KEYS, "icustay_id"]
    scored = icustays.select("row_id", *stay, "intime", "first_careunit").join(
        oasis.select(*stay, "oasis"), stay
    )
    first = pick_row(scored, KEYS, ["intime", "row_id"])
    days = F.datediff("admittime", "dob").cast("double")
    return (
        admissions.join(first.select(*KEYS, "intime", "first_careunit", "oasis"), KEYS)
        .join(patients.select("subject_id", "gender", "dob"), "subject_id")
        .select(
            *KEYS,
            (days / C.YEAR_DEMOGRAPHICS).alias("age"),
            "gender",
            "admittime",
            F.col("intime").alias("icutime"),
            F.col("first_careunit").alias("icu"),
            "oasis",
            categorize("ethnicity", C.ETHNICITY, "OTHER").alias("ethnicity"),
            "insurance",
            "admission_type",
            categorize("admission_location", C.ADMISSION_LOCATION, "OTHER").alias(
                "admission_location"
            ),
        )
    )


def ccs_primary_distribution(
    diagnoses: DataFrame, ccs: DataFrame, cohort: DataFrame
) -> DataFrame:
    """Grouped primary diagnoses of a cohort, with their share; one row per group."""
    counted = (
        diagnoses.where(F.col("seq_num") == 1)
        .join(cohort.select(*KEYS).distinct(), KEYS, "left_semi")
        .join(ccs.select("icd9_code", "ccs_id", "ccs_name"), "icd9_code")
        .groupBy("ccs_id", "ccs_name")
        .agg(F.count("*").alias("n"))
    )
    share = F.col("n").cast("double") / F.sum("n").over(W.partitionBy()).cast("double")
    return counted.withColumn("percent", share)
