"""Anemia: hemoglobin series, ages, pregnancies and severity bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardframe.functions import codes as C
from wardframe.operators import temporal as tp
from wardframe.operators.cohort import KEYS
from wardframe.operators.rules import code_flag, without_errors
from wardframe.operators.skew import HotKeys, join_one_per_key

SEVERITY = "anemia_severity"
SERIES = [*KEYS, "charttime", "age", "gender", "is_pregnant", "hgb"]


def hgb_series(labevents: DataFrame, chartevents: DataFrame | None = None) -> DataFrame:
    """Hemoglobin to one decimal. With charted values, equal rows of the two sources merge."""

    def readings(events: DataFrame, codes: list[int]) -> DataFrame:
        return events.where(F.col("itemid").isin(codes) & (F.col("valuenum") > 0)).select(
            *KEYS, "charttime", F.round("valuenum", 1).alias("hgb")
        )

    labs = readings(labevents, C.HEMOGLOBIN_LAB)
    if chartevents is None:
        return labs
    charted = readings(chartevents.where(without_errors()), C.HEMOGLOBIN_CHART)
    return charted.unionByName(labs).distinct()


def ccs_flag(diagnoses: DataFrame, ccs: DataFrame, groups, out: str = "label") -> DataFrame:
    """Any diagnosis in the given groups, per admission with at least one grouped diagnosis."""
    grouped = diagnoses.join(ccs.select("icd9_code", "ccs_id"), "icd9_code")
    return code_flag(grouped, KEYS, "ccs_id", groups, out)


def pregnancy_flag(diagnoses: DataFrame, ccs: DataFrame) -> DataFrame:
    return ccs_flag(diagnoses, ccs, C.PREGNANCY_CCS, "is_pregnant")


def _admitted(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    return admissions.select(*KEYS, "admittime").join(
        patients.select("subject_id", "dob"), "subject_id"
    )


def ages(
    admissions: DataFrame, patients: DataFrame, days_per_year: float = C.YEAR_AGES
) -> DataFrame:
    """Age in years at admission."""
    days = F.datediff("admittime", "dob").cast("double")
    return _admitted(admissions, patients).select(*KEYS, (days / days_per_year).alias("age"))


def adults(admissions: DataFrame, patients: DataFrame, years: int = 15) -> DataFrame:
    of_age = F.col("dob") + F.make_ym_interval(years=F.lit(years))
    return _admitted(admissions, patients).where(F.col("admittime") >= of_age).select(*KEYS)


def anemia_severity(
    hgb: DataFrame,
    ages: DataFrame,
    pregnancies: DataFrame,
    patients: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Severity 0-3 per reading; NULL for readings whose facts contradict (see ``quarantined``)."""
    people = ages.join(pregnancies, KEYS).join(
        patients.select("subject_id", "gender"), "subject_id"
    )
    series = join_one_per_key(hgb, people, KEYS, "charttime", hot).select(*SERIES)

    age = F.col("age").cast("int")  # whole years
    female, pregnant, value = F.col("gender") == "F", F.col("is_pregnant"), F.col("hgb")
    impossible = (
        (age < 0)
        | F.col("gender").isNull()
        | ~F.col("gender").isin("F", "M")
        | (value <= 0)
        | (pregnant & (age <= 11))
        | (pregnant & ~female & (age > 14))
    )

    def banded(group: str):
        three, two, one = C.ANEMIA_LIMITS[group]
        return F.when(value < three, 3).when(value < two, 2).when(value < one, 1).otherwise(0)

    severity = (
        F.when(impossible | age.isNull() | pregnant.isNull() | value.isNull(), None)
        .when(age <= 4, banded("to_4_years"))
        .when(age <= 11, banded("to_11_years"))
        .when((age <= 14) | (~pregnant & female), banded("to_14_years_or_women"))
        .when(pregnant, banded("pregnant"))
        .otherwise(banded("men"))
    )
    return series.withColumn(SEVERITY, severity)


def quarantined(severities: DataFrame) -> DataFrame:
    """Readings that no band applies to, set aside for review."""
    return severities.where(F.col(SEVERITY).isNull())


def running_anemia(severities: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Worst severity so far; quarantined readings take no part."""
    usable = severities.where(F.col(SEVERITY).isNotNull())
    return tp.running_max(usable, KEYS, "charttime", SEVERITY, hot=hot)
