"""The generated parquet tables in the shapes the jobs read.

A patient is a user of ``events``; an admission is a ten-day block of that user's January; each
admission has one ICU stay. Event kinds and ids decide which measurement a row stands for. Urine
and weights run on a clock 24 times faster, or their gaps would be too long for the density rule;
there an admission is the whole month of a user. ``oracle_views.py`` builds the same views in SQL.
Values keep all their decimals: where a tie is rounded, the two engines go different ways.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardframe.checks.expected_values import PRESSURE_VALUES
from wardframe.operators.skew import MAX_ROWS, SLIDING_ROWS, HotKeys, measure_hot_keys, pin

KEYS = ["subject_id", "hadm_id"]
WELL = "(subject_id % 5 = 4)"  # users of the fast clock without any sign of kidney injury


def _case(selector: str, *branches: tuple[object, object], default: object) -> Column:
    chosen = F
    for key, value in branches:
        chosen = chosen.when(F.expr(selector) == F.lit(key), F.lit(value))
    return chosen.otherwise(F.lit(default))


class Roles:
    """``staged``: write the derived admissions and patients down once, for queries that read them often."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, max_rows: int = MAX_ROWS, staged: bool = False
    ):
        self.spark, self.sf_dir, self.max_rows, self.staged = spark, sf_dir, max_rows, staged
        self._hot: dict[tuple[str, ...], HotKeys | None] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def hot(self, *keys: str) -> HotKeys | None:
        """Hot admissions (or other keys) of the event table, which every event view is part of."""
        return self._measured("events", keys or tuple(KEYS))

    def hot_fast_clock(self) -> HotKeys | None:
        return self._measured("urine", tuple(KEYS))

    def _measured(self, view: str, keys: tuple[str, ...]) -> HotKeys | None:
        if (view, *keys) not in self._hot:
            rows = getattr(self, view)
            self._hot[(view, *keys)] = measure_hot_keys(
                rows, keys, "charttime", self.max_rows, min(self.max_rows, SLIDING_ROWS)
            )
        return self._hot[(view, *keys)]

    @cached_property
    def events(self) -> DataFrame:
        block = F.expr("datediff(ts, DATE'2024-01-01') div 10")
        return self.table("events").select(
            F.col("event_id").alias("row_id"),
            F.col("user_id").alias("subject_id"),
            (F.col("user_id") * 10 + block).alias("hadm_id"),
            (F.col("user_id") * 10 + block + 1000000).alias("icustay_id"),
            F.col("ts").alias("charttime"),
            "event_type",
            "value",
        )

    def of_type(self, *types: str) -> DataFrame:
        return self.events.where(F.col("event_type").isin(list(types)))

    @cached_property
    def admissions(self) -> DataFrame:
        start = F.expr(
            "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(CAST(hadm_id % 10 * 10 AS INT))"
        )
        died = F.expr("hadm_id % 11 = 0")
        admissions = (
            self.events.select(*KEYS)
            .distinct()
            .withColumn("admittime", start)
            .withColumn("dischtime", F.col("admittime") + F.expr("INTERVAL 9 DAYS"))
            .withColumn("deathtime", F.when(died, F.col("admittime") + F.expr("INTERVAL 3 DAYS")))
            .withColumn(
                "admission_type",
                _case("hadm_id % 3", (0, "ELECTIVE"), (1, "EMERGENCY"), default="URGENT"),
            )
            .withColumn(
                "ethnicity",
                _case(
                    "subject_id % 6",
                    (0, "ASIAN - CHINESE"),
                    (1, "BLACK/AFRICAN"),
                    (2, "SOUTH AMERICAN"),
                    (3, "WHITE"),
                    (4, "UNABLE TO OBTAIN"),
                    default="PORTUGUESE",
                ),
            )
            .withColumn(
                "admission_location",
                _case(
                    "subject_id % 4",
                    (0, "CLINIC REFERRAL/PREMATURE"),
                    (1, "PHYS REFERRAL/NORMAL DELI"),
                    (2, "TRANSFER FROM HOSP/EXTRAM"),
                    default="EMERGENCY ROOM ADMIT",
                ),
            )
            .withColumn("discharge_location", F.when(died, "DEAD/EXPIRED").otherwise("HOME"))
            .withColumn(
                "insurance",
                _case("subject_id % 3", (0, "Medicare"), (1, "Private"), default="Self Pay"),
            )
            .withColumn("hospital_expire_flag", F.when(died, 1).otherwise(0))
        )
        return pin(admissions) if self.staged else admissions

    @cached_property
    def icustays(self) -> DataFrame:
        wait = F.expr("make_dt_interval(0, CAST(hadm_id % 5 * 6 AS INT))")
        return self.admissions.select(
            F.col("hadm_id").alias("row_id"),
            *KEYS,
            (F.col("hadm_id") + 1000000).alias("icustay_id"),
            _case("hadm_id % 2", (0, "MICU"), default="SICU").alias("first_careunit"),
            (F.col("admittime") + wait).alias("intime"),
            (F.col("admittime") + F.expr("INTERVAL 5 DAYS")).alias("outtime"),
        )

    @cached_property
    def patients(self) -> DataFrame:
        born = F.expr("date_add(DATE'1934-01-01', CAST(c_custkey * 7919 % 32800 AS INT))")
        patients = (
            self.table("customer")
            .select(
                F.col("c_custkey").alias("subject_id"),
                F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END").alias("gender"),
                born.cast("timestamp_ntz").alias("dob"),
            )
            .join(self.admissions.select("subject_id"), "subject_id", "left_semi")
        )
        return pin(patients) if self.staged else patients

    @cached_property
    def creatinine(self) -> DataFrame:
        return self.of_type("view").select(
            "row_id", *KEYS, "charttime", F.round(0.4 + F.col("value") / 50, 4).alias("creatinine")
        )

    @cached_property
    def hgb(self) -> DataFrame:
        return self.of_type("purchase").select(
            "row_id", *KEYS, "charttime", F.round(5 + F.col("value") / 10, 3).alias("hgb")
        )

    @cached_property
    def labevents(self) -> DataFrame:
        """Creatinine, hemoglobin and other labs; some without admission or value."""
        return self.events.select(
            "row_id",
            "subject_id",
            F.expr("CASE WHEN row_id % 37 <> 0 THEN hadm_id END").alias("hadm_id"),
            "charttime",
            F.expr(
                "CASE event_type WHEN 'view' THEN 50912 "
                "WHEN 'purchase' THEN CASE row_id % 2 WHEN 0 THEN 50811 ELSE 51222 END "
                "ELSE 50809 END"
            ).alias("itemid"),
            F.expr(
                "CASE WHEN row_id % 41 = 0 THEN NULL "
                "WHEN event_type = 'view' THEN round(0.4D + value / 50, 4) "
                "WHEN row_id % 43 = 0 THEN 0D ELSE round(5 + value / 10, 3) END"
            ).alias("valuenum"),
        )

    @cached_property
    def chart_hgb(self) -> DataFrame:
        """Charted hemoglobin, partly the same readings as the labs."""
        return self.of_type("purchase", "click").select(
            "row_id",
            *KEYS,
            "charttime",
            F.expr("CASE row_id % 2 WHEN 0 THEN 814 ELSE 220228 END").alias("itemid"),
            F.expr("round(value / 10, 3)").alias("valuenum"),
            F.expr("CASE WHEN row_id % 50 = 0 THEN 1 END").alias("error"),
        )

    @cached_property
    def vitals(self) -> DataFrame:
        return self.events.select(
            "row_id",
            *KEYS,
            "icustay_id",
            "charttime",
            _case(
                "row_id % 9",
                (0, 220045),
                (1, 220050),
                (2, 220051),
                (3, 220052),
                (4, 220210),
                (5, 223761),
                (6, 223762),
                (7, 220277),
                default=220621,
            ).alias("itemid"),
            F.col("value").alias("valuenum"),
            F.expr("CASE WHEN row_id % 50 = 0 THEN 1 END").alias("error"),
        )

    @cached_property
    def gcs(self) -> DataFrame:
        return self.events.select(
            "row_id",
            *KEYS,
            "icustay_id",
            F.expr("CAST(date_trunc('HOUR', charttime) AS TIMESTAMP_NTZ)").alias("charttime"),
            _case("row_id % 3", (0, 454), (1, 223900), default=184).alias("itemid"),
            F.expr(
                "CASE WHEN row_id % 3 = 1 AND row_id % 7 = 0 THEN 'No Response-ETT' ELSE 'ok' END"
            ).alias("value"),
            F.expr(
                "CAST(1 + row_id % (CASE row_id % 3 WHEN 0 THEN 6 WHEN 1 THEN 5 ELSE 4 END) "
                "AS DOUBLE)"
            ).alias("valuenum"),
            F.lit(None).cast("int").alias("error"),
        )

    @cached_property
    def vent(self) -> DataFrame:
        """Ventilation flags per stay and instant, as the settings job would give them."""

        def flag(condition: str, name: str) -> Column:
            return F.max(F.expr(f"CASE WHEN {condition} THEN 1 ELSE 0 END")).alias(name)

        return (
            self.events
            .groupBy("icustay_id", "charttime")
            .agg(
                flag("event_type IN ('click', 'error')", "mechvent"),
                flag("event_type = 'view'", "oxygentherapy"),
                flag("event_type = 'purchase'", "extubated"),
            )
            .withColumn("selfextubated", F.lit(0))
        )

    @cached_property
    def vent_chart(self) -> DataFrame:
        """Charted ventilation settings, oxygen devices and extubations, on the full hour."""
        return self.events.select(
            "row_id",
            "icustay_id",
            F.expr("CAST(date_trunc('HOUR', charttime) AS TIMESTAMP_NTZ)").alias("charttime"),
            _case(
                "row_id % 10",
                (0, 720),
                (1, 223849),
                (2, 467),
                (3, 226732),
                (4, 640),
                (5, 445),
                (6, 459),
                (7, 470),
                (8, 223848),
                default=3459,
            ).alias("itemid"),
            F.expr(
                "CASE WHEN row_id % 31 = 0 THEN NULL ELSE "
                "CASE row_id % 10 "
                "WHEN 0 THEN CASE WHEN row_id % 3 = 0 THEN 'Other/Remarks' ELSE 'Servo' END "
                "WHEN 2 THEN CASE row_id % 3 WHEN 0 THEN 'Ventilator' WHEN 1 THEN 'Cannula' "
                "ELSE 'None' END "
                "WHEN 3 THEN CASE WHEN row_id % 3 = 0 THEN 'Nasal cannula' ELSE 'Other' END "
                "WHEN 4 THEN CASE row_id % 3 WHEN 0 THEN 'Extubated' WHEN 1 THEN 'Self Extubation' "
                "ELSE 'Intubated' END "
                "WHEN 8 THEN CASE WHEN row_id % 3 = 0 THEN 'Other' ELSE 'Drager' END "
                "ELSE '5' END END"
            ).alias("value"),
            F.expr("CASE WHEN row_id % 50 = 0 THEN 1 END").alias("error"),
        )

    @cached_property
    def procedures(self) -> DataFrame:
        return self.of_type("purchase").select(
            "row_id",
            "icustay_id",
            F.expr("CAST(date_trunc('HOUR', charttime) AS TIMESTAMP_NTZ)").alias("starttime"),
            _case(
                "row_id % 4", (0, 227194), (1, 225468), (2, 225477), default=225401
            ).alias("itemid"),
        )

    def _fast(self) -> Column:
        return F.expr(
            "timestampadd(MICROSECOND, (unix_micros(CAST(charttime AS TIMESTAMP)) - "
            "unix_micros(CAST(TIMESTAMP_NTZ'2024-01-01' AS TIMESTAMP))) div 24, "
            "TIMESTAMP_NTZ'2024-01-01')"
        ).alias("charttime")

    @cached_property
    def urine(self) -> DataFrame:
        return self.events.select(
            "row_id",
            "subject_id",
            F.col("subject_id").alias("hadm_id"),
            F.lit(40055).alias("itemid"),
            self._fast(),
            F.expr(f"CASE WHEN {WELL} THEN 200 + value ELSE value / 20 END").alias("value"),
            F.expr("CASE WHEN row_id % 97 = 0 THEN 1 END").alias("iserror"),
        )

    @cached_property
    def weights(self) -> DataFrame:
        return self.of_type("signup").select(
            "row_id",
            "subject_id",
            F.col("subject_id").alias("hadm_id"),
            _case("row_id % 3", (0, 762), (1, 3581), default=3582).alias("itemid"),
            self._fast(),
            F.expr(
                "CASE row_id % 3 WHEN 0 THEN 50 + value / 10 WHEN 1 THEN 110 + value / 5 "
                "ELSE 1760 + value * 3 END"
            ).alias("valuenum"),
            F.expr(
                "CASE WHEN row_id % 20 = 0 THEN NULL WHEN row_id % 21 = 0 THEN 'cm' ELSE 'kg' END"
            ).alias("valueuom"),
            F.expr("CASE WHEN row_id % 50 = 0 THEN 1 END").alias("error"),
        )

    @cached_property
    def fast_labevents(self) -> DataFrame:
        """The labs of the month, and of each admission a first creatinine an hour after its start."""
        first = self.fast_admissions.select(
            (-F.col("subject_id")).alias("row_id"),
            *KEYS,
            (F.col("admittime") + F.expr("INTERVAL 1 HOUR")).alias("charttime"),
            F.lit(50912).alias("itemid"),
            F.expr(f"CASE WHEN {WELL} THEN 0.8D ELSE (6 + subject_id % 7) / 10D END").alias("valuenum"),
        )
        labs = self.labevents.select(
            "row_id",
            "subject_id",
            F.expr("CASE WHEN hadm_id IS NOT NULL THEN subject_id END").alias("hadm_id"),
            self._fast(),
            "itemid",
            F.expr(f"CASE WHEN {WELL} THEN 0.8D + valuenum / 100 ELSE valuenum END").alias("valuenum"),
        )
        return labs.unionByName(first)

    @cached_property
    def fast_admissions(self) -> DataFrame:
        """Starts up to 60 hours before the month, so that the first 48 hours end before, among or after its events."""
        before = F.expr("make_dt_interval(0, CAST(subject_id % 4 * 20 AS INT))")
        return (
            self.urine.select(*KEYS)
            .distinct()
            .withColumn("admittime", F.expr("TIMESTAMP_NTZ'2024-01-01'") - before)
        )

    @cached_property
    def fast_notes(self) -> DataFrame:
        return self.of_type("error").select(
            "subject_id",
            F.col("subject_id").alias("hadm_id"),
            self._fast().alias("timestamp"),
            F.expr(f"value > 60 AND NOT {WELL}").alias("label"),
        )

    @cached_property
    def fast_diagnoses(self) -> DataFrame:
        return self.diagnoses.withColumn("hadm_id", F.col("subject_id"))

    @cached_property
    def outputs(self) -> DataFrame:
        return self.events.select(
            "row_id",
            *KEYS,
            "icustay_id",
            "charttime",
            F.expr("CASE WHEN row_id % 10 = 0 THEN 227488 ELSE 226559 END").alias("itemid"),
            (F.col("value") * 20).alias("value"),
        )

    @cached_property
    def notes(self) -> DataFrame:
        return self.of_type("error").select(
            *KEYS, F.col("charttime").alias("timestamp"), (F.col("value") > 60).alias("label")
        )

    @cached_property
    def diagnoses(self) -> DataFrame:
        return self.of_type("signup").select(
            "row_id",
            *KEYS,
            F.expr("CAST(1 + row_id % 5 AS INT)").alias("seq_num"),
            F.expr(
                "CASE WHEN row_id % 40 BETWEEN 1 AND 5 "
                "THEN '584' || CAST(4 + row_id % 40 AS STRING) "
                "WHEN row_id % 40 = 7 THEN '5856' WHEN row_id % 40 = 8 THEN 'V420' "
                "ELSE CAST(row_id % 200 AS STRING) END"
            ).alias("icd9_code"),
        )

    @cached_property
    def ccs(self) -> DataFrame:
        return self.table("part").select(
            F.expr(
                "CASE WHEN p_size <= 2 THEN 58 + p_size WHEN p_size <= 4 THEN 199 "
                "WHEN p_size <= 12 THEN 176 + p_size ELSE p_size END"
            ).alias("ccs_id"),
            F.concat(
                F.lit("group "),
                F.expr(
                    "CASE WHEN p_size <= 2 THEN 58 + p_size WHEN p_size <= 4 THEN 199 "
                    "WHEN p_size <= 12 THEN 176 + p_size ELSE p_size END"
                ).cast("string"),
            ).alias("ccs_name"),
            F.col("p_partkey").cast("string").alias("icd9_code"),
        )

    @cached_property
    def services(self) -> DataFrame:
        return self.of_type("click").select(
            "row_id",
            *KEYS,
            F.col("charttime").alias("transfertime"),
            F.expr(
                "CASE WHEN value > 60 THEN 'TSURG' WHEN value > 30 THEN 'ORTHO' ELSE 'MED' END"
            ).alias("curr_service"),
        )

    @cached_property
    def pi(self) -> DataFrame:
        return self.of_type("error").select(
            "row_id",
            *KEYS,
            "charttime",
            F.expr("CASE row_id % 7 WHEN 0 THEN 551 WHEN 1 THEN 227618 WHEN 2 THEN 999 ELSE 224631 END").alias("itemid"),
            _case("row_id % 16", *enumerate(PRESSURE_VALUES), default="Healed").alias("value"),
            F.expr("CASE WHEN row_id % 50 = 0 THEN 1 END").alias("error"),
        )
