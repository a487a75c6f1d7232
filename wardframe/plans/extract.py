"""The jobs end to end: catalog tables in, concept tables and CSV exports out.

Each named stage is a table, built once and reused (``materialize``), so a lost executor or a
restarted job repeats one stage and not the chain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.functions import codes as C
from wardframe.operators.cohort import KEYS
from wardframe.operators.skew import MAX_ROWS, measure_hot_keys, pin
from wardframe.plans import anemia, demographics, kidney, labels as L, pressure, severity
from wardframe.plans import ventilation
from wardframe.sources.csv import export_csv, read_note_labels
from wardframe.sources.tables import materialize, stage_name

CODED = sorted(
    {
        *[i for _, codes, *_ in C.VITALS for i in codes],
        *C.WEIGHT_KG, *C.WEIGHT_LB, *C.WEIGHT_OZ,
        *C.HEMOGLOBIN_CHART,
        *C.GCS_VERBAL, *C.GCS_MOTOR, *C.GCS_EYES,
        *C.VENT_SETTINGS, C.VENT_TYPE[0], C.VENT_MODE[0], C.O2_DEVICE, C.O2_DEVICES, *C.O2_FLOW,
        C.EXTUBATION,
        *C.PRESSURE_INJURY,
    }
)


def coded_events(chartevents: DataFrame) -> DataFrame:
    """The charted rows and columns that any concept reads: one scan of the largest table."""
    return chartevents.where(F.col("itemid").isin(CODED)).select(
        "row_id", *KEYS, "icustay_id", "charttime", "itemid", "value", "valuenum", "valueuom",
        "error",
    )


@dataclass(frozen=True)
class Catalog:
    """Where the tables are, and where stages go."""

    spark: SparkSession
    clinical: str = "clinical"
    ccs: str = "ccs_dx"
    stages: str = "stages"
    recreate: bool = False
    built: set[str] = field(default_factory=set, compare=False)  # by this catalog

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.clinical}.{name}")

    def ccs_single_level(self) -> DataFrame:
        return self.spark.table(f"{self.ccs}.ccs_single_level")

    def stage(
        self, name: str, build: Callable[[], DataFrame], series: bool = False, **params: object
    ) -> DataFrame:
        """``recreate`` rebuilds a stage once per catalog: later jobs read that, and frames made before keep theirs.

        A ``series`` of events is bucketed and sorted by admission, unless one admission has too many rows for a
        task, so that the jobs on it plan no exchange by admission.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.stages}")
        again = self.recreate and stage_name(name, **params) not in self.built
        self.built.add(stage_name(name, **params))
        layout = dict(by=KEYS, sort=[*KEYS, "charttime"], most_rows=MAX_ROWS) if series else {}
        return materialize(self.spark, f"{self.stages}.{name}", build, again, **layout, **params)

    def chart(self) -> DataFrame:
        return self.stage("coded_events", lambda: coded_events(self.table("chartevents")))


def concept_tables(c: Catalog) -> dict[str, DataFrame]:
    """Ventilation episodes, all first-day concepts in one pass, and the severity score, as stages."""
    stays, outputs, chart = c.table("icustays"), c.table("outputevents"), c.chart()

    def hot(events: DataFrame, t: str = "charttime"):
        return measure_hot_keys(events, ["icustay_id"], t)

    settings = c.stage(
        "vent_settings", lambda: ventilation.vent_settings(chart, c.table("procedureevents_mv"))
    )
    durations = c.stage(
        "vent_durations", lambda: ventilation.vent_durations(settings, hot(settings))
    )
    day = c.stage(
        "first_day",
        lambda: severity.first_day(
            stays, chart, outputs, durations, hot(chart.unionByName(outputs, allowMissingColumns=True))
        ),
    )

    def oasis() -> DataFrame:
        cohort = severity.oasis_cohort(
            stays, c.table("admissions"), c.table("patients"), day, c.table("services")
        )
        return severity.oasis_score(cohort)

    def of_day(columns: list[str], known: str | None = None) -> DataFrame:
        rows = day if known is None else day.where(F.col(known).isNotNull())
        return rows.select(*severity.STAY, *columns)

    return {
        "urine_first_day": of_day(["urineoutput"], "urineoutput"),
        "vent_settings": settings,
        "vent_durations": durations,
        "vent_first_day": of_day(["vent"]),
        "vitals_first_day": of_day(severity.VITAL_COLUMNS),
        "gcs_first_day": of_day(["mingcs", *severity.GCS_PARTS, "endotrachflag"]),
        "first_day": day,
        "oasis": c.stage("oasis", oasis),
    }


def _spec(c: Catalog, name: str, notes: str, stages: DataFrame, stage: str, icd: DataFrame):
    admissions, patients = c.table("admissions"), c.table("patients")
    adults = c.stage("adults", lambda: anemia.adults(admissions, patients))
    return L.ConditionSpec(
        name, stages, stage, read_note_labels(c.spark, notes), icd, admissions, adults
    )


def aki_spec(c: Catalog, notes: str, baseline: str = "median") -> L.ConditionSpec:
    """Kidney injury, staged against the chosen creatinine baseline."""

    def stages() -> DataFrame:
        labs, outputs, chart = c.table("labevents"), c.table("outputevents"), c.chart()
        creatinine = c.stage("creatinines", lambda: kidney.creatinines(labs), series=True)
        urine = c.stage("urine_volume", lambda: kidney.urine_volume(outputs), series=True)
        weights = c.stage(
            "patient_weights", lambda: kidney.patient_weights(chart, hot(chart)), series=True
        )
        rates = c.stage(
            "urine_stats",
            lambda: kidney.urine_stats(urine, weights, hot(urine.unionByName(weights, True))),
            series=True,
        )
        lab_heat = hot(creatinine)
        return kidney.aki_stages(
            kidney.creatinine_increase(creatinine, lab_heat),
            kidney.creatinine_baseline(creatinine, c.table("admissions"), baseline, hot=lab_heat),
            rates,
            lab_heat,
        )

    def hot(events: DataFrame):
        return measure_hot_keys(events, KEYS, "charttime")

    aki = c.stage("aki_stages", stages, series=True, baseline=baseline)
    c.stage("running_aki_stages", lambda: kidney.running_aki_stages(aki, hot(aki)), baseline=baseline)
    icd = kidney.acute_kidney_flag(c.table("diagnoses_icd"))
    return _spec(c, "aki", notes, aki, "aki_risk", icd)


def anemia_spec(c: Catalog, notes: str, chart_hgb: bool = False) -> L.ConditionSpec:
    """Anemia, from laboratory and, if wanted, charted hemoglobin."""
    diagnoses, ccs = c.table("diagnoses_icd"), c.ccs_single_level()

    def stages() -> DataFrame:
        admissions, patients = c.table("admissions"), c.table("patients")
        hgb = anemia.hgb_series(c.table("labevents"), c.chart() if chart_hgb else None)
        return anemia.anemia_severity(
            hgb,
            c.stage("ages", lambda: anemia.ages(admissions, patients)),
            c.stage("pregnancies", lambda: anemia.pregnancy_flag(diagnoses, ccs)),
            patients,
            measure_hot_keys(hgb, KEYS, "charttime"),
        )

    severities = c.stage("anemia_severity", stages, series=True, chart=chart_hgb)
    c.stage(
        "running_anemia_severity",
        lambda: anemia.running_anemia(
            severities, measure_hot_keys(severities, KEYS, "charttime")
        ),
        chart=chart_hgb,
    )
    icd = anemia.ccs_flag(diagnoses, ccs, C.ANEMIA_CCS)
    return _spec(c, "anemia", notes, severities, anemia.SEVERITY, icd)


def pressure_injury_spec(c: Catalog, notes: str) -> L.ConditionSpec:
    stages = c.stage(
        "pi_stages", lambda: pressure.pressure_injury_stages(c.chart()), series=True
    )
    c.stage(
        "running_pi_stages",
        lambda: pressure.running_pi_stages(stages, measure_hot_keys(stages, KEYS, "charttime")),
    )
    icd = anemia.ccs_flag(c.table("diagnoses_icd"), c.ccs_single_level(), C.PRESSURE_INJURY_CCS)
    return _spec(c, "pi", notes, stages, "pi_stage", icd)


# Names of the exported files per condition: with "ha" in front, what was acquired in hospital.
NAMES = {
    "aki": ("haaki", "aki", "stages", "noaki"),
    "anemia": ("haa", "anemia", "severities", "noa"),
    "pi": ("hapi", "pi", "stages", "nopi"),
}


def results_of(spec: L.ConditionSpec, acquired_controls: bool = False) -> dict[str, DataFrame]:
    """Every result of a condition by file name, all from one written table with a row per admission."""
    acquired, anyway, level, controls = NAMES[spec.name]
    found = pin(L.evidence(spec))
    labels, any_time = L.labels_from(found), L.labels_from(found, acquired=False)
    ordered = [*KEYS, "timestamp"]
    return {
        f"{acquired}_label_details": labels,
        f"{acquired}_label_dist": L.label_distribution(labels),
        f"{anyway}_{level}": L.onsets_from(found).orderBy(*ordered),
        f"{acquired}_{level}": L.onsets_from(found, acquired=True).orderBy(*ordered),
        f"{acquired}_positive_note_labels": L.positive_from(found, "note"),
        f"{acquired}_positive_table_labels": L.positive_from(found, "table"),
        f"{acquired}_positive_labels": L.positive_onsets_from(found),
        f"{anyway}_label_dist": L.label_distribution(any_time),
        f"{acquired}_hadms": L.case_cohort(labels),
        f"{controls}_hadms": L.control_cohort(labels if acquired_controls else any_time),
    }


def export_condition(
    spec: L.ConditionSpec, folder: str, single_file: bool = False, acquired_controls: bool = False
) -> list[str]:
    """Write every result of a condition as CSV with a header; returns the paths."""
    paths = []
    for name, result in results_of(spec, acquired_controls).items():
        paths.append(f"{folder.rstrip('/')}/{name}.csv")
        export_csv(result, paths[-1], single_file)
    return paths


def export_demographics(c: Catalog, path: str, single_file: bool = False) -> None:
    table = c.stage(
        "admission_demographics",
        lambda: demographics.admission_demographics(
            c.table("patients"),
            c.table("admissions"),
            c.table("icustays"),
            concept_tables(replace(c, recreate=False))["oasis"],
        ),
    )
    export_csv(table, path, single_file)
