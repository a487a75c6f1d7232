"""Labels, onsets and cohorts of a hospital-acquired condition, from three kinds of evidence.

One set of functions serves every condition; a ``ConditionSpec`` holds what differs. The raw stage
series is enough everywhere: "the running maximum reaches 1" and "a stage reaches 1" happen at the
same time, so no job here sorts or windows the events. Each evidence is one map-side combined
aggregate to a row per admission (or per admission and level) before it is joined to anything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from wardframe.operators.cohort import KEYS, first_onset, keep_acquired, on_admission
from wardframe.operators.skew import not_null


@dataclass(frozen=True)
class ConditionSpec:
    name: str
    stages: DataFrame  # subject_id, hadm_id, charttime, <stage_col>
    stage_col: str
    notes: DataFrame  # subject_id, hadm_id, timestamp, label
    icd_flag: DataFrame  # subject_id, hadm_id, label
    admissions: DataFrame  # subject_id, hadm_id, admittime
    adults: DataFrame  # subject_id, hadm_id
    poa_hours: int = 48
    levels: int = 4  # highest stage


def _notes_per_admission(spec: ConditionSpec) -> DataFrame:
    return (
        spec.notes.where(not_null(KEYS))
        .groupBy(*KEYS)
        .agg(
            F.bool_or("label").alias("label"),
            F.min(F.when(F.col("label"), F.col("timestamp"))).alias("first_positive"),
        )
    )


def _stages_per_admission(spec: ConditionSpec) -> DataFrame:
    stage = F.col(spec.stage_col)
    return (
        spec.stages.where(not_null([*KEYS, "charttime", spec.stage_col]))
        .groupBy(*KEYS)
        .agg(
            (F.max(stage) >= 1).alias("label"),
            F.min(F.when(stage >= 1, F.col("charttime"))).alias("first_positive"),
        )
    )


def _acquired(spec: ConditionSpec, per_admission: DataFrame) -> DataFrame:
    return keep_acquired(per_admission, "first_positive", spec.admissions, spec.poa_hours)


def note_evidence(spec: ConditionSpec, acquired: bool = True) -> DataFrame:
    notes = _notes_per_admission(spec)
    return (_acquired(spec, notes) if acquired else notes).select(*KEYS, "label")


def table_evidence(spec: ConditionSpec, acquired: bool = True) -> DataFrame:
    stages = _stages_per_admission(spec)
    return (_acquired(spec, stages) if acquired else stages).select(*KEYS, "label")


def icd_evidence(spec: ConditionSpec) -> DataFrame:
    return spec.icd_flag.select(*KEYS, "label")


def merge_labels(
    adults: DataFrame, note: DataFrame, table: DataFrame, icd: DataFrame
) -> DataFrame:
    """One row per adult admission; missing evidence is false."""
    labels = adults.where(F.col("hadm_id").isNotNull()).select(*KEYS).distinct()
    for name, evidence in (("note_dx", note), ("table_dx", table), ("icd_dx", icd)):
        evidence = evidence.select(*KEYS, F.col("label").alias(name))
        labels = labels.join(evidence, KEYS, "left")
    return labels.select(
        *KEYS, *[F.coalesce(n, F.lit(False)).alias(n) for n in ("note_dx", "table_dx", "icd_dx")]
    )


def labels_of(spec: ConditionSpec, acquired: bool = True) -> DataFrame:
    return merge_labels(
        spec.adults,
        note_evidence(spec, acquired),
        table_evidence(spec, acquired),
        icd_evidence(spec),
    )


def label_distribution(labels: DataFrame) -> DataFrame:
    """Admissions per combination of evidence, and their share of all rows (at most 8 rows)."""
    counted = labels.groupBy("note_dx", "table_dx", "icd_dx").agg(
        F.countDistinct("hadm_id").alias("num_hadms"), F.count("*").alias("_rows")
    )
    total = F.sum("_rows").over(W.partitionBy()).cast("double")
    return (
        counted.withColumn("percent", F.col("num_hadms").cast("double") / total)
        .drop("_rows")
        .orderBy(F.desc("icd_dx"), F.desc("table_dx"), F.desc("note_dx"))
    )


def stage_onsets(spec: ConditionSpec) -> DataFrame:
    stages = spec.stages.where(not_null(KEYS))
    return first_onset(stages, KEYS, "charttime", spec.stage_col, running=False)


def acquired_stage_onsets(spec: ConditionSpec) -> DataFrame:
    """Onsets of admissions whose first onset is not on admission."""
    onsets = stage_onsets(spec)
    first = F.min("timestamp").over(W.partitionBy(*KEYS))  # a row per level: four at most
    return _acquired(spec, onsets.withColumn("first_positive", first)).drop("first_positive")


def _positive_onsets_of(spec: ConditionSpec, per_admission: DataFrame) -> DataFrame:
    onset = F.col("first_positive").alias("timestamp")
    return _acquired(spec, per_admission.where("label")).select(*KEYS, onset)


def positive_note_onsets(spec: ConditionSpec) -> DataFrame:
    return _positive_onsets_of(spec, _notes_per_admission(spec))


def positive_table_onsets(spec: ConditionSpec) -> DataFrame:
    return _positive_onsets_of(spec, _stages_per_admission(spec))


def positive_onsets(spec: ConditionSpec) -> DataFrame:
    """Earliest positive evidence per adult admission."""
    either = positive_note_onsets(spec).unionByName(positive_table_onsets(spec))
    return (
        either.where(F.col("timestamp").isNotNull())
        .groupBy(*KEYS)
        .agg(F.min("timestamp").alias("timestamp"))
        .join(spec.adults.select(*KEYS).distinct(), KEYS)
        .select(*KEYS, "timestamp", F.lit(1).alias("label"))
    )


def case_cohort(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("note_dx") | F.col("table_dx")).select(*KEYS)


def control_cohort(labels: DataFrame) -> DataFrame:
    """Admissions without evidence; give any-time labels, or present-on-admission cases slip in."""
    return labels.where(~F.col("note_dx") & ~F.col("table_dx") & ~F.col("icd_dx")).select(*KEYS)


# --- all results from one table -----------------------------------------------------------------


def evidence(spec: ConditionSpec) -> DataFrame:
    """One row per admission with everything its results need, each source aggregated once.

    Columns: ``adult``, ``icd``; ``note`` and ``note_first``, ``table`` and ``table_first`` (any positive, and the first);
    ``note_early`` and ``table_early`` (present on admission); and ``onset_1`` up to ``onset_<levels>``, when a stage was
    first noted. Every adult admission has a row, others if they have any evidence.
    """
    stage, t = F.col(spec.stage_col), F.col("charttime")
    beyond = F.raise_error(F.lit(f"{spec.name} has stages above {spec.levels}")).cast("boolean")
    notes = _notes_per_admission(spec).select(
        *KEYS, F.col("label").alias("note"), F.col("first_positive").alias("note_first")
    )
    stages = (
        spec.stages.where(not_null([*KEYS, "charttime", spec.stage_col]))
        .groupBy(*KEYS)
        .agg(
            F.when(F.max(stage) <= spec.levels, F.max(stage) >= 1).otherwise(beyond).alias("table"),
            F.min(F.when(stage >= 1, t)).alias("table_first"),
            *[F.min(F.when(stage == k, t)).alias(f"onset_{k}") for k in range(1, spec.levels + 1)],
        )
    )
    icd = spec.icd_flag.where(not_null(KEYS)).select(*KEYS, F.col("label").alias("icd"))
    adults = spec.adults.where(not_null(KEYS)).select(*KEYS).distinct().withColumn("adult", F.lit(True))
    found = adults
    for part in (notes, stages, icd):
        found = found.join(part, KEYS, "full")
    found = found.join(spec.admissions.select(*KEYS, "admittime"), KEYS, "left")
    for kind in ("note", "table"):
        early = on_admission(f"{kind}_first", spec.poa_hours)
        found = found.withColumn(f"{kind}_early", F.coalesce(early, F.lit(False)))
    return found.withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("adult", "note", "table", "icd")}
    ).drop("admittime")


def labels_from(found: DataFrame, acquired: bool = True) -> DataFrame:
    """``labels_of`` from the evidence table."""

    def dx(kind: str):
        counts = F.col(kind) & ~F.col(f"{kind}_early") if acquired else F.col(kind)
        return counts.alias(f"{kind}_dx")

    return found.where("adult").select(*KEYS, dx("note"), dx("table"), F.col("icd").alias("icd_dx"))


def onsets_from(found: DataFrame, acquired: bool = False) -> DataFrame:
    """``stage_onsets``, or ``acquired_stage_onsets``, from the evidence table: a level counts if it is
    reached before any higher one."""
    levels = sorted(int(c.removeprefix("onset_")) for c in found.columns if c.startswith("onset_"))
    reached = []
    for k in levels:
        t, higher = F.col(f"onset_{k}"), [f"onset_{j}" for j in levels if j > k]
        before = F.least(*higher) if len(higher) > 1 else F.col(higher[0]) if higher else None
        counts = F.lit(True) if before is None else before.isNull() | (t < before)
        reached.append(F.struct(F.when(counts, t).alias("timestamp"), F.lit(k).alias("label")))
    rows = found.where(~F.col("table_early")) if acquired else found
    onsets = rows.select(*KEYS, F.inline(F.array(*reached)))
    return onsets.where(F.col("timestamp").isNotNull())


def positive_from(found: DataFrame, kind: str) -> DataFrame:
    """``positive_note_onsets`` (``note``) or ``positive_table_onsets`` (``table``) from the evidence table."""
    rows = found.where(F.col(kind) & ~F.col(f"{kind}_early"))
    return rows.select(*KEYS, F.col(f"{kind}_first").alias("timestamp"))


def positive_onsets_from(found: DataFrame) -> DataFrame:
    """``positive_onsets`` from the evidence table."""
    first = F.least(
        *[F.when(F.col(k) & ~F.col(f"{k}_early"), F.col(f"{k}_first")) for k in ("note", "table")]
    )
    rows = found.where("adult").select(*KEYS, first.alias("timestamp"), F.lit(1).alias("label"))
    return rows.where(F.col("timestamp").isNotNull())
