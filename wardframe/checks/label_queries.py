"""Labels, onsets and cohorts for the three conditions."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import functions as F

from wardframe.checks import concept_queries as concepts, expected_values as V
from wardframe.checks.registry import STEPS, in_list, query
from wardframe.checks.role_views import Roles
from wardframe.functions import codes as C
from wardframe.plans import anemia, demographics, extract, kidney, labels as L
from wardframe.session import shared_folder
from wardframe.sources import csv

KEY = "subject_id, hadm_id"


def spec(r: Roles, condition: str) -> L.ConditionSpec:
    """``aki`` goes by the full staging, urine and creatinine, on one set of admissions; ``aki_creatinine``
    by creatinine alone."""
    stages, stage_col, flag = {
        "aki": (concepts.aki_stages, "aki_risk", kidney.acute_kidney_flag),
        "aki_creatinine": (concepts.aki_stages_creatinine, "aki_risk", kidney.acute_kidney_flag),
        "anemia": (
            concepts.anemia_severity,
            "anemia_severity",
            lambda d: anemia.ccs_flag(d, r.ccs, C.ANEMIA_CCS),
        ),
        "pi": (
            concepts.pressure_injury_stages,
            "pi_stage",
            lambda d: anemia.ccs_flag(d, r.ccs, C.PRESSURE_INJURY_CCS),
        ),
    }[condition]
    fast = condition == "aki"
    admissions = r.fast_admissions if fast else r.admissions
    return L.ConditionSpec(
        name=condition,
        stages=stages(r),
        stage_col=stage_col,
        notes=r.fast_notes if fast else r.notes,
        icd_flag=flag(r.fast_diagnoses if fast else r.diagnoses),
        admissions=admissions,
        adults=anemia.adults(admissions, r.patients),
    )


for _condition, _table in (("aki", "fx_fast_diagnoses"), ("aki_creatinine", "fx_diagnoses")):
    STEPS[f"st_icd_{_condition}"] = f"""
    SELECT subject_id, hadm_id, bool_or(icd9_code IN ('5845', '5846', '5847', '5848', '5849')) AS label
    FROM {_table} GROUP BY subject_id, hadm_id
    HAVING NOT bool_or(icd9_code IN ({in_list(V.CHRONIC_KIDNEY)}))"""
for _condition, _groups in (("anemia", [59, 60]), ("pi", [199])):
    STEPS[f"st_icd_{_condition}"] = f"""
    SELECT subject_id, hadm_id, bool_or(ccs_id IN ({in_list(_groups)})) AS label
    FROM fx_diagnoses JOIN fx_ccs USING (icd9_code) GROUP BY subject_id, hadm_id"""

STEPS["st_fast_adults"] = """
    SELECT subject_id, hadm_id FROM fx_fast_admissions JOIN fx_patients USING (subject_id)
    WHERE admittime >= dob + INTERVAL 15 YEAR"""
for _notes, _stays in (("notes", "admissions"), ("fast_notes", "fast_admissions")):
    STEPS[f"st_poa_{_notes}"] = f"""
    SELECT subject_id, hadm_id FROM fx_{_notes} JOIN fx_{_stays} USING (subject_id, hadm_id)
    WHERE label GROUP BY subject_id, hadm_id
    HAVING epoch_us(min("timestamp")) - epoch_us(min(admittime)) <= 48 * 3600000000"""
    STEPS[f"st_acquired_{_notes}"] = f"SELECT * FROM fx_{_notes} ANTI JOIN st_poa_{_notes} USING (subject_id, hadm_id)"


def note_sql(source: str) -> str:
    return f"SELECT {KEY}, bool_or(label) AS label FROM {source} GROUP BY {KEY}"


def table_sql(source: str) -> str:
    return f"SELECT {KEY}, max(stage) >= 1 AS label FROM {source} GROUP BY {KEY}"


def onset_sql(source: str) -> str:
    return f"""SELECT {KEY}, min(charttime) AS "timestamp", stage AS label FROM {source}
    WHERE stage >= 1 GROUP BY {KEY}, stage"""


def labels_sql(notes: str, stages: str, icd: str, adults: str) -> str:
    return f"""
    SELECT a.subject_id, a.hadm_id, coalesce(n.label, false) AS note_dx,
      coalesce(t.label, false) AS table_dx, coalesce(i.label, false) AS icd_dx
    FROM {adults} a
      LEFT JOIN ({note_sql(notes)}) n ON a.subject_id = n.subject_id AND a.hadm_id = n.hadm_id
      LEFT JOIN ({table_sql(stages)}) t ON a.subject_id = t.subject_id AND a.hadm_id = t.hadm_id
      LEFT JOIN {icd} i ON a.subject_id = i.subject_id AND a.hadm_id = i.hadm_id
    WHERE a.hadm_id IS NOT NULL"""


def distribution_sql(labels: str) -> str:
    return f"""SELECT note_dx, table_dx, icd_dx, count(DISTINCT hadm_id) AS num_hadms,
      round(CAST(count(DISTINCT hadm_id) AS DOUBLE) / (SELECT count(*) FROM {labels}), 6)
        AS percent
    FROM {labels} GROUP BY note_dx, table_dx, icd_dx"""


for _c in ("aki", "aki_creatinine", "anemia", "pi"):
    _of = "fast_" if _c == "aki" else ""
    _notes, _adults = f"{_of}notes", f"st_{_of}adults"
    STEPS[f"st_poa_{_c}"] = f"""
    SELECT DISTINCT subject_id, hadm_id
    FROM st_running_{_c} JOIN fx_{_of}admissions USING (subject_id, hadm_id)
    WHERE stage >= 1 AND charttime <= admittime + INTERVAL 48 HOUR"""
    STEPS[f"st_acquired_{_c}"] = (
        f"SELECT * FROM st_running_{_c} ANTI JOIN st_poa_{_c} USING (subject_id, hadm_id)"
    )
    STEPS[f"st_labels_{_c}"] = labels_sql(f"st_acquired_{_notes}", f"st_acquired_{_c}", f"st_icd_{_c}", _adults)
    STEPS[f"st_any_labels_{_c}"] = labels_sql(f"fx_{_notes}", f"st_running_{_c}", f"st_icd_{_c}", _adults)
    STEPS[f"st_onset_notes_{_c}"] = f"""
    SELECT {KEY}, min("timestamp") AS "timestamp" FROM st_acquired_{_notes}
    WHERE label AND hadm_id IS NOT NULL GROUP BY {KEY}"""
    STEPS[f"st_onset_table_{_c}"] = f"""
    SELECT {KEY}, min(charttime) AS "timestamp" FROM st_acquired_{_c}
    WHERE stage >= 1 AND hadm_id IS NOT NULL GROUP BY {KEY}"""

    def _register(key: str, sql: str, job, condition: str = _c) -> None:
        query(f"{key}_{condition}", sql, staged=True)(lambda r: job(spec(r, condition)))

    _register("l1_note_evidence", note_sql(f"st_acquired_{_notes}"), L.note_evidence)
    _register(
        "l1_note_evidence_any_time", note_sql(f"fx_{_notes}"), partial(L.note_evidence, acquired=False)
    )
    _register("l2_table_evidence", table_sql(f"st_acquired_{_c}"), L.table_evidence)
    _register(
        "l2_table_evidence_any_time",
        table_sql(f"st_running_{_c}"),
        partial(L.table_evidence, acquired=False),
    )
    _register("l3_icd_evidence", f"SELECT * FROM st_icd_{_c}", L.icd_evidence)
    _register("l4_merge_labels", f"SELECT * FROM st_labels_{_c}", L.labels_of)
    _register(
        "l4_merge_labels_any_time",
        f"SELECT * FROM st_any_labels_{_c}",
        partial(L.labels_of, acquired=False),
    )
    _register(
        "l5_label_distribution",
        distribution_sql(f"st_labels_{_c}"),
        lambda s: L.label_distribution(L.labels_of(s)),
    )
    _register(
        "l5_label_distribution_any_time",
        distribution_sql(f"st_any_labels_{_c}"),
        lambda s: L.label_distribution(L.labels_of(s, acquired=False)),
    )
    _register("l6_stage_onsets", onset_sql(f"st_running_{_c}"), L.stage_onsets)
    _register("l7_acquired_stage_onsets", onset_sql(f"st_acquired_{_c}"), L.acquired_stage_onsets)
    _register(
        "l8_positive_note_onsets", f"SELECT * FROM st_onset_notes_{_c}", L.positive_note_onsets
    )
    _register(
        "l9_positive_table_onsets", f"SELECT * FROM st_onset_table_{_c}", L.positive_table_onsets
    )
    _register(
        "l10_positive_onsets",
        f"""SELECT {KEY}, min("timestamp") AS "timestamp", 1 AS label
    FROM {_adults} JOIN (SELECT * FROM st_onset_notes_{_c}
      UNION ALL SELECT * FROM st_onset_table_{_c}) USING ({KEY})
    WHERE "timestamp" IS NOT NULL GROUP BY {KEY}""",
        L.positive_onsets,
    )
    _register(
        "l11_case_cohort",
        f"SELECT {KEY} FROM st_labels_{_c} WHERE note_dx OR table_dx",
        lambda s: L.case_cohort(L.labels_of(s)),
    )
    _register(
        "l12_control_cohort",
        f"SELECT {KEY} FROM st_any_labels_{_c} WHERE NOT note_dx AND NOT table_dx AND NOT icd_dx",
        lambda s: L.control_cohort(L.labels_of(s, acquired=False)),
    )
    _register(
        "l12_control_cohort_acquired",
        f"SELECT {KEY} FROM st_labels_{_c} WHERE NOT note_dx AND NOT table_dx AND NOT icd_dx",
        lambda s: L.control_cohort(L.labels_of(s)),
    )


for _c in ("aki", "anemia", "pi"):
    _of = "fast_" if _c == "aki" else ""

    def _primary(r: Roles, condition: str = _c):
        cases = L.case_cohort(L.labels_of(spec(r, condition)))
        diagnoses = r.fast_diagnoses if condition == "aki" else r.diagnoses
        return demographics.ccs_primary_distribution(diagnoses, r.ccs, cases)

    query(
        f"d2_ccs_primary_distribution_{_c}_cases",
        f"""SELECT ccs_id, ccs_name, count(*) AS n,
          round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS percent
        FROM fx_{_of}diagnoses JOIN fx_ccs USING (icd9_code)
          SEMI JOIN (SELECT * FROM st_labels_{_c} WHERE note_dx OR table_dx) USING ({KEY})
        WHERE seq_num = 1 GROUP BY ccs_id, ccs_name""",
        staged=True,
    )(_primary)


# --- the exported files, read back --------------------------------------------------------------

EXPORTED = {  # columns of a file as it is written
    "labels": "subject_id bigint, hadm_id bigint, note_dx boolean, table_dx boolean, icd_dx boolean",
    "distribution": "note_dx boolean, table_dx boolean, icd_dx boolean, num_hadms bigint, percent double",
    "onsets": "subject_id bigint, hadm_id bigint, timestamp timestamp_ntz, label int",
    "times": "subject_id bigint, hadm_id bigint, timestamp timestamp_ntz",
    "admissions": "subject_id bigint, hadm_id bigint",
}


def _files(condition: str) -> dict[str, tuple[str, str]]:
    """Kind and SQL of each of a condition's ten files."""
    acquired, anyway, level, controls = extract.NAMES[condition]
    of = "fast_" if condition == "aki" else ""
    labels, any_time = f"st_labels_{condition}", f"st_any_labels_{condition}"
    positive = f"""SELECT {KEY}, min("timestamp") AS "timestamp", 1 AS label FROM st_{of}adults
      JOIN (SELECT * FROM st_onset_notes_{condition} UNION ALL SELECT * FROM st_onset_table_{condition}) USING ({KEY})
      WHERE "timestamp" IS NOT NULL GROUP BY {KEY}"""
    return {
        f"{acquired}_label_details": ("labels", f"SELECT * FROM {labels}"),
        f"{acquired}_label_dist": ("distribution", distribution_sql(labels)),
        f"{anyway}_{level}": ("onsets", onset_sql(f"st_running_{condition}") + " HAVING subject_id + hadm_id IS NOT NULL"),
        f"{acquired}_{level}": ("onsets", onset_sql(f"st_acquired_{condition}") + " HAVING subject_id + hadm_id IS NOT NULL"),
        f"{acquired}_positive_note_labels": ("times", f"SELECT * FROM st_onset_notes_{condition}"),
        f"{acquired}_positive_table_labels": ("times", f"SELECT * FROM st_onset_table_{condition}"),
        f"{acquired}_positive_labels": ("onsets", positive),
        f"{anyway}_label_dist": ("distribution", distribution_sql(any_time)),
        f"{acquired}_hadms": ("admissions", f"SELECT {KEY} FROM {labels} WHERE note_dx OR table_dx"),
        f"{controls}_hadms": ("admissions", f"SELECT {KEY} FROM {any_time} WHERE NOT (note_dx OR table_dx OR icd_dx)"),
    }


def _exported(r: Roles, condition: str):
    files, folder = _files(condition), shared_folder(r.spark)
    written = extract.export_condition(spec(r, condition), folder)
    assert [p.rsplit("/", 1)[1].removesuffix(".csv") for p in written] == list(files)
    read = [
        csv.read_table(r.spark, path, EXPORTED[kind]).withColumn("file", F.lit(name))
        for path, (name, (kind, _)) in zip(written, files.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


for _c in ("aki", "anemia", "pi"):
    query(
        f"s6_export_{_c}",
        " UNION ALL BY NAME ".join(
            f"SELECT *, '{name}' AS file FROM ({sql})" for name, (_, sql) in _files(_c).items()
        ),
        staged=True,
    )(partial(_exported, condition=_c))
