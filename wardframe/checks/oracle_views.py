"""The role views of ``role_views.py`` as SQL, and shared steps of the expected results."""

from __future__ import annotations

import re

from wardframe.checks.expected_values import PRESSURE_VALUES

FAST = (
    "TIMESTAMP '2024-01-01' + to_microseconds(CAST((epoch_us(charttime) - "
    "epoch_us(TIMESTAMP '2024-01-01')) // 24 AS BIGINT)) AS charttime"
)
CCS_ID = (
    "CASE WHEN p_size <= 2 THEN 58 + p_size WHEN p_size <= 4 THEN 199 "
    "WHEN p_size <= 12 THEN 176 + p_size ELSE p_size END"
)

VIEWS = {
    "fx_events": """
        SELECT event_id AS row_id, user_id AS subject_id,
          user_id * 10 + date_diff('day', TIMESTAMP '2024-01-01', ts) // 10 AS hadm_id,
          user_id * 10 + date_diff('day', TIMESTAMP '2024-01-01', ts) // 10 + 1000000
            AS icustay_id,
          ts AS charttime, event_type, value
        FROM events""",
    "fx_admissions": """
        SELECT DISTINCT subject_id, hadm_id,
          TIMESTAMP '2024-01-01' + (hadm_id % 10) * INTERVAL 10 DAY AS admittime,
          TIMESTAMP '2024-01-01' + (hadm_id % 10) * INTERVAL 10 DAY + INTERVAL 9 DAY AS dischtime,
          CASE WHEN hadm_id % 11 = 0 THEN TIMESTAMP '2024-01-01'
            + (hadm_id % 10) * INTERVAL 10 DAY + INTERVAL 3 DAY END AS deathtime,
          CASE hadm_id % 3 WHEN 0 THEN 'ELECTIVE' WHEN 1 THEN 'EMERGENCY' ELSE 'URGENT' END
            AS admission_type,
          CASE subject_id % 6 WHEN 0 THEN 'ASIAN - CHINESE' WHEN 1 THEN 'BLACK/AFRICAN'
            WHEN 2 THEN 'SOUTH AMERICAN' WHEN 3 THEN 'WHITE' WHEN 4 THEN 'UNABLE TO OBTAIN'
            ELSE 'PORTUGUESE' END AS ethnicity,
          CASE subject_id % 4 WHEN 0 THEN 'CLINIC REFERRAL/PREMATURE'
            WHEN 1 THEN 'PHYS REFERRAL/NORMAL DELI' WHEN 2 THEN 'TRANSFER FROM HOSP/EXTRAM'
            ELSE 'EMERGENCY ROOM ADMIT' END AS admission_location,
          CASE WHEN hadm_id % 11 = 0 THEN 'DEAD/EXPIRED' ELSE 'HOME' END AS discharge_location,
          CASE subject_id % 3 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Private' ELSE 'Self Pay' END
            AS insurance,
          CASE WHEN hadm_id % 11 = 0 THEN 1 ELSE 0 END AS hospital_expire_flag
        FROM fx_events""",
    "fx_icustays": """
        SELECT hadm_id AS row_id, subject_id, hadm_id, hadm_id + 1000000 AS icustay_id,
          CASE hadm_id % 2 WHEN 0 THEN 'MICU' ELSE 'SICU' END AS first_careunit,
          admittime + (hadm_id % 5) * INTERVAL 6 HOUR AS intime,
          admittime + INTERVAL 5 DAY AS outtime
        FROM fx_admissions""",
    "fx_patients": """
        SELECT c_custkey AS subject_id,
          CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
          CAST(DATE '1934-01-01' + CAST((c_custkey * 7919) % 32800 AS INT) AS TIMESTAMP) AS dob
        FROM customer WHERE c_custkey IN (SELECT user_id FROM events)""",
    "fx_creatinine": """
        SELECT row_id, subject_id, hadm_id, charttime, round(0.4 + value / 50, 4) AS creatinine
        FROM fx_events WHERE event_type = 'view'""",
    "fx_hgb": """
        SELECT row_id, subject_id, hadm_id, charttime, round(5 + value / 10, 3) AS hgb
        FROM fx_events WHERE event_type = 'purchase'""",
    "fx_labevents": """
        SELECT row_id, subject_id, CASE WHEN row_id % 37 <> 0 THEN hadm_id END AS hadm_id,
          charttime,
          CASE event_type WHEN 'view' THEN 50912
            WHEN 'purchase' THEN CASE row_id % 2 WHEN 0 THEN 50811 ELSE 51222 END
            ELSE 50809 END AS itemid,
          CASE WHEN row_id % 41 = 0 THEN NULL
            WHEN event_type = 'view' THEN round(0.4 + value / 50, 4)
            WHEN row_id % 43 = 0 THEN 0 ELSE round(5 + value / 10, 3) END AS valuenum
        FROM fx_events""",
    "fx_chart_hgb": """
        SELECT row_id, subject_id, hadm_id, charttime,
          CASE row_id % 2 WHEN 0 THEN 814 ELSE 220228 END AS itemid,
          round(value / 10, 3) AS valuenum, CASE WHEN row_id % 50 = 0 THEN 1 END AS error
        FROM fx_events WHERE event_type IN ('purchase', 'click')""",
    "fx_vitals": """
        SELECT row_id, subject_id, hadm_id, icustay_id, charttime,
          CASE row_id % 9 WHEN 0 THEN 220045 WHEN 1 THEN 220050 WHEN 2 THEN 220051
            WHEN 3 THEN 220052 WHEN 4 THEN 220210 WHEN 5 THEN 223761 WHEN 6 THEN 223762
            WHEN 7 THEN 220277 ELSE 220621 END AS itemid,
          value AS valuenum, CASE WHEN row_id % 50 = 0 THEN 1 END AS error
        FROM fx_events""",
    "fx_gcs": """
        SELECT row_id, subject_id, hadm_id, icustay_id, date_trunc('hour', charttime) AS charttime,
          CASE row_id % 3 WHEN 0 THEN 454 WHEN 1 THEN 223900 ELSE 184 END AS itemid,
          CASE WHEN row_id % 3 = 1 AND row_id % 7 = 0 THEN 'No Response-ETT' ELSE 'ok' END AS value,
          CAST(1 + row_id % (CASE row_id % 3 WHEN 0 THEN 6 WHEN 1 THEN 5 ELSE 4 END) AS DOUBLE)
            AS valuenum,
          CAST(NULL AS INT) AS error
        FROM fx_events""",
    "fx_vent": """
        SELECT icustay_id, charttime,
          max(CASE WHEN event_type IN ('click', 'error') THEN 1 ELSE 0 END) AS mechvent,
          max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS oxygentherapy,
          max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS extubated,
          0 AS selfextubated
        FROM fx_events GROUP BY icustay_id, charttime""",
    "fx_vent_chart": """
        SELECT row_id, icustay_id, date_trunc('hour', charttime) AS charttime,
          CASE row_id % 10 WHEN 0 THEN 720 WHEN 1 THEN 223849 WHEN 2 THEN 467 WHEN 3 THEN 226732
            WHEN 4 THEN 640 WHEN 5 THEN 445 WHEN 6 THEN 459 WHEN 7 THEN 470 WHEN 8 THEN 223848
            ELSE 3459 END AS itemid,
          CASE WHEN row_id % 31 = 0 THEN NULL ELSE
            CASE row_id % 10
            WHEN 0 THEN CASE WHEN row_id % 3 = 0 THEN 'Other/Remarks' ELSE 'Servo' END
            WHEN 2 THEN CASE row_id % 3 WHEN 0 THEN 'Ventilator' WHEN 1 THEN 'Cannula'
              ELSE 'None' END
            WHEN 3 THEN CASE WHEN row_id % 3 = 0 THEN 'Nasal cannula' ELSE 'Other' END
            WHEN 4 THEN CASE row_id % 3 WHEN 0 THEN 'Extubated' WHEN 1 THEN 'Self Extubation'
              ELSE 'Intubated' END
            WHEN 8 THEN CASE WHEN row_id % 3 = 0 THEN 'Other' ELSE 'Drager' END
            ELSE '5' END END AS value,
          CASE WHEN row_id % 50 = 0 THEN 1 END AS error
        FROM fx_events""",
    "fx_procedures": """
        SELECT row_id, icustay_id, date_trunc('hour', charttime) AS starttime,
          CASE row_id % 4 WHEN 0 THEN 227194 WHEN 1 THEN 225468 WHEN 2 THEN 225477 ELSE 225401 END
            AS itemid
        FROM fx_events WHERE event_type = 'purchase'""",
    "fx_urine": f"""
        SELECT row_id, subject_id, subject_id AS hadm_id, 40055 AS itemid, {FAST},
          CASE WHEN subject_id % 5 = 4 THEN 200 + value ELSE value / 20 END AS value,
          CASE WHEN row_id % 97 = 0 THEN 1 END AS iserror
        FROM fx_events""",
    "fx_weights": f"""
        SELECT row_id, subject_id, subject_id AS hadm_id,
          CASE row_id % 3 WHEN 0 THEN 762 WHEN 1 THEN 3581 ELSE 3582 END AS itemid, {FAST},
          CASE row_id % 3 WHEN 0 THEN 50 + value / 10 WHEN 1 THEN 110 + value / 5
            ELSE 1760 + value * 3 END AS valuenum,
          CASE WHEN row_id % 20 = 0 THEN NULL WHEN row_id % 21 = 0 THEN 'cm' ELSE 'kg' END
            AS valueuom,
          CASE WHEN row_id % 50 = 0 THEN 1 END AS error
        FROM fx_events WHERE event_type = 'signup'""",
    "fx_fast_admissions": """
        SELECT DISTINCT subject_id, hadm_id,
          TIMESTAMP '2024-01-01' - (subject_id % 4 * 20) * INTERVAL 1 HOUR AS admittime FROM fx_urine""",
    "fx_fast_labevents": f"""
        SELECT row_id, subject_id, CASE WHEN hadm_id IS NOT NULL THEN subject_id END AS hadm_id, {FAST},
          itemid, CASE WHEN subject_id % 5 = 4 THEN 0.8::DOUBLE + valuenum / 100 ELSE valuenum END AS valuenum
        FROM fx_labevents
        UNION ALL
        SELECT -subject_id, subject_id, hadm_id, admittime + INTERVAL 1 HOUR, 50912,
          CASE WHEN subject_id % 5 = 4 THEN 0.8::DOUBLE ELSE (6 + subject_id % 7) / 10::DOUBLE END
        FROM fx_fast_admissions""",
    "fx_outputs": """
        SELECT row_id, subject_id, hadm_id, icustay_id, charttime,
          CASE WHEN row_id % 10 = 0 THEN 227488 ELSE 226559 END AS itemid, value * 20 AS value
        FROM fx_events""",
    "fx_notes": """
        SELECT subject_id, hadm_id, charttime AS "timestamp", value > 60 AS label
        FROM fx_events WHERE event_type = 'error'""",
    "fx_diagnoses": """
        SELECT row_id, subject_id, hadm_id, CAST(1 + row_id % 5 AS INT) AS seq_num,
          CASE WHEN row_id % 40 BETWEEN 1 AND 5 THEN '584' || CAST(4 + row_id % 40 AS VARCHAR)
            WHEN row_id % 40 = 7 THEN '5856' WHEN row_id % 40 = 8 THEN 'V420'
            ELSE CAST(row_id % 200 AS VARCHAR) END AS icd9_code
        FROM fx_events WHERE event_type = 'signup'""",
    "fx_fast_notes": f"""
        SELECT subject_id, hadm_id, charttime AS "timestamp", label FROM (
          SELECT subject_id, subject_id AS hadm_id, {FAST},
            value > 60 AND NOT subject_id % 5 = 4 AS label
          FROM fx_events WHERE event_type = 'error')""",
    "fx_fast_diagnoses": "SELECT * REPLACE (subject_id AS hadm_id) FROM fx_diagnoses",
    "fx_ccs": f"""
        SELECT {CCS_ID} AS ccs_id, 'group ' || CAST({CCS_ID} AS VARCHAR) AS ccs_name,
          CAST(p_partkey AS VARCHAR) AS icd9_code
        FROM part""",
    "fx_services": """
        SELECT row_id, subject_id, hadm_id, charttime AS transfertime,
          CASE WHEN value > 60 THEN 'TSURG' WHEN value > 30 THEN 'ORTHO' ELSE 'MED' END
            AS curr_service
        FROM fx_events WHERE event_type = 'click'""",
    "fx_pi": f"""
        SELECT row_id, subject_id, hadm_id, charttime,
          CASE row_id % 7 WHEN 0 THEN 551 WHEN 1 THEN 227618 WHEN 2 THEN 999 ELSE 224631 END AS itemid,
          coalesce([{', '.join("'" + t + "'" for t in PRESSURE_VALUES)}][1 + row_id % 16], 'Healed') AS value,
          CASE WHEN row_id % 50 = 0 THEN 1 END AS error
        FROM fx_events WHERE event_type = 'error'""",
}


def with_views(body: str, steps: dict[str, str]) -> str:
    """``body`` with a WITH clause of the views and steps it reads, in order of definition."""
    known = {**VIEWS, **steps}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(known[name])

    visit(body)
    ctes = ", ".join(f"{n} AS ({known[n].strip()})" for n in known if n in needed)
    return f"WITH {ctes} {body.strip()}" if ctes else body.strip()
