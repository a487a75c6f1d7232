"""Rows for all 26 clinical tables, from the events, as SQL expressions that both engines read alike."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from wardframe.checks.role_views import Roles
from wardframe.sources import schemas

#: Which events stand for the rows of a table; a table that loses some of them fails its audit.
EVENTS_OF = {
    "admissions": "event_type = 'signup'", "callout": "event_type = 'signup'", "caregivers": "event_type = 'signup'",
    "chartevents": "event_type IN ('view', 'click')", "cptevents": "event_type = 'error'",
    "d_cpt": "event_type = 'signup'", "d_icd_diagnoses": "event_type = 'signup'",
    "d_icd_procedures": "event_type = 'signup'", "d_items": "event_type = 'error'", "d_labitems": "event_type = 'signup'",
    "datetimeevents": "event_type = 'click'", "diagnoses_icd": "event_type = 'signup'", "drgcodes": "event_type = 'error'",
    "icustays": "event_type = 'signup'", "inputevents_cv": "event_type = 'view'", "inputevents_mv": "event_type = 'click'",
    "labevents": "event_type = 'purchase'", "microbiologyevents": "event_type = 'error'",
    "noteevents": "event_type = 'purchase'", "outputevents": "event_type = 'view'", "patients": "event_type = 'signup'",
    "prescriptions": "event_type = 'click'", "procedureevents_mv": "event_type = 'purchase'",
    "procedures_icd": "event_type = 'error'", "services": "event_type = 'signup'", "transfers": "event_type = 'error'",
}
LOSSES = {"callout": 7, "d_items": 3, "microbiologyevents": 2, "noteevents": 5, "transfers": 11}  # every n-th event
UNSET = {"callout": "createtime", "services": "transfertime", "datetimeevents": "cgid"}  # required, but at times NULL

_BY_TYPE = {
    "int": "{n} % 9000", "smallint": "{n} % 90", "double": "value", "timestamp_ntz": "charttime",
    "string": "'text, ' || ({n} % 50)",
}


class Field(NamedTuple):
    name: str
    kind: str
    nullable: bool


def fields_of(table: str) -> list[Field]:
    """The declared columns, without a session to parse them."""
    parts = [part.split() for part in schemas.CLINICAL[table].split(",")]
    return [Field(p[0], p[1], p[2:] != ["not", "null"]) for p in parts]


def _column(table: str, place: int, field: Field) -> str:
    name, kind, _ = field
    known = {"row_id": "row_id", "subject_id": "subject_id", "hadm_id": "hadm_id", "icustay_id": "icustay_id"}
    made = known.get(name) or _BY_TYPE[kind].format(n=f"(row_id + {place})")
    if (table, name) == ("noteevents", "text"):
        made = "'line ' || row_id || chr(10) || 'said \"yes, no\"' || chr(10)"
    if UNSET.get(table) == name:
        return f"CASE WHEN row_id % 53 <> 0 THEN {made} END AS {name}"
    return f"{made if not field.nullable else f'CASE WHEN (row_id + {place}) % 4 <> 0 THEN {made} END'} AS {name}"


def columns(table: str) -> list[str]:
    return [_column(table, k, f) for k, f in enumerate(fields_of(table))]


def condition(table: str) -> str:
    lost = f" AND row_id % {LOSSES[table]} <> 0" if table in LOSSES else ""
    return f"({EVENTS_OF[table]}){lost}"


def rows(r: Roles, table: str) -> DataFrame:
    return r.events.where(condition(table)).selectExpr(*columns(table))


def sql(table: str) -> str:
    return f"SELECT {', '.join(columns(table))} FROM fx_events WHERE {condition(table)}"


def sums_sql(table: str) -> str:
    """The content sums of a table, as ``audit.content_sums`` has them."""
    fields = fields_of(table)

    def total(kinds: tuple[str, ...], each: str, none: str = "CAST(0 AS BIGINT)") -> str:
        parts = [f"coalesce(sum({each.format(f.name)}), 0)" for f in fields if f.kind in kinds]
        return " + ".join(parts) or none

    required = " + ".join(f"count_if({f.name} IS NULL)" for f in fields if not f.nullable)
    return f"""SELECT '{table}' AS tbl, count(*) AS observed_count, CAST({required} AS BIGINT) AS required_nulls,
      CAST({total(('int', 'smallint'), '{0}')} AS BIGINT) AS whole_numbers,
      CAST({total(('string',), 'length({0})')} AS BIGINT) AS characters,
      CAST({total(('timestamp_ntz',), 'floor(epoch({0}))')} AS BIGINT) AS seconds,
      round(CAST({total(('double',), '{0}', '0')} AS DOUBLE), 2) AS decimals FROM ({sql(table)})"""
