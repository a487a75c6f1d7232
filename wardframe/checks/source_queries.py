"""Sources, sinks, stages and audits, as round trips through files and catalog tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wardframe.checks import catalog_views, concept_queries as concepts
from wardframe.checks.registry import query
from wardframe.checks.role_views import KEYS, Roles
from wardframe.session import shared_folder
from wardframe.sources import audit, csv, schemas, tables


def _database(r: Roles, name: str) -> str:
    """A database of its own, with its tables in the shared folder."""
    db = f"{name}_{uuid.uuid4().hex[:12]}"
    r.spark.sql(f"CREATE DATABASE {db} LOCATION '{shared_folder(r.spark)}'")
    return db


def _as_declared(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with the declared columns, NULL where it has none."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.struct(ddl)
        ]
    )


@query("s1_read_clinical_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_clinical_csv(r: Roles):
    path = shared_folder(r.spark)
    documents = r.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    csv.export_csv(documents, path)
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return csv.read_table(r.spark, path, ddl, partitions=8, multi_line=True)


@query(
    "s1_read_clinical_csv_whole_files", "SELECT doc_id, text, lang, source, n_chars FROM documents"
)
def read_clinical_csv_whole_files(r: Roles):
    path = shared_folder(r.spark)
    documents = r.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    csv.export_csv(documents, path)
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return csv.read_table(r.spark, path, ddl, partitions=8, multi_line=True, whole_files=True)


@query(
    "s1_read_clinical_csv_lines",
    "SELECT event_id, user_id, ts, event_type, value FROM events",
)
def read_clinical_csv_lines(r: Roles):
    path = shared_folder(r.spark)
    csv.export_csv(r.table("events").select("event_id", "user_id", "ts", "event_type", "value"), path)
    ddl = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double"
    return csv.read_table(r.spark, path, ddl)


def _load(r: Roles, tables_: dict) -> tuple[str, dict]:
    """Write the tables as CSV and load them; the database, and what was summed up while loading."""
    folder, sums = shared_folder(r.spark), {}
    for name, rows in tables_.items():
        df = _as_declared(rows, schemas.CLINICAL[name])
        csv.export_csv(df.toDF(*[c.upper() for c in df.columns]), f"{folder}/{name.upper()}.csv")
    db = _database(r, "clinical")
    tables.load_catalog(r.spark, folder, db, tables=list(tables_), sums=sums)
    return db, sums


def _load_labs(r: Roles) -> str:
    return _load(r, {"labevents": r.labevents})[0]


def _load_all(r: Roles) -> tuple[str, dict]:
    return _load(r, {name: catalog_views.rows(r, name) for name in schemas.CLINICAL})


@query(
    "s2_load_catalog",
    """SELECT row_id, subject_id, hadm_id, charttime, itemid, valuenum FROM fx_labevents""",
)
def load_catalog(r: Roles):
    labs = r.spark.table(f"{_load_labs(r)}.labevents")
    return labs.select("row_id", "subject_id", "hadm_id", "charttime", "itemid", "valuenum")


#: All 26 tables, loaded and read back.
@query(
    "s2_load_catalog_tables",
    " UNION ALL ".join(catalog_views.sums_sql(t) for t in schemas.CLINICAL),
)
def load_catalog_tables(r: Roles):
    db, _ = _load_all(r)
    read = []
    for name, ddl in schemas.CLINICAL.items():
        sums = r.spark.table(f"{db}.{name}").agg(*audit.content_sums(schemas.struct(ddl)))
        read.append(sums.withColumn("tbl", F.lit(name)))
    found = reduce(lambda a, b: a.unionByName(b), read).drop("checksum")
    return found.withColumn("decimals", F.round("decimals", 2))


@query(
    "s3_write_bucketed",
    """SELECT subject_id, hadm_id, count(*) AS n, round(sum(value), 6) AS total
    FROM fx_events GROUP BY subject_id, hadm_id""",
)
def write_bucketed(r: Roles):
    table = tables.write_bucketed(
        r.events,
        f"{_database(r, 'bucketed')}.chartevents",
        KEYS,
        8,
        [*KEYS, "charttime", "row_id"],
    )
    # The buckets are the partitions of this aggregate: no shuffle.
    return table.groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("s4_load_ccs", "SELECT ccs_id, ccs_name, icd9_code FROM fx_ccs")
def load_ccs(r: Roles):
    folder = shared_folder(r.spark)
    multi = r.ccs.withColumn("ccs_mid", F.col("ccs_id").cast("string"))
    for name, df in (("ccs_single_level", r.ccs), ("ccs_multi_level", multi)):
        csv.export_csv(_as_declared(df, schemas.CCS[name]), f"{folder}/{name}.csv")
    db = _database(r, "ccs_dx")
    tables.load_ccs(r.spark, folder, db)
    single = r.spark.table(f"{db}.ccs_single_level")
    codes = r.spark.table(f"{db}.ccs_multi_level").select("icd9_code")
    return single.join(codes, "icd9_code", "left_semi").select("ccs_id", "ccs_name", "icd9_code")


@query("s5_read_note_labels", 'SELECT subject_id, hadm_id, "timestamp", label FROM fx_notes')
def read_note_labels(r: Roles):
    path = shared_folder(r.spark)
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp_str")
    csv.export_csv(r.notes.select(*KEYS, iso, "label"), path)
    return csv.read_note_labels(r.spark, path)


@query(
    "s6_export_csv",
    """SELECT row_id, hadm_id, charttime, itemid, round(valuenum, 6) AS valuenum
    FROM fx_labevents""",
)
def export_csv(r: Roles):
    path = shared_folder(r.spark)
    labs = r.labevents.select("row_id", "hadm_id", "charttime", "itemid", "valuenum")
    csv.export_csv(labs, path)
    ddl = "row_id bigint, hadm_id bigint, charttime timestamp_ntz, itemid int, valuenum double"
    return csv.read_table(r.spark, path, ddl)


@query("s7_materialize", "SELECT * FROM st_baseline")
def materialize(r: Roles):
    stage = f"{_database(r, 'stages')}.baseline"
    for _ in range(2):  # built the first time, reused the second
        table = tables.materialize(
            r.spark, stage, lambda: concepts.baseline(r, "median"), method="median"
        )
    return table


def _expected_sql() -> str:
    """How many events stand for the rows of each table; some tables lose a few."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, count(*) AS expected_count FROM fx_events WHERE {where}"
        for t, where in catalog_views.EVENTS_OF.items()
    )


def _expected(r: Roles) -> dict[str, int]:
    counts = r.events.agg(*[F.count_if(F.expr(w)).alias(t) for t, w in catalog_views.EVENTS_OF.items()])
    return counts.first().asDict()


SUMMED = " UNION ALL ".join(catalog_views.sums_sql(t) for t in catalog_views.EVENTS_OF)
CHECKED = f"""SELECT tbl, expected_count, observed_count,
  CASE WHEN expected_count = observed_count THEN 'PASSED' ELSE 'FAILED' END AS row_count_check"""


@query("s8_audit_row_counts", f"{CHECKED} FROM ({_expected_sql()}) JOIN ({SUMMED}) USING (tbl)")
def audit_row_counts(r: Roles):
    db, _ = _load_all(r)
    return audit.audit_row_counts(r.spark, _expected(r), db)


@query(
    "s8_audit_loads",
    f"""{CHECKED}, required_nulls, whole_numbers, characters, seconds, decimals
    FROM ({_expected_sql()}) JOIN ({SUMMED}) USING (tbl)""",
)
def audit_loads(r: Roles):
    _, sums = _load_all(r)
    found = audit.audit_loads(r.spark, sums, _expected(r)).drop("checksum")
    return found.withColumn("decimals", F.round("decimals", 2))


REQUIRED = ("row_id", "subject_id", "itemid")


@query(
    "s8_audit_required",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS null_count FROM fx_labevents"
        for c in REQUIRED
    ),
)
def audit_required(r: Roles):
    labs = r.spark.table(f"{_load_labs(r)}.labevents")
    return audit.audit_required(labs, schemas.struct(schemas.CLINICAL["labevents"]))
