"""Reading, writing, loading and auditing tables."""

import gzip
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardframe.sources import audit, csv, schemas, tables

DDL = "ROW_ID int not null, TEXT string, AT timestamp_ntz, X double"
GOOD = 'ROW_ID,TEXT,AT,X\n1,"two\nlines, ""quoted""",2101-10-20 19:08:00,1.5\n2,,,\n'


@pytest.fixture
def folder(tmp_path):
    return tmp_path


def put(path, text):
    path.write_text(text)
    return str(path)


def test_read_quoted_lines_and_nulls(spark, folder):
    df = csv.read_table(spark, put(folder / "a.csv", GOOD), DDL, multi_line=True)
    assert df.columns == ["row_id", "text", "at", "x"]
    rows = {r["row_id"]: tuple(r)[1:] for r in df.collect()}
    assert rows[1] == ('two\nlines, "quoted"', datetime(2101, 10, 20, 19, 8), 1.5)
    assert rows[2] == (None, None, None)


def test_read_gz_and_repartition(spark, folder):
    with gzip.open(folder / "a.csv.gz", "wt") as f:
        f.write(GOOD)
    df = csv.read_table(spark, str(folder / "a.csv"), DDL, gz=True, partitions=3, multi_line=True)
    assert df.count() == 2 and df.rdd.getNumPartitions() == 3


def test_other_header_or_malformed_row_fails(spark, folder):
    swapped = put(folder / "b.csv", "TEXT,ROW_ID,AT,X\na,1,,\n")
    with pytest.raises(Exception):
        csv.read_table(spark, swapped, DDL).collect()
    bad = put(folder / "c.csv", "ROW_ID,TEXT,AT,X\none,a,,\n")
    with pytest.raises(Exception):
        csv.read_table(spark, bad, DDL).collect()


def test_note_labels(spark, folder):
    path = put(
        folder / "n.csv",
        "subject_id,hadm_id,timestamp_str,label\n1,2,2101-10-20T19:08,true\n1,,2101-10-20T19:08:30,false\n",
    )
    got = csv.read_note_labels(spark, path).collect()
    assert [(r["hadm_id"], r["timestamp"], r["label"]) for r in got] == [
        (2, datetime(2101, 10, 20, 19, 8), True),
        (None, datetime(2101, 10, 20, 19, 8, 30), False),
    ]
    wrong = put(folder / "w.csv", "subject_id,hadm_id,timestamp_str,label\n1,2,yesterday,true\n")
    with pytest.raises(Exception):
        csv.read_note_labels(spark, wrong).collect()


def test_export_round_trip(spark, folder):
    df = spark.createDataFrame(
        [(1, ' "a", \\ \n b ', datetime(2024, 1, 1, 1, 2, 3, 456), 0.1), (2, None, None, None), (3, "x,y", None, 2.0)],
        DDL.lower().replace(" not null", ""),
    )
    path = str(folder / "out")
    csv.export_csv(df, path, single_file=True)
    assert len(list((folder / "out").glob("*.csv"))) == 1
    got = csv.read_table(spark, path, DDL.lower(), multi_line=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_bucketed_table(spark, folder):
    df = spark.range(1000).select(
        (F.col("id") % 7).alias("subject_id"), (F.col("id") % 50).alias("hadm_id"), F.col("id").alias("row_id")
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_test")
    table = tables.write_bucketed(
        df, "bucket_test.events", ["subject_id", "hadm_id"], 8, ["subject_id", "hadm_id", "row_id"]
    )
    spec = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED bucket_test.events").collect()}
    assert spec["Num Buckets"] == "8"
    assert spec["Bucket Columns"].replace("`", "") == "[subject_id, hadm_id]"
    counted = table.groupBy("subject_id", "hadm_id").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.agg(F.sum("count")).first()[0] == 1000
    many = df.repartition(64)
    wide = tables.write_bucketed(many, "bucket_test.many", ["subject_id", "hadm_id"], 8, tasks_per_bucket=2)
    assert len(wide.inputFiles()) <= 8 * 2 and wide.count() == 1000


def test_load_catalog_and_audits(spark, folder):
    for name in ("inputevents_mv", "caregivers"):
        fields = schemas.struct(schemas.CLINICAL[name]).fieldNames()
        line = ",".join("1" if c in ("row_id", "subject_id", "cgid") else "" for c in fields)
        missing = ",".join("1" if c == "row_id" else "" for c in fields)
        put(folder / f"{name.upper()}.csv", f"{','.join(fields).upper()}\n{line}\n{missing}\n")
    names = ("inputevents_mv", "caregivers")
    loaded = tables.load_catalog(spark, str(folder), "load_test", tables=names)
    assert loaded == ["load_test.inputevents_mv", "load_test.caregivers"]
    checks = audit.audit_row_counts(spark, {"inputevents_mv": 2, "caregivers": 3}, "load_test")
    assert {r["tbl"]: r["row_count_check"] for r in checks.collect()} == {
        "inputevents_mv": "PASSED", "caregivers": "FAILED",
    }
    nulls = audit.audit_required(
        spark.table("load_test.inputevents_mv"), schemas.struct(schemas.CLINICAL["inputevents_mv"])
    )
    assert {r["column"]: r["null_count"] for r in nulls.collect()} == {"row_id": 0, "subject_id": 1}
    with pytest.raises(Exception):
        tables.load_catalog(spark, str(folder), "load_test", mode="error", tables=names)
    tables.load_catalog(spark, str(folder), "load_test", mode="append", tables=["caregivers"], with_breaks=[])
    assert spark.table("load_test.caregivers").count() == 4


def test_every_schema_parses():
    assert len(schemas.CLINICAL) == 26 and len(schemas.CCS) == 2
    assert set(schemas.EXPECTED_ROWS) == set(schemas.CLINICAL)
    widths = {n: len(schemas.struct(d)) for n, d in schemas.CLINICAL.items()}
    assert widths["admissions"] == 19 and widths["inputevents_mv"] == 31 and widths["transfers"] == 13
    for name, sort in schemas.BUCKET_SORT.items():
        assert set(sort) <= set(schemas.struct(schemas.CLINICAL[name]).fieldNames())


def test_materialize_is_keyed_by_its_parameters(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stage_test")
    built = []

    def build(n):
        built.append(n)
        return spark.range(n)

    for recreate, n in ((False, 1), (False, 2), (True, 3)):
        got = tables.materialize(spark, "stage_test.s", lambda: build(n), recreate, method="median")
    assert built == [1, 3] and got.count() == 3
    assert tables.materialize(spark, "stage_test.s", lambda: build(5), method="first").count() == 5


@pytest.fixture
def small_splits(spark):
    """Files of a few lines are read by many tasks."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in kept.items():
        spark.conf.set(k, v)


def quoted_file(rng, rows, newline):
    """CSV with random breaks, quotes and commas in fields, quoted where needed and sometimes where not."""
    lines = ["id,a,b"]
    for k in range(rows):
        fields = []
        for _ in range(2):
            text = "".join(rng.choices(["x", "yz", " ", ",", '"', "\n", "\n\n", "\r\n", "é"], k=rng.randrange(8)))
            quote = any(c in text for c in ',"\n\r') or text != text.strip() or rng.random() < 0.3
            fields.append('"' + text.replace('"', '""') + '"' if quote and text else text)
        lines.append(f"{k},{fields[0]},{fields[1]}")
    return newline.join(lines) + newline


@pytest.mark.parametrize("seed", range(4))
def test_records_with_breaks_are_read_in_splits(spark, folder, small_splits, seed):
    rng = random.Random(seed)
    (folder / "many").mkdir()
    newline = "\r\n" if seed == 3 else "\n"
    for k in range(2):
        (folder / "many" / f"{k}.csv").write_bytes(quoted_file(rng, 60, newline).encode())
    ddl = "id int, a string, b string"
    want = csv.read_table(spark, str(folder / "many"), ddl, multi_line=True, whole_files=True).collect()
    for size in (40, 300, 1 << 20):
        small_splits(size)
        got = csv.read_table(spark, str(folder / "many"), ddl, multi_line=True)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want)) and len(want) == 120
    small_splits(40)
    assert spark.read.option("lineSep", "\n").text(str(folder / "many")).rdd.getNumPartitions() > 20


def test_a_record_over_many_splits(spark, folder, small_splits):
    long = "\n".join(f'line {k}, ""quoted""' for k in range(200))
    path = put(folder / "long.csv", f'ID,A,B\n1,"{long}",x\n\n2,"",y\n3,"{long}","{long}"')
    small_splits(64)
    got = {r["id"]: (r["a"], r["b"]) for r in csv.read_table(spark, path, "id int, a string, b string", multi_line=True).collect()}
    text = long.replace('""', '"')
    assert got == {1: (text, "x"), 2: (None, "y"), 3: (text, text)}


def test_splits_refuse_other_headers_and_malformed_records(spark, folder, small_splits):
    small_splits(16)
    for name, content in (("h", "A,ID,B\n1,x,y\n"), ("n", 'ID,A,B\none,"x\ny",z\n'), ("c", 'ID,A,B\n1,"x\ny"\n'), ("q", 'ID,A,B\n1,x"y,z\n2,a,b\n')):
        with pytest.raises(Exception):
            csv.read_table(spark, put(folder / f"{name}.csv", content), "id int, a string, b string", multi_line=True).collect()
    empty = csv.read_table(spark, put(folder / "e.csv", "ID,A,B\n"), "id int, a string, b string", multi_line=True)
    assert empty.collect() == []
