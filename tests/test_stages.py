"""Stages and their versions."""

import pytest
from pyspark.sql import functions as F

from wardframe.plans.extract import Catalog
from wardframe.sources import tables


@pytest.fixture(scope="module", autouse=True)
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions_test")


def build(spark, n):
    return lambda: spark.range(n).withColumn("n", F.lit(n))


def test_a_frame_outlives_a_rebuild_by_another_catalog(spark):
    first = Catalog(spark, stages="versions_test").stage("s", build(spark, 3), method="a")
    joined = first.join(spark.range(2), "id")
    other = Catalog(spark, stages="versions_test", recreate=True)
    again = other.stage("s", build(spark, 5), method="a")
    assert (first.count(), joined.count(), again.count()) == (3, 2, 5)
    assert spark.table("versions_test.s__method_a").count() == 5
    # once per catalog: later jobs, and frames made before, read what it built
    assert other.stage("s", build(spark, 7), method="a").count() == 5
    assert Catalog(spark, stages="versions_test").stage("s", build(spark, 9), method="a").count() == 5


def test_old_versions_go_when_no_longer_named(spark):
    for n in (1, 2, 3):
        tables.materialize(spark, "versions_test.t", build(spark, n), recreate=True)
    tables.materialize(spark, "versions_test.t_x", build(spark, 8))
    found = tables.versions(spark, "versions_test.t")
    assert len(found) == 3 and found[-1] == tables.current_version(spark, "versions_test.t")
    assert tables.drop_old_versions(spark, "versions_test.t", older_than_hours=1) == []
    assert tables.drop_old_versions(spark, "versions_test.t") == found[:2]
    assert tables.versions(spark, "versions_test.t") == found[2:]
    assert spark.table("versions_test.t").count() == 3 and spark.table("versions_test.t_x").count() == 8


def test_a_build_that_dies_leaves_the_stage(spark):
    tables.materialize(spark, "versions_test.u", build(spark, 4))

    def dies():
        return spark.range(100).select(F.assert_true(F.col("id") < 50).alias("x"))

    with pytest.raises(Exception):
        tables.materialize(spark, "versions_test.u", dies, recreate=True)
    assert spark.table("versions_test.u").count() == 4
    assert tables.materialize(spark, "versions_test.u", dies).count() == 4
    with pytest.raises(Exception):
        tables.materialize(spark, "versions_test.never", dies)
    assert not spark.catalog.tableExists("versions_test.never")
    assert tables.materialize(spark, "versions_test.never", build(spark, 2)).count() == 2


def test_a_plain_table_becomes_the_first_version(spark):
    spark.range(6).write.saveAsTable("versions_test.plain")
    got = tables.materialize(spark, "versions_test.plain", build(spark, 1))
    assert got.count() == 6 and len(tables.versions(spark, "versions_test.plain")) == 1
    assert tables.materialize(spark, "versions_test.plain", build(spark, 1), recreate=True).count() == 1
    assert got.count() == 6


def test_versions_lie_in_folders_of_their_own(spark, tmp_path):
    for n in (1, 2):
        frame = tables.materialize(spark, "versions_test.at", build(spark, n), recreate=True, path=str(tmp_path))
        assert frame.count() == n
    assert len(list(tmp_path.iterdir())) == 2


def test_jobs_by_the_key_of_a_bucketed_stage_plan_no_exchange(spark):
    events = spark.range(4000).select((F.col("id") % 61).alias("subject_id"), (F.col("id") % 122).alias("hadm_id"), F.col("id").alias("t"))
    keys = ["subject_id", "hadm_id"]
    for name in ("left", "right"):
        tables.materialize(spark, f"versions_test.{name}", lambda: events, by=keys, sort=[*keys, "t"], buckets=8)
    left, right = (tables.materialize(spark, f"versions_test.{n}", lambda: events) for n in ("left", "right"))
    totals = right.groupBy(*keys).agg(F.max("t").alias("last"))
    window = left.withColumn("first", F.expr("min(t) OVER (PARTITION BY subject_id, hadm_id ORDER BY t)"))
    job = window.join(totals.hint("merge"), keys).groupBy(*keys).agg(F.count("*").alias("n"), F.max("last").alias("last"))
    plan = job._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and job.agg(F.sum("n")).first()[0] == 4000
    # through the stage's name as well
    named = spark.table("versions_test.left").groupBy(*keys).count()
    assert "Exchange" not in named._jdf.queryExecution().executedPlan().toString()


def test_a_stage_with_a_large_key_is_not_bucketed(spark):
    rows = spark.range(500).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("k"), "id")
    for most, layout in ((100, None), (200, "1")):
        got = tables.materialize(spark, f"versions_test.large_{most}", lambda: rows, by=["k"], most_rows=most)
        name = tables.current_version(spark, f"versions_test.large_{most}")
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert described.get("Num Buckets") == layout and got.count() == 500


def test_bucket_count_follows_the_measured_size(spark):
    assert tables.buckets_for(0, 8) == 1 and tables.buckets_for(1000, 8) == 1
    assert tables.buckets_for(tables.BUCKET_BYTES, 8) == 8  # small tables keep all tasks at work
    assert tables.buckets_for(1000 * tables.BUCKET_BYTES, 8) == 1000
    assert tables.buckets_for(10**18, 8) == 100_000
    small = tables.materialize(spark, "versions_test.sized", lambda: spark.range(100), by=["id"])
    name = tables.current_version(spark, "versions_test.sized")
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "1" and small.count() == 100
