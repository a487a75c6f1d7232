"""Catalog tables: loading, bucketing, and stages built once."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wardframe.session import remove, shared_folder
from wardframe.sources.audit import content_sums
from wardframe.sources.csv import read_table
from wardframe.sources.schemas import BUCKET_KEYS, BUCKET_SORT, BUCKETS, CCS, CLINICAL, struct


BUCKET_BYTES = 256 << 20  # of files; a bucket is one task of the jobs that read it


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files in a folder, wherever it is."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def buckets_for(size: int, parallel: int, most: int = 100_000) -> int:
    """Buckets for so many bytes: of ``BUCKET_BYTES``, or smaller so that ``parallel`` tasks have work."""
    least = min(parallel, -(-size // (BUCKET_BYTES // 16)))
    return max(1, min(most, max(least, -(-size // BUCKET_BYTES))))


def write_bucketed(
    df: DataFrame,
    name: str,
    by: Sequence[str],
    n: int | None = BUCKETS,
    sort: Sequence[str] = (),
    fmt: str = "orc",
    mode: str = "overwrite",
    path: str | None = None,
    tasks_per_bucket: int = 4,
    watch: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Persist as a table bucketed by all of ``by`` together, sorted within each bucket.

    ``watch`` gets the rows as the last stage writes them.

    Rows are gathered by bucket first, each bucket in ``tasks_per_bucket`` tasks by the hash of the
    whole row: so there are at most that many files per bucket, however many tasks read the
    input, and a hot key is written by several tasks. Without ``n`` the rows are written to the shared folder first, and
    the size of those files gives the number of buckets.
    """
    spark, scratch = df.sparkSession, None
    if n is None:
        scratch = shared_folder(spark)
        df.write.parquet(scratch)
        n = buckets_for(folder_bytes(spark, scratch), spark.sparkContext.defaultParallelism)
        df = spark.read.schema(df.schema).parquet(scratch)
    bucket = F.pmod(F.hash(*by), F.lit(n))  # the hash that bucketing uses
    part = F.pmod(F.xxhash64(*df.columns), F.lit(tasks_per_bucket))
    df = watch(df.repartition(n * tasks_per_bucket, bucket, part))
    writer = df.write.format(fmt).mode(mode).bucketBy(n, *by)
    if sort:
        writer = writer.sortBy(*sort)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if scratch:
        remove(spark, scratch)
    return spark.table(name)


def _load(
    spark: SparkSession,
    registry: Mapping[str, str],
    src: str,
    db: str,
    mode: str,
    fmt: str | None,
    tables: Iterable[str] | None,
    gz: bool,
    partitions: int | None,
    buckets: int,
    file_name: Callable[[str], str],
    with_breaks: Iterable[str] = (),
    sums: dict[str, dict] | None = None,
) -> list[str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    loaded = []
    for table in registry if tables is None else tables:
        path = f"{src}/{file_name(table)}.csv"
        df = read_table(spark, path, registry[table], gz, partitions, table in with_breaks)
        name = f"{db}.{table}"
        # Watched in the stage that writes: there a task counts once, however often it runs.
        watched, metrics = Observation(), content_sums(struct(registry[table]))
        watch = (lambda rows: rows.observe(watched, *metrics)) if sums is not None else (lambda rows: rows)
        if table in BUCKET_SORT:
            write_bucketed(
                df, name, BUCKET_KEYS, buckets, BUCKET_SORT[table], fmt or "orc", mode, watch=watch
            )
        else:
            writer = watch(df).write.mode(mode)
            (writer.format(fmt) if fmt else writer).saveAsTable(name)
        if sums is not None:
            sums[table] = watched.get
        loaded.append(name)
    return loaded


def load_catalog(
    spark: SparkSession,
    src: str,
    db: str = "clinical",
    mode: str = "overwrite",
    fmt: str = "orc",
    tables: Iterable[str] | None = None,
    gz: bool = False,
    partitions: int | None = None,
    buckets: int = BUCKETS,
    with_breaks: Iterable[str] = ("noteevents",),
    sums: dict[str, dict] | None = None,
) -> list[str]:
    """Load the clinical tables (files named like the table, in capitals) into a database.

    Files are read in splits; ``with_breaks`` names the tables whose fields may hold line breaks. ``sums``, if
    given, gets the content sums of each table (see ``audit``), gathered while it is written. With
    ``mode="ignore"`` a table that is there already is not written, so it has none.
    """
    if mode == "ignore":
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        tables = [t for t in (tables or CLINICAL) if not spark.catalog.tableExists(f"{db}.{t}")]
    with_breaks = set(with_breaks)
    return _load(
        spark, CLINICAL, src, db, mode, fmt, tables, gz, partitions, buckets, str.upper, with_breaks, sums
    )


def load_ccs(
    spark: SparkSession,
    src: str,
    db: str = "ccs_dx",
    mode: str = "overwrite",
    fmt: str | None = None,
    gz: bool = False,
) -> list[str]:
    """Load the two diagnosis grouping tables, in the session's default format."""
    return _load(spark, CCS, src, db, mode, fmt, None, gz, None, BUCKETS, str)


def stage_name(name: str, **params: object) -> str:
    """Table name of a stage, keyed by every parameter that shapes it."""
    return "__".join([name, *[f"{k}_{v}" for k, v in sorted(params.items())]]).lower()


_VERSION = "stage.version"  # the property of a stage's view that names the table it stands for
_MARK = "__v"  # between a stage's name and the time and number of a version


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def current_version(spark: SparkSession, stage: str) -> str | None:
    """The table that a stage's name stands for at this moment, None if there is none."""
    if not spark.catalog.tableExists(stage):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(stage)}").collect()
    return {r["key"]: r["value"] for r in rows}.get(_VERSION, stage)


def _point(spark: SparkSession, stage: str, version: str) -> None:
    """Let the stage's name stand for ``version``: one change in the catalog, after all rows are written."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(stage)} TBLPROPERTIES ('{_VERSION}' = '{version}') "
        f"AS SELECT * FROM {_quoted(version)}"
    )


def materialize(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    recreate: bool = False,
    path: str | None = None,
    by: Sequence[str] = (),
    sort: Sequence[str] = (),
    buckets: int | None = None,
    most_rows: int | None = None,
    **params: object,
) -> DataFrame:
    """Build a stage once and reuse it; ``recreate`` builds it anew.

    A stage is a view that stands for one of its versions, each a table of its own. A build writes a new
    version and swaps the view when all of it is written, so a build that dies leaves the stage as
    it was, and a frame made before keeps reading the version it was made on, whoever rebuilds the stage.
    ``drop_old_versions`` removes versions that are no longer named.

    With ``by`` the versions are bucketed by these columns, sorted by ``sort`` within the buckets, and jobs by these keys plan
    no exchange on them; their number follows the measured size of the rows unless ``buckets`` gives it. A bucket is one
    task of such jobs, so with ``most_rows`` a stage in which a key has more rows than that stays a plain table.
    """
    stage = stage_name(name, **params)
    version = current_version(spark, stage)
    if version == stage:  # a plain table of that name: it becomes the first version
        version = _new_version(stage)
        spark.sql(f"ALTER TABLE {_quoted(stage)} RENAME TO {_quoted(version)}")
        _point(spark, stage, version)
    if version is None or recreate:
        version = _new_version(stage)
        own_path = path and f"{path.rstrip('/')}/{version.split('.')[-1]}"
        rows, scratch = build(), None
        if by:
            scratch = shared_folder(spark)
            rows.write.parquet(scratch)
            rows = spark.read.schema(rows.schema).parquet(scratch)
            largest = rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0 if most_rows else 0
            buckets = buckets or buckets_for(folder_bytes(spark, scratch), spark.sparkContext.defaultParallelism)
        if by and largest <= (most_rows or 0):
            write_bucketed(rows, version, by, buckets, sort, "parquet", path=own_path)
        else:
            writer = rows.write
            (writer.option("path", own_path) if own_path else writer).saveAsTable(version)
        if scratch:
            remove(spark, scratch)
        _point(spark, stage, version)
    return spark.table(version)


def _new_version(stage: str) -> str:
    return f"{stage}{_MARK}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def versions(spark: SparkSession, name: str, **params: object) -> list[str]:
    """All versions of a stage, oldest first, those of builds that died among them."""
    stage = stage_name(name, **params)
    *database, own = stage.split(".")
    where = f" IN {_quoted('.'.join(database))}" if database else ""
    rows = spark.sql(f"SHOW TABLES{where} LIKE '{own}{_MARK}*'").collect()
    # In that pattern a dot stands for any character and names may go on: only full names count.
    full = re.compile(re.escape(own + _MARK) + r"\d{20}_[0-9a-f]{8}")
    found = [r["tableName"] for r in rows if full.fullmatch(r["tableName"])]
    return [".".join([*database, t]) for t in sorted(found)]


def drop_old_versions(
    spark: SparkSession, name: str, older_than_hours: float = 0.0, **params: object
) -> list[str]:
    """Drop the versions that the stage does not stand for and that were begun so long ago; returns them.

    Give the hours that the longest job reads a stage, or a build takes.
    """
    current = current_version(spark, stage_name(name, **params))
    begun = time.time_ns() - int(older_than_hours * 3600e9)
    old = [
        v
        for v in versions(spark, name, **params)
        if v != current and int(v.rsplit(_MARK, 1)[1][:20]) <= begun
    ]
    for v in old:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(v)}")
    return old
