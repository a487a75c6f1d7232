"""Audits of loaded tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: What is known of a table's content: sums that other engines can give as well, and a checksum of whole rows.
SUMS = "required_nulls long, whole_numbers long, characters long, seconds long, decimals double, checksum string"


def content_sums(schema: StructType) -> list[Column]:
    """Aggregates that describe a table's content, whatever the order of its rows.

    Rows; NULLs in columns declared NOT NULL; the sums of whole numbers, of characters, of seconds since
    1970 and of other numbers, over all columns of such a type; and the sum of a hash of every row.
    """

    def total(kinds: tuple[str, ...], each, zero: Column) -> Column:
        own = [f.name for f in schema if f.dataType.typeName() in kinds]
        return reduce(add, [F.coalesce(F.sum(each(F.col(f"`{c}`"))), zero) for c in own], zero)

    required = [F.count_if(F.col(f"`{f.name}`").isNull()) for f in schema if not f.nullable]
    none = F.lit(0).cast("long")
    hashed = F.sum(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema]).cast("decimal(20,0)"))
    return [
        F.count("*").alias("observed_count"),
        reduce(add, required, none).alias("required_nulls"),
        total(("byte", "short", "integer", "long"), lambda c: c, none).alias("whole_numbers"),
        total(("string",), F.length, none).alias("characters"),
        total(("timestamp", "timestamp_ntz"), F.unix_timestamp, none).alias("seconds"),
        total(("float", "double"), lambda c: c, F.lit(0.0)).alias("decimals"),
        F.coalesce(hashed.cast("string"), F.lit("0")).alias("checksum"),
    ]


def _checked(counts: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    spark = counts.sparkSession
    wanted = spark.createDataFrame(list(expected.items()), "tbl string, expected_count long")
    check = F.when(F.col("expected_count") == F.col("observed_count"), "PASSED").otherwise("FAILED")
    rest = [c for c in counts.columns if c not in ("tbl", "observed_count")]
    # A row per table on both sides.
    return (
        counts.join(F.broadcast(wanted), "tbl")
        .select("tbl", "expected_count", "observed_count", check.alias("row_count_check"), *rest)
        .orderBy("tbl")
    )


def audit_row_counts(
    spark: SparkSession, expected: Mapping[str, int], db: str | None = None
) -> DataFrame:
    """``(tbl, expected_count, observed_count, row_count_check)`` per table, PASSED or FAILED."""
    counts = [
        spark.table(f"{db}.{t}" if db else t)
        .agg(F.count("*").alias("observed_count"))
        .select(F.lit(t).alias("tbl"), "observed_count")
        for t in expected
    ]
    return _checked(reduce(DataFrame.unionByName, counts), expected)


def audit_loads(
    spark: SparkSession, sums: Mapping[str, Mapping[str, object]], expected: Mapping[str, int]
) -> DataFrame:
    """The same, with the content sums that ``load_catalog`` gathered while it wrote: no table is read again."""
    names = ["observed_count", *[c.split(" ")[0] for c in SUMS.split(", ")]]
    rows = [(t, *[found[n] for n in names]) for t, found in sums.items()]
    return _checked(spark.createDataFrame(rows, f"tbl string, observed_count long, {SUMS}"), expected)


def audit_required(df: DataFrame, schema: StructType) -> DataFrame:
    """``(column, null_count)`` for every column declared NOT NULL, in one pass."""
    required = [f.name for f in schema if not f.nullable]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.unpivot([], required, "column", "null_count")
