"""Registered queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.checks.oracle_views import with_views
from wardframe.checks.role_views import Roles
from wardframe.operators.skew import MAX_ROWS
from wardframe.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
STEPS: dict[str, str] = {}  # shared parts of the SQL, in order of definition

SMALL_SLICE = 8  # rows: makes most keys of the small test tables hot ones


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals: sums may differ in the last bits with the order of addition."""
    return df.select(
        *[F.round(c, 6).alias(c) if ty == "double" else F.col(c) for c, ty in df.dtypes]
    )


def query(key: str, sql: str, split: bool = False, staged: bool = False):
    """Register a job over the role views; ``split`` adds a run with its busy keys cut up."""

    def runner(job: Callable[[Roles], DataFrame], max_rows: int):
        return lambda spark, sf_dir: rounded(
            job(Roles(configure(spark), sf_dir, max_rows, staged))
        )

    def register(job: Callable[[Roles], DataFrame]):
        QUERIES[key] = runner(job, MAX_ROWS)
        ORACLES[key] = with_views(sql, STEPS)
        if split:
            QUERIES[f"{key}_hot_keys"] = runner(job, SMALL_SLICE)
            ORACLES[f"{key}_hot_keys"] = ORACLES[key]
        return job

    return register


def in_list(codes) -> str:
    return ", ".join(f"'{c}'" if isinstance(c, str) else str(c) for c in codes)
