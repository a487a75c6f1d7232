"""Session settings the jobs count on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Turn on runtime re-planning; every setting here can be set on a live session.

    The tables' times have no zone, so their differences must not see clock changes: UTC.
    ``forceOptimizeSkewedJoin`` lets Spark split a skewed join partition even when a later
    aggregate wants the same partitioning, which is the usual shape here (join to admissions,
    then group by admission).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the cluster's checkpoint folder, for tables written between stages.

    The folder is that of ``spark.checkpoint.dir``, or else the one given to ``setCheckpointDir``. Without
    either, a session on one machine gets a temporary folder that goes when the program ends; on a
    cluster that folder would not be shared, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/wardframe-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system, wherever it is."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="wardframe-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
