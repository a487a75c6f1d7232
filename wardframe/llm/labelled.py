"""Bounded samples of labelled and unlabelled documents for the text classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardframe.llm.common import crc_fold


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id, y`` of the training fold: rows whose crc32(doc_id) mod 5 is not 0.

    Null ids and labels teach nothing; a repeated id counts once, with its largest label.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).where(crc_fold() != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(column) > 0).cast("int").alias("y"))
    )


def spread_ids(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` ids, the same ones every time, in an order that has nothing to do with the id."""
    return ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of documents with these ids. ``ids`` has a fixed largest size, so it is broadcast."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
