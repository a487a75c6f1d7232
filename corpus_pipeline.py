"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes what its predecessor kept, as a table, and all but the last return the columns of
``documents``. ``run`` writes every stage as Parquet into the folder that the cluster shares and reads
it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.llm import decontamination, ngram_join, packing, quality_classifier, substring_dedup
from wardframe.llm.common import Stages, table
from wardframe.llm.tokens import vocabulary

KEEP_FROM = 0.3  # quality score


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on these documents' labels, scores KEEP_FROM or more."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.scored(docs, model, docs.columns).where(F.col("score") >= KEEP_FROM).select("record.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram Jaccard links hold together."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur earlier; a document of which nothing is left goes."""
    cut = substring_dedup.without_repeats(docs).where("n_removed = 0 OR kept_text <> ''")
    text = F.col("kept_text")
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("record.n_chars"))}
    return cut.select(*[changed.get(c, F.col(f"record.`{c}`")).alias(c) if c in ("text", "n_chars") else F.col(f"record.`{c}`").alias(c) for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies among the training sequences."""
    pieces = packing.pieces_of(docs, ["doc_id"], vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))
    return packing.pack(pieces).select("record.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed),
]

#: A trained classifier and tokenizer ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stages.write(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            stages.drop(f"stage{k - 1}")
    return docs
