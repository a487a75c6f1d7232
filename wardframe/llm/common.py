"""What the operators share: stages written to the shared folder, words, hashes, file removal."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.session import shared_folder


class Stages:
    """Written tables of one operator run, in the folder that all executors share.

    A stage cuts the lineage: a lost executor costs the running stage only, and nothing lives on
    one machine alone. ``drop`` removes stages that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}-{label}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.folder}/{name}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system, wherever it is."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Texts can be long: bound what one Arrow batch holds.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- words and hashes in tasks


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes; bytes.split knows exactly these separators."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def lower_words_of(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased: bytes.lower leaves all other characters alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of its argument."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, in order; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * base + hashes[k : k + n]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)


def per_row(batches: Iterable[pd.DataFrame], rows: Callable[[pd.DataFrame], pd.DataFrame], most_bytes: int = 4 << 20, column: str = "text") -> Iterator[pd.DataFrame]:
    """Apply ``rows`` to slices of bounded text size, so that very long texts never pile up."""
    for batch in batches:
        if not len(batch):
            continue
        size = batch[column].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy().cumsum()
        cut = size // most_bytes
        for _, part in batch.groupby(cut, sort=True):
            out = rows(part)
            if len(out):
                yield out


def crc_fold(doc_id: str = "doc_id"):
    """crc32 of doc_id as text, modulo 5: 0 marks the held-out fold. Null ids count as the text ''."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 5
