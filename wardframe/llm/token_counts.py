"""Token counts as delta-maintained rollups.

The store is a folder of committed batches. A batch of changes (insert, delete, revise) is turned into
signed rows against the present state: +1 with the new count, -1 with the old one. Next to the rows
the batch keeps its rollup, their sums by source, language and tokenizer version. Totals are the
sum of all rollups, so they are never recounted, and the state of a document is the sum of its signed rows.

A batch is written under a name of its own and then renamed to its id, in one step of the file system,
after which it counts as a whole; a batch whose id is there already is not applied again. A job that
died half-way leaves nothing that counts and can be run again.

Within a batch, the change with the highest ``seq`` holds for a (doc_id, version); of equal ones, the
largest by content. Inserting what is there, or revising it to the same values, changes nothing; inserting
other values revises; revising what is not there inserts; deleting what is not there does nothing.
Null ids, sources and languages are values like any other; a null count is 0. Rollups add on the map side,
so a source with a third of all documents is one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardframe.llm.common import Stages, per_row, table, words_of
from wardframe.llm.tokens import encoder, vocabulary

KEY = ["doc_id", "version"]
GROUP = ["source", "lang", "version"]
SIGNED = "doc_id long, version string, source string, lang string, tokens long, sign int"
ROLLUP = "source string, lang string, version string, docs long, tokens long"


class Rollups:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        root = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(root)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def batches(self) -> list[str]:
        """Ids of committed batches."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(""))]
        return sorted(n.removeprefix("batch-") for n in names if n.startswith("batch-"))

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/batch-{b}/{part}" for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def state(self) -> DataFrame:
        """One row per (doc_id, version) present: source, lang, tokens."""
        return self._read("rows", SIGNED).groupBy(*KEY, "source", "lang", "tokens").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")

    def totals(self) -> DataFrame:
        """``source, lang, version, docs, tokens``, groups without documents left out."""
        return (
            self._read("rollup", ROLLUP).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0")
        )

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit ``changes`` (op, seq, doc_id, version, source, lang, tokens) once; False if it was there."""
        if batch_id in self.batches():
            return False
        value = F.struct(F.col("op"), F.col("source"), F.col("lang"), F.coalesce(F.col("tokens").cast("long"), F.lit(0)).alias("tokens"))
        asked = changes.groupBy(F.col("doc_id").cast("long").alias("doc_id"), "version").agg(F.max(F.struct(F.col("seq"), value.alias("v"))).alias("c"))
        asked = asked.select(*KEY, "c.v.*")
        if self.batches():
            now = self.state().select(*[F.col(c).alias(f"o_{c}") for c in (*KEY, "source", "lang", "tokens")], F.lit(True).alias("known"))
            both = asked.join(now, F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & F.col("version").eqNullSafe(F.col("o_version")), "left")
        else:
            both = asked.select("*", *[F.lit(None).cast(t).alias(f"o_{c}") for c, t in (("source", "string"), ("lang", "string"), ("tokens", "long"))], F.lit(None).cast("boolean").alias("known"))
        same = F.col("known") & F.col("source").eqNullSafe(F.col("o_source")) & F.col("lang").eqNullSafe(F.col("o_lang")) & (F.col("tokens") == F.col("o_tokens"))
        moved = both.withColumn("drop", F.coalesce("known", F.lit(False)) & ((F.col("op") == "delete") | ~F.coalesce(same, F.lit(False))))
        moved = moved.withColumn("put", (F.col("op") != "delete") & ~F.coalesce(same, F.lit(False)))
        plus = F.when(F.col("put"), F.struct("source", "lang", "tokens", F.lit(1).alias("sign")))
        minus = F.when(F.col("drop"), F.struct(F.col("o_source").alias("source"), F.col("o_lang").alias("lang"), F.col("o_tokens").alias("tokens"), F.lit(-1).alias("sign")))
        signed = moved.select(*KEY, F.explode(F.filter(F.array(plus, minus), lambda x: x.isNotNull())).alias("r")).select(*KEY, "r.*")

        stages = Stages(self.spark, "batch")
        draft = f"draft-{stages.folder.rsplit('/', 1)[-1]}"
        signed.write.option("compression", "zstd").parquet(f"{self.folder}/{draft}/rows")
        rows = self.spark.read.schema(SIGNED).parquet(f"{self.folder}/{draft}/rows")
        rows.groupBy(*GROUP).agg(F.sum(F.col("sign").cast("long")).alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens")).write.parquet(
            f"{self.folder}/{draft}/rollup"
        )
        if not self._fs.exists(self._path(f"batch-{batch_id}")) and self._fs.rename(self._path(draft), self._path(f"batch-{batch_id}")):
            return True
        self._fs.delete(self._path(draft), True)
        return False


def counted(docs: DataFrame, counters: dict[str, Callable[[], Callable[[str | None], int]]], keep: list[str]) -> DataFrame:
    """The ``keep`` columns with ``version`` and ``tokens``: a row per document and tokenizer version.

    ``counters`` maps a version to a function that makes its counter; it is called in the tasks.
    """
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], "text")

    def run(batches):
        made = {version: make() for version, make in counters.items()}

        def rows(part: pd.DataFrame) -> pd.DataFrame:
            texts = [t if isinstance(t, str) else None for t in part["text"]]
            rest = part.drop(columns=["text"])
            return pd.concat([rest.assign(version=v, tokens=[count(t) for t in texts]) for v, count in made.items()])

        return per_row(batches, rows)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "text")
    return slim.mapInPandas(run, f"{kept}, version string, tokens long")


def bpe_counter(tokenizer_file: str, ranks_file: str | None) -> Callable[[], Callable[[str | None], int]]:
    return lambda: lambda text, own=encoder(tokenizer_file, ranks_file): len(own.ids(text)) // 4


def word_counter() -> Callable[[str | None], int]:
    return lambda text: len(words_of(text))


def changes(op: str, seq: int, rows: DataFrame, tokens: Column | str = "tokens") -> DataFrame:
    return rows.select(F.lit(op).alias("op"), F.lit(seq).alias("seq"), "doc_id", "version", "source", "lang", (F.col(tokens) if isinstance(tokens, str) else tokens).alias("tokens"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under two tokenizer versions; exact copies go; BPE counts get an end token.

    The last batch is sent twice, as a job that was started again would do.
    """
    stages = Stages(spark, "token-counts")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    versions = {"bpe-50k-1": bpe_counter(vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")), "words-1": word_counter}
    slim = docs.select("doc_id", "source", "lang", "text", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("digest"))
    rows = stages.write(counted(slim, versions, ["doc_id", "source", "lang", "digest"]), "counted")
    first = rows.where("version = 'words-1'").groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = rows.join(first, "digest").where("doc_id <> first")

    store = Rollups(spark, f"{stages.folder}/store")
    store.apply("1-load", changes("insert", 1, rows))
    store.apply("2-copies", changes("delete", 1, copies))
    left = store.state().where("version = 'bpe-50k-1'")
    revised = changes("revise", 1, left, F.col("tokens") + 1)
    store.apply("3-end-token", revised)
    store.apply("3-end-token", revised)
    return store.totals()
