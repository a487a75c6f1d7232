"""Sharding by a two-pass external shuffle, in DataFrame functions alone.

Pass one scatters whole records by seeded hashes into buckets that fit in memory. Pass two shuffles
each bucket by Fisher-Yates (Spark's ``shuffle``) and writes it. The buckets laid end to end are one
random order of the corpus; place p of that order goes to shard p mod n, slot p div n, so shard
sizes differ by one row at most. Running counts over buckets are taken in two levels, so no task
sees all buckets.

A seeded run repeats itself as long as the input is read with the same splits: the hash takes a
row's place in the scan, not its key, so repeated rows and null keys scatter like all others. The
input should be a table (or a written stage), which a retried task reads again in the same order.

Null texts, null ids, repeated rows and empty texts are records like any other; an empty table gives
no rows. All input columns stay together in the struct ``record``, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardframe.llm.common import Stages, table

BLOCK = 4096  # buckets per first-level running count


def shuffled_shards(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 20240607,
    bucket_bytes: int = 8 << 20,
    most_partitions: int = 20_000,
    text: str = "text",
) -> DataFrame:
    """``record`` (all input columns), ``shard`` 0..shards-1, ``slot`` gapless from 0 in each shard."""
    spark = docs.sparkSession
    stages = Stages(spark, "sharding")
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64).alias("b")).first().b or 0
    buckets = max(1, -(-total // bucket_bytes))

    scattered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        F.monotonically_increasing_id().alias("at"),
    ).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "at"), F.lit(buckets)))
    mixed = (
        scattered.repartition(min(buckets, most_partitions), "bucket")
        .sortWithinPartitions("bucket", "at")  # one order per seed, whatever order blocks arrive in
        .groupBy("bucket")
        .agg(F.collect_list("record").alias("records"))
        .select("bucket", F.shuffle("records", F.lit(seed)).alias("records"))
        .select("bucket", F.posexplode("records").alias("place", "record"))
    )
    written = stages.write(mixed, "buckets")
    offsets = _offsets(written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    position = F.col("before") + F.col("place")
    return written.join(offsets, "bucket").select(
        "record",
        (position % shards).cast("int").alias("shard"),
        F.expr(f"(before + place) div {shards}").alias("slot"),
    )


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows in all earlier buckets, per bucket."""
    blocked = counts.withColumn("block", F.expr(f"bucket div {BLOCK}"))
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy("block")
        .agg(F.sum("n").alias("total"))
        .select("block", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("base"))
    )
    return (
        blocked.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(blocks, "block")
        .select("bucket", (F.col("inner") + F.col("base")).alias("before"))
    )


def op8_shuffled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return shuffled_shards(table(spark, sf_dir, "documents"), shards=8).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
