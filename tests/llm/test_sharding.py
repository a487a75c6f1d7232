import zlib
from collections import Counter

from pyspark.sql import functions as F

from wardframe.llm.sharding import op8_shuffled_shards, shuffled_shards


def test_shards_are_even_gapless_and_whole(documents):
    rows = [(k, f"text {k % 7}" * (k % 50)) for k in range(1003)] + [(None, None)] * 400 + [(5, "")] * 3
    docs = documents(rows, {"shard": F.lit("clash"), "bucket": F.lit(1)})
    out = shuffled_shards(docs, shards=8, bucket_bytes=4096).collect()
    assert Counter((r.record.doc_id, r.record.text) for r in out) == Counter(rows)
    slots = {s: sorted(r.slot for r in out if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in slots.values())
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_same_seed_same_order_other_seed_other_order(documents, stored, spark):
    sf = stored(documents=documents([(k, "x" * (k % 9)) for k in range(500)]))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    place = lambda seed: {r.record.doc_id: (r.shard, r.slot) for r in shuffled_shards(docs, seed=seed, bucket_bytes=2000).collect()}
    one, again, other = place(1), place(1), place(2)
    assert one == again != other
    moved = sum(a != b for a, b in zip([d for d, _ in sorted(one.items(), key=lambda x: x[1])], range(500)))
    assert moved > 450


def test_query_on_empty_and_null_texts(documents, stored, spark):
    assert op8_shuffled_shards(spark, stored(documents=documents([]))).collect() == []


def test_query_digests(documents, stored, spark):
    out = {r.doc_id: r for r in op8_shuffled_shards(spark, stored(documents=documents([(1, None), (2, ""), (3, "é")]))).collect()}
    assert [(out[k].size, out[k].text_crc32) for k in (1, 2, 3)] == [(1, 0), (1, 0), (3, zlib.crc32("é".encode()))]
    assert {r.law for r in out.values()} == {"rows"}
