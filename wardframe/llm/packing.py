"""Best-fit packing of documents into sequences, bulk-synchronous over sorted lengths and gaps.

Documents and gaps are sorted by length. In each round the longest documents not yet placed look up
their successor among the gaps, the smallest gap that holds them; where several documents want the
same gaps, rank decides: the k-th document gets the k-th place. What finds no gap opens sequences. Then the
gaps are updated, and the next round starts. That is best-fit decreasing, all documents of one length at
a time.

Documents of a length can stand in for each other, so a sweep needs only how many there are: the
matching works on runs (length, ranks from-to) and (gap, sequences from-to). Runs are bounded by the
sequence length (2048), whatever the corpus holds. Spark does all that grows: cutting texts into pieces,
ranking each piece among its length (in two levels, since one length may hold a third of all
pieces), and looking up each piece's run.

Null texts are empty; an empty text is one piece of the end id alone. Repeated rows are packed one by one.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardframe.llm.common import Stages, per_row, table
from wardframe.llm.tokens import encoder, vocabulary

SEQUENCE = 2048
RANKED = 200_000  # pieces per ranking bucket


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, and before them what is left over."""
    first = n % size
    heads = [(0, first)] if first else []
    return heads + [(at, size) for at in range(first, n, size)]


def pieces_of(docs: DataFrame, keep: list[str], tokenizer_file: str, ranks_file: str | None, size: int = SEQUENCE, end: int = 0, with_ids: bool = False) -> DataFrame:
    """A row per piece: ``record`` (the ``keep`` columns), piece, start, length, ids_crc32 (and ids)."""
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text")
    names = ["piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches):
        own = encoder(tokenizer_file, ranks_file)
        last = end.to_bytes(4, "little")

        def rows(part: pd.DataFrame) -> pd.DataFrame:
            out, of = [], []
            for i, text in enumerate(part["text"]):
                ids = own.ids(text) + last
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    own_ids = ids[4 * start : 4 * (start + length)]
                    out.append((k, start, length, zlib.crc32(own_ids), *[own_ids] * with_ids))
                    of.append(i)
            result = pd.DataFrame(out, columns=names)
            result.insert(0, "record", part["record"].iloc[of].array)
            return result

        return per_row(batches, rows)

    schema = f"record {slim.schema['record'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return slim.mapInPandas(run, schema)


def plan(counts: dict[int, int], size: int = SEQUENCE) -> np.ndarray:
    """Runs (length, rank from, rank to, first sequence, pieces per sequence, offset in it), by length and rank."""
    gaps: list[int] = []  # sorted gap sizes with sequences
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
    out, opened = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                bisect.insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        updated = []

        def place(gap: int, first: int, n: int) -> int:
            """Put what is left into n sequences with this gap; returns how many sequences were touched."""
            nonlocal left, rank
            each = min(gap // length, left)
            full = min(n, left // each)
            out.append((length, rank, rank + full * each, first, each, size - gap))
            updated.append((gap - each * length, first, full))
            left, rank = left - full * each, rank + full * each
            if left and full < n:  # the last sequence takes fewer
                out.append((length, rank, rank + left, first + full, left, size - gap))
                updated.append((gap - left * length, first + full, 1))
                left, rank, full = 0, rank + left, full + 1
            return full

        at = bisect.bisect_left(gaps, length)
        while left and at < len(gaps):
            gap = gaps[at]
            while left and runs[gap]:
                first, n = runs[gap].pop()
                used = place(gap, first, n)
                if used < n:
                    runs[gap].append((first + used, n - used))
            if runs[gap]:
                at += 1
            else:
                del runs[gap], gaps[at]
        while left:
            n = -(-left // (size // length))
            opened, first = opened + n, opened
            place(size, first, n)
        for change in updated:
            add(*change)
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` (any columns, among them ``length``, 1 to ``size``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    stages = Stages(spark, "packing")
    rows = stages.write(pieces.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    classes = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``size`` rows
    counts = {int(r.length): int(r.n) for r in classes}
    held = spark.sparkContext.broadcast(plan(counts, size))

    buckets = max(1, -(-sum(counts.values()) // RANKED))
    split = rows.withColumn("_bucket", F.pmod(F.xxhash64("_at"), F.lit(buckets)))
    own = Window.partitionBy("length", "_bucket").orderBy("_at")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        split.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    )
    ranked = split.withColumn("_rank", F.row_number().over(own) - 1).join(base, ["length", "_bucket"])
    look = ranked.select(*pieces.columns, (F.col("_rank") + F.col("_base")).cast("long").alias("_rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def run(batches):
        table_ = held.value
        keys = table_[:, 0] * (1 << 44) + table_[:, 1]
        for part in batches:
            at = np.searchsorted(keys, part["length"].to_numpy() * (1 << 44) + part["_rank"].to_numpy(), side="right") - 1
            length, start, _, first, each, offset = table_[at].T
            k = part.pop("_rank").to_numpy() - start
            yield part.assign(sequence_id=first + k // each, offset=offset + k % each * length)

    return look.mapInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, length``: the ids of each sequence in order; ``packed`` must carry ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = pieces_of(docs, ["doc_id"], vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))
    return pack(pieces).select("record.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
