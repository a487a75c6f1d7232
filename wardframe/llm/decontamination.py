"""Benchmark decontamination: q-gram filtering on diagonal bands, then banded alignment.

Benchmark items and texts are folded (lower case, white space as single spaces). An item is cut into
segments of two kinds: adjoining ones of 80 to 159 characters, and overlapping ones of at most 60, so close
that every stretch of half the item (and of ``least`` characters) holds a whole one. A segment of m characters
may differ by e = floor(rate * m) edits. Any text region within that budget shares at least
m - q + 1 - q * e of the segment's q-grams (the q-gram lemma), all of them on diagonals at most e apart.

So each text is scanned once for q-grams of the benchmark; every hit falls on the diagonal (its place in
the text less its place in the segment), and hits are counted per segment and per band of 2e + 2
diagonals, bands overlapping by half. Bands that reach the bound are verified: an edit-distance
alignment of the segment against the band's stretch of text, free at both ends, kept if at most e.

The benchmark is read in blocks of at most about ``block_chars`` characters of segments, each broadcast and applied
to all texts, so the memory of a pass is bounded however large the benchmark is. Texts are not moved.

Items of fewer than ``least`` folded characters are no evidence and are left out. Null and empty texts
match nothing; null items are left out; repeated rows match alike; repeated item ids are one item.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardframe.llm.common import mix, per_row, table

Q, RATE, SEGMENT, SHORT, LEAST = 9, 0.08, 80, 60, 30
FILTER_BITS = 22


def fold(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def qgrams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of every q-gram, built by doubling."""
    n = len(points) - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base, wide, at = 0x9E3779B97F4A7C15, points.astype(np.uint64), 0
    width = 1
    out = None
    while width <= q:
        if q & width:
            piece = wide[at : at + n]
            factor = np.uint64(pow(base, width, 1 << 64))
            out = piece if out is None else out * factor + piece
            at += width
        if 2 * width <= q:
            wide = wide[:-width] * np.uint64(pow(base, width, 1 << 64)) + wide[width:]
        width *= 2
    return mix(out)


def overlapping(n: int, least: int = LEAST) -> tuple[int, int]:
    """Length and stride of an item's overlapping segments: a stretch of length + stride - 1 holds a whole one."""
    half = (n + 1) // 2
    length = min(max(half * 3 // 4, least), SHORT, n)
    return length, max(1, min(half - length + 1, length // 3))


def segments_of(text: str, length: int = SEGMENT, least: int = LEAST) -> list[str]:
    n, k = len(text), max(1, len(text) // length)
    short, stride = overlapping(n, least)
    cuts = [(n * i // k, n * (i + 1) // k) for i in range(k)] + [(at, at + short) for at in range(0, n - short + 1, stride)]
    return [text[a:b] for a, b in dict.fromkeys(cuts)]


def segment_chars(n: Column, least: int = LEAST) -> Column:
    """About the characters that the segments of an item of n characters have in all."""
    half = F.floor((n + 1) / 2)
    length = F.least(F.greatest(F.floor(half * 3 / 4), F.lit(least)), F.lit(SHORT), n)
    stride = F.greatest(F.lit(1), F.least(half - length + 1, F.floor(length / 3)))
    return n + length * (F.floor((n - length) / stride) + 1)


class Index:
    """Q-grams of one benchmark block: a bit filter, sorted hashes, and where each occurs."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE, least: int = LEAST):
        self.q = q
        self.segments, self.items, hashes, owner, place = [], [], [], [], []
        for item, text in items:
            folded = fold(text)
            for segment in segments_of(folded, least=least) if len(folded) >= least else []:
                grams = qgrams(code_points(segment), q)
                hashes.append(grams)
                owner.append(np.full(len(grams), len(self.segments), dtype=np.int64))
                place.append(np.arange(len(grams), dtype=np.int64))
                self.segments.append(segment)
                self.items.append(item)
        length = np.array([len(s) for s in self.segments], dtype=np.int64)
        self.budget = np.floor(rate * length).astype(np.int64)
        self.bound = np.maximum(length - q + 1 - q * self.budget, 1)
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.owner, self.place = (np.concatenate(x)[order] if x else np.empty(0, np.int64) for x in (owner, place))
        self.hashes, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, edits, place in the folded text) for each item that the text holds, by its best segment."""
        if not self.segments or not text:
            return []
        folded = fold(text)
        grams = qgrams(code_points(folded), self.q)
        at = np.flatnonzero(self.filter[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at):
            return []
        slot = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        true = self.hashes[slot] == grams[at]
        at, slot = at[true], slot[true]
        many = self.first[slot + 1] - self.first[slot]
        if not many.sum():
            return []
        index = np.repeat(self.first[slot] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        owner, diagonal = self.owner[index], np.repeat(at, many) - self.place[index]
        step = self.budget[owner] + 1
        half = (diagonal + len(folded) + 400) // step  # shifted so that it is never negative
        wide = 2 * (len(folded) + 1000)
        keys, counts = np.unique(owner * wide + half, return_counts=True)
        # A band is two neighbouring halves: a half is counted with the next one.
        following = np.searchsorted(keys, keys + 1)
        joint = following < len(keys)
        both = counts.copy()
        both[joint] += np.where(keys[np.minimum(following, len(keys) - 1)] == keys + 1, counts[np.minimum(following, len(keys) - 1)], 0)[joint]
        best: dict[int, tuple[int, int]] = {}
        for key in keys[both >= self.bound[keys // wide]]:
            own, band = divmod(int(key), wide)
            e, segment = int(self.budget[own]), self.segments[own]
            low = band * (e + 1) - len(folded) - 400
            start = max(0, low - e)
            region = folded[start : max(0, low + 2 * (e + 1) + len(segment) + e)]
            edits, end = align(segment, region, e)
            if edits <= e:
                found = (edits, start + end)
                best[self.items[own]] = min(best.get(self.items[own], found), found)
        return [(item, edits, end) for item, (edits, end) in sorted(best.items())]


def align(segment: str, region: str, most: int) -> tuple[int, int]:
    """Fewest edits between the segment and any part of the region, and where that part ends."""
    exact = region.find(segment)
    if exact >= 0:
        return 0, exact + len(segment)
    text, n = code_points(region), len(region)
    cells = np.arange(n + 1)
    row = np.zeros(n + 1, dtype=np.int64)
    for i, c in enumerate(code_points(segment), start=1):
        through = np.minimum(row[1:] + 1, row[:-1] + (text != c))
        row = np.concatenate([[i], through])
        row = np.minimum.accumulate(row - cells) + cells
        if row.min() > most:
            return most + 1, 0
    return int(row.min()), int(row.argmin())


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], rate: float = RATE, q: int = Q, least: int = LEAST, block_chars: int = 4_000_000) -> DataFrame:
    """The ``keep`` columns as ``record`` with ``matches``, an array of (item_id, edits, ends_at), maybe empty."""
    spark = docs.sparkSession
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("n"))
    total = items.agg(F.coalesce(F.sum(segment_chars(F.length("text"), least)), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-total // block_chars))
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text", F.array().cast("array<struct<item_id:bigint,edits:int,ends_at:bigint>>").alias("matches"))
    schema = slim.schema
    for block in range(blocks):  # a stated set of items against all rows, a bounded block at a time
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).select("item_id", "text").collect()
        held = spark.sparkContext.broadcast(Index(sorted((int(r.item_id), r.text) for r in own), q, rate, least))
        slim = slim.mapInPandas(_matching(held), schema)
    return slim.select("record", "text", "matches")


def _matching(held):
    def run(batches):
        def rows(part: pd.DataFrame) -> pd.DataFrame:
            found = [
                list(before) + [{"item_id": i, "edits": e, "ends_at": at} for i, e, at in held.value.matches(t if isinstance(t, str) else None)]
                for t, before in zip(part["text"], part["matches"])
            ]
            return part.assign(matches=found)

        return per_row(batches, rows)

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark passage."""
    columns = docs.columns
    found = benchmark_matches(docs, benchmark, [c for c in columns if c != "text"], **parameters)
    return found.where(F.size("matches") == 0).select(*[F.col("text") if c == "text" else F.col(f"record.`{c}`").alias(c) for c in columns])


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    found = benchmark_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("record.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.edits", "m.ends_at")
