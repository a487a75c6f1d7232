"""Removal of repeated passages by anchored window hashing, in place of suffix trees.

A suffix of a document is its words from one position on. Two suffixes that agree on ``window`` words
would share a node of a suffix tree at that depth, and only that depth is asked for; so no tree is
built, and nodes are hashes of windows. The suffixes are split at two fixed depths:

* The first cut takes ``gram``-word prefixes, and only of suffixes at *anchors*: the position in each
  window whose gram has the smallest hash. Equal windows have equal anchors, so this sparse set (about
  one position in seven) meets at every repeat. Prefixes that occur once are leaves: nearly all.
* Windows below a prefix that occurs again are cut further, at their full depth. A stretch of at most
  four million windows is sorted at a time in a task; of each node it sends on the first suffix only
  and marks the later ones itself, so a passage that a third of all documents share costs one row
  per stretch. The rest of the subtrees meet by node, and all but the first suffix of a node are marked.

A document whose words are those of an earlier one loses them all and stays out of the trees.

Each word covered by a marked window goes. Windows are judged on the input. Order is doc_id (null
first), then start; rows with equal doc_id and start are not earlier than each other, so repeated rows
get equal results. Null and empty texts have no words and lose none. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardframe.llm.common import Stages, mix, per_row, run_hashes, signed, table, word_hashes, words_of

WINDOW, GRAM = 20, 8
STRETCH = 4 << 20  # windows sorted at a time in a task: 100 MB
PLACE = np.uint64((1 << 28) - 1)  # low bits that hold a position; a text has at most 2**28 words
NULL_ID = -(1 << 63)


def anchors_of(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes of a text, and for each window the position of its anchor."""
    grams = run_hashes(hashes, gram)
    if len(hashes) < window:
        return grams, np.empty(0, np.int64)
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    span, width = window - gram + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    return grams, (least & PLACE).astype(np.int64)


def covered_words(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _find_anchors(window: int, gram: int):
    def rows(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in part["text"]:
            words = words_of(text)
            if len(words) < window:
                out.append((len(words), _digest(words), [], []))
                continue
            grams, places = anchors_of(word_hashes(words), window, gram)
            places = np.unique(places)
            out.append((len(words), _digest(words), signed(grams[places]), places.astype(np.int32)))
        return pd.DataFrame(out, columns=["n_words", "sha256", "anchors", "places"], index=part.index).assign(doc_id=part["doc_id"].astype("Int64"), th=part["th"])[
            ["doc_id", "th", "n_words", "sha256", "anchors", "places"]
        ]

    return lambda batches: per_row(batches, rows)


def _find_windows(window: int, gram: int):
    """Windows whose anchor recurs; of each node the stretch's first suffix, and marks for the others."""

    def flush(held):
        docs, sizes = [h[:2] for h in held], [len(h[2]) for h in held]
        node, start = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
        ids = np.repeat(np.array([d[0] for d in docs], dtype=np.int64), sizes)
        rid = np.repeat(np.array([d[1] for d in docs], dtype=np.int64), sizes)
        order = np.lexsort((start, ids, node))
        node, start, ids, rid = node[order], start[order], ids[order], rid[order]
        new = np.ones(len(node), dtype=bool)
        new[1:] = node[1:] != node[:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(node)), 0))
        later = (ids != ids[head]) | (start != start[head])
        send = ~later  # the first, and any equal to it
        for at in range(0, int(send.sum()), 1 << 18):
            pick = np.flatnonzero(send)[at : at + (1 << 18)]
            yield pd.DataFrame({"node": node[pick].view(np.int64), "doc_id": ids[pick], "rid": rid[pick], "start": start[pick], "marked": None})
        where = np.flatnonzero(later)
        where = where[np.argsort(rid[where], kind="stable")]
        if len(where):
            own, first = np.unique(rid[where], return_index=True)
            marks = np.split(start[where], first[1:])
            keys = mix(own.view(np.uint64)).view(np.int64)  # spreads them; marks are no node
            yield pd.DataFrame({"node": keys, "doc_id": NULL_ID, "rid": own, "start": np.int32(-1), "marked": marks})

    def run(batches):
        held, size = [], 0
        for part in per_row(batches, lambda p: p):
            for doc_id, rid, text, places in zip(part["doc_id"], part["rid"], part["text"], part["places"]):
                hashes = word_hashes(words_of(text))
                _, anchor = anchors_of(hashes, window, gram)
                again = np.zeros(len(hashes) + 1, dtype=bool)
                again[np.asarray(places)] = True
                starts = np.flatnonzero(again[anchor]).astype(np.int32)
                held.append((NULL_ID if pd.isna(doc_id) else int(doc_id), rid, run_hashes(hashes, window)[starts], starts))
                size += len(starts)
                if size > STRETCH:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    return run


def _cut(window: int):
    """Texts without their marked words; texts that lose none stay as they are."""

    def rows(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text, starts in zip(part["text"], part["starts"]):
            if starts is None or not len(starts):
                out.append((text, 0, None))
                continue
            words = words_of(text)
            gone = covered_words(len(words), np.asarray(starts, dtype=np.int64), window)
            kept = [w for w, g in zip(words, gone) if not g]
            out.append((b" ".join(kept).decode("utf-8", "surrogatepass"), int(gone.sum()), _digest(kept)))
        result = pd.DataFrame(out, columns=["kept_text", "n_removed", "sha256"], index=part.index)
        return pd.concat([part.drop(columns=["text", "starts"]), result], axis=1)

    return lambda batches: per_row(batches, rows)


def _keyed(docs: DataFrame) -> DataFrame:
    """A row is known by its id and its text's hash: ids may repeat or be null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def repeated_windows(docs: DataFrame, stages: Stages, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``base`` (every row: doc_id, th, n_words, sha256, copy), ``held`` (rows that may lose words, with text
    and ``rid``) and ``marks`` (rid, starts: the windows of that row that occur earlier).

    ``copy`` rows have the words of an earlier document, all of them: they lose every word, and need no tree.
    """
    keyed = _keyed(docs)
    base = stages.write(
        keyed.mapInPandas(_find_anchors(window, gram), "doc_id long, th long, n_words long, sha256 string, anchors array<long>, places array<int>")
        .withColumn("row", F.monotonically_increasing_id()).withColumn("at", F.coalesce("doc_id", F.lit(NULL_ID))),
        "anchors",
    )
    long_enough = base.where(F.col("n_words") >= window)
    first = long_enough.groupBy("sha256").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1")
    copies = stages.write(long_enough.select("row", "at", "sha256").join(first, "sha256").where("at > first").select("row"), "copies")
    suffixes = (
        base.join(copies, "row", "left_anti")
        .select("row", F.explode(F.arrays_zip("anchors", "places")).alias("a")).select("row", F.col("a.anchors").alias("prefix"), F.col("a.places").alias("place"))
    )
    again = suffixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("prefix")
    recurring = suffixes.join(again, "prefix").groupBy("row").agg(F.collect_list("place").alias("places"))
    wanted = (
        recurring.join(base.select("row", "doc_id", "th"), "row").dropDuplicates(["doc_id", "th"])
        .select(F.col("doc_id").alias("w"), F.col("th").alias("wth"), "places")
    )
    held = stages.write(
        keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("w")) & (F.col("th") == F.col("wth")))
        .select("doc_id", "th", "text", "places").withColumn("rid", F.monotonically_increasing_id()),
        "held",
    )
    nodes = held.select("doc_id", "rid", "text", "places").mapInPandas(
        _find_windows(window, gram), "node long, doc_id long, rid long, start int, marked array<int>"
    )
    first = Window.partitionBy("loose", "node").orderBy("doc_id", "start").rowsBetween(Window.unboundedPreceding, 0)
    later = (
        nodes.withColumn("loose", F.col("marked").isNotNull())
        .withColumn("f_doc", F.first("doc_id").over(first)).withColumn("f_start", F.first("start").over(first))
        .where("loose OR doc_id <> f_doc OR start <> f_start")
        .groupBy("rid").agg(F.collect_list(F.when(~F.col("loose"), F.col("start"))).alias("own"), F.flatten(F.collect_list("marked")).alias("marked"))
        .select("rid", F.concat("own", "marked").alias("starts"))
    )
    marks = stages.write(later, "marks")
    flagged = base.join(copies.withColumn("copy", F.lit(True)), "row", "left")
    return flagged.select("doc_id", "th", "n_words", "sha256", F.coalesce("copy", F.lit(False)).alias("copy")), held, marks


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Every row as ``record`` (its columns but the text) with ``kept_text``, its text without the words of
    repeated windows, and ``n_removed``."""
    stages = Stages(docs.sparkSession, "substring")
    base, held, marks = repeated_windows(docs, stages, window, gram)
    every = F.expr(f"array_append(sequence(0, n_words - {window}, {window}), n_words - {window})").cast("array<int>")
    starts = held.select("doc_id", "th", "rid").join(marks, "rid").select("doc_id", "th", "starts")
    starts = starts.unionByName(base.where("copy").select("doc_id", "th", every.alias("starts"))).dropDuplicates(["doc_id", "th"])
    starts = starts.select(F.col("doc_id").alias("w"), F.col("th").alias("wth"), "starts")
    record = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("record"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    joined = record.join(starts, F.col("doc_id").eqNullSafe(F.col("w")) & (F.col("th") == F.col("wth")), "left").select("record", "text", "starts")
    return joined.mapInPandas(_cut(window), f"record {joined.schema['record'].dataType.simpleString()}, kept_text string, n_removed long, sha256 string").drop("sha256")


def removed_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row."""
    stages = Stages(docs.sparkSession, "substring")
    base, held, marks = repeated_windows(docs, stages, window, gram)
    cut = (
        held.select("rid", "doc_id", "th", "text").join(marks, "rid").select("doc_id", "th", "text", "starts")
        .mapInPandas(_cut(window), "doc_id long, th long, kept_text string, n_removed long, sha256 string")
        .dropDuplicates(["doc_id", "th"])
        .select(F.col("doc_id").alias("w"), F.col("th").alias("wth"), "n_removed", F.col("sha256").alias("cut_sha256"))
    )
    joined = base.join(cut, F.col("doc_id").eqNullSafe(F.col("w")) & (F.col("th") == F.col("wth")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(_digest([]))).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_words(table(spark, sf_dir, "documents"))


#: The same by definition: every 20-word window with its place, the first place of each, and the cover.
OP2_SQL = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20
), windows AS MATERIALIZED (
  SELECT doc_id, s, md5(array_to_string(w[s : s + 19], ' ')) AS k FROM starts
), later AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows
  ) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS p FROM later
), each_word AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.p) AS t, count(*) AS n
  FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
