"""N-gram Jaccard join over a token-group matrix, exact at its threshold.

A document's set is its distinct five-word shingles; two documents link when 100 * |x & y| >= 75 *
|x | y|. Links are found between sets (equal sets are one *node*), in two steps.

1. *Groups.* Nodes that share a sketch band become candidates of the band's busiest node, as stars;
   exact comparison keeps the true links, and their components are what need not be looked at again. The
   stars' families, linked or not, cut into chunks of bounded size, are the groups of similar documents.
2. *Matrix.* Every node's prefix (enough of its tokens in one global order that any two linked nodes
   share a prefix token) is laid out by token, and each token keeps the groups it occurs in, with
   their smallest and largest set. A node queries the groups that hold other components, whose sizes
   fit and that share as many prefix tokens as a link needs. Where they meet, the group's token union
   bounds the overlap; only groups that reach 75% of the query's own size are opened and compared set by set.

So a crowd of near copies costs stars and chunks, not pairs, and no link between components is
lost. The global order puts frequent tokens last (a bounded list of counts, broadcast); the list
changes the cost, never the result.

Texts without words have an empty set and link with nothing. Fewer than five words are one shingle.
Null ids take part in links; repeated rows are rows of one node. Sets are 64-bit hashes per shingle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardframe.llm.common import Stages, lower_words_of, per_row, run_hashes, signed, table, word_hashes
from wardframe.llm.components import components

WORDS = 5
BANDS, ROWS = 8, 3
FREQUENT = 200_000  # longest list of frequent tokens: 3.2 MB broadcast
CHUNK_SHINGLES = 150_000  # tokens per group or unit of comparison: 1.2 MB of hashes
LOCAL = 1 << 21  # tokens counted at once when looking for frequent ones
LENGTHS = 0.05  # classes of set sizes are 5% wide


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles."""
    words = lower_words_of(text)
    return np.unique(run_hashes(word_hashes(words), min(WORDS, len(words)))) if words else np.empty(0, np.uint64)


def node_of(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def needed(n):
    """Fewest tokens that a partner of a set of n must share with it."""
    return (3 * n + 3) // 4


def bands_of(tokens: np.ndarray) -> list[int]:
    """Hashes of bands; each takes the first tokens at or after equally spaced points of the hash range."""
    points = np.arange(BANDS * ROWS, dtype=np.uint64) * np.uint64(2**64 // (BANDS * ROWS))
    first = tokens[np.searchsorted(tokens, points) % len(tokens)].reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), seed=k) - (1 << 63) for k, row in enumerate(first)]


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = shared(x, y)
    return 100 * both >= 75 * (len(x) + len(y) - both)


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


# ---------------------------------------------------------------- passes over the texts

PROFILE = "key long, key2 long, doc_id long, n int, node long, bands array<long>, token long, times long"


def _profile(batches):
    """A row per document, and in between the tokens found in several documents of one stretch."""
    held, size = [], 0

    def frequent():
        values, times = np.unique(np.concatenate(held), return_counts=True)
        often = times >= 4
        return pd.DataFrame({"key": None, "key2": None, "doc_id": None, "n": None, "node": None, "bands": None, "token": signed(values[often]), "times": times[often]}).astype(
            {"key": "Int64", "key2": "Int64", "doc_id": "Int64", "n": "Int32", "node": "Int64", "token": "Int64", "times": "Int64"}
        )

    for part in per_row(batches, lambda p: p):
        sets = [shingles(t) for t in part["text"]]
        yield pd.DataFrame(
            {
                "key": part["key"].astype("Int64").array,
                "key2": part["key2"].astype("Int64").array,
                "doc_id": part["doc_id"].astype("Int64").array,
                "n": pd.array([len(s) for s in sets], dtype="Int32"),
                "node": pd.array([node_of(s) if len(s) else None for s in sets], dtype="Int64"),
                "bands": [bands_of(s) if len(s) else None for s in sets],
                "token": pd.array([None] * len(sets), dtype="Int64"),
                "times": pd.array([None] * len(sets), dtype="Int64"),
            }
        )
        held += sets
        size += sum(map(len, sets))
        if size > LOCAL:
            yield frequent()
            held, size = [], 0
    if size:
        yield frequent()


def _postings(frequent):
    """Prefix tokens: the tokens in order (frequency class, hash), as many as any link must touch."""

    def run(batches):
        tokens, classes = frequent.value
        for part in per_row(batches, lambda p: p, 2 << 20):
            out = []
            for text in part["text"]:
                s = shingles(text)
                n = len(s)
                if not n:
                    continue
                p = n - needed(n) + 1
                node = node_of(s)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    rank = np.where(tokens[at] == s, classes[at], 0)
                    s = s[np.argsort(rank, kind="stable")]
                out.append((s[:p], node, n))
            if out:
                sizes = [len(x[0]) for x in out]
                yield pd.DataFrame(
                    {
                        "token": signed(np.concatenate([x[0] for x in out])),
                        "node": np.repeat(np.array([x[1] for x in out], dtype=np.int64), sizes),
                        "n": np.repeat(np.array([x[2] for x in out], dtype=np.int32), sizes),
                    }
                )

    return run


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, tokens`` of wanted nodes (node, doc_id), read from one document of each."""
    at = wanted.select(F.col("doc_id").alias("w"), F.col("node"))
    # Null ids meet null ids; the set computed from the text decides whether it is the one wanted. A merge
    # join at every size: the wanted nodes grow with the corpus.
    texts = docs.join(at.hint("merge"), F.col("doc_id").eqNullSafe(F.col("w"))).select("text", "node")

    def run(batches):
        for part in per_row(batches, lambda p: p):
            sets = [shingles(t) for t in part["text"]]
            keep = [len(s) > 0 and node_of(s) == w for s, w in zip(sets, part["node"])]
            yield pd.DataFrame({"node": part["node"][keep].array, "tokens": [s.tobytes() for s, k in zip(sets, keep) if k]})

    return texts.mapInPandas(run, "node long, tokens binary")


def _by_unit(batches, keys: list[str]):
    """Rows of one unit after another; rows arrive sorted by unit, and a unit is bounded."""
    last, rows = None, []
    for batch in batches:
        for row in batch.itertuples(index=False):
            unit = tuple(getattr(row, k) for k in keys)
            if unit != last and rows:
                yield last, rows
                rows = []
            last = unit
            rows.append((row.node, row.query, np.frombuffer(row.tokens, dtype=np.uint64), getattr(row, "comp", None)))
    if rows:
        yield last, rows


def _check_stars(batches):
    """Members of a unit against its one query, the star's centre."""
    for (centre, _), rows in _by_unit(batches, ["centre", "part"]):
        middle = next((r[2] for r in rows if r[1]), None)
        if middle is None:
            continue
        found = [r[0] for r in rows if not r[1] and linked(middle, r[2])]
        if found:
            yield pd.DataFrame({"a": centre, "b": found}).astype("int64")


def _open_groups(batches):
    """Queries of a unit against its group: the union bounds the overlap, then sets decide."""
    for _, rows in _by_unit(batches, ["family", "chunk", "part"]):
        group = [r for r in rows if not r[1]]
        queries = [r for r in rows if r[1]]
        if not group or not queries:
            continue
        flat = np.concatenate([r[2] for r in group])
        sizes = np.array([len(r[2]) for r in group])
        owner = np.repeat(np.arange(len(group)), sizes)
        nodes, comps = (np.array([r[k] for r in group]) for k in (0, 3))
        union = np.unique(flat)
        found = []
        for node, _, tokens, comp in queries:
            n = len(tokens)
            if shared(tokens, union) < needed(n):
                continue
            at = np.searchsorted(tokens, flat)
            at[at == n] = 0
            both = np.bincount(owner[tokens[at] == flat], minlength=len(group))
            hit = np.flatnonzero((100 * both >= 75 * (n + sizes - both)) & (comps != comp))
            _, first = np.unique(comps[hit], return_index=True)  # one link joins a whole component
            found += [(node, m) for m in nodes[hit[first]].tolist()]
        if found:
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")


# ---------------------------------------------------------------- the join


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``key, key2, doc_id, n_shingles, root, component_id`` for every row of ``docs``.

    ``root`` names the component (null for an empty set, which links with nothing), ``component_id`` is
    the smallest id in it. The keys (see ``_keys``) are the same for rows with equal id and text.
    """
    spark = docs.sparkSession
    docs = docs.select(*_keys("doc_id"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    stages = Stages(spark, "ngram-join")
    profile = stages.write(docs.mapInPandas(_profile, PROFILE), "profile")
    rows = profile.where("token IS NULL")
    nodes = stages.write(
        rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.min("bands").alias("bands")),
        "nodes",
    )
    stars, families = _star_links(docs, nodes, stages)
    stars = stages.write(stars, "stars")
    grouped = stages.write(_groups(nodes, components(stars, stages, "groups"), families), "grouped")

    frequent = _frequent(spark, profile)
    crossing = stages.write(_candidates(docs, grouped, frequent, stages), "candidates")
    links = stages.write(_cross_links(docs, grouped, crossing, stages), "links")

    # Components of components: the second step's links join whole groups.
    roots = grouped.select("node", "comp")
    ends = links.join(roots.toDF("a", "ca"), "a").join(roots.toDF("b", "cb"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    over = components(ends, stages, "whole").toDF("comp", "root")
    placed = grouped.join(over, "comp", "left").select("node", "doc_id", F.coalesce("root", "comp").alias("root"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    final = placed.join(least, "root").select("node", "root", "component_id")
    return rows.join(final, "node", "left").select(
        "key", "key2", "doc_id", F.col("n").cast("long").alias("n_shingles"), "root", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _keys(doc_id: str) -> list[Column]:
    """Two hashes of id and text, NULL told from every value: what a row is known by in another scan."""
    known = [F.col(doc_id).cast("long"), F.col(doc_id).isNull(), F.col("text"), F.col("text").isNull()]
    return [F.xxhash64(F.lit(1), *known).alias("key"), F.xxhash64(F.lit(2), *known).alias("key2")]


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one of each component: that of the smallest id, null ids
    last. Rows with an empty set all stay. Rows with equal id and text are one row."""
    comps = jaccard_components(docs)
    best = comps.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key", "key2")).alias("b"))
    kept = best.select("b.key", "b.key2").unionByName(comps.where("root IS NULL").select("key", "key2").distinct())
    kept = Stages(docs.sparkSession, "one-of-each").write(kept.toDF("_key", "_key2"), "kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), *[k.alias(f"_{n}") for k, n in zip(_keys("doc_id"), ("key", "key2"))])
    return rows.join(kept.hint("merge"), ["_key", "_key2"], "left_semi").dropDuplicates(["_key", "_key2"]).select("record.*")


def _star_links(docs: DataFrame, nodes: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Links of members to centres, and the family (busiest centre) of every member."""
    banded = nodes.select("node", "n", F.explode("bands").alias("band"))
    shared_bands = banded.groupBy("band").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    banded = stages.write(banded.join(shared_bands, "band"), "banded")
    # The centre of a band is the node that meets most others over all its bands: copies that differ
    # from each other in two places differ from what they were copied from in one.
    degree = banded.groupBy("node").agg(F.sum("k").alias("degree"))
    ranked = banded.join(degree, "node")
    centres = ranked.groupBy("band").agg(F.max(F.struct("degree", "node", "n")).alias("c")).select("band", F.col("c.node").alias("centre"), F.col("c.n").alias("cn"), F.col("c.degree").alias("degree"))
    pairs = (
        banded.join(centres, "band")
        .where("node <> centre AND 4 * least(n, cn) >= 3 * greatest(n, cn)")
        .select("centre", "degree", "node", "n").distinct()
    )
    pairs = stages.write(pairs, "pairs")
    parts = pairs.groupBy("centre").agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("parts"))
    members = pairs.join(parts, "centre").select("centre", F.pmod(F.hash("node"), "parts").alias("part"), "node", F.lit(False).alias("query"))
    middles = members.select("centre", "part").distinct().select("centre", "part", F.col("centre").alias("node"), F.lit(True).alias("query"))
    units = stages.write(members.unionByName(middles), "star-units")
    families = pairs.groupBy("node").agg(F.max_by("centre", F.struct("degree", "centre")).alias("family"))
    return _compared(docs, nodes, units, ["centre", "part"], _check_stars, stages, "star-nodes"), families


def _compared(docs: DataFrame, nodes: DataFrame, units: DataFrame, keys: list[str], check, stages: Stages, name: str) -> DataFrame:
    wanted = stages.write(units.select("node").distinct().join(nodes.select("node", "doc_id"), "node"), name)
    return units.join(_sets(docs, wanted), "node").repartition(*keys).sortWithinPartitions(*keys).mapInPandas(check, "a long, b long")


def _groups(nodes: DataFrame, comps: DataFrame, families: DataFrame) -> DataFrame:
    """Every node with its component and its size, its family and its chunk of the family."""
    placed = nodes.select("node", "doc_id", "n").join(comps, "node", "left").join(families, "node", "left")
    placed = placed.select("node", "doc_id", "n", F.coalesce("root", "node").alias("comp"), F.coalesce("family", "node").alias("family"))
    sizes = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    chunks = placed.groupBy("family").agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    return placed.join(sizes, "comp").join(chunks, "family").select("node", "doc_id", "n", "comp", "size", "family", F.pmod(F.hash("node"), "chunks").alias("chunk"))


def _frequent(spark: SparkSession, profile: DataFrame):
    """The most frequent tokens with their frequency class: at most FREQUENT, so of bounded size."""
    top = (
        profile.where("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "token").limit(FREQUENT).toPandas()
    )
    tokens = top["token"].to_numpy(dtype=np.int64).view(np.uint64)
    classes = np.log2(top["times"].to_numpy(dtype=float)).astype(np.int8) if len(top) else np.empty(0, np.int8)
    order = np.argsort(tokens)
    return spark.sparkContext.broadcast((tokens[order], classes[order]))


def _candidates(docs: DataFrame, grouped: DataFrame, frequent, stages: Stages) -> DataFrame:
    """``query`` nodes with the groups (comp, chunk) whose matrix row they must look at."""
    postings = docs.select("text").mapInPandas(_postings(frequent), "token long, node long, n int")
    # One pass over each token's rows: tokens of a single node end here, which are nearly all.
    every = Window.partitionBy("token")
    common = (
        postings.withColumn("lo", F.min("node").over(every)).withColumn("hi", F.max("node").over(every))
        .where("lo <> hi").dropDuplicates(["token", "node"]).drop("lo", "hi")
    )
    placed = stages.write(common.join(grouped.select("node", "comp", "size", "family", "chunk"), "node"), "matrix")
    mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    placed = stages.write(placed.join(mixed, "token").withColumn("length", F.floor(F.log(F.col("n").cast("double")) / LENGTHS).cast("int")), "mixed")

    # Sets of n and m tokens link only if they share 3/7 (n + m), of which at most 3/4 max(n, m) lie
    # behind the prefixes; so the prefixes share (12 min - 9 max + 7) / 28 tokens at least. Over a range
    # of m that is least at one of its ends.
    enough = "28 * k >= least(12 * low - 9 * n, 12 * n - 9 * high) + 7"
    fits = "4 * high >= 3 * n AND 3 * low <= 4 * n"

    # First per node and class of lengths, which is linear: are there enough tokens at all that sets of
    # such lengths in other components have in their prefixes?
    lengths = placed.groupBy("token", F.col("length").alias("g_length")).agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("low"), F.max("n").alias("high")
    )
    reach = (
        placed.join(lengths, "token").where(fits).where("lo <> hi OR lo <> comp")
        .groupBy("node", "n", "g_length").agg(F.count(F.lit(1)).alias("k"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where(enough).select("node", "g_length")
    )
    asking = stages.write(placed.join(reach, "node"), "asking")
    matrix = placed.groupBy("token", F.col("length").alias("g_length"), F.col("family").alias("g_family"), F.col("chunk").alias("g_chunk")).agg(
        F.max(F.struct("size", "comp")).alias("g_top"), F.min("n").alias("low"), F.max("n").alias("high")
    )
    return (
        asking.join(matrix, ["token", "g_length"])
        .where("struct(size, comp) < g_top")  # the smaller component asks the larger
        .where(fits)
        .groupBy(F.col("node").alias("query"), "n", "comp", F.col("g_family").alias("family"), F.col("g_chunk").alias("chunk"), "g_length")
        .agg(F.count(F.lit(1)).alias("k"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where(enough).select("query", "n", "comp", "family", "chunk").distinct()
    )


def _cross_links(docs: DataFrame, grouped: DataFrame, crossing: DataFrame, stages: Stages) -> DataFrame:
    keys = ["family", "chunk"]
    parts = crossing.groupBy(*keys).agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("parts"))
    asking = crossing.join(parts, keys).select(*keys, F.pmod(F.hash("query"), "parts").alias("part"), F.col("query").alias("node"), "comp", F.lit(True).alias("query"))
    asked = asking.select(*keys, "part").distinct().join(grouped.select(*keys, "node", "comp"), keys).select(*keys, "part", "node", "comp", F.lit(False).alias("query"))
    units = stages.write(asking.unionByName(asked), "units")
    return _compared(docs, grouped, units, [*keys, "part"], _open_groups, stages, "group-nodes")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


#: The same by definition: overlaps counted from shared shingles, then the closure over links.
OP5_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM words WHERE len(w) > 0
), shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 4], ' ') AS g FROM places
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common_count AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT o.x, o.y FROM common_count o JOIN sizes p ON p.doc_id = o.x JOIN sizes q ON q.doc_id = o.y
  WHERE 100 * o.k >= 75 * (p.n + q.n - o.k)
), reach AS (
  SELECT DISTINCT x AS doc_id, x AS r FROM links
  UNION
  SELECT l.y, t.r FROM reach t JOIN links l ON l.x = t.doc_id WHERE t.r < l.y
), least AS (
  SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(t.r, d.doc_id)) AS component_id
FROM words d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least t ON t.doc_id = d.doc_id
"""
