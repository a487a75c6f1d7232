"""Ranked lexical search over a term-document grid held in K2-treaps.

The index is a table of blocks of documents. A block's grid has a row per term (frequent ones first) and a
column per document (by ascending id); the point of a term in a document carries its impact, the part of the
score that depends on the two alone. The grid is cut into quadtree cells; where one side runs out of bits, or
below ``BOTTOM`` levels of documents, a cell splits on the other side only. A node keeps a mask of its four children and
how far the cell's highest impact lies below its parent's, in level order, so that children are found by counting bits.

A query descends best-first over ranges of documents: for each of its terms it holds the node on the path to the term's
row, and weight times the node's highest impact, summed over the terms, bounds every document of the range. The
ranges of highest bound are split first, those of many queries at once; a range whose bound is below a query's
20th score so far, or equal to it with later ids only, is not opened. The scores found in one block hold in the
next blocks of the task. So results are exact.

Counts are of all documents. Queries are worked on in chunks of a bounded size, each sent to all tasks; the highest rows
of every task meet in a window per query.

Documents without a term, null texts among them, count nowhere and are never found; so are queries without terms. Null ids
come after all others among equal scores; repeated rows are documents of their own and each gets a rank. Equal rows of
queries are one query; rows that share an id but not the text are ranked apart. A very long text is one column and
its block may be larger than others. Empty tables give no rows. Other columns of either table are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardframe.llm.common import Stages, table

FOUND = 20
BLOCK_POINTS = 1_000_000  # (term, document) points of a block, and more only if one document has them
BOTTOM = 6  # levels that split documents only: ranges of up to 2**BOTTOM documents have impacts of single terms
OPENED = 16  # ranges of a query that are split at once
CHUNK_BYTES = 8 << 20  # text of a chunk of queries, by a hash of the query: a mean

#: Bytes that belong to a term: letters, digits, and all of characters from U+0080 on. A-Z become small, the rest a space.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

BITS = np.array([bin(k).count("1") for k in range(16)], np.int64)
LAST = np.iinfo(np.int64).max  # stands for a null id


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERMS).split()


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """The part of the score of a term that occurs ``tf`` times in a document of ``n`` terms."""
    m = 100 - 25 + (25 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# ---------------------------------------------------------------- the tree


def levels(n_rows: int, n_docs: int) -> list[tuple[int, int]]:
    """Per level, whether it splits rows and whether it splits documents."""
    row_bits, doc_bits = max(n_rows - 1, 0).bit_length(), max(n_docs - 1, 0).bit_length()
    bottom = min(BOTTOM, doc_bits)
    both = min(row_bits, doc_bits - bottom)
    return [(1, 0)] * (row_bits - both) + [(0, 1)] * (doc_bits - bottom - both) + [(1, 1)] * both + [(0, 1)] * bottom


def build(row: np.ndarray, doc: np.ndarray, value: np.ndarray, n_rows: int, n_docs: int) -> bytes:
    """The tree of a grid with at least one point; (row, doc) are distinct and values above 0."""
    plan = levels(n_rows, n_docs)
    code = np.zeros(len(row), np.int64)
    row_left, doc_left = sum(r for r, _ in plan), sum(d for _, d in plan)
    for splits_rows, splits_docs in plan:
        row_left, doc_left = row_left - splits_rows, doc_left - splits_docs
        quarter = 2 * ((row >> row_left) & 1) * splits_rows + ((doc >> doc_left) & 1) * splits_docs
        code = code * 4 + quarter
    order = np.argsort(code, kind="stable")
    code, high = code[order], value[order].astype(np.int64)
    masks, lower = [], []
    for _ in plan:
        parent = code >> 2
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        top = np.maximum.reduceat(high, first)
        masks.append(np.bitwise_or.reduceat((1 << (code & 3)).astype(np.uint8), first))
        lower.append((np.repeat(top, np.diff(np.append(first, len(high)))) - high).astype("<u4"))
        code, high = parent[first], top
    masks, lower = np.concatenate([np.empty(0, np.uint8), *masks[::-1]]), np.concatenate([np.empty(0, "<u4"), *lower[::-1]])
    head = np.array([n_rows, n_docs, high[0], len(masks)], "<i8")
    return head.tobytes() + masks.tobytes() + lower.tobytes()


@dataclass
class Tree:
    """Nodes in level order; those of the last level are points and have no mask."""

    masks: np.ndarray
    first: np.ndarray  # first child
    high: np.ndarray
    rows_split: np.ndarray  # per level
    docs_split: np.ndarray
    row_shift: np.ndarray  # bits of the row below each level
    doc_shift: np.ndarray  # bits of the document below each level and above its own split


def opened(packed: bytes) -> Tree:
    n_rows, n_docs, top, n_masks = np.frombuffer(packed, "<i8", 4).tolist()
    masks = np.frombuffer(packed, np.uint8, n_masks, 32)
    lower = np.frombuffer(packed, "<u4", -1, 32 + n_masks)
    children = BITS[masks]
    first = (1 + np.cumsum(children) - children).astype(np.int64)
    high = np.empty(1 + len(lower), np.int64)
    high[0] = top
    plan, at, end = levels(n_rows, n_docs), 0, 1
    for _ in plan:
        below = int(children[at:end].sum())
        high[end : end + below] = np.repeat(high[at:end], children[at:end]) - lower[end - 1 : end - 1 + below]
        at, end = end, end + below
    rows_split, docs_split = (np.array([x[k] for x in plan], np.int64) for k in (0, 1))
    return Tree(masks, first, high, rows_split, docs_split, rows_split.sum() - np.cumsum(rows_split), docs_split.sum() - np.cumsum(docs_split))


@dataclass
class Best:
    """The highest rows of each query so far."""

    query: np.ndarray
    score: np.ndarray
    id: np.ndarray

    @classmethod
    def empty(cls) -> Best:
        return cls(*(np.empty(0, np.int64) for _ in range(3)))

    def add(self, query, score, id_, most: int) -> Best:
        query, score, id_ = np.append(self.query, query), np.append(self.score, score), np.append(self.id, id_)
        order = np.lexsort((id_, -score, query))
        query, score, id_ = query[order], score[order], id_[order]
        keep = _rank(query) < most
        return Best(query[keep], score[keep], id_[keep])

    def bar(self, queries: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the last of a full list; (0, last id) for others."""
        score, id_ = np.zeros(queries, np.int64), np.full(queries, LAST)
        full = np.flatnonzero(_rank(self.query) == most - 1)
        score[self.query[full]], id_[self.query[full]] = self.score[full], self.id[full]
        return score, id_


def _rank(groups: np.ndarray) -> np.ndarray:
    """Position of each element within its run of equal ones."""
    at = np.arange(len(groups))
    start = np.append(True, groups[1:] != groups[:-1]) if len(groups) else np.empty(0, bool)
    return at - np.maximum.accumulate(np.where(start, at, 0)) if len(groups) else at


def _spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ... (n[0] of them), lo[1], ..."""
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def search(tree: Tree, ids: np.ndarray, query: np.ndarray, row: np.ndarray, own_weight: np.ndarray, best: Best, queries: int, most: int) -> Best:
    """``best`` with what this block adds. (query, row, own_weight): the terms that the block has, by query.

    ``ids`` are the documents' by column, ascending.
    """
    n_levels = len(tree.rows_split)
    asked, n = np.unique(query, return_counts=True)
    # A range of documents: its query, bound, level and column prefix, and where its nodes lie in `node`/`term`.
    node, term = [np.zeros(len(row), np.int64)], [np.arange(len(row))]
    held, lo = len(row), np.cumsum(n) - n
    bound = tree.high[0] * np.add.reduceat(own_weight, lo) if len(row) else np.empty(0, np.int64)
    pool = np.stack([asked, bound, np.zeros_like(asked), np.zeros_like(asked), lo, n]) if len(row) else np.empty((6, 0), np.int64)
    score_bar, id_bar = best.bar(queries, most)
    all_nodes, all_terms = node[0], term[0]

    def promising(q, b, level, column) -> np.ndarray:
        shift = tree.docs_split.sum() - np.append(0, np.cumsum(tree.docs_split))[level]
        first_id = ids[column << shift]
        return (b > 0) & ((b > score_bar[q]) | ((b == score_bar[q]) & (first_id < id_bar[q])))

    while True:
        pool = pool[:, promising(*pool[:4])]
        if not pool.shape[1]:
            return best
        pool = pool[:, np.lexsort((-pool[1], pool[0]))]
        now = _rank(pool[0]) < OPENED
        q, _, level, column, lo, n = pool[:, now]
        pool = pool[:, ~now]
        if n_levels == 0:  # a single row and document
            return best.add(q, tree.high[0] * np.bincount(query, own_weight, queries)[q].astype(np.int64), ids[column], most)
        at, of = _spread(lo, n), np.repeat(np.arange(len(n)), n)
        own_node, own_term, own_level = all_nodes[at], all_terms[at], np.repeat(level, n)
        half = 2 * ((row[own_term] >> tree.row_shift[own_level]) & 1) * tree.rows_split[own_level]
        mask = tree.masks[own_node].astype(np.int64)
        grown = []
        for right in (0, 1):
            has = np.flatnonzero((mask >> (half + right)) & 1)
            if not len(has):
                continue
            child = tree.first[own_node[has]] + BITS[mask[has] & ((1 << (half[has] + right)) - 1)]
            start = np.flatnonzero(np.append(True, np.diff(of[has]) != 0))
            parent = of[has][start]
            bound = np.add.reduceat(tree.high[child] * own_weight[own_term[has]], start)
            count = np.diff(np.append(start, len(has)))
            below, to = level[parent] + 1, column[parent]
            to = np.where(tree.docs_split[level[parent]] == 1, 2 * to + right, to)
            good = promising(q[parent], bound, below, to)
            last = good & (below == n_levels)
            if last.any():
                best = best.add(q[parent[last]], bound[last], ids[to[last]], most)
            good &= below < n_levels
            kept = np.repeat(good, count)
            grown.append((np.stack([q[parent], bound, below, to, np.zeros_like(to), count])[:, good], child[kept], own_term[has][kept]))
        score_bar, id_bar = best.bar(queries, most)
        # What is left of the pool keeps its nodes; those of ranges that were split are no longer needed.
        rest = _spread(pool[4], pool[5])
        pool = np.concatenate([pool, *[g[0] for g in grown]], axis=1)
        all_nodes = np.concatenate([all_nodes[rest], *[g[1] for g in grown]])
        all_terms = np.concatenate([all_terms[rest], *[g[2] for g in grown]])
        pool[4] = np.cumsum(pool[5]) - pool[5]


# ---------------------------------------------------------------- the index


class _Numbers(dict):
    """Numbers terms as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


class _Block:
    """Documents of a block while it is gathered."""

    def __init__(self):
        self.numbers, self.ids, self.n, self.points = _Numbers(), [], [], 0
        self.rows, self.tfs = [], []

    def add(self, doc_id: int | None, terms: list[bytes]) -> None:
        rows, tf = np.unique(np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms)), return_counts=True)
        self.ids.append(LAST if doc_id is None else doc_id)
        self.n.append(len(terms))
        self.rows.append(rows)
        self.tfs.append(tf)
        self.points += len(rows)

    def packed(self, squeeze) -> tuple:
        """Terms by falling frequency, documents by id, points by (term, document)."""
        names = list(self.numbers)
        row, tf = np.concatenate(self.rows), np.concatenate(self.tfs)
        doc = np.repeat(np.arange(len(self.ids)), list(map(len, self.rows)))
        df = np.bincount(row, minlength=len(names))
        by_df = sorted(range(len(names)), key=lambda k: (-df[k], names[k]))
        place = np.empty(len(names), np.int64)
        place[by_df] = np.arange(len(names))
        by_id = np.argsort(np.array(self.ids, np.int64), kind="stable")
        column = np.empty(len(by_id), np.int64)
        column[by_id] = np.arange(len(by_id))
        row, doc = place[row], column[doc]
        order = np.lexsort((doc, row))
        doc, df = doc[order], df[by_df]
        # Documents as steps within a term's row: small numbers squeeze well.
        step = np.diff(doc, prepend=0)
        step[np.cumsum(df)[:-1]] = doc[np.cumsum(df)[:-1]]
        return (
            np.array(self.ids, "<i8")[by_id].tobytes(), np.array(self.n, "<i8")[by_id].tobytes(), len(self.ids), sum(self.n),
            squeeze(b" ".join(names[k] for k in by_df)), squeeze(df.astype("<i4").tobytes()),
            squeeze(step.astype("<i4").tobytes()), squeeze(tf[order].astype("<i4").tobytes()),
        )


def postings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents in blocks: ids, numbers of terms, terms with their document counts, and points."""

    def run(batches) -> Iterator[pd.DataFrame]:
        squeeze, part, k, block = zstandard.ZstdCompressor(3).compress, TaskContext.get().partitionId(), 0, _Block()

        def done() -> pd.DataFrame:
            return pd.DataFrame([((part << 32) + k, *block.packed(squeeze))], columns=["block", "ids", "n", "documents", "length", "terms", "df", "step", "tf"])

        for batch in batches:
            for doc_id, null, text in zip(batch["_id"].tolist(), batch["_null"].tolist(), batch["_text"], strict=True):
                if terms := terms_of(text):
                    block.add(None if null else int(doc_id), terms)
                    if block.points >= BLOCK_POINTS:
                        yield done()
                        k, block = k + 1, _Block()
        if block.ids:
            yield done()

    id_ = F.col(f"`{id_column}`").cast("long")
    slim = docs.select(F.coalesce(id_, F.lit(0)).alias("_id"), id_.isNull().alias("_null"), F.col(f"`{text_column}`").alias("_text"))
    return slim.mapInPandas(run, "block long, ids binary, n binary, documents long, length long, terms binary, df binary, step binary, tf binary")


@dataclass
class Index:
    """``blocks``: block, ids, terms, df, tree. ``documents`` with a term, and how many terms they have."""

    blocks: DataFrame
    documents: int
    length: int
    stages: Stages


def index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """Two passes: the points of all documents, then, as totals are known, impacts and trees."""
    stages = Stages(docs.sparkSession, "lexical")
    points = stages.write(postings(docs, id_column, text_column), "points")
    documents, length = points.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()

    def run(batches) -> Iterator[pd.DataFrame]:
        squeeze, open_ = zstandard.ZstdCompressor(3).compress, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for r in batch.itertuples():
                n, df = np.frombuffer(r.n, "<i8"), np.frombuffer(open_(r.df), "<i4").astype(np.int64)
                step, tf = (np.frombuffer(open_(x), "<i4").astype(np.int64) for x in (r.step, r.tf))
                first = np.cumsum(df) - df
                total = np.cumsum(step)
                doc = total - np.repeat(total[first] - step[first], df)
                tree = build(np.repeat(np.arange(len(df)), df), doc, impacts(tf, n[doc], documents, length), len(df), len(n))
                yield pd.DataFrame([(r.block, r.ids, r.terms, r.df, squeeze(tree))], columns=["block", "ids", "terms", "df", "tree"])

    trees = points.select("block", "ids", "n", "terms", "df", "step", "tf").mapInPandas(run, "block long, ids binary, terms binary, df binary, tree binary")
    blocks = stages.write(trees, "blocks")
    stages.drop("points")
    return Index(blocks, documents, length, stages)


# ---------------------------------------------------------------- queries


def _asked_terms(terms: bytes, wanted: dict[bytes, int], open_) -> tuple[np.ndarray, np.ndarray]:
    """(number in ``wanted``, row) of the block's terms that are asked for."""
    found = [(wanted[t], k) for k, t in enumerate(open_(terms).split(b" ")) if t in wanted]
    both = np.array(found, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _document_counts(own: Index, wanted: dict[bytes, int]) -> dict[int, int]:
    """How many documents hold each of a chunk's terms."""
    sent = own.blocks.sparkSession.sparkContext.broadcast(wanted)

    def run(batches) -> Iterator[pd.DataFrame]:
        open_ = zstandard.ZstdDecompressor().decompress
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for terms, df in zip(batch["terms"], batch["df"], strict=True):
                term, row = _asked_terms(terms, sent.value, open_)
                total[term] += np.frombuffer(open_(df), "<i4")[row]
        held = np.flatnonzero(total)
        yield pd.DataFrame({"term": held, "df": total[held]})

    rows = own.blocks.select("terms", "df").mapInPandas(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    return {r.term: r.df for r in rows}


def _search_chunk(own: Index, texts: list[tuple[int, str]], most: int) -> DataFrame:
    """``row, doc_id, score`` of the highest documents of each task for each query of a chunk."""
    counted = [(row, Counter(terms_of(text))) for row, text in texts]
    wanted: dict[bytes, int] = _Numbers()
    for _, terms in counted:
        for t in terms:
            wanted[t]
    wanted = dict(wanted)
    df = _document_counts(own, wanted)
    weights = {k: weight(own.documents, n) for k, n in df.items()}
    # By term: the queries that ask for it and what each occurrence of its impact is worth to them.
    by_term = sorted((wanted[t], q, weights[wanted[t]] * times) for q, (_, terms) in enumerate(counted) for t, times in terms.items() if weights.get(wanted[t]))
    term, query, worth = np.array(by_term, np.int64).reshape(-1, 3).T
    bounds = np.searchsorted(term, np.arange(len(wanted) + 1))
    rows = np.array([row for row, _ in counted], np.int64)
    sent = own.blocks.sparkSession.sparkContext.broadcast((wanted, bounds, query, worth, rows))

    def run(batches) -> Iterator[pd.DataFrame]:
        wanted_, bounds_, query_, worth_, rows_ = sent.value
        open_, best = zstandard.ZstdDecompressor().decompress, Best.empty()
        for batch in batches:
            for ids, terms, tree in zip(batch["ids"], batch["terms"], batch["tree"], strict=True):
                asked, row = _asked_terms(terms, wanted_, open_)
                n = bounds_[asked + 1] - bounds_[asked]
                at = _spread(bounds_[asked], n)
                order = np.argsort(query_[at], kind="stable")
                at, own_row = at[order], np.repeat(row, n)[order]
                best = search(opened(open_(tree)), np.frombuffer(ids, "<i8"), query_[at], own_row, worth_[at], best, len(rows_), most)
        yield pd.DataFrame({"row": rows_[best.query], "doc_id": pd.array(np.where(best.id == LAST, 0, best.id), "Int64").copy(), "score": best.score}).assign(null=best.id == LAST)

    return own.blocks.select("ids", "terms", "tree").mapInPandas(run, "row long, doc_id long, score long, null boolean")


def ranked(own: Index, queries: DataFrame, id_column: str = "item_id", text_column: str = "text", most: int = FOUND) -> DataFrame:
    """``item_id, rank, doc_id, score``: each query's highest documents with a score above 0."""
    stages = own.stages
    distinct = queries.select(F.col(f"`{id_column}`").alias("item_id"), F.col(f"`{text_column}`").alias("text")).distinct()
    asked = stages.write(distinct.where("text IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "queries")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-size // CHUNK_BYTES))
    found = None
    for k in range(chunks):
        own_texts = asked.where(F.pmod(F.xxhash64("row"), F.lit(chunks)) == k).select("row", "text").collect()
        part = stages.write(_search_chunk(own, [(r.row, r.text) for r in own_texts], most), f"found{k}")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    doc_id = F.when(~F.col("null"), F.col("doc_id")).alias("doc_id")
    top = found.select("row", doc_id, "score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return top.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS copy,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), docs AS (
    SELECT *, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0
), totals AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM docs
), held AS (
    SELECT doc_id, copy, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, copy, n, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM held, totals GROUP BY term
), asked AS (
    SELECT item_id, text, term, count(*)::BIGINT AS times FROM (
        SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)
    ) GROUP BY ALL
), scores AS (
    SELECT item_id, text, doc_id, copy,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * totals.docs) // totals.terms))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term), totals
    GROUP BY item_id, text, doc_id, copy
), ranks AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 20
"""
