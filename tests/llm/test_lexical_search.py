import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardframe.checks.compare import difference, duckdb_connection
from wardframe.llm import lexical_search
from wardframe.llm.lexical_search import LAST, OP13_SQL, Best, build, impacts, index, levels, op13_ranked_search, opened, ranked, search, terms_of, weight

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_rows(docs, items, most=20):
    held = [(d, Counter(plain_terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scores = Counter(plain_terms(text)), []
        for d, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // length
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in asked.items() if t in c)
            if score:
                scores.append((-score, math.inf if d is None else d, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:most], 1)]
    return sorted(out, key=repr)


def made(seed, n, words=60):
    rng = random.Random(seed)
    vocabulary = [f"{w}{k}" for k in range(words) for w in ("Wort", "naïve", "x")]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 40))) for _ in range(n)]


def test_terms():
    texts = ["", None, "Ünïcode don't STOP_x²", "a\x7fb\x00c", "１２３ 北京 4,5.6", "İI"]
    assert [[t.decode() for t in terms_of(t)] for t in texts] == [plain_terms(t) for t in texts]


@pytest.mark.parametrize("shape", [(1, 1), (1, 200), (300, 1), (5, 700), (900, 40), (64, 64), (33, 129)])
def test_tree_keeps_points_and_finds_the_highest(shape):
    n_rows, n_docs = shape
    rng = np.random.default_rng(n_rows)
    at = rng.choice(n_rows * n_docs, max(1, n_rows * n_docs // 3), replace=False)
    row, doc, value = at // n_docs, at % n_docs, rng.integers(1, 30, len(at))
    tree = opened(build(row, doc, value, n_rows, n_docs))
    assert len(levels(n_rows, n_docs)) == len(tree.rows_split) and sorted(tree.high[-len(at) :]) == sorted(value)
    ids = np.sort(rng.choice(10 * n_docs, n_docs, replace=False))
    grid = np.zeros(shape, np.int64)
    grid[row, doc] = value
    best, want = Best.empty(), []
    own = [(q, r, int(rng.integers(0, 9))) for q in range(6) for r in sorted(rng.choice(n_rows, min(n_rows, q), replace=False))]
    own_q, own_r, own_w = np.array(own, np.int64).reshape(-1, 3).T
    best = search(tree, ids, own_q, own_r, own_w, best, 6, 4)
    for q in range(6):
        scores = sum((w * grid[r] for k, r, w in own if k == q), np.zeros(n_docs, np.int64))
        want += [(q, int(s), int(i)) for s, i in sorted(zip(scores, ids), key=lambda x: (-x[0], x[1]))[:4] if s]
    assert list(zip(best.query.tolist(), best.score.tolist(), best.id.tolist())) == want


def test_ties_open_only_earlier_documents():
    """Equal rows everywhere: what comes out has the smallest ids, and later blocks with larger ids add nothing."""
    row, doc = np.zeros(5000, np.int64), np.arange(5000)
    tree = opened(build(row, doc, np.full(5000, 7), 1, 5000))
    asked = (np.array([0]), np.array([0]), np.array([3]))
    best = search(tree, np.arange(100, 5100), *asked, Best.empty(), 1, 20)
    assert best.id.tolist() == list(range(100, 120))
    assert search(tree, np.arange(9000, 14000), *asked, best, 1, 20).id.tolist() == list(range(100, 120))
    assert search(tree, np.arange(5000), *asked, best, 1, 20).id.tolist() == list(range(20))


def test_rows_against_brute_force(documents, spark, monkeypatch):
    texts = [*enumerate(made(1, 300)), (400, None), (401, ""), (402, "... --"), (403, "Wort0 same"), (403, "Wort0 same"), (None, "Wort0 same"), (None, "wort0 Same"), (404, "Wort1 " * 3000)]
    items = [(k, t) for k, t in enumerate(made(2, 30))] + [(90, None), (91, ""), (92, "wort0 SAME same"), (92, "wort0 SAME same"), (92, "wort3"), (93, "unknown"), (None, "x1 x2")]
    docs = documents(texts, {"terms": F.lit(1), "block": F.lit("x"), "_id": F.lit("y")}).repartition(5)
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("z"))
    monkeypatch.setattr(lexical_search, "BLOCK_POINTS", 400)
    monkeypatch.setattr(lexical_search, "CHUNK_BYTES", 1000)
    got = ranked(index(docs), queries)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_rows(texts, items)


def test_query_equals_its_sql(spark, documents, stored):
    for folder in ("/root/testdata/sf0.001",):
        assert difference(op13_ranked_search(spark, folder), duckdb_connection(folder), OP13_SQL) is None


def test_numbers():
    assert weight(10, 10) == math.floor(1000 * math.log(22 / 21)) and LAST > 10**18
    assert impacts(np.array([2]), np.array([50]), 4, 100).tolist() == [2 * 10**9 // (2000 + 12 * (75 + 50))]


def test_empty_tables(documents, stored, spark):
    some = spark.createDataFrame([(1, "text")], "item_id long, text string")
    for docs in ([], [(1, None), (2, "...")]):
        assert ranked(index(documents(docs)), some).collect() == []
    assert ranked(index(documents([(1, "text")])), some.limit(0)).collect() == []
    assert [tuple(r) for r in ranked(index(documents([(1, "text")])), some).collect()] == plain_rows([(1, "text")], [(1, "text")])
