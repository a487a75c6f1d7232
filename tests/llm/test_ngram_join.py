import random

import pytest
from pyspark.sql import functions as F

from wardframe.llm.ngram_join import jaccard_components, one_of_each


def brute(rows):
    """Component of each row by comparing all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return [(d, len(sets[i]), min((x for x in ids[find(i)] if x is not None), default=None) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    passage = " ".join(rng.choices(words, k=40))
    rows, k = [], 0
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([3, 5, 6, 20, 60, 150]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            changed = list(base)
            for _ in range(int(len(base) * rng.choice([0, 0.02, 0.04, 0.06, 0.1]))):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            text = " ".join(changed)
            rows.append((k, (passage + " " + text) if rng.random() < 0.3 else text.upper() if rng.random() < 0.2 else text))
            k += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(documents, seed):
    rows = corpus(seed) + [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE  two"), (None, "one two"), (None, None)]
    rng = random.Random(seed)
    rng.shuffle(rows)
    got = jaccard_components(documents(rows, {"node": F.lit("x"), "key": F.lit(3)})).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)


def test_crowd_of_near_copies_and_a_bridge(documents):
    rng = random.Random(5)
    base = [f"v{k}" for k in range(200)]
    rows = []
    for k in range(150):
        changed = list(base)
        for i in rng.sample(range(200), 2):
            changed[i] = f"x{rng.random()}"
        rows.append((k, " ".join(changed)))
    bridge = base[:185] + [f"y{k}" for k in range(15)]
    rows += [(500, " ".join(bridge)), (501, " ".join(base[25:185] + [f"y{k}" for k in range(15)]))]
    got = jaccard_components(documents(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_empty_table(documents):
    assert jaccard_components(documents([])).collect() == []


def test_one_of_each_keeps_columns_and_rows_without_words(documents, stored, spark):
    text = " ".join(f"a{k}" for k in range(30))
    rows = [(4, text), (2, text), (2, text), (None, text), (7, None), (7, None), (8, ""), (None, "lonely words here"), (None, None), (9, text + " more")]
    docs = spark.read.parquet(stored(documents=documents(rows, {"_key": F.lit(1)})) + "/documents.parquet")
    out = one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([(2, text), (7, None), (8, ""), (None, "lonely words here"), (None, None)], key=repr)
