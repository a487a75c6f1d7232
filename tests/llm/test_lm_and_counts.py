import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from wardframe.llm import lm_scoring
from wardframe.llm.token_counts import Rollups, changes, counted, op9_token_counts, word_counter
from wardframe.llm.tokens import encoder, vocabulary


def test_log_probabilities_match_plain_evaluation():
    rng = np.random.default_rng(1)
    w = lm_scoring.first_weights(np.zeros(lm_scoring.CLASSES, np.float32), 1)
    cls = rng.integers(0, lm_scoring.CLASSES, 50).astype(np.int16)
    got = lm_scoring.log_probabilities(w, lm_scoring.contexts(cls), cls.astype(np.int64))
    for i in range(50):
        near = [cls[j] if 0 <= j < 50 else lm_scoring.CLASSES for j in range(i - 3, i + 4) if j != i]
        h = np.tanh(np.concatenate([w["embed"][c] for c in near]) @ w["w1"] + w["b1"])
        z = h @ w["w2"] + w["b2"]
        assert np.isclose(got[i], z[cls[i]] - np.log(np.exp(z).sum()), atol=1e-4)


def test_learns_both_sides_and_scores_edges(documents, spark):
    rng = random.Random(2)
    rows = [(k, " ".join(f"{a} mid{a} {a}" for a in rng.choices("abcdefgh", k=60))) for k in range(300)]
    shuffled = " ".join(rng.sample(rows[0][1].split(), 180))
    rows += [(1000, shuffled), (1001, None), (1002, ""), (1003, rows[0][1].upper()), (None, "a")]
    docs = documents(rows, {"n_words": F.lit("clash")})
    out = {r.record.doc_id: r for r in lm_scoring.scored(docs, lm_scoring.fit(docs, stride=2), ["doc_id"]).collect()}
    assert out[0].mean > out[1000].mean + 0.3
    assert np.isclose(out[0].log_likelihood, out[1003].log_likelihood)
    assert (out[1001].n_words, out[1001].log_likelihood, out[1001].mean) == (0, 0.0, None) == (out[1002].n_words, out[1002].log_likelihood, out[1002].mean)
    assert out[None].n_words == 1 and out[None].mean < 0
    empty = documents([])
    assert lm_scoring.scored(empty, lm_scoring.fit(empty), ["doc_id"]).collect() == []


def test_words_at_every_place_are_learned(documents, spark):
    """With the registered parameters, where every eighth word from a place given by the text is a filler."""
    rng = random.Random(3)
    first = int(lm_scoring.buckets_of("filler")[0]) % 8
    rows = []
    for k in range(600):
        letters = [a for a in rng.choices("abcdefgh", k=8) for _ in range(8)]
        rows.append((k, " ".join("filler" if i % 8 == first or not i else a for i, a in enumerate(letters))))
    docs = documents(rows)
    # A letter costs log 8 = 2.08 to one that knows only how often it occurs, and a text 1.8 a word.
    assert lm_scoring.scored(docs, lm_scoring.fit(docs), ["doc_id"]).agg(F.avg("mean")).first()[0] > -1.3


def test_texts_are_cut_into_words_once(documents, spark):
    """Counting and both rounds read the buckets that one pass over the texts wrote."""
    evaluated = spark.sparkContext.accumulator(0)

    def seen(text):
        evaluated.add(1)
        return text

    docs = documents([(k, f"some words and {k}") for k in range(40)]).withColumn("text", F.udf(seen)("text"))
    assert lm_scoring.fit(docs) is not None and evaluated.value == 40


def test_descent_matches_plain_gradients():
    rng = np.random.default_rng(6)
    context, target = rng.integers(0, lm_scoring.CLASSES + 1, (32, lm_scoring.CONTEXT)).astype(np.int16), rng.integers(0, lm_scoring.CLASSES, 32)
    w = lm_scoring.first_weights(np.zeros(lm_scoring.CLASSES, np.float32), 2)
    moved = {k: v.copy() for k, v in w.items()}
    lm_scoring.descend(moved, context, target, 0.5, 32)
    d = lm_scoring.DIM
    embed = np.zeros_like(w["embed"])
    for c, y in zip(context, target):
        h = np.tanh(np.concatenate([w["embed"][k] for k in c]) @ w["w1"] + w["b1"])
        p = np.exp(z := h @ w["w2"] + w["b2"]) / np.exp(z).sum()
        p[y] -= 1
        dx = ((p @ w["w2"].T) * (1 - h * h)) @ w["w1"].T / 32
        for place, k in enumerate(c):
            embed[k] += dx[place * d : (place + 1) * d]
    assert np.allclose(moved["embed"] - w["embed"], -0.5 * embed, atol=1e-6)


def test_one_word_in_all(documents, spark):
    docs = documents([(1, "word"), (2, None)])
    assert [r.n_words for r in lm_scoring.scored(docs, lm_scoring.fit(docs), ["doc_id"]).orderBy("record.doc_id").collect()] == [1, 0]


def test_rollups_follow_a_plain_ledger(spark, tmp_path):
    rng = random.Random(4)
    store, ledger = Rollups(spark, f"{tmp_path}/store"), {}
    schema = "op string, seq int, doc_id long, version string, source string, lang string, tokens long"
    for batch in range(4):
        rows, last = [], {}
        for seq in range(40):
            key = (rng.choice([None, *range(12)]), rng.choice(["v1", "v2"]))
            row = (rng.choice(["insert", "revise", "delete"]), seq, *key, rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice([None, 5, 9]))
            rows.append(row)
            last[key] = row
        for key, row in last.items():
            if row[0] == "delete":
                ledger.pop(key, None)
            else:
                ledger[key] = (row[4], row[5], row[6] or 0)
        df = spark.createDataFrame(rows, schema)
        assert store.apply(str(batch), df) and not store.apply(str(batch), df)
        want = defaultdict(lambda: [0, 0])
        for (_, version), (source, lang, tokens) in ledger.items():
            want[source, lang, version][0] += 1
            want[source, lang, version][1] += tokens
        got = {(r.source, r.lang, r.version): [r.docs, r.tokens] for r in Rollups(spark, f"{tmp_path}/store").totals().collect()}
        assert got == dict(want)
    assert store.batches() == ["0", "1", "2", "3"]


def test_a_failed_batch_leaves_nothing(documents, spark, tmp_path):
    store = Rollups(spark, f"{tmp_path}/store")
    rows = counted(documents([(1, "a b"), (2, None)]), {"w": word_counter}, ["doc_id", "source", "lang"])
    bad = changes("insert", 1, rows).withColumn("tokens", F.raise_error(F.lit("no")).cast("long"))
    try:
        store.apply("x", bad)
    except Exception:
        pass
    assert store.batches() == [] and store.totals().count() == 0
    assert store.apply("x", changes("insert", 1, rows))
    assert [(r.docs, r.tokens) for r in store.totals().collect()] == [(2, 2)]


def test_query_counts(documents, stored, spark):
    texts = ["one two three", "one two three", "four", "", None, "x " * 500]
    rows = [(k, t, "en", "abc"[k % 3]) for k, t in enumerate(texts)]
    got = {(r.source, r.version): (r.docs, r.tokens) for r in op9_token_counts(spark, stored(documents=documents(rows))).collect()}
    own, want, seen = encoder(vocabulary("byte_bpe_50k.json")), defaultdict(lambda: [0, 0]), set()
    for k, t, _, source in rows:
        if (t or "") in seen:
            continue
        seen.add(t or "")
        for version, n in (("bpe-50k-1", len(own.ids(t)) // 4 + 1), ("words-1", len((t or "").split()))):
            want[source, version][0] += 1
            want[source, version][1] += n
    assert got == {k: tuple(v) for k, v in want.items()}
