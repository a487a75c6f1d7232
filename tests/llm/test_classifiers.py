import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardframe.llm import quality_classifier, toxicity
from wardframe.llm.quality_classifier import op6_quality_classifier
from wardframe.llm.toxicity import op3_toxicity

LABELS = "doc_id long, quality int, toxic int"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(500)]
    rows, labels = [], []
    for k in range(900):
        text = rng.choices(words, k=rng.randrange(20, 200))
        toxic, quality = k % 9 == 0, k % 6 != 1
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                text.insert(rng.randrange(len(text)), "zorgl" + rng.choice(["ing", "ed", "s", "", "ish"]))
        if not quality:
            text = [w.upper() + "!!" for w in text] if k % 4 else [w + "###" for w in text]
        rows.append((k, " ".join(text)))
        labels.append((k, int(quality), int(toxic)))
    return rows, labels


def accuracy(out, labels, column):
    known = {d: (q, t)[column == "toxic"] for d, q, t in labels}
    right = [r.predicted == known[r.doc_id] for r in out if r.held_out and r.doc_id in known]
    return np.mean(right)


def test_held_out_accuracy_and_edges(documents, stored, spark, corpus):
    rows, labels = corpus
    odd = [(5000, None), (5001, ""), (5002, rows[0][1]), (5002, rows[0][1]), (None, "no id")]
    sf = stored(
        documents=documents(rows + odd, {"score": F.lit("clash")}),
        labels=spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (9999, 1, 1), (4, labels[4][1], labels[4][2])], LABELS),
    )
    for query, column in ((op3_toxicity, "toxic"), (op6_quality_classifier, "quality")):
        out = query(spark, sf).collect()
        assert len(out) == len(rows) + len(odd)
        assert all(0 <= r.score <= 1 for r in out)
        assert all(r.held_out == held(r.doc_id) for r in out if r.doc_id is not None)
        assert accuracy(out, labels, column) > 0.95
        twice = {r.score for r in out if r.doc_id == 5002}
        assert len(twice) == 1


def test_labels_of_the_held_out_fold_change_nothing(documents, stored, spark, corpus):
    rows, labels = corpus
    docs = documents(rows)
    flipped = [(d, 1 - q, 1 - t) if held(d) else (d, q, t) for d, q, t in labels]
    a, b = (spark.createDataFrame(x, LABELS) for x in (labels, flipped))
    one, other = toxicity.fit(docs, a), toxicity.fit(docs, b)
    assert all(np.array_equal(x, y) for x, y in zip(one, other))
    one, other = quality_classifier.fit(docs, a), quality_classifier.fit(docs, b)
    assert all(np.array_equal(x, y) for x, y in zip(one[2], other[2]))


def test_without_labels(documents, stored, spark):
    sf = stored(documents=documents([(1, "a text"), (2, None)]), labels=spark.createDataFrame([], LABELS))
    assert {(r.score, r.predicted) for r in op3_toxicity(spark, sf).collect()} == {(0.0, 0)}
    assert {(r.score, r.predicted) for r in op6_quality_classifier(spark, sf).collect()} == {(0.5, 1)}


def test_pair_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    w, v = rng.normal(size=1 << toxicity.BITS).astype(np.float16), rng.normal(size=(1 << toxicity.BITS, 8)).astype(np.float16)
    d = np.array([3, 77, 4096, 200_000])
    w32, v32 = w.astype(np.float64), v.astype(np.float64)
    z = 0.1 + w32[d].sum() + sum(v32[d[i]] @ v32[d[j]] for i in range(4) for j in range(i))
    assert np.isclose(toxicity.predict((0.1, w, v), [d])[0], 1 / (1 + np.exp(-z)), atol=1e-3)


def test_terms_take_whole_words_and_digits():
    def same(a, b):
        return np.array_equal(toxicity.terms(a), toxicity.terms(b))

    for a, b in (("internationalised", "internationalized"), ("abcdefghXX", "abcdefghYY"), ("k1ll y0u", "k9ll y3u"), ("123 456", "124 456")):
        assert not same(a, b) and len(toxicity.terms(a)) > 0
    assert same("Some WORDS, some words", "words... some!") and len(toxicity.terms("?!... -")) == 0
    # a word's terms are the same wherever it stands, in texts of any length
    long = " ".join(f"w{k}" for k in range(30_000))
    assert set(toxicity.terms("internationalised ärger").tolist()) <= set(toxicity.terms(long + " internationalised, ärger").tolist())
    assert len(toxicity.terms("abcdefgh")) == 4 and len(toxicity.terms("abc")) == 1


def test_learns_what_only_a_pair_tells():
    """Two words, each as frequent in both classes: toxic is exactly who has both or neither."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(300)]
    texts, y = [], []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        text = rng.choices(words, k=40) + ["zorgling"] * a + ["mentioned"] * b
        rng.shuffle(text)
        texts.append(toxicity.terms(" ".join(text)))
        y.append(int(a == b))
    y = np.array(y)
    model = toxicity.train(texts[:3000], y[:3000])
    right = (toxicity.predict(model, texts[3000:]) >= 0.5) == y[3000:]
    assert right.mean() > 0.95
    # no pair among words that tell nothing
    alone, paired = toxicity.telling(texts[:3000], np.array([rng.randrange(2) for _ in range(3000)]), 3, 99.0, 6.0, 0.01, 50)
    assert not alone.any() and not paired.any()
