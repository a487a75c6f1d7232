"""Quality by positive-unlabelled learning with the non-negative risk estimator.

A small network (one hidden layer, numpy) on a fixed set of text features is trained from trusted
positives, that is labelled good documents of the training fold, and unlabelled web text, a sample of
all documents whose labels are not looked at. With class prior p the risk is

    p * E_positive[loss(+)] + max(0, E_unlabelled[loss(-)] - p * E_positive[loss(-)]),

the second part being the risk on negatives that unbiased estimation would give; where it falls below
zero, the step goes the other way, so the network cannot win by overfitting the positives. The prior
is estimated as the share of positives among the labelled rows of the training fold.

Bounds, as parameters: ``positives`` and ``unlabelled`` documents are the most that training reads.
Scoring reads every text whole, and the model broadcast is some 100 KB whatever the corpus is.

Null and empty texts are scored by their (zero) features. Without any positive label the score is the
prior, or 0.5 without labels. Repeated rows get equal scores.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.llm.common import crc_fold, per_row, table, words_of
from wardframe.llm.labelled import spread_ids, texts_of, training_labels

KINDS = 24
HIDDEN = 24


def _kinds() -> np.ndarray:
    """Class of every byte: letters by case, digits, white space, single marks, the rest of the marks, UTF-8."""
    kind = np.full(256, KINDS - 1, dtype=np.uint8)
    kind[ord("a") : ord("z") + 1] = 0
    kind[128:] = 0  # letters outside ASCII, nearly always small ones
    kind[0xC3] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[[9, 11, 12, 13, 32]] = 4
    kind[10] = 5
    for k, c in enumerate(".,!?;:-'\"()|#*$%&", start=6):
        kind[ord(c)] = k
    return kind


KIND = _kinds()
SIZE = KINDS * KINDS + 8


def features(text: str | None) -> np.ndarray:
    """Log shares of byte-class pairs, and eight whole-text statistics."""
    out = np.zeros(SIZE, dtype=np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = words_of(text)
    if not words:
        return out
    kind = KIND[np.frombuffer(b" " + raw + b" ", dtype=np.uint8)].astype(np.int32)
    pairs = np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS * KINDS)
    out[:-8] = np.log1p(1000.0 * pairs / (len(kind) - 1))
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = len(set(words))
    out[-8:] = (
        np.log1p(n),
        4 * len(zlib.compress(raw, 1)) / len(raw),
        4 * distinct / n,
        np.log(n / distinct),
        sum(map(len, words)) / n / 2,
        4 * len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)),
        4 * sum(a == b for a, b in zip(words, words[1:])) / n,
    )
    return out


def _feature_rows(batches):
    def rows(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": part["doc_id"], "f": [features(t).astype(np.float16).tobytes() for t in part["text"]]})

    return per_row(batches, rows)


def _sample(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of a bounded set of documents; they are all that comes to the driver (1.2 KB each)."""
    got = texts_of(docs, ids).mapInPandas(_feature_rows, "doc_id long, f binary").toPandas().sort_values(["doc_id", "f"])
    return np.frombuffer(b"".join(got["f"]), dtype=np.float16).reshape(-1, SIZE).astype(np.float32)


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7, epochs: int = 30, batch: int = 512, rate: float = 0.003):
    """Minimise the non-negative risk by Adam; returns what ``predict`` needs."""
    rng = np.random.default_rng(seed)
    middle, spread = unlabelled.mean(0), unlabelled.std(0) + 0.05
    p, u = ((x - middle) / spread for x in (positive, unlabelled))
    weights = [rng.normal(0, SIZE**-0.5, (SIZE, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    weights = [w.astype(np.float32) for w in weights]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(u)), max(1, len(u) // batch)):
            xp, xu = p[rng.integers(0, len(p), len(rows))], u[rows]
            x = np.clip(np.concatenate([xp, xu]), -8, 8)
            h = np.tanh(x @ weights[0] + weights[1])
            q = 1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -30, 30)))
            k = len(rows)
            # Logistic loss: d loss(+)/d logit = q - 1, d loss(-)/d logit = q.
            negative = -np.log(1 - q[k:] + 1e-7).mean() + prior * np.log(1 - q[:k] + 1e-7).mean()
            d = np.zeros(2 * k, dtype=np.float32)
            if negative >= 0:
                d[:k] = prior * (q[:k] - 1) / k - prior * q[:k] / k
                d[k:] = q[k:] / k
            else:  # undo part of what made the negative risk go below zero
                d[:k] = prior * q[:k] / k
                d[k:] = -q[k:] / k
            dh = np.outer(d, weights[2]) * (1 - h * h)
            grads = [x.T @ dh, dh.sum(0), h.T @ d, d.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                g = g + 1e-4 * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return middle, spread, weights


def predict(model, x: np.ndarray) -> np.ndarray:
    """Scores to six decimals, in double precision: sums vary with the size of a batch in their last digits."""
    middle, spread, weights = model
    x = np.clip((x.astype(np.float64) - middle) / spread, -8, 8)
    z = np.tanh(x @ weights[0].astype(np.float64) + weights[1]) @ weights[2].astype(np.float64) + weights[3]
    return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 6)


def fit(docs: DataFrame, labels: DataFrame, positives: int = 6_000, unlabelled: int = 12_000, seed: int = 7):
    """The model, or the prior alone where there is nothing to learn from."""
    known = training_labels(labels, "quality")
    n, good = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    prior = min(max(good / n, 0.05), 0.95) if n else 0.5
    if not good:
        return good / n if n else 0.5
    p = _sample(docs, spread_ids(known.where("y = 1").select("doc_id"), positives, seed))
    u = _sample(docs, spread_ids(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), unlabelled, seed + 1))
    return train(p, u, prior, seed) if len(p) and len(u) else prior


def scored(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with its ``score``, 0 to 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text")
    return slim.mapInPandas(_scores(held), f"record {slim.schema['record'].dataType.simpleString()}, score double")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    result = scored(docs.withColumn("held_out", crc_fold() == 0), model, ["doc_id", "held_out"])
    return result.select("record.*", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _scores(held):
    def run(batches):
        def rows(part: pd.DataFrame) -> pd.DataFrame:
            model = held.value
            score = np.full(len(part), model) if isinstance(model, float) else predict(model, np.stack([features(t) for t in part["text"]]))
            return part.drop(columns=["text"]).assign(score=score)

        return per_row(batches, rows)

    return run
