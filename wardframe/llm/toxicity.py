"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words, whole, and word beginnings (4, 5 and 6 bytes), with A-Z in lower case, and hashed.
A word is a run of letters, digits and characters beyond ASCII. The score is the sigmoid of

    b + sum_i w_i + sum_(i<j) <v_i, v_j>

over the terms present, the pair sum taken in linear time as half of (|sum v|^2 - sum |v|^2), so an
insult and a group mention together can weigh more than both apart. Weights are learnt in numpy by
AdaGrad on the logistic loss from at most ``each`` labelled documents per class of the training fold,
with the classes weighted alike. In a long text, thousands of meaningless terms would add up to noise, so a term takes part only
if it occurs in ``least`` training documents or more, and if it tells the classes apart: alone, when its share of documents
differs by ``sigma`` standard errors, or with another term, when toxic documents hold both more (or less) often than the
two alone would have it, and differ in that from the others by ``pair_sigma`` errors. Pairs are tested among the ``AMONG`` most
frequent terms that ``common`` of the training documents or more hold, and the ``pairs`` strongest are tried: they stay if a fifth of the training
documents, left out for that, is predicted better with them. So two words that are equally frequent in both classes
count if their meeting tells (an insult that is harmless by itself, and the mention of a group).

Every text is scored whole. The model is 2**18 rows of nine half floats: 4.7 MB to broadcast, always.
Null and empty texts have no terms and get the sigmoid of b. Without labels of both classes the score
is the share of toxic labels (0 without any). Repeated rows get equal scores.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.llm.common import crc_fold, mix, per_row, table
from wardframe.llm.labelled import spread_ids, texts_of, training_labels

BITS, FACTORS = 18, 8
AMONG = 2_000  # most frequent terms whose pairs are tested: some 160 MB for 10,000 documents
COLUMNS = 500  # of them at once
START = 0.01  # squared gradient that AdaGrad assumes at first, so that early steps stay small
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WORD = np.zeros(256, dtype=bool)
WORD[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1)]] = True
WORD[128:] = True
BEGINNINGS = (4, 5, 6)
BASE = 0x9E3779B97F4A7C15  # odd, so that it can be divided by
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct hashed terms."""
    low = LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)]
    edge = np.diff(WORD[low].view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, dtype=np.int32)
    # Running sums of byte times power: a difference, divided by the power where it starts, is a run's own hash.
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(low)), out=sums[1:])
    shift = _powers(INVERSE, len(low))[starts]
    found = [(sums[ends] - sums[starts]) * shift + np.uint64(len(BEGINNINGS))]
    for kind, k in enumerate(BEGINNINGS):
        own = ends - starts >= k
        found.append((sums[starts[own] + k] - sums[starts[own]]) * shift[own] + np.uint64(kind))
    hashed = mix(np.concatenate(found))
    return np.unique((hashed >> np.uint64(64 - BITS)).astype(np.int32))


def _apart(toxic: np.ndarray, other: np.ndarray, p: int, n: int, sigma: float) -> np.ndarray:
    """Do the shares toxic/p and other/n differ by ``sigma`` standard errors?"""
    share = (toxic + other) / (p + n)
    return np.abs(toxic / p - other / n) >= sigma * (np.sqrt(share * (1 - share) * (1 / p + 1 / n)) + 1e-9)


def telling(docs: list[np.ndarray], y: np.ndarray, least: int, sigma: float, pair_sigma: float, common: float, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms in at least ``least`` documents that tell the classes apart: alone, and with another."""
    size = np.array([len(d) for d in docs])
    ids, of = np.concatenate([*docs, np.empty(0, np.int32)]), np.repeat(y, size)
    toxic, other = (np.bincount(ids[of == c], minlength=1 << BITS) for c in (1, 0))
    p, n = int(y.sum()), int((1 - y).sum())
    seen = (toxic + other >= least) & _apart(toxic, other, p, n, sigma)
    # How far the share with both terms of a pair is from what the terms alone give, in either class:
    # products of the documents' rows, some columns at once.
    often = np.flatnonzero(toxic + other >= max(least, common * (p + n)))
    often = often[np.argsort(-(toxic + other)[often], kind="stable")[:AMONG]]
    place = np.full(1 << BITS, -1)
    place[often] = np.arange(len(often))
    held = np.zeros((len(docs), len(often)), np.float32)
    at = place[ids]
    held[np.repeat(np.arange(len(docs)), size)[at >= 0], at[at >= 0]] = 1
    strongest: list[tuple] = []
    classes = [(held[y == c], held[y == c].mean(0), m) for c, m in ((1, p), (0, n))]
    for lo in range(0, len(often), COLUMNS):
        some = slice(lo, lo + COLUMNS)
        together, error = [], []
        for rows, share, m in classes:
            together.append(rows[:, some].T @ rows / m - np.outer(share[some], share))
            error.append(np.outer(share[some] * (1 - share[some]), share * (1 - share)) / m)
        more = together[0] - together[1]
        strength = np.abs(more) / (np.sqrt(error[0] + error[1]) + 1e-9)
        found = (strength > pair_sigma) & (np.abs(together[0]) > pair_sigma / 2 * np.sqrt(error[0])) & (more * together[0] > 0)
        i, j = np.nonzero(found)
        i, j = i[i + lo < j], j[i + lo < j]
        strongest += zip(strength[i, j].tolist(), often[i + lo].tolist(), often[j].tolist())
        strongest = heapq.nlargest(pairs, strongest)
    paired = np.zeros(1 << BITS, bool)
    paired[[t for _, *both in strongest for t in both]] = True
    return seen, paired


def train(docs: list[np.ndarray], y: np.ndarray, least: int = 3, sigma: float = 3.0, pair_sigma: float = 6.0, common: float = 0.01, pairs: int = 50, seed: int = 5):
    """Bias, linear weights and factors; terms that don't tell the classes apart stay at zero."""
    alone, paired = telling(docs, y, least, sigma, pair_sigma, common, pairs)
    if (paired & ~alone).any():
        out = np.random.default_rng(seed).random(len(docs)) < 0.2
        if 0 < y[~out].sum() < (~out).sum():
            kept, left = ([d for d, o in zip(docs, out) if o == c] for c in (False, True))
            losses = [_loss(predict(_fit(kept, y[~out], seen, seed), left), y[out]) for seen in (alone, alone | paired)]
            if losses[1] < losses[0]:
                alone = alone | paired
    return _fit(docs, y, alone, seed)


def _loss(score: np.ndarray, y: np.ndarray) -> float:
    """Mean log loss, either class counting alike."""
    each = -np.log(np.clip(np.where(y == 1, score, 1 - score), 1e-6, 1))
    return sum(each[y == c].mean() for c in (0, 1) if (y == c).any())


def _fit(docs: list[np.ndarray], y: np.ndarray, seen: np.ndarray, seed: int, epochs: int = 30, batch: int = 64, rate: float = 0.2, decay: float = 1e-4):
    rng = np.random.default_rng(seed)
    docs = [d[seen[d]] for d in docs]
    bias, bias_sum = 0.0, START
    w, v = np.zeros(1 << BITS, np.float32), rng.normal(0, 0.01, (1 << BITS, FACTORS)).astype(np.float32)
    w_sum, v_sum = np.full(1 << BITS, START, np.float32), np.full((1 << BITS, FACTORS), START, np.float32)
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // batch)):
            size = np.array([len(docs[r]) for r in rows])
            ids, at = np.unique(np.concatenate([docs[r] for r in rows]), return_inverse=True)
            own = np.repeat(np.arange(len(rows)), size)
            vi = v[ids][at]
            total = np.stack([np.bincount(own, vi[:, f], len(rows)) for f in range(FACTORS)], 1)
            z = bias + np.bincount(own, w[ids][at], len(rows)) + 0.5 * ((total**2).sum(1) - np.bincount(own, (vi**2).sum(1), len(rows)))
            d = weight[rows] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            g = d.sum()
            bias_sum += g * g
            bias -= rate * g / np.sqrt(bias_sum)
            dt = d[own]
            gw = np.bincount(at, dt, len(ids)) + decay * w[ids]
            w_sum[ids] += gw**2
            w[ids] -= rate * gw / np.sqrt(w_sum[ids])
            gv = np.stack([np.bincount(at, dt * (total[own, f] - vi[:, f]), len(ids)) for f in range(FACTORS)], 1) + decay * v[ids]
            v_sum[ids] += gv**2
            v[ids] -= 0.2 * rate * gv / np.sqrt(v_sum[ids])
    w[~seen], v[~seen] = 0, 0
    return float(bias), w.astype(np.float16), v.astype(np.float16)


def predict(model, docs: list[np.ndarray]) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(docs), model)
    bias, w, v = model
    out = np.empty(len(docs))
    for i, d in enumerate(docs):
        vi = v[d].astype(np.float32)
        out[i] = bias + w[d].astype(np.float32).sum() + 0.5 * ((vi.sum(0) ** 2).sum() - (vi**2).sum())
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _term_rows(batches):
    def rows(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": part["doc_id"], "y": part["y"], "t": [terms(t).tobytes() for t in part["text"]]})

    return per_row(batches, rows)


def fit(docs: DataFrame, labels: DataFrame, each: int = 5_000, seed: int = 5):
    """Learn from at most ``each`` toxic and ``each`` other documents of the training fold."""
    known = training_labels(labels, "toxic")
    n, toxic = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not toxic or toxic == n:
        return float(toxic / n) if n else 0.0
    ids = spread_ids(known.where("y = 1"), each, seed).unionByName(spread_ids(known.where("y = 0"), each, seed))
    got = texts_of(docs, ids).mapInPandas(_term_rows, "doc_id long, y int, t binary").toPandas().sort_values(["doc_id", "t"])
    y = got["y"].to_numpy()
    if not len(y) or y.min() == y.max():
        return float(toxic / n)
    return train([np.frombuffer(t, dtype=np.int32) for t in got["t"]], y, seed=seed)


def scored(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with its ``score``, 0 to 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text")

    def run(batches):
        def rows(part: pd.DataFrame) -> pd.DataFrame:
            return part.drop(columns=["text"]).assign(score=predict(held.value, [terms(t) for t in part["text"]]))

        return per_row(batches, rows)

    return slim.mapInPandas(run, f"record {slim.schema['record'].dataType.simpleString()}, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    result = scored(docs.withColumn("held_out", crc_fold() == 0), model, ["doc_id", "held_out"])
    return result.select("record.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
