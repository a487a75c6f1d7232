"""Masked pseudo-likelihood of texts under a bidirectional window network over word classes.

Every word is predicted from the three words on its left and the three on its right, its own place
masked; a text's score is the sum of the log-probabilities of all its words.

* *Vocabulary.* Words (A-Z lower-cased) fall into 2**17 hash buckets, counted over the whole corpus in tasks
  and summed by Spark. The most frequent buckets are classes of their own, the others share classes of
  buckets of like frequency: log P(word) = log P(class | both sides) + log P(bucket | class).
  The second term knows no context, and of words outside the most frequent the context tells the class only.
* *Passes.* Words are cut and hashed once; their buckets are a written table, which the counts, every round
  and the scores read.
* *Network.* Embeddings of the six neighbours, one tanh layer, a softmax over the classes; numpy.
* *Training.* Every task trains the current weights on its own texts, each text from every ``stride``-th word
  (starting at a place that follows from the text, and one further each round), and sends its weights,
  parameter by parameter; Spark averages them, weighted by words seen, and the next round starts from the
  mean. There are as many rounds as places in a stride, so every word of every text is a target once, and
  what is gathered grows with the texts; what reaches the driver is one set of weights.

Null and empty texts have no words: sum 0, mean null. Repeated rows get equal scores. An empty corpus gives
no rows. Results vary in the last digits with how the input is split, since tasks train on their own share.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.llm.common import Stages, lower_words_of, per_row, table, word_hashes

BUCKET_BITS = 17
CLASSES, OWN = 128, 96  # classes in all, and how many are single buckets
SIDE, DIM, HIDDEN = 3, 12, 24
CONTEXT = 2 * SIDE
SHAPES = {"embed": (CLASSES + 1, DIM), "w1": (CONTEXT * DIM, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, CLASSES), "b2": (CLASSES,)}
STRETCH = 1 << 21
BATCH = 1 << 14
CELLS = np.arange((CLASSES + 1) * DIM).reshape(CLASSES + 1, DIM)  # places of the embeddings


def buckets_of(text: str | None) -> np.ndarray:
    return (word_hashes(lower_words_of(text)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def numbered(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns as ``record``, each text's buckets as little-endian 32-bit numbers, and its length."""
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text")

    def rows(part: pd.DataFrame) -> pd.DataFrame:
        return part[["record"]].assign(
            buckets=[buckets_of(t).astype("<i4").tobytes() for t in part["text"]], size=[len(t) if isinstance(t, str) else 0 for t in part["text"]]
        )

    return slim.mapInPandas(lambda batches: per_row(batches, rows), f"record {slim.schema['record'].dataType.simpleString()}, buckets binary, size long")


def _parts(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Slices of ``numbered`` rows, of bounded text size, with their buckets."""
    for batch in batches:
        if len(batch):
            cut = batch["size"].to_numpy().cumsum() // (4 << 20)
            for _, part in batch.groupby(cut, sort=True):
                yield part, [np.frombuffer(b, dtype="<i4") for b in part["buckets"]]


def _count(batches):
    held = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    size = 0

    def out():
        seen = np.flatnonzero(held)
        return pd.DataFrame({"bucket": seen.astype(np.int32), "n": held[seen]})

    for _, texts in _parts(batches):
        found = np.concatenate(texts)
        held += np.bincount(found, minlength=1 << BUCKET_BITS)
        size += len(found)
        if size > STRETCH:
            yield out()
            held[:] = 0
            size = 0
    if size:
        yield out()


class Vocabulary:
    """Class of every bucket, and log P(bucket | class); of fixed size."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        self.cls = np.empty(len(counts), dtype=np.int16)
        self.cls[order[:OWN]] = np.arange(OWN)
        rest = order[OWN:]
        # The other classes hold equal shares of the words left, from frequent buckets to rare ones.
        share = np.cumsum(counts[rest] + 0.01)
        self.cls[rest] = OWN + np.minimum((share / share[-1] * (CLASSES - OWN)).astype(int), CLASSES - OWN - 1)
        smooth = counts + 0.01
        self.within = np.log(smooth / np.bincount(self.cls, smooth, CLASSES)[self.cls]).astype(np.float32)
        total = np.bincount(self.cls, counts, CLASSES) + 0.5
        self.prior = np.log(total / total.sum()).astype(np.float32)


def first_weights(prior: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {k: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32) for k, shape in SHAPES.items() if len(shape) == 2}
    w["embed"] = rng.normal(0, 0.5, SHAPES["embed"]).astype(np.float32)
    return w | {"b1": np.zeros(HIDDEN, np.float32), "b2": prior.copy()}


def contexts(cls: np.ndarray) -> np.ndarray:
    """Classes of the six neighbours of every word; CLASSES stands for places outside the text."""
    wide = np.full(len(cls) + CONTEXT, CLASSES, dtype=np.int16)
    wide[SIDE : SIDE + len(cls)] = cls
    return np.stack([wide[k : k + len(cls)] for k in range(CONTEXT + 1) if k != SIDE], axis=1)


def log_probabilities(weights: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(class) of each target given its context."""
    # The first layer on an embedding is one table per place: no product is needed per word.
    tables = [weights["embed"] @ weights["w1"][k * DIM : (k + 1) * DIM] for k in range(CONTEXT)]
    out = np.empty(len(target), dtype=np.float32)
    for at in range(0, len(target), BATCH):
        c, y = context[at : at + BATCH], target[at : at + BATCH]
        h = tables[0].take(c[:, 0], axis=0)
        for k in range(1, CONTEXT):
            h += tables[k].take(c[:, k], axis=0)
        z = np.tanh(h + weights["b1"]) @ weights["w2"]
        z += weights["b2"]
        own = z[np.arange(len(y)), y]
        np.exp(z, out=z)  # tanh bounds the logits, so exp cannot overflow
        out[at : at + BATCH] = own - np.log(z.sum(1))
    return out


def descend(weights: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray, rate: float, batch: int = 256) -> None:
    """One pass of gradient descent over the examples, in place."""
    for at in range(0, len(target), batch):
        flat, y = context[at : at + batch].ravel(), target[at : at + batch]
        x = weights["embed"].take(flat, axis=0).reshape(len(y), -1)
        h = np.tanh(x @ weights["w1"] + weights["b1"])
        p = h @ weights["w2"]
        p += weights["b2"]
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= batch
        dh = (p @ weights["w2"].T) * (1 - h * h)
        dx = (dh @ weights["w1"].T).reshape(-1, DIM)
        weights["w2"] -= rate * (h.T @ p)
        weights["b2"] -= rate * p.sum(0)
        weights["w1"] -= rate * (x.T @ dh)
        weights["b1"] -= rate * dh.sum(0)
        sums = np.bincount(CELLS.take(flat, axis=0).ravel(), dx.ravel(), CELLS.size)  # all columns of the embeddings at once
        weights["embed"] -= rate * sums.astype(np.float32).reshape(CELLS.shape)


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES]).astype(np.float64)


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])
    return {k: part.reshape(s).astype(np.float32) for (k, s), part in zip(SHAPES.items(), np.split(flat, ends[:-1]))}


def _train_here(held, stride: int, turn: int, rate: float):
    def run(batches):
        vocabulary, start = held.value
        weights, seen = {k: v.copy() for k, v in start.items()}, 0
        for _, texts in _parts(batches):
            context, target = [], []
            for b in texts:
                if len(b):
                    cls = vocabulary.cls[b]
                    first = (int(b[0]) + turn) % stride
                    context.append(contexts(cls)[first::stride])
                    target.append(cls[first::stride])
            if target:
                context, target = np.concatenate(context), np.concatenate(target)
                mixed = np.random.default_rng(len(target)).permutation(len(target))
                descend(weights, context[mixed], target[mixed], rate)
                seen += len(target)
        if seen:
            flat = _flat(weights)
            yield pd.DataFrame({"i": np.arange(len(flat), dtype=np.int32), "v": flat * seen, "seen": float(seen)})

    return run


def fit(docs: DataFrame, rounds: int = 2, stride: int | None = None, rate: float = 0.5, seed: int = 3):
    """Vocabulary and weights from all texts; None if there is no word at all.

    ``stride`` is by default ``rounds``: the rounds' places differ, and together they are all words.
    """
    words = numbered(docs, []).select("buckets", "size")  # a file holds no struct without columns
    return fit_numbered(Stages(docs.sparkSession, "lm-scoring").write(words, "words"), rounds, stride, rate, seed)


def fit_numbered(words: DataFrame, rounds: int = 2, stride: int | None = None, rate: float = 0.5, seed: int = 3):
    """The same from a written table of ``numbered`` texts, which each round reads."""
    spark = words.sparkSession
    words = words.select("buckets", "size")
    got = words.mapInPandas(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(got):
        return None
    counts = np.zeros(1 << BUCKET_BITS)
    counts[got["bucket"].to_numpy()] = got["n"].to_numpy()
    vocabulary = Vocabulary(counts)
    weights = first_weights(vocabulary.prior, seed)
    for k in range(rounds):
        held = spark.sparkContext.broadcast((vocabulary, weights))
        sums = words.mapInPandas(_train_here(held, stride or rounds, k, rate / (k + 1)), "i int, v double, seen double")
        mean = sums.groupBy("i").agg((F.sum("v") / F.sum("seen")).alias("v")).toPandas().sort_values("i")
        if len(mean):  # else no text has a word at this round's places
            weights = _shaped(mean["v"].to_numpy())
        held.unpersist()
    return vocabulary, weights


def scored(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The ``keep`` columns as ``record`` with ``n_words``, ``log_likelihood`` and its mean per word."""
    return score_numbered(numbered(docs, keep), model)


def score_numbered(words: DataFrame, model) -> DataFrame:
    """The same for ``numbered`` texts."""
    held = words.sparkSession.sparkContext.broadcast(model)

    def rows(part: pd.DataFrame, texts: list[np.ndarray]) -> pd.DataFrame:
        sizes = np.array([len(b) for b in texts])
        result = part[["record"]].assign(n_words=sizes.astype(np.int64), log_likelihood=0.0)
        if sizes.sum():
            vocabulary, weights = held.value
            flat = np.concatenate(texts)
            cls = vocabulary.cls[flat]
            context = np.concatenate([contexts(vocabulary.cls[b]) for b in texts if len(b)])
            each = log_probabilities(weights, context, cls.astype(np.int64)) + vocabulary.within[flat]
            result["log_likelihood"] = np.bincount(np.repeat(np.arange(len(sizes)), sizes), each, len(sizes))
        return result

    scores = words.mapInPandas(
        lambda batches: (rows(*found) for found in _parts(batches)), f"record {words.schema['record'].dataType.simpleString()}, n_words long, log_likelihood double"
    )
    return scores.withColumn("mean", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = Stages(spark, "lm-scoring").write(numbered(docs, ["doc_id"]), "words")
    return score_numbered(words, fit_numbered(words)).select("record.doc_id", "n_words", "log_likelihood", "mean")
