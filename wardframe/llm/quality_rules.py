"""Quality rules: plain base rules, then robust multivariate outliers per language and source.

Every text is turned into word and line counts, and these into a transformed statistic vector. For
each (language, source) the minimum-covariance-determinant estimate is found by concentration steps
over all rows: take the half of the rows nearest to the current centre, re-estimate centre and
covariance from them, repeat. Two deterministic starts run side by side and the one with the smaller
determinant wins. A row whose squared Mahalanobis distance passes the chi-square quantile of the tail is
rejected. Shares (symbols, repeated lines and words) enter as square roots, which spreads a binomial share
alike over its range; in the last distance only their excess over the centre counts.

Nothing is sampled. A step is two map-side combined aggregates over a small staged table: a count
per (group, start, distance bin), whose running sum gives the half, then sums of x and of x*x'.
A group that holds a third of all rows is a handful of sums like any other.

Groups with fewer than ``least`` rows pool per language, and pools still smaller pool together; if
even that is smaller, or spread cannot be told, its rows are kept. Each axis has a smallest spread, so
a statistic that is the same in most rows (no repeated line at all) can't make the covariance singular.

Null or empty texts and texts of white space have no words and fail the base rules. Null language
or source is a value of its own. Repeated rows count as often as they occur and get equal verdicts.
All input columns are carried as ``record``, so their names can't clash.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardframe.llm.common import Stages, per_row, table, words_of

SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Transformed statistics, in order, with the smallest spread that counts as spread on each axis.
AXES = {"length": 0.25, "word_length": 0.05, "symbols": 0.05, "dup_lines": 0.1, "repeats": 0.1}
#: Axes on which only more than usual is bad.
ONE_SIDED = {"symbols", "dup_lines", "repeats"}
K = len(AXES)
BINS_PER_OCTAVE = 64

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a whole text."""
    words = words_of(text)
    n = len(words)
    if not n:
        return 0, 0, len(SYMBOLS.findall(text or "")), 0, 0, 0
    # Characters of words: all but the separators, which are one code point each.
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return n, chars, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeat_words(words), len(lines)


def repeat_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.int64, count=len(words))
    size = len(ids)
    if size > 2_000_000:  # three numbers no longer fit in 63 bits: number the pairs first
        _, pairs = np.unique(w[:-1] * size + w[1:], return_inverse=True)
        keys = pairs[:-1] * size + w[2:]
    else:
        keys = (w[:-2] * size + w[1:-1]) * size + w[2:]
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + n] |= twice
    return int(covered.sum())


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (by default all but the text) as ``record``, beside the counts."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), F.col(f"`{text}`").alias("text"))
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def count(batches):
        def rows(part: pd.DataFrame) -> pd.DataFrame:
            out = pd.DataFrame([text_counts(t if isinstance(t, str) else None) for t in part["text"]], columns=names, index=part.index)
            return pd.concat([part[["record"]], out], axis=1)

        return per_row(batches, rows)

    schema = f"record {slim.schema['record'].dataType.simpleString()}, {COUNTS}"
    return slim.mapInPandas(count, schema)


def _vector() -> dict[str, Column]:
    n, chars, lines = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("n_words", "word_chars", "n_lines"))
    # The constant keeps one symbol, line or phrase of a short text from being a large share.
    share = lambda a, b, more: F.sqrt(F.col(a) / (b + more))
    return {
        "length": F.log(n),
        "word_length": F.log(chars / n),
        "symbols": share("n_symbols", chars, 100.0),
        "dup_lines": share("n_dup_lines", lines, 10.0),
        "repeats": share("n_repeat_words", n, 50.0),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def robust_outliers(counted: DataFrame, lang: str, source: str, least: int = 200, steps: int = 8, half: float = 0.5, tail: float = 1e-4) -> DataFrame:
    """``counted`` with ``distance`` (squared, null where no estimate holds) and ``kept``.

    A normal vector passes the cutoff with probability ``tail``: the squared distance may be at most the
    chi-square quantile of 1 - ``tail``.
    """
    cutoff = _chi2_quantile(1 - tail, K)
    spark = counted.sparkSession
    stages = Stages(spark, "quality-rules")
    rows = stages.write(
        counted.select("*", base_failed().alias("base_failed"), *[v.alias(f"x_{a}") for a, v in _vector().items()])
        .withColumn("at", F.monotonically_increasing_id()),
        "rows",
    )
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(a) for c, a in ((lang, "lang"), (source, "source")))
    xs = [F.col(f"x_{a}").alias(f"x{i}") for i, a in enumerate(AXES)]
    fit = rows.where(~F.col("base_failed")).select("at", lang, source, *xs)
    keys = _pools(fit, least)
    fit = stages.write(fit.join(keys, ["lang", "source"]).select("at", "pool", *[f"x{i}" for i in range(K)]), "fit")

    models = stages.write(_starts(fit), "models0")
    for step in range(1, steps + 1):
        models = stages.write(_concentrate(fit, models, half), f"models{step}")
        if step > 1:
            stages.drop(f"models{step - 1}")
    best = (
        models.groupBy("pool").agg(F.min_by(F.struct("m", "inv"), F.struct("logdet", "start")).alias("b"))
        .select("pool", "b.*")
    )
    far = fit.join(best, "pool").select("at", _distance(ONE_SIDED).alias("distance"))
    scored = rows.join(far, "at", "left")
    return scored.drop("at", *[f"x_{a}" for a in AXES]).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)
    )


def _pools(fit: DataFrame, least: int) -> DataFrame:
    """The pool of every (language, source): itself, its language's rest, or the rest of all; none if that is too small."""
    n = fit.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    rest = n.where(F.col("n") < least).groupBy("lang").agg(F.sum("n").alias("rest"))
    pools = n.join(rest, "lang", "left").select(
        "lang",
        "source",
        "n",
        F.when(F.col("n") >= least, F.concat(F.lit("s\0"), "lang", F.lit("\0"), "source"))
        .when(F.col("rest") >= least, F.concat(F.lit("l\0"), "lang"))
        .otherwise(F.lit("all"))
        .alias("pool"),
    )
    large = pools.groupBy("pool").agg(F.sum("n").alias("rows")).where(F.col("rows") >= least)
    return pools.drop("n").join(large, "pool", "left_semi")


def _starts(fit: DataFrame) -> DataFrame:
    """Two starts per pool: the medians with their absolute deviations, and half that spread."""
    med = fit.groupBy("pool").agg(*[F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"c{i}") for i in range(K)])
    mad = (
        fit.join(med, "pool")
        .groupBy("pool")
        .agg(
            *[F.first(f"c{i}").alias(f"c{i}") for i in range(K)],
            *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), 0.5, 1000).alias(f"d{i}") for i in range(K)],
        )
    )
    floors = list(AXES.values())

    def build(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                m = [float(getattr(r, f"c{i}")) for i in range(K)]
                sd = np.array([max(1.4826 * float(getattr(r, f"d{i}")), floors[i]) for i in range(K)])
                for start, spread in enumerate((sd, np.array(floors))):
                    out.append((r.pool, start, m, list(np.diag(1 / spread**2).ravel()), 2 * float(np.log(spread).sum())))
            yield pd.DataFrame(out, columns=["pool", "start", "m", "inv", "logdet"])

    return mad.mapInPandas(build, "pool string, start int, m array<double>, inv array<double>, logdet double")


def _distance(one_sided: set[str] = frozenset()) -> Column:
    d = [F.col(f"x{i}") - F.col("m")[i] for i in range(K)]
    d = [F.greatest(x, F.lit(0.0)) if a in one_sided else x for a, x in zip(AXES, d)]
    total = F.lit(0.0)
    for i in range(K):
        for j in range(i, K):
            term = d[i] * d[j] * F.col("inv")[i * K + j]
            total = total + (term if i == j else 2 * term)
    return F.greatest(total, F.lit(1e-9))


def _concentrate(fit: DataFrame, models: DataFrame, half: float) -> DataFrame:
    """One concentration step: moments of each pool's nearest half, and the next model from them."""
    measured = fit.join(models, "pool").select(
        "pool", "start", *[f"x{i}" for i in range(K)],
        F.floor(F.log2(_distance()) * BINS_PER_OCTAVE).cast("int").alias("bin"),
    )
    bins = measured.groupBy("pool", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("pool", "start")
    edge = (
        bins.withColumn("upto", F.sum("n").over(by.orderBy("bin")))
        .withColumn("all", F.sum("n").over(by))
        .where(F.col("upto") >= F.col("all") * half)
        .groupBy("pool", "start")
        .agg(F.min("bin").alias("edge"), F.first("all").alias("rows"))
    )
    pairs = [(i, j) for i in range(K) for j in range(i, K)]
    sums = (
        measured.join(edge, ["pool", "start"])
        .where(F.col("bin") <= F.col("edge"))
        .groupBy("pool", "start")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.first("rows").alias("rows"),
            *[F.sum(f"x{i}").alias(f"s{i}") for i in range(K)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs],
        )
    )
    floors = np.array(list(AXES.values()))

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                n = float(r.n)
                m = np.array([getattr(r, f"s{i}") for i in range(K)]) / n
                c = np.zeros((K, K))
                for i, j in pairs:
                    c[i, j] = c[j, i] = getattr(r, f"s{i}_{j}") / n - m[i] * m[j]
                # The nearest half understates the spread; scale it to the normal law, then floor.
                c = c * (1 / _half_factor(n / float(r.rows)))
                c[np.diag_indices(K)] = np.maximum(c[np.diag_indices(K)], 0)
                c = c + np.diag(floors**2)
                out.append((r.pool, int(r.start), list(m), list(np.linalg.inv(c).ravel()), float(np.linalg.slogdet(c)[1])))
            yield pd.DataFrame(out, columns=["pool", "start", "m", "inv", "logdet"])

    return sums.mapInPandas(solve, "pool string, start int, m array<double>, inv array<double>, logdet double")


def _half_factor(share: float) -> float:
    """Variance of a normal vector's nearest ``share`` of rows over its full variance.

    That is P(chi2(K+2) <= q) / share with q the chi-square(K) quantile of the share; K is odd, so
    both distribution functions have a closed form.
    """
    share = min(max(share, 0.05), 1.0)
    if share > 0.999:
        return 1.0
    return _chi2_cdf(_chi2_quantile(share, K), K + 2) / share


def _chi2_quantile(share: float, k: int) -> float:
    """For odd k."""
    lo, hi = 0.0, 200.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, k) < share else (lo, mid)
    return lo


def _chi2_cdf(q: float, k: int) -> float:
    """For odd k."""
    if q <= 0:
        return 0.0
    value, term = math.erf(math.sqrt(q / 2)), math.sqrt(2 * q / math.pi) * math.exp(-q / 2)
    for i in range(1, k, 2):
        value -= term
        term *= q / (i + 2)
    return value


def op10_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = with_counts(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return robust_outliers(counted, "record.lang", "record.source").select(
        F.col("record.doc_id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance",
    )
