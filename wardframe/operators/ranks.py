"""Exact quantiles by rank, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from wardframe.operators.skew import HotKeys, join_on, keys_apart, pin

_PART = "_part"


@keys_apart("df")
def lower_quantile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    q: float = 0.5,
    out: str = "quantile",
    hot: HotKeys | None = None,
) -> DataFrame:
    """The smallest value that at least the share ``q`` of a key's values does not exceed; 0.5 is the
    lower median. NULL values do not count, and a key with no other has a NULL.

    Ordinary keys get one aggregate, whose buffer holds a key's distinct values. Of hot keys the values are
    counted first, so that one row per key and value is left, and these are dealt into ranges by
    key and value. Running counts go over a key's ranges (a row each), which finds the range with the
    wanted rank, and then over that range's rows alone.
    """
    keys = list(keys)
    if not 0 < q <= 1:
        raise ValueError(f"the share must be above 0 and at most 1, not {q}")
    if hot is None:
        wanted = F.expr(f"percentile_disc({q}D) WITHIN GROUP (ORDER BY `{value}`)")
        return df.groupBy(*keys).agg(wanted.alias(out))

    counts = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    # Written, as ranges come from a sample of the rows: read twice, they must be the same.
    ranges = pin(counts.repartitionByRange(*keys, "_value").withColumn(_PART, F.spark_partition_id()))
    known = ranges.where(F.col("_value").isNotNull())
    by_range = W.partitionBy(*keys).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    totals = (
        known.groupBy(*keys, _PART)
        .agg(F.sum("_n").alias("_n"))
        .select(
            *keys,
            _PART,
            "_n",
            F.coalesce(F.sum("_n").over(by_range), F.lit(0)).alias("_before"),
            F.sum("_n").over(W.partitionBy(*keys)).alias("_all"),
        )
    )
    rank = F.greatest(F.ceil(F.col("_all") * F.lit(float(q))), F.lit(1))
    place = totals.select(*keys, _PART, "_before", "_n", rank.alias("_rank")).where(
        (F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_n"))
    )
    inside = W.partitionBy(*keys).orderBy("_value")
    near = join_on(known, place.drop("_n"), [*keys, _PART], "inner").withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(inside)
    )
    found = near.where(F.col("_upto") >= F.col("_rank")).groupBy(*keys).agg(F.min("_value").alias(out))
    return join_on(ranges.select(*keys).distinct(), found, keys, "left")
