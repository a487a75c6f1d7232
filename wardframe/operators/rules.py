"""Rule operators: conditional aggregates, code sets, bands, categories and unit conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

_AGGS = {"min": F.min, "max": F.max, "mean": F.avg, "sum": F.sum}


def without_errors(flag: str = "error") -> Column:
    """Rows not marked as erroneous; an unset flag is no error."""
    return ~F.col(flag).eqNullSafe(F.lit(1))


def pivot_agg(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    value: str,
    mapping: Mapping[str, object],
    aggs: Sequence[str],
) -> DataFrame:
    """One pass of ``{name}_{agg}`` over the values whose ``code`` is ``mapping[name]``."""
    return df.groupBy(*keys).agg(
        *[
            _AGGS[agg](F.when(F.col(code) == F.lit(wanted), F.col(value))).alias(f"{name}_{agg}")
            for name, wanted in mapping.items()
            for agg in aggs
        ]
    )


def code_flag(
    diagnoses: DataFrame, keys: Sequence[str], code: str, codes: Sequence, out: str = "label"
) -> DataFrame:
    """Per key: is any of its codes in the set; a NULL code decides nothing."""
    return diagnoses.groupBy(*keys).agg(F.bool_or(F.col(code).isin(list(codes))).alias(out))


def band(rules: Sequence[tuple], default: object, known: str | None = None) -> Column:
    """Score of the first rule ``(SQL condition, score, ...)`` that holds, else ``default``.

    NULL if ``known`` is NULL. A condition that is NULL does not hold.
    """
    chosen = F.when(F.col(known).isNull(), None) if known else F
    for condition, score, *_ in rules:
        chosen = chosen.when(F.expr(condition), F.lit(score))
    return chosen.otherwise(F.lit(default))


def band_value(rules: Sequence[tuple], default: Column, known: str | None = None) -> Column:
    """The value behind the first rule ``(SQL condition, score, value column)`` that holds."""
    chosen = F.when(F.col(known).isNull(), None) if known else F
    for condition, _, value in rules:
        chosen = chosen.when(F.expr(condition), F.col(value))
    return chosen.otherwise(default)


def categorize(text: str, rules: Sequence[tuple], default: object) -> Column:
    """Bucket of the first rule ``(bucket, prefixes, exact texts)`` that matches, case-sensitive."""
    chosen = F
    for bucket, prefixes, exact in rules:
        match = F.col(text).isin(exact) if exact else F.lit(False)
        for prefix in prefixes:
            match = match | F.col(text).startswith(prefix)
        chosen = chosen.when(match, F.lit(bucket))
    return chosen.otherwise(F.lit(default))


class Unit(NamedTuple):
    """How to read one measurement code: ``(value - shift) * factor / divisor``, if in range."""

    itemid: int
    concept: str
    shift: float = 0.0
    factor: float = 1.0
    divisor: float = 1.0
    low: float | None = None  # exclusive
    high: float | None = None
    closed: bool = False  # high is inclusive


def normalize_units(
    events: DataFrame,
    units: Sequence[Unit],
    code: str = "itemid",
    value: str = "valuenum",
    error: str | None = "error",
    out: str = "value_norm",
    keep_out_of_range: bool = False,
) -> DataFrame:
    """Events of the listed codes with ``concept`` and the value in common units.

    Erroneous rows drop out, and so do values out of range (judged before conversion), unless they
    are kept with a NULL concept. The unit table has a fixed size, so it is broadcast; the plain
    code filter reaches the scan.
    """
    schema = (
        f"`{code}` int, concept string, _shift double, _factor double, _divisor double, "
        "_low double, _high double, _closed boolean"
    )
    table = events.sparkSession.createDataFrame([tuple(u) for u in units], schema)
    wanted = events.where(F.col(code).isin([u.itemid for u in units]))
    if error is not None:
        wanted = wanted.where(without_errors(error))
    v = F.col(value)
    in_range = (F.col("_low").isNull() | (v > F.col("_low"))) & (
        F.col("_high").isNull()
        | (v < F.col("_high"))
        | (F.col("_closed") & (v == F.col("_high")))
    )
    joined = wanted.join(F.broadcast(table), code)
    if keep_out_of_range:
        joined = joined.withColumn("concept", F.when(in_range, F.col("concept")))
    else:
        joined = joined.where(in_range)
    converted = (v - F.col("_shift")) * F.col("_factor") / F.col("_divisor")
    return joined.select(*events.columns, "concept", converted.alias(out))
