"""Splitting hot keys into time slices.

A window over ``(subject_id, hadm_id)`` puts a whole admission into one task. Most admissions
are small, but one key may hold a large share of the table. ``measure_hot_keys`` looks for such
keys once per event table and cuts each of them, and only them, into slices of its own event
times. The operators then window over ``(keys, slice)`` and carry a one-row summary from slice to
slice, so no task holds more than a slice.

Finding the cuts is a job like any other: rows per key, then, for the hot keys, rows per second, a running
count over the seconds of an hour and one over hours, and a cut wherever that count fills a slice. No
list of keys or cuts is bounded, and none comes to the driver. A key may be NULL like any other value.

Slices depend on the key and the time only: rows of one second stay together, a filtered subset
of the table keeps the bound, and every branch of a plan agrees on them because the cut points
are a written table once measured.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wardframe.session import shared_folder

SLICE = "_slice"

MAX_ROWS = 2_000_000  # rows of one key that one task handles unsplit
SLIDING_ROWS = 100_000  # the same for sliding frames, where every row visits its whole frame


@dataclass(frozen=True)
class HotKeys:
    """Cut points per hot key: ``cuts`` has the key columns, ``_rows`` and a sorted array ``_cuts`` of less
    than ``2**bits`` times.

    Keys with more than ``max_rows`` rows are hot for every job, the others listed only for
    sliding frames. The rows at hand can be of listed keys ``alone`` (see ``keys_apart``).
    """

    keys: tuple[str, ...]
    cuts: DataFrame
    largest: int
    max_rows: int
    alone: bool = False
    bits: int = 30

    def for_scans(self) -> HotKeys | None:
        """The keys that are hot for jobs without sliding frames."""
        if self.alone:
            return self
        if self.largest <= self.max_rows:
            return None
        return replace(self, cuts=self.cuts.where(F.col("_rows") > self.max_rows))


def not_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys, where NULL equals NULL; ``keys`` appear once, from the left."""
    named = right.select(*[F.col(c).alias(f"_on_{c}" if c in keys else c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_on_{k}" for k in keys])


def measure_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    max_rows: int = MAX_ROWS,
    sliding_rows: int = SLIDING_ROWS,
) -> HotKeys | None:
    """Find keys with too many rows for one task, and their cut points; None if there are none.

    Runs at once and writes the cut points, one row per hot key. Only the size of the largest
    key comes back.
    """
    keys = list(keys)
    timed = df.where(F.col(t).isNotNull()).select(*keys, t)
    hot = pin(timed.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > sliding_rows))
    largest = hot.agg(F.max("_rows")).first()[0]
    if largest is None:
        return None
    second = F.date_trunc("second", F.col(t)).cast(timed.schema[t].dataType)
    per_second = (
        join_on(timed, hot.select(*keys), keys, "left_semi")
        .groupBy(*keys, second.alias("_at"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_hour", F.date_trunc("hour", "_at"))
    )
    # Rows before each second: those of earlier hours, and those of the hour so far.
    hours = W.partitionBy(*keys).orderBy("_hour").rowsBetween(W.unboundedPreceding, -1)
    earlier = (
        per_second.groupBy(*keys, "_hour")
        .agg(F.sum("_n").alias("_n"))
        .select(*keys, "_hour", F.coalesce(F.sum("_n").over(hours), F.lit(0)).alias("_before"))
    )
    inside = W.partitionBy(*keys, "_hour").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    placed = join_on(
        per_second.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))),
        earlier, [*keys, "_hour"], "inner",
    )
    number = F.floor((F.col("_before") + F.col("_inside")) / F.lit(sliding_rows))
    cuts = (
        placed.groupBy(*keys, number.alias("_number"))
        .agg(F.min("_at").alias("_from"))
        .where("_number > 0")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_from")).alias("_cuts"))
    )
    cuts = pin(join_on(hot, cuts, keys, "inner"))
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
    return HotKeys(tuple(keys), cuts, largest, max_rows, bits=most.bit_length())


def _slice_of(t: Column, bits: int) -> Column:
    """Number of cuts at or before ``t``, by binary search in the sorted array ``_cuts``."""
    cuts = F.col("_cuts")
    if not bits:
        return F.lit(0)
    steps = F.array(*[F.lit(2**p) for p in range(bits - 1, -1, -1)])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda i, s: i + F.when(F.get(cuts, i + s - F.lit(1)) <= t, s).otherwise(F.lit(0)),
    )
    return F.when(cuts.isNull(), F.lit(0)).otherwise(found)


def with_slices(df: DataFrame, t: str, hot: HotKeys) -> DataFrame:
    """Add ``_slice``, 0 for keys that are not hot."""
    return with_slices_of(df, {SLICE: F.col(t)}, hot)


def with_slices_of(df: DataFrame, times: Mapping[str, Column], hot: HotKeys) -> DataFrame:
    """Add the slice that each time falls into, by name; 0 for keys that are not hot.

    Spark broadcasts the cuts if they are under its own size threshold; beyond that it splits the
    hot side of the join, which has one row per key on the other.
    """
    return (
        join_on(df, hot.cuts, hot.keys, "left")
        .withColumns({name: _slice_of(t, hot.bits) for name, t in times.items()})
        .drop("_cuts", "_rows")
    )


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that its plan is not repeated.

    A split operator reads its input twice (rows and slice summaries); chained, that would double
    with every step. A written table also outlives the executors that made it.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys)."""
    listed = hot.cuts.select(*hot.keys)
    return tuple(join_on(df, listed, hot.keys, how) for how in ("left_anti", "left_semi"))


def keys_apart(*inputs: str, sliding: bool = False) -> Callable:
    """Decorate a job that treats every key by itself and takes ``hot``.

    Ordinary keys then run through the job's plain, lazy plan, and only the rows of hot keys
    through its split one, so that what the split plan writes down is the hot rows. ``inputs``
    names the parameters that hold rows by key. Jobs may nest: inner ones see ``hot.alone``.
    ``sliding``: the job has sliding frames, so more keys are too large for it.
    """

    def decorate(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(job)

        @wraps(job)
        def apart(*args, **kwargs) -> DataFrame:
            call = signature.bind(*args, **kwargs)
            hot = call.arguments.get("hot")
            if hot is not None and not sliding:
                hot = call.arguments["hot"] = hot.for_scans()
            if hot is None or hot.alone:
                return job(**call.arguments)
            parts = []
            for which, heat in ((0, None), (1, replace(hot, alone=True))):
                rows = {n: split_hot(call.arguments[n], hot)[which] for n in inputs}
                parts.append(job(**{**call.arguments, **rows, "hot": heat}))
            return parts[0].unionByName(parts[1])

        return apart

    return decorate


def join_one_per_key(
    events: DataFrame,
    one_per_key: DataFrame,
    keys: Sequence[str],
    t: str,
    hot: HotKeys | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join an event series to a table with one row per key.

    Spark broadcasts the small side if it is under its own size threshold. Beyond that both sides
    shuffle by key, so a hot key is spread by its slices and its one row repeated per slice. As in any
    equi join, a NULL key matches nothing.
    """
    keys = list(keys)
    hot = hot and hot.for_scans()
    if hot is None:
        return events.join(one_per_key, keys, how)
    spread = (
        one_per_key.join(hot.cuts, list(hot.keys), "left")
        .withColumn(
            SLICE, F.explode(F.sequence(F.lit(0), F.coalesce(F.size("_cuts"), F.lit(0))))
        )
        .drop("_cuts", "_rows")
    )
    joined = with_slices(events, t, hot).join(spread, [*keys, SLICE], how)
    return joined.drop(SLICE)
