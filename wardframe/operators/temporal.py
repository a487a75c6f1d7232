"""Operators over event series ordered by time within a key.

Each takes ``hot`` (see ``skew``). Ordinary keys get the plain, lazy window plan, one exchange and
one sort. The rows of hot keys are written to the shared folder once, windowed slice by slice, and
joined to a summary of their earlier slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wardframe.operators.skew import (
    SLICE,
    HotKeys,
    join_on,
    join_one_per_key,
    keys_apart,
    not_null,
    pin,
    with_slices,
    with_slices_of,
)

_RUNNING = {
    "sum": (F.sum, lambda part, carry: F.coalesce(part + carry, part, carry)),
    "count": (F.count, lambda part, carry: part + F.coalesce(carry, F.lit(0))),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
    "last": (lambda c: F.last(c, ignorenulls=True), F.coalesce),
}


def interval(width: str) -> Column:
    return F.expr(f"INTERVAL {width}")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in whole seconds, each time truncated to its second first."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


@keys_apart("df")
def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: Mapping[str, tuple[str, str]],
    hot: HotKeys | None = None,
    peers: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Cumulative ``{out: (fn, column)}`` per key along ``order``, whose first column is the time.

    ``peers`` takes rows equal on ``order`` into account together (RANGE frame); otherwise the
    frame ends at the row itself and ``order`` should be total. ``fn``: sum, count, min, max, last.
    """
    keys, order = list(keys), list(order)

    def directed(c: str) -> Column:
        return F.desc(c) if descending else F.asc(c)

    def over(group: list[str]) -> W:
        w = W.partitionBy(*group).orderBy(*[directed(c) for c in order])
        return w if peers else w.rowsBetween(W.unboundedPreceding, W.currentRow)

    if hot is None:
        w = over(keys)
        return df.withColumns({out: _RUNNING[fn][0](F.col(c)).over(w) for out, (fn, c) in aggs.items()})

    group = [*keys, SLICE]
    sliced = pin(with_slices(df, order[0], hot))

    def total(fn: str, c: str) -> Column:
        if fn != "last":
            return _RUNNING[fn][0](F.col(c))
        at = F.when(F.col(c).isNotNull(), F.struct(*order))
        return F.min_by(c, at) if descending else F.max_by(c, at)

    before = W.partitionBy(*keys).orderBy(directed(SLICE)).rowsBetween(W.unboundedPreceding, -1)
    merge = {"sum": "sum", "count": "sum", "min": "min", "max": "max", "last": "last"}
    carry = (
        sliced.groupBy(*group)
        .agg(*[total(fn, c).alias(f"_c_{out}") for out, (fn, c) in aggs.items()])
        .select(
            *group,
            *[
                _RUNNING[merge[fn]][0](F.col(f"_c_{out}")).over(before).alias(f"_c_{out}")
                for out, (fn, _) in aggs.items()
            ],
        )
    )
    w = over(group)
    parts = sliced.withColumns(
        {f"_p_{out}": _RUNNING[fn][0](F.col(c)).over(w) for out, (fn, c) in aggs.items()}
    )
    joined = join_on(parts, carry, group, "left")
    return joined.select(
        *df.columns,
        *[
            _RUNNING[fn][1](F.col(f"_p_{out}"), F.col(f"_c_{out}")).alias(out)
            for out, (fn, _) in aggs.items()
        ],
    )


def within_anchor(
    events: DataFrame,
    anchors: DataFrame,
    keys: Sequence[str],
    t: str,
    anchor: str,
    lo: str | None,
    hi: str | None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Events with ``anchor + lo <= t <= anchor + hi``, joined to the one anchor row of their key."""
    joined = join_one_per_key(events, anchors, keys, t, hot)
    start = F.col(anchor) if lo is None else F.col(anchor) + interval(lo)
    end = F.col(anchor) if hi is None else F.col(anchor) + interval(hi)
    return joined.where(F.col(t).between(start, end))


@keys_apart("left", "right")
def asof_backward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    lt: str,
    rt: str,
    cols: Sequence[str],
    tie: str = "row_id",
    how: str = "inner",
    hot: HotKeys | None = None,
) -> DataFrame:
    """The latest right row at or before each left row; equal times take the highest ``tie``.

    Both sides are stacked and the last right row is carried forward: one shuffle, linear. A NULL
    key matches nothing, as in an equi join.
    """
    keys = list(keys)
    right_rows = right.where(not_null([*keys, rt])).select(
        *keys,
        F.col(rt).alias("_t"),
        F.lit(0).alias("_side"),
        F.col(tie).alias("_tie"),
        F.struct(*cols).alias("_right"),
    )
    left_rows = left.select(
        *keys,
        F.col(lt).alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_left"),
    )
    stacked = right_rows.unionByName(left_rows, allowMissingColumns=True)
    matched = running(
        stacked, keys, ["_t", "_side", "_tie"], {"_match": ("last", "_right")}, hot, peers=False
    ).where("_side = 1")
    if how == "inner":
        matched = matched.where(F.col("_match").isNotNull())
    # Keys and time come from the stacked columns, so later windows see the partitioning and order.
    stacked_as = {lt: "_t", **{k: k for k in keys}}
    return matched.select(
        *[F.col(stacked_as.get(c, f"_left.{c}")).alias(c) for c in left.columns], "_match.*"
    )


@keys_apart("df", sliding=True)
def rolling_range(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    specs: Mapping[str, tuple[str, str, str]],
    hot: HotKeys | None = None,
) -> DataFrame:
    """``{out: (fn, column, "6 HOURS")}`` over the trailing time range, current instant included.

    ``fn``: sum, count, min, max, or first of the time column itself. Rows without a time drop out.
    """
    keys = list(keys)
    for fn, c, _ in specs.values():
        if fn == "first" and c != t:
            raise ValueError("first is defined for the time column only: ties have no order")
    specs = {
        out: ("min" if fn == "first" else fn, c, width) for out, (fn, c, width) in specs.items()
    }
    timed = df.where(F.col(t).isNotNull())
    if hot is None:
        return _rolling_plain(timed, keys, t, specs)
    return _rolling_tiled(timed, keys, t, specs, hot).select(*df.columns, *specs)


def _rolling_plain(df, keys, t, specs):
    by = ", ".join(f"`{k}`" for k in keys)
    return df.withColumns(
        {
            out: F.expr(
                f"{fn}(`{c}`) OVER (PARTITION BY {by} ORDER BY `{t}` "
                f"RANGE BETWEEN INTERVAL {width} PRECEDING AND CURRENT ROW)"
            )
            for out, (fn, c, width) in specs.items()
        }
    )


_FIRST, _LAST = "0001-01-01", "9999-12-31"  # before and after all times


def _rolling_tiled(df, keys, t, specs, hot):
    """The same range aggregates from two running ones each, which slices can split.

    With time tiles as wide as the range, ``[t - width, t]`` is the part of t's tile up to t and
    the part of the tile before it from ``t - width`` on. Both are linear in the rows, while a
    sliding frame visits all its rows at every row. Rows are combined per instant first and written once, with the
    slices of t and of every ``t - width``. Then the instants, and a lookup for each at ``t - width``, of all
    widths are dealt by tile and slice together; what earlier and later slices of a tile add stands before
    and after the rows of each slice, so one running aggregate in either direction gives both parts. They
    meet again per instant.
    """
    widths = list(dict.fromkeys(width for *_, width in specs.values()))
    partials = {pair: f"_a{i}" for i, pair in enumerate(dict.fromkeys(s[:2] for s in specs.values()))}
    merged = {name: "sum" if fn == "count" else fn for (fn, _), name in partials.items()}

    instants = df.groupBy(*keys, t).agg(
        *[_RUNNING[fn][0](F.col(c)).alias(name) for (fn, c), name in partials.items()]
    )
    slices = {SLICE: F.col(t), **{f"_p{i}": F.col(t) - interval(w) for i, w in enumerate(widths)}}
    placed = pin(with_slices_of(instants, slices, hot))
    for i, width in enumerate(widths):
        placed = placed.withColumn(f"_tile{i}", F.window(t, width).start)

    group = [*keys, "_w", "_tile", SLICE]
    here = F.array(
        *[F.struct(F.lit(i).alias("_w"), F.col(f"_tile{i}").alias("_tile")) for i in range(len(widths))]
    )
    there = F.array(
        *[
            F.struct(
                F.lit(i).alias("_w"),
                (F.col(f"_tile{i}") - interval(width)).alias("_tile"),
                F.col(f"_p{i}").alias(SLICE),
                (F.col(t) - interval(width)).alias("_at"),
            )
            for i, width in enumerate(widths)
        ]
    )
    data = placed.select(
        *keys, F.inline(here), SLICE, F.col(t).alias("_at"), F.col(t).alias("_of"),
        F.lit(0).alias("_kind"), *merged,
    )
    lookups = placed.select(*keys, F.inline(there), F.col(t).alias("_of"), F.lit(1).alias("_kind"))
    rows = data.unionByName(lookups, allowMissingColumns=True)

    # Slices of a tile that rows or lookups fall into, and what the others before and after them hold.
    by_slice = W.partitionBy(*keys, "_w", "_tile").orderBy(SLICE)
    earlier = by_slice.rowsBetween(W.unboundedPreceding, -1)
    later = by_slice.rowsBetween(1, W.unboundedFollowing)
    totals = rows.groupBy(*group).agg(*[_RUNNING[fn][0](F.col(n)).alias(n) for n, fn in merged.items()])
    edges = [
        totals.select(
            *group,
            F.lit(at).cast(df.schema[t].dataType).alias("_at"),
            F.lit(2).alias("_kind"),
            *[_RUNNING[fn][0](F.col(n)).over(w).alias(n) for n, fn in merged.items()],
        )
        for at, w in ((_FIRST, earlier), (_LAST, later))
    ]
    for edge in edges:
        rows = rows.unionByName(edge, allowMissingColumns=True)

    def run(direction) -> dict[str, Column]:
        w = W.partitionBy(*group).orderBy(direction("_at"))
        kind = "upto" if direction is F.asc else "since"
        return {f"{n}_{kind}": _RUNNING[fn][0](F.col(n)).over(w) for n, fn in merged.items()}

    ran = rows.withColumns({**run(F.asc), **run(F.desc)}).where(F.col("_kind") < 2)

    def part(kind: int, width: str, column: str) -> Column:
        wanted = (F.col("_kind") == kind) & (F.col("_w") == widths.index(width))
        return F.max(F.when(wanted, F.col(column)))

    ranges = ran.groupBy(*keys, F.col("_of").alias(t)).agg(
        *[
            _RUNNING[merged[n]][1](part(0, width, f"{n}_upto"), part(1, width, f"{n}_since")).alias(out)
            for out, (fn, c, width) in specs.items()
            for n in [partials[(fn, c)]]
        ]
    )
    return join_on(df, ranges, [*keys, t], "inner")


@keys_apart("df")
def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Mapping[str, str],
    hot: HotKeys | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Add ``{out: column}`` of the row just before in ``order`` (total, first column the time).

    With ``where``, of the last row before for which it holds.
    """
    keys, order = list(keys), list(order)
    row = F.struct(*[F.col(c).alias(out) for out, c in cols.items()])
    at = F.struct(*order)
    if where is not None:
        row, at = F.when(where, row), F.when(where, at)

    def before(group: list[str]) -> Column:
        w = W.partitionBy(*group).orderBy(*order)
        if where is None:
            return F.lag(row).over(w)
        return F.last(row, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))

    if hot is None:
        found = df.withColumn("_prev", before(keys))
    else:
        group = [*keys, SLICE]
        sliced = pin(with_slices(df, order[0], hot))
        earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
        carry = (
            sliced.groupBy(*group)
            .agg(F.max_by(row, at).alias("_last"))
            .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
            .drop("_last")
        )
        found = sliced.withColumn("_prev", before(group))
        found = join_on(found, carry, group, "left").withColumn("_prev", F.coalesce("_prev", "_carry"))
    return found.select(*df.columns, *[F.col(f"_prev.{out}").alias(out) for out in cols])


@keys_apart("df")
def lag_gap(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    tie: Sequence[str] = (),
    out: str = "gap_seconds",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Whole seconds since the previous event of the key; NULL for the first one."""
    prev = previous_row(df, keys, [t, *tie], {"_prev_t": t}, hot)
    return prev.withColumn(out, seconds_between(F.col(t), F.col("_prev_t"))).drop("_prev_t")


@keys_apart("df")
def prev_within(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    cols: Mapping[str, str],
    width: str,
    tie: Sequence[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """``{out: column}`` of the row just before, if it is strictly less than ``width`` older."""
    prev = previous_row(df, keys, [t, *tie], {**cols, "_prev_t": t}, hot)
    near = F.col("_prev_t") > F.col(t) - interval(width)
    return prev.withColumns({out: F.when(near, F.col(out)) for out in cols}).drop("_prev_t")


@keys_apart("df")
def rolling_median(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    before: int = 1,
    after: int = 1,
    out: str = "median",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Lower median of the rows around each row in ``order`` (total); NULL values do not count."""
    keys, order = list(keys), list(order)
    item = F.struct(F.col(value).alias("v"))

    def lower_median(items: Column) -> Column:
        values = F.array_sort(F.filter(items, lambda v: v.isNotNull()))
        return F.get(values, ((F.size(values) - 1) / F.lit(2)).cast("int"))

    if hot is None:
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(-before, after)
        return df.withColumn(out, lower_median(F.collect_list(value).over(w)))

    group = [*keys, SLICE]
    sliced = pin(with_slices(df, order[0], hot))
    w = W.partitionBy(*group).orderBy(*order)
    backwards = W.partitionBy(*group).orderBy(*[F.desc(c) for c in order])
    # The first and last few rows of each slice, newest first, are what its neighbours need.
    # Every slice present has at least one row, so `before` slices hold `before` rows.
    edges = sliced.withColumns(
        {"_rank": F.row_number().over(w), "_back": F.row_number().over(backwards)}
    )
    edges = (
        edges.where((F.col("_rank") <= after) | (F.col("_back") <= before))
        .groupBy(*group)
        .agg(
            F.array_sort(
                F.collect_list(F.when(F.col("_back") <= before, F.struct("_back", item.alias("i"))))
            ).alias("_tail"),
            F.array_sort(
                F.collect_list(F.when(F.col("_rank") <= after, F.struct("_rank", item.alias("i"))))
            ).alias("_head"),
        )
    )
    by_slice = W.partitionBy(*keys).orderBy(SLICE)
    earlier = F.collect_list("_tail").over(by_slice.rowsBetween(-max(before, 1), -1))
    later = F.collect_list("_head").over(by_slice.rowsBetween(1, max(after, 1)))
    edges = edges.select(
        *group,
        F.transform(F.flatten(F.reverse(earlier)), lambda e: e["i"]).alias("_earlier"),
        F.transform(F.flatten(later), lambda e: e["i"]).alias("_later"),
    )
    shifted = sliced.withColumns(
        {
            "_rank": F.row_number().over(w),
            **{f"_lag{i}": F.lag(item, i).over(w) for i in range(1, before + 1)},
            **{f"_lead{j}": F.lead(item, j).over(w) for j in range(1, after + 1)},
        }
    )
    shifted = join_on(shifted, edges, group, "left")
    leads = sum((F.col(f"_lead{j}").isNotNull().cast("int") for j in range(1, after + 1)), F.lit(0))
    around = [
        F.coalesce(F.col(f"_lag{i}"), F.get("_earlier", F.lit(i) - F.col("_rank")))
        for i in range(1, before + 1)
    ] + [
        F.coalesce(F.col(f"_lead{j}"), F.get("_later", F.lit(j - 1) - leads))
        for j in range(1, after + 1)
    ]
    items = F.array(F.col(value), *[a["v"] for a in around])
    return shifted.withColumn(out, lower_median(items)).select(*df.columns, out)


@keys_apart("df")
def running_max(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    col: str,
    out: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Highest ``col`` so far, the current instant included; rows without a time drop out."""
    timed = df.where(F.col(t).isNotNull())
    highest = running(timed, keys, [t], {"_highest": ("max", col)}, hot)
    if out is None or out == col:
        return highest.withColumn(col, F.col("_highest")).drop("_highest")
    return highest.withColumnRenamed("_highest", out)


@keys_apart("df")
def sessionize(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    new_flag: str,
    keep: Column,
    require: Column,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Episodes ``(keys, seq, starttime, endtime, duration_hours)`` of a series.

    ``new_flag`` (0/1) opens an episode; it counts on all rows, but only rows with ``keep`` belong
    to one. Episodes of zero length, or without any row with ``require``, are dropped.
    """
    keys = list(keys)
    numbered = running(df, keys, [t], {"_grp": ("sum", new_flag)}, hot)
    episodes = (
        numbered.where(keep)
        .groupBy(*keys, "_grp")
        .agg(
            F.min(t).alias("starttime"),
            F.max(t).alias("endtime"),
            F.max(require.cast("int")).alias("_required"),
        )
        .where((F.col("starttime") != F.col("endtime")) & (F.col("_required") == 1))
    )
    # Episodes of a key do not overlap, so their start times order them as the groups do.
    counted = running(episodes, keys, ["starttime"], {"seq": ("count", "starttime")}, hot)
    hours = seconds_between(F.col("endtime"), F.col("starttime")).cast("double") / 60 / 60
    return counted.select(
        *keys, F.col("seq"), "starttime", "endtime", hours.alias("duration_hours")
    )


def overlap_flag(
    stays: DataFrame,
    episodes: DataFrame,
    key: str,
    anchor: str,
    width: str,
    out: str = "flag",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Stays with 1 if an episode covers the anchor or starts within ``width`` after it, else 0."""
    a, start, end = F.col(anchor), F.col("starttime"), F.col("endtime")
    covers = (start <= a) & (end >= a)
    starts = (start >= a) & (start <= a + interval(width))
    spans = episodes.select(key, "starttime", "endtime")
    hits = (
        join_one_per_key(spans, stays.select(key, anchor), [key], "starttime", hot)
        .where(covers | starts)
        .select(key)
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    return (
        stays.join(hits, key, "left")
        .withColumn(out, F.coalesce("_hit", F.lit(0)))
        .drop("_hit")
    )


def pick_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False
) -> DataFrame:
    """The first (or last) row per key in ``order`` (total), by an aggregate that combines map-side."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
