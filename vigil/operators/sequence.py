"""Sequential window helpers that survive a hot key.

A window ``partitionBy(device).orderBy(when)`` sends all rows of a device to
one task.  When one device holds a large share of the rows, these helpers cut
its rows into time slices ``floor(when / split_seconds)`` and work in two
levels:

1. a window per (device, slice) gives the local previous / next row and a
   local running sum;
2. a per-slice summary (one row per slice: first and last time, local total)
   is windowed per device over the slices, which is small, and joined back on
   (device, slice).  The rows side is already partitioned by (device, slice)
   from step 1, so only the small summary moves.

With ``split_seconds=None`` the plain one-level window is used.

``keyed_cumsum`` does the same along any order: rows are range-partitioned by
(key, order), so a hot key spreads over as many partitions as it fills.
``halo_slices`` gives every time slice copies of the rows around it, so that
range frames can run per slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "__slice"


def neighbour_times(df: DataFrame, keys, time_col: str = "when",
                    split_seconds: int | None = None,
                    prev_name: str = "Prev_TimeStamp",
                    next_name: str = "Next_TimeStamp",
                    gap: int | None = None, flag_name: str | None = None,
                    run_name: str | None = None, slice_col: str | None = None) -> DataFrame:
    """Add previous/next time per ``keys`` ordered by ``time_col``.

    If ``gap`` is given, also add ``flag_name`` = 1 when the time since the
    previous row is strictly over ``gap`` (0 otherwise, also on the first
    row) and ``run_name`` = running sum of that flag (0-based ids).

    ``slice_col`` names a column that holds the time slice, as laid-out tables do
    (sources/layout.py); it takes the place of ``split_seconds`` and is kept.
    """
    keys = list(keys)
    t = F.col(time_col)
    if split_seconds is None and slice_col is None:
        w = Window.partitionBy(*keys).orderBy(time_col)
        out = df.withColumns({prev_name: F.lag(t).over(w), next_name: F.lead(t).over(w)})
        if gap is not None:
            out = out.withColumn(
                flag_name, F.when(t - F.col(prev_name) > gap, 1).otherwise(0))
            out = out.withColumn(run_name, F.sum(flag_name).over(
                w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return out

    part = slice_col or _SLICE
    sliced = df if slice_col else df.withColumn(part, F.floor(t / split_seconds))
    w_loc = Window.partitionBy(*keys, part).orderBy(time_col)
    loc = sliced.withColumns({"__lp": F.lag(t).over(w_loc), "__ln": F.lead(t).over(w_loc)})
    if gap is not None:
        loc = loc.withColumn("__lf", F.when(t - F.col("__lp") > gap, 1).otherwise(0))
        loc = loc.withColumn("__lc", F.sum("__lf").over(
            w_loc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    aggs = [F.min(t).alias("__first"), F.max(t).alias("__last")]
    if gap is not None:
        aggs.append(F.sum("__lf").alias("__inner"))
    summary = loc.groupBy(*keys, part).agg(*aggs)
    w_s = Window.partitionBy(*keys).orderBy(part)
    summary = summary.withColumns({
        "__pl": F.lag("__last").over(w_s),
        "__nf": F.lead("__first").over(w_s),
    })
    keep = [*keys, part, "__pl", "__nf"]
    if gap is not None:
        summary = summary.withColumn(
            "__sf", F.when(F.col("__first") - F.col("__pl") > gap, 1).otherwise(0))
        summary = summary.withColumn(
            "__off", F.coalesce(F.sum(F.col("__sf") + F.col("__inner")).over(
                w_s.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        keep += ["__sf", "__off"]
    joined = loc.join(summary.select(*keep), on=[*keys, part], how="left")
    cols = {
        prev_name: F.coalesce(F.col("__lp"), F.col("__pl")),
        next_name: F.coalesce(F.col("__ln"), F.col("__nf")),
    }
    if gap is not None:
        first_in_slice = F.col("__lp").isNull()
        cols[flag_name] = F.when(first_in_slice, F.col("__sf")).otherwise(F.col("__lf"))
        cols[run_name] = F.col("__off") + F.col("__sf") + F.col("__lc")
    out = joined.withColumns(cols)
    return out.drop(_SLICE, "__lp", "__ln", "__lf", "__lc", "__pl", "__nf", "__sf", "__off")


def runs_after(df: DataFrame, keys, mark, time_col: str, split_seconds: int, flag_name: str,
               run_name: str) -> DataFrame:
    """Number the runs of rows that end with a marked row: ``flag_name`` = 1
    on the row after one where ``mark`` holds, ``run_name`` = running sum of
    it (0-based), per ``keys`` in the order of ``time_col``, by time slice.

    Inside a slice the flag is the mark of the row before, and the running
    sum counts the marks before the row, so the whole summary of a slice is
    its number of marks; whether the row before a slice was marked is carried
    with the count."""
    keys = list(keys)
    sliced = df.withColumn(_SLICE, F.floor(F.col(time_col) / split_seconds)).withColumn(
        "__mark", mark.cast("int"))
    w = Window.partitionBy(*keys, _SLICE).orderBy(time_col)
    local = sliced.withColumns({
        "__before": F.lag("__mark").over(w),
        "__count": F.coalesce(F.sum("__mark").over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    totals = sliced.groupBy(*keys, _SLICE).agg(
        F.sum("__mark").alias("__marks"), F.max_by("__mark", time_col).alias("__last"))
    ws = Window.partitionBy(*keys).orderBy(_SLICE)
    totals = totals.select(*keys, _SLICE, F.lag("__last").over(ws).alias("__carried"), F.coalesce(
        F.sum("__marks").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    out = local.join(totals, [*keys, _SLICE])
    return out.withColumns({
        flag_name: F.coalesce("__before", "__carried", F.lit(0)),
        run_name: F.col("__off") + F.col("__count"),
    }).drop(_SLICE, "__mark", "__before", "__count", "__carried", "__off")


def slice_bounds(df: DataFrame, order_col: str, slices: int) -> list[float]:
    """Inner bounds of ``slices`` ranges with about equally many rows, from
    approximate quantiles (at most ``slices - 1`` numbers, read by the driver;
    repeated bounds collapse)."""
    at = [k / slices for k in range(1, slices)]
    cuts = df.approxQuantile(order_col, at, 0.1 / slices) if at else []
    return sorted(set(cuts))


def global_cumsum(df: DataFrame, order_col: str, sum_cols, slices: int = 256,
                  descending: bool = False) -> DataFrame:
    """Running sums of ``sum_cols`` over the whole frame ordered by the
    (unique) ``order_col``, without a single-partition window.

    Rows are cut into ranges of ``order_col`` with about equally many rows
    (so crowded values spread): a window per range gives the local running
    sums, and the range totals (at most ``slices`` rows, so broadcasting them
    is bounded) give each range its offset.  Adds ``<c>_cum`` for every
    column.
    """
    sum_cols = list(sum_cols)
    cuts = slice_bounds(df, order_col, slices)
    b = F.lit(0)
    if cuts:
        # number of cuts at or below the value
        b = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(order_col)))
    if descending:
        b = F.lit(len(cuts)) - b
    x = df.withColumn(_SLICE, b)
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy(_SLICE).orderBy(o).rowsBetween(Window.unboundedPreceding,
                                                           Window.currentRow)
    x = x.withColumns({f"__loc_{c}": F.sum(c).over(w) for c in sum_cols})
    tot = df.withColumn(_SLICE, b).groupBy(_SLICE).agg(
        *[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    ws = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(_SLICE, *[F.coalesce(F.sum(f"__tot_{c}").over(ws), F.lit(0))
                               .alias(f"__off_{c}") for c in sum_cols])
    j = x.join(F.broadcast(tot), _SLICE)
    return j.select(*df.columns, *[(F.col(f"__loc_{c}") + F.col(f"__off_{c}")).alias(f"{c}_cum")
                                   for c in sum_cols])


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the scratch folder: columns are pruned and
    sizes known when it is read."""
    from vigil.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_cumsum(df: DataFrame, keys, order_col: str, sum_cols,
                 next_name: str | None = None) -> DataFrame:
    """Running sums of ``sum_cols`` per ``keys`` in the order of the (unique per
    key) ``order_col``, without one task per key.  Adds ``<c>_cum`` for every
    column, the row itself included, and on demand the next value of
    ``order_col`` within the key (null for the last).

    Rows are range-partitioned by (keys, order) and written once; windows run
    per (partition, key).  The totals per partition and key (at most partitions
    + keys rows) give each its offset.  Null keys are a key of their own."""
    keys, sum_cols = list(keys), list(sum_cols)
    order = [*keys, order_col]
    x = written_once(df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()),
                     "keyed-runs")
    local = Window.partitionBy("__pid", *keys).orderBy(order_col)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = x.groupBy("__pid", *keys).agg(F.min(order_col).alias("__first"), *[
        F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    # rows here: partitions that a key fills
    across = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("__pid")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("__pid").alias("__p"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.lead("__first").over(across).alias("__after"),
        *[F.coalesce(F.sum(f"__tot_{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in sum_cols])
    x = x.withColumns({f"__loc_{c}": F.sum(c).over(upto) for c in sum_cols}
                      | {"__next": F.lead(order_col).over(local)})
    same = F.col("__pid") == F.col("__p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    j = x.join(runs, same)
    nxt = [] if next_name is None else [F.coalesce("__next", "__after").alias(next_name)]
    return j.select(*df.columns, *[(F.col(f"__loc_{c}") + F.col(f"__off_{c}")).alias(f"{c}_cum")
                                   for c in sum_cols], *nxt)


def halo_slices(df: DataFrame, time_col: str, split_seconds: int, reach: int) -> DataFrame:
    """Every row once for each time slice that holds a moment within ``reach`` of
    it: ``__slice``, and ``__own`` where the slice is its own.  Frames of up to
    ``reach`` over (key, slice) see for own rows what they would see over the
    key alone; drop the copies afterwards."""
    t = F.col(time_col)
    slice_of = lambda x: F.floor(x / F.lit(split_seconds))
    out = df.withColumn(_SLICE, F.explode(F.sequence(slice_of(t - reach), slice_of(t + reach))))
    return out.withColumn("__own", F.col(_SLICE) == slice_of(t))
