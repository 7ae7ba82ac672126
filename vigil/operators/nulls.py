"""Null handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fill_nearest(df: DataFrame, sensors, max_gap: int, drop: bool = True,
                 device_col: str = "hwid", block_col: str = "BlockID",
                 time_col: str = "when") -> DataFrame:
    """A null sensor takes the next row's value if
    ``NextDiff <= max_gap and NextDiff <= PrevDiff``, else the previous
    row's value if ``PrevDiff <= max_gap``, else stays null.  Only the
    adjacent rows inside (device, block) are looked at; if the chosen side is
    null the other side is not tried (Trap T4).  Then rows with any null left
    in ``sensors`` are dropped.  All sensors in one projection over one
    window, so one exchange and one sort.
    """
    sensors = list(sensors)
    w = Window.partitionBy(device_col, block_col).orderBy(time_col)
    nd, pd_ = F.col("NextDiff"), F.col("PrevDiff")
    take_next = (nd <= max_gap) & (nd <= pd_)
    take_prev = pd_ <= max_gap
    filled = {
        s: F.when(F.col(s).isNotNull(), F.col(s))
        .when(take_next, F.lead(s).over(w))
        .when(take_prev, F.lag(s).over(w))
        for s in sensors
    }
    out = df.withColumns(filled)
    return out.na.drop(subset=sensors) if drop else out


def fill_nearest_nonnull(df: DataFrame, sensors, max_gap: int,
                         skip=("A5", "A9", "ComError"), device_col: str = "hwid",
                         block_col: str = "BlockID", time_col: str = "when") -> DataFrame:
    """As N1, but the value taken is the last non-null before / the
    first non-null after the row in the block; the gap test stays on the
    adjacent row.  Alarm words are skipped and no row is dropped."""
    w = Window.partitionBy(device_col, block_col).orderBy(time_col)
    w_prev = w.rowsBetween(Window.unboundedPreceding, -1)
    # the rows ahead are those before in descending order
    w_next = Window.partitionBy(device_col, block_col).orderBy(F.desc(time_col)).rowsBetween(
        Window.unboundedPreceding, -1)
    nd, pd_ = F.col("NextDiff"), F.col("PrevDiff")
    filled = {
        s: F.when(F.col(s).isNotNull(), F.col(s))
        .when((nd <= max_gap) & (nd <= pd_), F.last(s, ignorenulls=True).over(w_next))
        .when(pd_ <= max_gap, F.last(s, ignorenulls=True).over(w_prev))
        for s in sensors if s not in skip
    }
    return df.withColumns(filled)


def fill_nearest_sliced(df: DataFrame, sensors, max_gap: int, split_seconds: int | None = None,
                        slice_col: str | None = None, nonnull: bool = False, drop: bool = True,
                        device_col: str = "hwid", block_col: str = "BlockID",
                        time_col: str = "when") -> DataFrame:
    """N1, or N2 with ``nonnull`` (which drops no row), on time slices: no task
    holds a whole block.  ``slice_col`` names a column with the slices of a
    laid-out table (kept), else they are ``floor(when / split_seconds)``.

    Windows run per (device, block, slice).  A block's values at the borders of
    its slices are one row per block and slice; carried over the slices of the
    block they give what lies before and after a slice.  Block ids rise with time,
    so of a slice only the first block goes on from earlier slices and only the
    last one into later ones: one row per (device, slice) is joined back, and the
    rows stay where they are.  Times of a device differ; rows without a device
    see their own slice only."""
    sensors = list(sensors)
    part = slice_col or "__slice"
    x = df if slice_col else df.withColumn(part, F.floor(F.col(time_col) / split_seconds))
    t, block, values = F.col(time_col), F.col(block_col), range(len(sensors))
    edges = x.groupBy(device_col, block_col, part).agg(*[
        agg(s, F.when(F.col(s).isNotNull(), t) if nonnull else t).alias(f"__{name}{i}")
        for i, s in enumerate(sensors) for agg, name in ((F.min_by, "first"), (F.max_by, "last"))])
    over = Window.partitionBy(device_col, block_col).orderBy(part)
    back = Window.partitionBy(device_col, block_col).orderBy(F.desc(part))
    earlier = Window.unboundedPreceding, -1
    edges = edges.withColumns({
        f"__{side}{i}": F.last(f"__{end}{i}", ignorenulls=True).over(w.rowsBetween(*earlier))
        if nonnull else F.lag(f"__{end}{i}").over(w)
        for i in values for side, end, w in (("before", "last", over), ("after", "first", back))})
    edges = edges.groupBy(device_col, part).agg(
        F.min_by(F.struct(block.alias("b"), *[f"__before{i}" for i in values]), block).alias("__in"),
        F.max_by(F.struct(block.alias("b"), *[f"__after{i}" for i in values]), block).alias("__out"))
    w = Window.partitionBy(device_col, block_col, part).orderBy(time_col)
    v = Window.partitionBy(device_col, block_col, part).orderBy(F.desc(time_col))
    near = {"__no_prev": F.lag(t).over(w).isNull(), "__no_next": F.lead(t).over(w).isNull()}
    for i, s in enumerate(sensors):
        near[f"__p{i}"] = F.last(s, ignorenulls=True).over(w.rowsBetween(*earlier)) \
            if nonnull else F.lag(s).over(w)
        near[f"__n{i}"] = F.last(s, ignorenulls=True).over(v.rowsBetween(*earlier)) \
            if nonnull else F.lead(s).over(w)
    x = x.withColumns(near).join(edges, [device_col, part], "left")

    def neighbour(i, own, missing, edge, side):
        outside = F.when(F.col(f"{edge}.b") == block, F.col(f"{edge}.__{side}{i}"))
        if nonnull:
            return F.coalesce(F.col(f"{own}{i}"), outside)
        return F.when(F.col(missing), outside).otherwise(F.col(f"{own}{i}"))

    nd, pd_ = F.col("NextDiff"), F.col("PrevDiff")
    x = x.withColumns({
        s: F.when(F.col(s).isNotNull(), F.col(s))
        .when((nd <= max_gap) & (nd <= pd_), neighbour(i, "__n", "__no_next", "__out", "after"))
        .when(pd_ <= max_gap, neighbour(i, "__p", "__no_prev", "__in", "before"))
        for i, s in enumerate(sensors)})
    x = x.select(*df.columns)
    return x.na.drop(subset=sensors) if drop and not nonnull else x


def forward_fill(df: DataFrame, cols, device_col: str = "hwid",
                 time_col: str = "when", split_seconds: int | None = None) -> DataFrame:
    """Last non-null value so far, per device.

    With ``split_seconds`` a device's rows are cut into time slices: the fill
    runs per (device, slice), and each slice's last non-null values (one row
    per slice) are carried forward over the earlier slices of the device and
    joined back for the rows that have nothing earlier in their own slice.
    No task then holds a whole device."""
    cols = list(cols)
    if split_seconds is None:
        w = Window.partitionBy(device_col).orderBy(time_col).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    sl = "__slice"
    x = df.withColumn(sl, F.floor(F.col(time_col) / split_seconds))
    w = Window.partitionBy(device_col, sl).orderBy(time_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    x = x.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    # last non-null value of each column in each slice (max_by skips nulls
    # because the ordering key is null where the value is null)
    summ = df.withColumn(sl, F.floor(F.col(time_col) / split_seconds)).groupBy(device_col, sl).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time_col))).alias(f"__l_{c}")
          for c in cols])
    ws = Window.partitionBy(device_col).orderBy(sl).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(device_col, sl, *[F.last(f"__l_{c}", ignorenulls=True).over(ws)
                                         .alias(f"__c_{c}") for c in cols])
    j = x.join(summ, [device_col, sl], "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.col(f"__c_{c}")) for c in cols}) \
        .drop(sl, *[f"__c_{c}" for c in cols])


def null_profile(df: DataFrame, sensors, alarms, device_col: str = "hwid") -> DataFrame:
    """Per device: rows, rows with every sensor present, non-null count
    of each alarm word, rows with at least one null sensor."""
    sensors = list(sensors)
    all_present = F.least(*[F.col(c).isNotNull().cast("int") for c in sensors]) \
        if len(sensors) > 1 else F.col(sensors[0]).isNotNull().cast("int")
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in sensors]) \
        if len(sensors) > 1 else F.col(sensors[0]).isNull().cast("int")
    return df.groupBy(device_col).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(all_present).cast("long").alias("n_full"),
        *[F.count(a).alias(f"n_notnull_{a}") for a in alarms],
        F.sum(any_null).cast("long").alias("n_any_null"),
    )


def _unpivot(df: DataFrame, names, value_type: str = "bigint",
             name_col: str = "sensor", value_col: str = "value") -> DataFrame:
    parts = ", ".join(f"'{n}', CAST(`{n}` AS {value_type})" for n in names)
    return df.select(F.expr(f"stack({len(names)}, {parts}) AS ({name_col}, {value_col})"))


def null_counts(df: DataFrame, sensors) -> DataFrame:
    """Null count per sensor in one aggregate, then unpivoted."""
    sensors = list(sensors)
    agg = df.agg(*[F.count_if(F.col(s).isNull()).alias(s) for s in sensors])
    return _unpivot(agg, sensors, "bigint", "sensor", "n_null")


def drop_report(df: DataFrame, subset) -> DataFrame:
    """Rows before and after dropping rows with a null in ``subset``,
    and the dropped percentage, in one pass."""
    subset = list(subset)
    complete = F.greatest(*[F.col(c).isNull() for c in subset]) if len(subset) > 1 \
        else F.col(subset[0]).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~complete).alias("rows_after"),
    ).withColumn("pct_dropped", F.try_divide(
        (F.col("rows_before") - F.col("rows_after")) * 100.0, F.col("rows_before")))
