"""Blocks: gap sessionization and event-to-event blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.scalar import size_bucket, size_bucket_rank
from vigil.operators.sequence import neighbour_times, runs_after


def build_blocks(df: DataFrame, max_interval: int, device_col: str = "hwid",
                 time_col: str = "when", split_seconds: int | None = None,
                 slice_col: str | None = None) -> DataFrame:
    """B1/B2: per device ``Prev_TimeStamp, Next_TimeStamp, PrevDiff,
    NextDiff``; a new block starts when ``PrevDiff > max_interval`` (strict);
    ``BlockID`` is the running count of block starts, from 0.

    With ``split_seconds`` the rows of a device are processed in time slices
    (see operators/sequence.py), so a device with most of the rows does not
    end up in one task; ``slice_col`` names a column with the slices of a
    laid-out table instead (sources/layout.py), whose rows are then read without
    an exchange.  B2 (one device) is the same call: the device key is
    kept.
    """
    out = neighbour_times(df, [device_col], time_col, split_seconds,
                          gap=max_interval, flag_name="__new", run_name="BlockID",
                          slice_col=slice_col)
    t = F.col(time_col)
    return out.withColumns({
        "PrevDiff": t - F.col("Prev_TimeStamp"),
        "NextDiff": F.col("Next_TimeStamp") - t,
        "BlockID": F.col("BlockID").cast("long"),
    }).drop("__new")


def blocks_per_device(blocks: DataFrame, device_col: str = "hwid",
                      block_col: str = "BlockID") -> DataFrame:
    """Distinct blocks per device."""
    return blocks.groupBy(device_col).agg(
        F.count_distinct(block_col).alias("n_blocks"))


def block_stats(blocks: DataFrame, device_col: str = "hwid",
                block_col: str = "BlockID", time_col: str = "when") -> DataFrame:
    """Rows per block and duration ``(max - min)/60`` in minutes."""
    return blocks.groupBy(device_col, block_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        ((F.max(time_col) - F.min(time_col)) / 60).alias("minutes"),
    )


def longest_blocks(stats: DataFrame, k: int, by: str = "n_rows",
                   device_col: str = "hwid", block_col: str = "BlockID") -> DataFrame:
    """B4 top-k: the k longest blocks (ties by device and block id)."""
    return stats.orderBy(F.col(by).desc(), device_col, block_col).limit(k)


def contiguous_blocks(df: DataFrame, interval: int, time_col: str = "when",
                      device_col: str = "hwid") -> DataFrame:
    """Runs of rows exactly ``interval`` seconds apart, cut per day (so
    no task holds more than one device-day); result: how many runs have each
    length."""
    day = F.to_date(F.from_unixtime(F.col(time_col)))
    x = df.select(device_col, time_col, day.alias("day"))
    w = Window.partitionBy(device_col, "day").orderBy(time_col)
    gap = F.col(time_col) - F.lag(time_col).over(w)
    x = x.withColumn("__new", F.when(gap.isNull() | (gap != interval), 1).otherwise(0))
    x = x.withColumn("__run", F.sum("__new").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = x.groupBy(device_col, "day", "__run").agg(F.count(F.lit(1)).alias("block_length"))
    return runs.groupBy("block_length").agg(F.count(F.lit(1)).alias("block_count"))


def event_blocks(df: DataFrame, event_col: str = "overheating",
                 min_block_length: int = 2, device_col: str = "hwid",
                 time_col: str = "when", debug: bool = False,
                 order=None, split_seconds: int | None = None) -> DataFrame:
    """Blocks that run from one event row to the next (``BlockHeat``).

    Per device, ordered by time: a new block starts on the row after a row
    with event = 1; ids from 1.  If the device's last row is not an event
    (null counts as no event) its last block is dropped.  Blocks with fewer
    than ``min_block_length`` rows are dropped and the rest renumbered
    1, 2, .. per device without holes.  ``TimeOverheating`` is the block's
    last time and ``MinToOverheating = (TimeOverheating - when)/60``.

    Only window expressions on the device ordering and its reverse: blocks are
    runs of consecutive rows, so a block's size, end time and last event come
    from running values (the next block start is one in descending order),
    with no window partitioned by the block and no self-join: one exchange,
    no second pass over the input.

    With ``split_seconds`` no task holds a whole device: runs are numbered in
    two levels by time slice, blocks are summed up by an aggregate (one row
    per block), and only that table is windowed per device and joined back.

    ``order`` may give an ordering equal to time order that the input is
    already sorted by, e.g. ``("BlockID", "when")`` after the gap blocks
    (block ids rise with time), so the device windows need no new sort.
    """
    if split_seconds is not None:
        return _event_blocks_sliced(df, event_col, min_block_length, device_col, time_col, debug,
                                    split_seconds)
    order = list(order) if order else [time_col]
    w = Window.partitionBy(device_col).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(device_col).orderBy(*[F.desc(c) for c in order]).rowsBetween(
        Window.unboundedPreceding, -1)
    t = F.col(time_col)
    x = df.withColumn("new_block_flag", F.when(F.lag(event_col).over(w) == 1, 1).otherwise(0))
    x = x.withColumns({
        "oldBlockHeat": F.sum("new_block_flag").over(upto) + 1,
        "__pos": F.row_number().over(w),
        "__prev_t": F.lag(time_col).over(w),
        "__n_dev": F.count(F.lit(1)).over(whole),
        "__last_t": F.max(time_col).over(whole),
        "__last_ev": F.last(event_col).over(whole),
    })
    # blocks are runs of consecutive rows: a block starts on the device's
    # first row and on each row whose previous row is an event
    starts = (F.col("new_block_flag") == 1) | (F.col("__pos") == 1)
    nxt = F.col("new_block_flag") == 1
    x = x.withColumns({
        "__start": F.last(F.when(starts, F.col("__pos")), ignorenulls=True).over(upto),
        "__next_start": F.last(F.when(nxt, F.col("__pos")), ignorenulls=True).over(after),
        "__end_t": F.last(F.when(nxt, F.col("__prev_t")), ignorenulls=True).over(after),
    })
    n = F.coalesce(F.col("__next_start") - 1, F.col("__n_dev")) - F.col("__start") + 1
    last_block = F.col("__next_start").isNull()
    dropped_tail = last_block & ~F.coalesce(F.col("__last_ev") == 1, F.lit(False))
    x = x.withColumn("TimeOverheating", F.coalesce(F.col("__end_t"), F.col("__last_t")))
    x = x.where(~dropped_tail & (n >= min_block_length))
    x = x.withColumn("BlockHeat", F.sum((F.col("__pos") == F.col("__start")).cast("long"))
                     .over(upto))
    x = x.withColumn("MinToOverheating", (F.col("TimeOverheating") - t) / 60)
    x = x.drop("__pos", "__prev_t", "__n_dev", "__last_t", "__last_ev", "__start",
               "__next_start", "__end_t")
    if debug:
        return x
    return x.drop("new_block_flag", "oldBlockHeat", "TimeOverheating")


def _event_blocks_sliced(df: DataFrame, event_col: str, min_block_length: int, device_col: str,
                         time_col: str, debug: bool, split_seconds: int) -> DataFrame:
    """B6 in time slices (see ``event_blocks``)."""
    x = runs_after(df, [device_col], F.coalesce(F.col(event_col) == 1, F.lit(False)), time_col,
                   split_seconds, "new_block_flag", "__run")
    x = x.withColumn("oldBlockHeat", F.col("__run") + 1).drop("__run")
    keys = [device_col, "oldBlockHeat"]
    ends = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                F.max(F.struct(time_col, event_col)).alias("__end"))
    w = Window.partitionBy(device_col).orderBy("oldBlockHeat")
    ended = F.coalesce(F.col(f"__end.{event_col}") == 1, F.lit(False))
    ends = ends.withColumn("__tail", F.lead("oldBlockHeat").over(w).isNull() & ~ended)
    ends = ends.where(~F.col("__tail") & (F.col("__n") >= min_block_length)).select(
        *keys, F.col(f"__end.{time_col}").alias("TimeOverheating"),
        F.row_number().over(w).cast("long").alias("BlockHeat"))
    x = x.join(ends, keys)
    x = x.withColumn("MinToOverheating", (F.col("TimeOverheating") - F.col(time_col)) / 60)
    return x if debug else x.drop("new_block_flag", "oldBlockHeat", "TimeOverheating")


def event_block_sizes(heat: DataFrame, device_col: str = "hwid",
                      block_col: str = "BlockHeat") -> DataFrame:
    """Rows per event block -> size label -> number of blocks, with the
    report order in ``bucket_rank``."""
    sizes = heat.groupBy(device_col, block_col).agg(F.count(F.lit(1)).alias("count"))
    lab = sizes.select(size_bucket("count").alias("block_size"))
    res = lab.groupBy("block_size").agg(F.count(F.lit(1)).alias("n_blocks"))
    return res.withColumn("bucket_rank", size_bucket_rank("block_size"))
