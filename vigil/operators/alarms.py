"""Alarm bits, look-ahead labels and event-aligned views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.config import ALARM_WORDS, OVERHEATING_BITS
from vigil.functions.scalar import bit_is_set, safe_divide


def alarm_bits(df: DataFrame, columns=ALARM_WORDS, bits=OVERHEATING_BITS) -> DataFrame:
    """M1: column ``<bit>-<word>`` = 1 if that bit (1 = LSB) of the word is
    set, 0 if not, null if the word is null.  Any bit list (1..31)."""
    return df.withColumns({f"{b}-{c}": bit_is_set(c, b) for c in columns for b in bits})


def extract_alarms(df: DataFrame, columns=ALARM_WORDS, bits=OVERHEATING_BITS,
                   fill_null: bool = False) -> DataFrame:
    """M2 (and M4 with ``fill_null``): ``overheating`` = 1 if any listed
    bit of any listed word is 1, else 0; rows where every word is null are
    dropped.  M4 also passes the flag through ``coalesce(flag, 0)`` (the
    bit columns keep their nulls)."""
    x = alarm_bits(df, columns, bits)
    names = [f"{b}-{c}" for c in columns for b in bits]
    cond = reduce(lambda a, b: a | b, [F.col(n) == 1 for n in names])
    x = x.withColumn("overheating", F.when(cond, 1).otherwise(0).cast("int"))
    present = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])
    x = x.where(present)
    if fill_null:
        x = x.withColumn("overheating", F.coalesce(F.col("overheating"), F.lit(0)))
    return x


def extract_alarms_sum(df: DataFrame, columns=ALARM_WORDS, bits=(8, 7, 6)) -> DataFrame:
    """M3: the flag from the sum of the bit columns: a null word makes the
    sum null, which counts as 0; no row is dropped."""
    x = alarm_bits(df, columns, bits)
    total = reduce(lambda a, b: a + b, [F.col(f"{b}-{c}") for c in columns for b in bits])
    return x.withColumn("overheating", F.when(total > 0, 1).otherwise(0).cast("int"))


def attach_flag(df: DataFrame, flags: DataFrame, flag: str, keys=("hwid", "when"),
                fill: int | None = 0) -> DataFrame:
    """Left join a flag on (device, time), then null -> ``fill``."""
    out = df.join(flags.select(*keys, flag), list(keys), "left")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(fill))) if fill is not None else out


def attach_overheating(df: DataFrame, columns=ALARM_WORDS, bits=OVERHEATING_BITS) -> DataFrame:
    """M5 on a frame that already carries the alarm words: the same result
    as joining M2's output back on (device, time) and filling null with 0,
    as one projection (no join, no shuffle)."""
    names = [bit_is_set(c, b) == 1 for c in columns for b in bits]
    cond = reduce(lambda a, b: a | b, names)
    present = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])
    return df.withColumn("overheating",
                         F.when(present & cond, 1).otherwise(0).cast("int"))


def add_predictive(df: DataFrame, target: str, window_before: int = 30,
                   debug: bool = False, device_col: str = "hwid",
                   block_col: str = "BlockID", time_col: str = "when",
                   name: str | None = None) -> DataFrame:
    """M6: look-ahead label.  An event starts where target = 1 and the
    previous row of the block is not 1 (or missing).  The label is 1 on rows
    that are no event themselves and have the next start of the block at most
    ``window_before`` minutes ahead.

    The next start is the latest one met when the block is read backwards: a
    running value in descending order, linear in the rows of a block.
    ``debug`` keeps ``is_start_<target>`` and ``next_start_<target>``."""
    start, ahead = f"is_start_{target}", f"next_start_{target}"
    block = Window.partitionBy(device_col, block_col)
    backwards = block.orderBy(F.desc(time_col)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    on = F.coalesce(F.col(target) == 1, F.lit(False))
    was_on = F.coalesce(F.lag(target).over(block.orderBy(time_col)) == 1, F.lit(False))
    x = df.withColumn(start, (on & ~was_on).cast("int"))
    x = x.withColumn(ahead, F.last(F.when(F.col(start) == 1, F.col(time_col)), True).over(backwards))
    wait = F.col(ahead) - F.col(time_col)
    idle = F.coalesce(F.col(target), F.lit(0)) == 0
    near = F.coalesce(wait.between(1, window_before * 60), F.lit(False))
    x = x.withColumn(name or f"predictive_{target}", (idle & near).cast("int"))
    return x if debug else x.drop(start, ahead)


def event_aligned_by_position(df: DataFrame, sensors, event: str = "overheating",
                              prev_time: int = 3600, post_time: int = 300,
                              device_col: str = "hwid", block_col: str = "BlockID",
                              time_col: str = "when") -> DataFrame:
    """M7: rows from ``prev_time`` before to ``post_time`` after an event
    (same block); position in the block after that filter, minus the
    position of the block's first event row."""
    w = Window.partitionBy(device_col, block_col).orderBy(time_col)
    near = F.count_if(F.col(event) == 1).over(w.rangeBetween(-post_time, prev_time)) > 0
    x = df.select(device_col, block_col, time_col, *sensors, event, near.alias("__near")) \
        .where("__near")
    x = x.withColumn("naive_order", F.row_number().over(w) - 1)
    first = F.min(F.when(F.col(event) == 1, F.col("naive_order"))).over(
        Window.partitionBy(device_col, block_col))
    return x.select(device_col, block_col, time_col, *sensors, event,
                    (F.col("naive_order") - first).alias("order"))


def event_aligned_rate(df: DataFrame, sensors, event: str = "overheating",
                       prev_time: int = 6_000_000, post_time: int = 6_000_000,
                       device_col: str = "hwid", block_col: str = "BlockID",
                       time_col: str = "when") -> DataFrame:
    """M8: rows with an event of the device from ``post_time`` before to
    ``prev_time`` after them; time relative to the block's first event; for
    every sensor value the share of rows at that relative time having it,
    for relative times below ``post_time``.  Long format:
    (sensor, relative_time, value, rate)."""
    # the last event up to a row and the next one from it, on the whole device
    device, at = Window.partitionBy(device_col), F.when(F.col(event) == 1, F.col(time_col))
    passed = F.max(at).over(device.orderBy(time_col).rangeBetween(Window.unboundedPreceding, 0))
    coming = F.min(at).over(device.orderBy(F.desc(time_col)).rangeBetween(
        Window.unboundedPreceding, 0))
    near = F.coalesce(F.col(time_col) - passed <= post_time, F.lit(False)) | F.coalesce(
        coming - F.col(time_col) <= prev_time, F.lit(False))
    first = F.min(F.when(F.col(event) == 1, F.col(time_col))).over(
        Window.partitionBy(device_col, block_col))
    x = df.select(*sensors, event, time_col, device_col, block_col, near.alias("__near")) \
        .where("__near")
    x = x.select(*sensors, (F.col(time_col) - first).alias("relative_time")) \
        .where(F.col("relative_time") < post_time)
    parts = ", ".join(f"'{s}', CAST(`{s}` AS DOUBLE)" for s in sensors)
    long = x.select("relative_time", F.expr(f"stack({len(sensors)}, {parts}) AS (sensor, value)"))
    occ = long.groupBy("sensor", "relative_time", "value").agg(
        F.count(F.lit(1)).alias("occurrences"))
    tot = F.sum("occurrences").over(Window.partitionBy("sensor", "relative_time"))
    return occ.select("sensor", "relative_time", "value",
                      (F.col("occurrences") / tot).alias("rate"))


def event_summary(df: DataFrame, duration: float, sensors, rolling: float,
                  key: str = "MinToOverheating") -> DataFrame:
    """M9: per value of ``key`` up to ``duration`` the mean, std and count of
    each sensor, ``err = std/sqrt(n)``, and the mean of the means over
    ``[key - rolling, key]`` (towards the event, since a smaller key is later).
    The last window runs over the summary: one row per key value."""
    stats = {"avg": F.avg, "std": F.stddev_samp, "n": F.count}
    summary = df.where(F.col(key) <= duration).groupBy(key).agg(
        *[fn(s).alias(f"{s}_{tag}") for s in sensors for tag, fn in stats.items()])
    past = Window.orderBy(key).rangeBetween(-rolling, 0)
    return summary.select(
        "*", *[F.avg(f"{s}_avg").over(past).alias(f"{s}_rolling") for s in sensors],
        *[(F.col(f"{s}_std") / F.sqrt(f"{s}_n")).alias(f"{s}_err") for s in sensors])


def rolling_and_derivative(df: DataFrame, colname: str, mean_minutes: int = 240,
                           debug: bool = False, device_col: str = "hwid",
                           block_col: str = "BlockHeat", time_col: str = "when") -> DataFrame:
    """M10 for one column (see ``add_rolling_features``).  ``debug`` adds the
    previous row's rolling mean and time."""
    x = add_rolling_features(df, [colname], mean_minutes, device_col, block_col, time_col)
    if not debug:
        return x
    w = Window.partitionBy(device_col, block_col).orderBy(time_col)
    return x.withColumns({f"{colname}_rolling_prev": F.lag(f"{colname}_rolling").over(w),
                          "when_prev": F.lag(time_col).over(w)})


def add_rolling_features(df: DataFrame, cols, mean_minutes: int = 240,
                         device_col: str = "hwid", block_col: str = "BlockHeat",
                         time_col: str = "when") -> DataFrame:
    """Mean over the past ``mean_minutes`` in the event block (range
    frame, current row included) and its change per second against the
    previous row; no previous row or no time between gives 0.  All columns in
    one projection over one window."""
    w = Window.partitionBy(device_col, block_col).orderBy(time_col)
    wr = w.rangeBetween(-mean_minutes * 60, 0)
    x = df.withColumns({f"{c}_rolling": F.avg(c).over(wr) for c in cols})
    dt = F.col(time_col) - F.lag(time_col).over(w)
    return x.withColumns({
        f"{c}_rolling_derivative": F.coalesce(
            safe_divide(F.col(f"{c}_rolling") - F.lag(f"{c}_rolling").over(w), dt), F.lit(0.0))
        for c in cols})
