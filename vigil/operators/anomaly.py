"""Engine-switch anomaly detection.

An engine is a 0/1 column.  A block where an engine switches on and off
many times within a short time is flagged.  Everything is window
expressions over one (device, block) partitioning ordered by time, so Spark
plans one exchange for the whole chain and all engines; the per-engine joins
of the original design are replaced by window expressions (no join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(device_col, block_col, time_col):
    return Window.partitionBy(device_col, block_col).orderBy(time_col)


def switch_columns(df: DataFrame, sensors, time_separator: int,
                   device_col: str = "hwid", block_col: str = "BlockID",
                   time_col: str = "when", row_frames: int | None = None,
                   first_lag_default=None, qualify: bool = True) -> DataFrame:
    """D1-D3 for every engine.

    D1 ``didSwitch_<s>``: 1 if the value differs from the previous row in
    the block; a missing previous row gives 0 (or compares with
    ``first_lag_default``).
    D2 ``qualified_<s>``: a switch to 1 counts only if a 0 follows within
    (+1 .. +sep) seconds; a switch to 0 only if a 0 precedes within
    (-sep .. -1) seconds.  With ``row_frames`` the frames are that many rows.
    D3 ``switchID_<s>``: among qualified rows, a new group starts when the
    previous qualified row is more than ``sep`` seconds back (the first one
    always starts a group); id = running count of starts from 1; null on
    rows that are not qualified.
    """
    w = _w(device_col, block_col, time_col)
    t = F.col(time_col)
    cols = {}
    for s in sensors:
        v = F.col(s)
        lagged = F.lag(v, 1, first_lag_default).over(w) if first_lag_default is not None \
            else F.lag(v).over(w)
        cols[f"didSwitch_{s}"] = F.when(lagged != v, 1).otherwise(0)
    out = df.withColumns(cols)
    cols = {}
    for s in sensors:
        v = F.col(s)
        sw = F.col(f"didSwitch_{s}") == 1
        if qualify:
            if row_frames is None:
                ahead = w.rangeBetween(1, time_separator)
                behind = w.rangeBetween(-time_separator, -1)
            else:
                ahead = w.rowsBetween(1, row_frames)
                behind = w.rowsBetween(-row_frames, -1)
            zero_ahead = F.count_if(v == 0).over(ahead) > 0
            zero_behind = F.count_if(v == 0).over(behind) > 0
            q = sw & F.when(v == 1, zero_ahead).otherwise(True) \
                & F.when(v == 0, zero_behind).otherwise(True)
        else:
            q = sw
        cols[f"qualified_{s}"] = F.coalesce(q, F.lit(False))
    out = out.withColumns(cols)
    cols = {}
    for s in sensors:
        q = F.col(f"qualified_{s}")
        prev_q = F.last(F.when(q, t), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1))
        cols[f"startGroup_{s}"] = F.when(
            q, F.when(prev_q.isNull() | (t - prev_q > time_separator), 1).otherwise(0))
    out = out.withColumns(cols)
    cols = {}
    for s in sensors:
        run = F.sum(F.coalesce(F.col(f"startGroup_{s}"), F.lit(0))).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cols[f"switchID_{s}"] = F.when(F.col(f"qualified_{s}"), run).cast("long")
    return out.withColumns(cols)


def flag_groups(df: DataFrame, sensors, threshold: int, device_col: str = "hwid",
                block_col: str = "BlockID", strict: bool = False,
                require_switch: bool = False, time_col: str = "when") -> DataFrame:
    """``flag_<s>`` is true on the rows of a switch group with at least
    ``threshold`` rows (``> threshold`` if ``strict``) and a positive id.

    ``count_<s>`` is the number of rows sharing the row's switch id in the
    block (for rows with no id: the rows with no id).  Group members are
    consecutive among the qualified rows in time order, so the size is
    computed with frames on the same (device, block, time) ordering as the
    rest of the chain: running count of group rows at the group's end minus
    the one before its start.  The next group's start is a running
    value in descending order, and no window is partitioned by the id: one
    exchange and two sorts for all engines.
    """
    w = _w(device_col, block_col, time_col)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(device_col, block_col).orderBy(F.desc(time_col)).rowsBetween(
        Window.unboundedPreceding, -1)
    cols = {}
    for s in sensors:
        sid = F.col(f"switchID_{s}")
        member = sid.isNotNull()
        cols[f"__cq_{s}"] = F.sum(member.cast("long")).over(upto)
        cols[f"__nq_{s}"] = F.sum(member.cast("long")).over(whole)
        cols[f"__n_{s}"] = F.count(F.lit(1)).over(whole)
    x = df.withColumns(cols)
    cols = {}
    for s in sensors:
        sid, cq = F.col(f"switchID_{s}"), F.col(f"__cq_{s}")
        starts = F.col(f"startGroup_{s}") == 1
        first_cq = F.last(F.when(starts, cq), ignorenulls=True).over(upto)
        next_start_cq = F.last(F.when(starts, cq), ignorenulls=True).over(after)
        last_cq = F.coalesce(next_start_cq - 1, F.col(f"__nq_{s}"))
        n = F.when(sid.isNotNull(), last_cq - first_cq + 1).otherwise(
            F.col(f"__n_{s}") - F.col(f"__nq_{s}"))
        cols[f"count_{s}"] = n
    x = x.withColumns(cols)
    cols = {}
    for s in sensors:
        sid, n = F.col(f"switchID_{s}"), F.col(f"count_{s}")
        big = (n > threshold) if strict else (n >= threshold)
        cond = big & (F.col(f"didSwitch_{s}") == 1) if require_switch else big & (sid > 0)
        cols[f"flag_{s}"] = F.coalesce(cond, F.lit(False))
    x = x.withColumns(cols)
    return x.drop(*[f"__{k}_{s}" for s in sensors for k in ("cq", "nq", "n")])


def extend_flags(df: DataFrame, sensors, time_separator: int, device_col: str = "hwid",
                 block_col: str = "BlockID", time_col: str = "when",
                 row_frames: int | None = None) -> DataFrame:
    """A row between two rows of the same flagged switch group is
    flagged too.  ``prevID`` = largest id within the past ``sep`` if a
    flag is there, ``nextID`` = smallest id within the next ``sep`` if a
    flag is there; equal and positive -> flagged."""
    w = _w(device_col, block_col, time_col)
    if row_frames is None:
        back, ahead = w.rangeBetween(-time_separator, 0), w.rangeBetween(0, time_separator)
    else:
        back, ahead = w.rowsBetween(-row_frames, 0), w.rowsBetween(0, row_frames)
    cols = {}
    for s in sensors:
        f, sid = F.col(f"flag_{s}"), F.col(f"switchID_{s}")
        cols[f"prevID_{s}"] = F.when(F.bool_or(f).over(back), F.max(sid).over(back))
        cols[f"nextID_{s}"] = F.when(F.bool_or(f).over(ahead), F.min(sid).over(ahead))
    out = df.withColumns(cols)
    cols = {}
    for s in sensors:
        p, n = F.col(f"prevID_{s}"), F.col(f"nextID_{s}")
        cols[f"flag_{s}"] = F.when((n == p) & (n > 0), True).otherwise(F.col(f"flag_{s}"))
    return out.withColumns(cols)


def joint_flag(df: DataFrame, sensors, name: str = "flag_anomaly") -> DataFrame:
    """1 if any engine is flagged, else 0."""
    cond = reduce(lambda a, b: a | b, [F.col(f"flag_{s}") for s in sensors])
    return df.withColumn(name, F.when(cond, 1).otherwise(0))


def detect_anomalies(df: DataFrame, time_separator: int, threshold: int, sensors,
                     debug: bool = False, device_col: str = "hwid",
                     block_col: str = "BlockID", time_col: str = "when",
                     keep_input: bool = False) -> DataFrame:
    """D1..D6 for all engines.  ``debug`` keeps every helper column;
    ``keep_input`` keeps the input columns plus the flags."""
    sensors = list(sensors)
    in_cols = df.columns
    x = switch_columns(df, sensors, time_separator, device_col, block_col, time_col)
    x = flag_groups(x, sensors, threshold, device_col, block_col, time_col=time_col)
    x = extend_flags(x, sensors, time_separator, device_col, block_col, time_col)
    x = joint_flag(x, sensors)
    if debug:
        return x
    flags = [f"flag_{s}" for s in sensors] + ["flag_anomaly"]
    if keep_input:
        return x.select(*in_cols, *flags)
    return x.select(device_col, block_col, time_col, *sensors, *flags)


def detect_anomalies_sliced(df: DataFrame, time_separator: int, threshold: int, sensors,
                            split_seconds: int, device_col: str = "hwid",
                            block_col: str = "BlockID", time_col: str = "when") -> DataFrame:
    """D7 for blocks longer than a task: the result of ``detect_anomalies`` for
    times that are unique in a block, with windows over (device, block, time
    slice) only.

    Rows are written once with the needed columns.  The value before the first row of
    a slice comes from a summary per slice.  Slices then get copies of the
    rows within twice the separator of them (a row is qualified by rows one
    separator away, and starts a group by qualified rows one separator away);
    groups are numbered by running sums per slice and offsets per block; the
    rows of a group are counted by its number; a second exchange of copies
    within the separator extends the flags.  Only tables with a row per slice
    are windowed per block."""
    from vigil.operators.sequence import halo_slices, written_once
    sensors = list(sensors)
    keys = [device_col, block_col]
    t = F.col(time_col)
    sep = time_separator
    rows = written_once(df.select(*keys, time_col, *sensors), "anomaly-rows").withColumn(
        "__slice", F.floor(t / split_seconds))
    sliced = [*keys, "__slice"]
    w = Window.partitionBy(*sliced).orderBy(time_col)
    over_slices = Window.partitionBy(*keys).orderBy("__slice")

    # The row before, in the slice or at the end of the slice before
    ends = rows.groupBy(*sliced).agg(*[F.max_by(s, time_col).alias(f"__end_{s}") for s in sensors])
    ends = ends.select(*sliced, *[F.lag(f"__end_{s}").over(over_slices).alias(f"__pre_{s}")
                                  for s in sensors])
    x = rows.withColumns({f"__lag_{s}": F.lag(s).over(w) for s in sensors}
                         | {"__inner": F.lag(F.lit(True)).over(w)}).join(ends, sliced)
    x = x.select(*keys, time_col, *sensors, *[
        F.coalesce(F.when(F.col("__inner"), F.col(f"__lag_{s}")).otherwise(F.col(f"__pre_{s}"))
                   != F.col(s), F.lit(False)).alias(f"__sw_{s}") for s in sensors])

    # Qualified switches and starts of groups
    x = halo_slices(x, time_col, split_seconds, 2 * sep)
    ahead, behind = w.rangeBetween(1, sep), w.rangeBetween(-sep, -1)
    cols = {}
    for s in sensors:
        v = F.col(s)
        cols[f"__q_{s}"] = F.coalesce(
            F.col(f"__sw_{s}") & F.when(v == 1, F.count_if(v == 0).over(ahead) > 0).otherwise(True)
            & F.when(v == 0, F.count_if(v == 0).over(behind) > 0).otherwise(True), F.lit(False))
    x = x.withColumns(cols)
    x = x.withColumns({f"__st_{s}": (F.col(f"__q_{s}") & (F.count_if(F.col(f"__q_{s}")).over(behind) == 0))
                       .cast("long") for s in sensors}).filter("__own").drop("__own")
    x = written_once(x, "anomaly-switches")

    # group numbers: running sums per slice, offsets per block
    sums = x.groupBy(*sliced).agg(*[F.sum(f"__st_{s}").alias(f"__n_{s}") for s in sensors])
    sums = sums.select(*sliced, *[F.coalesce(F.sum(f"__n_{s}").over(
        over_slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"__off_{s}")
        for s in sensors])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumns({f"__run_{s}": F.sum(f"__st_{s}").over(upto) for s in sensors}).join(sums, sliced)
    x = x.withColumns({f"__id_{s}": F.when(F.col(f"__q_{s}"), F.col(f"__off_{s}") + F.col(f"__run_{s}"))
                       for s in sensors})
    x = x.select(*keys, time_col, *sensors, *[f"__id_{s}" for s in sensors])

    # Groups with enough rows
    for s in sensors:
        big = (x.filter(F.col(f"__id_{s}").isNotNull()).groupBy(*keys, f"__id_{s}")
               .agg(F.count(F.lit(1)).alias("__size")).filter(F.col("__size") >= threshold)
               .select(*keys, f"__id_{s}", F.lit(True).alias(f"__big_{s}")))
        x = x.join(big, [*keys, f"__id_{s}"], "left").withColumn(
            f"__big_{s}", F.coalesce(f"__big_{s}", F.lit(False)))

    # Rows between two rows of the same flagged group
    x = halo_slices(x, time_col, split_seconds, sep)
    back, forth = w.rangeBetween(-sep, 0), w.rangeBetween(0, sep)
    cols = {}
    for s in sensors:
        f, i = F.col(f"__big_{s}"), F.col(f"__id_{s}")
        before = F.when(F.bool_or(f).over(back), F.max(i).over(back))
        after = F.when(F.bool_or(f).over(forth), F.min(i).over(forth))
        cols[f"flag_{s}"] = F.coalesce((before == after) & (after > 0), F.lit(False)) | f
    x = joint_flag(x.withColumns(cols).filter("__own"), sensors)
    return x.select(device_col, block_col, time_col, *sensors, *[f"flag_{s}" for s in sensors],
                    "flag_anomaly")


def detect_anomalies_rows(df: DataFrame, time_separator: int, threshold: int, sensors,
                          extended: bool = True, debug: bool = False,
                          device_col: str = "hwid", block_col: str = "BlockID",
                          time_col: str = "when") -> DataFrame:
    """The row-frame variant: the look-ahead/-behind frames are
    ``int(sep/60)`` rows instead of seconds; ``extended`` toggles D5."""
    sensors = list(sensors)
    rows = int(time_separator / 60)
    x = switch_columns(df, sensors, time_separator, device_col, block_col, time_col,
                       row_frames=rows)
    x = flag_groups(x, sensors, threshold, device_col, block_col, time_col=time_col)
    if extended:
        x = extend_flags(x, sensors, time_separator, device_col, block_col, time_col,
                         row_frames=rows)
    if debug:
        return x
    return x.select(device_col, block_col, time_col, *sensors,
                    *[f"flag_{s}" for s in sensors])


def detect_anomalies_first(df: DataFrame, time_separator: int, threshold: int, sensors,
                           device_col: str = "hwid", block_col: str = "BlockID",
                           time_col: str = "when") -> DataFrame:
    """The first variant: the previous value of the first row is 0,
    every switch counts (no D2), a group needs ``count > threshold`` and the
    row itself must be a switch; no extension."""
    sensors = list(sensors)
    x = switch_columns(df, sensors, time_separator, device_col, block_col, time_col,
                       first_lag_default=0, qualify=False)
    x = flag_groups(x, sensors, threshold, device_col, block_col, strict=True,
                    require_switch=True, time_col=time_col)
    return x.select(device_col, block_col, time_col, *sensors,
                    *[f"flag_{s}" for s in sensors], *[f"count_{s}" for s in sensors])


def rolling_switch_anomaly(df: DataFrame, sensors, window_minutes: int = 60,
                           switch_threshold: int = 6, device_col: str = "hwid",
                           time_col: str = "when") -> DataFrame:
    """Per device and day, switches in the past ``window_minutes``
    (range frame in seconds, current row included); flagged when the count
    is over ``switch_threshold``.  Cut by day so no task holds more than a
    device-day."""
    day = F.to_date(F.from_unixtime(F.col(time_col)))
    x = df.withColumn("day", day)
    w = Window.partitionBy(device_col, "day").orderBy(time_col)
    x = x.withColumns({f"switch_{s}": F.when(F.lag(s).over(w) != F.col(s), 1).otherwise(0)
                       for s in sensors})
    wr = w.rangeBetween(-window_minutes * 60, 0)
    x = x.withColumns({f"change_count_{s}": F.sum(f"switch_{s}").over(wr) for s in sensors})
    return x.withColumns({f"{s}_anomaly": F.col(f"change_count_{s}") > switch_threshold
                          for s in sensors})


def blocks_with_anomaly(anomalies: DataFrame, engine: str, device_col: str = "hwid",
                        block_col: str = "BlockID") -> DataFrame:
    """Blocks with at least one flagged row for one engine."""
    return anomalies.where(F.col(f"flag_{engine}")).select(device_col, block_col).distinct()
