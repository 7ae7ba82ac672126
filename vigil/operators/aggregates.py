"""Aggregations.

Wide per-column statistics are computed in one aggregate and unpivoted with
``stack`` (one job instead of one job per column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.scalar import equal_width_bin


def unpivot(df: DataFrame, names, value_type: str = "double", keys=(),
            name_col: str = "sensor", value_col: str = "value") -> DataFrame:
    """Wide -> long with ``stack`` (a narrow projection)."""
    names = list(names)
    parts = ", ".join(f"'{n}', CAST(`{n}` AS {value_type})" for n in names)
    return df.select(*keys, F.expr(f"stack({len(names)}, {parts}) AS ({name_col}, {value_col})"))


def rows_per_device(df: DataFrame, device_col: str = "hwid") -> DataFrame:
    """A1: rows per device."""
    return df.groupBy(device_col).agg(F.count(F.lit(1)).alias("n_rows"))


def constant_columns(df: DataFrame, sensors) -> DataFrame:
    """A2: min and max of every sensor in one pass; ``is_constant`` when
    max == min (the constant value in ``min``).  Useful = not constant."""
    sensors = list(sensors)
    agg = df.agg(*[F.min(s).cast("double").alias(f"mn_{i}") for i, s in enumerate(sensors)],
                 *[F.max(s).cast("double").alias(f"mx_{i}") for i, s in enumerate(sensors)])
    parts = ", ".join(f"'{s}', mn_{i}, mx_{i}" for i, s in enumerate(sensors))
    long = agg.select(F.expr(f"stack({len(sensors)}, {parts}) AS (sensor, min, max)"))
    return long.withColumn("is_constant", F.coalesce(F.col("min") == F.col("max"), F.lit(False)))


def distinct_counts(df: DataFrame, sensors, keep_over: int = 1) -> DataFrame:
    """A3: exact distinct count per column, keep those over ``keep_over``.
    Unpivoted first, so the distinct count is one two-phase aggregate keyed
    by (sensor, value) instead of one expand per column."""
    long = unpivot(df, sensors, "double")
    res = long.groupBy("sensor").agg(F.count_distinct("value").alias("n_distinct"))
    return res.where(F.col("n_distinct") > keep_over)


def approx_distinct_counts(df: DataFrame, sensors, rsd: float = 0.15,
                           keep_over: int = 1) -> DataFrame:
    """A4: HyperLogLog distinct count of every column in one pass."""
    sensors = list(sensors)
    agg = df.agg(*[F.approx_count_distinct(s, rsd).alias(s) for s in sensors])
    return unpivot(agg, sensors, "bigint", name_col="sensor", value_col="n_distinct") \
        .where(F.col("n_distinct") > keep_over)


def approx_distinct_per_block(df: DataFrame, sensors, min_counts: int = 10,
                              rsd: float = 0.05, device_col: str = "hwid",
                              block_col: str = "BlockID") -> DataFrame:
    """A5: approximate distinct count per block and column; the columns with
    more than ``min_counts`` values in a block."""
    sensors = list(sensors)
    agg = df.groupBy(device_col, block_col).agg(
        *[F.approx_count_distinct(s, rsd).alias(s) for s in sensors])
    long = unpivot(agg, sensors, "bigint", keys=(device_col, block_col),
                   name_col="sensor", value_col="n_distinct")
    return long.where(F.col("n_distinct") > min_counts)


def time_gap_frequency(df: DataFrame, device_col: str = "hwid",
                       time_col: str = "when", split_seconds: int | None = None) -> DataFrame:
    """Per device, how often each gap ``when - previous when`` occurs."""
    from vigil.operators.sequence import neighbour_times
    x = neighbour_times(df.select(device_col, time_col), [device_col], time_col,
                        split_seconds, prev_name="__p", next_name="__n")
    gaps = x.select(device_col, (F.col(time_col) - F.col("__p")).alias("time_diff")) \
        .where(F.col("time_diff").isNotNull())
    return gaps.groupBy(device_col, "time_diff").agg(F.count(F.lit(1)).alias("count"))


def gap_histogram(freq: DataFrame, min_diff: float, max_diff: float, delta: float,
                  gap_col: str = "time_diff", count_col: str = "count") -> DataFrame:
    """Gaps in [min, max] in ``int((max-min)/delta)`` equal bins (last
    bin closed), weighted by their count."""
    bins = int((max_diff - min_diff) / delta)
    x = freq.where(F.col(gap_col).between(min_diff, max_diff))
    b = equal_width_bin(gap_col, float(min_diff), float(max_diff), bins)
    width = (max_diff - min_diff) / bins
    res = x.groupBy(b.alias("bin")).agg(F.sum(count_col).cast("long").alias("count"))
    return res.select("bin", (F.lit(float(min_diff)) + F.col("bin") * width).alias("bin_lo"),
                      (F.lit(float(min_diff)) + (F.col("bin") + 1) * width).alias("bin_hi"),
                      "count")


def flag_totals(df: DataFrame, flags, device_col: str = "hwid") -> DataFrame:
    """Total of each 0/1 flag per device."""
    return df.groupBy(device_col).agg(
        *[F.sum(F.col(f).cast("long")).alias(f"total_{f}") for f in flags])


def any_true(df: DataFrame, keys, flag: str) -> DataFrame:
    """A10: whether any row of the group is true."""
    return df.groupBy(*keys).agg(F.bool_or(flag).alias(f"any_{flag}"))


def summarize(df: DataFrame, keys=(), **aggs) -> DataFrame:
    """A list of named aggregates, grouped or global (no keys)."""
    exprs = [e.alias(n) for n, e in aggs.items()]
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)


def anomalous_blocks(df: DataFrame, flag: str = "flag_anomaly",
                     device_col: str = "hwid", block_col: str = "BlockID") -> DataFrame:
    """Blocks whose max flag is 1."""
    return (df.groupBy(device_col, block_col)
            .agg(F.max(F.col(flag).cast("int")).alias("max_flag"))
            .where(F.col("max_flag") == 1).select(device_col, block_col))


def daily_anomaly_counts(df: DataFrame, flags, t0: int, t1: int,
                         device_col: str = "hwid", time_col: str = "when") -> DataFrame:
    """Rows with t0 <= when <= t1; per device and day the sum of each flag."""
    x = df.where(F.col(time_col).between(t0, t1))
    day = F.to_date(F.from_unixtime(F.col(time_col))).alias("day")
    return x.groupBy(device_col, day).agg(
        *[F.sum(F.col(f).cast("long")).alias(f"n_{f}") for f in flags])


def approx_median_by_class(df: DataFrame, feature: str, target: str,
                           accuracy: int = 10000) -> DataFrame:
    """Approximate median of a feature per class (mergeable sketch)."""
    return df.groupBy(target).agg(
        F.percentile_approx(feature, 0.5, accuracy).alias("median"))


def class_histogram(df: DataFrame, feature: str, target: str, bins: int = 30) -> DataFrame:
    """Per class, ``bins`` equal bins over that class's own range (last
    bin closed), count and density ``count / (n_class * width)``.

    The class bounds are an aggregate (one row per class, however many) that
    is joined back; AQE splits a class that holds most of the rows."""
    x = df.select(F.col(feature).cast("double").alias("x"), F.col(target).alias("cls")) \
        .where(F.col("x").isNotNull() & F.col("cls").isNotNull())
    stats = x.groupBy("cls").agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                                 F.count(F.lit(1)).alias("n_class"))
    j = x.join(stats, "cls")
    j = j.withColumn("bin", equal_width_bin("x", "lo", "hi", bins))
    res = j.groupBy("cls", "bin", "lo", "hi", "n_class").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("hi") - F.col("lo")) / bins
    return res.select(
        F.col("cls").alias(target), "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        "count",
        F.try_divide(F.col("count").cast("double"), F.col("n_class") * width).alias("density"),
    )


def rule_count(df: DataFrame, rule, label: str) -> DataFrame:
    """Rows where a boolean rule holds, and all rows, split by label."""
    return df.groupBy(label).agg(F.count_if(rule).alias("n_rule"),
                                 F.count(F.lit(1)).alias("n_rows"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each class.  The share's window runs over the
    grouped table (one row per class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
