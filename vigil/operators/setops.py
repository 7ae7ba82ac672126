"""Set operations, sorts, limits and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_by_name(a: DataFrame, b: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union matching columns by name."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def union_by_position(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by position."""
    return a.union(b)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a not in b, with set semantics (duplicates collapse)."""
    return a.subtract(b)


def distinct(df: DataFrame, cols=None) -> DataFrame:
    """Z3."""
    return (df.select(*cols) if cols else df).distinct()


def sort(df: DataFrame, *keys) -> DataFrame:
    """Several keys; a key may be a column expression; sort only at the
    sink."""
    return df.orderBy(*keys)


def first_n(df: DataFrame, n: int, *keys, last: bool = False) -> DataFrame:
    """First n by the keys, or the last n shown in ascending order."""
    if not last:
        return df.orderBy(*keys).limit(n)
    desc = [F.col(k).desc() if isinstance(k, str) else k.desc() for k in keys]
    return df.orderBy(*desc).limit(n).orderBy(*keys)


def top_gaps(df: DataFrame, n: int = 5, device_col: str = "hwid",
             gap_col: str = "time_diff", count_col: str = "count",
             buckets: int = 64) -> DataFrame:
    """Per device the n smallest and the n largest gaps (from the gap
    frequency table, one row per distinct gap), with the rank on each side
    (null when the gap is not among that side's n).

    Two-level top-k so that a device with very many distinct gaps is not
    ranked in one task: the top n of each side inside hash buckets of
    (device, gap), then the final top n per device over at most
    ``n * buckets`` candidates.  Gaps are unique per device, so the result
    is exact."""
    b = F.pmod(F.xxhash64(F.col(gap_col)), F.lit(buckets))
    x = df.select(device_col, gap_col, count_col, b.alias("__b"))
    wb_s = Window.partitionBy(device_col, "__b").orderBy(F.col(gap_col).asc())
    wb_l = Window.partitionBy(device_col, "__b").orderBy(F.col(gap_col).desc())
    cand = x.select("*", F.row_number().over(wb_s).alias("__rs"),
                    F.row_number().over(wb_l).alias("__rl")) \
        .where((F.col("__rs") <= n) | (F.col("__rl") <= n)).drop("__b", "__rs", "__rl")
    w_small = Window.partitionBy(device_col).orderBy(F.col(gap_col).asc())
    w_large = Window.partitionBy(device_col).orderBy(F.col(gap_col).desc())
    y = cand.select(device_col, gap_col, count_col,
                    F.row_number().over(w_small).alias("rank_small"),
                    F.row_number().over(w_large).alias("rank_large"))
    y = y.where((F.col("rank_small") <= n) | (F.col("rank_large") <= n))
    # a rank is reported only on its own side (ranks past n are not computed
    # over all gaps by the two-level top-k)
    return y.select(device_col, gap_col, count_col,
                    F.when(F.col("rank_small") <= n, F.col("rank_small")).alias("rank_small"),
                    F.when(F.col("rank_large") <= n, F.col("rank_large")).alias("rank_large"),
                    F.when(F.col("rank_small") <= n, "smallest").otherwise("largest").alias("side"))


def slice_time(df: DataFrame, sensors, start: int, end: int, time_col: str = "when",
               device_col: str = "hwid") -> DataFrame:
    """Rows with ``start <= when <= end`` (both ends closed), chosen
    sensors, plus the readable ``time``.  The range filter reaches the
    Parquet scan when ``when`` is a stored column."""
    return df.where(F.col(time_col).between(start, end)).select(
        device_col, time_col, *sensors, F.from_unixtime(F.col(time_col)).alias("time"))
