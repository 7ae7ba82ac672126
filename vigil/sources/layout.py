"""Snapshots laid out for the chain (X2, X5): bucketed by device and time slice.

A reading belongs to the slice ``floor(when / split_seconds)``, kept as a column.
Rows of one device and slice lie in one bucket, sorted by time, and a device
spreads over as many buckets as it has slices.  Spark's own bucketed tables tell
the planner so: an aggregate or window by (device, slice, ...) and the row side of
a join on (device, slice) read the table without an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = "slice"


def with_slice(df: DataFrame, split_seconds: int, time_col: str = "when") -> DataFrame:
    """``df`` with its time slice; a null time has a null slice."""
    return df.withColumn(SLICE, F.floor(F.col(time_col) / split_seconds))


def write_laid_out(df: DataFrame, table: str, path: str, split_seconds: int, buckets: int,
                   device_col: str = "hwid", time_col: str = "when") -> DataFrame:
    """Write ``df`` as the bucketed table ``table`` with its files at ``path`` and
    read it back.  One exchange deals the rows out as the buckets want them, so
    every bucket is one file.  An existing table is an error.

    A column named ``slice`` is taken as the slice that it holds."""
    if SLICE not in df.columns:
        df = with_slice(df, split_seconds, time_col)
    keys = [device_col, SLICE]
    (df.repartition(buckets, *keys).write.format("parquet").mode("errorifexists")
     .bucketBy(buckets, *keys).sortBy(*keys, time_col).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def open_laid_out(spark: SparkSession, table: str, path: str, schema, buckets: int,
                  device_col: str = "hwid", time_col: str = "when") -> DataFrame:
    """Name the files that ``write_laid_out`` left at ``path`` in a session whose
    catalog does not know the table, and read it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = f"`{device_col}`, `{SLICE}`"
    spark.sql(f"CREATE TABLE `{table}` ({columns}) USING parquet CLUSTERED BY ({keys}) "
              f"SORTED BY ({keys}, `{time_col}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)
