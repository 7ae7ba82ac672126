"""Sources and sinks (X1-X9) and the stand-in mapping of the test tables.

The long readings table has one row per (when, hwid, metric) with a value.
On the test tables the ``events`` table plays that role (FIXTURES.md §3):

  hwid   <- user_id
  when   <- unix_timestamp(ts)  (truncating, session zone UTC)
  metric <- event_type, value <- value
  engine <- value > 50 of the same event, as 0/1
  A5/A9  <- props.k of ``error`` / ``purchase`` events (integer alarm words)

so every event gives its own metric row, one engine row and, for error and
purchase events, one alarm-word row.  The rows are generated by one narrow
``stack`` projection (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.config import Roles
from vigil.functions.scalar import ms_to_seconds

READINGS_SCHEMA = T.StructType([
    T.StructField("when", T.LongType(), True),
    T.StructField("hwid", T.StringType(), True),
    T.StructField("metric", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])

# Metric names of the stand-in readings, in pivot column order.
EVENT_METRICS = ("A5", "A9", "click", "engine", "error", "purchase", "signup", "view")
EVENT_ROLES = Roles(
    sensors=("click", "error", "purchase", "signup", "view"),
    alarms=("A5", "A9"),
    engines=("engine",),
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_readings(events: DataFrame) -> DataFrame:
    """Long readings (hwid, when, metric, value) from ``events``."""
    k = F.get_json_object("props", "$.k").cast("int").cast("double")
    base = events.select(
        F.col("user_id").alias("hwid"),
        F.unix_timestamp(F.col("ts")).alias("when"),
        F.col("event_type"),
        F.col("value"),
        k.alias("k"),
    )
    stacked = base.select(
        "hwid", "when",
        F.expr(
            "stack(4,"
            " event_type, value,"
            " 'engine', CAST(CAST(value > 50 AS INT) AS DOUBLE),"
            " 'A5', CASE WHEN event_type = 'error' THEN k END,"
            " 'A9', CASE WHEN event_type = 'purchase' THEN k END)"
            " AS (metric, value)"
        ),
    )
    return stacked.where(F.col("value").isNotNull())


def read_readings(spark: SparkSession, path: str, fmt: str = "csv",
                  ms: bool = True) -> DataFrame:
    """Long readings with an explicit schema (no inference pass);
    ``when`` in epoch ms is turned into seconds (P1)."""
    reader = spark.read.schema(READINGS_SCHEMA)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    if ms:
        df = df.withColumn("when", ms_to_seconds("when"))
    return df


def read_readings_checked(spark: SparkSession, path: str | list[str], quarantine: str,
                          ms: bool = True) -> tuple[DataFrame, DataFrame]:
    """X1 for files with bad lines: (readings, counts).  A line that does not
    parse by the schema (a field of another type, too few or too many fields)
    is kept as it stands (column ``bad_line``) in the folder ``rejected=1`` of
    the Parquet table ``quarantine``; the readings are its other folder.
    ``counts`` has one row: lines, read, rejected.

    The lines are parsed once and written, good and bad, in one pass."""
    schema = T.StructType([*READINGS_SCHEMA, T.StructField("bad_line", T.StringType(), True)])
    lines = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
             .option("enforceSchema", True).option("columnNameOfCorruptRecord", "bad_line").csv(path))
    lines.withColumn("rejected", F.col("bad_line").isNotNull().cast("int")) \
        .write.partitionBy("rejected").parquet(quarantine)
    written = spark.read.schema(T.StructType([*schema, T.StructField("rejected", T.IntegerType())])) \
        .parquet(quarantine)
    good = written.where("rejected = 0").select(*READINGS_SCHEMA.names)
    counts = written.agg(F.count(F.lit(1)).alias("lines"),
                         F.count_if(F.col("rejected") == 0).alias("read"),
                         F.count_if(F.col("rejected") == 1).alias("rejected"))
    return (good.withColumn("when", ms_to_seconds("when")) if ms else good), counts


def repartition_by_device(df: DataFrame, n: int | None = None,
                          cols=("hwid",)) -> DataFrame:
    """Hash repartition by device (and more keys).  Usually not needed:
    Spark inserts the exchange the next window or aggregate wants."""
    return df.repartition(n, *cols) if n else df.repartition(*cols)


def read_snapshot(spark: SparkSession, path: str,
                  alarm_words=("A5", "A9")) -> DataFrame:
    """Parquet snapshot with the alarm words cast to int."""
    df = spark.read.parquet(path)
    return df.withColumns({c: F.col(c).cast("int") for c in alarm_words if c in df.columns})


def read_csv_snapshot(spark: SparkSession, path: str, schema: T.StructType,
                      alarm_words=("A5", "A9")) -> DataFrame:
    """CSV snapshot read with a given schema; alarm words cast to int
    before any bit test."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumns({c: F.col(c).cast("int") for c in alarm_words if c in df.columns})


# Rows of a device from which on its folder holds more than one file.
ROWS_PER_FILE = 2_000_000


def by_device(df: DataFrame, device_col: str = "hwid", tasks: int | None = None) -> DataFrame:
    """Rows dealt out by device, for a table with a folder per device.  The
    number of files follows the rows: a device is one file, and a partition above
    the advisory size (a device with very many rows) is split over more tasks.

    Many devices with few rows each make many files of few bytes, whose time goes
    into opening and closing them; partitions put together by their bytes would
    leave all that to a few tasks.  With ``tasks`` the devices are dealt out over
    so many, and a device above ``ROWS_PER_FILE`` over several of them."""
    if tasks is None:
        return df.hint("rebalance", device_col)
    # at most one row per ROWS_PER_FILE rows of the table
    large = df.groupBy(F.col(device_col).alias("__device")).count().where(
        F.col("count") > ROWS_PER_FILE).select(
        "__device", F.ceil(F.col("count") / ROWS_PER_FILE).alias("__parts"))
    part = F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col("__parts")), F.lit(0))
    return df.join(F.broadcast(large), F.col(device_col).eqNullSafe(F.col("__device")), "left") \
        .repartition(tasks, device_col, part).select(*df.columns)


def write_snapshot(df: DataFrame, path: str, device_col: str = "hwid") -> None:
    """Write the prepared table partitioned by device, from the executors.
    Rows are dealt out by device first, so that a folder holds one file; a device
    too large for one task is split."""
    by_device(df, device_col).write.mode("overwrite").partitionBy(device_col).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite a Parquet table."""
    df.write.mode("overwrite").parquet(path)


def split_by_device(df: DataFrame, ids, device_col: str = "hwid",
                    key_cols=("hwid", "when", "metric"),
                    path: str | None = None, tasks: int | None = None) -> DataFrame:
    """One folder per listed device plus a reconciliation report.

    Report (one row): rows in, rows written (listed devices), rows that match
    no listed device, and rows that repeat a (device, time, metric) key.
    All counts come from one aggregate pass plus one duplicate count.
    ``tasks`` write the folders (see ``by_device``).
    """
    if isinstance(ids, DataFrame):
        # listed devices given as a table: a left-semi / left join instead of
        # a driver-side list (Spark broadcasts it only if it is small)
        flag = ids.select(F.col(ids.columns[0]).alias(device_col)).distinct() \
            .withColumn("__listed", F.lit(True))
        marked = df.join(flag, device_col, "left")
        listed = F.coalesce(F.col("__listed"), F.lit(False))
    else:
        marked = df
        listed = F.coalesce(F.col(device_col).isin(list(ids)), F.lit(False))
    if path is not None:
        by_device(marked.where(listed).drop("__listed"), device_col, tasks).write.mode(
            "overwrite").partitionBy(device_col).parquet(path)
    # One pass: count per key (partial aggregation before the shuffle), then
    # one global aggregate over the key counts.
    per_key = marked.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n"),
                                            F.max(listed).alias("__l"))
    listed_k = F.col("__l")
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_in"),
        F.coalesce(F.sum(F.when(listed_k, F.col("n"))), F.lit(0)).cast("long").alias("rows_out"),
        F.coalesce(F.sum(F.when(~listed_k, F.col("n"))), F.lit(0)).cast("long").alias("rows_unmatched"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long")
        .alias("rows_duplicate"),
    )


def frame_from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Literal rows (tests and golden frames)."""
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int = 5, last: bool = False,
            order=("when",)) -> DataFrame:
    """First n (or last n, shown in ascending order) rows by time.
    A top-k: Spark plans TakeOrderedAndProject, no global sort."""
    order = list(order)
    if not last:
        return df.orderBy(*[F.col(c).asc() for c in order]).limit(n)
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(
        *[F.col(c).asc() for c in order])
