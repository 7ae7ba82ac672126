"""Registered queries: one per operator of the inventory, each with a
DuckDB twin where the operator is exact.

Every query reads the test tables at ``sf_dir`` (whole tables) through the
stand-in chain of ``plans/stand_in.py``.  Column names and types of a query
and its twin are the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.plans import stand_in as S
from vigil.plans.stand_in import sql
from vigil.session import cut_lineage, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query.  The stand-in mapping reads ``events.ts`` (a
    timestamp without zone) as UTC, so the session zone is pinned to UTC
    before the plan is built (the twins' DuckDB times are UTC too)."""
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            SQL[name] = oracle
        return fn
    return deco


def _grid_out(df: DataFrame) -> DataFrame:
    """Grid frames carry window bounds as timestamps; queries report them
    as epoch seconds."""
    return df.withColumns({c: F.unix_timestamp(F.col(c)) for c in ("window_start", "window_end")
                           if c in df.columns})


GRID_SELECT = ('hwid, "when", window_start, window_end, A5, A9, click, engine, error, '
               'purchase, signup, view')
BLOCK_SELECT = GRID_SELECT + ", Prev_TimeStamp, Next_TimeStamp, PrevDiff, NextDiff, BlockID"

# ------------------------------------------------------------ X: sources

from vigil.sources import readings as X  # noqa: E402


@register("x1_read_readings", sql('SELECT hwid, "when", metric, value FROM readings', "readings"))
def x1_read_readings(spark, sf):
    return S.readings(spark, sf)


@register("x2_repartition_by_device", sql('SELECT hwid, "when", metric, value FROM readings',
                                          "readings"))
def x2_repartition_by_device(spark, sf):
    return X.repartition_by_device(S.readings(spark, sf), None, ("hwid",))


@register("x3_x5_snapshot_roundtrip", sql(f"SELECT {BLOCK_SELECT} FROM blocks", "blocks"))
def x3_x5_snapshot_roundtrip(spark, sf):
    path = scratch_path(spark, "snapshot-blocks")
    X.write_snapshot(_grid_out(S.blocks(spark, sf)), path)
    df = X.read_snapshot(spark, path)
    return df.withColumn("hwid", F.col("hwid").cast("long"))


_FILL_PREPARED = ", ".join(S.fill_case(c, f"lead({c}) OVER ({S._W_BLK})", f"lag({c}) OVER ({S._W_BLK})")
                           for c in S.PREPARED_FILL)


@register("x5_laid_out_chain", sql(f"""SELECT {BLOCK_SELECT}
FROM (SELECT * REPLACE ({_FILL_PREPARED}) FROM blocks)
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in S.PREPARED_FILL)}""", "blocks"))
def x5_laid_out_chain(spark, sf):
    """Grid, blocks and fill on tables bucketed by device and time slice."""
    from vigil.plans.composite import prepare_laid_out
    path = scratch_path(spark, "laid_out")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    return _grid_out(prepare_laid_out(S.readings(spark, sf), X.EVENT_ROLES, S.EVENTS, name, path, 16,
                                      S.ENGINES, S.PREPARED_FILL))


@register("x4_x6_csv_roundtrip", sql(f"SELECT {GRID_SELECT} FROM grid", "grid"))
def x4_x6_csv_roundtrip(spark, sf):
    g = _grid_out(S.grid(spark, sf))
    path = scratch_path(spark, "snapshot-grid")
    X.write_parquet(g, f"{path}.parquet")
    g = spark.read.parquet(f"{path}.parquet")
    g.write.option("header", True).csv(f"{path}.csv")
    return X.read_csv_snapshot(spark, f"{path}.csv", g.schema)


@register("x7_split_by_device", sql("""SELECT CAST(sum(n) AS BIGINT) AS rows_in,
  CAST(COALESCE(sum(CASE WHEN listed THEN n END), 0) AS BIGINT) AS rows_out,
  CAST(COALESCE(sum(CASE WHEN NOT listed THEN n END), 0) AS BIGINT) AS rows_unmatched,
  CAST(COALESCE(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS rows_duplicate
FROM (SELECT hwid, "when", metric, count(*) AS n,
             hwid IN (SELECT c_custkey FROM customer) AS listed
      FROM readings GROUP BY hwid, "when", metric)""", "readings"))
def x7_split_by_device(spark, sf):
    ids = X.load_table(spark, sf, "customer").select(F.col("c_custkey").alias("hwid"))
    return X.split_by_device(S.readings(spark, sf), ids, path=scratch_path(spark, "by-device"),
                             tasks=S.device_tasks(spark, sf))


@register("x9_preview_first", sql(f"""SELECT {GRID_SELECT} FROM grid
ORDER BY "when", hwid LIMIT 5""", "grid"))
def x9_preview_first(spark, sf):
    return X.preview(_grid_out(S.grid(spark, sf)), 5, order=("when", "hwid"))


@register("x9_preview_last", sql(f"""SELECT {GRID_SELECT} FROM grid
ORDER BY "when" DESC, hwid DESC LIMIT 5""", "grid"))
def x9_preview_last(spark, sf):
    return X.preview(_grid_out(S.grid(spark, sf)), 5, last=True, order=("when", "hwid"))


# ------------------------------------------------------- P: projections

from vigil.functions import scalar as P  # noqa: E402


@register("p1_ms_to_seconds", sql("""SELECT event_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS when_ms,
  CAST(round(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) / 1000) AS BIGINT) AS "when"
FROM events"""))
def p1_ms_to_seconds(spark, sf):
    ev = X.load_table(spark, sf, "events")
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    return ev.select("event_id", ms.alias("when_ms")).withColumn("when", P.ms_to_seconds("when_ms"))


@register("p2_readable_time", sql("""SELECT hwid, "when",
  strftime(make_timestamp("when" * 1000000), '%Y-%m-%d %H:%M:%S') AS time FROM grid""", "grid"))
def p2_readable_time(spark, sf):
    return S.grid(spark, sf).select("hwid", "when", P.readable_time("when").alias("time"))


@register("p3_scale_decimals", sql("""SELECT hwid, "when", A5, A9, click / 10 AS click, engine, error,
  purchase, signup, view / 100 AS view FROM wide""", "wide"))
def p3_scale_decimals(spark, sf):
    return P.scale_decimals(S.wide(spark, sf), {"click": 1, "view": 2})


T0, T1 = 1704672000, 1705276800  # 2024-01-08 .. 2024-01-15 UTC, both ends closed


@register("p4_slice_time", sql(f"""SELECT hwid, "when", click, engine,
  strftime(make_timestamp("when" * 1000000), '%Y-%m-%d %H:%M:%S') AS time
FROM wide WHERE "when" BETWEEN {T0} AND {T1}""", "wide"))
def p4_slice_time(spark, sf):
    from vigil.operators.setops import slice_time
    return slice_time(S.wide(spark, sf), ["click", "engine"], T0, T1)


@register("p7_drop_nulls", sql(f"""SELECT {GRID_SELECT} FROM grid
WHERE click IS NOT NULL AND view IS NOT NULL""", "grid"))
def p7_drop_nulls(spark, sf):
    return _grid_out(S.grid(spark, sf)).na.drop(subset=["click", "view"])


@register("p9_cast_double", sql("""SELECT hwid, "when", CAST(A5 AS DOUBLE) AS A5,
  CAST(A9 AS DOUBLE) AS A9, CAST(BlockID AS DOUBLE) AS BlockID FROM blocks""", "blocks"))
def p9_cast_double(spark, sf):
    return S.blocks(spark, sf).select("hwid", "when", *[F.col(c).cast("double").alias(c)
                                                        for c in ("A5", "A9", "BlockID")])


@register("p11_rule_count", sql("""SELECT flag_anomaly,
  count(CASE WHEN click > 100 AND view > 100 AND engine = 1 THEN 1 END) AS n_rule,
  count(*) AS n_rows
FROM final GROUP BY flag_anomaly""", "final"))
def p11_rule_count(spark, sf):
    from vigil.operators.aggregates import rule_count
    rule = (F.col("click") > 100) & (F.col("view") > 100) & (F.col("engine") == 1)
    return rule_count(S.final(spark, sf), rule, "flag_anomaly")


@register("p12_class_balance", sql("""SELECT flag_anomaly, n,
  n / CAST(sum(n) OVER () AS DOUBLE) AS share
FROM (SELECT flag_anomaly, count(*) AS n FROM final GROUP BY flag_anomaly)""", "final"))
def p12_class_balance(spark, sf):
    from vigil.operators.aggregates import class_balance
    return class_balance(S.final(spark, sf), "flag_anomaly")


@register("p13_constant_column", sql("""SELECT hwid, "when", 'fleet' AS source, 1 AS weight
FROM wide""", "wide"))
def p13_constant_column(spark, sf):
    return S.wide(spark, sf).select("hwid", "when", F.lit("fleet").alias("source"),
                                    F.lit(1).alias("weight"))


@register("p14_device_list", sql("SELECT DISTINCT hwid FROM readings ORDER BY hwid", "readings"))
def p14_device_list(spark, sf):
    return S.readings(spark, sf).select("hwid").distinct().orderBy("hwid")


@register("p15_alarm_rows", sql(f"""SELECT {GRID_SELECT},
  COALESCE(A5 > 0 OR A9 > 0, FALSE) AS alarm_positive
FROM grid WHERE A5 IS NOT NULL OR A9 IS NOT NULL""", "grid"))
def p15_alarm_rows(spark, sf):
    g = _grid_out(S.grid(spark, sf))
    x = g.where(F.col("A5").isNotNull() | F.col("A9").isNotNull())
    return x.withColumn("alarm_positive",
                        F.coalesce((F.col("A5") > 0) | (F.col("A9") > 0), F.lit(False)))


# ------------------------------------------------------------ R: grid

from vigil.operators import grid as R  # noqa: E402


@register("r1_pivot_metrics", sql('SELECT * FROM wide', "wide"))
def r1_pivot_metrics(spark, sf):
    return S.wide(spark, sf)


@register("r2_create_grid", sql(f"SELECT {GRID_SELECT} FROM grid", "grid"))
def r2_create_grid(spark, sf):
    # binary columns found from the data (one aggregate over all columns)
    return _grid_out(S.grid(spark, sf, binary=None))


def _resample_sql(fn_for):
    cols = ", ".join(f"{fn_for(c)} AS {c}" for c in S.GRID_COLS)
    return sql(f"""SELECT hwid, ws + {S.HALF} AS "when", ws AS window_start, ws + {S.G} AS window_end,
  {', '.join(S.GRID_COLS)} FROM (SELECT hwid, CAST(floor("when" / {S.G}) AS BIGINT) * {S.G} AS ws, {cols}
  FROM wide GROUP BY hwid, ws)""", "wide")


for _mod in ("mean", "min", "max"):
    _f = {"mean": "avg", "min": "min", "max": "max"}[_mod]

    def _q(spark, sf, _mod=_mod):
        return _grid_out(R.resample(S.wide(spark, sf), S.GRID_COLS, S.G, _mod))

    register(f"r3_resample_{_mod}", _resample_sql(lambda c, _f=_f: f"{_f}({c})"))(_q)


@register("r3_resample_auto", _resample_sql(
    lambda c: f"max({c})" if c in ("A5", "A9", "engine") else f"avg({c})"))
def r3_resample_auto(spark, sf):
    return _grid_out(R.resample(S.wide(spark, sf), S.GRID_COLS, S.G, "auto"))


@register("r3_resample_mode", sql(f"""SELECT hwid, ws + {S.HALF} AS "when", ws AS window_start,
  ws + {S.G} AS window_end, {', '.join(f"max(CASE WHEN sensor = '{c}' THEN v END) AS {c}"
                                          for c in S.GRID_COLS)}
FROM (SELECT hwid, ws, sensor, v, row_number() OVER (PARTITION BY hwid, ws, sensor
        ORDER BY cnt DESC, v ASC NULLS FIRST) AS rk
      FROM (SELECT hwid, ws, sensor, v, count(*) AS cnt FROM (
              SELECT hwid, CAST(floor("when" / {S.G}) AS BIGINT) * {S.G} AS ws, sensor, v
              FROM wide UNPIVOT INCLUDE NULLS (v FOR sensor IN
                ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in S.GRID_COLS)})))
            GROUP BY hwid, ws, sensor, v))
WHERE rk = 1 GROUP BY hwid, ws""", "wide"))
def r3_resample_mode(spark, sf):
    return _grid_out(R.resample(S.wide(spark, sf), S.GRID_COLS, S.G, "mode",
                                tasks=S.device_tasks(spark, sf)))


@register("r4_window_average", sql("""SELECT ws AS window_start, ws + 600 AS window_end,
  avg(value) AS avg_value, count(value) AS n
FROM (SELECT CAST(floor(epoch(ts) / 600) AS BIGINT) * 600 AS ws, value FROM events)
GROUP BY ws"""))
def r4_window_average(spark, sf):
    ev = X.load_table(spark, sf, "events")
    return _grid_out(R.window_average(ev, "ts", "value", "10 minutes"))


def _r5_sql(agg):
    return sql(f"""SELECT b.hwid, t.target AS "when", {agg} AS click
FROM (SELECT hwid, min("when") AS t0, max("when") AS t1 FROM wide GROUP BY hwid) b,
     LATERAL (SELECT b.t0 + 3600 * k AS target FROM range(0, (b.t1 - b.t0) // 3600 + 1) r(k)) t
JOIN wide w ON w.hwid = b.hwid AND w.click IS NOT NULL
  AND w."when" >= t.target - 1800 AND w."when" <= t.target + 1800
GROUP BY b.hwid, t.target""", "wide")


@register("r5_resample_sensor_near",
          _r5_sql('arg_min(w.click, abs(w."when" - t.target) * 10000000000 + w."when")'))
def r5_resample_sensor_near(spark, sf):
    return R.resample_sensor(S.wide(spark, sf), "click", 3600, "near")


@register("r5_resample_sensor_mean", _r5_sql("avg(w.click)"))
def r5_resample_sensor_mean(spark, sf):
    return R.resample_sensor(S.wide(spark, sf), "click", 3600, "mean")


@register("r5_resample_sensor_min", _r5_sql("min(w.click)"))
def r5_resample_sensor_min(spark, sf):
    return R.resample_sensor(S.wide(spark, sf), "click", 3600, "min")


@register("r5_resample_sensor_max", _r5_sql("max(w.click)"))
def r5_resample_sensor_max(spark, sf):
    return R.resample_sensor(S.wide(spark, sf), "click", 3600, "max")


@register("r6_densify_gaps", sql(f"""SELECT *,
  CAST(row_number() OVER (PARTITION BY hwid, BlockID ORDER BY "when") - 1 AS INTEGER) AS window_id,
  "when" - {S.HALF} AS window_start, "when" + {S.HALF} AS window_end,
  "when" - lag("when") OVER (PARTITION BY hwid, BlockID ORDER BY "when") AS TimeDiff_s
FROM (
  SELECT hwid, BlockID, "when", {', '.join(S.GRID_COLS)}, FALSE AS is_artificial FROM blocks
  UNION ALL
  SELECT hwid, BlockID, UNNEST(generate_series("when" + {S.G}, n_t - {S.G}, {S.G})) AS "when",
    {', '.join(f'n_{c}' for c in S.GRID_COLS)}, TRUE
  FROM (SELECT *, {', '.join(f'lead({c}) OVER (PARTITION BY hwid, BlockID ORDER BY "when") AS n_{c}'
                             for c in S.GRID_COLS)},
          lead("when") OVER (PARTITION BY hwid, BlockID ORDER BY "when") AS n_t FROM blocks)
  WHERE NextDiff > {S.G} AND NextDiff < {S.GAP})""", "blocks"))
def r6_densify_gaps(spark, sf):
    b = S.blocks(spark, sf).select("hwid", "BlockID", "when", "NextDiff", *S.GRID_COLS)
    return R.densify_gaps(b, S.GAP, S.G)


@register("r7_block_timeline", sql(f"""SELECT a.hwid, a.BlockID, a."when",
  CAST((a."when" - a.t0) / {S.G} AS BIGINT) AS minute,
  CAST(COALESCE(r.engine, 0) AS DOUBLE) AS value, COALESCE(r.flag_engine, FALSE) AS flag,
  CAST(CASE WHEN r.hwid IS NULL THEN 0.5 ELSE 0.0 END AS DOUBLE) AS missing,
  greatest(CAST(COALESCE(r.flag_engine, FALSE) AS DOUBLE),
           CASE WHEN r.hwid IS NULL THEN 0.5 ELSE 0.0 END) AS combined
FROM (SELECT hwid, BlockID, t0, UNNEST(generate_series(t0, t1, {S.G})) AS "when"
      FROM (SELECT hwid, BlockID, min("when") AS t0, max("when") AS t1 FROM anomalies
            GROUP BY hwid, BlockID)) a
LEFT JOIN anomalies r ON a.hwid = r.hwid AND a.BlockID = r.BlockID AND a."when" = r."when\"""",
                                      "anomalies"))
def r7_block_timeline(spark, sf):
    return R.block_timeline(S.anomalies(spark, sf), "engine", S.G)


# ------------------------------------------------------------ B: blocks

from vigil.operators import blocks as B  # noqa: E402


@register("b1_build_blocks", sql(f"SELECT {BLOCK_SELECT} FROM blocks", "blocks"))
def b1_build_blocks(spark, sf):
    return _grid_out(S.blocks(spark, sf))


@register("b1_build_blocks_sliced", sql(f"SELECT {BLOCK_SELECT} FROM blocks", "blocks"))
def b1_build_blocks_sliced(spark, sf):
    # the hot-device form: rows of a device cut into weekly slices
    return _grid_out(B.build_blocks(S.grid(spark, sf), S.GAP, split_seconds=S.EVENTS.split_seconds))


@register("b2_build_blocks_device_window", sql(f"SELECT {BLOCK_SELECT} FROM blocks", "blocks"))
def b2_build_blocks_device_window(spark, sf):
    # B2: the single-partition form of the reference made per device: one
    # window per device over the whole table, the device key kept.
    return _grid_out(B.build_blocks(S.grid(spark, sf), S.GAP, split_seconds=None))


@register("b3_blocks_per_device", sql("""SELECT hwid, count(DISTINCT BlockID) AS n_blocks
FROM blocks GROUP BY hwid""", "blocks"))
def b3_blocks_per_device(spark, sf):
    return B.blocks_per_device(S.blocks(spark, sf))


_B4 = """SELECT hwid, BlockID, count(*) AS n_rows, (max("when") - min("when")) / 60 AS minutes
FROM blocks GROUP BY hwid, BlockID"""


@register("b4_block_stats", sql(_B4, "blocks"))
def b4_block_stats(spark, sf):
    return B.block_stats(S.blocks(spark, sf))


@register("b4_longest_blocks", sql(_B4 + " ORDER BY n_rows DESC, hwid, BlockID LIMIT 10", "blocks"))
def b4_longest_blocks(spark, sf):
    return B.longest_blocks(B.block_stats(S.blocks(spark, sf)), 10)


@register("b5_contiguous_blocks", sql(f"""SELECT block_length, count(*) AS block_count FROM (
  SELECT hwid, day, run, count(*) AS block_length FROM (
    SELECT hwid, day, sum(new) OVER (PARTITION BY hwid, day ORDER BY "when" {S._RUN}) AS run FROM (
      SELECT hwid, "when", day, CASE WHEN gap IS NULL OR gap <> {S.G} THEN 1 ELSE 0 END AS new FROM (
        SELECT hwid, "when", CAST(make_timestamp("when" * 1000000) AS DATE) AS day,
          "when" - lag("when") OVER (PARTITION BY hwid, CAST(make_timestamp("when" * 1000000) AS DATE)
                                     ORDER BY "when") AS gap FROM grid)))
  GROUP BY hwid, day, run) GROUP BY block_length""", "grid"))
def b5_contiguous_blocks(spark, sf):
    return B.contiguous_blocks(S.grid(spark, sf), S.G)


HEAT_SELECT = (BLOCK_SELECT + ", flag_engine, flag_anomaly, overheating, predictive_overheating, "
               "BlockHeat, MinToOverheating")


@register("b6_event_blocks", sql(f"SELECT {HEAT_SELECT} FROM heat", "heat"))
def b6_event_blocks(spark, sf):
    return _grid_out(S.heat(spark, sf))


@register("b6_event_blocks_sliced", sql(f"SELECT {HEAT_SELECT} FROM heat", "heat"))
def b6_event_blocks_sliced(spark, sf):
    # runs numbered in two levels, so that no task holds a whole device
    rows = cut_lineage(S.predicted(spark, sf))
    return _grid_out(B.event_blocks(rows, "overheating", S.EVENTS.min_heat_block,
                                    split_seconds=S.EVENTS.split_seconds))


@register("b7_event_block_sizes", sql("""SELECT block_size, count(*) AS n_blocks,
  CASE block_size WHEN '1-30' THEN 1 WHEN '31-100' THEN 2 WHEN '101-500' THEN 3
    WHEN '501-1000' THEN 4 WHEN '1001-1500' THEN 5 WHEN '1501-2000' THEN 6
    WHEN '2001-4000' THEN 7 ELSE 8 END AS bucket_rank
FROM (SELECT CASE WHEN c BETWEEN 1 AND 30 THEN '1-30' WHEN c BETWEEN 31 AND 100 THEN '31-100'
   WHEN c BETWEEN 101 AND 500 THEN '101-500' WHEN c BETWEEN 501 AND 1000 THEN '501-1000'
   WHEN c BETWEEN 1001 AND 1500 THEN '1001-1500' WHEN c BETWEEN 1501 AND 2000 THEN '1501-2000'
   WHEN c BETWEEN 2001 AND 4000 THEN '2001-4000' WHEN c > 4000 THEN '>4000' ELSE 'Other' END
   AS block_size FROM (SELECT hwid, BlockHeat, count(*) AS c FROM heat GROUP BY hwid, BlockHeat))
GROUP BY block_size""", "heat"))
def b7_event_block_sizes(spark, sf):
    return B.event_block_sizes(S.heat(spark, sf))


# ------------------------------------------------------------- N: nulls

from vigil.operators import nulls as N  # noqa: E402


_FILLED = ", ".join(S.fill_case(c, f'lead({c}) OVER ({S._W_BLK})', f'lag({c}) OVER ({S._W_BLK})')
                    for c in S.PREPARED_FILL)


@register("n1_fill_nearest", sql(f"""SELECT * FROM (
  SELECT hwid, "when", BlockID, PrevDiff, NextDiff, {_FILLED} FROM blocks)
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in S.PREPARED_FILL)}""", "blocks"))
def n1_fill_nearest(spark, sf):
    b = S.blocks(spark, sf).select("hwid", "when", "BlockID", "PrevDiff", "NextDiff",
                                   *S.PREPARED_FILL)
    return N.fill_nearest(b, S.PREPARED_FILL, S.FILL)


_FILLED_NN = ", ".join(S.fill_case(
    c,
    f'first({c} IGNORE NULLS) OVER ({S._W_BLK} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)',
    f'last({c} IGNORE NULLS) OVER ({S._W_BLK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')
    for c in S.SENSORS)


@register("n1_fill_nearest_sliced", SQL["n1_fill_nearest"])
def n1_fill_nearest_sliced(spark, sf):
    b = S.blocks(spark, sf).select("hwid", "when", "BlockID", "PrevDiff", "NextDiff",
                                   *S.PREPARED_FILL)
    return N.fill_nearest_sliced(cut_lineage(b), S.PREPARED_FILL, S.FILL, S.EVENTS.split_seconds)


@register("n2_fill_nearest_nonnull", sql(f"""SELECT hwid, "when", BlockID, PrevDiff, NextDiff,
  A5, A9, {_FILLED_NN} FROM blocks""", "blocks"))
def n2_fill_nearest_nonnull(spark, sf):
    b = S.blocks(spark, sf).select("hwid", "when", "BlockID", "PrevDiff", "NextDiff", "A5", "A9",
                                   *S.SENSORS)
    return N.fill_nearest_nonnull(b, ["A5", "A9", *S.SENSORS], S.FILL)


@register("n2_fill_nearest_nonnull_sliced", SQL["n2_fill_nearest_nonnull"])
def n2_fill_nearest_nonnull_sliced(spark, sf):
    b = S.blocks(spark, sf).select("hwid", "when", "BlockID", "PrevDiff", "NextDiff", "A5", "A9",
                                   *S.SENSORS)
    return N.fill_nearest_sliced(cut_lineage(b), S.SENSORS, S.FILL, S.EVENTS.split_seconds,
                                 nonnull=True)


@register("n3_forward_fill", sql(f"""SELECT hwid, "when", {', '.join(
    f'last({c} IGNORE NULLS) OVER ({S._W_DEV} {S._RUN}) AS {c}' for c in S.SENSORS)} FROM grid""",
                                    "grid"))
def n3_forward_fill(spark, sf):
    return N.forward_fill(S.grid(spark, sf).select("hwid", "when", *S.SENSORS), S.SENSORS)


@register("n4_null_profile", sql(f"""SELECT hwid, count(*) AS n_total,
  CAST(sum(least({', '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in (*S.SENSORS, 'engine'))})) AS BIGINT) AS n_full,
  count(A5) AS n_notnull_A5, count(A9) AS n_notnull_A9,
  CAST(sum(greatest({', '.join(f'CAST({c} IS NULL AS INTEGER)' for c in (*S.SENSORS, 'engine'))})) AS BIGINT) AS n_any_null
FROM blocks GROUP BY hwid""", "blocks"))
def n4_null_profile(spark, sf):
    return N.null_profile(S.blocks(spark, sf), [*S.SENSORS, "engine"], S.ALARMS)


@register("n5_null_counts", sql(f"""SELECT sensor, n_null FROM (SELECT {', '.join(
    f'count(*) - count({c}) AS {c}' for c in S.GRID_COLS)} FROM blocks)
UNPIVOT (n_null FOR sensor IN ({', '.join(S.GRID_COLS)}))""", "blocks"))
def n5_null_counts(spark, sf):
    return N.null_counts(S.blocks(spark, sf), S.GRID_COLS)


@register("n6_drop_report", sql(f"""SELECT count(*) AS rows_before,
  count(CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in S.SENSORS)} THEN 1 END) AS rows_after,
  (count(*) - count(CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in S.SENSORS)} THEN 1 END))
    * 100.0 / count(*) AS pct_dropped
FROM blocks""", "blocks"))
def n6_drop_report(spark, sf):
    return N.drop_report(S.blocks(spark, sf), S.SENSORS)


# -------------------------------------------------------- A: aggregates

from vigil.operators import aggregates as A  # noqa: E402


@register("a1_rows_per_device_raw", sql("""SELECT hwid, count(*) AS n_rows FROM wide GROUP BY hwid""",
                                        "wide"))
def a1_rows_per_device_raw(spark, sf):
    return A.rows_per_device(S.wide(spark, sf))


@register("a1_rows_per_device_grid", sql("""SELECT hwid, count(*) AS n_rows FROM grid GROUP BY hwid""",
                                         "grid"))
def a1_rows_per_device_grid(spark, sf):
    return A.rows_per_device(S.grid(spark, sf))


@register("a2_constant_columns", sql(f"""SELECT sensor, min, max, COALESCE(min = max, FALSE) AS is_constant
FROM ({' UNION ALL '.join(f"SELECT '{c}' AS sensor, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM blocks" for c in S.GRID_COLS)})""",
                                     "blocks"))
def a2_constant_columns(spark, sf):
    return A.constant_columns(S.blocks(spark, sf), S.GRID_COLS)


@register("a3_distinct_counts", sql(f"""SELECT sensor, n_distinct FROM ({' UNION ALL '.join(
    f"SELECT '{c}' AS sensor, count(DISTINCT CAST({c} AS DOUBLE)) AS n_distinct FROM blocks" for c in S.GRID_COLS)})
WHERE n_distinct > 1""", "blocks"))
def a3_distinct_counts(spark, sf):
    return A.distinct_counts(S.blocks(spark, sf), S.GRID_COLS)


_EXACT_DISTINCT = " UNION ALL ".join(
    f"SELECT '{c}' AS sensor, count(DISTINCT {c}) AS exact, TRUE AS within FROM blocks"
    for c in S.GRID_COLS)


@register("a4_approx_distinct_counts", sql(f"SELECT * FROM ({_EXACT_DISTINCT}) WHERE exact > 1",
                                           "blocks"))
def a4_approx_distinct_counts(spark, sf):
    """The sketch beside the exact count: within three standard errors."""
    blocks = S.blocks(spark, sf)
    exact = A.distinct_counts(blocks, S.GRID_COLS).withColumnRenamed("n_distinct", "exact")
    near = A.approx_distinct_counts(blocks, S.GRID_COLS, 0.15, keep_over=0)
    return exact.join(near, "sensor").select("sensor", "exact", (
        F.abs(F.col("n_distinct") - F.col("exact")) <= 0.45 * F.col("exact")).alias("within"))


@register("a5_approx_distinct_per_block")
def a5_approx_distinct_per_block(spark, sf):
    return A.approx_distinct_per_block(S.blocks(spark, sf), S.GRID_COLS, 2)


from vigil.operators import states as ST  # noqa: E402
from vigil.operators.sequence import written_once  # noqa: E402


def _exact_sql(level, keys):
    cols = ", ".join(k if k in keys else f"CAST(NULL AS BIGINT) AS {k}" for k in ("hwid", "BlockID"))
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return " UNION ALL ".join(
        f"SELECT '{level}' AS level, {cols}, '{c}' AS sensor, count(DISTINCT {c}) AS exact, TRUE AS within "
        f"FROM blocks {group}" for c in S.GRID_COLS)


@register("a5_sketch_rollup", sql("SELECT * FROM (" + " UNION ALL ".join(
    _exact_sql(level, keys) for level, keys in (("block", ("hwid", "BlockID")), ("device", ("hwid",)),
                                                ("table", ()))) + ") WHERE exact > 0", "blocks"))
def a5_sketch_rollup(spark, sf):
    """Sketches per block, merged to devices and to the table, beside exact
    counts: within four standard errors."""
    blocks = S.blocks(spark, sf)
    cells = written_once(ST.distinct_sketches(blocks, S.GRID_COLS), "sketches")
    long = A.unpivot(blocks, list(S.GRID_COLS), "double", keys=("hwid", "BlockID"),
                     name_col="sensor", value_col="v").where("v IS NOT NULL")
    out = None
    for level, keys in (("block", ["hwid", "BlockID"]), ("device", ["hwid"]), ("table", [])):
        near = ST.distinct_estimates(ST.merge_sketches(cells, keys))
        exact = long.groupBy(*keys, "sensor").agg(F.count_distinct("v").alias("exact"))
        absent = [F.lit(None).cast("long").alias(k) for k in ("hwid", "BlockID") if k not in keys]
        one = exact.join(near, [*keys, "sensor"]).select(
            F.lit(level).alias("level"), *keys, *absent, "sensor", "exact",
            ST.within_error(F.col("n_distinct"), F.col("exact")).alias("within"))
        out = one if out is None else out.unionByName(one)
    return out


_A6 = """SELECT hwid, time_diff, count(*) AS count FROM (
  SELECT hwid, "when" - lag("when") OVER (PARTITION BY hwid ORDER BY "when") AS time_diff FROM wide)
WHERE time_diff IS NOT NULL GROUP BY hwid, time_diff"""


@register("a6_time_gap_frequency", sql(_A6, "wide"))
def a6_time_gap_frequency(spark, sf):
    return A.time_gap_frequency(S.wide(spark, sf), split_seconds=S.EVENTS.split_seconds)


def _a7_sql(lo, hi, delta):
    bins = int((hi - lo) / delta)
    w = (hi - lo) / bins
    return sql(f"""SELECT bin, CAST({float(lo)} AS DOUBLE) + bin * CAST({w} AS DOUBLE) AS bin_lo,
  CAST({float(lo)} AS DOUBLE) + (bin + 1) * CAST({w} AS DOUBLE) AS bin_hi,
  CAST(sum(count) AS BIGINT) AS count
FROM (SELECT CAST(least(greatest(floor((time_diff - {float(lo)}) / (({float(hi)} - {float(lo)}) / {bins})), 0), {bins - 1}) AS INTEGER) AS bin,
             count FROM ({_A6}) WHERE time_diff BETWEEN {lo} AND {hi})
GROUP BY bin""", "wide")


@register("a7_gap_histogram_short", _a7_sql(0, 86400, 3600))
def a7_gap_histogram_short(spark, sf):
    return A.gap_histogram(A.time_gap_frequency(S.wide(spark, sf), split_seconds=S.EVENTS.split_seconds), 0, 86400, 3600)


@register("a7_gap_histogram_long", _a7_sql(86400, 864000, 21600))
def a7_gap_histogram_long(spark, sf):
    return A.gap_histogram(A.time_gap_frequency(
        S.wide(spark, sf), split_seconds=S.EVENTS.split_seconds), 86400, 864000, 21600)


@register("a9_flag_totals", sql("""SELECT hwid, CAST(sum(flag_anomaly) AS BIGINT) AS total_flag_anomaly,
  CAST(sum(overheating) AS BIGINT) AS total_overheating FROM final GROUP BY hwid""", "final"))
def a9_flag_totals(spark, sf):
    return A.flag_totals(S.final(spark, sf), ["flag_anomaly", "overheating"])


@register("a10_any_true", sql("""SELECT hwid, BlockID, bool_or(flag_engine) AS any_flag_engine
FROM final GROUP BY hwid, BlockID""", "final"))
def a10_any_true(spark, sf):
    return A.any_true(S.final(spark, sf), ["hwid", "BlockID"], "flag_engine")


@register("a11_global_aggregate", sql("""SELECT count(*) AS n, avg(value) AS avg_value,
  max(value) AS max_value, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts FROM events"""))
def a11_global_aggregate(spark, sf):
    ev = X.load_table(spark, sf, "events")
    return A.summarize(ev, n=F.count(F.lit(1)), avg_value=F.avg("value"),
                       max_value=F.max("value"),
                       first_ts=F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("a11_grouped_aggregate", sql("""SELECT event_type, avg(value) AS avg_value,
  max(value) AS max_value, count(DISTINCT user_id) AS n_devices, count(*) AS n
FROM events GROUP BY event_type"""))
def a11_grouped_aggregate(spark, sf):
    ev = X.load_table(spark, sf, "events")
    return A.summarize(ev, ["event_type"], avg_value=F.avg("value"), max_value=F.max("value"),
                       n_devices=F.count_distinct("user_id"), n=F.count(F.lit(1)))


@register("a12_anomalous_blocks", sql("""SELECT hwid, BlockID FROM final GROUP BY hwid, BlockID
HAVING max(flag_anomaly) = 1""", "final"))
def a12_anomalous_blocks(spark, sf):
    return A.anomalous_blocks(S.final(spark, sf))


@register("a13_daily_anomaly_counts", sql(f"""SELECT hwid, strftime(make_timestamp("when" * 1000000), '%Y-%m-%d') AS day,
  CAST(sum(flag_anomaly) AS BIGINT) AS n_flag_anomaly, CAST(sum(overheating) AS BIGINT) AS n_overheating
FROM final WHERE "when" BETWEEN {T0} AND {T1} GROUP BY 1, 2""", "final"))
def a13_daily_anomaly_counts(spark, sf):
    x = A.daily_anomaly_counts(S.final(spark, sf), ["flag_anomaly", "overheating"], T0, T1)
    return x.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("a14_approx_median_by_class", sql("""SELECT flag_anomaly, quantile_disc("view", 0.5) AS exact,
  TRUE AS within FROM final WHERE "view" IS NOT NULL GROUP BY flag_anomaly""", "final"))
def a14_approx_median_by_class(spark, sf):
    """The sketch beside the exact median: equal while a class has fewer rows
    than the sketch's accuracy, near it beyond."""
    x = S.final(spark, sf).where("view IS NOT NULL")
    exact = x.groupBy("flag_anomaly").agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY view)").alias("exact"),
        F.stddev_pop("view").alias("sd"))
    return exact.join(A.approx_median_by_class(x, "view", "flag_anomaly"), "flag_anomaly").select(
        "flag_anomaly", "exact", (F.abs(F.col("median") - F.col("exact")) <= 0.05 * F.col("sd"))
        .alias("within"))


def _class_hist_sql(src, feature, target, bins):
    return f"""SELECT {target}, bin, lo + bin * ((hi - lo) / {bins}) AS bin_lo, count,
  CASE WHEN hi = lo THEN NULL ELSE count / (n_class * ((hi - lo) / {bins})) END AS density
FROM (SELECT {target}, bin, lo, hi, n_class, count(*) AS count FROM (
  SELECT x.{target}, lo, hi, n_class,
    CAST(CASE WHEN hi = lo THEN 0 ELSE least(greatest(floor((x.v - lo) / ((hi - lo) / {bins})), 0), {bins - 1}) END AS INTEGER) AS bin
  FROM (SELECT CAST({feature} AS DOUBLE) AS v, {target} FROM {src}
        WHERE {feature} IS NOT NULL AND {target} IS NOT NULL) x
  JOIN (SELECT {target}, min(CAST({feature} AS DOUBLE)) AS lo, max(CAST({feature} AS DOUBLE)) AS hi,
               count(*) AS n_class FROM {src} WHERE {feature} IS NOT NULL AND {target} IS NOT NULL
        GROUP BY {target}) b ON x.{target} = b.{target})
  GROUP BY {target}, bin, lo, hi, n_class)"""


@register("a16_class_histogram", sql(_class_hist_sql("final", "view", "flag_anomaly", 30), "final"))
def a16_class_histogram(spark, sf):
    return A.class_histogram(S.final(spark, sf), "view", "flag_anomaly", 30)


# ---------------------------------------------------------- D: anomaly

from vigil.operators import anomaly as D  # noqa: E402

_DKEYS = 'hwid, BlockID, "when", engine'


@register("d1_did_switch", sql(f"SELECT {_DKEYS}, didSwitch_engine FROM an1", "an1"))
def d1_did_switch(spark, sf):
    x = D.switch_columns(S.blocks(spark, sf), S.ENGINES, S.SEP)
    return x.select("hwid", "BlockID", "when", "engine", "didSwitch_engine")


@register("d2_qualify_switch", sql(f"SELECT {_DKEYS}, didSwitch_engine, qualified_engine FROM an2", "an2"))
def d2_qualify_switch(spark, sf):
    x = D.switch_columns(S.blocks(spark, sf), S.ENGINES, S.SEP)
    return x.select("hwid", "BlockID", "when", "engine", "didSwitch_engine", "qualified_engine")


@register("d3_switch_group", sql(f"""SELECT {_DKEYS}, qualified_engine, startGroup_engine, switchID_engine
FROM an4""", "an4"))
def d3_switch_group(spark, sf):
    x = D.switch_columns(S.blocks(spark, sf), S.ENGINES, S.SEP)
    return x.select("hwid", "BlockID", "when", "engine", "qualified_engine", "startGroup_engine",
                    "switchID_engine")


@register("d4_flag_groups", sql(f"""SELECT {_DKEYS}, switchID_engine, count_engine,
  flag0_engine AS flag_engine FROM an5""", "an5"))
def d4_flag_groups(spark, sf):
    x = D.switch_columns(S.blocks(spark, sf), S.ENGINES, S.SEP)
    x = D.flag_groups(x, S.ENGINES, S.TH)
    return x.select("hwid", "BlockID", "when", "engine", "switchID_engine", "count_engine",
                    "flag_engine")


@register("d5_extend_flags", sql(f"""SELECT {_DKEYS}, prevID_engine, nextID_engine, flag_engine
FROM anomalies""", "anomalies"))
def d5_extend_flags(spark, sf):
    x = S.anomalies(spark, sf, debug=True)
    return x.select("hwid", "BlockID", "when", "engine", "prevID_engine", "nextID_engine",
                    "flag_engine")


@register("d6_d7_detect_anomalies", sql(f"SELECT {_DKEYS}, flag_engine, flag_anomaly FROM anomalies",
                                        "anomalies"))
def d6_d7_detect_anomalies(spark, sf):
    return S.anomalies(spark, sf)


@register("d6_d7_detect_anomalies_sliced",
          sql(f"SELECT {_DKEYS}, flag_engine, flag_anomaly FROM anomalies", "anomalies"))
def d6_d7_detect_anomalies_sliced(spark, sf):
    """The same flags by time slices of five days with copies around them."""
    return D.detect_anomalies_sliced(S.blocks(spark, sf), S.SEP, S.TH, S.ENGINES, 5 * 24 * 3600)


def _d8_sql(rows):
    return sql(f"""SELECT {_DKEYS}, CASE WHEN nextID = prevID AND nextID > 0 THEN TRUE ELSE flag0 END AS flag_engine
FROM (SELECT *,
  CASE WHEN bool_or(flag0) OVER ({S._W_BLK} ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW)
       THEN max(sid) OVER ({S._W_BLK} ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW) END AS prevID,
  CASE WHEN bool_or(flag0) OVER ({S._W_BLK} ROWS BETWEEN CURRENT ROW AND {rows} FOLLOWING)
       THEN min(sid) OVER ({S._W_BLK} ROWS BETWEEN CURRENT ROW AND {rows} FOLLOWING) END AS nextID
FROM (SELECT *, COALESCE(count(*) OVER (PARTITION BY hwid, BlockID, sid) >= {S.TH} AND sid > 0, FALSE) AS flag0
FROM (SELECT *, CASE WHEN q THEN CAST(sum(COALESCE(sg, 0)) OVER ({S._W_BLK} {S._RUN}) AS BIGINT) END AS sid
FROM (SELECT *, CASE WHEN q THEN CASE WHEN pq IS NULL OR "when" - pq > {S.SEP} THEN 1 ELSE 0 END END AS sg
FROM (SELECT *, last(CASE WHEN q THEN "when" END IGNORE NULLS)
        OVER ({S._W_BLK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pq
FROM (SELECT *, COALESCE(ds = 1 AND (CASE WHEN engine = 1 THEN za > 0 ELSE TRUE END)
        AND (CASE WHEN engine = 0 THEN zb > 0 ELSE TRUE END), FALSE) AS q
FROM (SELECT *, CASE WHEN lag(engine) OVER ({S._W_BLK}) <> engine THEN 1 ELSE 0 END AS ds,
  count(CASE WHEN engine = 0 THEN 1 END) OVER ({S._W_BLK} ROWS BETWEEN 1 FOLLOWING AND {rows} FOLLOWING) AS za,
  count(CASE WHEN engine = 0 THEN 1 END) OVER ({S._W_BLK} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING) AS zb
FROM blocks)))))))""", "blocks")


@register("d8_detect_anomalies_rows", _d8_sql(int(S.SEP / 60)))
def d8_detect_anomalies_rows(spark, sf):
    return D.detect_anomalies_rows(S.blocks(spark, sf), S.SEP, S.TH, S.ENGINES)


_D9_TH = 3


@register("d9_detect_anomalies_first", sql(f"""SELECT {_DKEYS}, COALESCE(count_engine > {_D9_TH} AND ds = 1, FALSE) AS flag_engine,
  count_engine
FROM (SELECT *, count(*) OVER (PARTITION BY hwid, BlockID, sid) AS count_engine
FROM (SELECT *, CASE WHEN ds = 1 THEN CAST(sum(COALESCE(sg, 0)) OVER ({S._W_BLK} {S._RUN}) AS BIGINT) END AS sid
FROM (SELECT *, CASE WHEN ds = 1 THEN CASE WHEN pq IS NULL OR "when" - pq > {S.SEP} THEN 1 ELSE 0 END END AS sg
FROM (SELECT *, last(CASE WHEN ds = 1 THEN "when" END IGNORE NULLS)
        OVER ({S._W_BLK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pq
FROM (SELECT *, CASE WHEN lag(engine, 1, 0) OVER ({S._W_BLK}) <> engine THEN 1 ELSE 0 END AS ds
FROM blocks)))))""", "blocks"))
def d9_detect_anomalies_first(spark, sf):
    return D.detect_anomalies_first(S.blocks(spark, sf), S.SEP, _D9_TH, S.ENGINES)


_D10_MIN, _D10_TH = 720, 1


@register("d10_rolling_switch_anomaly", sql(f"""SELECT hwid, "when", strftime(day, '%Y-%m-%d') AS day, engine, switch_engine,
  change_count_engine, change_count_engine > {_D10_TH} AS engine_anomaly
FROM (SELECT *, CAST(sum(switch_engine) OVER (PARTITION BY hwid, day ORDER BY "when"
        RANGE BETWEEN {_D10_MIN * 60} PRECEDING AND CURRENT ROW) AS BIGINT) AS change_count_engine
FROM (SELECT hwid, "when", day, engine,
        CASE WHEN lag(engine) OVER (PARTITION BY hwid, day ORDER BY "when") <> engine THEN 1 ELSE 0 END AS switch_engine
      FROM (SELECT *, CAST(make_timestamp("when" * 1000000) AS DATE) AS day FROM grid)))""", "grid"))
def d10_rolling_switch_anomaly(spark, sf):
    x = D.rolling_switch_anomaly(S.grid(spark, sf), S.ENGINES, _D10_MIN, _D10_TH)
    return x.select("hwid", "when", F.date_format("day", "yyyy-MM-dd").alias("day"), "engine",
                    "switch_engine", "change_count_engine", "engine_anomaly")


@register("d11_blocks_with_anomaly", sql("""SELECT DISTINCT hwid, BlockID FROM anomalies
WHERE flag_engine""", "anomalies"))
def d11_blocks_with_anomaly(spark, sf):
    return D.blocks_with_anomaly(S.anomalies(spark, sf), "engine")


# ------------------------------------------------------------- J: joins

from vigil.operators import alarms as M  # noqa: E402


@register("j2_attach_flag_join", sql("""SELECT hwid, "when", BlockID, overheating FROM final""", "final"))
def j2_attach_flag_join(spark, sf):
    b = S.blocks(spark, sf)
    alarms = M.extract_alarms(b.select("hwid", "when", "A5", "A9"))
    out = M.attach_flag(b.select("hwid", "when", "BlockID"), alarms, "overheating")
    return out


@register("j3_join_multi_key", sql("""SELECT b.hwid, b."when", b.BlockID, b.engine, b.click, a.flag_anomaly
FROM blocks b LEFT JOIN anomalies a ON b.hwid = a.hwid AND b."when" = a."when"
  AND b.BlockID = a.BlockID AND b.engine = a.engine""", "blocks", "anomalies"))
def j3_join_multi_key(spark, sf):
    b = S.blocks(spark, sf).select("hwid", "when", "BlockID", "engine", "click")
    a = S.anomalies(spark, sf).select("hwid", "when", "BlockID", "engine", "flag_anomaly")
    return b.join(a, ["hwid", "when", "BlockID", "engine"], "left")


@register("j5_semi_join", sql("""SELECT hwid, "when", BlockID, flag_anomaly FROM final f
WHERE EXISTS (SELECT 1 FROM final g WHERE g.hwid = f.hwid AND g.BlockID = f.BlockID
              GROUP BY g.hwid, g.BlockID HAVING max(g.flag_anomaly) = 1)""", "final"))
def j5_semi_join(spark, sf):
    f = S.final(spark, sf)
    blocks = A.anomalous_blocks(f)
    return f.select("hwid", "when", "BlockID", "flag_anomaly").join(blocks, ["hwid", "BlockID"],
                                                                    "left_semi")


@register("j10_first_event_per_block", sql("""SELECT hwid, "when", BlockID, overheating,
  min(CASE WHEN overheating = 1 THEN "when" END) OVER (PARTITION BY hwid, BlockID) AS first_event,
  count(*) OVER (PARTITION BY hwid, BlockID) AS block_rows
FROM final""", "final"))
def j10_first_event_per_block(spark, sf):
    f = S.final(spark, sf)
    w = Window.partitionBy("hwid", "BlockID")
    return f.select("hwid", "when", "BlockID", "overheating",
                    F.min(F.when(F.col("overheating") == 1, F.col("when"))).over(w).alias("first_event"),
                    F.count(F.lit(1)).over(w).alias("block_rows"))


# ------------------------------------------------------ Z: set operators

from vigil.operators import setops as Z  # noqa: E402


@register("z1_union_by_name", sql("""SELECT hwid, "when", 'grid' AS src FROM grid
UNION ALL SELECT hwid, "when", 'raw' AS src FROM wide""", "grid", "wide"))
def z1_union_by_name(spark, sf):
    g = S.grid(spark, sf).select("hwid", "when", F.lit("grid").alias("src"))
    w = S.wide(spark, sf).select(F.lit("raw").alias("src"), "when", "hwid")
    return Z.union_by_name(g, w)


@register("z1_union_by_position", sql("""SELECT hwid, "when" FROM grid UNION ALL SELECT hwid, "when" FROM wide""",
                                      "grid", "wide"))
def z1_union_by_position(spark, sf):
    return Z.union_by_position(S.grid(spark, sf).select("hwid", "when"),
                               S.wide(spark, sf).select("hwid", "when"))


@register("z2_subtract", sql("""SELECT hwid, BlockID FROM blocks EXCEPT
SELECT hwid, BlockID FROM anomalies WHERE flag_engine""", "blocks", "anomalies"))
def z2_subtract(spark, sf):
    return Z.subtract(S.blocks(spark, sf).select("hwid", "BlockID"),
                      S.anomalies(spark, sf).where("flag_engine").select("hwid", "BlockID"))


@register("z3_distinct", sql("SELECT DISTINCT hwid, engine FROM grid", "grid"))
def z3_distinct(spark, sf):
    return Z.distinct(S.grid(spark, sf), ["hwid", "engine"])


@register("z4_sort", sql("""SELECT hwid, "when", view FROM grid
ORDER BY hwid DESC, view * -1 ASC NULLS LAST, "when\"""", "grid"))
def z4_sort(spark, sf):
    g = S.grid(spark, sf).select("hwid", "when", "view")
    return Z.sort(g, F.col("hwid").desc(), (F.col("view") * -1).asc_nulls_last(), "when")


@register("z5_limit_last", sql("""SELECT hwid, "when" FROM grid ORDER BY "when" DESC, hwid DESC LIMIT 7""",
                               "grid"))
def z5_limit_last(spark, sf):
    return Z.first_n(S.grid(spark, sf).select("hwid", "when"), 7, "when", "hwid", last=True)


@register("z6_top_gaps", sql(f"""SELECT hwid, time_diff, count,
  CASE WHEN rank_small <= 3 THEN rank_small END AS rank_small,
  CASE WHEN rank_large <= 3 THEN rank_large END AS rank_large,
  CASE WHEN rank_small <= 3 THEN 'smallest' ELSE 'largest' END AS side
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY hwid ORDER BY time_diff) AS INTEGER) AS rank_small,
        CAST(row_number() OVER (PARTITION BY hwid ORDER BY time_diff DESC) AS INTEGER) AS rank_large
      FROM ({_A6}))
WHERE rank_small <= 3 OR rank_large <= 3""", "wide"))
def z6_top_gaps(spark, sf):
    return Z.top_gaps(A.time_gap_frequency(S.wide(spark, sf),
                                           split_seconds=S.EVENTS.split_seconds), 3)


# ------------------------------------------------------ C: correlation

from vigil.operators import correlation as C  # noqa: E402

LI_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


_LI_COMPLETE = ("SELECT * FROM lineitem WHERE "
                + " AND ".join(f"{c} IS NOT NULL" for c in LI_COLS))


@register("c1_covariance_matrix", sql(f"""WITH li AS ({_LI_COMPLETE})
SELECT col_i, col_j, cov FROM (
  {' UNION ALL '.join(f"SELECT '{a}' AS col_i, '{b}' AS col_j, covar_samp({a}, {b}) AS cov FROM li"
                      for a in LI_COLS for b in LI_COLS)})"""))
def c1_covariance_matrix(spark, sf):
    return C.covariance_matrix(X.load_table(spark, sf, "lineitem"), LI_COLS)


def _rank_sql(src, cols, target):
    feats = [c for c in cols if c != target]
    where = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS sensor, covar_samp({c}, {target}) / "
        f"NULLIF(sqrt(var_samp({c})) * sqrt(var_samp({target})), 0) AS correlation FROM x"
        for c in feats)
    return (f"WITH x AS (SELECT * FROM {src} WHERE {where})\n"
            f"SELECT sensor, correlation, abs(correlation) AS abs_corr FROM ({parts}) "
            f"WHERE correlation IS NOT NULL AND NOT isnan(correlation) AND NOT isinf(correlation)")


@register("c2_correlation_ranking", sql(_rank_sql("lineitem", LI_COLS, "l_extendedprice")))
def c2_correlation_ranking(spark, sf):
    return C.correlation_ranking(X.load_table(spark, sf, "lineitem"), LI_COLS, "l_extendedprice")


def _pair_sql(src, feats, target, group=None):
    exprs = []
    for s in feats:
        b = f"CASE WHEN {s} IS NOT NULL AND {target} IS NOT NULL"
        vs, ts = f"{b} THEN CAST({s} AS DOUBLE) END", f"{b} THEN CAST({target} AS DOUBLE) END"
        exprs.append((s, f"covar_samp({vs}, {ts}) / NULLIF(stddev_samp({vs}) * stddev_samp({ts}), 0)"))
    if group:
        return f"SELECT {group}, " + ", ".join(f"{e} AS corr_{s}" for s, e in exprs) + \
            f" FROM {src} GROUP BY {group}"
    parts = " UNION ALL ".join(
        f"SELECT '{s}' AS sensor, COALESCE(CASE WHEN isnan({e}) THEN NULL ELSE {e} END, 0.0) AS correlation FROM {src}"
        for s, e in exprs)
    return f"SELECT sensor, correlation, abs(correlation) AS abs_corr FROM ({parts})"


@register("c3_pairwise_correlation", sql(_pair_sql("final", [*S.SENSORS, "engine"], "flag_anomaly"),
                                         "final"))
def c3_pairwise_correlation(spark, sf):
    return C.pairwise_correlation(S.final(spark, sf), [*S.SENSORS, "engine"], "flag_anomaly")


@register("c5_correlation_by_device", sql(_pair_sql("final", [*S.SENSORS, "engine"], "flag_anomaly",
                                                    group="hwid"), "final"))
def c5_correlation_by_device(spark, sf):
    return C.correlation_by_device(S.final(spark, sf), [*S.SENSORS, "engine"], "flag_anomaly")


def _line_states(spark, sf, pairs):
    """Co-moments of the order lines per supplier and day, written once."""
    lines = X.load_table(spark, sf, "lineitem")
    return written_once(ST.pair_states(lines, pairs, ["l_suppkey", "l_shipdate"], complete=True,
                                       deal=True), "line-states")


def _sensor_states(spark, sf):
    """Co-moments of sensors and the flag per device and day, written once."""
    rows = S.final(spark, sf).withColumn("day", F.floor(F.col("when") / 86400))
    pairs = [(c, "flag_anomaly") for c in (*S.SENSORS, "engine")]
    return written_once(ST.pair_states(rows, pairs, ["hwid", "day"]), "sensor-states")


@register("c1_covariance_from_states", SQL["c1_covariance_matrix"])
def c1_covariance_from_states(spark, sf):
    return ST.covariances(ST.merge_pair_states(_line_states(spark, sf, ST.all_pairs(LI_COLS))))


@register("c2_ranking_from_states", SQL["c2_correlation_ranking"])
def c2_ranking_from_states(spark, sf):
    pairs = [(c, "l_extendedprice") for c in LI_COLS if c != "l_extendedprice"]
    got = ST.correlations(ST.merge_pair_states(_line_states(spark, sf, pairs)))
    return got.where("correlation IS NOT NULL").withColumn("abs_corr", F.abs("correlation"))


@register("c3_pairwise_from_states", SQL["c3_pairwise_correlation"])
def c3_pairwise_from_states(spark, sf):
    got = ST.correlations(ST.merge_pair_states(_sensor_states(spark, sf)))
    return got.select("sensor", F.coalesce("correlation", F.lit(0.0)).alias("correlation"),
                      F.abs(F.coalesce("correlation", F.lit(0.0))).alias("abs_corr"))


@register("c5_by_device_from_states", sql(f"""SELECT hwid, sensor, correlation FROM (
  {' UNION ALL '.join(f"""SELECT hwid, '{s}' AS sensor, corr_{s} AS correlation FROM
    ({_pair_sql('final', [s], 'flag_anomaly', 'hwid')})""" for s in (*S.SENSORS, 'engine'))})
WHERE correlation IS NOT NULL AND NOT isnan(correlation)""", "final"))
def c5_by_device_from_states(spark, sf):
    got = ST.correlations(ST.merge_pair_states(_sensor_states(spark, sf), ["hwid"]), "hwid")
    return got.where("correlation IS NOT NULL")


@register("c6_overlap_area", sql("""WITH x AS (SELECT CAST(view AS DOUBLE) AS x, CAST(flag_anomaly AS INTEGER) AS y
  FROM final WHERE view IS NOT NULL AND flag_anomaly IN (0, 1)),
b AS (SELECT min(x) AS lo, max(x) AS hi, count(CASE WHEN y = 0 THEN 1 END) AS n0,
             count(CASE WHEN y = 1 THEN 1 END) AS n1 FROM x)
SELECT 'view' AS sensor, sum(least(CAST(c0 AS DOUBLE) / n0, CAST(c1 AS DOUBLE) / n1)) * 100 AS overlap_pct
FROM (SELECT bin, count(CASE WHEN y = 0 THEN 1 END) AS c0, count(CASE WHEN y = 1 THEN 1 END) AS c1
      FROM (SELECT y, CAST(least(greatest(floor((x - lo) / ((hi - lo) / 50)), 0), 49) AS INTEGER) AS bin
            FROM x, b) GROUP BY bin), (SELECT n0, n1 FROM b)
GROUP BY n0, n1""", "final"))
def c6_overlap_area(spark, sf):
    return C.overlap_area(S.final(spark, sf), "view", "flag_anomaly", 50)


@register("c7_own_bins_overlap", sql("""WITH x AS (SELECT CAST(view AS DOUBLE) AS x, CAST(flag_anomaly AS INTEGER) AS y
  FROM final WHERE view IS NOT NULL AND flag_anomaly IN (0, 1)),
b AS (SELECT y, min(x) AS lo, max(x) AS hi, count(*) AS n, (max(x) - min(x)) / 30 AS width FROM x GROUP BY y),
h AS (SELECT b.y, g.bin, lo + g.bin * width AS from_x, CASE WHEN g.bin = 29 THEN hi ELSE lo + (g.bin + 1) * width END AS to_x,
    width, (SELECT count(*) FROM x WHERE x.y = b.y
      AND least(greatest(floor((x.x - lo) / ((hi - lo) / 30)), 0), 29) = g.bin) / (n * width) AS height
  FROM b, (SELECT unnest(range(30)) AS bin) g)
SELECT 'view' AS sensor,
  (SELECT sum(least(p.height, q.height) * greatest(0.0, least(p.to_x, q.to_x) - greatest(p.from_x, q.from_x)))
   FROM h p, h q WHERE p.y = 0 AND q.y = 1) * 100 AS overlap_pct,
  (SELECT sum(least(p.height, q.height) * p.width) FROM h p JOIN h q ON p.bin = q.bin
   WHERE p.y = 0 AND q.y = 1) * 100 AS by_bin_pct""", "final"))
def c7_own_bins_overlap(spark, sf):
    return C.own_bins_overlap(S.final(spark, sf), "view", "flag_anomaly", 30)


@register("c8_load_temperature", sql("""SELECT l_quantity, count(l_extendedprice) AS count,
  avg(l_extendedprice) AS avg_temperature, stddev_samp(l_extendedprice) AS std_temperature
FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY l_quantity
HAVING count(l_extendedprice) > 300 OR l_quantity = 100"""))
def c8_load_temperature(spark, sf):
    return C.load_temperature(X.load_table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")


@register("c9_hist2d", sql("""WITH x AS (SELECT CAST(l_quantity AS DOUBLE) AS l, l_tax * 100 AS t FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_tax IS NOT NULL),
b AS (SELECT min(t) - 1 - 0.5 AS t0, max(t) + 1 + 0.5 AS t1 FROM x)
SELECT load_bin, temp_bin, count(*) AS count FROM (
  SELECT CAST(floor((l - (-3.0)) / 4) AS BIGINT) AS load_bin, CAST(floor((t - t0) / 1) AS BIGINT) AS temp_bin,
         CAST(ceil((t1 - t0) / 1) AS BIGINT) - 1 AS n_t
  FROM x, b)
WHERE load_bin BETWEEN 0 AND 25 AND temp_bin BETWEEN 0 AND n_t - 1
GROUP BY load_bin, temp_bin"""))
def c9_hist2d(spark, sf):
    li = X.load_table(spark, sf, "lineitem").withColumn("tax_pct", F.col("l_tax") * 100)
    return C.hist2d(li, "l_quantity", "tax_pct")


@register("c10_top_levels", sql("""WITH top AS (SELECT l_quantity FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
  GROUP BY l_quantity ORDER BY count(*) DESC, l_quantity ASC LIMIT 3),
b AS (SELECT l_quantity, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
        CAST(greatest(floor(max(l_extendedprice) - min(l_extendedprice)) * 2, 1) AS INTEGER) AS n_bins
      FROM lineitem WHERE l_quantity IN (SELECT l_quantity FROM top) AND l_extendedprice IS NOT NULL
      GROUP BY l_quantity)
SELECT l_quantity, bin, lo + bin * ((hi - lo) / n_bins) AS bin_lo, count(*) AS count FROM (
  SELECT b.l_quantity, lo, hi, n_bins, CAST(CASE WHEN hi = lo THEN 0
    ELSE least(floor((l.l_extendedprice - lo) / ((hi - lo) / n_bins)), n_bins - 1) END AS INTEGER) AS bin
  FROM lineitem l JOIN b ON l.l_quantity = b.l_quantity WHERE l.l_extendedprice IS NOT NULL)
GROUP BY l_quantity, n_bins, lo, hi, bin"""))
def c10_top_levels(spark, sf):
    return C.top_levels(X.load_table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 3)


@register("c11_load_temp_correlation", sql(_pair_sql("lineitem", ["l_quantity", "l_discount", "l_tax"],
                                                     "l_extendedprice")))
def c11_load_temp_correlation(spark, sf):
    return C.pairwise_correlation(X.load_table(spark, sf, "lineitem"),
                                  ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


@register("c12_pca")
def c12_pca(spark, sf):
    table, _ = C.pca(X.load_table(spark, sf, "lineitem"), LI_COLS)
    return table


_C13_MIN = 3


@register("c13_auc_by_block_sensor", sql(f"""WITH fb AS (SELECT hwid, BlockID FROM final GROUP BY hwid, BlockID
  HAVING max(flag_anomaly) = 1),
long AS (SELECT hwid, BlockID, CAST(flag_anomaly AS INTEGER) AS y, sensor, v
  FROM (SELECT * FROM final WHERE EXISTS (SELECT 1 FROM fb WHERE fb.hwid = final.hwid
                                         AND fb.BlockID = final.BlockID))
  UNPIVOT (v FOR sensor IN ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in S.SENSORS)}))),
r AS (SELECT *, rank() OVER (PARTITION BY hwid, BlockID, sensor ORDER BY v)
        + (count(*) OVER (PARTITION BY hwid, BlockID, sensor, v) - 1) / 2.0 AS rk FROM long),
g AS (SELECT hwid, BlockID, sensor, count(DISTINCT v) AS nd, sum(CASE WHEN y = 1 THEN rk END) AS rsum,
        count(CASE WHEN y = 1 THEN 1 END) AS n1, count(CASE WHEN y = 0 THEN 1 END) AS n0
      FROM r GROUP BY hwid, BlockID, sensor)
SELECT hwid, BlockID, sensor, (CAST(rsum AS DOUBLE) - CAST(n1 * (n1 + 1) AS DOUBLE) / 2) / CAST(n1 * n0 AS DOUBLE) AS roc_auc
FROM g WHERE nd > {_C13_MIN} AND n1 > 0 AND n0 > 0""", "final"))
def c13_auc_by_block_sensor(spark, sf):
    return C.auc_by_block_sensor(S.final(spark, sf), S.SENSORS, "flag_anomaly", _C13_MIN)


def _docs(spark, sf):
    d = X.load_table(spark, sf, "documents").select("doc_id", "n_chars")
    return d.join(X.load_table(spark, sf, "labels"), "doc_id")


_DOCS_SQL = "(SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@register("c14_roc_curve", sql(f"""WITH per AS (SELECT CAST(n_chars AS DOUBLE) AS s,
    count(CASE WHEN quality = 1 THEN 1 END) AS tp_d, count(CASE WHEN quality = 0 THEN 1 END) AS fp_d
  FROM {_DOCS_SQL} WHERE n_chars IS NOT NULL AND quality IS NOT NULL GROUP BY 1)
SELECT s AS threshold,
  CAST(sum(tp_d) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) / (SELECT sum(tp_d) FROM per) AS tpr,
  CAST(sum(fp_d) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) / (SELECT sum(fp_d) FROM per) AS fpr
FROM per"""))
def c14_roc_curve(spark, sf):
    return C.roc_curve(_docs(spark, sf), "quality", "n_chars")


@register("c15_mutual_information", sql(f"""WITH long AS (SELECT hwid, BlockID, CAST(flag_anomaly AS INTEGER) AS y, sensor, v
  FROM final UNPIVOT (v FOR sensor IN ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in S.SENSORS)}))
  WHERE flag_anomaly IS NOT NULL),
b AS (SELECT hwid, BlockID, sensor, min(v) AS lo, max(v) AS hi, count(*) AS n FROM long GROUP BY 1, 2, 3),
cell AS (SELECT l.hwid, l.BlockID, l.sensor, n, y,
    CAST(CASE WHEN hi = lo THEN 0 ELSE least(greatest(floor((v - lo) / ((hi - lo) / 10)), 0), 9) END AS INTEGER) AS bin,
    count(*) AS nxy
  FROM long l JOIN b ON l.hwid = b.hwid AND l.BlockID = b.BlockID AND l.sensor = b.sensor
  GROUP BY l.hwid, l.BlockID, l.sensor, n, y, bin),
c2 AS (SELECT *, sum(nxy) OVER (PARTITION BY hwid, BlockID, sensor, bin) AS nx,
              sum(nxy) OVER (PARTITION BY hwid, BlockID, sensor, y) AS ny FROM cell)
SELECT hwid, BlockID, sensor, sum((CAST(nxy AS DOUBLE) / n) * ln(nxy * n / (nx * ny))) AS mutual_info
FROM c2 GROUP BY hwid, BlockID, sensor""", "final"))
def c15_mutual_information(spark, sf):
    return C.mutual_information(S.final(spark, sf), S.SENSORS, "flag_anomaly", 10)


@register("c15_neighbour_information", sql(f"""WITH fb AS (SELECT hwid, BlockID FROM final GROUP BY hwid, BlockID
  HAVING max(flag_anomaly) = 1),
long AS (SELECT row_number() OVER () AS id, hwid, BlockID, CAST(flag_anomaly AS INTEGER) AS y, sensor, v
  FROM (SELECT * FROM final JOIN fb USING (hwid, BlockID))
  UNPIVOT (v FOR sensor IN ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in S.SENSORS)}))),
-- distances to all class mates, in order
near AS (SELECT a.id, a.hwid, a.BlockID, a.sensor, a.v, count(b.id) AS mates,
    list_sort(list(abs(a.v - b.v)) FILTER (b.id IS NOT NULL)) AS far
  FROM long a LEFT JOIN long b ON a.hwid = b.hwid AND a.BlockID = b.BlockID AND a.sensor = b.sensor
    AND a.y = b.y AND a.id <> b.id
  GROUP BY a.id, a.hwid, a.BlockID, a.sensor, a.v),
rad AS (SELECT *, least(3, mates) AS k, far[least(3, mates)] AS r FROM near WHERE mates > 0),
cnt AS (SELECT p.id, p.hwid, p.BlockID, p.sensor, p.k, p.mates + 1 AS size, count(*) AS m
  FROM rad p JOIN long q ON p.hwid = q.hwid AND p.BlockID = q.BlockID AND p.sensor = q.sensor
    AND (q.v = p.v OR (q.v > p.v - p.r AND q.v < p.v + p.r))
  GROUP BY ALL),
psi AS (SELECT n, -0.57721566490153286::DOUBLE + coalesce(sum(1.0::DOUBLE / (n - 1)) OVER (ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS psi
  FROM (SELECT unnest(range(2, (SELECT max(c) + 2 FROM (SELECT count(*) AS c FROM long GROUP BY hwid, BlockID, sensor)))) AS n)
  UNION ALL SELECT 1, -0.57721566490153286::DOUBLE),
est AS (SELECT c.hwid, c.BlockID, c.sensor, count(*) AS n, avg(a.psi - b.psi - d.psi) AS mean
  FROM cnt c JOIN psi a ON a.n = c.k JOIN psi b ON b.n = c.size JOIN psi d ON d.n = c.m
  GROUP BY c.hwid, c.BlockID, c.sensor)
SELECT hwid, BlockID, sensor, coalesce(greatest(0.0::DOUBLE, round(p.psi + mean, 10)), 0.0::DOUBLE) AS mutual_info
FROM (SELECT DISTINCT hwid, BlockID, sensor FROM long) LEFT JOIN est USING (hwid, BlockID, sensor)
LEFT JOIN psi p ON p.n = est.n""", "final"))
def c15_neighbour_information(spark, sf):
    return C.neighbour_information(S.final(spark, sf), S.SENSORS, "flag_anomaly", 3)


@register("c16_top_bottom", sql(f"""(SELECT *, 'top' AS side FROM ({_pair_sql('final', [*S.SENSORS, 'engine'], 'flag_anomaly')})
  ORDER BY abs_corr DESC, sensor LIMIT 2)
UNION ALL (SELECT *, 'bottom' AS side FROM ({_pair_sql('final', [*S.SENSORS, 'engine'], 'flag_anomaly')})
  ORDER BY abs_corr ASC, sensor LIMIT 2)""", "final"))
def c16_top_bottom(spark, sf):
    r = C.pairwise_correlation(S.final(spark, sf), [*S.SENSORS, "engine"], "flag_anomaly")
    return C.top_bottom(r, 2)


# -------------------------------------------------- M: alarms and labels

def _bit_sql(word, b):
    return f'CAST(({word} & {1 << (b - 1)}) > 0 AS INTEGER)'


_BITS8 = range(1, 9)


@register("m1_alarm_bits", sql(f"""SELECT hwid, "when", A5, A9, {', '.join(
    f'{_bit_sql(w, b)} AS "{b}-{w}"' for w in S.ALARMS for b in _BITS8)} FROM grid""", "grid"))
def m1_alarm_bits(spark, sf):
    return M.alarm_bits(S.grid(spark, sf).select("hwid", "when", "A5", "A9"), S.ALARMS, _BITS8)


_B678 = (6, 7, 8)
_OVER = " OR ".join(f"{_bit_sql(w, b)} = 1" for w in S.ALARMS for b in _B678)


@register("m2_extract_alarms", sql(f"""SELECT hwid, "when", A5, A9, {', '.join(
    f'{_bit_sql(w, b)} AS "{b}-{w}"' for w in S.ALARMS for b in _B678)},
  CASE WHEN {_OVER} THEN 1 ELSE 0 END AS overheating
FROM grid WHERE A5 IS NOT NULL OR A9 IS NOT NULL""", "grid"))
def m2_extract_alarms(spark, sf):
    return M.extract_alarms(S.grid(spark, sf).select("hwid", "when", "A5", "A9"))


@register("m3_extract_alarms_sum", sql(f"""SELECT hwid, "when", A5, A9, {', '.join(
    f'{_bit_sql(w, b)} AS "{b}-{w}"' for w in S.ALARMS for b in (8, 7, 6))},
  CASE WHEN {' + '.join(_bit_sql(w, b) for w in S.ALARMS for b in (8, 7, 6))} > 0 THEN 1 ELSE 0 END AS overheating
FROM grid""", "grid"))
def m3_extract_alarms_sum(spark, sf):
    return M.extract_alarms_sum(S.grid(spark, sf).select("hwid", "when", "A5", "A9"))


@register("m4_extract_alarms_fill", sql(f"""SELECT hwid, "when", A5, A9, {', '.join(
    f'{_bit_sql(w, b)} AS "{b}-{w}"' for w in S.ALARMS for b in _B678)},
  COALESCE(CASE WHEN {_OVER} THEN 1 ELSE 0 END, 0) AS overheating
FROM grid WHERE A5 IS NOT NULL OR A9 IS NOT NULL""", "grid"))
def m4_extract_alarms_fill(spark, sf):
    return M.extract_alarms(S.grid(spark, sf).select("hwid", "when", "A5", "A9"), fill_null=True)


@register("m5_attach_overheating", sql("""SELECT hwid, "when", BlockID, A5, A9, overheating FROM final""",
                                       "final"))
def m5_attach_overheating(spark, sf):
    return S.final(spark, sf).select("hwid", "when", "BlockID", "A5", "A9", "overheating")


@register("m6_add_predictive", sql("""SELECT hwid, "when", BlockID, overheating, predictive_overheating
FROM predicted""", "predicted"))
def m6_add_predictive(spark, sf):
    return S.predicted(spark, sf).select("hwid", "when", "BlockID", "overheating",
                                         "predictive_overheating")


@register("m6_add_predictive_anomaly", sql(f"""SELECT hwid, "when", BlockID, flag_anomaly,
  CASE WHEN ns IS NOT NULL AND (flag_anomaly IS NULL OR flag_anomaly = 0)
        AND ns - "when" > 0 AND ns - "when" <= {S.LOOK} THEN 1 ELSE 0 END AS predictive_flag_anomaly
FROM (SELECT *, first(CASE WHEN st = 1 THEN "when" END IGNORE NULLS)
        OVER ({S._W_BLK} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ns
      FROM (SELECT *, CASE WHEN flag_anomaly = 1 AND (lag(flag_anomaly) OVER ({S._W_BLK}) <> 1
              OR lag(flag_anomaly) OVER ({S._W_BLK}) IS NULL) THEN 1 ELSE 0 END AS st FROM final))""",
                                           "final"))
def m6_add_predictive_anomaly(spark, sf):
    x = M.add_predictive(S.final(spark, sf), "flag_anomaly", S.EVENTS.lookahead_minutes)
    return x.select("hwid", "when", "BlockID", "flag_anomaly", "predictive_flag_anomaly")


_M7_PREV, _M7_POST = 2 * 86400, 6 * 3600


@register("m7_event_aligned_by_position", sql(f"""SELECT hwid, BlockID, "when", engine, view, overheating,
  CAST(naive_order - min(CASE WHEN overheating = 1 THEN naive_order END)
       OVER (PARTITION BY hwid, BlockID) AS INTEGER) AS "order"
FROM (SELECT *, row_number() OVER ({S._W_BLK}) - 1 AS naive_order FROM (
  SELECT hwid, BlockID, "when", engine, view, overheating,
    count(CASE WHEN overheating = 1 THEN 1 END) OVER ({S._W_BLK}
      RANGE BETWEEN {_M7_POST} PRECEDING AND {_M7_PREV} FOLLOWING) AS c FROM final) WHERE c > 0)""",
                                              "final"))
def m7_event_aligned_by_position(spark, sf):
    return M.event_aligned_by_position(S.final(spark, sf), ["engine", "view"], "overheating",
                                       _M7_PREV, _M7_POST)


_M8_PREV, _M8_POST = 10 * 86400, 10 * 86400


@register("m8_event_aligned_rate", sql(f"""SELECT sensor, relative_time, value,
  CAST(occurrences AS DOUBLE) / sum(occurrences) OVER (PARTITION BY sensor, relative_time) AS rate
FROM (SELECT 'engine' AS sensor, relative_time, CAST(engine AS DOUBLE) AS value, count(*) AS occurrences
      FROM (SELECT engine, "when" - min(CASE WHEN overheating = 1 THEN "when" END)
                   OVER (PARTITION BY hwid, BlockID) AS relative_time
            FROM (SELECT * FROM (SELECT *, count(CASE WHEN overheating = 1 THEN 1 END) OVER ({S._W_DEV}
                    RANGE BETWEEN {_M8_POST} PRECEDING AND {_M8_PREV} FOLLOWING) AS near FROM final)
                  WHERE near > 0))
      WHERE relative_time < {_M8_POST} GROUP BY 1, 2, 3)""", "final"))
def m8_event_aligned_rate(spark, sf):
    return M.event_aligned_rate(S.final(spark, sf), ["engine"], "overheating", _M8_PREV, _M8_POST)


_M9_DUR, _M9_ROLL = 4320, 720


@register("m9_event_summary", sql(f"""SELECT MinToOverheating, {', '.join(
    f'{s}_avg, {s}_std, {s}_n, avg({s}_avg) OVER (ORDER BY MinToOverheating RANGE BETWEEN {_M9_ROLL} PRECEDING AND CURRENT ROW) AS {s}_rolling, {s}_std / sqrt({s}_n) AS {s}_err'
    for s in ('engine', 'view'))}
FROM (SELECT MinToOverheating, {', '.join(f'avg({s}) AS {s}_avg, stddev_samp({s}) AS {s}_std, count({s}) AS {s}_n'
                                          for s in ('engine', 'view'))}
      FROM heat WHERE MinToOverheating <= {_M9_DUR} GROUP BY MinToOverheating)""", "heat"))
def m9_event_summary(spark, sf):
    return M.event_summary(S.heat(spark, sf), _M9_DUR, ["engine", "view"], _M9_ROLL)


def _rolling_sql(src, cols, minutes):
    parts = []
    for c in cols:
        r = f'avg({c}) OVER ({S._W_HEAT} RANGE BETWEEN {minutes * 60} PRECEDING AND CURRENT ROW)'
        parts.append(f"{r} AS {c}_rolling")
    inner = f"SELECT *, {', '.join(parts)} FROM {src}"
    ders = ", ".join(
        f'COALESCE(({c}_rolling - lag({c}_rolling) OVER ({S._W_HEAT})) / '
        f'NULLIF("when" - lag("when") OVER ({S._W_HEAT}), 0), 0.0) AS {c}_rolling_derivative'
        for c in cols)
    return f"SELECT *, {ders} FROM ({inner})"


_M10_MIN = 1440


@register("m10_rolling_and_derivative", sql(f"""SELECT hwid, BlockHeat, "when", engine, engine_rolling,
  engine_rolling_derivative FROM ({_rolling_sql('heat', ['engine'], _M10_MIN)})""", "heat"))
def m10_rolling_and_derivative(spark, sf):
    x = M.rolling_and_derivative(S.heat(spark, sf), "engine", _M10_MIN)
    return x.select("hwid", "BlockHeat", "when", "engine", "engine_rolling",
                    "engine_rolling_derivative")


# ------------------------------------------------- L: learning and scores

from vigil.operators import learn as L  # noqa: E402

FEATURES = ("engine_rolling", "engine_rolling_derivative", "flag_anomaly_rolling",
            "flag_anomaly_rolling_derivative")


def _features(spark, sf):
    return M.add_rolling_features(S.heat(spark, sf), ["engine", "flag_anomaly"], _M10_MIN)


_KEYS_P = ["hwid", "when", "predictive_overheating"]


def _unit_sql(seed, keys=("hwid", '"when"')):
    text = "':' || ".join(f"{k}::VARCHAR || " for k in keys)[:-4]
    return f"('0x' || substr(md5('{seed}:' || {text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


@register("l1_undersample", sql(f"""SELECT hwid, "when", predictive_overheating FROM predicted
WHERE predictive_overheating = 1 OR {_unit_sql(123)} <= 0.25""", "predicted"))
def l1_undersample(spark, sf):
    return L.undersample(S.predicted(spark, sf), "predictive_overheating", 0.25).select(*_KEYS_P)


@register("l2_class_weights", sql("""SELECT hwid, "when", predictive_overheating,
  CAST(CASE WHEN predictive_overheating = 1 THEN 8.0 ELSE 1.0 END AS DOUBLE) AS weight FROM predicted""", "predicted"))
def l2_class_weights(spark, sf):
    return L.class_weights(S.predicted(spark, sf).select(*_KEYS_P), "predictive_overheating", 8)


@register("l3_replicate_positive", sql("""SELECT f.hwid, f."when", f.overheating FROM final f,
  range(CASE WHEN f.overheating = 1 THEN 3 ELSE 1 END) r""", "final"))
def l3_replicate_positive(spark, sf):
    return L.replicate_positive(S.final(spark, sf).select("hwid", "when", "overheating"),
                                "overheating", 3)


@register("l4_balanced_set", sql(f"""SELECT DISTINCT hwid, "when", predictive_overheating FROM predicted
WHERE predictive_overheating = 0 AND NOT {_unit_sql(42)} <= 0.73
UNION ALL SELECT hwid, "when", predictive_overheating FROM predicted
WHERE predictive_overheating = 1""", "predicted"))
def l4_balanced_set(spark, sf):
    return L.balanced_set(S.predicted(spark, sf).select(*_KEYS_P), "predictive_overheating", 0.73)


@register("l5_train_test_split", sql(f"""SELECT hwid, "when", predictive_overheating,
  CASE WHEN {_unit_sql(42 + 7919)} < 0.7 THEN 'train' ELSE 'test' END AS part FROM predicted""",
                                     "predicted"))
def l5_train_test_split(spark, sf):
    train, test = L.train_test_split(S.predicted(spark, sf).select(*_KEYS_P))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


def _scaled_sql():
    mean = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATURES)
    keep = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
    cols = ", ".join(f"CASE WHEN s_{c} = 0 THEN 0.0::DOUBLE ELSE ({c} - m_{c}) / s_{c} END AS {c}"
                     for c in FEATURES)
    return f"""WITH f AS (SELECT * FROM ({_rolling_sql('heat', ['engine', 'flag_anomaly'], _M10_MIN)})
  WHERE {keep}), m AS (SELECT {mean} FROM f)
SELECT hwid, "when", {cols} FROM f, m"""


@register("l6_assemble_scale", sql(_scaled_sql(), "heat"))
def l6_assemble_scale(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    data = _features(spark, sf).na.drop(subset=list(FEATURES))
    model = Pipeline(stages=L.assembler_stages(FEATURES, scaler=True)).fit(data)
    scaled = vector_to_array("features")
    return model.transform(data).select("hwid", "when", *[scaled[i].alias(c)
                                                          for i, c in enumerate(FEATURES)])


_MODEL_COLS = ("hwid", "when", "BlockHeat", "MinToOverheating", "predictive_overheating")


def _model_rows(spark, sf, skim=None):
    """The rows that models are fitted on and score, with ``skim`` undersampled.  If
    there are events for more tasks than cores, they are written once: each model
    reads them to be fitted and to score.  Rows of small tables are cheaper to make
    again."""
    rows = _features(spark, sf)
    if skim is not None:
        rows = L.undersample(rows, "predictive_overheating", skim)
    if S.device_tasks(spark, sf) <= spark.sparkContext.defaultParallelism:
        return rows
    return written_once(rows.select(*_MODEL_COLS, *FEATURES), "model-rows")


def _model_preds(spark, sf, algo, rows=None, **kw):
    data = _model_rows(spark, sf, 0.25) if rows is None else rows
    model, _, preds = L.run_model(data, FEATURES, "predictive_overheating", algo, **kw)
    cols = [*_MODEL_COLS, "prediction"]
    if "ProbOverheating" in preds.columns:
        cols.append("ProbOverheating")
    return model, preds.select(*cols)


@register("l7_linear_svm")
def l7_linear_svm(spark, sf):
    return _model_preds(spark, sf, "svc", weight_class1=8)[1]


@register("l8_logistic_regression")
def l8_logistic_regression(spark, sf):
    return _model_preds(spark, sf, "lr", weight_class1=10)[1]


@register("l8_coefficients")
def l8_coefficients(spark, sf):
    model, _ = _model_preds(spark, sf, "lr", weight_class1=10)
    return spark.createDataFrame(L.coefficient_report(model, FEATURES),
                                 "feature string, coefficient double, direction string")


@register("l9_l16_random_forest")
def l9_l16_random_forest(spark, sf):
    return _model_preds(spark, sf, "rf", weight_class1=10)[1]


@register("l13_l14_model_metrics")
def l13_l14_model_metrics(spark, sf):
    """Confusion matrix, accuracy, precision and AUC of each model's own
    predictions (the SVM's score is its prediction)."""
    out = None
    rows = _model_rows(spark, sf, 0.25)
    for algo in ("rf", "lr", "svc"):
        label = "predictive_overheating"
        preds = _model_preds(spark, sf, algo, rows)[1].where("prediction IS NOT NULL")
        score = "ProbOverheating" if "ProbOverheating" in preds.columns else "prediction"
        # read by the matrix, the metrics and the AUC: rows are scored once
        preds = written_once(preds.select(*dict.fromkeys([label, "prediction", score])), "scored-rows")
        one = L.confusion_matrix(preds, label).withColumn("algo", F.lit(algo)).join(
            L.metrics(preds, label, score).withColumn("algo", F.lit(algo)), "algo")
        out = one if out is None else out.unionByName(one)
    return out


@register("l10_decision_stump")
def l10_decision_stump(spark, sf):
    thr = L.stump_threshold(_features(spark, sf), "engine_rolling", "predictive_overheating")
    return spark.createDataFrame([("engine_rolling", float(thr))], "feature string, threshold double")


_SPLIT_SQL = """WITH x AS (SELECT CAST(value AS DOUBLE) AS v,
    CAST(event_type = 'error' AS INTEGER) AS y FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL),
per AS (SELECT v, count(*) AS n, sum(y) AS ones FROM x GROUP BY v),
cum AS (SELECT v, lead(v) OVER (ORDER BY v) AS after, sum(n) OVER (ORDER BY v) AS n1,
    sum(ones) OVER (ORDER BY v) AS o1, sum(n) OVER () AS n, sum(ones) OVER () AS o FROM per),
g AS (SELECT (v + after) / 2 AS border, n, n1::DOUBLE AS a, (n - n1)::DOUBLE AS b, o1 / n1::DOUBLE AS p,
    (o - o1) / (n - n1)::DOUBLE AS q, o / n::DOUBLE AS r FROM cum WHERE after IS NOT NULL),
best AS (SELECT border, round((n * 2 * r * (1 - r) - a * 2 * p * (1 - p) - b * 2 * q * (1 - q)) / n, 12) AS gain
  FROM g QUALIFY row_number() OVER (ORDER BY gain DESC, border) = 1),
med AS (SELECT avg(m) AS m FROM (SELECT quantile_cont(v, 0.5) AS m FROM x GROUP BY y))
SELECT 'value' AS feature, CASE WHEN gain > 0 THEN border ELSE m END AS threshold,
  CASE WHEN gain > 0 THEN gain ELSE 0.0 END AS gain FROM med LEFT JOIN best ON true"""


@register("l10_exact_split", _SPLIT_SQL)
def l10_exact_split(spark, sf):
    """The border of the event values that best tells error events apart."""
    ev = X.load_table(spark, sf, "events").where("event_type IS NOT NULL")
    return L.exact_split(ev.withColumn("is_error", F.col("event_type") == "error"), "value", "is_error")


@register("l8_optimum", "SELECT unnest([" + ", ".join(f"'{c}'" for c in (*FEATURES, "intercept"))
          + "]) AS feature, TRUE AS at_optimum")
def l8_optimum(spark, sf):
    """The gradient of the loss at the fitted coefficients, below 1e-4 a feature."""
    label = "predictive_overheating"
    data = written_once(L.undersample(_features(spark, sf), label, 0.25)
                        .select("hwid", "when", *FEATURES, label), "l8-rows")
    model, _, _ = L.run_model(data, FEATURES, label, "lr", weight_class1=10)
    train = L.class_weights(L.train_test_split(data.na.drop(subset=[*FEATURES, label]))[0], label, 10)
    fit = model.stages[-1]
    slope = L.logistic_gradient(L.standardised(train, FEATURES, train), FEATURES, label,
                                fit.coefficients, fit.intercept, "weight")
    return slope.select("feature", (F.abs("gradient") < 1e-4).alias("at_optimum"))


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)


def _forest(spark, sf):
    """A fitted forest of 40 trees, its node table and all rows with features."""
    label = "predictive_overheating"
    every = written_once(_features(spark, sf).na.drop(subset=list(FEATURES))
                         .select("hwid", "when", *FEATURES, label), "forest-rows")
    model, _, _ = L.run_model(L.undersample(every, label, 0.25), FEATURES, label, "rf",
                              weight_class1=10, n_trees=40)
    return model, L.forest_nodes(model), every


@register("l9_forest_by_nodes", sql(f"""SELECT hwid, "when", TRUE AS as_model
FROM ({_rolling_sql('heat', ['engine', 'flag_anomaly'], _M10_MIN)}) WHERE {_COMPLETE}""", "heat"))
def l9_forest_by_nodes(spark, sf):
    """All rows scored by joins with the node table, held against the model."""
    from pyspark.ml.functions import vector_to_array
    model, nodes, every = _forest(spark, sf)
    keys = ["hwid", "when"]
    said = L.with_probability(model.transform(every), "said").select(
        *keys, "said", vector_to_array("features").alias("x"))
    found = L.score_by_nodes(said, nodes, "x", model.stages[-1].getMaxDepth(), keys, "found")
    return said.drop("x").join(found, keys, "left").select(
        *keys, F.coalesce(F.abs(F.col("said") - F.col("found")) < 1e-9, F.lit(False)).alias("as_model"))


@register("l17_importance_by_nodes", "SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURES)
          + "]) AS feature, TRUE AS as_model")
def l17_importance_by_nodes(spark, sf):
    """Importances from the gains of the node table, held against the model's."""
    model, nodes, _ = _forest(spark, sf)
    said = spark.createDataFrame(list(zip(FEATURES, map(float, model.stages[-1].featureImportances
                                                        .toArray()))), "feature string, said double")
    found = L.importance_by_nodes(nodes, FEATURES)
    return said.join(found, "feature", "left").select(
        "feature", (F.abs(F.col("said") - F.coalesce("importance", F.lit(0.0))) < 1e-9).alias("as_model"))


@register("l7_moved_weights")
def l7_moved_weights(spark, sf):
    """The SVM's objective as fitted and with each weight moved by 0.05 either
    way; above_fitted is below 0 where the fit stopped short of the optimum, as
    Spark's solver may on this loss, which has kinks."""
    label = "predictive_overheating"
    data = written_once(L.undersample(_features(spark, sf), label, 0.25)
                        .select("hwid", "when", *FEATURES, label), "l7-rows")
    model, _, _ = L.run_model(data, FEATURES, label, "svc", weight_class1=8)
    train = L.class_weights(L.train_test_split(data.na.drop(subset=[*FEATURES, label]))[0], label, 8)
    fit = model.stages[-1]
    at = [*map(float, fit.coefficients), float(fit.intercept)]
    points = [("fitted", at[:-1], at[-1])]
    for i, c in enumerate((*FEATURES, "intercept")):
        for sign, step in (("+", 0.05), ("-", -0.05)):
            to = [*at[:i], at[i] + step, *at[i + 1:]]
            points.append((c + sign, to[:-1], to[-1]))
    got = L.hinge_objective(L.standardised(train, FEATURES, train), FEATURES, label, points,
                            fit.getRegParam(), "weight")
    fitted = got.where("name = 'fitted'").select(F.col("objective").alias("fitted"))  # one row
    return got.where("name <> 'fitted'").join(F.broadcast(fitted)).select(
        F.col("name").alias("moved"), "objective", "fitted",
        (F.col("objective") - F.col("fitted")).alias("above_fitted"))


def _test_part(algo):
    def run(spark, sf):
        data = _model_rows(spark, sf)
        _, test, _ = L.run_model(data, FEATURES, "predictive_overheating", algo)
        return test.select("hwid", "when", "predictive_overheating", "prediction")
    return run


register("l15_run_model_test_part")(_test_part("lr"))
register("l15_run_model_rf")(_test_part("rf"))
register("l15_run_model_svc")(_test_part("svc"))


@register("l17_importance_report")
def l17_importance_report(spark, sf):
    model, _ = _model_preds(spark, sf, "rf")
    rows = L.importance_report(model, FEATURES, 4)
    return spark.createDataFrame(rows, "sensor string, importance_pct double")


_THR = {"n_chars": 5000, "toxic": 0}
_DOC_COLS = ["doc_id", "n_chars", "quality", "toxic"]


def _rules_sql():
    hits = " + ".join(f"COALESCE(CAST(CAST({c} AS DOUBLE) > {float(t)} AS INTEGER), 0)"
                      for c, t in _THR.items())
    return (f"SELECT doc_id, n_chars, quality, toxic, CAST({hits} AS DOUBLE) AS score, "
            f"CASE WHEN {hits} > 0 THEN 1 ELSE 0 END AS prediction FROM {_DOCS_SQL}")


@register("l11_threshold_rules", sql(_rules_sql()))
def l11_threshold_rules(spark, sf):
    return L.threshold_rules(_docs(spark, sf).select(*_DOC_COLS), _THR)


_LS = dict(intercept=-1.0, coefs={"n_chars": 0.8, "toxic": -0.5},
           means={"n_chars": 2000.0, "toxic": 0.1}, stds={"n_chars": 1500.0, "toxic": 0.0})


def _linear_sql():
    e = f"{_LS['intercept']}"
    for c, w in _LS["coefs"].items():
        sd = _LS["stds"][c] if _LS["stds"][c] != 0 else 1e-8
        e = f"({e} + ({w} * (CAST({c} AS DOUBLE) - {_LS['means'][c]})) / {sd})"
    return e


@register("l12_linear_score", sql(f"""SELECT doc_id, n_chars, quality, toxic, {_linear_sql()} AS score,
  1.0 / (1.0 + exp(-{_linear_sql()})) AS score_prob FROM {_DOCS_SQL}"""))
def l12_linear_score(spark, sf):
    return L.linear_score(_docs(spark, sf).select(*_DOC_COLS), **_LS)


@register("l13_confusion_matrix", sql(f"""SELECT
  count(CASE WHEN quality = 0 AND prediction = 0 THEN 1 END) AS tn,
  count(CASE WHEN quality = 0 AND prediction = 1 THEN 1 END) AS fp,
  count(CASE WHEN quality = 1 AND prediction = 0 THEN 1 END) AS fn,
  count(CASE WHEN quality = 1 AND prediction = 1 THEN 1 END) AS tp
FROM ({_rules_sql()})"""))
def l13_confusion_matrix(spark, sf):
    return L.confusion_matrix(L.threshold_rules(_docs(spark, sf), _THR), "quality")


@register("l14_metrics", sql(f"""WITH r AS ({_rules_sql()}),
cm AS (SELECT count(CASE WHEN quality = 0 AND prediction = 0 THEN 1 END) AS tn,
  count(CASE WHEN quality = 0 AND prediction = 1 THEN 1 END) AS fp,
  count(CASE WHEN quality = 1 AND prediction = 0 THEN 1 END) AS fn,
  count(CASE WHEN quality = 1 AND prediction = 1 THEN 1 END) AS tp FROM r),
per AS (SELECT CAST(n_chars AS DOUBLE) AS s, count(CASE WHEN quality = 1 THEN 1 END) AS pos,
  count(CASE WHEN quality = 0 THEN 1 END) AS neg FROM r
  WHERE n_chars IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
c AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS neg_cum FROM per)
SELECT CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) AS accuracy,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0) AS precision,
  (SELECT sum(pos * (CAST(neg_cum - neg AS DOUBLE) + CAST(neg AS DOUBLE) / 2))
          / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) FROM c) AS auc
FROM cm"""))
def l14_metrics(spark, sf):
    return L.metrics(L.threshold_rules(_docs(spark, sf), _THR), "quality", "n_chars")


_SHOW, _MOVE = 4320, 720


def _scored_sql(src="heat"):
    return (f"SELECT *, engine_rolling AS ProbOverheating FROM "
            f"({_rolling_sql(src, ['engine', 'flag_anomaly'], _M10_MIN)})")


@register("l18_probability_trend", sql(f"""SELECT *, avg(AvgProb) OVER (ORDER BY MinToOverheating
  RANGE BETWEEN CURRENT ROW AND {_MOVE} FOLLOWING) AS MovingAvg
FROM (SELECT MinToOverheating, avg(ProbOverheating) AS AvgProb, stddev_samp(ProbOverheating) AS Std,
        count(ProbOverheating) AS N, stddev_samp(ProbOverheating) / pow(count(ProbOverheating), 0.5) AS Err
      FROM ({_scored_sql()}) GROUP BY MinToOverheating)
WHERE MinToOverheating < {_SHOW}""", "heat"))
def l18_probability_trend(spark, sf):
    scored = _features(spark, sf).withColumn("ProbOverheating", F.col("engine_rolling"))
    return L.probability_trend(scored, _SHOW, _MOVE)


@register("l19_block_probability_trend", sql(f"""SELECT * FROM (
  SELECT hwid, BlockHeat, MinToOverheating, ProbOverheating,
    avg(ProbOverheating) OVER (PARTITION BY hwid, BlockHeat ORDER BY MinToOverheating
      RANGE BETWEEN CURRENT ROW AND {_MOVE} FOLLOWING) AS MovingAvg
  FROM ({_scored_sql()})) WHERE MinToOverheating < {_SHOW}""", "heat"))
def l19_block_probability_trend(spark, sf):
    scored = _features(spark, sf).withColumn("ProbOverheating", F.col("engine_rolling"))
    return L.block_probability_trend(scored, _SHOW, _MOVE)


@register("l20_score_separation", sql(f"""SELECT avg(CASE WHEN quality = 0 THEN score END) AS mean_0,
  stddev_samp(CASE WHEN quality = 0 THEN score END) AS std_0,
  avg(CASE WHEN quality = 1 THEN score END) AS mean_1,
  stddev_samp(CASE WHEN quality = 1 THEN score END) AS std_1,
  avg(CAST(CAST(score > 0 AS INTEGER) = quality AS DOUBLE)) AS accuracy_at_0,
  avg(CASE WHEN quality = 1 THEN score END) - avg(CASE WHEN quality = 0 THEN score END) AS mean_diff
FROM (SELECT quality, {_linear_sql()} AS score FROM {_DOCS_SQL})"""))
def l20_score_separation(spark, sf):
    return L.score_separation(L.linear_score(_docs(spark, sf), **_LS), "quality", "score")


@register("l21_random_rows", sql(f"""SELECT hwid, "when", BlockID, flag_anomaly FROM final
ORDER BY {_unit_sql(7)}, hwid, "when" LIMIT 10""", "final"))
def l21_random_rows(spark, sf):
    return L.random_rows(S.final(spark, sf).select("hwid", "when", "BlockID", "flag_anomaly"), 10)


# ---------------------------------------------------- Q: composite chains

from vigil.config import Roles  # noqa: E402
from vigil.plans import composite as Q  # noqa: E402

ROLES = Roles(sensors=S.SENSORS, alarms=S.ALARMS, engines=S.ENGINES)


@register("q1_prepare", sql(f"SELECT {BLOCK_SELECT} FROM p_blocks", "p_blocks"))
def q1_prepare(spark, sf):
    """Pivot, scale, grid, blocks, fill, drop of the constant sensor."""
    return _grid_out(S.prepared(spark, sf))


def _report(spark, sf):
    return Q.anomaly_report(S.prepared(spark, sf), ROLES, S.EVENTS)


@register("q2_anomaly_report", sql(_pair_sql("p_final", list(S.SENSORS), "flag_anomaly"), "p_final"))
def q2_anomaly_report(spark, sf):
    return _report(spark, sf)[1]


@register("q2_overheating_ranking", sql(_pair_sql("p_final", list(S.SENSORS), "overheating"),
                                        "p_final"))
def q2_overheating_ranking(spark, sf):
    """The ranking that picks the features of the model."""
    rows = M.attach_overheating(_report(spark, sf)[0])
    return C.pairwise_correlation(rows, list(S.SENSORS), "overheating")


def _maintenance_rows(spark, sf):
    return Q.maintenance_frame(_report(spark, sf)[0], ROLES, S.EVENTS,
                               features=["engine", "flag_anomaly"])


@register("q3_maintenance_report", sql(f"""SELECT *, avg(AvgProb) OVER (ORDER BY MinToOverheating
  RANGE BETWEEN CURRENT ROW AND {_MOVE} FOLLOWING) AS MovingAvg
FROM (SELECT MinToOverheating, avg(ProbOverheating) AS AvgProb, stddev_samp(ProbOverheating) AS Std,
        count(ProbOverheating) AS N, stddev_samp(ProbOverheating) / pow(count(ProbOverheating), 0.5) AS Err
      FROM ({_scored_sql('p_heat')}) GROUP BY MinToOverheating)
WHERE MinToOverheating < {_SHOW}""", "p_heat"))
def q3_maintenance_report(spark, sf):
    return Q.maintenance_report(_maintenance_rows(spark, sf), FEATURES, _SHOW, _MOVE,
                                score="engine_rolling")


@register("q3_maintenance_model")
def q3_maintenance_model(spark, sf):
    return Q.maintenance_report(_maintenance_rows(spark, sf), FEATURES, _SHOW, _MOVE, model="rf")


# ----------------------------------------------------- W: window blocks

from vigil.operators import windows as W  # noqa: E402

_DEV = ["hwid"]


@register("w1_lag_lead", sql(f"""SELECT hwid, "when", engine,
  lag(engine) OVER ({S._W_DEV}) AS prev_engine, lead(engine) OVER ({S._W_DEV}) AS next_engine,
  lag(engine, 1, -1.0) OVER ({S._W_DEV}) AS prev_engine_d, lead(engine, 1, -1.0) OVER ({S._W_DEV}) AS next_engine_d
FROM grid""", "grid"))
def w1_lag_lead(spark, sf):
    p, n = W.lag_lead("engine", _DEV)
    pd_, nd = W.lag_lead("engine", _DEV, default=-1.0)
    return S.grid(spark, sf).select("hwid", "when", "engine", p.alias("prev_engine"),
                                    n.alias("next_engine"), pd_.alias("prev_engine_d"),
                                    nd.alias("next_engine_d"))


@register("w2_w3_running_and_group_count", sql(f"""SELECT hwid, "when", engine,
  sum(engine) OVER ({S._W_DEV} {S._RUN}) AS running_engine,
  count(*) OVER (PARTITION BY hwid) AS device_rows FROM grid""", "grid"))
def w2_w3_running_and_group_count(spark, sf):
    return S.grid(spark, sf).select("hwid", "when", "engine",
                                    W.running_sum("engine", _DEV).alias("running_engine"),
                                    W.group_count(_DEV).alias("device_rows"))


_D = 86400


@register("w4_range_frames", sql(f"""SELECT hwid, "when", engine,
  count(CASE WHEN engine = 0 THEN 1 END) OVER ({S._W_DEV} RANGE BETWEEN 1 FOLLOWING AND {_D} FOLLOWING) AS zeros_ahead,
  COALESCE(bool_or(engine = 1) OVER ({S._W_DEV} RANGE BETWEEN {_D} PRECEDING AND 1 PRECEDING), FALSE) AS on_before,
  max(view) OVER ({S._W_DEV} RANGE BETWEEN {_D} PRECEDING AND {_D} FOLLOWING) AS max_view_2d,
  min(view) OVER ({S._W_DEV} RANGE BETWEEN {_D} PRECEDING AND {_D} FOLLOWING) AS min_view_2d
FROM grid""", "grid"))
def w4_range_frames(spark, sf):
    g = S.grid(spark, sf)
    return g.select("hwid", "when", "engine",
                    F.count_if(F.col("engine") == 0).over(W.range_frame(_DEV, 1, _D)).alias("zeros_ahead"),
                    F.coalesce(F.bool_or(F.col("engine") == 1).over(W.range_frame(_DEV, -_D, -1)),
                               F.lit(False)).alias("on_before"),
                    F.max("view").over(W.range_frame(_DEV, -_D, _D)).alias("max_view_2d"),
                    F.min("view").over(W.range_frame(_DEV, -_D, _D)).alias("min_view_2d"))


@register("w5_w11_row_frames", sql(f"""SELECT hwid, "when", engine,
  sum(engine) OVER ({S._W_DEV} ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS sum_0_1,
  sum(engine) OVER ({S._W_DEV} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS sum_m1_1,
  count(engine) OVER ({S._W_DEV} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS count_m1_1,
  sum(engine) OVER ({S._W_DEV} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sum_last5
FROM grid""", "grid"))
def w5_w11_row_frames(spark, sf):
    return S.grid(spark, sf).select(
        "hwid", "when", "engine",
        F.sum("engine").over(W.rows_frame(_DEV, 0, 1)).alias("sum_0_1"),
        F.sum("engine").over(W.rows_frame(_DEV, -1, 1)).alias("sum_m1_1"),
        F.count("engine").over(W.rows_frame(_DEV, -1, 1)).alias("count_m1_1"),
        F.sum("engine").over(W.rows_frame(_DEV, -4, 0)).alias("sum_last5"))


@register("w6_w7_non_null_neighbours", sql(f"""SELECT hwid, "when", view,
  first(view IGNORE NULLS) OVER ({S._W_DEV} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_view,
  last(view IGNORE NULLS) OVER ({S._W_DEV} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_view
FROM grid""", "grid"))
def w6_w7_non_null_neighbours(spark, sf):
    return S.grid(spark, sf).select("hwid", "when", "view",
                                    W.next_non_null("view", _DEV).alias("next_view"),
                                    W.last_non_null("view", _DEV).alias("last_view"))


@register("w8_w9_rolling", sql(f"""SELECT hwid, "when", engine,
  avg(engine) OVER ({S._W_DEV} RANGE BETWEEN {_D} PRECEDING AND CURRENT ROW) AS engine_mean_1d,
  sum(engine) OVER ({S._W_DEV} RANGE BETWEEN {_D} PRECEDING AND CURRENT ROW) AS engine_sum_1d
FROM grid""", "grid"))
def w8_w9_rolling(spark, sf):
    return S.grid(spark, sf).select("hwid", "when", "engine",
                                    W.rolling_mean("engine", _DEV, _D).alias("engine_mean_1d"),
                                    W.rolling_sum("engine", _DEV, _D).alias("engine_sum_1d"))


@register("w10_w12_positions", sql(f"""SELECT hwid, "when",
  CAST(row_number() OVER ({S._W_DEV}) - 1 AS INTEGER) AS pos_in_device,
  CAST(row_number() OVER (PARTITION BY hwid ORDER BY view DESC NULLS LAST, "when") AS INTEGER) AS view_rank
FROM grid""", "grid"))
def w10_w12_positions(spark, sf):
    return S.grid(spark, sf).select(
        "hwid", "when", W.position(_DEV, ["when"], start=0).alias("pos_in_device"),
        W.position(_DEV, [F.col("view").desc_nulls_last(), "when"]).alias("view_rank"))


@register("x1_read_readings_csv", sql("""SELECT CAST(round(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) / 1000) AS BIGINT) AS "when",
  CAST(user_id AS VARCHAR) AS hwid, metric, value FROM (
  SELECT ts, user_id, event_type AS metric, value FROM events WHERE value IS NOT NULL
  UNION ALL SELECT ts, user_id, 'engine', CAST(CAST(value > 50 AS INTEGER) AS DOUBLE) FROM events WHERE value IS NOT NULL
  UNION ALL SELECT ts, user_id, 'A5', CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS DOUBLE) FROM events
    WHERE event_type = 'error' AND json_extract(props, '$.k') IS NOT NULL
  UNION ALL SELECT ts, user_id, 'A9', CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS DOUBLE) FROM events
    WHERE event_type = 'purchase' AND json_extract(props, '$.k') IS NOT NULL)"""))
def x1_read_readings_csv(spark, sf):
    # write the readings as the raw CSV form (epoch ms, header), then read it
    # back with the explicit schema and the ms -> s rounding
    ev = X.load_table(spark, sf, "events")
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    # same rows as the stand-in readings, with the time kept in ms
    k = F.get_json_object("props", "$.k").cast("int").cast("double")
    base = ev.select(ms.alias("when"), F.col("user_id").cast("string").alias("hwid"),
                     "event_type", "value", k.alias("k"))
    long = base.select("when", "hwid", F.expr(
        "stack(4, event_type, value, 'engine', CAST(CAST(value > 50 AS INT) AS DOUBLE),"
        " 'A5', CASE WHEN event_type = 'error' THEN k END,"
        " 'A9', CASE WHEN event_type = 'purchase' THEN k END) AS (metric, value)")) \
        .where(F.col("value").isNotNull())
    path = scratch_path(spark, "readings-csv")
    long.write.option("header", True).csv(path)
    return X.read_readings(spark, path)


@register("x1_read_readings_quarantine", """SELECT count(*) AS lines,
  count(CASE WHEN ok THEN 1 END) AS "read", count(CASE WHEN NOT ok THEN 1 END) AS rejected,
  count(DISTINCT CASE WHEN ok THEN user_id END) AS devices
FROM (SELECT user_id, value IS NOT NULL AND event_type <> 'signup' AS ok FROM events)""")
def x1_read_readings_quarantine(spark, sf):
    # a line per event; those without a value say so in words, and signups
    # have a field too many
    ev = X.load_table(spark, sf, "events")
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    rows = ev.select("event_type", ms.alias("when"), F.col("user_id").alias("hwid"),
                     F.col("event_type").alias("metric"),
                     F.coalesce(F.col("value").cast("string"), F.lit("missing")).alias("value"))
    signup = F.col("event_type") == "signup"
    path = [scratch_path(spark, "readings-lines"), scratch_path(spark, "readings-lines")]
    rows.where(~signup).drop("event_type").write.option("header", True).csv(path[0])
    rows.where(signup).drop("event_type").withColumn("via", F.lit("web")) \
        .write.option("header", True).csv(path[1])
    good, counts = X.read_readings_checked(spark, path, scratch_path(spark, "quarantine"))
    devices = good.agg(F.count_distinct("hwid").alias("devices"))
    return counts.join(F.broadcast(devices))  # one row each


@register("n3_forward_fill_raw_sliced", sql(f"""SELECT hwid, "when", {', '.join(
    f'last({c} IGNORE NULLS) OVER ({S._W_DEV} {S._RUN}) AS {c}' for c in S.SENSORS)} FROM wide""", "wide"))
def n3_forward_fill_raw_sliced(spark, sf):
    # the raw pivoted readings (rows per device grow with the data): weekly slices
    w = S.wide(spark, sf).select("hwid", "when", *S.SENSORS)
    return N.forward_fill(w, S.SENSORS, split_seconds=S.EVENTS.split_seconds)


@register("p8_drop_columns", sql("""SELECT hwid, "when", BlockID, A5, A9, click, engine, error, purchase,
  signup, view, PrevDiff, NextDiff FROM blocks""", "blocks"))
def p8_drop_columns(spark, sf):
    return S.blocks(spark, sf).drop("Prev_TimeStamp", "Next_TimeStamp", "window_start", "window_end")


@register("p6_coalesce_flag", sql("""SELECT hwid, "when", COALESCE(A5, 0) AS A5, COALESCE(A9, 0) AS A9 FROM grid""",
                                  "grid"))
def p6_coalesce_flag(spark, sf):
    g = S.grid(spark, sf)
    return g.select("hwid", "when", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in S.ALARMS])
