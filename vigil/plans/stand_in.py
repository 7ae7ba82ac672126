"""The chain on the driver's test tables, as Spark frames and as SQL.

``events`` stands in for the long readings (see sources/readings.py).  The
time settings are larger than the reference's one-minute ones because the
test events of a device are hours apart (FIXTURES.md §3): grid 6 h, fill gap
12 h, block gap 24 h, switch separator 2 days, look-ahead 1 day.

Each Spark base frame has a SQL twin (a CTE) written for DuckDB; a query's
oracle is the CTEs it needs plus its own final SELECT.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import Roles, Settings
from vigil.operators.alarms import attach_overheating, add_predictive
from vigil.operators.anomaly import detect_anomalies
from vigil.operators.blocks import build_blocks, event_blocks
from vigil.operators.grid import create_grid, pivot_metrics
from vigil.plans.composite import prepare
from vigil.sources.readings import EVENT_METRICS, events_as_readings, load_table

# Fixed parameters of the stand-in chain.
EVENTS = Settings(
    grid_interval=6 * 3600,
    block_gap=24 * 3600,
    fill_gap=12 * 3600,
    switch_separator=2 * 24 * 3600,
    switch_threshold=8,
    lookahead_minutes=24 * 60,
    min_heat_block=2,
    rolling_minutes=24 * 60,
    split_seconds=7 * 24 * 3600,
)
SENSORS = ("click", "error", "purchase", "signup", "view")
ALARMS = ("A5", "A9")
ENGINES = ("engine",)
GRID_COLS = ("A5", "A9", "click", "engine", "error", "purchase", "signup", "view")


# ---------------------------------------------------------------- Spark side
#
# The base frames are lazy plans shared by many queries.  They are memoized
# per (session, tables folder) so each plan is built and analyzed once per
# process.  ``prepared`` also writes its grid and its filled rows to the scratch
# folder while it is built, once; later queries of the process read these files.

_FRAMES: dict = {}

# Events to a task where rows are dealt out for a chain of windows, whose sorts
# hold several copies of a task's rows.
EVENTS_PER_TASK = 50_000


def _memo(fn):
    def wrapper(spark: SparkSession, sf: str, *args, **kw):
        key = (fn.__name__, spark.sparkContext.applicationId, id(spark._jsparkSession), spark.conf.get("spark.sql.session.timeZone"),
               spark.conf.get("spark.sql.ansi.enabled", "true"), sf,
               args, tuple(sorted(kw.items())))
        df = _FRAMES.get(key)
        if df is None:
            df = _FRAMES[key] = fn(spark, sf, *args, **kw)
        return df
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


@_memo
def readings(spark: SparkSession, sf: str) -> DataFrame:
    return events_as_readings(load_table(spark, sf, "events"))


def device_tasks(spark: SparkSession, sf: str) -> int:
    """Tasks for the rows of all devices: one a core, more of them for many events
    (counted from the files' footers).  A number given to ``repartition`` is kept,
    where small partitions would be put together by their compressed size, which
    says little about rows as alike as these."""
    n = load_table(spark, sf, "events").count()
    return max(spark.sparkContext.defaultParallelism, -(-n // EVENTS_PER_TASK))


@_memo
def wide(spark: SparkSession, sf: str) -> DataFrame:
    w = pivot_metrics(readings(spark, sf), EVENT_METRICS)
    return w.withColumns({a: F.col(a).cast("int") for a in ALARMS})


@_memo
def grid(spark: SparkSession, sf: str, binary=ENGINES) -> DataFrame:
    return create_grid(wide(spark, sf), EVENTS.grid_interval, alarms=ALARMS, binary=binary,
                       metrics=GRID_COLS)


@_memo
def blocks(spark: SparkSession, sf: str) -> DataFrame:
    # Grid rows per device are bounded by (time span / interval), so the
    # one-level device window is used here; the sliced form is for series
    # whose rows per device grow with the data (raw readings).
    # All later windows keep to the device, so they stay in the tasks dealt here.
    dealt = grid(spark, sf).repartition(device_tasks(spark, sf), "hwid")
    return build_blocks(dealt, EVENTS.block_gap)


@_memo
def anomalies(spark: SparkSession, sf: str, debug: bool = False) -> DataFrame:
    return detect_anomalies(blocks(spark, sf), EVENTS.switch_separator,
                            EVENTS.switch_threshold, ENGINES, debug=debug)


@_memo
def final(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks with the joint anomaly flag and the overheating flag."""
    a = detect_anomalies(blocks(spark, sf), EVENTS.switch_separator, EVENTS.switch_threshold,
                         ENGINES, keep_input=True)
    return attach_overheating(a)


@_memo
def predicted(spark: SparkSession, sf: str) -> DataFrame:
    return add_predictive(final(spark, sf), "overheating", EVENTS.lookahead_minutes)


@_memo
def heat(spark: SparkSession, sf: str) -> DataFrame:
    return event_blocks(predicted(spark, sf), "overheating", EVENTS.min_heat_block,
                        order=("BlockID", "when"))


# The end-to-end chain (Q1-Q3) runs on prepared rows: a constant sensor is added
# to the readings and has to be found and dropped again, one sensor is scaled, and
# rows are filled and kept by the engine and the densest sensor.

PREPARED_FILL = ("engine", "view")
DECIMALS = {"view": 1}


def prepared_readings(spark: SparkSession, sf: str) -> DataFrame:
    r = readings(spark, sf)
    ones = r.where("metric = 'engine'").select("hwid", "when", F.lit("status").alias("metric"),
                                               F.lit(1.0).alias("value"))
    return r.unionByName(ones)


@_memo
def prepared(spark: SparkSession, sf: str) -> DataFrame:
    roles = Roles(sensors=(*SENSORS, "status"), alarms=ALARMS, engines=ENGINES)
    return prepare(prepared_readings(spark, sf), roles, EVENTS, decimals=DECIMALS, binary=ENGINES,
                   fill_cols=PREPARED_FILL)


# ------------------------------------------------------------------ SQL side

G, HALF, GAP, FILL, SEP, TH = (EVENTS.grid_interval, EVENTS.grid_interval // 2,
                               EVENTS.block_gap, EVENTS.fill_gap,
                               EVENTS.switch_separator, EVENTS.switch_threshold)
LOOK = EVENTS.lookahead_minutes * 60

_W_DEV = 'PARTITION BY hwid ORDER BY "when"'
_W_BLK = 'PARTITION BY hwid, BlockID ORDER BY "when"'
_W_HEAT = 'PARTITION BY hwid, BlockHeat ORDER BY "when"'
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _avg2(c):
    return f"sign(avg({c})) * floor(abs(avg({c})) * 100 + 0.5) / 100 AS {c}"


def _bits(word, bits=(6, 7, 8)):
    return " OR ".join(f"({word} & {1 << (b - 1)}) > 0" for b in bits)


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name, body, deps=()):
    CTES[name] = (body, tuple(deps))


_cte("ev", """SELECT event_id, user_id AS hwid, CAST(floor(epoch(ts)) AS BIGINT) AS "when",
       ts, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""")
_cte("readings", """SELECT hwid, "when", event_type AS metric, value FROM ev WHERE value IS NOT NULL
UNION ALL SELECT hwid, "when", 'engine', CAST(CAST(value > 50 AS INTEGER) AS DOUBLE)
  FROM ev WHERE value IS NOT NULL
UNION ALL SELECT hwid, "when", 'A5', CAST(k AS DOUBLE) FROM ev WHERE event_type = 'error' AND k IS NOT NULL
UNION ALL SELECT hwid, "when", 'A9', CAST(k AS DOUBLE) FROM ev WHERE event_type = 'purchase' AND k IS NOT NULL""",
     ["ev"])
_cte("wide", "SELECT hwid, \"when\",\n" + ",\n".join(
    [f"  CAST(max(CASE WHEN metric = '{a}' THEN value END) AS INTEGER) AS {a}" for a in ALARMS]
    + [f"  max(CASE WHEN metric = '{m}' THEN value END) AS {m}"
       for m in ("click", "engine", "error", "purchase", "signup", "view")])
     + "\nFROM readings GROUP BY hwid, \"when\"", ["readings"])
_cte("grid0", f"""SELECT hwid, CAST(floor("when" / {G}) AS BIGINT) * {G} AS ws,
  max(A5) AS A5, max(A9) AS A9, {_avg2('click')}, max(engine) AS engine, {_avg2('error')},
  {_avg2('purchase')}, {_avg2('signup')}, {_avg2('view')}
FROM wide GROUP BY hwid, ws""", ["wide"])
_cte("grid", f"""SELECT hwid, ws + {HALF} AS "when", ws AS window_start, ws + {G} AS window_end,
  A5, A9, click, engine, error, purchase, signup, view FROM grid0""", ["grid0"])
_cte("blocks0", f"""SELECT *, lag("when") OVER ({_W_DEV}) AS Prev_TimeStamp,
  lead("when") OVER ({_W_DEV}) AS Next_TimeStamp FROM grid""", ["grid"])
_cte("blocks", f"""SELECT *, "when" - Prev_TimeStamp AS PrevDiff, Next_TimeStamp - "when" AS NextDiff,
  CAST(sum(CASE WHEN "when" - Prev_TimeStamp > {GAP} THEN 1 ELSE 0 END)
       OVER ({_W_DEV} {_RUN}) AS BIGINT) AS BlockID
FROM blocks0""", ["blocks0"])
_cte("an1", f"""SELECT *,
  CASE WHEN lag(engine) OVER ({_W_BLK}) <> engine THEN 1 ELSE 0 END AS didSwitch_engine,
  count(CASE WHEN engine = 0 THEN 1 END) OVER ({_W_BLK} RANGE BETWEEN 1 FOLLOWING AND {SEP} FOLLOWING) AS z_ahead,
  count(CASE WHEN engine = 0 THEN 1 END) OVER ({_W_BLK} RANGE BETWEEN {SEP} PRECEDING AND 1 PRECEDING) AS z_behind
FROM blocks""", ["blocks"])
_cte("an2", """SELECT *, COALESCE(didSwitch_engine = 1
  AND (CASE WHEN engine = 1 THEN z_ahead > 0 ELSE TRUE END)
  AND (CASE WHEN engine = 0 THEN z_behind > 0 ELSE TRUE END), FALSE) AS qualified_engine
FROM an1""", ["an1"])
_cte("an3", f"""SELECT *, CASE WHEN qualified_engine THEN
  CASE WHEN pq IS NULL OR "when" - pq > {SEP} THEN 1 ELSE 0 END END AS startGroup_engine
FROM (SELECT *, last(CASE WHEN qualified_engine THEN "when" END IGNORE NULLS)
        OVER ({_W_BLK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pq FROM an2)""",
     ["an2"])
_cte("an4", f"""SELECT *, CASE WHEN qualified_engine THEN CAST(sum(COALESCE(startGroup_engine, 0))
  OVER ({_W_BLK} {_RUN}) AS BIGINT) END AS switchID_engine FROM an3""", ["an3"])
_cte("an5", f"""SELECT *, count(*) OVER (PARTITION BY hwid, BlockID, switchID_engine) AS count_engine,
  COALESCE(count(*) OVER (PARTITION BY hwid, BlockID, switchID_engine) >= {TH}
           AND switchID_engine > 0, FALSE) AS flag0_engine FROM an4""", ["an4"])
_cte("an6", f"""SELECT *,
  CASE WHEN bool_or(flag0_engine) OVER ({_W_BLK} RANGE BETWEEN {SEP} PRECEDING AND CURRENT ROW)
       THEN max(switchID_engine) OVER ({_W_BLK} RANGE BETWEEN {SEP} PRECEDING AND CURRENT ROW) END AS prevID_engine,
  CASE WHEN bool_or(flag0_engine) OVER ({_W_BLK} RANGE BETWEEN CURRENT ROW AND {SEP} FOLLOWING)
       THEN min(switchID_engine) OVER ({_W_BLK} RANGE BETWEEN CURRENT ROW AND {SEP} FOLLOWING) END AS nextID_engine
FROM an5""", ["an5"])
_cte("anomalies", """SELECT *, CASE WHEN flag_engine THEN 1 ELSE 0 END AS flag_anomaly FROM (
  SELECT *, CASE WHEN nextID_engine = prevID_engine AND nextID_engine > 0 THEN TRUE
                 ELSE flag0_engine END AS flag_engine FROM an6)""", ["an6"])
_cte("final", f"""SELECT hwid, "when", window_start, window_end, A5, A9, click, engine, error,
  purchase, signup, view, Prev_TimeStamp, Next_TimeStamp, PrevDiff, NextDiff, BlockID,
  flag_engine, flag_anomaly,
  CASE WHEN (A5 IS NOT NULL OR A9 IS NOT NULL) AND ({_bits('A5')} OR {_bits('A9')})
       THEN 1 ELSE 0 END AS overheating
FROM anomalies""", ["anomalies"])
_cte("pred1", f"""SELECT *, CASE WHEN overheating = 1 AND (lag(overheating) OVER ({_W_BLK}) <> 1
    OR lag(overheating) OVER ({_W_BLK}) IS NULL) THEN 1 ELSE 0 END AS is_start
FROM final""", ["final"])
_cte("predicted", f"""SELECT * EXCLUDE (is_start, next_start),
  CASE WHEN next_start IS NOT NULL AND (overheating IS NULL OR overheating = 0)
        AND next_start - "when" > 0 AND next_start - "when" <= {LOOK} THEN 1 ELSE 0 END
    AS predictive_overheating
FROM (SELECT *, first(CASE WHEN is_start = 1 THEN "when" END IGNORE NULLS)
        OVER ({_W_BLK} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_start FROM pred1)""",
     ["pred1"])
_cte("heat1", f"""SELECT *, CAST(sum(nbf) OVER ({_W_DEV} {_RUN}) AS BIGINT) + 1 AS oldBlockHeat
FROM (SELECT *, CASE WHEN lag(overheating) OVER ({_W_DEV}) = 1 THEN 1 ELSE 0 END AS nbf
      FROM predicted)""", ["predicted"])
_cte("heatkeep", f"""SELECT hwid, oldBlockHeat, TimeOverheating,
  CAST(row_number() OVER (PARTITION BY hwid ORDER BY oldBlockHeat) AS BIGINT) AS BlockHeat
FROM (SELECT *, oldBlockHeat = max(oldBlockHeat) OVER (PARTITION BY hwid) AS is_last
      FROM (SELECT hwid, oldBlockHeat, count(*) AS n, max("when") AS TimeOverheating,
                   arg_max_null(overheating, "when") AS last_event
            FROM heat1 GROUP BY hwid, oldBlockHeat))
WHERE NOT (is_last AND NOT COALESCE(last_event = 1, FALSE)) AND n >= {EVENTS.min_heat_block}""",
     ["heat1"])
_cte("heat", """SELECT h.* EXCLUDE (nbf, oldBlockHeat), k.BlockHeat,
  CAST(k.TimeOverheating - h."when" AS DOUBLE) / 60 AS MinToOverheating
FROM heat1 h JOIN heatkeep k ON h.hwid = k.hwid AND h.oldBlockHeat = k.oldBlockHeat""",
     ["heat1", "heatkeep"])


def fill_case(c, nxt, prv):
    """N1 for one column."""
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN NextDiff <= {FILL} AND NextDiff <= PrevDiff "
            f"THEN {nxt} WHEN PrevDiff <= {FILL} THEN {prv} END AS {c}")


# The same chain on prepared rows: every name from the wide table on gets the
# prefix ``p_``; the wide table is scaled, and the blocks are filled.
_CHAIN = list(CTES)[list(CTES).index("wide"):]


for _name in _CHAIN:
    _body, _deps = CTES[_name]
    if _name == "wide":
        _cte("p_wide", "SELECT * REPLACE (" + ", ".join(
            f"{c} / {float(10 ** d)} AS {c}" for c, d in DECIMALS.items()) + ") FROM wide", ["wide"])
        continue
    _body = re.sub(rf"\b(FROM|JOIN) ({'|'.join(_CHAIN)})\b", r"\1 p_\2", _body)
    _deps = [f"p_{d}" for d in _deps]
    if _name == "blocks":
        _cte("p_blocks_raw", _body, _deps)
        _filled = ", ".join(fill_case(c, f"lead({c}) OVER ({_W_BLK})", f"lag({c}) OVER ({_W_BLK})")
                            for c in PREPARED_FILL)
        _cte("p_blocks", f"""SELECT * FROM (SELECT * REPLACE ({_filled}) FROM p_blocks_raw)
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in PREPARED_FILL)}""", ["p_blocks_raw"])
    else:
        _cte(f"p_{_name}", _body, _deps)


def sql(select: str, *needed: str) -> str:
    """WITH clause holding the needed CTEs (and what they depend on, in
    dependency order) followed by ``select``."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return select
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    head = select.lstrip()
    if head[:5].upper() == "WITH ":
        # the query's own CTEs follow the shared ones
        return "WITH " + ",\n".join(parts) + ",\n" + head[5:]
    return "WITH " + ",\n".join(parts) + "\n" + select
