"""Composite chains (Q1-Q3): the reference's chain end to end.

Each returns lazy DataFrames; only the constant-column test reads one row
of column statistics on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import Roles, Settings
from vigil.functions.scalar import scale_decimals
from vigil.operators.aggregates import constant_columns
from vigil.operators.alarms import add_predictive, add_rolling_features, attach_overheating
from vigil.operators.anomaly import detect_anomalies
from vigil.operators.blocks import build_blocks, event_blocks
from vigil.operators.correlation import pairwise_correlation
from vigil.operators.grid import binary_metrics, create_grid, pivot_metrics
from vigil.operators.learn import probability_trend, run_model, undersample
from vigil.operators.nulls import fill_nearest, fill_nearest_sliced
from vigil.session import cut_lineage
from vigil.sources.layout import SLICE, write_laid_out


def prepare(readings: DataFrame, roles: Roles, settings: Settings,
            decimals: dict | None = None, binary=None, fill_cols=None,
            drop_constant: bool = True, slice_blocks: bool = True,
            materialize_grid: bool = True) -> DataFrame:
    """Q1: readings -> pivot -> scale -> grid -> blocks -> nearest fill ->
    drop constant sensors.

    Shuffles: one for the pivot (partial aggregation before it), one for the
    grid (partial aggregation before it), one for the blocks (by device and
    time slice) and one for the fill (by device and block).  The grid is
    written once to the shared checkpoint folder: the raw -> grid part is the
    expensive one, and the sliced block builder reads its input twice.  So
    are the filled rows where constant sensors are dropped: the test and the
    result read the written rows, nothing is computed twice.
    Without ``slice_blocks`` and ``materialize_grid`` the blocks are one
    window per device over the lazy grid, for small fleets and short spans."""
    metrics = list(roles.all_metrics)
    if binary is None:
        # decided on the long readings: one small aggregate, no second pivot
        binary = binary_metrics(readings, [m for m in metrics if m not in roles.alarms])
    wide = pivot_metrics(readings, metrics)
    wide = wide.withColumns({a: F.col(a).cast("int") for a in roles.alarms})
    if decimals:
        wide = scale_decimals(wide, decimals)
    grid = create_grid(wide, settings.grid_interval, alarms=roles.alarms, binary=binary,
                       metrics=metrics)
    if materialize_grid:
        grid = cut_lineage(grid)
    blocks = build_blocks(grid, settings.block_gap,
                          split_seconds=settings.split_seconds if slice_blocks else None)
    fill_cols = list(fill_cols) if fill_cols is not None else [*roles.sensors, *roles.engines]
    filled = fill_nearest(blocks, fill_cols, settings.fill_gap)
    if not drop_constant:
        return filled
    filled = cut_lineage(filled)
    const = constant_columns(filled, roles.sensors).where("is_constant").select("sensor")
    useless = [r["sensor"] for r in const.collect()]  # at most one row per sensor
    return filled.drop(*useless)


def prepare_laid_out(readings: DataFrame, roles: Roles, settings: Settings, name: str, path: str,
                     buckets: int, binary, fill_cols) -> DataFrame:
    """Pivot, grid, blocks and nearest fill on laid-out tables (X5): the readings
    are dealt out by device and time slice once, as table ``name``, and the grid
    is kept as table ``name_grid`` with the same buckets.  From then on only
    summaries of slices are exchanged (one row per device and slice, or per
    device, block and slice); the rows stay in their buckets.

    The grid interval has to divide ``settings.split_seconds``, so that no window
    lies in two slices."""
    if settings.split_seconds % settings.grid_interval:
        raise ValueError("a time slice must hold whole grid windows")
    metrics = list(roles.all_metrics)
    rows = write_laid_out(readings, name, path, settings.split_seconds, buckets)
    wide = pivot_metrics(rows, metrics, by=[SLICE])
    wide = wide.withColumns({a: F.col(a).cast("int") for a in roles.alarms})
    grid = create_grid(wide, settings.grid_interval, alarms=roles.alarms, binary=binary,
                       metrics=metrics, by=[SLICE])
    grid = write_laid_out(grid, f"{name}_grid", f"{path}_grid", settings.split_seconds, buckets)
    blocks = build_blocks(grid, settings.block_gap, slice_col=SLICE)
    return fill_nearest_sliced(blocks, fill_cols, settings.fill_gap, slice_col=SLICE).drop(SLICE)


def anomaly_report(blocks: DataFrame, roles: Roles, settings: Settings,
                   spread_blocks: bool = True):
    """Q2: anomalies on the blocks, the joint flag attached, and the
    sensors ranked by correlation with it.  Returns (rows, ranking).

    Blocks come out of the block builder partitioned by device only, which
    would leave the whole per-block chain to one task per device (a fleet of
    a few devices gets a few tasks).  ``spread_blocks`` repartitions by
    (device, block) first: one exchange of grid-level rows, then the chain
    runs over as many tasks as there are blocks to spread."""
    if spread_blocks:
        blocks = blocks.repartition(roles.device_col, "BlockID")
    rows = detect_anomalies(blocks, settings.switch_separator, settings.switch_threshold,
                            roles.engines, keep_input=True)
    ranking = pairwise_correlation(rows, list(roles.sensors), "flag_anomaly")
    return rows, ranking


def maintenance_frame(rows: DataFrame, roles: Roles, settings: Settings,
                      features=None) -> DataFrame:
    """Q3 (data part): overheating flag, look-ahead label, event blocks and
    rolling features.  The labelled rows are written once, as the sliced event
    blocks read them twice; no task holds a whole device."""
    x = attach_overheating(rows)
    x = add_predictive(x, "overheating", settings.lookahead_minutes)
    x = event_blocks(cut_lineage(x), "overheating", settings.min_heat_block,
                     split_seconds=settings.split_seconds)
    features = list(features) if features is not None else list(roles.engines)
    return add_rolling_features(x, features, settings.rolling_minutes)


def maintenance_report(frame: DataFrame, features, show: float, moving: float,
                       score: str | None = None, model: str | None = "rf",
                       **model_kw) -> DataFrame:
    """Q3 (report part): the mean probability trend before an event.

    With ``score`` the trend is taken of that column; otherwise a classifier
    (``model``) is fit on the undersampled frame and its class-1 probability
    is used."""
    if score is not None:
        return probability_trend(frame.withColumn("ProbOverheating", F.col(score)), show, moving)
    data = undersample(frame, "predictive_overheating")
    _, _, preds = run_model(data, features, "predictive_overheating", model, **model_kw)
    return probability_trend(preds, show, moving)
