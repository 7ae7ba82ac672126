"""Laid-out tables and the fill by time slices, against the plain forms."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vigil.operators.blocks import build_blocks
from vigil.operators.grid import create_grid, pivot_metrics
from vigil.operators.nulls import fill_nearest, fill_nearest_nonnull, fill_nearest_sliced
from vigil.session import scratch_path
from vigil.sources.layout import SLICE, open_laid_out, write_laid_out


def series(seed, n=400):
    rnd, rows = random.Random(seed), []
    for device, many in ((1, n), (2, n // 10), (3, 1)):
        t = rnd.randrange(100)
        for _ in range(many):
            t += rnd.choice([1, 3, 10, 40, 41, 90, 400])
            rows.append((device, t, *[rnd.choice([None, None, rnd.random()]) for _ in range(2)], t % 7))
    return rows


SCHEMA = "hwid long, when long, a double, b double, __in long"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("width", [5, 60, 700, 10**7])
def test_sliced_fill_equals_plain(spark, width):
    df = build_blocks(spark.createDataFrame(series(width), SCHEMA.replace("__in", "extra")), 90)
    plain = fill_nearest(df, ["a", "b"], 40)
    assert rows_of(fill_nearest_sliced(df, ["a", "b"], 40, width)) == rows_of(plain)
    assert 0 < plain.count() < df.count()
    plain = fill_nearest_nonnull(df, ["a", "b"], 40)
    sliced = fill_nearest_sliced(df, ["a", "b"], 40, width, nonnull=True)
    assert sliced.columns == plain.columns
    assert rows_of(sliced) == rows_of(plain)
    assert fill_nearest_sliced(df.limit(0), ["a"], 40, width).count() == 0


def chain(table, interval, gap, fill):
    wide = pivot_metrics(table, ["a", "b"], by=[SLICE])
    grid = create_grid(wide, interval, binary=(), metrics=["a", "b"], by=[SLICE])
    return grid, fill_nearest_sliced(build_blocks(grid, gap, slice_col=SLICE), ["a", "b"], fill,
                                     slice_col=SLICE, drop=False)


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString(), \
        df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plain_plans(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def laid_out(spark, rows, buckets=8, width=600):
    path = scratch_path(spark, "laid_out_test")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    long = spark.createDataFrame(rows, "hwid long, when long, metric string, value double")
    return name, path, long, write_laid_out(long, name, path, width, buckets)


def long_rows(seed):
    return [(d, t, m, v) for d, t, a, b, _ in series(seed) for m, v in (("a", a), ("b", b))
            if v is not None]


def test_chain_on_a_laid_out_table(spark, plain_plans):
    name, path, long, table = laid_out(spark, long_rows(1))
    grid, filled = chain(table, 20, 90, 40)
    wide = pivot_metrics(long, ["a", "b"])
    plain_grid = create_grid(wide, 20, binary=(), metrics=["a", "b"])
    plain = fill_nearest(build_blocks(plain_grid, 90), ["a", "b"], 40, drop=False)
    assert rows_of(grid.drop(SLICE)) == rows_of(plain_grid)
    assert rows_of(filled.drop(SLICE).select(plain.columns)) == rows_of(plain)
    # the grid is read without any exchange
    assert "Exchange" not in plan_of(grid)[1]
    # what is exchanged is the result of an aggregate by slice or a window over one,
    # never rows of the table, which a scan or join would give
    lines = plan_of(filled)[1].splitlines()
    at = [i for i, x in enumerate(lines) if "- Exchange " in x]
    assert at
    for i in at:
        below = next(x for x in lines[i + 1:] if re.search(r"Aggregate\(|Join \[|FileScan |ReusedExchange", x))
        assert re.search(r"Aggregate\(|ReusedExchange", below) and f"{SLICE}#" in below, below


def test_layout_spreads_a_device_and_opens_again(spark):
    rows = [(1, t, "a", 1.0) for t in range(0, 60000, 10)] + [(2, None, "a", 2.0), (None, 5, "b", 3.0)]
    name, path, long, table = laid_out(spark, rows)
    assert rows_of(table.drop(SLICE)) == rows_of(long)
    files = table.groupBy(F.input_file_name().alias("f")).count().collect()
    assert max(r["count"] for r in files) < 0.5 * len(rows)
    again = open_laid_out(spark, f"{name}_again", path, table.schema, 8)
    assert rows_of(again) == rows_of(table)
    assert "Exchange" not in plan_of(again.groupBy("hwid", SLICE).count())[1].replace(
        "AdaptiveSparkPlan", "")
    with pytest.raises(Exception, match="(?i)exists"):
        write_laid_out(long, name, path, 600, 8)


def test_empty_table(spark):
    *_, table = laid_out(spark, [])
    assert chain(table, 20, 90, 40)[1].count() == 0
