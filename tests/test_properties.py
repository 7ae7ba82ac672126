
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import grid as R
from vigil.operators import nulls as N
from vigil.operators.learn import run_model
from vigil.plans import stand_in as S

SF = "/root/testdata/sf0.001"


def test_block_ids_step_by_one(spark):
    b = S.blocks(spark, SF)
    w = Window.partitionBy("hwid").orderBy("when")
    d = b.select((F.col("BlockID") - F.lag("BlockID").over(w)).alias("d")).where("d IS NOT NULL")
    assert d.where("d < 0 OR d > 1").count() == 0
    first = b.groupBy("hwid").agg(F.min("BlockID").alias("m"))
    assert first.where("m <> 0").count() == 0


def test_sliced_blocks_equal_plain(spark):
    from vigil.operators.blocks import build_blocks
    g = S.grid(spark, SF)
    a = build_blocks(g, S.GAP)
    b = build_blocks(g, S.GAP, split_seconds=3 * 86400)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fill_keeps_non_null(spark):
    b = S.blocks(spark, SF)
    f = N.fill_nearest(b, S.SENSORS, S.FILL, drop=False)
    j = b.alias("a").join(f.alias("b"), ["hwid", "when"])
    for c in S.SENSORS:
        assert j.where(F.col(f"a.{c}").isNotNull() & (F.col(f"a.{c}") != F.col(f"b.{c}"))).count() == 0


def test_densify_keeps_originals(spark):
    b = S.blocks(spark, SF).select("hwid", "BlockID", "when", "NextDiff", *S.GRID_COLS)
    d = R.densify_gaps(b, S.GAP, S.G)
    orig = d.where(~F.col("is_artificial")).select("hwid", "BlockID", "when")
    assert orig.exceptAll(b.select("hwid", "BlockID", "when")).count() == 0
    assert orig.count() == b.count()


def test_label_implies_event_ahead(spark):
    p = S.predicted(spark, SF)
    w = Window.partitionBy("hwid", "BlockID").orderBy("when").rangeBetween(1, S.LOOK)
    x = p.withColumn("ev", F.max("overheating").over(w))
    assert x.where("predictive_overheating = 1 AND (ev IS NULL OR ev <> 1)").count() == 0


@pytest.mark.parametrize("name", ["d6_d7_detect_anomalies", "b6_event_blocks", "c13_auc_by_block_sensor"])
def test_same_result_for_1_and_8_partitions(spark, name):
    from vigil.plans.catalog import QUERIES
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = QUERIES[name](spark, SF).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        b = QUERIES[name](spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_error_contract(spark):
    w = S.wide(spark, SF)
    with pytest.raises(ValueError):
        R.resample(w, ["click"], 60, "median")
    with pytest.raises(ValueError):
        R.resample_sensor(w, "click", 60, "nearest")
    with pytest.raises(ValueError):
        run_model(w, ["click"], "engine", algo="gbt")


def test_sliced_forward_fill_equals_plain(spark):
    w = S.wide(spark, SF).select("hwid", "when", *S.SENSORS)
    a = N.forward_fill(w, S.SENSORS)
    b = N.forward_fill(w, S.SENSORS, split_seconds=2 * 86400)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_level_top_gaps_equals_one_level(spark):
    from vigil.operators.aggregates import time_gap_frequency
    from vigil.operators.setops import top_gaps
    f = time_gap_frequency(S.wide(spark, SF))
    a = top_gaps(f, 3, buckets=1)
    b = top_gaps(f, 3, buckets=16)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_global_cumsum_equals_single_window(spark):
    from vigil.operators.sequence import global_cumsum
    ev = spark.read.parquet(f"{SF}/events.parquet")
    per = ev.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    got = global_cumsum(per, "value", ["n"], slices=7, descending=True)
    ref = per.withColumn("n_cum", F.sum("n").over(
        Window.orderBy(F.col("value").desc()).rowsBetween(Window.unboundedPreceding, 0)))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_split_by_device_writes_partitions(spark, tmp_path):
    from vigil.sources.readings import split_by_device
    r = S.readings(spark, SF)
    ids = [r["hwid"] for r in r.select("hwid").distinct().limit(3).collect()]
    out = str(tmp_path / "split")
    rep = split_by_device(r, ids, path=out).first()
    back = spark.read.parquet(out)
    assert back.count() == rep["rows_out"]
    assert rep["rows_in"] == r.count() == rep["rows_out"] + rep["rows_unmatched"]
    assert {x["hwid"] for x in back.select("hwid").distinct().collect()} == set(ids)


def test_prepare_materialized_sliced_equals_default(spark):
    from vigil.plans import composite as Q
    from vigil.plans.catalog import ROLES
    r = S.readings(spark, SF)
    a = Q.prepare(r, ROLES, S.EVENTS, fill_cols=("engine",), slice_blocks=True,
                  materialize_grid=True)
    b = Q.prepare(r, ROLES, S.EVENTS, fill_cols=("engine",))
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
