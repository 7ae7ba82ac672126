"""What grows with the rows, and what must not: files, groups, states, tasks."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vigil.operators import learn as L
from vigil.operators import states as ST
from vigil.operators.grid import resample
from vigil.operators.states import all_pairs, merge_pair_states, pair_states
from vigil.plans import stand_in as S
from vigil.sources import readings as R
from vigil.sources.readings import read_snapshot, split_by_device, write_snapshot

DAY = 86400


def daily_readings(spark, devices: int, days: int):
    return spark.range(devices * days).select(
        ((F.col("id") % days) * DAY).alias("when"),
        F.format_string("d%d", F.floor(F.col("id") / days)).alias("hwid"),
        F.lit("m").alias("metric"), F.col("id").cast("double").alias("value"))


@pytest.fixture
def many_tasks(spark):
    """Small shuffles keep all their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def plan_of(df) -> str:
    """The plan as made before the run."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def rounded(df) -> list:
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()),
                  key=str)


def files_by_folder(path) -> dict[str, int]:
    return {d.name: len(list(d.glob("*.parquet"))) for d in Path(path).iterdir() if d.is_dir()}


def test_a_device_of_a_snapshot_is_one_file_whatever_its_days(spark, many_tasks, tmp_path):
    rows = daily_readings(spark, 6, 40)
    write_snapshot(rows, path := str(tmp_path / "snapshot"))
    assert files_by_folder(path) == {f"hwid=d{i}": 1 for i in range(6)}
    back = read_snapshot(spark, path).select(rows.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_a_listed_device_is_one_file_whatever_its_days(spark, many_tasks, tmp_path):
    rows = daily_readings(spark, 6, 40)
    report = split_by_device(rows, ["d1", "d4", "d9"], path=str(tmp_path / "split")).first()
    assert report.asDict() == {"rows_in": 240, "rows_out": 80, "rows_unmatched": 160,
                               "rows_duplicate": 0}
    assert files_by_folder(tmp_path / "split") == {"hwid=d1": 1, "hwid=d4": 1}


def test_devices_are_dealt_out_however_few_their_bytes(spark, tmp_path):
    rows = daily_readings(spark, 60, 3)
    split_by_device(rows, [f"d{i}" for i in range(60)], path=str(tmp_path / "split"), tasks=7)
    found = spark.read.parquet(str(tmp_path / "split"))
    # a file's name begins with its task
    tasks = found.select(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)).distinct().count()
    assert tasks == 7 and found.count() == 180


def test_a_large_device_is_split_and_no_row_is_lost(spark, monkeypatch):
    monkeypatch.setattr(R, "ROWS_PER_FILE", 10)
    rows = daily_readings(spark, 3, 40).withColumn("hwid", F.when(F.col("hwid") != "d2", F.col("hwid")))
    rows = rows.where("hwid IS NULL OR hwid = 'd0' OR when < 86400 * 5")
    dealt = R.by_device(rows, tasks=16)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    tasks = dict(map(tuple, dealt.select("hwid", F.spark_partition_id().alias("task")).distinct()
                     .groupBy("hwid").count().collect()))
    assert tasks["d1"] == 1 and tasks["d0"] > 1 and tasks[None] > 1


def lines(spark, n=300):
    return spark.range(n).select(
        (F.col("id") % 50).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") * 1.5).alias("a"),
        (F.col("id") % 13).cast("double").alias("b"), (F.col("id") % 5).cast("double").alias("c"))


def test_rows_move_in_place_of_unfinished_states(spark):
    pairs = all_pairs(["a", "b", "c"])
    dealt = pair_states(lines(spark), pairs, ["k"], complete=True, deal=True)
    assert rounded(dealt) == rounded(pair_states(lines(spark), pairs, ["k"], complete=True))
    plan = plan_of(dealt)
    assert plan.count("Exchange ") == 1
    # lines run from the result down to the scan: nothing is aggregated below the exchange
    assert "Aggregate" not in plan[plan.index("Exchange "):]


def test_a_large_key_of_states_is_not_sent_to_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "ROWS_PER_KEY", 100)
    # two keys, each null or not; 1500 of 2000 rows have the key (null, null)
    rows = lines(spark, 2000).select(
        F.when(F.col("k") % 4 == 0, F.col("k")).alias("k"),
        F.when(F.col("k") % 8 == 0, F.lit(3)).alias("day"), "a", "b", "c")
    rows.repartition(6).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    pairs = all_pairs(["a", "b", "c"])
    dealt = pair_states(rows, pairs, ["k", "day"], complete=True, deal=True)
    got, want = ({tuple(r)[:4]: tuple(r)[4:] for r in x.collect()} for x in (
        dealt, pair_states(rows, pairs, ["k", "day"], complete=True)))
    assert got.keys() == want.keys() and dealt.count() == len(got) == 14 * len(pairs)
    assert all(got[k] == pytest.approx(v, rel=1e-12, abs=1e-9) for k, v in want.items())
    sent = []  # what each exchange sends: rows, or an aggregate of them
    for part in plan_of(dealt).split("Exchange ")[1:]:
        below = next(x for x in part.splitlines()[1:] if "Aggregate" in x or "FileScan" in x)
        sent.append("Aggregate" if "Aggregate" in below else "rows")
    assert sorted(sent) == ["Aggregate", "rows"]


def test_states_of_a_pair_do_not_meet_in_one_task(spark):
    states = pair_states(lines(spark), [("a", "b"), ("b", "c")], ["k"]).localCheckpoint()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(merge_pair_states(states))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        by_key = plan_of(merge_pair_states(states, ["k"]))
        assert "SortMergeJoin" in by_key  # as many means as keys: never forced
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mode_stays_in_the_tasks_dealt(spark):
    rows = spark.range(400).select(
        F.format_string("d%d", F.col("id") % 9).alias("hwid"), (F.col("id") * 10).alias("when"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 4).cast("double")).alias("a"),
        F.when(F.col("id") % 8 == 0, 1.0).alias("b"))
    dealt = resample(rows, ["a", "b"], 600, "mode", tasks=11)
    assert rounded(dealt) == rounded(resample(rows, ["a", "b"], 600, "mode"))
    plan = plan_of(dealt)
    assert plan.count("Exchange ") == 1 and ", 11), REPARTITION_BY_NUM" in plan


def test_more_events_are_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    spark.range(200).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 9000).alias("ts"),
        (F.col("id") % 30).alias("user_id"), F.get(kinds, F.col("id") % 5).alias("event_type"),
        (F.col("id") % 100).cast("double").alias("value"), F.lit('{"k": 3}').alias("props")
    ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(S, "EVENTS_PER_TASK", 10)
    assert S.device_tasks(spark, str(tmp_path)) == 20
    # the windows by device are given 20 tasks, however few bytes they read
    assert S.blocks(spark, str(tmp_path)).rdd.getNumPartitions() == 20


def labelled(spark, n=400):
    return spark.range(n).select(
        F.col("id").cast("string").alias("hwid"), F.col("id").alias("when"),
        ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 53) % 17).cast("double").alias("b"),
        (((F.col("id") * 37) % 101 > 60) != ((F.col("id") * 53) % 17 > 9)).cast("double").alias("y"))


def test_rows_keep_their_nodes_and_the_forest_is_the_same(spark):
    stages = L.assembler_stages(["a", "b"], scaler=False)
    data = stages[0].transform(labelled(spark)).localCheckpoint()
    forest = L.build_model("rf", "y", n_trees=6, max_depth=4)
    assert forest.getCacheNodeIds()
    walked = forest.copy().setCacheNodeIds(False)
    kept, plain = ([t.toDebugString.split("\n")[1:] for t in x.fit(data).trees] for x in (forest, walked))
    assert kept == plain


def test_training_rows_are_dealt_out_by_rows_times_trees(spark, tmp_path, monkeypatch):
    labelled(spark).coalesce(1).write.parquet(str(tmp_path / "train"))
    train = spark.read.parquet(str(tmp_path / "train"))
    assert L.dealt_for_trees(train, 10).rdd.getNumPartitions() == 1
    monkeypatch.setattr(L, "VISITS_PER_TASK", 500)
    dealt = L.dealt_for_trees(train, 10)  # 4000 visits: whole rounds of 4 tasks
    assert dealt.rdd.getNumPartitions() == 8 and max(map(len, dealt.rdd.glom().collect())) <= 52
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, train.collect()))
