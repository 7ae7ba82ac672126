"""Forests fitted on counted groups of rows."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from vigil.operators import forest as G
from vigil.operators import learn as L
from vigil.plans import catalog as K


def rows(spark, n=4000, parts=3):
    """Few distinct feature values, labels that go by them and by chance."""
    a, b = F.col("id") * 37 % 11, F.col("id") * 53 % 7
    noise = F.pmod(F.xxhash64("id"), F.lit(10)) < 2
    return spark.range(0, n, 1, parts).select(
        F.col("id").cast("string").alias("hwid"), F.col("id").alias("when"),
        (a / 4).alias("a"), (-b).cast("double").alias("b"), (F.col("id") % 3).cast("double").alias("c"),
        (((a > 5) != (b > 3)) != noise).cast("int").alias("y"))


def assembled(df):
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def trees_of(model):
    return [t.toDebugString.split("\n")[1:] for t in model.trees]


def test_powers_add_up_to_counts(spark):
    counts = [1, 2, 5, 4095, 4096, 3 * 4096 + 9, 10_000_000]
    got = G.by_powers(spark.createDataFrame([(n,) for n in counts], "__n long"))
    sums = got.groupBy("__n").agg(F.sum(F.pow(F.lit(2), "__power")).cast("long"), F.count("*"),
                                  F.count_distinct("__part")).collect()
    assert sorted((r[0], r[1]) for r in sums) == [(n, n) for n in counts]
    assert all(r[2] == r[3] <= r[0] for r in sums)


def test_groups_are_rows_alike_in_label_and_bins(spark):
    data = assembled(rows(spark, 500))
    splits = [[0.5, 1.0], [-3.0], []]
    got = {(r["y"], r["__b0"], r["__b1"], r["__b2"]): (r["__n"], r["features"].toArray().tolist())
           for r in G.counted_groups(data, "y", "features", splits).collect()}
    want = {}
    for r in data.collect():
        key = (float(r["y"]), (r["a"] > 0.5) + (r["a"] > 1.0), int(r["b"] > -3.0), 0)
        want[key] = want.get(key, 0) + 1
    assert {k: n for k, (n, _) in got.items()} == want
    # the vector of a group lies in its bins
    assert all((x[0] > 0.5) + (x[0] > 1.0) == k[1] and (x[1] > -3.0) == k[2] for k, (_, x) in got.items())


def test_a_large_forest_is_fitted_on_groups(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "VISITS_PER_TASK", 1000)
    monkeypatch.setattr(G, "by_powers", lambda x, f=G.by_powers: seen.append(f(x)) or seen[-1])
    df = rows(spark)
    model, test, scored = L.run_model(df, ["a", "b", "c"], "y", "rf", weight_class1=2, n_trees=30, max_depth=5)
    train = L.replicate_positive(L.train_test_split(df)[0], "y", 2)
    assert seen[0].agg(F.sum(F.pow(F.lit(2), "__power"))).first()[0] == train.count()
    assert seen[0].count() < train.count() / 4
    forest = model.stages[-1]
    assert forest.getNumTrees == 30 and forest.numClasses == 2 and forest.numFeatures == 3
    assert scored.where("ProbOverheating BETWEEN 0 AND 1").count() == df.count()
    right = test.agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
    assert right > 0.75  # 0.8 of the labels are not noise
    # nodes are read from the model's saved form
    assert L.forest_nodes(model).agg(F.count_distinct("tree")).first()[0] == 30


def test_rows_are_scored_in_tasks_by_rows_times_trees(spark, monkeypatch):
    monkeypatch.setattr(L, "VISITS_PER_TASK", 1000)
    df = rows(spark, 600, 1).localCheckpoint()
    _, test, scored = L.run_model(df, ["a", "b", "c"], "y", "rf", weight_class1=1, n_trees=20, max_depth=2)
    n = L.train_test_split(df)[0].count()
    assert test.rdd.getNumPartitions() == -(-n * 20 // 1000)
    held = scored.select("hwid", F.spark_partition_id().alias("p")).groupBy("p").count()
    assert held.agg(F.max("count")).first()[0] <= 100 and scored.select("hwid").distinct().count() == 600


def events(spark, path, n=3000):
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.expr("id div 30") * 21600).alias("ts"),
        (F.col("id") % 30).alias("user_id"), F.get(kinds, F.pmod(F.xxhash64("id"), F.lit(5)).cast("int")).alias("event_type"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double").alias("value"),
        F.format_string('{"k": %d}', F.pmod(F.xxhash64("id", F.lit(2)), F.lit(256))).alias("props")
    ).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_queries_fit_large_forests_on_groups(spark, tmp_path, monkeypatch):
    class Grouped(Exception):
        pass

    def seen(forest, data, visits):
        raise Grouped(forest.getNumTrees(), forest.getMaxDepth(), data.count())

    sf = events(spark, tmp_path)
    monkeypatch.setattr(L, "VISITS_PER_TASK", 1000)
    monkeypatch.setattr(G, "fit_by_bins", seen)
    with pytest.raises(Grouped) as found:
        K.QUERIES["l17_importance_report"](spark, sf)
    trees, depth, n = found.value.args
    assert (trees, depth) == (500, 10) and n > 2


def test_rows_of_three_models_are_made_once(spark, tmp_path, monkeypatch):
    sf, read = events(spark, tmp_path), []

    def run(df, cols, label, algo, **kw):
        read.append(df.inputFiles())
        return None, None, df.withColumns({"prediction": F.lit(1.0), "ProbOverheating": F.lit(0.5)})

    monkeypatch.setattr(K.S, "EVENTS_PER_TASK", 10)
    monkeypatch.setattr(L, "run_model", run)
    assert K.QUERIES["l13_l14_model_metrics"](spark, sf).count() == 3
    # three times the same written rows, not the events
    assert read[0] == read[1] == read[2] and all("model-rows" in f for f in read[0])


def test_small_forests_are_fitted_on_rows(spark, monkeypatch):
    monkeypatch.setattr(G, "fit_by_bins", None)
    L.run_model(rows(spark, 200), ["a", "b", "c"], "y", "rf", n_trees=3, max_depth=2)


def test_a_group_is_drawn_as_often_as_its_rows(spark):
    n, trees = 4000, 300
    data = assembled(rows(spark, n))
    model = G.fit_by_bins(RandomForestClassifier(labelCol="y", numTrees=trees, maxDepth=1, seed=5), data, 10**6)
    drawn = L.forest_nodes(model).where("node = 0").agg(F.avg("weight"), F.var_samp("weight")).first()
    # Poisson(n): the variance is n, some 25 times of it if one draw was multiplied by the count
    assert abs(drawn[0] - n) < 4 * (n / trees) ** 0.5 and 0.7 * n < drawn[1] < 1.4 * n


def test_groups_give_the_probabilities_of_rows(spark):
    data = assembled(rows(spark)).localCheckpoint()
    forest = RandomForestClassifier(labelCol="y", numTrees=200, maxDepth=5, seed=5)
    by_rows, by_bins = forest.fit(data), G.fit_by_bins(forest, data, 10**6)
    x = data.select("features", "a", "b", "c").dropDuplicates(["a", "b", "c"])
    said = L.with_probability(by_rows.transform(x), "said").select("a", "b", "c", "said")
    found = L.with_probability(by_bins.transform(x), "found").select("a", "b", "c", "found")
    off = said.join(found, ["a", "b", "c"]).agg(F.count("*"), F.max(F.abs(F.col("said") - F.col("found")))).first()
    assert off[0] == x.count() and off[1] < 0.05
    assert abs(by_rows.featureImportances.toArray() - by_bins.featureImportances.toArray()).max() < 0.05
    points = [{(r["feature"], r["threshold"]) for r in L.forest_nodes(m).where("feature IS NOT NULL").collect()}
              for m in (by_rows, by_bins)]
    assert points[0] == points[1]


def test_the_draw_does_not_go_by_partitions(spark):
    forest = RandomForestClassifier(labelCol="y", numTrees=5, maxDepth=4, seed=5)
    one, seven = (trees_of(G.fit_by_bins(forest, assembled(rows(spark, parts=p)), 10**6)) for p in (1, 7))
    assert one == seven


def test_categories_and_weights_are_left_to_rows(spark):
    df = rows(spark, 300)
    indexed = StringIndexer(inputCol="c", outputCol="k").fit(df).transform(df)
    data = VectorAssembler(inputCols=["a", "k"], outputCol="features").transform(indexed)
    assert G.fit_by_bins(RandomForestClassifier(labelCol="y"), data, 10**6) is None
    assert G.fit_by_bins(RandomForestClassifier(labelCol="y", weightCol="a"), assembled(df), 10**6) is None
    assert G.fit_by_bins(RandomForestClassifier(labelCol="y", bootstrap=False), assembled(df), 10**6) is None
