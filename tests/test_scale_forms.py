"""Forms for keys longer than a task, and estimates, against plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators.anomaly import detect_anomalies, detect_anomalies_sliced
from vigil.operators.correlation import (auc_by_block_sensor, digamma, neighbour_information,
                                         own_bins_overlap)
from vigil.operators import learn as L
from vigil.operators.sequence import keyed_cumsum


def switching(rnd, device, block, n, start=0):
    """Rows of an engine that switches in bursts, with gaps of many widths."""
    t, rows = start, []
    for _ in range(n):
        t += rnd.choice([1, 2, 5, 30, 31, 200, 1000])
        rows.append((device, block, t, rnd.choice([0.0, 1.0, None] + [0.0, 1.0] * 4), rnd.choice([0.0, 1.0])))
    return rows


@pytest.mark.parametrize("width", [7, 60, 5000])
def test_sliced_anomalies_equal_plain(spark, width):
    rnd = random.Random(width)
    rows = switching(rnd, 1, 0, 900) + switching(rnd, 1, 1, 60, 10**6) + switching(rnd, 2, 0, 40)
    df = spark.createDataFrame(rows, "hwid long, BlockID long, when long, e1 double, e2 double")
    plain = detect_anomalies(df, 30, 4, ["e1", "e2"])
    sliced = detect_anomalies_sliced(df, 30, 4, ["e1", "e2"], width)
    assert sliced.columns == plain.columns
    a, b = (sorted(map(tuple, d.collect()), key=str) for d in (plain, sliced))
    assert a == b
    assert 0 < sum(r[-1] for r in a) < len(a)


def test_sliced_anomalies_have_no_window_over_a_block(spark):
    df = spark.createDataFrame(switching(random.Random(1), 1, 0, 50),
                               "hwid long, BlockID long, when long, e1 double, e2 double")
    plan = detect_anomalies_sliced(df, 30, 4, ["e1"], 100)._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Window [")]
    rows = [w for w in windows if "when#" in w]
    assert rows and all("__slice" in w for w in rows)


def test_keyed_running_sums_with_a_hot_key(spark):
    rnd = random.Random(3)
    rows = [("hot", i, rnd.randrange(5)) for i in rnd.sample(range(10**6), 1800)]
    rows += [(f"k{i % 40}", i, 1) for i in range(180)] + [(None, i, 2) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, o long, n long").repartition(5)
    got = {(r.k, r.o): (r.n_cum, r.after) for r in keyed_cumsum(df, ["k"], "o", ["n"], "after").collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        mine, total = sorted((o, n) for k, o, n in rows if k == key), 0
        for i, (o, n) in enumerate(mine):
            total += n
            assert got[key, o] == (total, mine[i + 1][0] if i + 1 < len(mine) else None)


def test_auc_with_one_block_of_most_rows(spark):
    rnd = random.Random(4)
    rows = [(1, 0, rnd.randrange(30) / 4, int(rnd.random() < 0.3)) for _ in range(900)]
    rows += [(2, b, float(rnd.randrange(9)), rnd.randrange(2)) for b in range(5) for _ in range(20)]
    df = spark.createDataFrame(rows, "hwid long, BlockID long, s double, flag_anomaly int")
    got = {(r.hwid, r.BlockID): r.roc_auc for r in auc_by_block_sensor(df, ["s"], min_distinct=3).collect()}
    for key in {r[:2] for r in rows}:
        ones = [r[2] for r in rows if r[:2] == key and r[3] == 1]
        zeros = [r[2] for r in rows if r[:2] == key and r[3] == 0]
        wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
        assert got[key] == pytest.approx(wins / (len(ones) * len(zeros)))


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def test_digamma(spark):
    n = [1, 2, 3, 9, 10, 500, 100000]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in n], "n long").select(
        digamma(F.col("n"))).collect()]
    assert got == pytest.approx([psi(i) for i in n], abs=1e-12)


def brute_information(points, k=3):
    sizes = {c: sum(y == c for _, y in points) for _, c in points}
    terms = []
    for i, (v, y) in enumerate(points):
        if sizes[y] < 2:
            continue
        kk = min(k, sizes[y] - 1)
        r = sorted(abs(v - w) for j, (w, c) in enumerate(points) if c == y and j != i)[kk - 1]
        m = sum(w == v or v - r < w < v + r for w, _ in points)
        terms.append(psi(kk) - psi(sizes[y]) - psi(m))
    return max(0.0, psi(len(terms)) + sum(terms) / len(terms)) if terms else 0.0


def test_neighbour_information(spark):
    rnd = random.Random(6)
    groups = {
        (1, 0): [(rnd.gauss(2 * (i % 3 == 0), 1), int(i % 3 == 0)) for i in range(120)],
        (1, 1): [(rnd.randrange(6) / 2, rnd.randrange(2)) for _ in range(60)],  # ties
        (1, 2): [(1.0, 1), (2.0, 0), (2.5, 0), (2.5, 0)],  # a class of one row
        (2, 0): [(1.0, 1), (3.0, 0)],  # no class of two
        (2, 1): [(5.0, 1)] * 5 + [(5.0, 0)] * 2,  # one value
        (2, 2): [(float(i), 0) for i in range(9)],  # no anomaly
        (3, 0): [(None, 1), (1.0, 0), (2.0, 0), (9.0, None)]}
    rows = [(*g, v, y) for g, points in groups.items() for v, y in points]
    df = spark.createDataFrame(rows, "hwid long, BlockID long, s double, flag_anomaly int").repartition(3)
    got = {(r.hwid, r.BlockID): r.mutual_info for r in neighbour_information(df, ["s"]).collect()}
    assert got.keys() == groups.keys() - {(2, 2)}
    for g, value in got.items():
        whole = [(v, y) for v, y in groups[g] if v is not None and y is not None]
        assert value == pytest.approx(brute_information(whole), abs=1e-9), g
    assert got[1, 0] > 0.1
    assert neighbour_information(df.limit(0), ["s"]).count() == 0


def test_own_bins_overlap(spark):
    rnd = random.Random(7)
    zeros, ones = [rnd.gauss(0, 1) for _ in range(400)], [rnd.gauss(1, 2) for _ in range(300)]
    df = spark.createDataFrame([(x, 0) for x in zeros] + [(x, 1) for x in ones] + [(None, 1), (1.0, None)],
                               "s double, t int")
    (row,) = own_bins_overlap(df, "s", "t", 30).collect()
    (h0, e0), (h1, e1) = (np.histogram(x, bins=30, density=True) for x in (zeros, ones))
    edges = np.union1d(e0, e1)
    middle = (edges[1:] + edges[:-1]) / 2

    def height(h, e):
        at = np.searchsorted(e, middle) - 1
        return np.where((at >= 0) & (at < 30), h[np.clip(at, 0, 29)], 0)

    area = (np.minimum(height(h0, e0), height(h1, e1)) * np.diff(edges)).sum()
    assert row.overlap_pct == pytest.approx(100 * area)
    assert row.by_bin_pct == pytest.approx(100 * np.minimum(h0, h1).sum() * (e0[1] - e0[0]))
    one = spark.createDataFrame([(1.0, 0), (1.0, 0), (1.05, 1)], "s double, t int")
    (row,) = own_bins_overlap(one, "s", "t", 10).collect()
    assert row.overlap_pct == pytest.approx(50) and row.by_bin_pct == pytest.approx(100)
    (row,) = own_bins_overlap(one.where("t = 0"), "s", "t", 10).collect()
    assert row.overlap_pct is None and row.by_bin_pct is None


def forest_rows(spark, n=300):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        a, b, c = rnd.random(), rnd.choice([0.0, 1.0, 2.0]), rnd.random()
        rows.append((str(i), i, a, b, c, float(a + 0.3 * (b == 1.0) + 0.2 * rnd.random() > 0.8)))
    return spark.createDataFrame(rows, "hwid string, when long, a double, b double, c double, y double")


@pytest.mark.parametrize("depth", [1, 4])
def test_forest_nodes_score_as_the_model(spark, depth):
    from pyspark.ml.functions import vector_to_array
    df = forest_rows(spark)
    model, _, _ = L.run_model(df, ["a", "b", "c"], "y", "rf", n_trees=7, max_depth=depth)
    nodes = L.forest_nodes(model)
    assert nodes.select("tree").distinct().count() == 7
    said = L.with_probability(model.transform(df), "said").select(
        "hwid", "said", vector_to_array("features").alias("x"))
    for broadcast_rows in (1_000_000, 0):
        got = L.score_by_nodes(said, nodes, "x", depth, ["hwid"], "found", broadcast_rows)
        both = said.join(got, "hwid").collect()
        assert len(both) == 300 and all(abs(r.said - r.found) < 1e-9 for r in both)
    weights = {r.feature: r.importance for r in L.importance_by_nodes(nodes, ["a", "b", "c"]).collect()}
    for c, w in zip("abc", model.stages[-1].featureImportances.toArray()):
        assert abs(weights.get(c, 0.0) - w) < 1e-9


def test_forest_nodes_with_categories_and_one_tree(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.functions import vector_to_array
    df = forest_rows(spark)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="raw"),
                             VectorIndexer(inputCol="raw", outputCol="features", maxCategories=3),
                             DecisionTreeClassifier(labelCol="y", maxDepth=3)]).fit(df)
    nodes = L.forest_nodes(model)
    assert nodes.where("lefts IS NOT NULL").count() > 0
    said = L.with_probability(model.transform(df), "said").select(
        "hwid", "said", vector_to_array("features").alias("x"))
    both = said.join(L.score_by_nodes(said, nodes, "x", 3, ["hwid"], "found"), "hwid").collect()
    assert len(both) == 300 and all(abs(r.said - r.found) < 1e-9 for r in both)


def test_hinge_objective_by_hand(spark):
    rows = [(1.0, 2.0, 1, 2.0), (-1.0, 0.5, 0, 1.0), (0.5, -1.0, 1, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, y int, w double")
    b, i, reg = (0.4, -0.2), 0.1, 0.5
    x, w = np.array([r[:2] for r in rows]), np.array([r[3] for r in rows])
    s = np.array([1, -1, 1])
    mean = (w[:, None] * x).sum(0) / w.sum()
    var = (w[:, None] * (x - mean) ** 2).sum(0) / (w.sum() - (w * w).sum() / w.sum())
    want = (w * np.maximum(0, 1 - s * (x @ b + i))).sum() / w.sum() + reg / 2 * (var * np.square(b)).sum()
    got = L.hinge_objective(df, ["a", "b"], "y", [("p", b, i)], reg, "w").collect()
    assert [r.name for r in got] == ["p"] and abs(got[0].objective - want) < 1e-12
