"""Mergeable states, exact split, gradient and checked reading."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import learn as L
from vigil.operators import states as ST
from vigil.sources import readings as X


def test_merged_sketches_are_near_exact_counts(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("hwid"), (F.col("id") % 30).alias("BlockID"),
                                    (F.col("id") % 20_011).cast("double").alias("a"),
                                    F.when(F.col("id") % 3 == 0, -0.0).otherwise(0.0).alias("b"),
                                    F.lit(None).cast("double").alias("c"))
    cells = ST.distinct_sketches(df, ["a", "b", "c"])
    for keys in ([], ["hwid"], ["hwid", "BlockID"]):
        near = {(*[r[k] for k in keys], r.sensor): r.n_distinct
                for r in ST.distinct_estimates(ST.merge_sketches(cells, keys)).collect()}
        exact = {(*[r[k] for k in keys], s): r[s] for s in ("a", "b")
                 for r in df.groupBy(*keys).agg(*[F.count_distinct(c).alias(c) for c in "ab"]).collect()}
        assert near.keys() == exact.keys()
        assert all(abs(near[k] - n) <= max(0.5, 4 * 1.04 / 64 * n) for k, n in exact.items())


def test_states_merge_to_the_whole(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([1, 2, None]), rnd.randrange(9), *[
        None if rnd.random() < 0.1 else 1e8 + rnd.gauss(0, 1) * (i + 1) for i in range(3)])
        for _ in range(800)]
    df = spark.createDataFrame(rows, "hwid long, day long, x double, y double, z double")
    pairs = ST.all_pairs("xyz")
    states = ST.pair_states(df, pairs, ["hwid", "day"])
    data = {c: [r[i + 2] for r in rows] for i, c in enumerate("xyz")}

    def cov(a, b, keep=lambda r: True):
        both = [(p, q) for p, q, r in zip(data[a], data[b], rows)
                if p is not None and q is not None and keep(r)]
        return np.cov(*np.array(both).T)[0, 1]

    got = {(r.col_i, r.col_j): r["cov"] for r in ST.covariances(ST.merge_pair_states(states)).collect()}
    assert got.keys() == {(a, b) for a in "xyz" for b in "xyz"}
    assert all(v == pytest.approx(cov(*k), rel=1e-5, abs=1e-5) for k, v in got.items())
    late = ST.merge_pair_states(states.where("day >= 5"), ["hwid"])
    for r in late.where("a = 'x' and b = 'y'").collect():
        want = cov("x", "y", lambda q, h=r.hwid: q[0] == h and q[1] >= 5)
        assert r.sab / (r.n - 1) == pytest.approx(want, rel=1e-5, abs=1e-5)
    full = ST.pair_states(df, pairs, ["hwid", "day"], complete=True)
    n = sum(None not in r[2:] for r in rows)
    assert {r.n for r in ST.merge_pair_states(full).collect()} == {n}
    assert ST.merge_pair_states(states.limit(0)).count() == 0


def brute_split(points):
    gini = lambda ys: len(ys) * 2 * np.mean(ys) * (1 - np.mean(ys)) if ys else 0.0
    values = sorted({v for v, _ in points})
    best = (0.0, None)
    for a, b in zip(values, values[1:]):
        left, right = [y for v, y in points if v <= a], [y for v, y in points if v > a]
        gain = round((gini([y for _, y in points]) - gini(left) - gini(right)) / len(points), 12)
        if gain > best[0]:
            best = (gain, (a + b) / 2)
    return best


def test_exact_split(spark):
    rnd = random.Random(2)
    for points in ([(rnd.randrange(40) / 8, rnd.randrange(2)) for _ in range(300)],
                   [(float(i), int(i > 4)) for i in range(9)],
                   [(1.0, 0), (2.0, 1), (3.0, 0)]):  # two borders gain alike
        df = spark.createDataFrame(points + [(None, 1), (1.0, None)], "v double, y int")
        (row,) = L.exact_split(df, "v", "y").collect()
        gain, at = brute_split(points)
        assert (row.threshold, row.gain) == (at, pytest.approx(gain, abs=1e-11))
    flat = spark.createDataFrame([(3.0, 0), (3.0, 1)], "v double, y int")
    assert tuple(L.exact_split(flat, "v", "y").first()) == ("v", 3.0, 0.0)
    assert tuple(L.exact_split(flat.limit(0), "v", "y").first()) == ("v", None, 0.0)


def test_gradient_is_that_of_the_loss(spark):
    rnd = random.Random(3)
    rows = [(rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.randrange(2), rnd.choice([1.0, 8.0])) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y int, w double")
    x = np.array([(a, b, 1.0) for a, b, *_ in rows])
    y, w = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])

    def loss(t):
        m = x @ t
        return (w * (np.log1p(np.exp(-m)) + (1 - y) * m)).sum() / w.sum()

    at = np.array([0.3, -0.7, 0.2])
    want = [(loss(at + e) - loss(at - e)) / 2e-6 for e in np.eye(3) * 1e-6]
    got = {r.feature: r.gradient for r in L.logistic_gradient(df, ["a", "b"], "y", at[:2], at[2], "w").collect()}
    assert [got["a"], got["b"], got["intercept"]] == pytest.approx(want, abs=1e-6)


def test_bad_lines_go_to_quarantine(spark, tmp_path):
    lines = ["when,hwid,metric,value", "1000,a,S1,2.5", "x,a,S1,1", "3000,a,S1", "4000,b,S2,1,extra",
             "5000,b,S2,", "6000,c,,7"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    good, counts = X.read_readings_checked(spark, str(tmp_path / "in.csv"), str(tmp_path / "q"))
    assert counts.first().asDict() == {"lines": 6, "read": 3, "rejected": 3}
    assert sorted(map(tuple, good.collect()), key=str) == [
        (1, "a", "S1", 2.5), (5, "b", "S2", None), (6, "c", None, 7.0)]
    bad = {r.bad_line for r in spark.read.parquet(str(tmp_path / "q")).where("rejected = 1").collect()}
    assert bad == {lines[2], lines[3], lines[4]}
