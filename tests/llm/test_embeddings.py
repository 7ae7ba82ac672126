import numpy as np
import pytest

from vigil.llm import embedding_neardup as E


def rows_of(seed=0, n=150, dims=16):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        v = rng.normal(size=dims)
        out.append((v, i % 3))
        if i % 5 == 0:
            for _ in range(int(rng.integers(1, 12))):
                out.append((v + rng.normal(size=dims) * 0.04, i % 3))
        if i % 7 == 0:
            out.append((v, i % 3))
            out.append((v * 2, i % 3))
            out.append((v, (i + 1) % 3))
    ball = rng.normal(size=dims)
    out += [(ball + rng.normal(size=dims) * 0.03, 1) for _ in range(150)]
    return [(i, [float(np.float32(x)) for x in v], lab) for i, (v, lab) in enumerate(out)]


def brute(rows, threshold=0.98):
    ok = []
    for _, v, lab in rows:
        a = np.array([np.nan if x is None else x for x in v], float) if v else np.array([])
        ok.append(lab is not None and len(a) > 0 and np.isfinite(a).all() and np.abs(a).max() > 0)
    links = {i: set() for i in range(len(rows))}
    for i, (_, v, lab) in enumerate(rows):
        for j in range(i + 1, len(rows)):
            w, other = rows[j][1], rows[j][2]
            if ok[i] and ok[j] and lab == other and len(v) == len(w):
                a, b = np.array(v) / np.abs(v).max(), np.array(w) / np.abs(w).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold or v == w:
                    links[i].add(j)
                    links[j].add(i)
    out, seen = {}, {}
    for i in links:
        if i not in seen:
            todo, part = [i], {i}
            while todo:
                for j in links[todo.pop()] - part:
                    part.add(j)
                    todo.append(j)
            for j in part:
                seen[j] = min((rows[k][0] for k in part if rows[k][0] is not None), default=None)
    return [(r[0], len(links[i]), seen[i]) for i, r in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows],
                                 "vec_id long, embedding array<float>, label int, node string")


def test_links_match_brute_force(spark):
    rows = rows_of()
    odd = [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 16, 1), (9003, [1.0, None] * 8, 1),
           (9004, [float("nan")] * 16, 1), (9005, [float("inf")] + [0.0] * 15, 1),
           (9006, rows[0][1], None), (9007, [1.0, 0.0], 1), (9008, [1e-30, 0.0], 1),
           (9009, [3e38, 1e30], 1), (None, rows[0][1], rows[0][2]), (None, [5.0] * 3, 2)]
    rows += odd
    got = E.link_vectors(frame(spark, rows).repartition(3), k=8, tables=8).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty(spark):
    assert E.link_vectors(frame(spark, [(1, [1.0], 1)]).limit(0)).count() == 0
    only = E.link_vectors(frame(spark, [(1, [1.0, 2.0], 1)])).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in only] == [(1, 0, 1, True)]


def test_exact_counts(spark):
    rows = rows_of(n=30)
    nodes = E.nodes_of(frame(spark, rows), "embedding", "label", "vec_id")
    got = {r.node: r.n for r in E.exact_counts(nodes, 20, 0.98).collect()}
    assert len(got) == 20
    all_nodes = {r.node: r for r in nodes.collect()}
    for node, n in got.items():
        me = all_nodes[node]
        u = np.array(me.vec) / np.linalg.norm(me.vec)
        assert n == sum(u @ np.array(r.vec) / np.linalg.norm(r.vec) >= 0.98 for r in all_nodes.values()
                        if r.node != node and r.label == me.label)


def test_recall_is_a_mean_over_nodes(spark):
    truth = spark.createDataFrame([(i, 1000) for i in range(95)] + [(100 + i, 1) for i in range(5)]
                                  + [(200, 0)], "node long, n long")
    lists = spark.createDataFrame([(i, [0.99] * 1000) for i in range(95)] + [(100, [0.97])],
                                  "node long, sims array<double>")
    assert abs(E.mean_recall(truth, lists, 0.98) - 0.95) < 1e-12
    assert E.mean_recall(truth.filter("n = 0"), lists, 0.98) == 1.0


def test_lone_pairs_beside_a_large_group(spark):
    rng = np.random.default_rng(5)
    ball = rng.normal(size=16)
    vecs = [ball + rng.normal(size=16) * 0.03 for _ in range(600)]
    for v in rng.normal(size=(400, 16)):
        vecs += [v, v + rng.normal(size=16) * 0.15]
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(vecs)]
    units = np.array([v for _, v, _ in rows])
    units /= np.linalg.norm(units, axis=1)[:, None]
    links = (units @ units.T >= 0.98).sum(axis=1) - 1
    with pytest.raises(RuntimeError, match="recall"):
        E.link_vectors(frame(spark, rows), tables=1, restarts=0)
    got = {r.vec_id: r.n_links for r in E.link_vectors(frame(spark, rows), tables=1).collect()}
    assert [got[i] for i in range(len(rows))] == links.tolist()
