import pytest
from pyspark.sql import functions as F

from vigil.llm import mixing


def brute_targets(sizes, share=1.5, most=2.0):
    """Reshare the excess until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    cap = {s: most * sizes[s] for s in order}
    target = dict.fromkeys(order, 0.0)
    left, open_ = share * sum(sizes.values()), [s for s in order if cap[s] > 0]
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        give = {s: min(cap[s] - target[s], left * weight[s] / total) for s in open_}
        for s, g in give.items():
            target[s] += g
        left -= sum(give.values())
        open_ = [s for s in open_ if cap[s] - target[s] > 1e-9]
    return target


def test_targets(spark):
    sizes = {"a": 10, "b": 500, "B": 3, None: 40, "c": 0, "é": 1000, "z": 7}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6), s


def test_mix_meets_targets(docs_of):
    rows = [(i, " ".join(f"w{k}" for k in range(1 + i * 7 % 40)), "en", "hot" if i % 3 else f"s{i % 5}")
            for i in range(600)]
    out = mixing.mix(docs_of(rows)).toPandas()
    assert len(out) == 600
    for _, g in out.groupby("source"):
        assert g["size"].sum() == g.source_size.iloc[0]
        assert g.taken.sum() == int(g.target.iloc[0])
        assert (g.taken <= 2 * g["size"]).all()
        epochs = int(g.target.iloc[0] // g["size"].sum())
        assert (g.taken >= epochs * g["size"]).all()
        assert ((g.taken % g["size"]) > 0).sum() <= 1  # one document in part
    again = mixing.mix(docs_of(rows, 7)).toPandas()
    assert (out.set_index("doc_id").taken.sort_index()
            == again.set_index("doc_id").taken.sort_index()).all()


def test_better_documents_come_first(docs_of):
    plain, noisy = "word " * 20, "w%%%%%%%%%%%%%%%%%%%% " * 20
    rows = [(i, plain if i % 2 else noisy, "en", "a" if i < 800 else "b") for i in range(1000)]
    out = mixing.mix(docs_of(rows), share=0.3, weights=(1.0,)).toPandas()
    got = out[out.source == "a"].groupby(out.doc_id % 2).taken.sum()
    assert got[1] > 1.3 * got[0]


def test_rows_follow_the_mix(docs_of, odd_rows):
    rows = odd_rows + [(i, f"alpha beta\ngamma {i} delta", "en", f"s{i % 4}") for i in range(50, 90)]
    df = docs_of(rows)
    taken = mixing.mix(df).agg(F.sum("taken")).first()[0]
    out = mixing.mix_rows(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert out.select(F.sum(mixing.size_in_words(F.col("text")))).first()[0] == taken
    assert out.filter("n_chars != length(text)").count() == 0
    texts = {r[1] for r in rows}
    assert all(any(t and t.startswith(r.text) for t in texts) for r in out.collect())


def test_first_words(spark):
    df = spark.createDataFrame([(" a\nb  c d ", 2), ("a b", 2), ("x", 1)], "t string, n int")
    assert [r[0] for r in df.select(mixing.first_words(F.col("t"), F.col("n"))).collect()] == [
        " a\nb", "a b", "x"]


def test_odd_rows_and_empty(docs_of, odd_rows):
    out = mixing.mix(docs_of(odd_rows)).toPandas()
    assert len(out) == len(odd_rows)
    assert (out.taken <= 2 * out["size"]).all()
    assert mixing.mix(docs_of([])).count() == 0
    assert mixing.mix_rows(docs_of([])).count() == 0
    none = mixing.mix(docs_of([(1, None, "en", "a"), (2, "", "en", "b")])).collect()
    assert [(r["size"], r.taken, r.target) for r in none] == [(0, 0, 0.0)] * 2
