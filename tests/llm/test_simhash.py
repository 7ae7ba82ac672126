import random

import numpy as np
import xxhash

from vigil.llm import components, simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, most=2):
    """Root (smallest position) by position."""
    f, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= most):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def near_texts(n=40, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(5, 400))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(words))
            out.append(" ".join([*words[:k], "changed", *words[k + 1:]]))
        if i % 4 == 0:
            out.append(out[-1])
            out.append(out[-1].upper())
    return out


def test_groups_match_brute_force(docs_of, odd_rows):
    rows = odd_rows[:-3] + [odd_rows[-1]]
    rows += [(100 + i, t, "en", "a") for i, t in enumerate(near_texts())]
    ids = [r[0] for r in rows]
    fps = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_groups(fps)
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min(i, least.get(r, i))
    want = sorted((i, f, least[r]) for i, f, r in zip(ids, fps, roots))
    got = simhash.simhash_groups(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want


def test_null_ids(docs_of):
    got = simhash.simhash_groups(docs_of([(None, "a b c", "", ""), (9, "a b c", "", ""),
                                          (None, "quite another text", "", "")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 9), (9, 9)]


def test_large_buckets_are_split(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    ball = {base}
    while len(ball) < 2500:
        x = base
        for b in rng.sample(range(64), rng.choice((1, 2, 3, 3, 4))):
            x ^= 1 << b
        ball.add(x)
    ball = sorted(ball | {rng.getrandbits(64) for _ in range(500)})
    df = spark.createDataFrame([(simhash._signed(x),) for x in ball], "fp long")
    got = {r.fp & (1 << 64) - 1: r.root for r in simhash.fingerprint_components(df).collect()}
    assert len(got) == len(ball)
    want, seen = brute_groups(ball), {}
    for x, r in zip(ball, want):
        assert seen.setdefault(r, got[x]) == got[x]
    assert len(set(seen.values())) == len(seen)


def test_near_pairs_match_all_pairs():
    rng = random.Random(2)
    for n in (1, 2, 30, 200):
        fps = sorted({rng.getrandbits(10) << 20 for _ in range(n)})
        want = {(x, y) for i, x in enumerate(fps) for y in fps[i + 1:] if (x ^ y).bit_count() <= 2}
        got = [tuple(sorted(p)) for p in simhash.near_pairs(fps, 2)]
        assert len(got) == len(set(got)) and set(got) == want


def test_keep_one(docs_of, odd_rows):
    df = docs_of(odd_rows + [(50, "Plain  words HERE", "en", "a")])
    out = simhash.keep_one(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    got = out.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [
        (False, 1), (False, 4), (False, 5), (False, 7), (True, 0)]
    assert simhash.keep_one(docs_of([])).count() == 0
    assert simhash.simhash_groups(docs_of([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)]
    edges += [(5, 5), (2000, 2001), (2001, 2000)]
    random.Random(3).shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(300)} | {2000: 2000, 2001: 2000}
    assert got == want
    assert components.connected_components(df.limit(0)).count() == 0
