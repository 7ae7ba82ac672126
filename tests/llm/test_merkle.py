"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vigil.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}"
               for f in merkle.FIELDS])


def climb(nodes, at, claim):
    """(siblings, root of nodes, root from claim)"""
    sibs = []
    while len(nodes) > 1:
        run = nodes[at // 2 * 2:at // 2 * 2 + 2]
        other = run[1 - at % 2] if len(run) == 2 else ""
        sibs.append(other)
        claim = h(other, claim) if at % 2 else h(claim, other)
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        at //= 2
    return sibs, nodes[0], claim


def brute(rows, claims):
    """Rows (leaf, subroot, root, proof, folded root), sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in langs:
        rs = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append((rs, [leaf(r) for r in rs]))
    subroots = [climb(t, 0, t[0])[1] for _, t in trees]
    out = []
    for i, (rs, leaves) in enumerate(trees):
        for j, r in enumerate(rs):
            a, sub, c = climb(leaves, j, claims(r))
            b, root, c = climb(subroots, i, c)
            out.append((r["doc_id"], leaves[j], sub, root, h(*a, *b), c))
    return sorted(out, key=str)


def built(df, claim=None):
    m = merkle.manifest(df, claim=claim)
    return sorted(map(tuple, m.select("doc_id", "leaf", "subroot", "root", F.sha2(
        F.array_join("path", ""), 256), "folded_root").collect()), key=str)


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_odd_rows_ties_and_block_borders(docs_of, odd_rows, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BITS", bits)
    rows = odd_rows + [(100 + i % 17, f"t{i}", "en", "a") for i in range(36)]
    df = docs_of(rows)
    plain = [r.asDict() for r in df.collect()]
    assert built(df) == brute(plain, leaf)


def test_changed_rows_do_not_fold_to_the_root(docs_of):
    df = docs_of([(i, f"text {i}", "de" if i % 3 else None, "a") for i in range(40)])
    shown = merkle.leaf_of(*[F.col(f) + 1 if f == "n_chars" else F.col(f) for f in merkle.FIELDS])
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    plain = [r.asDict() for r in df.collect()]

    def claims(r):
        hit = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        return leaf(r | {"n_chars": r["n_chars"] + 1} if hit else r)

    got = built(df, F.when(odd, shown))
    assert got == brute(plain, claims)
    assert any(r[3] != r[5] for r in got) and any(r[3] == r[5] for r in got)


def test_one_document_and_none(docs_of):
    one = docs_of([(7, "only", "en", "a")])
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.path == []
    assert merkle.manifest(docs_of([])).collect() == []


def test_names_with_dots_and_clashes(docs_of):
    df = docs_of([(i, f"t{i}", "en", "a") for i in range(5)])
    names = ["part", "pos", "n", "node", "block", "rows", "level_0", "a.b", "PID", "copy", "root"]
    more = df.select("*", *[F.lit(1).alias(n) for n in names])
    assert built(more) == built(df)
