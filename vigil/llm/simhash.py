"""SimHash near-duplicates: fingerprints joined with themselves as binary tries.

A fingerprint has a bit set if it is set in over half of the XXH64 values
(seed 42) of the text's word shingles.  Two fingerprints link if they differ
in at most ``max_bits`` bits.

The self-join descends a binary trie by pairs of nodes, adds up the bits in
which the two paths differ, and leaves a pair as soon as the sum exceeds the
budget.  To spread over a cluster the descent starts below shared paths: with
``max_bits + 1`` blocks of bits, two near fingerprints agree in one block at
least, so there is one trie for each block with that block on top, and on top
no difference is spent.  The subtrie below a path is a bucket, joined by one
task.  A bucket of more than ``cap`` fingerprints is split in the same way by
its remaining bits, again and again, until it is small; as fingerprints are
distinct, a bucket with ten bits left holds 1024 at most.  No pair is
lost by this.  A bucket gives the edges of a spanning forest, not all pairs.

Defined cases: a null or blank text has fingerprint zero and links like any
other; a text shorter than a shingle is one shingle; repeated rows and exact
copies have one fingerprint and are joined once; a null id takes part, and
counts as larger than any id when the component's smallest id is taken (a
component of null ids has a null id); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import column, new_name, stored, text_or_empty
from vigil.llm.components import connected_components, spanning_forest

SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()  # of bytes: ASCII letters and the six blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    step = 1 << 16  # bounds the bit matrix of a long text
    for k in range(0, len(starts), step):
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in
                         zip(starts[k:k + step], ends[k:k + step])), np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    over = counts * 2 > len(starts)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3,
                     keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """Columns ``keep`` (all, if not given) and the fingerprint as a signed long."""
    keep = docs.columns if keep is None else keep
    kept = [column(c) for c in keep]
    # Arrow functions take no names with dots, so columns go by their number
    names = [f"c{i}" for i in range(len(keep))]
    narrow = docs.select(*kept, text_or_empty(column(text)).cast("binary")).toDF(*names, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(len(names)).to_pylist()]
            fps = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], fps], [*names, "fp"])

    schema = narrow.drop("body").schema.add("fp", "long")
    return narrow.mapInArrow(run, schema).toDF(*keep, name)


def near_pairs(fps: list[int], max_bits: int) -> Iterator[tuple[int, int]]:
    """Pairs of distinct fingerprints (unsigned) within ``max_bits``: descent of
    a binary trie by pairs of nodes.  Bits in which all agree are skipped."""
    varying = 0
    for x in fps:
        varying |= x ^ fps[0]
    bits = [b for b in range(63, -1, -1) if varying >> b & 1]
    todo = [(fps, fps, 0, 0)]
    while todo:
        a, b, depth, spent = todo.pop()
        if a is b and len(a) < 2:
            continue
        if depth == len(bits) or len(a) * len(b) <= 16:
            # few leaves are left below: compare them
            for i, x in enumerate(a):
                for y in (a[i + 1:] if a is b else b):
                    if (x ^ y).bit_count() <= max_bits:
                        yield x, y
            continue
        bit = bits[depth]
        a0, a1 = [x for x in a if not x >> bit & 1], [x for x in a if x >> bit & 1]
        if a is b:
            todo += [(a0, a0, depth + 1, spent)] if a0 else []
            todo += [(a1, a1, depth + 1, spent)] if a1 else []
            if a0 and a1 and spent < max_bits:
                todo.append((a0, a1, depth + 1, spent + 1))
            continue
        b0, b1 = [x for x in b if not x >> bit & 1], [x for x in b if x >> bit & 1]
        for x, y, cost in ((a0, b0, 0), (a1, b1, 0), (a0, b1, 1), (a1, b0, 1)):
            if x and y and spent + cost <= max_bits:
                todo.append((x, y, depth + 1, spent + cost))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(free: list[int], n: int) -> list[int]:
    """Masks of ``n`` blocks of nearly equal size over the free bits."""
    cuts = [len(free) * k // n for k in range(n + 1)]
    return [sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def near_edges(fps: DataFrame, max_bits: int = 2, cap: int = 1024) -> DataFrame:
    """Edges (u, v) that connect the fingerprints of ``fps`` (one long column
    ``fp``, distinct) just as all links within ``max_bits`` do."""
    cap = max(cap, 1024)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for bucket in batch.column(0).to_pylist():
                mine = sorted(x & 0xFFFFFFFFFFFFFFFF for x in bucket)
                for x, root in spanning_forest(near_pairs(mine, max_bits)).items():
                    if x != root:
                        u.append(_signed(x))
                        v.append(_signed(root))
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()),
                                              "v": pa.array(v, pa.int64())})

    masks = {0: _blocks(list(range(64)), max_bits + 1)}
    entries = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    found = []
    while True:
        # each bucket splits by the blocks of its free bits
        children = F.create_map(*[x for m, c in masks.items() for x in (
            F.lit(_signed(m)), F.array(*[F.lit(_signed(m | b)) for b in c]))])
        entries = entries.select("fp", F.explode(F.element_at(children, F.col("mask")))
                                 .alias("mask"))
        if found:  # two paths may lead to one mask
            entries = entries.distinct()
        entries = entries.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = stored(entries.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
                       .filter("n > 1"), "simhash-buckets")
        small = entries.join(sizes.filter(f"n <= {cap}"), ["mask", "key"])
        buckets = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        found.append(buckets.mapInArrow(join, "u long, v long"))
        large = sizes.filter(f"n > {cap}")
        if large.limit(1).count() == 0:
            break
        entries = stored(entries.join(large, ["mask", "key"]).select("fp", "mask"), "simhash-large")
        masks = {m | b: _blocks([i for i in range(64) if not (m | b) >> i & 1], max_bits + 1)
                 for m, c in masks.items() for b in c}
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprint_components(fps: DataFrame, max_bits: int = 2, cap: int = 1024) -> DataFrame:
    """(fp, root) for each distinct ``fp`` of ``fps``: the root names its component."""
    distinct = stored(fps.select("fp").distinct(), "simhash-fps")
    linked = connected_components(near_edges(distinct, max_bits, cap))
    return (distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("component", "fp").alias("root")))


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                   max_bits: int = 2, cap: int = 1024) -> DataFrame:
    """doc_id, fp (signed long) and component_id for every row."""
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body"))
    rows = stored(with_fingerprint(ids, "body", shingle, ["doc_id"]), "simhash")
    roots = fingerprint_components(rows, max_bits, cap)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    both = stored(least.join(roots, "fp"), "simhash-roots")
    ids_of = both.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = both.join(ids_of, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
             max_bits: int = 2, cap: int = 1024) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row
    with the smallest id stays (null ids last, then the first written row)."""
    number, fp = new_name(docs, "dedup_row"), new_name(docs, "dedup_fp")
    base = with_fingerprint(docs.withColumn(number, F.monotonically_increasing_id()), text,
                            shingle, name=fp)
    base = stored(base, "simhash-docs")
    rows = base.select(F.col(fp).alias("fp"), F.struct(
        column(doc_id).isNull().alias("no_id"), column(doc_id).alias("id"),
        F.col(number).alias("row")).alias("pick"))
    roots = fingerprint_components(rows, max_bits, cap)
    picks = (rows.groupBy("fp").agg(F.min("pick").alias("pick")).join(roots, "fp")
             .groupBy("root").agg(F.min("pick").alias("pick"))
             .select(F.col("pick.row").alias(number)))
    return base.join(picks, number, "left_semi").select(*[column(c) for c in docs.columns])
