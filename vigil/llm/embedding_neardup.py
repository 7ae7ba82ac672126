"""Embedding near-duplicates by NN-descent.

Equal vectors of one label are one node, with the number of its copies.  A
neighbour graph starts from random projections: nodes are sorted by a
signature of random hyperplanes, in several tables, and meet those near them in
the order.  Then the graph is refined: all members of a node's neighbour list
meet each other (neighbours of neighbours), and what is near goes to their
lists.  Lists hold the ``k`` nearest of at least ``floor``; a list whose ``k``
entries all link is saturated, and its ``k`` grows fourfold until all links
found so far fit, so that none is dropped.  Of the large lists only some are
joined in a round, as their members see each other in several.  A list that
grew is due until it has met others without growing; one that waits is drawn
with a chance that grows fourfold each round.  Rounds go on until no list is
due, the large ones twice.

The recall is audited against the exact neighbours of ``audit`` nodes drawn by
hash (a stated set against all rows, in blocks).  It is the mean over the
audited nodes that have links, so that a node with one link counts as much as
one of a large group.  While it is below ``recall``, the graph is enlarged from
new tables, twice as many each time, as a vector with a single neighbour is
found by the tables only; if it is still below in the end, that is an error.
Edges of at least ``threshold`` are kept, in double precision, so that no link
is false.

Defined cases: vectors that are null, empty, zero or have null or non-finite
components, and those with a null label, link with nothing and are their own
component; vectors of different length do not link; copies link to each other;
a null id takes part, but does not name a component unless all ids of it are
null; ties are in order of the node; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import stored
from vigil.llm.components import connected_components

#: Rows that meet in the order of a table, half of them anew at each step.
MEET = 256

#: ``old`` tells the list of a node from partial lists that are to be added;
#: ``due`` is 0, or one more than the rounds that a list has waited for its join.
LISTS = "node long, nbrs array<long>, sims array<double>, k int, old boolean, due int"

#: Lists of one neighbour have no others to bring together.
DUE = "due > 0 AND size(nbrs) > 1"


def usable(vector: Column, label: Column) -> Column:
    """True if the vector can link."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & vector.isNotNull() & ~odd & some, F.lit(False))


def nodes_of(vectors: DataFrame, vector: str, label: str, vec_id: str) -> DataFrame:
    """One row per distinct label and vector: node, label, vec, copies, least."""
    good = vectors.filter(usable(F.col(vector), F.col(label)))
    classes = good.groupBy(F.col(label).alias("label"), F.col(vector).alias("vec")).agg(
        F.count(F.lit(1)).alias("copies"), F.min(vec_id).alias("least"))
    return stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")


def unit_rows(column: pa.Array) -> list[np.ndarray]:
    """Unit vectors in double precision."""
    out = []
    for x in column.to_numpy(zero_copy_only=False):
        v = np.asarray(x, np.float64)
        v = v / np.abs(v).max()  # neither overflow nor underflow in the norm
        out.append(v / np.sqrt(v @ v))
    return out


def _meet(units: np.ndarray, nodes: np.ndarray, floor: float, threshold: float, k: int,
          known: int = 0):
    """(node, neighbours, cosines) for all rows: all that link, and others up to
    ``k``; pairs among the first ``known`` rows have met before."""
    sims = np.clip(units @ units.T, -1.0, 1.0)
    np.fill_diagonal(sims, -2.0)
    if known:
        sims[:known, :known] = -2.0
    for i in np.flatnonzero(sims.max(axis=1, initial=-2.0) >= floor):
        near = np.flatnonzero(sims[i] >= floor)
        near = near[np.lexsort((nodes[near], -sims[i, near]))]
        near = near[:max(k, int((sims[i, near] >= threshold).sum()))]
        yield int(nodes[i]), nodes[near], sims[i, near]


def _lists_batch(rows: list, k: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "node": pa.array([r[0] for r in rows], pa.int64()),
        "nbrs": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
        "sims": pa.array([r[2] for r in rows], pa.list_(pa.float64())),
        "k": pa.array([k] * len(rows), pa.int32()),
        "old": pa.array([False] * len(rows), pa.bool_()),
        "due": pa.array([0] * len(rows), pa.int32())})


def first_lists(nodes: DataFrame, tables: int, seed: int, floor: float, threshold: float, k: int,
                bits: int = 30) -> DataFrame:
    """Partial lists from random projections; a node may have several rows."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_rows(batch.column(2))
            sizes = np.array([len(u) for u in units])
            for t in range(tables):
                signs = np.zeros(len(units), np.int64)
                for size in np.unique(sizes):
                    planes = np.random.default_rng([seed, t, int(size)]).normal(size=(size, bits))
                    mine = np.flatnonzero(sizes == size)
                    on = np.stack([units[i] for i in mine]) @ planes > 0
                    signs[mine] = on @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(units), pa.int32()), batch.column(1),
                     pa.array(sizes.astype(np.int32)), pa.array(signs), batch.column(0),
                     batch.column(2)], ["t", "label", "size", "signs", "node", "vec"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        known = 0

        def found(rows: list) -> Iterator[pa.RecordBatch]:
            got = list(_meet(np.stack([r[1] for r in rows]), np.array([r[0] for r in rows]),
                             floor, threshold, k, known))
            if got:
                yield _lists_batch(got, k)

        for batch in batches:
            units = unit_rows(batch.column(5))
            keys = zip(*(batch.column(c).to_pylist() for c in (0, 1, 2)))
            for row_key, node, unit in zip(keys, batch.column(4).to_pylist(), units):
                if row_key != key:
                    if len(held) > known:
                        yield from found(held)
                    held, key, known = [], row_key, 0
                held.append((node, unit))
                if len(held) == MEET:
                    yield from found(held)
                    held = held[MEET // 2:]
                    known = len(held)
        if len(held) > known:
            yield from found(held)

    label = nodes.schema["label"].dataType.simpleString()
    vec = nodes.schema["vec"].dataType.simpleString()
    rows = nodes.select("node", "label", "vec").mapInArrow(
        spread, f"t int, label {label}, size int, signs long, node long, vec {vec}")
    order = ["t", "label", "size", "signs", "node"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(meet, LISTS)


def merged_lists(rows: DataFrame, threshold: float) -> DataFrame:
    """One list per node, with all links of the rows.  It is due if it has more
    than the old one or was saturated, or if it was due and met none."""

    def merge(group: pa.Table) -> pa.Table:
        old = group.filter(group.column("old"))
        before = len(old.column("nbrs")[0]) if len(old) else 0
        waited = old.column("due")[0].as_py() if len(old) == len(group) else 0
        k = max(group.column("k").to_pylist())
        nbrs = np.asarray(pc.list_flatten(group.column("nbrs")))
        sims = np.asarray(pc.list_flatten(group.column("sims")))
        nbrs, place = np.unique(nbrs, return_index=True)
        sims = sims[place]
        links = int((sims >= threshold).sum())
        full = links >= k
        while links >= k:
            k *= 4
        order = np.lexsort((nbrs, -sims))[:k]
        due = 1 if full or len(order) > before else waited + 1 if waited else 0
        return pa.Table.from_batches([pa.RecordBatch.from_pydict({
            "node": group.column("node").combine_chunks()[:1],
            "nbrs": pa.array([nbrs[order]], pa.list_(pa.int64())),
            "sims": pa.array([sims[order]], pa.list_(pa.float64())),
            "k": pa.array([k], pa.int32()),
            "old": pa.array([True], pa.bool_()),
            "due": pa.array([due], pa.int32())})])

    return rows.groupBy("node").applyInArrow(merge, LISTS)


def join_neighbours(lists: DataFrame, nodes: DataFrame, floor: float, threshold: float, turn: int,
                    pivots: int = 10) -> DataFrame:
    """Partial lists of all that meet in a list that is due.  A list joins with
    a chance of ``pivots`` in its length, fourfold for each turn that it has
    waited, drawn by hash for each turn."""
    draw = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
    chosen = lists.filter(DUE).filter(
        draw < F.lit(float(pivots)) * F.pow(F.lit(4.0), F.col("due") - 1) / F.size("nbrs"))
    members = chosen.select(F.col("node").alias("pivot"), "k", F.explode(
        F.array_append("nbrs", F.col("node"))).alias("node"))
    rows = members.join(nodes.select("node", "vec"), "node").select("pivot", "k", "node", "vec")

    def meet(group: pa.Table) -> pa.Table:
        k = max(group.column("k").to_pylist())
        units = np.stack(unit_rows(group.column("vec").combine_chunks()))
        got = list(_meet(units, np.asarray(group.column("node")), floor, threshold, k))
        return pa.Table.from_batches([_lists_batch(got, k)])

    return rows.groupBy("pivot").applyInArrow(meet, LISTS)


def exact_counts(nodes: DataFrame, audit: int, threshold: float) -> DataFrame:
    """(node, n): the exact number of links of at most ``audit`` nodes."""
    picked = nodes.select("node", "label", "vec").orderBy(F.xxhash64("node"), "node").limit(audit)
    queries: dict = {}
    for node, label, vec in picked.collect():  # at most ``audit`` rows
        v = np.asarray(vec, np.float64)
        v = v / np.abs(v).max()
        queries.setdefault((label, len(v)), []).append((node, v / np.sqrt(v @ v)))
    asked = {key: (np.array([n for n, _ in q]), np.stack([v for _, v in q]))
             for key, q in queries.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict = {}
            for node, label, unit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         unit_rows(batch.column(2))):
                rows.setdefault((label, len(unit)), []).append((node, unit))
            ids, totals = [], []
            for key, mine in rows.items():
                if key in asked:
                    names, units = asked[key]
                    near = units @ np.stack([u for _, u in mine]).T >= threshold
                    near &= names[:, None] != np.array([n for n, _ in mine])[None, :]
                    ids += names.tolist()
                    totals += near.sum(axis=1).tolist()
            yield pa.RecordBatch.from_pydict({"node": pa.array(ids, pa.int64()),
                                              "n": pa.array(totals, pa.int64())})

    return (nodes.select("node", "label", "vec").mapInArrow(count, "node long, n long")
            .groupBy("node").agg(F.sum("n").alias("n")))


def mean_recall(truth: DataFrame, lists: DataFrame, threshold: float) -> float:
    """Mean share of the exact links (``node``, ``n``) that the lists have, over
    the nodes with links; 1 if there are none."""
    found = F.size(F.filter("sims", lambda s: s >= threshold)).cast("long")
    share = F.least(F.coalesce("found", F.lit(0)), "n") / F.col("n")
    return truth.filter("n > 0").join(lists.select("node", found.alias("found")), "node", "left").agg(
        F.coalesce(F.avg(share), F.lit(1.0))).first()[0]


def neighbour_lists(nodes: DataFrame, threshold: float = 0.98, floor: float = 0.95, k: int = 32,
                    tables: int = 8, audit: int = 512, recall: float = 0.999, turns: int = 30,
                    restarts: int = 4, pivots: int = 10) -> DataFrame:
    """The refined lists; ``restarts`` bounds the enlargements after an audit."""
    # a pair within rounding of the threshold is not missed
    truth = stored(exact_counts(nodes, audit, threshold + 1e-9), "audit")
    lists = None
    for restart in range(restarts + 1):
        parts = first_lists(nodes, tables << restart, restart, floor, threshold, k)
        if lists is not None:
            parts = parts.unionByName(lists)
        lists = stored(merged_lists(parts, threshold), "lists")
        quiet = 0
        for turn in range(turns):
            if lists.filter(DUE).limit(1).count() == 0:
                # the lists of which only some joined are drawn once more
                quiet += 1
                lists = lists.withColumn("due", (F.size("nbrs") > pivots).cast("int"))
                if quiet == 2 or lists.filter(DUE).limit(1).count() == 0:
                    break
            more = join_neighbours(lists, nodes, floor, threshold, turn, pivots)
            lists = stored(merged_lists(lists.unionByName(more), threshold), "lists")
        got = mean_recall(truth, lists, threshold)
        if got >= recall:
            return lists
    raise RuntimeError(f"mean recall {got:.5f} of {audit} audited nodes is below {recall} after "
                       f"{restarts} restarts")


def link_vectors(vectors: DataFrame, vector: str = "embedding", label: str = "label",
                 vec_id: str = "vec_id", threshold: float = 0.98, **options) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    nodes = nodes_of(vectors, vector, label, vec_id)
    lists = neighbour_lists(nodes, threshold, **options)
    near = (lists.select(F.col("node").alias("u"), F.explode(F.arrays_zip("nbrs", "sims")).alias("e"))
            .filter(F.col("e.sims") >= threshold)
            .select(F.least("u", "e.nbrs").alias("u"), F.greatest("u", "e.nbrs").alias("v"))
            .distinct())
    near = stored(near, "links")
    both = near.unionByName(near.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = (both.join(nodes.select(F.col("node").alias("v"), "copies"), "v")
              .groupBy(F.col("u").alias("node")).agg(F.sum("copies").alias("others")))
    parts = connected_components(near)
    classes = stored(nodes.join(others, "node", "left").join(parts, "node", "left").select(
        "label", "vec", "least", (F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
        .alias("n_links"), F.coalesce("component", "node").alias("part")), "vector-classes")
    least = classes.groupBy("part").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "part").select(
        F.col("label").alias("c_label"), F.col("vec").alias("c_vec"), "n_links", "component_id")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("r_label"),
                          F.col(vector).alias("r_vec"))
    good = usable(F.col("r_vec"), F.col("r_label"))
    linked = rows.filter(good).join(classes, (F.col("r_label") == F.col("c_label"))
                                    & (F.col("r_vec") == F.col("c_vec"))).select(
        "vec_id", F.col("n_links").cast("long"), F.col("component_id").cast("long"))
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                      F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept",
                                                F.col("vec_id").eqNullSafe(F.col("component_id")))
