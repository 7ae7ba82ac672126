"""A Merkle manifest of a dataset, kept as one hex string per level and block.

Every document is a leaf: the SHA-256 of its fields, each written as its
length in bytes, a colon and the value.  The leaves of a group (a language)
stand in the order of their ids; two neighbours become the hash of their
digests until one node is left, the root of the group.  A last node without a
neighbour is hashed alone.  The roots of the groups, in order, are joined to
one root the same way.

A tree is cut into aligned blocks of ``2 ** BITS`` nodes.  A block is one row:
each of its levels is one string of concatenated hex digests, and the parents
are the hashes of its substrings of twice the width of a digest.  The top of
every block is a node of the next tree, which is cut alike, so there are as
many rounds as blocks fit into each other (10**10 leaves: five).  The
siblings that prove a leaf are the substrings beside its path, block by block.

The place of a leaf in its group comes from a range partitioning by (group,
id, leaf): rows are sorted within their partition, counts per partition and
group (at most partitions + groups rows) give the offsets.  No task holds more
than a range partition or a block.

Defined cases: a null field is ``-``; a null group is a group of its own,
first in order; null ids come first; rows with the same id are ordered by
their leaf, and fully equal rows are leaves of their own; a single leaf is the
root of its group; an empty table gives no rows; columns other than those
named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import column, small, stored

#: A block holds 2 ** BITS nodes, a digest WIDTH hex digits.
BITS = 8
WIDTH = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(value: Column) -> Column:
    """``-`` for null, else bytes, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*fields: Column) -> Column:
    """The digest of a row from its fields in order."""
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def _part(group: Column) -> Column:
    """A key without null that sorts as the group does, null first."""
    text = group.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), text))


def _numbered(rows: DataFrame, keys: tuple[str, ...], carried: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``pos`` (place in the order of ``keys`` within ``part``)
    and ``n`` (rows of the part)."""
    order = ("part", *keys)
    # equal rows may stand in any order, but must not share one partition
    spread = rows.withColumn("copy", F.monotonically_increasing_id())
    ranged = stored(spread.repartitionByRange(*order, "copy").sortWithinPartitions(*order, "copy")
                    .select("part", *carried, F.monotonically_increasing_id().alias("seq"))
                    .withColumn("pid", F.shiftright("seq", 33)), "merkle-rows")
    per_part = Window.partitionBy("part")
    before = per_part.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = (ranged.groupBy("part", "pid")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first"))
            .withColumn("shift", F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first"))
            .withColumn("n", F.sum("rows").over(per_part))
            .select("part", "pid", "shift", "n"))
    return (ranged.join(small(runs, "merkle-runs"), ["part", "pid"])
            .select("part", (F.col("seq") + F.col("shift")).alias("pos"), "n", *carried))


def _parents(level: Column) -> Column:
    """The level above, from substrings of two digests (the last: one)."""
    width = 2 * WIDTH
    pairs = F.floor((F.octet_length(level) + F.lit(width - 1)) / F.lit(width)).cast("int")
    hashes = F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.sha2(
        F.substring(level, i * width + 1, F.lit(width)), 256))
    return F.array_join(hashes, "").cast("binary")


def _blocks(nodes: DataFrame, carried: tuple[str, ...], name: str) -> DataFrame:
    """One row per block of ``nodes`` (part, pos, n, node): part, n, block, rows
    (the carried columns), level_0 to level_BITS.  A part of one block stops
    at its root, so levels above that repeat it."""
    blocks = nodes.groupBy("part", "n", F.shiftright("pos", BITS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", *carried))).alias("rows"))
    blocks = blocks.withColumn("level_0", F.array_join(
        F.transform("rows", lambda r: r["node"]), "").cast("binary"))
    for j in range(BITS):
        below = F.col(f"level_{j}")
        blocks = blocks.withColumn(f"level_{j + 1}", F.when(
            F.col("n") > F.lit(1 << j), _parents(below)).otherwise(below))
    kept = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in ("pos", *carried)]))
    return stored(blocks.withColumn("rows", kept), name)


def _steps(n: Column) -> Column:
    """Levels that a block of a part of ``n`` nodes climbs."""
    return sum((F.when(n > F.lit(1 << j), 1).otherwise(0) for j in range(BITS)), F.lit(0))


def _digest(level: Column, index: Column) -> Column:
    """The index-th digest of a level; empty beyond its end."""
    return F.substring(level, index * WIDTH + 1, F.lit(WIDTH)).cast("string")


def _at(pos: Column) -> Column:
    """The place of a node in its block."""
    return F.pmod(pos, F.lit(1 << BITS)).cast("int")


def _siblings(pos: Column) -> Column:
    """Siblings of a node on its way up through its block, empty for none."""
    beside = [_digest(F.col(f"level_{j}"), F.shiftright(_at(pos), j).bitwiseXOR(F.lit(1)))
              for j in range(BITS)]
    return F.slice(F.array(*beside), F.lit(1), F.col("steps"))


def _each(blocks: DataFrame, *kept: str) -> DataFrame:
    """One row per node of ``blocks``: its carried columns ``r``, its digest
    ``node`` and its ``path`` to the root of its part."""
    made = F.transform("rows", lambda r: F.struct(
        r.alias("r"), _digest(F.col("level_0"), _at(r["pos"])).alias("node"),
        F.concat(_siblings(r["pos"]), F.col("above")).alias("path")))
    return blocks.select(*kept, F.explode(made).alias("m")).select(*kept, "m.*")


def _climb(nodes: DataFrame, carried: tuple[str, ...], name: str):
    """(blocks with ``above``: siblings from the top of the block to the root of
    its part, empty for none; roots: part, root)."""
    blocks = _blocks(nodes, carried, name).withColumn("steps", _steps(F.col("n")))
    top = F.col(f"level_{BITS}").cast("string")
    most = blocks.agg(F.max("n")).first()[0] or 0
    if most <= 1 << BITS:
        return (blocks.withColumn("above", F.array().cast("array<string>")),
                blocks.select("part", top.alias("root")))
    tops = blocks.select("part", F.col("block").alias("pos"),
                         F.ceil(F.col("n") / F.lit(float(1 << BITS))).cast("long").alias("n"),
                         top.alias("node"))
    upper, roots = _climb(tops, (), name)
    paths = _each(upper, "part").select("part", F.col("r.pos").alias("block"),
                                        F.col("path").alias("above"))
    return blocks.join(paths, ["part", "block"]), roots


def _fold(claim: Column, path: Column, pos: Column, height: Column, group_pos: Column) -> Column:
    """The root that a leaf and its siblings give; bit j of the place says on
    which side the sibling of level j stands."""
    def odd(at: Column, j: Column) -> Column:
        return F.pmod(F.floor(at / F.pow(F.lit(2.0), j)), F.lit(2)) == 1

    sided = F.transform(path, lambda s, j: F.struct(
        s.alias("s"), F.when(j < height, odd(pos, j)).otherwise(odd(group_pos, j - height))
        .alias("left")))
    return F.aggregate(sided, claim, lambda acc, x: F.sha2(
        F.when(x["left"], F.concat(x["s"], acc)).otherwise(F.concat(acc, x["s"])), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang",
             doc_id: str = "doc_id", claim: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, group_pos and pos (places of the
    group and of the leaf in it), path (siblings from the leaf to the root,
    empty where a node has none), subroot, root, claim (null: the leaf) and
    folded_root (from claim and path).  ``claim`` is the digest, of the columns
    of ``docs``, under which a document is to be proved."""
    rows = docs.select(
        _part(column(group)).alias("part"), column(doc_id).alias("id"),
        leaf_of(*[column(f) for f in fields]).alias("node"),
        (claim if claim is not None else F.lit(None).cast("string")).alias("claim"))
    rows = rows.withColumn("claim", F.when(F.col("claim") != F.col("node"), F.col("claim")))
    leaves = _numbered(stored(rows, "merkle-leaves"), ("id", "node"), ("id", "node", "claim"))
    blocks, subroots = _climb(leaves, ("id", "claim"), "merkle-blocks")
    # the groups are the leaves of the last tree
    groups = subroots.select(F.lit("").alias("part"), F.col("part").alias("id"),
                             F.col("root").alias("node"))
    tree, roots = _climb(_numbered(groups, ("id",), ("id", "node")), ("id",), "merkle-groups")
    tops = (_each(tree.join(F.broadcast(roots), "part"), "root")  # roots: the one row of all
            .select(F.col("r.id").alias("part"), F.col("r.pos").alias("group_pos"), "root",
                    F.col("node").alias("subroot"), F.col("path").alias("group_path")))
    blocks = blocks.join(small(tops, "merkle-tops"), "part")
    rows = _each(blocks, "subroot", "root", "group_pos", "group_path")
    rows = rows.select(
        F.col("r.id").alias("doc_id"), F.col("node").alias("leaf"), "group_pos", "r.pos", "subroot",
        "root", F.coalesce("r.claim", "node").alias("claim"), F.size("path").alias("height"),
        F.concat("path", "group_path").alias("path"))
    return rows.select(
        "doc_id", "leaf", "group_pos", "pos", "path", "subroot", "root", "claim",
        _fold(F.col("claim"), F.col("path"), F.col("pos"), F.col("height"),
              F.col("group_pos")).alias("folded_root"))
