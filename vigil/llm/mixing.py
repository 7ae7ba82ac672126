"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a share of a total budget of words by its weight.  A target
above ``max_epochs`` times the words of its source stops there, and the
excess goes to the others by weight (one level ``L`` with
``target = min(max_epochs * words, L * weight)``, found from the sources
sorted by the level at which each stops).

Within a source whole epochs come first: every document is taken
``floor(target / words)`` times.  The rest of the target is drawn without
replacement with the quality of a document as its weight: documents are
sorted by the exponential key ``-ln(u) / quality`` and taken until their
running sum of words reaches the rest.  The last one is taken in part, so the
taken words of a source are its target rounded down to a whole word.

The running sum needs no sort of a whole source.  Keys map to ``buckets``
equal slices of ``1 - exp(-key)``; the words of each (source, slice) are summed
first, slices below the one that holds the boundary are taken whole, and
only the boundary slice of each source is sorted.

Defined cases: a null or blank text has size 0 and takes 0 words; a null source
is a source of its own, last in order; rows that repeat a document (same id
and same text) are documents of their own, and ties between their keys are
broken by a fixed row number; an empty table gives no rows.  A source without
words has target 0.  Columns of the input other than those named are
carried along untouched by ``mix_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import (SALTS, column, salted, small, stored, symbols_in,
                              text_or_empty, words_of)

#: Weights by the order of the sources, repeating.
WEIGHTS = (3.0, 1.0, 2.0)


def size_in_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def quality_of(text: Column) -> Column:
    """Quality in [0.5, 1]: one less the share of symbols among the
    non-space characters, halved at worst.  An empty text has quality 1."""
    solid = F.length(F.array_join(words_of(text), ""))
    plain = solid - symbols_in(text)
    return F.when(solid == 0, F.lit(1.0)).otherwise(
        F.lit(0.5) + F.lit(0.5) * plain.cast("double") / solid.cast("double"))


def uniform_of(*parts: Column) -> Column:
    """A number in (0, 1) from an md5 of the parts, alike on every run."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, share: float = 1.5, max_epochs: float = 2.0,
                   weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Targets of ``sizes`` (source, source_size: one row per source).

    The windows below run over one row per source, never over documents."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.lit(float(max_epochs)) * F.col("source_size").cast("double")
    t = sizes.withColumn("weight", w).withColumn("cap", cap)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(),
                              F.col("source"))
    below = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    t = (t.withColumn("capped", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
          .withColumn("weight_left", F.sum("weight").over(whole)
                      - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
          .withColumn("budget", F.lit(float(share))
                      * F.sum("source_size").over(whole).cast("double"))
          .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("weight_left")))
    # the level lies between the stops of the source before and of its own
    stop = F.col("cap") / F.col("weight")
    fits = F.when((F.col("level") <= stop)
                  & (F.col("level") >= F.coalesce(F.lag(stop).over(by_level), F.lit(0.0))),
                  F.col("level"))
    t = t.withColumn("level", F.min(fits).over(whole))
    return t.select("source", "source_size", F.coalesce(
        F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def _same_source(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def mix(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0,
        weights: tuple[float, ...] = WEIGHTS, buckets: int = 1024, seed: int = 0,
        text: str = "text", doc_id: str = "doc_id", source: str = "source",
        row: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs,
    taken and ``row_no`` (the given ``row``, else null)."""
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        size_in_words(F.col(text)).alias("size"), quality_of(F.col(text)).alias("quality"),
        F.md5(text_or_empty(F.col(text)).cast("binary")).alias("text_md5"),
        (row if row is not None else F.lit(None)).cast("long").alias("row_no"))
    # the copy number tells repeated rows apart; it is fixed by writing it once
    narrow = stored(narrow.withColumn("copy", F.monotonically_increasing_id()), "mix")
    narrow = (narrow
              .withColumn("key", -F.log(uniform_of(F.lit(seed), F.col("doc_id"),
                                                   F.col("text_md5"))) / F.col("quality"))
              .withColumn("bucket", F.least(
                  F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.lit(buckets)),
                  F.lit(buckets - 1)).cast("int"))
              .withColumn("salt", F.pmod(F.xxhash64("copy"), F.lit(SALTS)).cast("int")))
    slices = narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sizes = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = (source_targets(sizes, share, max_epochs, weights)
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
                   F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
               .withColumn("rest", F.floor(F.col("target")).cast("long")
                           - F.col("epochs") * F.col("source_size")))
    running = Window.partitionBy("source").orderBy("bucket")
    t, s = targets.alias("t"), slices.alias("s")
    # the slice in which the running sum of words passes the rest
    edge = (s.withColumn("upto", F.sum("words").over(running)).alias("s")
            .join(t, _same_source(F.col("s.source"), F.col("t.source")))
            .filter(F.col("upto") >= F.col("rest"))
            .groupBy(F.col("t.source").alias("source"))
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")))
                 .alias("edge")))
    plan = (t.join(edge.alias("e"), _same_source(F.col("t.source"), F.col("e.source")), "left")
            .select(F.col("t.source").alias("t_source"), "source_size", "target", "epochs", "rest",
                    F.col("edge.bucket").alias("edge_bucket"), F.col("edge.before").alias("before")))
    plan = salted(plan).withColumnRenamed("salt", "t_salt")
    rows = (narrow.join(plan, _same_source(F.col("source"), F.col("t_source"))
                        & (F.col("salt") == F.col("t_salt")))
            .withColumn("at_edge", F.col("bucket") == F.col("edge_bucket")))
    within = (Window.partitionBy("source").orderBy("key", "doc_id", "copy")
              .rowsBetween(Window.unboundedPreceding, -1))
    edge_rows = rows.filter("at_edge").withColumn(
        "ahead", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    edge_rows = edge_rows.withColumn("part", F.greatest(F.lit(0), F.least(
        F.col("size"), F.col("rest") - F.col("ahead"))))
    other = rows.filter("not at_edge or at_edge is null").withColumn("part", F.when(
        F.col("bucket") < F.col("edge_bucket"), F.col("size")).otherwise(F.lit(0)))
    cols = ["doc_id", "source", "size", "source_size", "target", "epochs", "row_no",
            (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken")]
    return edge_rows.select(*cols).unionByName(other.select(*cols))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space kept."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mix_rows(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0,
             weights: tuple[float, ...] = WEIGHTS, buckets: int = 1024, seed: int = 0,
             text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix as documents: a row for each whole copy taken, and one with the
    first words of the document that is taken in part (its ``n_chars``, if
    there is such a column, follows the text).  Documents of which the mix
    takes nothing are left out, those without words too.

    The keys are those of ``mix``.  What a source takes is one row of a plan: its
    epochs, the slice that holds the boundary, and in it the finer slice
    (``buckets`` a slice) that does.  Every row compares its own slices with
    the plan; only rows of the finer boundary slice are sorted, so texts
    stay where they are.  Equal rows share a key: any of them may be cut."""
    row = F.struct(*[column(c).alias(c) for c in docs.columns])
    body = F.col("d").getField(text)
    quantile = F.lit(1.0) - F.exp(F.log(uniform_of(
        F.lit(seed), F.col("d").getField(doc_id),
        F.md5(text_or_empty(body).cast("binary")))) / quality_of(body))
    fine = F.least(F.floor(quantile * F.lit(buckets * buckets)), F.lit(buckets * buckets - 1))
    rows = docs.select(row.alias("d")).select(
        "d", F.col("d").getField(source).alias("source"), size_in_words(body).alias("size"),
        fine.cast("long").alias("fine")).withColumn(
            "bucket", F.floor(F.col("fine") / F.lit(buckets)).cast("long"))
    narrow = stored(rows.groupBy("source", "bucket", "fine").agg(F.sum("size").alias("words")),
                    "mix-slices")
    slices = narrow.groupBy("source", "bucket").agg(F.sum("words").alias("words"))
    sizes = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = (source_targets(sizes, share, max_epochs, weights)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
                F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("rest", F.floor(F.col("target")).cast("long")
                        - F.col("epochs") * F.col("source_size")))
    plan = _edge(stored(plan.withColumn("before", F.lit(0).cast("long")), "mix-plan"), slices,
                 "bucket")
    at_edge = narrow.alias("n").join(
        small(plan, "mix-edges").select(F.col("source").alias("p"), "edge_bucket"),
        _same_source(F.col("n.source"), F.col("p")) & (F.col("bucket") == F.col("edge_bucket")))
    plan = _edge(plan, at_edge.select("source", "fine", "words"), "fine")
    plan = plan.select(F.col("source").alias("p_source"), "epochs", "rest", "before", "edge_fine")
    got = rows.join(small(plan, "mix-plan"), _same_source(F.col("source"), F.col("p_source")))
    below = F.when(F.col("edge_fine").isNull() | (F.col("fine") < F.col("edge_fine")),
                   F.col("size")).otherwise(F.lit(0))
    within = (Window.partitionBy("source").orderBy("quantile", F.col("d").getField(doc_id))
              .rowsBetween(Window.unboundedPreceding, -1))
    edge = (got.filter("fine = edge_fine").withColumn("quantile", quantile)
            .withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
            .withColumn("part", F.greatest(F.lit(0), F.least(
                F.col("size"), F.col("rest") - F.col("ahead")))))
    other = got.filter("edge_fine is null or fine <> edge_fine").withColumn("part", below)
    cols = ["d", "size", "epochs", "part"]
    both = edge.select(*cols).unionByName(other.select(*cols))
    takes = F.filter(F.array_append(F.array_repeat(F.col("size"), F.col("epochs").cast("int")),
                                    F.col("part").cast("long")), lambda x: x > 0)
    out = both.select("d", "size", F.explode(takes).alias("take"))
    cut = F.when(F.col("take") < F.col("size"), first_words(body, F.col("take"))).otherwise(body)
    changed = {text: cut}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(
            F.col("take") < F.col("size"), F.length(cut).cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("d").getField("n_chars"))
    return out.select(*[changed.get(c, F.col("d").getField(c)).alias(c) for c in docs.columns])


def _edge(plan: DataFrame, slices: DataFrame, name: str) -> DataFrame:
    """``plan`` with ``edge_<name>``: the slice of each source in which the running
    sum of words passes its rest, and ``before``: the words ahead of it.  The
    windows run over slices, at most ``buckets`` a source."""
    running = Window.partitionBy("s_source").orderBy(name)
    sums = slices.select(F.col("source").alias("s_source"), name, "words").withColumn(
        "upto", F.sum("words").over(running))
    known = plan.select(F.col("source").alias("k_source"), "rest", F.col("before").alias("base"))
    found = (sums.join(known, _same_source(F.col("s_source"), F.col("k_source")))
             .withColumn("upto", F.col("upto") + F.col("base")).filter("upto >= rest")
             .groupBy(F.col("s_source").alias("e_source"))
             .agg(F.min(F.struct(name, (F.col("upto") - F.col("words")).alias("before")))
                  .alias("e")))
    kept = [c for c in plan.columns if c != "before"]
    return plan.join(found, _same_source(F.col("source"), F.col("e_source")), "left").select(
        *kept, F.coalesce("e.before", "before").alias("before"), F.col(f"e.{name}").alias(f"edge_{name}"))
