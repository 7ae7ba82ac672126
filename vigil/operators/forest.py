"""Fit of a large random forest on counted groups of rows.

A tree looks at a row's label and at the bins that its features lie in, no further.
Rows alike in these are counted together once, and the forest is grown by Spark's own
learner on the groups: what the levels cost goes by groups times trees, not by rows
times trees.  Split points, choices of features and gains are those of
``RandomForestClassifier``.  A row is drawn Poisson(rate) times for a tree; the draws
of n rows alike add up to Poisson(n * rate), which is what is drawn for their group,
so the forest is another one of the same distribution.

The learner's parts are called one by one, since ``fit`` takes no counts: a weight
would multiply one draw, which is not the sum of n of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _singleton(package, name: str):
    """A Scala object, for calls through the gateway."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


# The largest power of two that one entry stands for; more rows are several entries.
TOP = 12

# Rows times trees that a task draws for, at some 30 ns each.
DRAWS_PER_TASK = 200_000_000


def _bins(x, splits) -> list:
    """The bin of each feature of the array ``x``: how many split points lie below."""
    out = []
    for j, points in enumerate(splits):
        bin_ = F.lit(0)
        for p in points:
            bin_ = bin_ + (x[j] > F.lit(p)).cast("int")
        out.append(bin_.alias(f"__b{j}"))
    return out


def counted_groups(data: DataFrame, label: str, features: str, splits) -> DataFrame:
    """Rows counted by label and bins (``splits``: ascending split points of each
    feature): the label, ``__b0``, ... , ``__n``, and in ``features`` a vector that
    lies in these bins.  At most as many groups as rows or as combinations of bins."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    keys = [label, *[f"__b{j}" for j in range(len(splits))]]
    x = F.col("__x")
    got = data.select(F.col(label).cast("double").alias(label), vector_to_array(features).alias("__x")) \
        .select(label, *_bins(x, splits), *[x[j].alias(f"__x{j}") for j in range(len(splits))]) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                            *[F.min(f"__x{j}").alias(f"__x{j}") for j in range(len(splits))])
    return got.select(*keys, "__n", array_to_vector(
        F.array(*[f"__x{j}" for j in range(len(splits))])).alias(features))


def by_powers(groups: DataFrame) -> DataFrame:
    """Each group as powers of two (``__power``: the exponent, ``__part``: its place)
    that add up to its count, at most one entry per row."""
    parts = F.expr(f"concat(filter(sequence(0, {TOP - 1}), k -> (shiftright(__n, k) & 1) = 1), "
                   f"array_repeat({TOP}, CAST(shiftright(__n, {TOP}) AS INT)))")
    return groups.select("*", F.posexplode(parts).alias("__part", "__power"))


def drawn_entries(forest, entries: DataFrame, keys, seed: int, visits_per_task: int, in_bins) -> list:
    """What is drawn of the entries for each tree, as the learner's own RDDs, one per
    power.  ``in_bins`` turns entries into the learner's points.

    Entries are dealt out by hash and sorted, so the draws do not go by the layout of
    the rows; a task has at most about ``visits_per_task`` entries times trees, and
    draws for about ``DRAWS_PER_TASK`` rows times trees."""
    bagging = _singleton(entries.sparkSession._jvm.org.apache.spark.ml.tree.impl, "BaggedPoint")
    trees, unweighted = forest.getNumTrees(), getattr(bagging, "convertToBaggedRDD$default$5")()
    counts = entries.groupBy("__power").agg(F.count(F.lit(1)).alias("n")).collect()  # TOP + 1 rows at most
    drawn = []
    for power, n in sorted((r["__power"], r["n"]) for r in counts):
        tasks = max(-(-n * trees // visits_per_task), -(-n * trees * 2 ** power // DRAWS_PER_TASK))
        part = entries.where(F.col("__power") == power).repartition(tasks, *keys).sortWithinPartitions(*keys)
        drawn.append(bagging.convertToBaggedRDD(
            in_bins(part), forest.getSubsamplingRate() * 2.0 ** power, trees, True, unweighted,
            seed + 1_000_003 * power).toJavaRDD())
    return drawn


def fit_by_bins(forest, data: DataFrame, visits_per_task: int):
    """``forest`` (a ``RandomForestClassifier``) fitted on the rows of ``data`` by way
    of their groups, or None where it has to be fitted on rows: features with
    categories, weights, or trees without a bootstrap.

    Entries are written once; what was drawn of them is kept in memory and on disk
    while the trees grow."""
    from pyspark.ml.classification import RandomForestClassificationModel

    from vigil.session import cut_lineage
    sc, jvm = data.sparkSession.sparkContext, data.sparkSession._jvm
    impl, util = jvm.org.apache.spark.ml.tree.impl, jvm.org.apache.spark.ml.util
    learner, rows_of = _singleton(impl, "RandomForest"), _singleton(util, "DatasetUtils")
    label, features, trees = forest.getLabelCol(), forest.getFeaturesCol(), forest.getNumTrees()
    seed, subset = forest.getSeed(), forest.getFeatureSubsetStrategy()
    categories = _singleton(util, "MetadataUtils").getCategoricalFeatures(data._jdf.schema().apply(features))
    if not categories.isEmpty() or forest.isDefined(forest.weightCol) or not forest.getBootstrap():
        return None
    forest._transfer_params_to_java()
    java = forest._java_obj
    classes = rows_of.getNumClasses(data._jdf, label, 100)
    strategy = java.getOldStrategy(
        categories, classes, _singleton(jvm.org.apache.spark.mllib.tree.configuration, "Algo").Classification(),
        java.getOldImpurity())

    def instances(df):
        return rows_of.extractInstances(java, df._jdf, jvm.scala.Option.apply(classes))

    # split points are looked for in the rows, as ``fit`` does it
    metadata = _singleton(impl, "DecisionTreeMetadata").buildMetadata(instances(data), strategy, trees, subset)
    splits = learner.findSplits(instances(data), metadata, seed)
    points = [[s.threshold() for s in of_feature] for of_feature in splits]
    keys = [label, *[f"__b{j}" for j in range(len(points))], "__part"]
    entries = cut_lineage(by_powers(counted_groups(data, label, features, points)), "forest-groups")
    drawn = drawn_entries(forest, entries, keys, seed, visits_per_task, lambda df: _singleton(
        impl, "TreePoint").convertToTreeRDD(instances(df), splits, metadata))
    every = drawn[0]
    for more in drawn[1:]:
        every = every.union(more)
    every = every.persist(jvm.org.apache.spark.storage.StorageLevel.MEMORY_AND_DISK())
    try:
        # drawn in all tasks; a level then needs no more of them than entries times
        # trees call for, as each task returns sums for all nodes
        tasks = max(-(-every.count() * trees // visits_per_task), sc.defaultParallelism)
        grown = learner.runBagged(
            every.coalesce(tasks).rdd(), metadata, sc._jsc.broadcast(splits), strategy, trees, subset, seed,
            jvm.scala.Option.empty(), True, jvm.scala.Option.apply(java.uid()), 0)
    finally:
        every.unpersist(False)
    params = java.extractParamMap()
    models = sc._gateway.new_array(jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, trees)
    for i in range(trees):
        models[i] = java.copyValues(grown[i], params)
    fitted = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
        java.uid(), models, metadata.numFeatures(), classes)
    java.copyValues(fitted.setParent(java), params)
    return forest._copyValues(RandomForestClassificationModel(fitted))
