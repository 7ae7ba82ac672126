"""Learning and scoring on pyspark.ml.

Sampling is hash-based on row keys so that it is repeatable whatever the
partitioning (``rand(seed)`` depends on the partition layout).  Scores and
metrics are aggregates; the AUC is a rank-sum over distinct scores with a
two-level running sum (no single-partition sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ALGOS = ("rf", "lr", "svc")

# Rows times trees to a task of a forest's fit; a row keeps two numbers per tree.
# Larger forests are fitted on counted groups of rows.
VISITS_PER_TASK = 25_000_000


def _unit_hash(keys, seed: int):
    """A number in [0, 1) from the row keys and a seed: the first eight hex
    digits of an md5, so that SQL can draw the same rows."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    digits = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 32)


def undersample(df: DataFrame, target: str, skim: float = 0.25, seed: int = 123,
                keys=("hwid", "when")) -> DataFrame:
    """L1: keep every class-1 row and class-0 rows with hash <= skim."""
    return df.where((F.col(target) == 1)
                    | ((F.col(target) == 0) & (_unit_hash(keys, seed) <= skim)))


def class_weights(df: DataFrame, label: str, weight_class1: float,
                  name: str = "weight") -> DataFrame:
    """L2: weight column, ``weight_class1`` for class 1, 1.0 otherwise."""
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(weight_class1)))
                         .otherwise(F.lit(1.0)))


def replicate_positive(df: DataFrame, label: str, n: int) -> DataFrame:
    """L3: n copies of every class-1 row; ``n <= 1`` leaves the frame as is."""
    if n <= 1:
        return df
    reps = F.when(F.col(label) == 1, F.lit(n)).otherwise(F.lit(1))
    return df.withColumn("__rep", F.explode(F.array_repeat(F.lit(1), reps))).drop("__rep")


def balanced_set(df: DataFrame, label: str, frac: float = 0.73, seed: int = 42,
                 keys=("hwid", "when")) -> DataFrame:
    """L4: draw ``frac`` of class 0, remove the drawn rows from class 0 with
    set semantics (duplicates collapse), and add class 1."""
    zeros = df.where(F.col(label) == 0)
    drawn = zeros.where(_unit_hash(keys, seed) <= frac)
    return zeros.subtract(drawn).unionByName(df.where(F.col(label) == 1))


def train_test_split(df: DataFrame, share: float = 0.7, seed: int = 42,
                     keys=("hwid", "when")):
    """Repeatable split by row-key hash."""
    u = _unit_hash(keys, seed + 7919)
    return df.where(u < share), df.where(u >= share)


def assembler_stages(cols, scaler: bool = True, out: str = "features"):
    """Assemble (and scale by mean and std) the feature columns."""
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    cols = list(cols)
    if not scaler:
        return [VectorAssembler(inputCols=cols, outputCol=out)]
    return [VectorAssembler(inputCols=cols, outputCol="__raw"),
            StandardScaler(inputCol="__raw", outputCol=out, withMean=True, withStd=True)]


def build_model(algo: str, label: str, weight_col: str | None = None, seed: int = 42,
                n_trees: int = 500, max_depth: int = 10, svc_reg: float = 0.01,
                svc_iter: int = 1000):
    """The classifier for ``rf`` (500 trees of depth 10), ``lr``
    (no regularisation) or ``svc`` (up to 1000 iterations)."""
    from pyspark.ml.classification import (LinearSVC, LogisticRegression,
                                           RandomForestClassifier)
    if algo not in _ALGOS:
        raise ValueError(f"Unsupported algorithm: {algo}")
    kw = {"featuresCol": "features", "labelCol": label}
    if weight_col:
        kw["weightCol"] = weight_col
    if algo == "rf":
        # rows keep the node that they reached in each tree: else every level walks
        # every row through every tree from its root
        return RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth, seed=seed,
                                      cacheNodeIds=True, **kw)
    if algo == "lr":
        return LogisticRegression(regParam=0.0, **kw)
    return LinearSVC(regParam=svc_reg, maxIter=svc_iter, tol=1e-8, **kw)


def dealt_for_trees(train: DataFrame, n_trees: int) -> DataFrame:
    """Training rows (read from files) dealt out evenly in whole rounds of tasks, if
    their files, put together by bytes, would leave more to a task than
    ``VISITS_PER_TASK`` rows times trees."""
    tasks = -(-train.count() * n_trees // VISITS_PER_TASK)
    if tasks <= train.rdd.getNumPartitions():
        return train
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(-(-tasks // cores) * cores)


def fit_large_forest(pipe, train: DataFrame):
    """The pipeline fitted, its forest on counted groups of the rows; None if there are
    at most ``VISITS_PER_TASK`` rows times trees, or groups can not stand for rows."""
    from pyspark.ml import Pipeline, PipelineModel

    from vigil.operators.forest import fit_by_bins
    *stages, forest = pipe.getStages()
    if train.count() * forest.getNumTrees() <= VISITS_PER_TASK:
        return None
    prepared = Pipeline(stages=stages).fit(train)
    fitted = fit_by_bins(forest, prepared.transform(train), VISITS_PER_TASK)
    return None if fitted is None else PipelineModel([*prepared.stages, fitted])


def run_model(df: DataFrame, cols, label: str, algo: str = "rf", weight_class1: float = 10.0,
              seed: int = 42, scaler: bool = True, share: float = 0.7,
              keys=("hwid", "when"), **model_kw):
    """Fit on the train part and score on the test part and on all rows.

    ``rf`` replicates class 1 (L3) ``floor(weight_class1)`` times, and is fitted on
    counted groups of rows (``forest.fit_by_bins``) where there are more than
    ``VISITS_PER_TASK`` rows times trees; ``lr``/``svc`` use class weights (L2).
    Rows with a null feature or label are not fitted; among all rows they come back
    with null predictions.
    Returns (model, test predictions, all predictions)."""
    from pyspark.ml import Pipeline
    if algo not in _ALGOS:
        raise ValueError(f"Unsupported algorithm: {algo}")
    from vigil.session import cut_lineage
    data = df.na.drop(subset=list(cols) + [label])
    train, test = train_test_split(data, share, seed, keys)
    weight = None
    if algo == "rf":
        train = replicate_positive(train, label, int(weight_class1))
    else:
        train = class_weights(train, label, weight_class1)
        weight = "weight"
    # Iterative fits scan the training set many times: write it once to the
    # shared checkpoint folder so each pass reads it instead of recomputing
    # the whole chain (and a lost executor does not restart the lineage).
    train = cut_lineage(train.select(*cols, label, *([weight] if weight else [])))
    pipe = Pipeline(stages=[*assembler_stages(cols, scaler),
                            build_model(algo, label, weight, seed, **model_kw)])
    model = fit_large_forest(pipe, train) if algo == "rf" else None
    if model is not None:
        # a row is scored by every tree: small files or partitions put together by bytes
        # would leave that to a few tasks (of about as many rows as are fitted)
        tasks = -(-train.count() * model.stages[-1].getNumTrees // VISITS_PER_TASK)
        data, test = data.repartition(tasks), test.repartition(tasks)
    else:
        if algo == "rf":
            train = dealt_for_trees(train, pipe.getStages()[-1].getNumTrees())
        model = pipe.fit(train)
    missing = F.greatest(*[F.col(c).isNull() for c in (*cols, label)])
    scored = with_probability(model.transform(data)).unionByName(
        df.where(missing), allowMissingColumns=True)
    return model, with_probability(model.transform(test)), scored


def with_probability(preds: DataFrame, name: str = "ProbOverheating") -> DataFrame:
    """Probability of class 1 as a column (no Python UDF)."""
    from pyspark.ml.functions import vector_to_array
    if "probability" not in preds.columns:
        return preds
    return preds.withColumn(name, vector_to_array("probability")[1])


def importance_report(model, cols, n: int = 4) -> list[tuple[str, float]]:
    """Top n feature importances of a tree model, name up to the first
    ``_``, in percent."""
    imp = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(cols, imp), key=lambda p: -p[1])[:n]
    return [(c.split("_")[0], float(v) * 100) for c, v in ranked]


def coefficient_report(model, cols) -> list[tuple[str, float, str]]:
    """Coefficient of each (scaled) feature of a linear model, largest
    first, and whether it speaks for or against class 1."""
    coefs = model.stages[-1].coefficients.toArray()
    ranked = sorted(zip(cols, map(float, coefs)), key=lambda p: (-abs(p[1]), p[0]))
    return [(c, w, "for" if w > 0 else "against" if w < 0 else "none") for c, w in ranked]


def stump_threshold(df: DataFrame, feature: str, target: str) -> float:
    """Split point of a depth-1 tree on one feature; if the tree has no
    split, the mean of the two class medians."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    from vigil.session import cut_lineage
    data = cut_lineage(df.select(feature, target).na.drop())
    pipe = Pipeline(stages=[VectorAssembler(inputCols=[feature], outputCol="features"),
                            DecisionTreeClassifier(maxDepth=1, labelCol=target)])
    tree = pipe.fit(data).stages[-1]
    node = tree._call_java("rootNode")
    if node.getClass().getSimpleName() == "InternalNode":
        return float(node.split().threshold())
    med = data.groupBy(target).agg(F.percentile_approx(feature, 0.5).alias("m")).agg(
        F.avg("m")).first()[0]
    return float(med)


def exact_split(df: DataFrame, feature: str, target: str) -> DataFrame:
    """The split of one feature with the largest Gini gain, searched over
    every border between distinct values: feature, threshold (middle of the
    border; the smaller one of equal gains), gain.  Without a border that gains
    the threshold is the mean of the class medians (null without rows) and the
    gain 0.

    Classes are counted per distinct value; running counts along the values
    give both sides of every border without one task for all values."""
    from vigil.operators.sequence import keyed_cumsum, written_once
    x = df.select(F.col(feature).cast("double").alias("v"), F.col(target).cast("int").alias("y")) \
        .na.drop()
    per = written_once(x.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")),
                       "split-counts")
    totals = per.agg(F.sum("n").alias("all_n"), F.sum("ones").alias("all_ones"))
    # every count up to a border, and what is left behind it; totals: one row
    cum = keyed_cumsum(per, [], "v", ["n", "ones"], "after").where("after IS NOT NULL") \
        .join(F.broadcast(totals))

    def impure(n, ones):
        p = ones / n
        return n * 2.0 * p * (1.0 - p)

    n, ones = F.col("all_n"), F.col("all_ones")
    gain = (impure(n, ones) - impure(F.col("n_cum"), F.col("ones_cum"))
            - impure(n - F.col("n_cum"), ones - F.col("ones_cum"))) / n
    best = cum.select(F.round(gain, 12).alias("gain"), ((F.col("v") + F.col("after")) / 2).alias("at")) \
        .where("gain > 0").agg(F.max(F.struct("gain", (-F.col("at")).alias("minus"))).alias("best"))
    medians = x.groupBy("y").agg(F.percentile("v", 0.5).alias("m")).agg(F.avg("m").alias("middle"))
    return best.join(F.broadcast(medians)).select(  # one row each
        F.lit(feature).alias("feature"), F.coalesce(-F.col("best.minus"), "middle").alias("threshold"),
        F.coalesce("best.gain", F.lit(0.0)).alias("gain"))


def logistic_gradient(df: DataFrame, cols, label: str, coefficients, intercept: float,
                      weight: str | None = None) -> DataFrame:
    """The gradient of the mean weighted log loss at given coefficients of the
    columns ``cols`` as they stand: feature (the last row: intercept), gradient.
    One aggregate over the rows; at the optimum of an unpenalised model all are 0."""
    w = F.col(weight) if weight else F.lit(1.0)
    margin = sum((F.col(c) * float(b) for c, b in zip(cols, coefficients)), F.lit(float(intercept)))
    off = w * (1.0 / (1.0 + F.exp(-margin)) - F.col(label).cast("double"))
    names = [*cols, "intercept"]
    agg = df.agg(*[(F.sum(off * F.col(c)) / F.sum(w)).alias(c) for c in cols],
                 (F.sum(off) / F.sum(w)).alias("intercept"))
    from vigil.operators.aggregates import unpivot
    return unpivot(agg, names, "double", name_col="feature", value_col="gradient")


def standardised(df: DataFrame, cols, by: DataFrame) -> DataFrame:
    """``df`` with the columns centred and scaled by the mean and standard
    deviation that they have in ``by`` (constant columns become 0)."""
    stats = by.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols],
                   *[F.stddev_samp(c).alias(f"__s_{c}") for c in cols])
    j = df.join(F.broadcast(stats))  # one row
    scaled = {c: F.when(F.col(f"__s_{c}") > 0, (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}"))
              .otherwise(F.lit(0.0)) for c in cols}
    return j.withColumns(scaled).select(*df.columns)


def forest_nodes(model) -> DataFrame:
    """The nodes of a fitted forest (or tree) as a table: tree, node, feature
    (null in a leaf), threshold, lefts (categories that go left, null for a
    threshold), yes and no (child nodes; yes is the left one), share (of class
    1), gain and weight.

    Read from the model's own saved form, which executors write to the shared
    folder, so no tree passes through Python on the driver."""
    from pyspark.sql import SparkSession

    from vigil.session import scratch_path
    spark = SparkSession.active()
    forest = model.stages[-1] if hasattr(model, "stages") else model
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" not in saved.columns:  # a single tree
        saved = saved.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    d = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    leaf, split = F.col("leftChild") < 0, F.col("split")
    by_threshold = split["numCategories"] == -1
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return d.select(
        "tree", F.col("id").alias("node"), F.when(~leaf, split["featureIndex"]).alias("feature"),
        F.when(~leaf & by_threshold, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(~leaf & ~by_threshold, split["leftCategoriesOrThreshold"]).alias("lefts"),
        F.when(~leaf, F.col("leftChild")).alias("yes"), F.when(~leaf, F.col("rightChild")).alias("no"),
        F.when(total > 0, F.get("impurityStats", F.lit(1)) / total).otherwise(F.lit(0.0)).alias("share"),
        F.when(~leaf, F.col("gain")).alias("gain"), total.alias("weight"))


def score_by_nodes(rows: DataFrame, nodes: DataFrame, features: str, depth: int, keys,
                   name: str = "probability", broadcast_rows: int = 1_000_000) -> DataFrame:
    """The mean share of class 1 over all trees for each row, by joining
    rows with nodes at most ``depth`` times: keys and ``name``.  ``keys`` are
    unique; ``features`` is an array column.

    A row visits each tree on its own, so rows times trees go through the joins
    and only sums per key through the shuffle.  A node is named by one number and
    a leaf leads to itself, so that a join is one short lookup.  The nodes are
    written once and broadcast if they were counted to be at most
    ``broadcast_rows``."""
    from vigil.operators.sequence import written_once
    nodes = written_once(nodes, "forest-nodes")
    leaf, first = F.col("feature").isNull(), F.shiftleft(F.col("tree").cast("long"), 32)
    here = first + F.col("node")
    n, with_lefts = nodes.agg(F.count(F.lit(1)), F.count("lefts")).first()
    lefts = ["lefts"] if with_lefts else []
    steps = nodes.select(
        here.alias("__n"), F.coalesce("feature", F.lit(0)).alias("feature"), "threshold", *lefts,
        F.when(leaf, here).otherwise(first + F.col("yes")).alias("yes"),
        F.when(leaf, here).otherwise(first + F.col("no")).alias("no"))
    leaves = nodes.where(leaf).select(here.alias("__n"), "share")
    if n <= broadcast_rows:
        steps, leaves = F.broadcast(steps), F.broadcast(leaves)
    trees = nodes.agg(F.sort_array(F.collect_set(first)).alias("__trees"))  # one row
    at = rows.select(*keys, F.col(features).alias("__x")).join(F.broadcast(trees)) \
        .select(*keys, "__x", F.explode("__trees").alias("__at"))
    value = F.get("__x", F.col("feature"))
    left = value <= F.col("threshold")
    if lefts:
        left = F.when(F.col("lefts").isNotNull(), F.array_contains("lefts", value)).otherwise(left)
    for _ in range(depth):
        at = at.join(steps, F.col("__at") == F.col("__n")).select(
            *keys, "__x", F.when(left, F.col("yes")).otherwise(F.col("no")).alias("__at"))
    got = at.drop("__x").join(leaves, F.col("__at") == F.col("__n"))
    return got.groupBy(*keys).agg(F.avg("share").alias(name))


def importance_by_nodes(nodes: DataFrame, cols) -> DataFrame:
    """The share of each feature in the weighted gains of the inner nodes,
    each tree counting the same: feature, importance."""
    per = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("gain"))
    whole = Window.partitionBy("tree")
    shares = per.select("feature", (F.col("gain") / F.sum("gain").over(whole)).alias("share")) \
        .groupBy("feature").agg(F.sum("share").alias("share"))
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(i), F.lit(c))])
    total = shares.agg(F.sum("share").alias("all"))  # one row
    return shares.join(F.broadcast(total)).select(
        names[F.col("feature")].alias("feature"), (F.col("share") / F.col("all")).alias("importance"))


def hinge_objective(df: DataFrame, cols, label: str, points, reg: float,
                    weight: str | None = None) -> DataFrame:
    """What a linear SVM minimises, at each of ``points`` (name,
    coefficients, intercept): name, objective.  The mean weighted hinge loss plus
    half of ``reg`` times the squared coefficients of the standardised columns.
    One aggregate over the rows, as wide as there are points."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    sign = F.col(label).cast("double") * 2 - 1
    losses = []
    for k, (_, coefficients, intercept) in enumerate(points):
        margin = sum((F.col(c) * float(b) for c, b in zip(cols, coefficients)), F.lit(float(intercept)))
        losses.append((F.sum(w * F.greatest(F.lit(0.0), 1 - sign * margin)) / F.sum(w)).alias(f"__p{k}"))
    variances = []
    for c in cols:
        mean = F.sum(w * F.col(c)) / F.sum(w)
        spread = F.sum(w * F.col(c) * F.col(c)) - mean * mean * F.sum(w)
        variances.append((spread / (F.sum(w) - F.sum(w * w) / F.sum(w))).alias(f"__v_{c}"))
    agg = df.agg(*losses, *variances)
    values = []
    for k, (name, coefficients, _) in enumerate(points):
        penalty = sum((F.col(f"__v_{c}") * float(b) ** 2 for c, b in zip(cols, coefficients)), F.lit(0.0))
        values.append(F.struct(F.lit(name).alias("name"),
                               (F.col(f"__p{k}") + penalty * (reg / 2)).alias("objective")))
    return agg.select(F.explode(F.array(*values)).alias("p")).select("p.*")


def threshold_rules(df: DataFrame, thresholds: dict) -> DataFrame:
    """``prediction`` = 1 if any feature is over its threshold;
    ``score`` = number of rules that hold."""
    hits = [F.coalesce((F.col(c).cast("double") > float(t)).cast("int"), F.lit(0))
            for c, t in thresholds.items()]
    score = hits[0]
    for h in hits[1:]:
        score = score + h
    return df.withColumns({"score": score.cast("double"),
                           "prediction": F.when(score > 0, 1).otherwise(0)})


def linear_score(df: DataFrame, intercept: float, coefs: dict, means: dict | None = None,
                 stds: dict | None = None, name: str = "score") -> DataFrame:
    """``b + sum(c * (x - mean) / std)`` (std 0 -> 1e-8; without
    means/stds the raw values), and its sigmoid as ``<name>_prob``."""
    expr = F.lit(float(intercept))
    for c, w in coefs.items():
        x = F.col(c).cast("double")
        if means is not None and stds is not None:
            sd = stds[c] if stds[c] != 0 else 1e-8
            expr = expr + (F.lit(float(w)) * (x - F.lit(float(means[c])))) / F.lit(float(sd))
        else:
            expr = expr + F.lit(float(w)) * x
    return df.withColumns({name: expr}).withColumn(
        f"{name}_prob", 1.0 / (1.0 + F.exp(-F.col(name))))


def confusion_matrix(df: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """Tn, fp, fn, tp in one aggregate (missing cells are 0)."""
    y, p = F.col(target).cast("int"), F.col(prediction).cast("int")
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"),
                  F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"),
                  F.count_if((y == 1) & (p == 1)).alias("tp"))


def auc(df: DataFrame, target: str, score: str, slices: int = 256) -> DataFrame:
    """Area under the ROC curve by rank-sum with mean ranks on ties:
    sum over distinct scores of pos(s) * (neg_below(s) + neg(s)/2) / (P*N).
    One row: ``auc``."""
    from vigil.operators.sequence import global_cumsum
    x = df.select(F.col(score).cast("double").alias("s"), F.col(target).cast("int").alias("y")) \
        .where(F.col("s").isNotNull() & F.col("y").isNotNull())
    per = x.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("pos"),
                             F.count_if(F.col("y") == 0).alias("neg"))
    # used by the bounds read and both sides of the running sum: write once
    from vigil.session import cut_lineage
    per = cut_lineage(per)
    cum = global_cumsum(per, "s", ["neg"], slices)
    part = F.col("pos") * (F.col("neg_cum") - F.col("neg") + F.col("neg") / 2.0)
    return cum.agg((F.try_divide(F.sum(part), F.sum("pos") * F.sum("neg"))).alias("auc"))


def metrics(df: DataFrame, target: str, score: str, prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision (0 when nothing is predicted positive) and
    AUC of ``score``, as one row."""
    cm = confusion_matrix(df, target, prediction)
    tot = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    acc = cm.select(
        (F.try_divide((F.col("tp") + F.col("tn")).cast("double"), tot)).alias("accuracy"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")),
                   F.lit(0.0)).alias("precision"),
        F.lit(1).alias("__k"))
    a = auc(df, target, score).withColumn("__k", F.lit(1))
    return acc.join(a, "__k").drop("__k")


def probability_trend(preds: DataFrame, show: float = 720, moving: float = 60,
                      key: str = "MinToOverheating", prob: str = "ProbOverheating") -> DataFrame:
    """Per value of ``key`` the mean, std and count of the probability,
    ``err = std / n^0.5``; rows with ``key < show``; moving mean over
    ``[key, key + moving]`` (the past, since a larger key is earlier).  The
    filter runs before the window."""
    s = preds.groupBy(key).agg(F.avg(prob).alias("AvgProb"), F.stddev_samp(prob).alias("Std"),
                               F.count(prob).alias("N"))
    s = s.withColumn("Err", F.col("Std") / F.pow(F.col("N"), 0.5)).where(F.col(key) < show)
    return s.withColumn("MovingAvg", F.avg("AvgProb").over(
        Window.orderBy(key).rangeBetween(0, moving)))


def block_probability_trend(preds: DataFrame, show: float = 720, moving: float = 60,
                            key: str = "MinToOverheating", prob: str = "ProbOverheating",
                            device_col: str = "hwid", block_col: str = "BlockHeat") -> DataFrame:
    """Per event block a moving mean over ``[key, key + moving]``; here
    the ``key < show`` filter runs after the window."""
    w = Window.partitionBy(device_col, block_col).orderBy(key).rangeBetween(0, moving)
    x = preds.select(device_col, block_col, key, prob, F.avg(prob).over(w).alias("MovingAvg"))
    return x.where(F.col(key) < show)


def score_separation(df: DataFrame, target: str, score: str) -> DataFrame:
    """Mean and std of the score per class, the difference of the
    class means, and the accuracy of ``score > 0`` as the prediction."""
    y, s = F.col(target).cast("int"), F.col(score).cast("double")
    return df.agg(
        F.avg(F.when(y == 0, s)).alias("mean_0"), F.stddev_samp(F.when(y == 0, s)).alias("std_0"),
        F.avg(F.when(y == 1, s)).alias("mean_1"), F.stddev_samp(F.when(y == 1, s)).alias("std_1"),
        F.avg(((s > 0).cast("int") == y).cast("double")).alias("accuracy_at_0"),
    ).withColumn("mean_diff", F.col("mean_1") - F.col("mean_0"))


def random_rows(df: DataFrame, n: int, seed: int = 7, keys=("hwid", "when")) -> DataFrame:
    """N random rows (a sampling operator; top-n of a hash of the row
    keys, so the same rows whatever the partitions)."""
    return df.orderBy(_unit_hash(keys, seed), *keys).limit(n)
