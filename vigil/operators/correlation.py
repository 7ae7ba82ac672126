"""Correlation and dependence.

Covariances and correlations are aggregate expressions evaluated in one
pass on the executors (no RDD round trip through Python, no matrix on the
driver); results come back as small long-format DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.scalar import equal_width_bin, safe_divide
from vigil.operators.aggregates import unpivot


def _complete(df: DataFrame, cols) -> DataFrame:
    cols = list(cols)
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop(subset=cols)


def covariance_matrix(df: DataFrame, cols) -> DataFrame:
    """Sample covariance of every pair after dropping rows with any
    null (listwise).  Long format (col_i, col_j, cov), both triangles.

    The matrix comes from one tree aggregate over assembled vectors (Spark ML),
    so wide frames cost no expression per pair; the driver reads one number
    per pair of columns."""
    cols = list(cols)
    x = _complete(df, cols)
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    spread = x.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_samp(c).alias(c) for c in cols]).first()
    names = "col_i string, col_j string, cov double"
    if spread["n"] < 2:
        return df.sparkSession.createDataFrame([(a, b, None) for a in cols for b in cols], names)
    vec = VectorAssembler(inputCols=cols, outputCol="__v").transform(x).select("__v")
    corr = Correlation.corr(vec, "__v").first()[0].toArray()
    sd = [spread[c] for c in cols]
    cov = lambda i, j: (sd[i] * sd[j] if i == j else
                        float(corr[i, j]) * sd[i] * sd[j] if sd[i] and sd[j] else 0.0)
    return df.sparkSession.createDataFrame(
        [(a, b, cov(i, j)) for i, a in enumerate(cols) for j, b in enumerate(cols)], names)


def correlation_ranking(df: DataFrame, cols, target: str) -> DataFrame:
    """Correlation of each column with ``target`` from the listwise
    covariance (cov / (sd_i * sd_t)); self, NaN and infinite values are
    dropped; ``abs_corr`` gives the ranking order (largest first)."""
    feats = [c for c in cols if c != target]
    x = _complete(df, [*feats, target])
    sd_t = F.sqrt(F.var_samp(target))
    agg = x.agg(*[safe_divide(F.covar_samp(c, target), F.sqrt(F.var_samp(c)) * sd_t).alias(c)
                  for c in feats])
    long = unpivot(agg, feats, "double", name_col="sensor", value_col="correlation")
    long = long.where(F.col("correlation").isNotNull() & ~F.isnan("correlation")
                      & (F.abs("correlation") != float("inf")))
    return long.withColumn("abs_corr", F.abs("correlation"))


def pairwise_correlation(df: DataFrame, sensors, target: str) -> DataFrame:
    """Pearson correlation of each sensor with the target over the
    rows where both are present (pairwise), null -> 0.0; one aggregate for
    all sensors (no batches, no driver threads).  Written as
    cov / (sd*sd) with a guarded divide so constant columns give 0.0 instead
    of an ANSI error (Trap T3)."""
    feats = [s for s in sensors if s != target]
    t = F.col(target).cast("double")
    exprs = []
    for s in feats:
        v = F.col(s).cast("double")
        both = v.isNotNull() & t.isNotNull()
        vs, ts = F.when(both, v), F.when(both, t)
        r = safe_divide(F.covar_samp(vs, ts), F.stddev_samp(vs) * F.stddev_samp(ts))
        exprs.append(F.coalesce(F.when(~F.isnan(r), r), F.lit(0.0)).alias(s))
    agg = df.agg(*exprs)
    long = unpivot(agg, feats, "double", name_col="sensor", value_col="correlation")
    return long.withColumn("abs_corr", F.abs("correlation"))


def correlation_by_device(df: DataFrame, sensors, target: str,
                          device_col: str = "hwid") -> DataFrame:
    """One wide row per device with the pairwise correlation of each
    sensor with the target."""
    feats = [s for s in sensors if s != target]
    t = F.col(target).cast("double")
    exprs = []
    for s in feats:
        v = F.col(s).cast("double")
        both = v.isNotNull() & t.isNotNull()
        vs, ts = F.when(both, v), F.when(both, t)
        exprs.append(safe_divide(F.covar_samp(vs, ts),
                                 F.stddev_samp(vs) * F.stddev_samp(ts)).alias(f"corr_{s}"))
    return df.groupBy(device_col).agg(*exprs)


def overlap_area(df: DataFrame, sensor: str, target: str, num_bins: int = 50) -> DataFrame:
    """Overlap of the two class histograms of a sensor.  Common
    min/max over both classes, ``num_bins`` equal bins (last closed), each
    class's counts as shares of its total; overlap = 100 * sum over bins of
    min(share_0, share_1).

    The bounds are one row of column statistics read once on the driver."""
    x = df.select(F.col(sensor).cast("double").alias("x"), F.col(target).cast("int").alias("y")) \
        .where(F.col("x").isNotNull() & F.col("y").isin(0, 1))
    b = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
              F.count_if(F.col("y") == 0).alias("n0"),
              F.count_if(F.col("y") == 1).alias("n1")).first()
    spark = df.sparkSession
    if b is None or b["lo"] is None or not b["n0"] or not b["n1"] or b["lo"] == b["hi"]:
        return spark.createDataFrame([(sensor, None)], "sensor string, overlap_pct double")
    lo, hi, n0, n1 = float(b["lo"]), float(b["hi"]), int(b["n0"]), int(b["n1"])
    binned = x.withColumn("bin", equal_width_bin("x", lo, hi, num_bins))
    per_bin = binned.groupBy("bin").agg(
        F.count_if(F.col("y") == 0).alias("c0"), F.count_if(F.col("y") == 1).alias("c1"))
    share = F.least(F.col("c0") / n0, F.col("c1") / n1)
    return per_bin.agg((F.sum(share) * 100).alias("overlap_pct")) \
        .select(F.lit(sensor).alias("sensor"), "overlap_pct")


def load_temperature(df: DataFrame, load: str, temp: str, min_count: int = 300,
                     always_level: float = 100) -> DataFrame:
    """Per load value the count, mean and std of the temperature; keep
    levels with more than ``min_count`` rows or the ``always_level``."""
    x = df.where(F.col(load).isNotNull() & F.col(temp).isNotNull())
    res = x.groupBy(load).agg(F.count(temp).alias("count"),
                              F.avg(temp).alias("avg_temperature"),
                              F.stddev_samp(temp).alias("std_temperature"))
    return res.where((F.col("count") > min_count) | (F.col(load) == always_level))


def hist2d(df: DataFrame, load: str, temp: str, load_width: float = 4,
           temp_width: float = 1, load_lo: float = -1, load_hi: float = 101) -> DataFrame:
    """2-D histogram; load bins of ``load_width`` over [lo, hi] and
    temperature bins of ``temp_width`` over [min-1, max+1], both shifted by
    half a bin.  Values outside the edges are left out."""
    x = df.select(F.col(load).cast("double").alias("l"), F.col(temp).cast("double").alias("t")) \
        .where(F.col("l").isNotNull() & F.col("t").isNotNull())
    tb = x.agg(F.min("t").alias("mn"), F.max("t").alias("mx")).first()
    if tb is None or tb["mn"] is None:
        return x.sparkSession.createDataFrame([], "load_bin long, temp_bin long, count long")
    l0 = load_lo - load_width / 2
    n_l = len(_arange(l0, load_hi + load_width / 2, load_width)) - 1
    t0 = tb["mn"] - 1 - temp_width / 2
    n_t = len(_arange(t0, tb["mx"] + 1 + temp_width / 2, temp_width)) - 1
    lb = F.floor((F.col("l") - l0) / load_width)
    tbin = F.floor((F.col("t") - t0) / temp_width)
    y = x.select(lb.alias("load_bin"), tbin.alias("temp_bin")) \
        .where(F.col("load_bin").between(0, n_l - 1) & F.col("temp_bin").between(0, n_t - 1))
    return y.groupBy("load_bin", "temp_bin").agg(F.count(F.lit(1)).alias("count"))


def _arange(start, stop, step):
    out, v, i = [], start, 0
    while v < stop:
        out.append(v)
        i += 1
        v = start + i * step
    return out


def top_levels(df: DataFrame, load: str, temp: str, n: int = 3) -> DataFrame:
    """The n most frequent load values (ties: smaller value first) and
    the temperature distribution inside each: ``int(max-min)*2`` equal bins
    over the level's own range.  The top-n list has n rows, so the
    semi-join and the bounds join stay small."""
    x = df.where(F.col(load).isNotNull() & F.col(temp).isNotNull())
    top = (x.groupBy(load).agg(F.count(F.lit(1)).alias("n_level"))
           .orderBy(F.col("n_level").desc(), F.col(load).asc()).limit(n))
    sel = x.join(F.broadcast(top.select(load)), load, "left_semi")
    bounds = sel.groupBy(load).agg(F.min(temp).alias("lo"), F.max(temp).alias("hi"))
    bounds = bounds.withColumn("n_bins", F.greatest(
        (F.floor(F.col("hi") - F.col("lo")) * 2).cast("int"), F.lit(1)))
    j = sel.join(F.broadcast(bounds), load)
    width = (F.col("hi") - F.col("lo")) / F.col("n_bins")
    raw = F.floor(safe_divide(F.col(temp) - F.col("lo"), width))
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(raw, F.col("n_bins") - 1)).cast("int")
    res = j.groupBy(load, "n_bins", "lo", "hi", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return res.select(load, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"), "count")


def pca(df: DataFrame, cols, k: int | None = None):
    """Principal components of the listwise-complete columns (centred);
    Spark ML fits on the executors.  Long format: component, explained_ratio,
    column, loading; the largest loading of a component is positive."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml import Pipeline
    cols = list(cols)
    k = k or len(cols)
    x = _complete(df, cols)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="__v"),
        StandardScaler(inputCol="__v", outputCol="__c", withMean=True, withStd=False),
        PCA(k=k, inputCol="__c", outputCol="pca"),
    ])
    model = pipe.fit(x)
    pm = model.stages[-1]
    ratios = [float(v) for v in pm.explainedVariance.toArray()]
    loadings = pm.pc.toArray()
    rows = []
    for i, ratio in enumerate(ratios):
        axis = loadings[:, i]
        sign = 1.0 if axis[abs(axis).argmax()] >= 0 else -1.0
        rows += [(i + 1, ratio, c, float(sign * v)) for c, v in zip(cols, axis)]
    return df.sparkSession.createDataFrame(
        rows, "component int, explained_ratio double, column string, loading double"), model


def auc_by_block_sensor(df: DataFrame, sensors, flag: str = "flag_anomaly",
                        min_distinct: int = 10, device_col: str = "hwid",
                        block_col: str = "BlockID") -> DataFrame:
    """For blocks with an anomaly, and sensors with more than
    ``min_distinct`` distinct values in that block, the AUC of the raw
    sensor value against the flag, by the rank-sum formula with mean ranks
    on ties.  All blocks and sensors at once, no collect.  Blocks with only
    one class give no row, so those without an anomaly do not either.

    Rows are counted per (device, block, sensor, value) first; the mean rank of
    a value is the running count before it and half its own.  The running
    counts (``sequence.keyed_cumsum``) are not bound to one task per block."""
    from vigil.operators.sequence import keyed_cumsum
    g = [device_col, block_col, "sensor"]
    y = F.col(flag).cast("int")
    long = unpivot(df.select(device_col, block_col, y.alias("__y"), *sensors), sensors, "double",
                   keys=(device_col, block_col, "__y"), name_col="sensor", value_col="v")
    per = long.where(F.col("v").isNotNull()).groupBy(*g, "v").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__y") == 1).alias("ones"),
        F.count_if(F.col("__y") == 0).alias("zeros"))
    ranked = keyed_cumsum(per, g, "v", ["n"])
    rank = F.col("n_cum") - (F.col("n") - 1) / 2.0
    res = ranked.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n_distinct"), F.sum(F.col("ones") * rank).alias("rsum"),
        F.sum("ones").alias("n1"), F.sum("zeros").alias("n0"))
    res = res.where((F.col("n_distinct") > min_distinct) & (F.col("n1") > 0) & (F.col("n0") > 0))
    auc = (F.col("rsum") - F.col("n1") * (F.col("n1") + 1) / 2.0) / (F.col("n1") * F.col("n0"))
    return res.select(*g, auc.alias("roc_auc"))


def roc_curve(df: DataFrame, label: str, score: str, slices: int = 256) -> DataFrame:
    """C14: FPR and TPR at every distinct score taken as threshold
    (predict 1 when score >= threshold), from the highest score down.

    Counts per distinct score are cumulated in two levels: inside equally
    full score slices (windows per slice) and across slices (a table of at most
    ``slices`` rows), so no single task sorts all distinct scores."""
    x = df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y")) \
        .where(F.col("s").isNotNull() & F.col("y").isNotNull())
    per = x.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("tp_d"),
                             F.count_if(F.col("y") == 0).alias("fp_d"))
    # the per-score table feeds the bounds read and both sides of the
    # two-level running sum: write it once instead of computing it three times
    from vigil.session import cut_lineage
    per = cut_lineage(per)
    b = per.agg(F.sum("tp_d").alias("P"), F.sum("fp_d").alias("N")).first()
    if b["P"] is None:
        return per.sparkSession.createDataFrame([], "threshold double, tpr double, fpr double")
    from vigil.operators.sequence import global_cumsum
    cum = global_cumsum(per, "s", ["tp_d", "fp_d"], slices, descending=True)
    P, N = float(b["P"]), float(b["N"])
    return cum.select(F.col("s").alias("threshold"),
                      (F.col("tp_d_cum") / P if P else F.lit(None).cast("double")).alias("tpr"),
                      (F.col("fp_d_cum") / N if N else F.lit(None).cast("double")).alias("fpr"))


def mutual_information(df: DataFrame, sensors, flag: str = "flag_anomaly",
                       bins: int = 10, device_col: str = "hwid",
                       block_col: str = "BlockID") -> DataFrame:
    """Mutual information (nats) between a sensor, cut in ``bins``
    equal bins over its range in the block, and the flag, per block and
    sensor.  Blocks where the sensor is constant give 0.  Bounds and
    marginals are windows over (device, block, sensor): no join back."""
    keys = [device_col, block_col]
    long = unpivot(df.select(*keys, F.col(flag).cast("int").alias("__y"), *sensors), sensors,
                   "double", keys=(*keys, "__y"), name_col="sensor", value_col="v") \
        .where(F.col("v").isNotNull() & F.col("__y").isNotNull())
    g = [*keys, "sensor"]
    wg = Window.partitionBy(*g)
    j = long.select(*g, "__y", "v", F.min("v").over(wg).alias("lo"),
                    F.max("v").over(wg).alias("hi"), F.count(F.lit(1)).over(wg).alias("n"))
    j = j.withColumn("bin", equal_width_bin("v", "lo", "hi", bins))
    cell = j.groupBy(*g, "n", "bin", "__y").agg(F.count(F.lit(1)).alias("nxy"))
    wx = Window.partitionBy(*g, "bin")
    wy = Window.partitionBy(*g, "__y")
    cell = cell.withColumns({"nx": F.sum("nxy").over(wx), "ny": F.sum("nxy").over(wy)})
    term = (F.col("nxy") / F.col("n")) * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return cell.groupBy(*g).agg(F.sum(term).alias("mutual_info"))


def digamma(n):
    """Digamma of a positive whole number: the asymptotic series at n + 10, ten
    steps of the recurrence back (within 1e-14)."""
    x = n.cast("double") + 10.0
    inv = 1.0 / (x * x)
    series = F.log(x) - 0.5 / x - inv * (1 / 12 - inv * (1 / 120 - inv * (1 / 252 - inv * (
        1 / 240 - inv / 132))))
    return series - sum((1.0 / (n + i) for i in range(1, 10)), 1.0 / n)


def neighbour_information(df: DataFrame, sensors, flag: str = "flag_anomaly", k: int = 3,
                          device_col: str = "hwid", block_col: str = "BlockID") -> DataFrame:
    """Mutual information (nats) of a sensor and the flag by nearest
    neighbours, per sensor and block with an anomaly.

    For every row the distance r to its k-th neighbour of the same class (fewer,
    if the class has k rows or less) comes from ``lag`` and ``lead`` in value
    order.  Then m rows of any class lie in the open interval (v - r, v + r), or,
    where r is 0, at v.  The estimate is
    ``digamma(N) + <digamma(k)> - <digamma(class size)> - <digamma(m)>``, at
    least 0, over the N rows of classes with two rows or more; a sensor without
    such a class gives 0.  Rows with a null value or flag are left out.  Rounded
    to ten decimals, so that sums in another order agree.

    m needs no join: the ends of the intervals are sorted among the values, and
    a running count of the values at both ends gives it."""
    keys = [device_col, block_col]
    g = [*keys, "sensor"]
    y = F.col(flag).cast("int")
    odd = df.groupBy(*keys).agg(F.max(y).alias("__odd")).where("__odd = 1").drop("__odd")
    long = unpivot(df.join(odd, keys).select(*keys, y.alias("y"), *sensors), sensors, "double",
                   keys=(*keys, "y"), name_col="sensor", value_col="v")
    long = long.where(F.col("v").isNotNull() & F.col("y").isNotNull())
    mates = Window.partitionBy(*g, "y")
    by_value = mates.orderBy("v")
    below = [F.lit(0.0)] + [F.col("v") - F.lag("v", i).over(by_value) for i in range(1, k + 1)]
    above = [F.lit(0.0)] + [F.lead("v", i).over(by_value) - F.col("v") for i in range(1, k + 1)]
    x = long.withColumns({f"b{i}": b for i, b in enumerate(below)}
                         | {f"a{i}": a for i, a in enumerate(above)}
                         | {"mates": F.count(F.lit(1)).over(mates)})

    def radius(size):
        # the best run of size + 1 class mates that holds the row
        ends = [F.when(F.col(f"b{i}").isNotNull() & F.col(f"a{size - i}").isNotNull(),
                       F.greatest(f"b{i}", f"a{size - i}")) for i in range(size + 1)]
        return F.array_min(F.array(*ends))

    used = F.least(F.lit(k), F.col("mates") - 1)
    r = F.coalesce(*[F.when(used == size, radius(size)) for size in range(1, k + 1)])
    x = x.select(*g, "v", "mates", used.alias("k"), r.alias("r"),
                 F.monotonically_increasing_id().alias("id"))
    # the written rows fix the ids, which pair the two ends of an interval
    from vigil.operators.sequence import written_once
    x = written_once(x, "neighbour-radii")
    wide = F.col("r") > 0
    # at equal places: upper ends that leave out their place, values, others
    ends = F.array(
        F.struct(F.col("v").alias("place"), F.lit(1).alias("turn"), F.lit(0).alias("sign")),
        F.struct((F.col("v") - F.col("r")).alias("place"), F.when(wide, 2).otherwise(0).alias("turn"),
                 F.lit(-1).alias("sign")),
        F.struct((F.col("v") + F.col("r")).alias("place"), F.when(wide, 0).otherwise(2).alias("turn"),
                 F.lit(1).alias("sign")))
    events = x.select(*g, "mates", "k", "id", F.explode(ends).alias("e")).select(
        *g, "mates", "k", "id", "e.*").where("place is not null and (sign = 0 or mates > 1)")
    counted = events.withColumn("values", F.sum(F.when(F.col("sign") == 0, 1).otherwise(0)).over(
        Window.partitionBy(*g).orderBy("place", "turn")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    within = counted.where("mates > 1").groupBy(*g, "id", "mates", "k").agg(
        F.sum(F.col("sign") * F.col("values")).alias("m"))
    total = within.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(digamma(F.col("k")) - digamma(F.col("mates")) - digamma(F.col("m"))).alias("mean"))
    every = long.select(*g).distinct()
    estimate = F.round(digamma(F.col("n")) + F.col("mean"), 10)
    return every.join(total, g, "left").select(*g, F.coalesce(F.greatest(
        F.lit(0.0), estimate), F.lit(0.0)).alias("mutual_info"))


def own_bins_overlap(df: DataFrame, sensor: str, target: str, bins: int = 30) -> DataFrame:
    """Overlap of the density histograms of the two classes, each with
    ``bins`` equal bins over its own range (last one closed).

    ``overlap_pct`` is the area under the lower of the two step functions: the
    edges of both are merged and both heights carried forward over them.
    ``by_bin_pct`` compares bin i with bin i whatever its place, and takes the
    width of class 0, as the reference does.  A class with one value has a
    range of width 1 around it; with an empty class both are null.  The only
    tables joined have a row per bin."""
    x = df.select(F.col(sensor).cast("double").alias("x"), F.col(target).cast("int").alias("y")) \
        .where(F.col("x").isNotNull() & F.col("y").isin(0, 1))
    b = x.groupBy("y").agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"), F.count(F.lit(1)).alias("n"))
    flat = F.col("lo0") == F.col("hi0")
    b = b.select("y", "n", F.when(flat, F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                 F.when(flat, F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    b = b.withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    two = F.broadcast(b)  # one row per class
    counts = x.join(two, "y").groupBy("y", equal_width_bin("x", "lo", "hi", bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("c"))
    every = b.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    heights = every.join(counts, ["y", "bin"], "left").select(
        "y", "bin", "width", (F.col("lo") + F.col("bin") * F.col("width")).alias("edge"),
        (F.coalesce("c", F.lit(0)) / (F.col("n") * F.col("width"))).alias("height"))
    # behind its last bin a class has height 0
    ends = b.select("y", F.lit(bins).alias("bin"), "width", F.col("hi").alias("edge"),
                    F.lit(0.0).alias("height"))
    steps = heights.unionByName(ends)
    w = Window.orderBy("edge", "y", "bin")  # two rows per bin
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = steps.select(
        (F.lead("edge").over(w) - F.col("edge")).alias("length"),
        *[F.coalesce(F.last(F.when(F.col("y") == c, F.col("height")), True).over(upto), F.lit(0.0))
          .alias(f"h{c}") for c in (0, 1)])
    area = carried.agg(F.sum(F.least("h0", "h1") * F.col("length")).alias("area"))
    pairs = heights.groupBy("bin").agg(
        F.max(F.when(F.col("y") == 0, F.col("height"))).alias("h0"),
        F.max(F.when(F.col("y") == 1, F.col("height"))).alias("h1"),
        F.max(F.when(F.col("y") == 0, F.col("width"))).alias("width"))
    by_bin = pairs.agg(F.sum(F.least("h0", "h1") * F.col("width")).alias("same"),
                       (F.count_if(F.col("h0").isNull() | F.col("h1").isNull()) == 0).alias("both"))
    return area.crossJoin(by_bin).select(  # one row each
        F.lit(sensor).alias("sensor"),
        F.when(F.col("both"), F.col("area") * 100).alias("overlap_pct"),
        F.when(F.col("both"), F.col("same") * 100).alias("by_bin_pct"))


def top_bottom(ranking: DataFrame, k: int, by: str = "abs_corr",
               name_col: str = "sensor") -> DataFrame:
    """The k highest and k lowest of a ranking, with a ``side`` tag."""
    one = Window.partitionBy(F.lit(1))  # one row per sensor
    x = ranking.withColumns({"__hi": F.row_number().over(one.orderBy(F.desc(by), name_col)),
                             "__lo": F.row_number().over(one.orderBy(F.col(by), name_col))})
    sides = F.filter(F.array(F.when(F.col("__hi") <= k, "top"), F.when(F.col("__lo") <= k, "bottom")),
                     lambda s: s.isNotNull())
    return x.withColumn("side", F.explode(sides)).drop("__hi", "__lo")
