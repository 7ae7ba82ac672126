"""States that merge: distinct-count sketches (A4, A5) and co-moments.

A state table holds one small row per key, written once.  Coarser answers (a
device, a range of days, the whole table) come from merging its rows; the
readings are not read again, and new days only add rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.scalar import safe_divide
from vigil.operators.aggregates import unpivot

# ------------------------------------------------------ distinct counts

#: Buckets of a sketch are 2 ** LG_K; one standard error is 1.04 / sqrt(2 ** LG_K).
LG_K = 12


def distinct_sketches(df: DataFrame, columns, keys=("hwid", "BlockID"), lg_k: int = LG_K) -> DataFrame:
    """A HyperLogLog sketch per key and column: keys, sensor, sketch (null values
    are not counted; a column without values in a key has no row)."""
    keys = list(keys)
    long = unpivot(df, list(columns), "double", keys=tuple(keys), name_col="sensor", value_col="v")
    # the sketch takes no doubles; zero has one text, whatever its sign
    text = (F.col("v") + F.lit(0.0)).cast("string")
    return long.where(F.col("v").isNotNull()).groupBy(*keys, "sensor").agg(
        F.hll_sketch_agg(text, F.lit(lg_k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys=()) -> DataFrame:
    """Sketches of coarser ``keys`` from those of finer ones."""
    return sketches.groupBy(*keys, "sensor").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """The sketches' distinct counts in place of the sketches."""
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")


def within_error(estimate, exact, lg_k: int = LG_K, errors: float = 4.0):
    """Whether an estimate is within so many standard errors of the exact count."""
    bound = F.lit(errors * 1.04 / (1 << lg_k) ** 0.5) * exact
    return F.abs(estimate - exact) <= F.greatest(bound, F.lit(0.5))


# ----------------------------------------------------------- co-moments

#: Keys fall into so many buckets by their hash.
KEY_BUCKETS = 4096
#: Rows of a bucket from which on it is taken to hold a key of very many rows.
ROWS_PER_KEY = 1_000_000


def large_buckets(df: DataFrame, bucket) -> list[int]:
    """The buckets with a key of very many rows: those of more than ``ROWS_PER_KEY``
    rows and four times the mean.  All rows of a key are in one bucket, so keys are
    only parted from keys by this.  One row per bucket comes to the driver."""
    counts = [(r[0], r[1]) for r in df.groupBy(bucket).count().collect()]
    limit = max(ROWS_PER_KEY, 4 * sum(n for _, n in counts) // KEY_BUCKETS)
    return sorted(b for b, n in counts if n > limit)


def pair_states(df: DataFrame, pairs, keys, complete: bool = False, deal: bool = False) -> DataFrame:
    """Co-moments of column pairs per key: keys, a, b, n, mean_a, mean_b, saa,
    sbb, sab (sums of centred squares and products) over the rows where both
    are known, or, if ``complete``, where all columns are.

    With ``deal`` the rows themselves are dealt out by key before the aggregate:
    where a key has few rows, a row is much smaller than the unfinished state
    that would move in its place.  Keys of very many rows (see ``large_buckets``)
    are left to the plain aggregate, so that no task is sent all rows of one."""
    pairs = list(pairs)
    columns = sorted({c for p in pairs for c in p})
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)) if deal else None
    large = large_buckets(df, bucket) if deal else []
    if complete:
        df = df.na.drop(subset=columns)
    if deal:
        df = df.select(*keys, *[c for c in columns if c not in keys])
    def state(a, b):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        if complete:  # nothing is null: one count, mean and square sum serve all pairs of a column
            return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.regr_count(x, x).alias("n"),
                            F.regr_avgx(x, x).alias("mean_a"), F.regr_avgx(y, y).alias("mean_b"),
                            F.regr_sxx(x, x).alias("saa"), F.regr_sxx(y, y).alias("sbb"),
                            F.regr_sxy(x, y).alias("sab"))
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.regr_count(x, y).alias("n"),
                        F.regr_avgy(x, y).alias("mean_a"), F.regr_avgx(x, y).alias("mean_b"),
                        F.regr_syy(x, y).alias("saa"), F.regr_sxx(x, y).alias("sbb"),
                        F.regr_sxy(x, y).alias("sab"))
    def states(rows):
        return (rows.groupBy(*keys).agg(F.array(*[state(a, b) for a, b in pairs]).alias("s"))
                .select(*keys, F.inline("s")).where("n > 0"))
    if not large:
        return states(df.repartition(*keys) if deal else df)
    return states(df.where(~bucket.isin(large)).repartition(*keys)).unionByName(
        states(df.where(bucket.isin(large))))


def merge_pair_states(states: DataFrame, keys=()) -> DataFrame:
    """States of coarser ``keys``: centred sums move to the common mean, so that
    nothing large is subtracted.  Null keys are a key of their own.

    Without keys there is one mean per pair: these few rows are broadcast, so the
    states of a pair are not moved into one task."""
    few = not keys
    keys = [*keys, "a", "b"]
    share = lambda m: (F.sum(F.col("n") * F.col(m)) / F.sum("n")).alias(m.replace("mean", "at"))
    means = states.groupBy(*keys).agg(share("mean_a"), share("mean_b")).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "at_a", "at_b")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    da, db = F.col("mean_a") - F.col("at_a"), F.col("mean_b") - F.col("at_b")
    moved = lambda s, d, e: F.sum(F.col(s) + F.col("n") * d * e).alias(s)
    return states.join(F.broadcast(means) if few else means, same).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("at_a").alias("mean_a"), F.first("at_b").alias("mean_b"),
        moved("saa", da, da), moved("sbb", db, db), moved("sab", da, db))


def covariances(states: DataFrame) -> DataFrame:
    """C1 of states of all pairs, a column with itself included: col_i, col_j,
    cov, both triangles."""
    one = states.select("a", "b", safe_divide(F.col("sab"), F.col("n") - 1).alias("cov"))
    other = one.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "cov")
    return one.unionByName(other).withColumnsRenamed({"a": "col_i", "b": "col_j"})


def correlations(states: DataFrame, *keys: str) -> DataFrame:
    """keys, sensor (a), correlation (null where a column is constant)."""
    return states.select(*keys, F.col("a").alias("sensor"), safe_divide(
        F.col("sab"), F.sqrt("saa") * F.sqrt("sbb")).alias("correlation"))


def all_pairs(columns) -> list[tuple[str, str]]:
    columns = list(columns)
    return [(c, c) for c in columns] + list(combinations(columns, 2))
