"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.config import SIZE_BUCKET_OTHER, SIZE_BUCKET_OVER, SIZE_BUCKETS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_seconds(c="when") -> Column:
    """Epoch milliseconds -> seconds, rounded half up, as LONG (Trap T1:
    an int ``when`` overflows later under ANSI)."""
    return F.round(_c(c) / 1000).cast("long")


def readable_time(c="when") -> Column:
    """Epoch seconds -> 'yyyy-MM-dd HH:mm:ss' in the session zone."""
    return F.from_unixtime(_c(c))


def scale_decimals(df: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """Divide the listed columns by 10**d in one projection."""
    return df.select(*[
        (F.col(c) / (10 ** decimals[c])).alias(c) if c in decimals else F.col(c)
        for c in df.columns
    ])


def round_half_up(c, digits: int = 2) -> Column:
    """Rounding used by the grid (Trap T23): ties go away from zero, NaN
    stays NaN.

    Written as plain arithmetic, sign * floor(|x|*10^d + 0.5)/10^d, so that
    Spark and the SQL twin give the same double on ties."""
    p, x = 10 ** digits, _c(c).cast("double")
    return F.when(F.isnan(x), x).otherwise(
        F.signum(x) * F.floor(F.abs(x) * p + 0.5) / p + F.lit(0.0))


def size_bucket(c="count") -> Column:
    """P10: row-count label; ranges are closed on both ends."""
    col = _c(c)
    expr = None
    for label, lo, hi in SIZE_BUCKETS:
        cond = col.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(col > SIZE_BUCKETS[-1][2], SIZE_BUCKET_OVER).otherwise(
        SIZE_BUCKET_OTHER)


def size_bucket_rank(label_col) -> Column:
    """Report order of the size labels (labels not listed sort last)."""
    col = _c(label_col)
    expr = None
    for i, (label, _, _) in enumerate(SIZE_BUCKETS, start=1):
        expr = F.when(col == label, i) if expr is None else expr.when(col == label, i)
    n = len(SIZE_BUCKETS) + 1
    return expr.when(col == SIZE_BUCKET_OVER, n).otherwise(n)


def bit_is_set(word, bit: int) -> Column:
    """M1: 1 if bit ``bit`` (1 = least significant) of the integer word is
    set, 0 if not, null if the word is null.  The word is cast to int first
    (Trap T5: a bit test on a double is an analysis error)."""
    return (_c(word).cast("int").bitwiseAND(1 << (bit - 1)) > 0).cast("int")


def safe_divide(a, b) -> Column:
    """Null instead of an ANSI divide-by-zero error (Trap T2)."""
    return F.try_divide(_c(a), _c(b))


def equal_width_bin(x, lo, hi, n: int) -> Column:
    """Bin 0..n-1 of ``x`` in [lo, hi] with n equal bins, last bin closed
    (Trap T18).  ``lo``/``hi`` may be columns."""
    lo_c, hi_c = _c(lo) if not isinstance(lo, (int, float)) else F.lit(lo), \
        _c(hi) if not isinstance(hi, (int, float)) else F.lit(hi)
    width = (hi_c - lo_c) / n
    raw = F.floor(safe_divide(_c(x) - lo_c, width))
    return F.when(hi_c == lo_c, F.lit(0)).otherwise(
        F.least(F.greatest(raw, F.lit(0)), F.lit(n - 1))).cast("int")
