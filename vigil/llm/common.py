"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import scratch_path

#: Word separators: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"

#: Rows of small side tables are repeated this often so that the rows of one
#: hot join key spread over as many tasks.
SALTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return scratch_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage there,
    so that a lost executor costs neither a recomputation nor a change of
    values that depend on row order."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text; none for null and white space only."""
    return F.array_remove(F.split(text_or_empty(text), SPACE), "")


def symbols_in(text: Column) -> Column:
    """Characters of ``#*$%&|<>`` in a text."""
    t = text_or_empty(text)
    return F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))


def salted(df: DataFrame, column: str = "salt", salts: int = SALTS) -> DataFrame:
    """The small side of a join, once per salt."""
    return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def new_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def small(df: DataFrame, name: str, rows: int = 100_000) -> DataFrame:
    """``df`` written once, and broadcast if it was counted to have at most
    ``rows`` rows; beyond that Spark joins it as it sees fit."""
    df = stored(df, name)
    return F.broadcast(df) if df.count() <= rows else df
