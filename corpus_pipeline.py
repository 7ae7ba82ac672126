"""From documents to packed sequences: the stages of a training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes
the result of a stage as Parquet to the shared folder and reads it again as
the next one's documents.  All but the last return the columns of documents.

Every stage bears nulls in any column, empty and very long texts, repeated
rows, empty tables (it returns none) and further columns of any name, dots
included, which all but the last carry along.  What each does with them is said
below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import mixing, packing, quality, secrets, simhash
from vigil.llm.common import stored, table
from vigil.llm.queries import word_tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  A null or blank text has no words
    and is rejected; a null language is a language of its own; of repeated rows
    all are kept or none."""
    return quality.keep_good(docs)


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles,
    fingerprints linked at two or fewer differing bits.  Of a group the smallest
    id stays, null ids last, of repeated rows one; texts without words are one
    group."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in a text replaced by a mark and n_chars
    following it.  Null and empty texts stay as they are; repeated rows are
    treated alike."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each whole copy of a document that the mix takes, and one with
    its first words for the document it takes in part.  A null source is a source
    of its own; documents without words (null, empty, blank) are taken zero
    times; repeated rows are documents of their own."""
    return mixing.mix_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences.  A null or
    empty text is its end id alone; a null id is carried; repeated rows are
    packed as often as they occur."""
    return packing.pack_documents(docs, word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_neardup", simhash_neardup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Packing needs a tokenizer, which SQL lacks.
ORACLE_SQL = None
