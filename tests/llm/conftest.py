import pytest
from pyspark.sql import types as T


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text, lang, source) tuples, with extra columns
    whose names clash with those that operators make."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
        T.StructField("fp", T.StringType()), T.StructField("kept", T.StringType()),
        T.StructField("start", T.LongType()), T.StructField("salt", T.StringType())])

    def make(rows, partitions=3):
        full = [(*r, None if r[1] is None else len(r[1]), "s", None, "k", 7, "x") for r in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


#: Rows that every operator on documents has to bear.
@pytest.fixture
def odd_rows():
    long_text = " ".join(f"w{i % 997}" for i in range(60_000))
    return [(1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"),
            (4, long_text, "en", "a"), (5, "plain words here", "de", "b"),
            (5, "plain words here", "de", "b"), (6, "plain words here", "de", "b"),
            (None, "no id at all", "fr", "c"), (None, None, None, None),
            (7, "é ü 漢字 🎉 x\x0by", "xx", "b")]
