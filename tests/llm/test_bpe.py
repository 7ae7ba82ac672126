"""Chunked byte-level BPE against the tokenizer library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from vigil.llm import bpe
from vigil.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def ids_of(text):
    return bpe._encoding(PATH, PATTERN).encode_ordinary(text or "")


def row_of(doc, text):
    raw = np.array(ids_of(text), "<u4").tobytes()
    return (doc, len(raw) // 4, hashlib.sha256(raw).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def built(df, **options):
    tokens = bpe.encode_texts(df, PATH, PATTERN, **options)
    return sorted(map(tuple, bpe.digests(tokens, PATH).collect()), key=str)


def random_texts(n, seed):
    rnd = random.Random(seed)
    parts = ["we're", "'s", "'", "''re", " ", "  ", "\n", " \n ", "\t", "ab", "ABC", "12", "3", "!?", "é",
             "漢字", "🎉", " ", "x" * 40, " " * 30, "\x1c", "\U00010940", "\U00016ea7", "-", "0" * 25]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 80))) for _ in range(n)]


@pytest.mark.parametrize("chunk,overlap", [(5, 4), (16, 8), (64, 20)])
def test_stitched_chunks_equal_whole_texts(docs_of, chunk, overlap):
    texts = random_texts(150, chunk)
    df = docs_of([(i, t, "en", "a") for i, t in enumerate(texts)])
    assert built(df, chunk=chunk, overlap=overlap) == sorted(
        (row_of(i, t) for i, t in enumerate(texts)), key=str)


def test_odd_rows_long_tokens_and_special_strings(docs_of, odd_rows):
    rows = odd_rows + [(20, "a" * 70_000, "en", "a"), (21, "x" + "\n" * 40_000 + "y", "en", "a"),
                       (22, "<|endoftext|> " * 3000, "en", "a"), (20, "a" * 70_000, "en", "a")]
    df = docs_of(rows).select("*", F.lit(1).alias("row"), F.lit(2).alias("a.b"), F.lit(3).alias("body"))
    got = built(df)
    whole = bpe._encoding(PATH, r"[\s\S]+")  # the library's own pattern stops at long blanks

    def expected(doc, text):
        if doc != 21:
            return row_of(doc, text)
        pieces = ["x", "\n" * 39_999, "\n", "y"]
        raw = np.array([i for p in pieces for i in whole.encode_ordinary(p)], "<u4").tobytes()
        return (doc, len(raw) // 4, hashlib.sha256(raw).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest())

    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)


def test_empty_table(docs_of):
    assert built(docs_of([])) == []


def test_parts_of_a_long_text_follow_each_other(docs_of):
    text = " ".join(f"word{i}" for i in range(3000))
    df = docs_of([(1, text, "en", "a")])
    parts = bpe.decode_ids(bpe.encode_texts(df, PATH, PATTERN, chunk=1000, overlap=50), PATH)
    rows = sorted(parts.collect(), key=lambda r: r.start)
    assert len(rows) > 10
    assert b"".join(r.bytes for r in rows).decode() == text
    assert [r.start for r in rows] == [sum(len(x.bytes) for x in rows[:i]) for i in range(len(rows))]


def test_classes_of_all_characters_are_those_of_the_library():
    own = regex.compile(bpe.python_pattern(PATTERN))
    every = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    for mate in ("a", "1", "!"):
        theirs = bpe._in_one_piece(PATTERN, every, mate)
        mine = {c for c in every if own.match(c + mate).end() == 2}
        assert mine == theirs


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES["op13_byte_bpe"](spark, sf).collect()))
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got == sorted(row_of(d.doc_id, d.text) for d in docs)
