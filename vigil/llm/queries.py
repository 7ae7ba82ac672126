"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (bpe, conversations, embedding_neardup, html_extract, licenses, merkle,
                       mixing, packing, quality, secrets, simhash, token_attribution, warc)
from vigil.llm.common import new_name, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def word_tokenizer() -> str:
    """Path of the public word-level BPE vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("epochs", "row_no")


@query
def op7_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_of(groups.fp).alias("fingerprint"), "component_id")


@query
def op6_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())


@query
def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.records_of(warc.round_trip(spark, table(spark, sf_dir, "pages")))


@query
def op10_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op5_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = token_attribution.attribute_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)
    return found.withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neardup.link_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every seventh document (by a checksum of its id) is shown with n_chars
    # one higher than the manifest has it
    docs = table(spark, sf_dir, "documents")
    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
                  F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(
                      F.col("n_chars").cast("decimal(20,0)"))
    shown = merkle.leaf_of(*[more if f == "n_chars" else F.col(f) for f in merkle.FIELDS])
    rows = merkle.manifest(docs, claim=shown)
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join("path", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.encode_texts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(tokens, ranks)


def damaged_conversations(convs: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with the damage that op11 is to repair, and the column of the
    rows that it drops."""
    code, gone = new_name(convs, "code"), new_name(convs, "gone")
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" "))
                               for c in ("conv_id", "turn")])
    hit = F.col(code)
    role, text = [F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")]
    rows = convs.withColumn(code, (F.crc32(place.cast("binary")) % 20).cast("int")).select(
        "conv_id", "turn", (hit == 0).alias(gone), hit,
        F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"))
    twice = F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("*", twice.alias(new_name(rows, "copy"))), F.col(gone)


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, gone = damaged_conversations(table(spark, sf_dir, "conversations"))
    return conversations.digests(conversations.repair(rows, ignored=gone))
