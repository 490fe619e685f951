"""Registered queries of the subpackage; each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    bpe, codebooks, decontamination, hilbert, licenses, mixing, packing, partenum, secret_scan, sharding, spelling, toxicity, warc,
)
from salesmart.session import work_dir

#: Tokens beyond which a document counts as over the limit.
TOKEN_LIMIT = 512

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.by_position(mixing.mix(_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("first_position", 6).alias("first_position"))


def op2_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = partenum.similar_groups(_table(spark, sf_dir, "documents"), n_words=4, num=85, den=100)
    return documents.select("doc_id", "n_shingles", "component_id")


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.search(_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.flag(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_items"),
        F.transform("leaks", lambda x: x["item_id"]).alias("items"),
        F.transform("leaks", lambda x: x["distance"]).alias("distances"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.spans(F.coalesce("text", F.lit(""))).alias("found"))
    return found.select("doc_id", *[c.alias(n) for n, c in secret_scan.digest_columns(F.col("found")).items()])


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = licenses.scan(_table(spark, sf_dir, "documents"))
    return documents.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), teaches=~toxicity.held_out(F.col("doc_id")))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "slot", "shard_id", "shard")


def op9_tokens(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    counted = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        bpe.token_count(spark, F.col("text"), vocabulary).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, null_ids_revisit=False)
    return warc.page_captures(warc.assemble(warc.read_archives(spark, path, with_payload=False)))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codebooks.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(_table(spark, sf_dir, "documents"), vocabulary)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_partenum": op2_partenum,
    "op3_hilbert": op3_hilbert,
    "op4_decontamination": op4_decontamination,
    "op5_secrets": op5_secrets,
    "op6_licenses": op6_licenses,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_tokens": op9_tokens,
    "op10_warc": op10_warc,
    "op11_codes": op11_codes,
    "op12_spelling": op12_spelling,
    "op13_packing": op13_packing,
}
