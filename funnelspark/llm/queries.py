"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.llm import bpe, decontaminate, langid, licenses, minhash, quality, sanitize, substrings, toxicity, trie, urls, warc, whitening
from funnelspark.llm.common import ship_package, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge_urls(pages, F.col("url"), keep=["page_id"]).select("page_id", "host", "path", "rule", "verdict")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge(docs, F.col("text"), ["lang", "source"], keep=["doc_id"])
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "distance")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"), F.col("page_id"), F.col("url"), F.col("html"))
    return warc.read_records(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, F.col("doc_id"), F.col("text")).drop("spans")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, F.col("text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = substrings.remove_repeats(docs.select("doc_id", "text"), F.col("doc_id"), F.col("text"), texts=False, keep=["doc_id"])
    return made.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, F.col("doc_id"), F.col("text")).select("doc_id", "class_id", "class_size")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_texts(docs, F.col("text"), tokenizer_path(), ids=False, keep=["doc_id"]).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = sanitize.find_personal(docs, F.col("text"), keep=["doc_id"])
    return found.select(
        "doc_id", *[f"n_{k}" for k in sanitize.KINDS], F.sha2(sanitize.written(F.col("found"), base_only=True), 256).alias("base_sha256"),
        sanitize.written(F.col("found")).alias("spans"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    training = toxicity.packed(docs.where(~F.coalesce(held_out, F.lit(False))), F.col("doc_id"), F.col("text")).join(labels.hint("merge"), "doc_id")  # labels grow with the data
    scored = toxicity.score_texts(docs, F.col("text"), toxicity.fit(training, F.col("text"), F.col("label")), keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    field = langid.fit(docs.where(~held_out), F.col("text"), F.col("lang"))
    return langid.predict(docs, F.col("text"), field, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return trie.prefix_trie(turns, F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, F.col("embedding"), keep=["vec_id"])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _shipped(f) for f in (op1_url_filter, op2_quality, op3_warc, op4_licenses, op5_decontaminate, op6_substring_dedup, op7_near_duplicates, op8_bpe, op9_personal_data, op10_toxicity, op11_language, op12_prefix_trie, op13_whitening)}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run
