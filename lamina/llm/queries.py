"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (
    decontaminate, kdtree, language_id, licenses, merkle, mixing, near_dup, perspectives, pii, toxicity, url_filter, warc, whitening,
)

TOP, QUERY_STEP = 5, 50


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derivatives(warc.responses_of_pages(table(spark, folder, "pages")))


def mix_to_weights(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leak_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, and where the worst sentence lies."""
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    worst = F.array_max(F.transform("sentences", lambda s: F.struct(s["score"], (-s["start"]).alias("at"), s["end"])))
    return scored.select(
        "doc_id", "held_out", "score", "predicted", F.size("sentences").alias("n_sentences"),
        (-worst["at"]).alias("worst_start"), worst["end"].alias("worst_end"),
    )


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = kdtree.integer_vectors(table(spark, folder, "embeddings"))
    return kdtree.top_k(vectors, F.col("vec_id") % QUERY_STEP == 0, TOP)


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.identify(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "class_size", F.lower(F.hex("node")).alias("text_md5"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def rotated_dialogues(spark: SparkSession, folder: str) -> DataFrame:
    return perspectives.perspectives(table(spark, folder, "conversations"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.find(docs, pii.train(docs))


def whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judged(pages, url_filter.train(url_filter.labelled_by_rules(pages)))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_derivatives": warc_derivatives,
        "op2_mix_to_weights": mix_to_weights,
        "op3_benchmark_leaks": benchmark_leaks,
        "op4_toxicity": toxicity_scores,
        "op5_kdtree_top_k": nearest_vectors,
        "op6_language_id": languages,
        "op7_near_duplicates": near_duplicates,
        "op8_license_scan": license_scan,
        "op9_perspectives": rotated_dialogues,
        "op10_personal_data": personal_data,
        "op11_whitened_vectors": whitened_vectors,
        "op12_url_verdicts": url_verdicts,
        "op13_merkle_manifest": merkle_manifest,
    }
