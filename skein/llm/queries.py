"""Registered queries of the operators, and DuckDB SQL where SQL can express one.

Each query applies its operator to whole tables with the production
parameters and returns a row per document (see the operators' texts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import decontamination, hard_negatives, jaccard, language, licences, line_frequency, periodic_runs, pii, ppm, sentencepieces, sharding, toxicity, warc
from skein.llm.common import documents, remainder


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.report(documents(spark, sf_dir, "doc_id", "source", "text"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.component_ids(documents(spark, sf_dir, "doc_id", "text"), size=3, num=90, den=100)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.fit(docs, toxicity.trained(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "neighbours",
        "similarities",
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(documents(spark, sf_dir, "doc_id", "text"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.report(documents(spark, sf_dir, "doc_id", "text"), seed=42, keep=["doc_id"])


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    place = F.struct(F.col("_file").alias("file"), F.col("_row").alias("row"))
    scored = ppm.score(docs, remainder(F.col("doc_id"), 10) != 0, place=place)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return licences.report(docs, licences.fit(docs))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(documents(spark, sf_dir, "doc_id", "text"), spark.conf.get("spark.skein.pii.key", "not secret"), found="found")
    return out.select("doc_id", "text", F.size("found").alias("n_changed"), "found")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = language.fit(language.trained(documents(spark, sf_dir, "doc_id", "text", "lang")))
    predicted = language.predict(documents(spark, sf_dir, "doc_id", "text"), net, keep=["doc_id"])
    return predicted.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.concat_ws("-", F.hex(F.xxhash64("_file")), "_row")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.report(pages.select("page_id", "url", "html", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")), place)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(documents(spark, sf_dir, "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_line_frequency,
        op2_ngram_jaccard_join,
        op3_benchmark_decontamination,
        op4_toxicity,
        op5_sharding,
        op6_sentencepiece,
        op7_ppm,
        op8_licences,
        op9_pii_pseudonyms,
        op10_language,
        op11_warc,
        op12_hard_negatives,
        op13_periodic_runs,
    )
}

#: The others are beyond SQL, or too slow in it on whole tables: tested against brute force, round trips or held-out rows.
ORACLE: dict[str, str] = {"op1_line_frequency": line_frequency.SQL, "op5_sharding": sharding.sql(), "op11_warc": warc.SQL, "op12_hard_negatives": hard_negatives.SQL}
