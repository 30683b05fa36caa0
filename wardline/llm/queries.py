"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (bitslice, conversation, decontaminate, html_text, language_id, license_scan, near_dup, packing, ppm, quality,
                          resample, secret_scan, token_file)
from wardline.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT
    scored = quality.score(docs, quality.learn_model(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), ppm.FOLDS) == ppm.HELD_OUT
    return ppm.score(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                             "base_score", "score")


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), language_id.FOLDS) == language_id.HELD_OUT
    model = language_id.learn_model(docs, ~held_out)
    return language_id.detect(docs, model, runs=False).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.round_trip(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.digest(*conversation.repair(conversation.damage(table(spark, sf_dir, "conversations"))))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_topk_search, op3_quality, op4_packing, op5_license_scan, op6_decontaminate, op7_ppm_score,
    op8_near_dup, op9_html_text, op10_language_id, op11_token_file, op12_conversation_repair, op13_resample)}
ORACLE: dict[str, str] = {"op1_secret_scan": secret_scan.ORACLE, "op2_topk_search": bitslice.ORACLE,
                          "op6_decontaminate": decontaminate.ORACLE, "op8_near_dup": near_dup.ORACLE,
                          "op12_conversation_repair": conversation.ORACLE, "op13_resample": resample.ORACLE}
