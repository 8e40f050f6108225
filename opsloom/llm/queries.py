"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.llm import (
    alignment, chat, embeddings, html, mixing, packing, quality, resampling, rules, simhash, substrings, toxicity, urls,
)
from opsloom.llm.common import table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


SCORED = ("doc_id", "held_out", "score", "predicted")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(*SCORED)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.line_rules(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.drop("lost", "clean_text")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr("doc_id", "_n_words AS n_words", "_n_removed AS n_removed", "_kept_sha256 AS kept_sha256")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(*SCORED)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.format_turns(chat.probe_turns(table(spark, sf_dir, "conversations"))))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urls.rule_table(spark, urls.RULES)).drop("url")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_main_text": op1_main_text,
        "op2_quality": op2_quality,
        "op3_mixing": op3_mixing,
        "op4_line_rules": op4_line_rules,
        "op5_simhash": op5_simhash,
        "op6_embeddings": op6_embeddings,
        "op7_substrings": op7_substrings,
        "op8_packing": op8_packing,
        "op9_toxicity": op9_toxicity,
        "op10_chat": op10_chat,
        "op11_resampling": op11_resampling,
        "op12_alignment": op12_alignment,
        "op13_url_rules": op13_url_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_line_rules": rules.SQL, "op10_chat": chat.SQL, "op13_url_rules": urls.SQL}
