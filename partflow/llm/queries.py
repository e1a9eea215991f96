"""Registered queries of the training-data operators, over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from partflow.llm import (
    chat, decontamination, hard_negatives, lines, mixing, neighbours, passages, private, simhash, token_files, tokens, toxicity,
    vector_codes)
from partflow.llm.common import table
from partflow.llm.sql import TWINS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        decontamination.item_digest(F.col("item_ids")).alias("items_sha256"), "contaminated")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_private(spark: SparkSession, folder: str) -> DataFrame:
    return private.find_private(table(spark, folder, "documents"))


def op5_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digest_lines(table(spark, folder, "documents"))


def op6_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(table(spark, folder, "documents"))


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.with_probe(spark, table(spark, folder, "conversations"))
    return chat.digest_chats(chat.format_chats(rows))


def op8_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search_fiftieths(table(spark, folder, "embeddings"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.digest_codes(table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine_fiftieths(table(spark, folder, "embeddings"))


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.digest_tokens(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_private": op4_private,
    "op5_lines": op5_lines,
    "op6_tokens": op6_tokens,
    "op7_chat": op7_chat,
    "op8_passages": op8_passages,
    "op9_toxicity": op9_toxicity,
    "op10_neighbours": op10_neighbours,
    "op11_vector_codes": op11_vector_codes,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_files": op13_token_files,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(TWINS)
