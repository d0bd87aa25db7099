"""Queries pN_... over the driver's tables and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import alignment, budget, confusables, encoding, language, leaks, packing, pairs, repeated_lines


def p1_requests(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "translation_units"), table(spark, d, "request_limits"))


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    return packing.totals(p1_requests(spark, d), table(spark, d, "request_limits"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.found(table(spark, d, "translation_units"), table(spark, d, "translated_nodes"), table(spark, d, "documents"))


def p3_tokens(spark: SparkSession, d: str) -> DataFrame:
    return budget.token_budget(table(spark, d, "documents"), table(spark, d, "translation_units"), table(spark, d, "cost_estimates"))


def p3_texts(spark: SparkSession, d: str) -> DataFrame:
    return p3_tokens(spark, d).select("kind", "doc_id", "source", "lang", "topic", "texts", "distinct_texts", "estimated_input_tokens")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return alignment.found(table(spark, d, "inline_nodes"), table(spark, d, "navigation"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return confusables.found(table(spark, d, "text_primitives"), table(spark, d, "inline_nodes"))


def p5_usual_forms(spark: SparkSession, d: str) -> DataFrame:
    return confusables.usual_forms(table(spark, d, "text_primitives"), table(spark, d, "inline_nodes"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pages = repeated_lines.page_lines(table(spark, d, "text_primitives"))
    return pages.unionByName(repeated_lines.document_lines(table(spark, d, "documents")))


def p6_stripped(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.strip_repeated(table(spark, d, "documents").select("doc_id", "source", "text")).select("doc_id", "text")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_removal_spans(spark: SparkSession, d: str) -> DataFrame:
    return leaks.removal_spans(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return language.found(table(spark, d, "documents"))


def p9_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.languages(table(spark, d, "documents"))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segments(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"p1_totals": packing.TOTALS_SQL, "p3_texts": budget.TEXTS_SQL, "p6_found": repeated_lines.FOUND_SQL, "p6_stripped": repeated_lines.STRIPPED_SQL}
