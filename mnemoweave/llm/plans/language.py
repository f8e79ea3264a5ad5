"""Queries on document languages. No SQL form: tests hold them against written texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemoweave.llm.language import document_languages, fitted, segments, wrong_labels
from mnemoweave.session import spread, table


def _segments(spark: SparkSession, sf_dir: str, every: bool) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return segments(spread(docs), *fitted(docs, table(spark, sf_dir, "languages")), every)


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir, False)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrong_labels(p8_segments(spark, sf_dir))


def p8_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document its languages; null with confidence 0 where there is no word to judge."""
    return document_languages(_segments(spark, sf_dir, True), True).select("doc_id", "lang", F.round("confidence", 3).alias("confidence"), "n_chars", "label_lang")


QUERIES = {"p8_found": p8_found, "p8_segments": p8_segments, "p8_documents": p8_documents}
SQL: dict[str, str] = {}
