"""Queries on personal information. No SQL form: tests hold them against written cases and a held-out sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemoweave.llm.pii import fitted, personal_spans, redacted
from mnemoweave.session import spread, table


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "messages").select(F.lit("messages").alias("src"), F.col("seq").cast("string").alias("row_id"), "text")
    f = table(spark, sf_dir, "facts").select(F.lit("facts").alias("src"), F.col("fact_id").alias("row_id"), F.col("fact_text").alias("text"))
    return spread(m).unionByName(spread(f))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir)
    return personal_spans(rows, fitted(rows, table(spark, sf_dir, "name_parts"))).select("src", "row_id", "pii_type", "start_char")


def p2_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir)
    return redacted(rows, fitted(rows, table(spark, sf_dir, "name_parts")))


QUERIES = {"p2_found": p2_found, "p2_redacted": p2_redacted}
SQL: dict[str, str] = {}
