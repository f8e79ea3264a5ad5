"""Queries on credentials in listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mnemoweave.llm.secrets import credentials, redacted
from mnemoweave.session import spread, table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials(spread(table(spark, sf_dir, "messages").select("seq", "text"))).select("seq", "start_char")


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redacted(spread(table(spark, sf_dir, "messages").select("seq", "text")))


QUERIES = {"p3_found": p3_found, "p3_redacted": p3_redacted}
SQL: dict[str, str] = {}
