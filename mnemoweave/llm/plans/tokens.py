"""Encoding of the corpus and filling of containers. Neither has an SQL form: tests hold them against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemoweave.llm.bpe import encoded_documents
from mnemoweave.llm.packing import packed_documents
from mnemoweave.session import spread, table


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "size_limits"))


def p7_container_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use of each container."""
    return p7_containers(spark, sf_dir).groupBy("container_id").agg(F.count("*").alias("items"), F.sum("n_tokens").alias("tokens"))


QUERIES = {"p6_ids": p6_ids, "p7_containers": p7_containers, "p7_container_fill": p7_container_fill}
SQL: dict[str, str] = {}
