"""Queries on near-duplicate facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemoweave.llm.neardup import all_pairs, classes_with_links, near_duplicates
from mnemoweave.session import spread, table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = all_pairs(*near_duplicates(spread(table(spark, sf_dir, "facts").select("fact_id", "category", "fact_text"))))
    return found.select(F.col("id_a").alias("fact_id_a"), F.col("id_b").alias("fact_id_b"))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes_with_links(*near_duplicates(spread(table(spark, sf_dir, "facts").select("fact_id", "category", "fact_text"))))
    return found.select(F.col("id").alias("fact_id"), F.col("rep").alias("class_id"), "links")


QUERIES = {"p5_found": p5_found, "p5_classes": p5_classes}

_FACTS = """
WITH f AS (
  SELECT fact_id, trim(split_part(lower(trim(category)), '.', 1)) g, list_distinct(regexp_extract_all(lower(fact_text), '[\\p{L}\\p{N}]+')) w
  FROM facts WHERE category IS NOT NULL AND fact_text IS NOT NULL),
p AS (
  SELECT a.fact_id a, b.fact_id b, a.w aw, b.w bw FROM f a JOIN f b ON a.g = b.g AND a.fact_id < b.fact_id AND len(a.w) > 0
    AND len(a.w) >= 0.6 * len(b.w) AND len(b.w) >= 0.6 * len(a.w)),
q AS (SELECT a, b, aw, bw, len(list_intersect(aw, bw)) c FROM p)
"""

SQL = {
    "p5_found": _FACTS + "SELECT a AS fact_id_a, b AS fact_id_b FROM q WHERE c >= 0.6 * (len(aw) + len(bw) - c)",
}
