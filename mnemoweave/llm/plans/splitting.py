"""Queries on oversized items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemoweave.llm.splitting import all_items, split, split_texts
from mnemoweave.session import spread, table


def _items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return all_items(spread(table(spark, sf_dir, "messages").select("seq", "text")), table(spark, sf_dir, "chunk_meta"), table(spark, sf_dir, "size_limits"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that came out in more than one piece."""
    pieces, _ = split(_items(spark, sf_dir)[0], table(spark, sf_dir, "size_limits"))
    return pieces.groupBy("item_kind", "item_id").agg(F.count("*").alias("n")).where("n > 1").select("item_kind", "item_id")


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_texts(*_items(spark, sf_dir), table(spark, sf_dir, "size_limits"))


def p1_piece_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item its pieces, where the last one ends, and whether all are within the limit and each begins before the last one's end."""
    pieces = p1_pieces(spark, sf_dir)
    limits = table(spark, sf_dir, "size_limits").groupBy("item_kind").agg(F.min("max_tokens").alias("max_tokens"))
    return (
        pieces.join(F.broadcast(limits), "item_kind")  # a row per kind
        .groupBy("item_kind", "item_id")
        .agg(F.count("*").alias("pieces"), F.max("end_byte").alias("bytes"), F.bool_and(F.col("n_tokens") <= F.col("max_tokens")).alias("within"), F.sum(F.col("end_byte") - F.col("start_byte")).alias("covered"))
        .select("item_kind", "item_id", "pieces", "bytes", "within", (F.col("covered") >= F.col("bytes")).alias("whole"))
    )


QUERIES = {"p1_found": p1_found, "p1_pieces": p1_pieces, "p1_piece_totals": p1_piece_totals}

_SIZES = """
WITH m AS (SELECT seq, CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT) n FROM messages),
c AS (SELECT DISTINCT chunk_id, first_seq, last_seq FROM chunk_meta),
s AS (
  SELECT 'message' item_kind, CAST(seq AS VARCHAR) item_id, n FROM m
  UNION ALL SELECT 'chunk', chunk_id, sum(n) FROM c JOIN m ON seq BETWEEN first_seq AND last_seq GROUP BY chunk_id)
"""

SQL = {
    "p1_found": _SIZES + "SELECT item_kind, item_id FROM s JOIN size_limits USING (item_kind) WHERE n > max_tokens",
    # cuts stand in windows that depend on the limits alone, so their number is known
    "p1_piece_totals": _SIZES.rstrip() + """,
l AS (SELECT item_kind, max_tokens, max_tokens * 4 - 6 room, least(overlap_tokens * 4, (max_tokens * 4 - 6) // 8 * 4) o FROM size_limits),
w AS (SELECT item_kind, max_tokens, room - o step, greatest((room - o) // 4, 4) reach FROM l)
SELECT item_kind, item_id, CAST(greatest(1, ceil((n * 4 - step + reach) / (step - reach))) + 1 AS BIGINT) AS pieces, n * 4 AS bytes, true AS within, true AS whole FROM s JOIN w USING (item_kind) WHERE n > max_tokens""",
}
