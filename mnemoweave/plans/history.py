"""Queries of the validity history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mnemoweave.operators.history import history
from mnemoweave.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(table(spark, sf_dir, "fact_snapshots")).select("fact_id", "snapshot_no")


def p4_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(table(spark, sf_dir, "fact_snapshots")).select("fact_id", "snapshot_no", "valid_from", "valid_to", "valid_to_step", "event", "is_current")


QUERIES = {"p4_found": p4_found, "p4_history": p4_history}

_VERSIONS = """
WITH r AS (
  SELECT fact_id, snapshot_no, taken_at, lower(trim(category)) c, regexp_replace(lower(trim(status)), '[ _-]+', '', 'g') s, last_seen_ts t,
    row_number() OVER (PARTITION BY fact_id, snapshot_no ORDER BY delivery_no DESC NULLS LAST, taken_at DESC, category DESC, status DESC, last_seen_ts DESC, confidence_max DESC) k
  FROM fact_snapshots WHERE fact_id IS NOT NULL AND snapshot_no IS NOT NULL),
v AS (
  SELECT *, row_number() OVER w n, lag(c) OVER w pc, lag(s) OVER w ps, lag(t) OVER w pt FROM r WHERE k = 1
  WINDOW w AS (PARTITION BY fact_id ORDER BY snapshot_no)),
e AS (
  SELECT fact_id, snapshot_no, taken_at, CASE WHEN n = 1 THEN 'inserted' ELSE 'changed' END event FROM v
  WHERE n = 1 OR c IS DISTINCT FROM pc OR s IS DISTINCT FROM ps OR t IS DISTINCT FROM pt)
"""

SQL = {
    "p4_found": _VERSIONS + "SELECT fact_id, snapshot_no FROM e",
    "p4_history": _VERSIONS
    + """, cal AS (SELECT snapshot_no, lead(snapshot_no) OVER (ORDER BY snapshot_no) nx, lead(a) OVER (ORDER BY snapshot_no) nx_at
  FROM (SELECT snapshot_no, min(taken_at) a FROM fact_snapshots WHERE snapshot_no IS NOT NULL GROUP BY 1)),
l AS (SELECT fact_id, max(snapshot_no) snapshot_no FROM v GROUP BY 1),
d AS (SELECT l.fact_id, nx AS snapshot_no, nx_at AS taken_at, 'deleted' AS event FROM l JOIN cal USING (snapshot_no) WHERE nx IS NOT NULL),
u AS (SELECT * FROM e UNION ALL SELECT * FROM d),
p AS (SELECT *, lead(taken_at) OVER (PARTITION BY fact_id ORDER BY snapshot_no) valid_to, lead(snapshot_no) OVER (PARTITION BY fact_id ORDER BY snapshot_no) valid_to_step FROM u)
SELECT fact_id, snapshot_no, taken_at AS valid_from, valid_to, valid_to_step, event, valid_to IS NULL AS is_current FROM p WHERE event <> 'deleted'""",
}
