"""Validity history of changing attributes, from periodic snapshots.

Method: consecutive snapshot differencing. Every fact's snapshots are shifted by one to become the state
"before"; a null-safe full outer join of "before" and "now" on (key, step) classifies each step as inserted,
changed, unchanged or deleted; the change events are united and ``lead`` over them gives the validity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Java's white space and the Unicode blanks, so that outer blanks of any kind are ignored.
_OUTER = r"(?U)^[\s\u001c-\u001f]+|[\s\u001c-\u001f]+$"


def folded(c: Column) -> Column:
    """Letter case and outer blanks removed; null stays null."""
    return F.lower(F.regexp_replace(c, _OUTER, ""))


def folded_status(c: Column) -> Column:
    """As :func:`folded`, and without blank, ``-`` and ``_`` inside."""
    return F.regexp_replace(folded(c), r"(?U)[\s_-]+", "")


def current_rows(snapshots: DataFrame, key: str = "fact_id", step: str = "snapshot_no", version: str = "delivery_no") -> DataFrame:
    """Per (key, step) the row of the greatest version.

    Ties (repeated rows, or disagreeing rows of one version) are settled by the greatest whole row, so the result
    doesn't depend on file order. Rows with a null key or step belong to nothing and are left out; a null version is
    older than any other. Partial aggregation on the map side (``max`` of a struct), so a hot key is folded before
    the shuffle. Extra columns are carried along.
    """
    rest = [c for c in snapshots.columns if c not in (key, step, version)]
    whole = F.struct(F.col(version).alias("v"), *[F.col(f"`{c}`") for c in rest])
    best = (
        snapshots.where(F.col(key).isNotNull() & F.col(step).isNotNull())
        .groupBy(key, step)
        .agg(F.max(whole).alias("__best"))
    )
    return best.select(key, step, F.col("__best.v").alias(version), *[F.col("__best").getField(c).alias(c) for c in rest])


def change_events(snapshots: DataFrame, key: str = "fact_id", step: str = "snapshot_no", at: str = "taken_at", version: str = "delivery_no") -> DataFrame:
    """(key, step, at, category, status, last_seen_ts, event) per inserted or changed version, and the deletions.

    ``deleted`` events stand at the first snapshot of the whole table's calendar after a fact's last row only if
    that snapshot exists; gaps between two rows of a fact aren't deletions (a missing row says nothing).
    """
    now = current_rows(snapshots, key, step, version).select(
        key, step, at, "category", "status", "last_seen_ts",
        F.struct(folded(F.col("category")).alias("c"), folded_status(F.col("status")).alias("s"), F.col("last_seen_ts").alias("t")).alias("__state"),
    )
    # the position of a snapshot among the fact's own; one fact has at most as many as there are snapshots
    own = Window.partitionBy(key).orderBy(step)
    now = now.withColumn("__n", F.row_number().over(own))
    before = now.select(F.col(key), (F.col("__n") + 1).alias("__n"), F.col("__state").alias("__was"), F.lit(True).alias("__had"), F.col(step).alias("__last"))
    # both sides keep the window's partitioning by key: the join on (key, n) needs no further exchange
    both = now.withColumn("__has", F.lit(True)).join(before, [key, "__n"], "full_outer")
    # the calendar is one row per snapshot number: bounded by the number of snapshots ever taken
    calendar = snapshots.where(F.col(step).isNotNull()).groupBy(step).agg(F.min(at).alias("__at"))
    following = calendar.select(
        F.col(step).alias("__last"), F.lead(step).over(Window.orderBy(step)).alias("__next"), F.lead("__at").over(Window.orderBy(step)).alias("__next_at")
    )
    live = both.where(F.col("__has")).select(
        key, step, at, "category", "status", "last_seen_ts",
        F.when(F.col("__had").isNull(), "inserted").when(~F.col("__state").eqNullSafe(F.col("__was")), "changed").otherwise("unchanged").alias("event"),
    )
    gone = (
        both.where(F.col("__has").isNull())
        .join(following, "__last")
        .where(F.col("__next").isNotNull())
        .select(key, F.col("__next").alias(step), F.col("__next_at").alias(at), *[F.lit(None).cast(now.schema[c].dataType).alias(c) for c in ("category", "status", "last_seen_ts")], F.lit("deleted").alias("event"))
    )
    return live.where("event <> 'unchanged'").unionByName(gone)


def history(snapshots: DataFrame, key: str = "fact_id", step: str = "snapshot_no", at: str = "taken_at", version: str = "delivery_no") -> DataFrame:
    """Every version of each key with its period [valid_from, valid_to); valid_to is null for the current one.

    Nulls: null equals null and differs from any value. Rows without key or step are left out. An empty table gives
    an empty history. Repeated rows count once. Columns other than the compared ones don't enter.
    """
    own = Window.partitionBy(key).orderBy(step)
    return (
        change_events(snapshots, key, step, at, version)
        .withColumn("valid_to", F.lead(at).over(own))
        .withColumn("valid_to_step", F.lead(step).over(own))
        .where("event <> 'deleted'")
        .select(key, F.col(step), F.col(at).alias("valid_from"), "valid_to", "valid_to_step", "category", "status", "last_seen_ts", "event", F.col("valid_to").isNull().alias("is_current"))
    )
