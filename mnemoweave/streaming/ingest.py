"""Incremental ingestion: a batch of claims is merged into a store as one transaction, also from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mnemoweave.operators import store as S
from mnemoweave.operators.claims import unmergeable
from mnemoweave.session import checkpointed
from mnemoweave.sources.snapshots import Store


class Refused(ValueError):
    """A merge that was not begun: nothing of it is in the store."""


def merge_batch(store: Store, batch: DataFrame, imported_at: float | None = None, issues: DataFrame | None = None, least: float = 0.7) -> dict[str, int]:
    """Merges claims into the store: all of its tables change with one pointer, or none does. Returns counts.

    Refused are batches with a secret or without a required field in any claim, and those with an error among their
    validation `issues`. Claims that the store has are known by their content. Facts are updated from their rows and the batch
    alone (:func:`mnemoweave.operators.store.merged`), so decisions stay; exclusive categories are folded file by file behind.
    """
    store.bootstrap()
    if issues is not None and issues.where("level = 'error'").limit(1).count():
        raise Refused("the validation has errors")
    batch = checkpointed(batch)
    wrong = unmergeable(batch).orderBy("seq").first()
    if wrong is not None:
        raise Refused(f"claim {wrong['seq']}: {wrong['reason']}")
    at = store.current()
    old = {k: store.read(k) for k in ("claims", "facts", "evidence", "links", "flags", "reviews")}
    identified = checkpointed(S.identified(batch))
    new_ids = identified.select("claim_id").join(old["claims"], "claim_id", "left_anti")
    cutoff = S.cutoffs(old["reviews"])
    facts = checkpointed(S.merged(old["facts"], batch, old["claims"], cutoff, imported_at))
    # of exclusive categories the fold over the files decides on the status; reopened facts take part in it
    again = old["facts"].where("status = 'rejected'").select("fact_id").join(facts.where("status <> 'rejected'").select("fact_id"), "fact_id")
    prior = old["facts"].join(again.withColumn("__again", F.lit(True)), "fact_id", "left").withColumn("status", F.when(F.col("__again"), "needs_review").otherwise(F.col("status")))
    fold = S.fold_latest_only(batch, prior=prior).select("fact_id", F.col("status").alias("__folded"))
    facts = checkpointed(facts.join(fold, "fact_id", "left").withColumn("status", F.coalesce("__folded", "status")).drop("__folded"))
    was = old["facts"].select("fact_id", F.col("stability").alias("__was"), F.col("status").alias("__status"))
    both = facts.join(was, "fact_id")
    changed = both.where("__was <> stability").select("fact_id", F.lit("stability_change").alias("flag_type"), F.lit("").alias("detail"))
    fresh = S.stability_flags(batch).join(was, "fact_id", "left_anti").select("fact_id", F.lit("stability_change").alias("flag_type"), F.lit("").alias("detail"))
    again = both.where("__status = 'rejected' and status <> 'rejected'").select("fact_id", F.lit("reopened_after_new_evidence").alias("flag_type"), F.lit(str(imported_at)).alias("detail"))
    rivals = S.conflicts(facts, least=least).select("fact_id", F.lit("exclusive_conflict").alias("flag_type"), F.lit(str(least)).alias("detail"))
    raised = changed.unionByName(fresh).unionByName(again).unionByName(rivals)
    raised = raised.withColumn("flag_id", F.sha2(F.concat_ws("\n", "fact_id", "flag_type", "detail"), 256)).dropDuplicates(["flag_id"])
    flags = checkpointed(raised.join(old["flags"].select("flag_id"), "flag_id", "left_anti"))
    evidence = S.evidence_rows(batch).join(old["evidence"].select("evidence_id"), "evidence_id", "left_anti")
    links = S.links(batch).join(old["links"], ["fact_id", "claim_id"], "left_anti")
    tables = {
        "claims": old["claims"].unionByName(new_ids), "facts": facts, "evidence": old["evidence"].unionByName(evidence),
        "links": old["links"].unionByName(links), "flags": old["flags"].unionByName(flags),
    }
    store.write(tables, expected=at)
    seen = identified.select("fact_id").distinct().join(was, "fact_id", "left")
    n = seen.agg(F.count("*").alias("facts"), F.count("__status").alias("facts_updated")).first()
    return {
        "claims_new": new_ids.count(), "facts_inserted": n["facts"] - n["facts_updated"], "facts_updated": n["facts_updated"],
        "flags": flags.count(), "reopened": flags.where("flag_type = 'reopened_after_new_evidence'").count(),
    }


def decide_batch(store: Store, actions: DataFrame, decided_at: float) -> int:
    """Applies decisions (seq, fact_id, action, ...) to the store as one transaction; returns how many reviews are new.

    A decision that the store has already, by its line's identity, isn't recorded again, so its time stays.
    """
    store.bootstrap()
    at, reviews = store.current(), store.read("reviews")
    facts, audit = S.decide(store.read("facts"), actions)
    given = actions.select("seq", "fact_id", *[c for c in ("reason", "decided_by", "source_path", "source_line") if c in actions.columns])
    rows = audit.join(given, ["seq", "fact_id"])
    for name, kind in (("reason", "string"), ("decided_by", "string"), ("source_path", "string"), ("source_line", "long")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    new = checkpointed(S.new_reviews(rows, reviews).withColumn("decided_at", F.lit(decided_at)))
    store.write({"facts": facts, "reviews": reviews.unionByName(new.select(*reviews.columns))}, expected=at)
    return new.count()


def stream_claims(spark: SparkSession, source: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Runs :func:`merge_batch` on what a streaming source of claims has; ends when it is up to date. A batch that is run again
    after a failure changes nothing that is there."""
    store = Store(spark, folder)
    return source.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: merge_batch(store, df)).start()


def late_messages(messages: DataFrame, delay: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Messages per role and window of their own time; those later than the watermark are left out. For streams."""
    at = messages.where("ts is not null").withColumn("at", F.timestamp_seconds("ts"))
    return at.withWatermark("at", delay).groupBy(F.window("at", window), "role").agg(F.count("*").alias("messages"))
