"""Reports on the store, and progress of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemoweave.functions import text as X


def _order() -> list[Column]:
    return [
        F.col("category").asc_nulls_first(), F.when(F.col("stability") == "stable", 0).otherwise(1).asc(), F.when(F.col("status") == "accepted", 0).otherwise(1).asc(),
        F.coalesce("confidence_max", F.lit(0.0)).desc(), F.coalesce("last_seen_ts", F.lit(0.0)).desc(), F.col("fact_id").asc(),
    ]


def report_filter(store: DataFrame, needs_review: bool = False, rejected: bool = False) -> DataFrame:
    """Accepted facts; those to review and the rejected and superseded ones on request. Unknown states count as to review."""
    keep = F.col("status") == "accepted"
    if needs_review:
        keep = keep | ~F.col("status").isin("accepted", "rejected", "superseded")
    if rejected:
        keep = keep | F.col("status").isin("rejected", "superseded")
    return store.where(keep)


def top_evidence(evidence: DataFrame, k: int = 3) -> DataFrame:
    """Per fact the k best evidences with their rank: the user's first, then the latest, then by id.

    A heavily evidenced fact is split by a hash first; the best k of its parts compete (k rows each)."""
    if k <= 0:
        return evidence.withColumn("rank", F.lit(0)).limit(0)
    order = [F.when(F.col("role") == "user", 0).otherwise(1), F.col("ts").desc_nulls_last(), F.col("evidence_id")]
    once = evidence.dropDuplicates(["evidence_id"])
    part = once.withColumn("__p", F.pmod(F.xxhash64("evidence_id"), F.lit(32)))
    best = part.withColumn("__r", F.row_number().over(Window.partitionBy("fact_id", "__p").orderBy(*order))).where(F.col("__r") <= k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("fact_id").orderBy(*order))).where(F.col("rank") <= k).drop("__p", "__r")


def flags_by_fact(flags: DataFrame) -> DataFrame:
    return flags.groupBy("fact_id").agg(F.array_sort(F.collect_set("flag_type")).alias("flags"))


def derived_rollup(links: DataFrame, claims: DataFrame) -> DataFrame:
    """Per linked fact where it comes from: assistant before mixed before user, else unknown."""
    rank = F.max(F.when(F.col("derived_from") == "assistant", 3).when(F.col("derived_from") == "mixed", 2).when(F.col("derived_from") == "user", 1).otherwise(0))
    return links.join(claims.select("claim_id", "derived_from"), "claim_id").groupBy("fact_id").agg(rank.alias("__r")).select("fact_id", F.element_at(F.array(*map(F.lit, ("unknown", "user", "mixed", "assistant"))), F.col("__r") + 1).alias("derived_from"))


SECTIONS = ("flagged", "low_confidence", "assistant_derived", "other")


def review_queue(store: DataFrame, flags: DataFrame, derived: DataFrame, low: float = 0.6) -> DataFrame:
    """(fact_id, section) of the facts to review, each in the first section that it belongs to."""
    s = store.where("status = 'needs_review'").join(flags_by_fact(flags), "fact_id", "left").join(derived, "fact_id", "left")
    section = F.when(F.col("flags").isNotNull(), "flagged").when(F.col("confidence_max") < low, "low_confidence").when(F.col("derived_from").isin("assistant", "mixed"), "assistant_derived").otherwise("other")
    return s.select("fact_id", section.alias("section"))


def review_counts(store: DataFrame, flags: DataFrame, derived: DataFrame, low: float = 0.6) -> DataFrame:
    """One row: how many facts to review each section could have; the sections overlap here."""
    s = store.where("status = 'needs_review'").join(flags_by_fact(flags), "fact_id", "left").join(derived, "fact_id", "left")
    return s.agg(F.count_if(F.col("flags").isNotNull()).alias("flagged"), F.count_if(F.col("confidence_max") < low).alias("low_confidence"), F.count_if(F.col("derived_from").isin("assistant", "mixed")).alias("assistant_derived"), F.count("*").alias("needs_review"))


def worklist(store: DataFrame, flags: DataFrame) -> DataFrame:
    """Facts to review with their flags and empty action and reason, in order."""
    s = store.where("status = 'needs_review'").join(flags_by_fact(flags), "fact_id", "left")
    return s.select("fact_id", "category", F.col("fact_text").alias("fact"), "stability", "confidence_max", "last_seen_ts", "status", F.coalesce("flags", F.array().cast("array<string>")).alias("flags"), F.lit(None).cast("string").alias("action"), F.lit(None).cast("string").alias("reason"))


def evidence_lines(evidence: DataFrame, quote: int = 240, k: int = 3) -> DataFrame:
    """(fact_id, __ev): the lines of each fact's best evidences; at most k, so what is gathered is bounded."""
    line = F.concat(
        F.lit("    - “"), X.ellipsis(X.single_line(F.col("quote")), quote), F.lit("” (`conv_id="), F.col("conv_id"), F.lit("`, `message_id="), F.col("message_id"),
        F.lit("`, `ts="), X.format_ts(F.col("ts")), F.lit("`, `role="), F.col("role"), F.lit("`)\n"),
    )
    return top_evidence(evidence, k).groupBy("fact_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))), lambda x: x["l"]), "").alias("__ev"))


def fact_blocks(store: DataFrame, evidence: DataFrame, quote: int = 240, k: int = 3, with_status: bool = False) -> DataFrame:
    """Per fact its report key and Markdown block."""
    s = store.join(evidence_lines(evidence, quote, k), "fact_id", "left")
    block = F.concat(
        F.lit("- Fact: "), X.single_line(F.col("fact_text")), F.lit("\n"), F.concat(F.lit("  - Status: `"), F.col("status"), F.lit("`\n")) if with_status else F.lit(""),
        F.lit("  - As of: `"), X.format_ts(F.col("last_seen_ts")), F.lit("`\n  - Confidence: `"), F.coalesce(X.format_confidence(F.col("confidence_max")), F.lit("unknown")), F.lit("`\n"),
        _evidence(),
    )
    return s.select(*store.columns, X.report_key(F.col("category")).alias("report"), block.alias("block"))


def _evidence() -> Column:
    return F.coalesce(F.concat(F.lit("  - Evidence:\n"), F.col("__ev")), F.lit("  - Evidence: (missing)\n"))


# Headings of the review document.
REVIEW_HEADS = {"flagged": "Conflicts", "low_confidence": "Low-confidence items", "assistant_derived": "Assistant-derived (unconfirmed)", "other": "Other needs-review"}


def review_lines(store: DataFrame, flags: DataFrame, derived: DataFrame, evidence: DataFrame, low: float = 0.6, quote: int = 240) -> DataFrame:
    """(place, section, fact_id, line): the review document, a row per heading and per fact, in order of place and fact_id.

    `flags` are (fact_id, flag_type, detail). A fact stands in the first section that it belongs to; a section without any says
    so. Rows are ordered by range, not gathered.
    """
    queue = review_queue(store, flags, derived, low)
    detail = F.concat(F.lit("  - Flag: `"), F.col("flag_type"), F.lit("`\n    - Detail: "), X.single_line(F.coalesce("detail", F.lit(""))), F.lit("\n"))
    raised = flags.distinct().withColumn("__l", detail).groupBy("fact_id").agg(F.array_join(F.array_sort(F.collect_list("__l")), "").alias("__flags"))  # a few kinds per fact
    rows = queue.join(store.drop("section"), "fact_id").join(raised, "fact_id", "left").join(derived, "fact_id", "left").join(evidence_lines(evidence, quote), "fact_id", "left")
    sure = F.coalesce(X.format_confidence(F.col("confidence_max")), F.lit("unknown"))
    said, mine = X.single_line(F.col("fact_text")), F.col("section")
    tail = F.concat(F.lit("  - Status: `"), F.col("status"), F.lit("`\n"))
    block = F.when(
        mine == "flagged",
        F.concat(F.lit("- Category: `"), F.col("category"), F.lit("`\n  - Fact ID: `"), F.col("fact_id"), F.lit("`\n  - Fact: "), said, F.lit("\n"), tail, F.coalesce("__flags", F.lit(""))),
    ).otherwise(
        F.concat(
            F.lit("- Candidate: "), said, F.lit("\n  - Fact ID: `"), F.col("fact_id"), F.lit("`\n  - Category: `"), F.col("category"), F.lit("`\n"),
            F.when(mine == "assistant_derived", F.concat(F.lit("  - Derived from: `"), F.col("derived_from"), F.lit("`\n"))).otherwise(""),
            F.lit("  - Confidence: `"), sure, F.lit("`"), F.when(mine == "low_confidence", F.lit(f" (< `{low:.3f}`)")).otherwise(""), F.lit("\n"), tail,
        )
    )
    place = lambda c: F.array_position(F.array(*map(F.lit, SECTIONS)), c).cast("int")
    facts = rows.select(place(mine).alias("place"), "section", "fact_id", F.concat(block, _evidence()).alias("line"))
    heads = store.sparkSession.createDataFrame(list(REVIEW_HEADS.items()), "section string, head string")
    n = queue.groupBy("section").agg(F.count("*").alias("n"))
    none = F.when(F.col("n").isNull(), F.lit("- (none)\n")).otherwise("")
    heads = heads.join(n, "section", "left").select(place(F.col("section")).alias("place"), "section", F.lit(None).cast("string").alias("fact_id"), F.concat(F.lit("## "), F.col("head"), F.lit("\n"), none).alias("line"))
    return heads.unionByName(facts).orderBy("place", F.col("fact_id").asc_nulls_first())


TITLES = {"identity": "Identity", "preferences": "Preferences", "projects": "Projects", "goals": "Goals (Transient)", "constraints": "Constraints / Do-Not", "misc": "Misc"}


def render_lines(blocks: DataFrame) -> DataFrame:
    """(report, no, line): the reports as lines in order, so that a report of any size is written by all workers.

    no = the place among the report's facts: range-sorted, not gathered. Headings stand at the first fact of theirs.
    """
    o = [F.when(F.col("stability") == "stable", 0).otherwise(1), F.col("category"), *_order()[2:]]
    shown = blocks.where(F.col("stability").isin("stable", "transient"))
    heads = shown.groupBy("report", "stability", "category").agg(F.min(F.struct(F.when(F.col("status") == "accepted", 0).otherwise(1).alias("a"), (-F.coalesce("confidence_max", F.lit(0.0))).alias("b"), (-F.coalesce("last_seen_ts", F.lit(0.0))).alias("c"), F.col("fact_id").alias("f"))).alias("m"))
    # the first category of each report and stability opens the section; a row per report and stability
    opening = heads.groupBy("report", "stability").agg(F.min("category").alias("category"), F.lit(True).alias("__opens"))
    heads = heads.join(F.broadcast(opening), ["report", "stability", "category"], "left").select("report", "stability", "category", F.col("m.f").alias("fact_id"), F.lit(True).alias("__head"), "__opens")
    text = F.concat(
        F.when(F.col("__opens"), F.concat(F.lit("## "), F.initcap("stability"), F.lit("\n\n"))).otherwise(""), F.when(F.col("__head"), F.concat(F.lit("### `"), F.col("category"), F.lit("`\n"))).otherwise(""), F.col("block"),
    )
    out = shown.join(heads, ["report", "stability", "category", "fact_id"], "left").withColumn("line", text)
    return out.orderBy("report", *o).select("report", "stability", "category", "fact_id", "line")


def report_counts(store: DataFrame) -> DataFrame:
    return store.groupBy(X.report_key(F.col("category")).alias("report")).agg(F.count("*").alias("facts"))


def counts_by(store: DataFrame, column: str) -> DataFrame:
    return store.groupBy(column).agg(F.count("*").alias("facts"))


# -- progress -----------------------------------------------------------------------------------------------------


def progress(claims: DataFrame, chunks: DataFrame) -> DataFrame:
    """(chunk_id, chunk_sha256, claims_objects, note): what has been done, by chunk."""
    done = claims.where("chunk_id is not null").groupBy("chunk_id").agg(F.count("*").alias("claims_objects"))
    known = chunks.groupBy("chunk_id").agg(F.max("sha256").alias("chunk_sha256"))
    return done.join(known, "chunk_id", "left").select("chunk_id", F.coalesce("chunk_sha256", F.lit("")).alias("chunk_sha256"), "claims_objects", F.when(F.col("claims_objects") > 0, "ok").otherwise("empty").alias("note"))


def missing(chunks: DataFrame, done: DataFrame) -> DataFrame:
    return chunks.select("chunk_id").distinct().join(done, "chunk_id", "left_anti")


def next_chunk(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """One row: the first missing chunk, or null."""
    return missing(chunks, done).agg(F.min("chunk_id").alias("next_chunk"))


def stale(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Done chunks whose content has changed since; blank hashes don't tell."""
    now = chunks.groupBy("chunk_id").agg(F.max("sha256").alias("sha256"))
    return done.join(now, "chunk_id").where((F.col("chunk_sha256") != "") & (F.col("chunk_sha256") != F.col("sha256"))).select("chunk_id")


def run_status(chunks: DataFrame, done: DataFrame, found: DataFrame) -> DataFrame:
    """(item, n, ok): the checklist of a run."""
    rows = [
        chunks.agg(F.count_distinct("chunk_id").alias("n")).select(F.lit("chunks").alias("item"), "n", (F.col("n") > 0).alias("ok")),
        missing(chunks, done).agg(F.count("*").alias("n")).select(F.lit("missing").alias("item"), "n", (F.col("n") == 0).alias("ok")),
        stale(chunks, done).agg(F.count("*").alias("n")).select(F.lit("stale").alias("item"), "n", (F.col("n") == 0).alias("ok")),
        found.agg(F.count_if(F.col("level") == "error").alias("n")).select(F.lit("errors").alias("item"), "n", (F.col("n") == 0).alias("ok")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
