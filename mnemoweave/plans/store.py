"""Queries on chunks, claims, the store built from them, decisions, reports and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemoweave.functions import patterns as P
from mnemoweave.functions import text as X
from mnemoweave.operators import chunking as C
from mnemoweave.operators import claims as K
from mnemoweave.operators import report as R
from mnemoweave.operators import store as S
from mnemoweave.operators.messages import with_defaults
from mnemoweave.plans.dialect import STORE, duck, email_like, is_text, normalized, phone_like, single_line, strip
from mnemoweave.session import spread, table

#: Budget of the queries' own packing: the largest message must fit.
BUDGET = 12_000


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "claims")


# -- chunks -------------------------------------------------------------------------------------------------------


def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chunk_assignment(_t(spark, sf_dir, "messages"), BUDGET)


def chunk_oversize_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations' runs that don't fit one chunk, and how many chunks they touch."""
    from mnemoweave.operators.messages import conversation_runs

    # two hundred messages in a row as one conversation, so that there are long ones
    m = _t(spark, sf_dir, "messages").withColumn("conv_id", F.concat(F.lit("c"), F.floor(F.col("seq") / 200).cast("string")))
    a = C.chunk_assignment(m, BUDGET)
    runs = conversation_runs(m).select(F.col("run_no").cast("string").alias("chunk_id"), "first_seq", "last_seq")
    per = C.in_chunks(a, runs).groupBy("chunk_id").agg(F.sum("tokens").alias("tokens"), F.count_distinct("chunk_no").alias("chunks"))
    return per.where(F.col("tokens") > BUDGET).select(F.col("chunk_id").cast("long").alias("run_no"), "tokens", "chunks")


def chunk_budget_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.violations(_t(spark, sf_dir, "messages"), 1000)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = with_defaults(_t(spark, sf_dir, "messages"))
    rows = m.select("seq", "conv_id", "message_id", "ts", "text", F.concat_ws("\t", "conv_id", "role", "message_id", "text").alias("line"), X.token_count(F.col("text")).alias("tokens"))
    return C.in_chunks(rows, _t(spark, sf_dir, "chunk_meta"))


def chunk_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chunk_meta(_lines(spark, sf_dir)).withColumn("conv_ids", F.array_join("conv_ids", ","))


def chunk_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chunk_meta(_lines(spark, sf_dir)).select("chunk_id", "sha256")


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chunk_stats(C.chunk_meta(_lines(spark, sf_dir)))


def chunk_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_chunks(_t(spark, sf_dir, "chunk_meta").select("chunk_id").distinct(), ("chunk_0003.jsonl", "chunk_0001", "chunk_0007"), 2)


TEMPLATE = "# Heading\nSave to claims/claims_0001.jsonl\nRules:\n- Be exact.\n{{TRANSCRIPT}}"


def render_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).groupBy("chunk_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "message_id"))), lambda x: F.concat(x["message_id"], F.lit("\n"))), "").alias("content"))
    content = lines.select("chunk_id", F.sha2("content", 256).alias("sha256"), "content")
    return C.render_prompts(content, C.hardened(TEMPLATE)).select("chunk_id", F.sha2("prompt", 256).alias("prompt"))


def chunk_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _claims(spark, sf_dir)
    path = F.concat(F.lit("runs/x/claims/"), F.when(F.col("seq") % 5 == 0, "other_").otherwise("claims_"), F.coalesce("chunk_id", F.lit("none")), F.lit(".jsonl"))
    return c.select("seq", K.chunk_id_of(path).alias("chunk"))


# -- claims -------------------------------------------------------------------------------------------------------


def claim_line_format_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines made of the claims, several kinds of them broken."""
    j = F.to_json(F.struct("category", "stability", "seq"))
    kind = F.col("seq") % 9
    line = F.when(kind == 1, "").when(kind == 2, F.concat(F.lit("```"), j)).when(kind == 3, F.concat(F.lit("["), j, F.lit("]"))).when(kind == 4, F.expr("left(to_json(struct(category, stability, seq)), 12)")).when(kind == 5, F.concat(F.lit("﻿"), j)).when(kind == 6, F.concat(F.lit("  "), j)).otherwise(j)
    return K.line_format(_claims(spark, sf_dir).select("seq", line.alias("value"))).select("seq", "format")


def jsonl_scan_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = claim_line_format_gate(spark, sf_dir)
    return f.groupBy("format").agg(F.count("*").alias("lines"))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims, some of them broken in fields that are whole in the table."""
    c, seq = _claims(spark, sf_dir), F.col("seq")
    return (
        c.withColumn("category", F.when(seq % 97 == 5, F.lit(None)).when(seq % 97 == 6, " ").otherwise(F.col("category")))
        .withColumn("fact", F.when(seq % 89 == 7, "\t").when(seq % 89 == 8, F.lit(None)).otherwise(F.col("fact")))
        .withColumn("tags", F.when(seq % 83 == 3, F.array(F.lit("a"), F.lit(None))).otherwise(F.col("tags")))
        .withColumn("value", F.when(seq % 79 == 4, " ").otherwise(F.col("value")))
        .withColumn("notes", F.when(seq % 73 == 9, "password: abcdefghij0123456789klmn").otherwise(F.col("notes")))
    )


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.issues(spread(_broken(spark, sf_dir)))


def validate_optional_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional fields of the wrong type, which only the lines show."""
    kind = F.col("seq") % 7
    field = F.when(kind == 1, '"notes":3').when(kind == 2, '"notes":"x","tags":["a",2]').when(kind == 3, '"tags":"a","value":" "').when(kind == 4, '"notes":null,"tags":[]').when(kind == 5, '"value":{"a":1}')
    line = F.concat(F.lit('{"fact":'), F.to_json(F.struct("fact")), F.lit(","), F.coalesce(field, F.lit('"value":"v"')), F.lit("}"))
    return K.optional_issues(_claims(spark, sf_dir).select("seq", line.alias("value"))).select("seq", "code")


def _issues_of(*codes: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _issues(spark, sf_dir).where(F.col("code").isin(*codes)).groupBy("seq", "code").agg(F.count("*").alias("n"))

    return query


def validate_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(spark, sf_dir).where("code like 'safety.%' or code like 'privacy.%'").groupBy("level", "code").agg(F.count("*").alias("n"))


def validate_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.issues(_broken(spark, sf_dir), strict=True).groupBy("level").agg(F.count("*").alias("n"))


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spread(_broken(spark, sf_dir))
    return K.summary(c, K.issues(c))


def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_summary(spark, sf_dir).agg(*[F.sum(c).alias(c) for c in ("parsed", "valid", "errors", "warnings")])


def validation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims without a safety or privacy hit that the gate stops all the same."""
    return K.gate(_issues(spark, sf_dir).where("code not like 'safety.%'"))


def merge_secret_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _claims(spark, sf_dir).withColumn("notes", F.when(F.col("seq") % 50 == 3, "token: abcdefghij0123456789klmn").otherwise(F.col("notes")))
    return K.secret_violations(c).select("seq")


def merge_required_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims that a merge refuses for a missing field or a secret."""
    return K.unmergeable(_broken(spark, sf_dir)).select("seq", F.split_part("reason", F.lit(":"), F.lit(1)).alias("why"))


def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(spark, sf_dir).select("seq", K.canonical_json(F.concat(F.lit('{"b": '), F.col("seq").cast("string"), F.lit(', "a": [1.0, 2e3, "ü"]}'))).alias("j"))


def fact_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(spark, sf_dir).where("category is not null and fact is not null").select("seq", K.fact_id(F.col("category"), F.col("fact"), F.col("value")).alias("id"))


def claims_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.identified(_claims(spark, sf_dir)).select("seq")


def merge_status_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(spark, sf_dir).select("seq", S.wanted_status(F.col("status"), F.col("derived_from")).alias("status"))


# -- store --------------------------------------------------------------------------------------------------------


def facts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.facts(_claims(spark, sf_dir)).select("fact_id", "category", "fact_text", "stability", "first_seen_ts", "last_seen_ts", "confidence_max", "claims")


def facts_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.facts(_claims(spark, sf_dir)).select("fact_id", "status")


def latest_only_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the given facts."""
    return S.latest_only(_t(spark, sf_dir, "facts")).where(F.col("category").isin(*S.LATEST_ONLY)).select("fact_id", "status")


def latest_only_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fold_latest_only(_claims(spark, sf_dir))


def evidence_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.evidence_rows(_claims(spark, sf_dir)).groupBy("fact_id").agg(F.count("*").alias("n"))


def fact_claim_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.links(_claims(spark, sf_dir)).groupBy("fact_id").agg(F.count("*").alias("n"))


def stability_change_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stability_flags(_claims(spark, sf_dir))


def exclusive_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.conflicts(_t(spark, sf_dir, "facts"))


def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.merge_stats(_claims(spark, sf_dir))


# -- decisions ----------------------------------------------------------------------------------------------------


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of decisions made of the ids' first letters."""
    f = _t(spark, sf_dir, "facts").select("fact_id", F.substring("fact_id", 1, 1).alias("h"), F.substring("fact_id", 2, 1).alias("g"))
    one = f.select(F.lit(1).alias("seq"), "fact_id", F.when(F.col("h") < "4", " Reject").when(F.col("h") < "6", "accepted").when(F.col("h") < "8", "REVIEW").when(F.col("h") == "8", " ").when(F.col("h") == "9", "what").alias("action"))
    two = f.where("g < '5'").select(F.lit(2).alias("seq"), "fact_id", F.lit("accept").alias("action"))
    return one.unionByName(two)


_ACTIONS = "f AS (SELECT fact_id, fact_id[1] h, fact_id[2] g, status was FROM facts), a AS (SELECT 1 seq, fact_id, was, CASE WHEN h < '4' THEN 'rejected' WHEN h < '6' THEN 'accepted' WHEN h < '8' THEN 'needs_review' END st FROM f UNION ALL SELECT 2, fact_id, was, 'accepted' FROM f WHERE g < '5')"


def action_to_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir).select("seq", "fact_id", S.action_status(F.col("action")).alias("status"))


def review_actions_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _actions(spark, sf_dir).withColumn("status", S.action_status(F.col("action")))
    kind = F.when(~X.is_text(F.col("action")), "skipped").when(F.col("status").isNull(), "unknown").otherwise("taken")
    return a.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def apply_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.decide(_t(spark, sf_dir, "facts"), _actions(spark, sf_dir))[0].select("fact_id", "status")


def decision_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.decide(_t(spark, sf_dir, "facts"), _actions(spark, sf_dir))[1].select("seq", "fact_id", "previous_status", "new_status")


def decision_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.cutoffs(decision_audit(spark, sf_dir).withColumn("decided_at", F.col("seq")))


def reopen_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, audit = S.decide(_t(spark, sf_dir, "facts"), _actions(spark, sf_dir))
    new = _t(spark, sf_dir, "facts").where("substring(fact_id, 3, 1) < '8'").select("fact_id", F.lit(3).alias("imported_at"))
    return S.reopened(store, S.cutoffs(audit.withColumn("decided_at", F.col("seq"))), new).select("fact_id", "status")


def action_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions that name the category a snapshot has, where the store has another."""
    s = _t(spark, sf_dir, "fact_snapshots").select("fact_id", F.col("snapshot_no").alias("seq"), "category").distinct()
    return S.mismatches(s, _t(spark, sf_dir, "facts").select("fact_id", "category")).groupBy("fact_id").agg(F.count("*").alias("n"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all decisions, each as if it stood twice in its file's line."""
    audit = S.decide(_t(spark, sf_dir, "facts"), _actions(spark, sf_dir))[1]
    rows = audit.withColumn("action", F.col("new_status")).withColumn("reason", F.when(F.col("seq") == 1, "é")).withColumn("decided_by", F.lit(None).cast("string"))
    rows = rows.withColumn("source_path", F.lit("a.jsonl")).withColumn("source_line", F.col("seq").cast("long"))
    return rows.unionByName(rows.withColumn("seq", F.col("seq") + 2))


def decision_review_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.new_reviews(_audit(spark, sf_dir)).select("review_id", "fact_id", "seq")


def decisions_by_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of a file, then those by hand: the least fact accepted and rejected, the greatest up for review."""
    f = _t(spark, sf_dir, "facts")
    low, high = f.agg(F.min("fact_id"), F.max("fact_id")).first()
    actions = S.given_decisions(_actions(spark, sf_dir), (low,), (low,), (high,))
    return S.decide(f, actions)[0].select("fact_id", "status")


def flag_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.conflicts(_t(spark, sf_dir, "facts")).select("fact_id", S.flag_id(F.col("fact_id"), "exclusive_conflict", "0.7").alias("flag_id"))


def merge_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store of the first half of the files, decided on by people, then merged with the second half."""
    c = _claims(spark, sf_dir)
    half = c.agg(F.expr("percentile_disc(0.5) within group (order by file_no)")).first()[0] or 0
    first = c.where(F.coalesce("file_no", F.lit(0)) <= half)
    prior = S.facts(first)
    digit = F.substring("fact_id", 1, 1)
    prior = prior.withColumn("status", F.when(digit < "3", "rejected").when(digit < "5", "superseded").when(digit < "7", "accepted").otherwise(F.col("status")))
    cut = prior.where(F.substring("fact_id", 2, 1) < "8").select("fact_id", F.lit(1.0).alias("decided_at"))
    known = S.deduped(first).select("claim_id")
    out = S.merged(prior, c.where(F.coalesce("file_no", F.lit(0)) > half), known, cut, 2.0)
    return out.select("fact_id", "category", "fact_text", "stability", "first_seen_ts", "last_seen_ts", "confidence_max", "status", "claims")


# -- reports ------------------------------------------------------------------------------------------------------


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _t(spark, sf_dir, "facts")
    return S.conflicts(f, least=0.5).select("fact_id", F.lit("exclusive_conflict").alias("flag_type")).unionByName(f.where("stability = 'transient' and confidence_max > 0.9").select("fact_id", F.lit("stability_change").alias("flag_type")))


_FLAGS = """live AS (SELECT *, count(*) OVER (PARTITION BY category) n FROM facts WHERE category IN ('identity.name', 'identity.handle', 'identity.role', 'identity.company') AND status IN ('accepted', 'needs_review') AND stability = 'stable' AND confidence_max >= {0}),
flags AS (SELECT fact_id, 'exclusive_conflict' flag_type FROM live WHERE n > 1 UNION ALL SELECT fact_id, 'stability_change' FROM facts WHERE stability = 'transient' AND confidence_max > 0.9)"""


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.identified(_claims(spark, sf_dir))
    return R.derived_rollup(S.links(_claims(spark, sf_dir)), c)


def flags_by_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.flags_by_fact(_flags(spark, sf_dir)).select("fact_id", F.array_join("flags", ",").alias("flags"))


def derived_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir)


def report_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.report_filter(_t(spark, sf_dir, "facts"), needs_review=True).select("fact_id")


def report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each accepted fact among those of its category (range sorting orders the report itself)."""
    from pyspark.sql import Window

    s = R.report_filter(_t(spark, sf_dir, "facts"))
    return s.select("fact_id", F.row_number().over(Window.partitionBy("category").orderBy(*R._order())).alias("place"))


def facts_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    o = [F.col("status").asc_nulls_first(), F.col("confidence_max").desc_nulls_last(), F.col("last_seen_ts").desc_nulls_last(), F.col("fact_id")]
    return _t(spark, sf_dir, "facts").select("fact_id", F.row_number().over(Window.partitionBy("category", "stability").orderBy(*o)).alias("place"))


def top_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_evidence(_t(spark, sf_dir, "evidence")).select("fact_id", "evidence_id", "rank")


def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.report_counts(R.report_filter(_t(spark, sf_dir, "facts")))


def facts_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.counts_by(_t(spark, sf_dir, "facts"), "status")


def facts_by_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.counts_by(_t(spark, sf_dir, "facts"), "stability")


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.review_queue(_t(spark, sf_dir, "facts"), _flags(spark, sf_dir), _derived(spark, sf_dir))


def review_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.review_counts(_t(spark, sf_dir, "facts"), _flags(spark, sf_dir), _derived(spark, sf_dir))


def review_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.worklist(_t(spark, sf_dir, "facts"), _flags(spark, sf_dir)).select("fact_id", "category", "stability", "status", F.array_join("flags", ",").alias("flags"))


def review_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review document's blocks without their evidence lines, which top_evidence and render_docs have."""
    flags = _flags(spark, sf_dir).withColumn("detail", F.lit("two\n words"))
    lines = R.review_lines(_t(spark, sf_dir, "facts"), flags, _derived(spark, sf_dir), _t(spark, sf_dir, "evidence"))
    return lines.select("place", "section", "fact_id", F.split_part("line", F.lit("  - Evidence"), F.lit(1)).alias("line"))


def render_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = R.fact_blocks(R.report_filter(_t(spark, sf_dir, "facts")), _t(spark, sf_dir, "evidence"))
    return R.render_lines(blocks).select("report", "fact_id", F.sha2("line", 256).alias("line"))


def render_secret_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a key in the text of some facts
    f = _t(spark, sf_dir, "facts").withColumn("fact_text", F.when(F.substring("fact_id", 1, 1) == "a", F.concat("fact_text", F.lit(" sk-abcdefghijklmn"))).otherwise(F.col("fact_text")))
    blocks = R.fact_blocks(R.report_filter(f), _t(spark, sf_dir, "evidence"))
    return blocks.select("report", F.explode(X.secret_hits(F.col("block"), False)).alias("hit")).groupBy("report", "hit").agg(F.count("*").alias("n"))


# -- progress -----------------------------------------------------------------------------------------------------


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress by the claims; chunks whose number ends in 3 have none yet, every fifth one's hash is an old one."""
    d = R.progress(_claims(spark, sf_dir).where("chunk_id not like '%3'"), _t(spark, sf_dir, "chunk_meta"))
    return d.withColumn("chunk_sha256", F.when(F.substring("chunk_id", -1, 1).isin("0", "5"), "old").otherwise(F.col("chunk_sha256")))


_DONE = "d AS (SELECT c.chunk_id, CASE WHEN right(c.chunk_id, 1) IN ('0', '5') THEN 'old' ELSE coalesce(m.sha256, '') END sha, c.n FROM (SELECT chunk_id, count(*) n FROM claims WHERE chunk_id NOT LIKE '%3' GROUP BY 1) c LEFT JOIN (SELECT chunk_id, max(sha256) sha256 FROM chunk_meta GROUP BY 1) m USING (chunk_id))"


def chunk_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _done(spark, sf_dir)


def progress_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.missing(_t(spark, sf_dir, "chunk_meta"), _done(spark, sf_dir))


def progress_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.next_chunk(_t(spark, sf_dir, "chunk_meta"), _done(spark, sf_dir))


def progress_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.stale(_t(spark, sf_dir, "chunk_meta"), _done(spark, sf_dir))


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.run_status(_t(spark, sf_dir, "chunk_meta"), _done(spark, sf_dir), _issues(spark, sf_dir))


_NAMES = (
    "chunk_assignment chunk_oversize_split chunk_budget_violations chunk_meta chunk_sha256 chunk_stats chunk_select render_prompts chunk_id_parse claim_line_format_gate jsonl_scan_permissive validate_safety validate_strict validation_summary validation_totals "
    "validation_gate validate_optional_lines merge_secret_refusal merge_required_recheck merge_incremental decision_review_ids decisions_by_hand flag_ids canonical_json fact_id claims_dedupe merge_status_coercion facts_upsert facts_status latest_only_winner latest_only_fold evidence_dedupe fact_claim_links stability_change_flags exclusive_conflicts merge_stats action_to_status "
    "review_actions_parse apply_decisions decision_audit decision_cutoffs reopen_rejected action_mismatch flags_by_fact derived_from_rollup report_filter report_order facts_sorted top_evidence report_counts facts_by_status facts_by_stability review_queue review_counts "
    "review_worklist review_document render_docs render_secret_gate chunk_progress progress_missing progress_next progress_stale run_status"
).split()
_FAMILIES = {
    "validate_required": ("schema.category", "schema.fact"), "validate_enums": ("schema.stability", "schema.status", "schema.derived_from"), "validate_confidence": ("schema.confidence",), "validate_time": ("schema.time", "schema.time.as_of_ts"),
    "validate_evidence": ("schema.evidence", "schema.evidence.item"), "validate_evidence_items": ("evidence.role", "evidence.quote", "evidence.conv_id", "evidence.message_id", "evidence.ts"), "validate_optional": ("schema.tags", "schema.value"),
    "validate_grounding": ("grounding.user_evidence", "grounding.assistant_status"), "validate_interest": ("schema.value.required", "interest.threshold"),
}
QUERIES = {n: globals()[n] for n in _NAMES} | {n: _issues_of(*codes) for n, codes in _FAMILIES.items()}

_DEF = "coalesce(nullif({0}, ''), 'unknown')"
_USERS = "list_filter(evidence, lambda e: e.role = 'user')"
_RULES = {
    "schema.category": f"NOT {is_text('category')}", "schema.fact": f"NOT {is_text('fact')}", "schema.stability": "NOT coalesce(stability IN ('stable', 'transient'), false)", "schema.status": "NOT coalesce(status IN ('accepted', 'needs_review'), false)",
    "schema.derived_from": "NOT coalesce(derived_from IN ('user', 'assistant', 'mixed'), false)", "schema.confidence": "NOT coalesce(confidence BETWEEN 0 AND 1 AND NOT isnan(confidence), false)", "schema.time": "time IS NULL", "schema.time.as_of_ts": "time IS NOT NULL AND time.as_of_ts IS NULL",
    "schema.evidence": "coalesce(len(evidence), 0) = 0", "schema.evidence.item": "len(list_filter(evidence, lambda e: e IS NULL)) > 0", "schema.tags": "coalesce(len(list_filter(tags, lambda t: t IS NULL)) > 0, false)", "schema.value": f"value IS NOT NULL AND NOT {is_text('value')}",
    "grounding.user_evidence": f"coalesce(derived_from IN ('user', 'mixed'), false) AND coalesce(len({_USERS}), 0) = 0", "grounding.assistant_status": "coalesce(derived_from = 'assistant' AND status = 'accepted', false)",
    "schema.value.required": f"coalesce(category = 'preferences.interests', false) AND NOT {is_text('value')}",
    "interest.threshold": f"coalesce(category = 'preferences.interests' AND status = 'accepted', false) AND coalesce(len(list_distinct(list_transform({_USERS}, lambda e: (e.conv_id, e.message_id)))), 0) < 3",
}
_ITEMS = {
    "evidence.role": "NOT coalesce(e.role IN ('user', 'assistant'), false)", "evidence.quote": f"NOT {is_text('e.quote')}", "evidence.conv_id": f"NOT {is_text('e.conv_id')}", "evidence.message_id": f"NOT {is_text('e.message_id')}", "evidence.ts": "e.ts IS NULL",
}


def _family_sql(codes: tuple[str, ...]) -> str:
    parts = [f"SELECT seq, '{c}' AS code, 1 AS n FROM bc WHERE {_RULES[c]}" for c in codes if c in _RULES]
    parts += [f"SELECT seq, '{c}' AS code, count(*) AS n FROM (SELECT seq, unnest(evidence) e FROM bc) WHERE e IS NOT NULL AND {_ITEMS[c]} GROUP BY seq" for c in codes if c in _ITEMS]
    return f"WITH {_BROKEN} " + " UNION ALL ".join(parts)


_BEARER = r"(?i)\bAuthorization\s*:\s*Bearer\s+[A-Za-z0-9\-._~+/]+=*"
_KV = f"len(list_filter(regexp_extract_all(t, '{duck(P.KEY_VALUE)}', 3), lambda v: NOT contains(v, '[REDACTED]') AND regexp_full_match(v, '[A-Za-z0-9+/_=-]{{20,}}')))"
_BROKEN = """bc AS (SELECT * REPLACE (
  CASE WHEN seq % 97 = 5 THEN NULL WHEN seq % 97 = 6 THEN ' ' ELSE category END AS category, CASE WHEN seq % 89 = 7 THEN chr(9) WHEN seq % 89 = 8 THEN NULL ELSE fact END AS fact,
  CASE WHEN seq % 83 = 3 THEN ['a', NULL] ELSE tags END AS tags, CASE WHEN seq % 79 = 4 THEN ' ' ELSE value END AS value,
  CASE WHEN seq % 73 = 9 THEN 'password: abcdefghij0123456789klmn' ELSE notes END AS notes) FROM claims)"""


def _hits_sql(texts: str) -> str:
    """(seq, file_no, level, code, n) of secrets and personal data in texts (seq, file_no, t)."""
    secrets = [(n, f"regexp_matches(t, '{duck(p)}')") for n, p in P.SECRETS] + [("authorization_bearer", f"regexp_matches(t, '{_BEARER}')")]
    parts = [f"SELECT seq, file_no, 'error' AS level, 'safety.{n}' AS code, 1 AS n FROM {texts} WHERE {w}" for n, w in secrets]
    parts.append(f"SELECT seq, file_no, 'error', 'safety.secret_kv_high_entropy', {_KV} FROM {texts} WHERE {_KV} > 0")
    parts += [f"SELECT seq, file_no, 'warning', 'privacy.{n}', 1 FROM {texts} WHERE {w}" for n, w in (("email", email_like("t")), ("phone_like", phone_like("t")))]
    return " UNION ALL ".join(parts)


def _texts_sql(claims: str) -> str:
    return f"SELECT seq, file_no, fact t FROM {claims} UNION ALL SELECT seq, file_no, notes FROM {claims} UNION ALL SELECT seq, file_no, e.quote FROM (SELECT seq, file_no, unnest(evidence) e FROM {claims}) WHERE e IS NOT NULL"


def _issues_sql() -> str:
    """CTEs: bc (claims), i (seq, file_no, level, code, n)."""
    parts = [f"SELECT seq, file_no, 'error' AS level, '{c}' AS code, 1 AS n FROM bc WHERE {w}" for c, w in _RULES.items()]
    parts += [f"SELECT seq, file_no, 'error', '{c}', 1 FROM (SELECT seq, file_no, unnest(evidence) e FROM bc) WHERE e IS NOT NULL AND {w}" for c, w in _ITEMS.items()]
    return f"WITH {_BROKEN}, t AS ({_texts_sql('bc')}), i AS ({' UNION ALL '.join(parts)} UNION ALL {_hits_sql('t')})"


_CLAIM_KEY = "CAST(row(category, fact, stability, status, confidence, time, evidence, derived_from, value, tags, notes) AS VARCHAR)"
_INCH = "FROM messages m JOIN (SELECT DISTINCT chunk_id, first_seq, last_seq FROM chunk_meta) c ON m.seq BETWEEN c.first_seq AND c.last_seq"
_META = f"""WITH m AS (
  SELECT chunk_id, seq, {_DEF.format('conv_id')} conv_id, {_DEF.format('message_id')} message_id, ts, CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT) tokens,
    concat_ws(chr(9), {_DEF.format('conv_id')}, {_DEF.format('role')}, {_DEF.format('message_id')}, coalesce(text, '')) line {_INCH}),
l AS (SELECT *, lag(conv_id) OVER (PARTITION BY chunk_id ORDER BY seq) p FROM m),
meta AS (
  SELECT chunk_id, sha256(string_agg(line || chr(10), '' ORDER BY seq)) sha256, sum(tokens) token_estimate, count(*) message_count, string_agg(conv_id, ',' ORDER BY seq) FILTER (p IS NULL OR p <> conv_id) conv_ids,
    arg_min(ts, seq) FILTER (ts IS NOT NULL) first_ts, arg_max(ts, seq) FILTER (ts IS NOT NULL) last_ts, arg_min(message_id, seq) first_message_id, arg_max(message_id, seq) last_message_id
  FROM l GROUP BY chunk_id)
"""
_LINK = "links AS (SELECT fact_id, count(*) n, max(CASE derived_from WHEN 'assistant' THEN 3 WHEN 'mixed' THEN 2 WHEN 'user' THEN 1 ELSE 0 END) r FROM k WHERE len(evidence) > 0 GROUP BY 1), derived AS (SELECT fact_id, ['unknown', 'user', 'mixed', 'assistant'][r + 1] derived_from FROM links)"
_EV = f"""ev AS (SELECT DISTINCT fact_id, e.conv_id, e.message_id, e.role, e.quote FROM (SELECT fact_id, unnest(evidence) e FROM k) WHERE {is_text('e.quote')} AND {is_text('e.conv_id')} AND {is_text('e.message_id')} AND e.role IN ('user', 'assistant'))"""
_QUEUE = f"WITH {STORE}, {_LINK}, {_FLAGS.format(0.5)}, q AS (SELECT f.*, derived.derived_from, f.fact_id IN (SELECT fact_id FROM flags) flagged FROM facts f LEFT JOIN derived USING (fact_id) WHERE f.status = 'needs_review') "

SQL = {
    **{n: _family_sql(codes) for n, codes in _FAMILIES.items()},
    "chunk_budget_violations": f"SELECT seq, {_DEF.format('conv_id')} AS conv_id, {_DEF.format('message_id')} AS message_id, CAST(ceil(strlen(text) / 4.0) AS BIGINT) AS tokens FROM messages WHERE ceil(strlen(text) / 4.0) > 1000",
    "chunk_meta": _META + "SELECT * FROM meta", "chunk_sha256": _META + "SELECT chunk_id, sha256 FROM meta",
    "chunk_stats": _META + "SELECT count(*) AS chunks, sum(message_count) AS messages, sum(token_estimate) AS tokens, max(token_estimate) AS largest FROM meta",
    "chunk_select": "SELECT chunk_id FROM (VALUES ('chunk_0001'), ('chunk_0003')) v(chunk_id)",
    "chunk_id_parse": "SELECT seq, CASE WHEN seq % 5 > 0 AND regexp_full_match(chunk_id, 'chunk_[0-9]{4,}') THEN chunk_id END AS chunk FROM claims",
    "render_prompts": f"""WITH c AS (SELECT chunk_id, string_agg({_DEF.format('message_id')} || chr(10), '' ORDER BY seq) content {_INCH} GROUP BY chunk_id)
SELECT chunk_id, sha256('# Claims Map Prompt (' || chunk_id || ')' || chr(10) || chr(10) || 'Operator metadata (for you, not the model):' || chr(10) || '- chunk_id: `' || chunk_id || '`' || chr(10) || '- chunk_sha256: `' || sha256(content) || '`' || chr(10)
  || '- save_output_to: `claims/claims_' || chunk_id || '.jsonl`' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'Save to claims/claims_' || chunk_id || '.jsonl' || chr(10) || 'Rules:' || chr(10) || '{C.GUARD}' || chr(10) || '- Be exact.' || chr(10) || content) AS prompt FROM c""",
    "claim_line_format_gate": "SELECT seq, CASE seq % 9 WHEN 1 THEN 'blank' WHEN 2 THEN 'code_fence' WHEN 3 THEN 'non_json_object_line' WHEN 4 THEN 'json_parse' ELSE 'ok' END AS format FROM claims",
    "jsonl_scan_permissive": "SELECT CASE seq % 9 WHEN 1 THEN 'blank' WHEN 2 THEN 'code_fence' WHEN 3 THEN 'non_json_object_line' WHEN 4 THEN 'json_parse' ELSE 'ok' END AS format, count(*) AS lines FROM claims GROUP BY 1",
    "canonical_json": """SELECT seq, '{"a":[1.0,2000.0,"ü"],"b":' || seq || '}' AS j FROM claims""",
    "fact_id": f"SELECT seq, sha256(category || chr(10) || {normalized(f'CASE WHEN {is_text(chr(118) + chr(97) + chr(108) + chr(117) + chr(101))} THEN value ELSE fact END')}) AS id FROM claims WHERE category IS NOT NULL AND fact IS NOT NULL",
    "claims_dedupe": f"WITH {STORE} SELECT seq FROM k",
    "merge_status_coercion": f"SELECT seq, CASE WHEN derived_from = 'assistant' THEN 'needs_review' WHEN coalesce({strip('status')}, 'accepted') = 'needs_review' THEN 'needs_review' ELSE 'accepted' END AS status FROM claims",
    "facts_upsert": f"WITH {STORE} SELECT fact_id, category, fact_text, stability, first_seen_ts, last_seen_ts, confidence_max, claims FROM store",
    "facts_status": f"WITH {STORE} SELECT fact_id, status FROM store",
    "latest_only_winner": """WITH a AS (SELECT fact_id, category, status, row_number() OVER (PARTITION BY category, status IN ('accepted', 'needs_review') ORDER BY CASE WHEN status = 'accepted' THEN 0 ELSE 1 END, coalesce(last_seen_ts, -1) DESC, coalesce(confidence_max, 0) DESC, fact_id) r
  FROM facts WHERE category IN ('identity.name', 'identity.handle', 'identity.role', 'identity.company'))
SELECT fact_id, CASE WHEN status IN ('accepted', 'needs_review') AND r > 1 THEN 'superseded' ELSE status END AS status FROM a""",
    "evidence_dedupe": f"WITH {STORE}, {_EV} SELECT fact_id, count(*) AS n FROM ev GROUP BY 1",
    "fact_claim_links": f"WITH {STORE}, {_LINK} SELECT fact_id, n FROM links",
    "stability_change_flags": f"WITH {STORE}, s AS (SELECT fact_id, arg_min(stability, seq) was FROM k GROUP BY 1 HAVING count(DISTINCT stability) > 1) SELECT fact_id, was, arg_min(stability, seq) AS became FROM k JOIN s USING (fact_id) WHERE stability <> was GROUP BY 1, 2",
    "exclusive_conflicts": f"WITH {_FLAGS.format(0.7)}, o AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY confidence_max DESC, coalesce(last_seen_ts, -1) DESC, fact_id) r FROM live WHERE n > 1), t AS (SELECT category, string_agg(fact_id, ',' ORDER BY r) FILTER (r <= 5) first_rivals FROM o GROUP BY 1) SELECT category, fact_id, n AS rivals, first_rivals FROM o JOIN t USING (category)",
    "merge_stats": f"WITH {STORE}, {_EV} SELECT (SELECT count(*) FROM claims) AS claims, (SELECT count(*) FROM k) AS claims_new, (SELECT count(*) FROM store) AS facts, (SELECT count(*) FROM ev) AS evidence",
    "action_to_status": f"WITH {_ACTIONS} SELECT seq, fact_id, st AS status FROM a",
    "review_actions_parse": f"WITH {_ACTIONS} SELECT CASE WHEN st IS NOT NULL THEN 'taken' WHEN h = '9' THEN 'unknown' ELSE 'skipped' END AS kind, count(*) AS n FROM a JOIN f USING (fact_id) GROUP BY 1",
    "apply_decisions": f"WITH {_ACTIONS}, l AS (SELECT fact_id, arg_max(st, seq) st FROM a WHERE st IS NOT NULL GROUP BY 1) SELECT fact_id, coalesce(st, status) AS status FROM facts LEFT JOIN l USING (fact_id)",
    "decision_audit": f"WITH {_ACTIONS} SELECT seq, fact_id, coalesce(lag(st) OVER (PARTITION BY fact_id ORDER BY seq), was) AS previous_status, st AS new_status FROM a WHERE st IS NOT NULL",
    "decision_cutoffs": f"WITH {_ACTIONS} SELECT fact_id, max(seq) AS decided_at FROM a WHERE st IN ('accepted', 'rejected') GROUP BY 1",
    "reopen_rejected": f"WITH {_ACTIONS}, l AS (SELECT fact_id, arg_max(st, seq) st, max(seq) FILTER (st IN ('accepted', 'rejected')) cut FROM a WHERE st IS NOT NULL GROUP BY 1), s AS (SELECT fact_id, cut, coalesce(st, status) status FROM facts LEFT JOIN l USING (fact_id)) SELECT fact_id, CASE WHEN status = 'rejected' AND cut < 3 AND fact_id[3] < '8' THEN 'needs_review' ELSE status END AS status FROM s",
    "action_mismatch": "SELECT fact_id, count(*) AS n FROM (SELECT DISTINCT fact_id, snapshot_no, category FROM fact_snapshots) s JOIN facts f USING (fact_id) WHERE s.category <> f.category OR (s.category IS NOT NULL AND f.category IS NULL) GROUP BY 1",
    "decision_review_ids": f"""WITH {_ACTIONS}, r AS (SELECT seq, fact_id, sha256('{{"action":"' || st || '","decided_by":"","fact_id":"' || fact_id || '","new_status":"' || st || '","reason":"' || CASE WHEN seq = 1 THEN 'é' ELSE '' END || '","source_line":' || seq || ',"source_path":"a.jsonl"}}') review_id FROM a WHERE st IS NOT NULL)
SELECT review_id, fact_id, seq FROM r""",
    "decisions_by_hand": f"""WITH {_ACTIONS}, l AS (SELECT fact_id, arg_max(st, seq) st FROM a WHERE st IS NOT NULL GROUP BY 1)
SELECT fact_id, CASE WHEN fact_id = (SELECT max(fact_id) FROM facts) THEN 'needs_review' WHEN fact_id = (SELECT min(fact_id) FROM facts) THEN 'rejected' ELSE coalesce(st, status) END AS status FROM facts LEFT JOIN l USING (fact_id)""",
    "flag_ids": f"WITH {_FLAGS.format(0.7)} SELECT fact_id, sha256(fact_id || chr(10) || 'exclusive_conflict' || chr(10) || '0.7') AS flag_id FROM live WHERE n > 1",
    "validate_safety": _issues_sql() + " SELECT level, code, sum(n) AS n FROM i WHERE code LIKE 'safety.%' OR code LIKE 'privacy.%' GROUP BY 1, 2",
    "validate_strict": _issues_sql() + " SELECT 'error' AS level, sum(n) AS n FROM i",
    "validation_summary": (_SUMMARY := _issues_sql() + """, p AS (SELECT seq, sum(n) FILTER (level = 'error') e, sum(n) FILTER (level = 'warning') w FROM i GROUP BY 1),
s AS (SELECT bc.file_no, count(*) parsed, count(*) FILTER (p.seq IS NULL) valid, coalesce(sum(e), 0) errors, coalesce(sum(w), 0) warnings FROM bc LEFT JOIN p USING (seq) GROUP BY 1) """) + "SELECT * FROM s",
    "validation_totals": _SUMMARY + "SELECT sum(parsed) AS parsed, sum(valid) AS valid, sum(errors) AS errors, sum(warnings) AS warnings FROM s",
    "validation_gate": _issues_sql() + " SELECT DISTINCT seq FROM i WHERE level = 'error' AND code NOT LIKE 'safety.%'",
    "validate_optional_lines": """SELECT seq, unnest(CASE seq % 7 WHEN 1 THEN ['schema.notes'] WHEN 2 THEN ['schema.tags'] WHEN 3 THEN ['schema.tags', 'schema.value'] WHEN 5 THEN ['schema.value'] END) AS code
FROM claims WHERE fact IS NOT NULL AND seq % 7 IN (1, 2, 3, 5) UNION ALL SELECT seq, unnest(CASE seq % 7 WHEN 1 THEN ['schema.notes'] WHEN 2 THEN ['schema.tags'] WHEN 3 THEN ['schema.tags', 'schema.value'] WHEN 5 THEN ['schema.value'] END) FROM claims WHERE fact IS NULL AND seq % 7 IN (1, 2, 3, 5)""",
    "merge_secret_refusal": f"WITH c AS (SELECT * REPLACE (CASE WHEN seq % 50 = 3 THEN 'token: abcdefghij0123456789klmn' ELSE notes END AS notes) FROM claims), t AS ({_texts_sql('c')}), i AS ({_hits_sql('t')}) SELECT DISTINCT seq FROM i WHERE level = 'error'",
    "merge_required_recheck": f"WITH {_BROKEN}, t AS ({_texts_sql('bc')}), i AS ({_hits_sql('t')}) SELECT DISTINCT seq, 'secret' AS why FROM i WHERE level = 'error' UNION ALL SELECT seq, 'missing' FROM bc WHERE {_RULES['schema.category']} OR {_RULES['schema.fact']} OR {_RULES['schema.stability']} OR confidence IS NULL OR {_RULES['schema.derived_from']}",
    "merge_incremental": f"""WITH h AS (SELECT quantile_disc(file_no, 0.5) half FROM claims), {STORE.replace('FROM claims WHERE', 'FROM claims, h WHERE coalesce(file_no, 0) <= half AND')},
prior AS (SELECT * REPLACE (CASE WHEN fact_id[1] < '3' THEN 'rejected' WHEN fact_id[1] < '5' THEN 'superseded' WHEN fact_id[1] < '7' THEN 'accepted' ELSE status END AS status) FROM store),
l AS (SELECT *, {_CLAIM_KEY} key, sha256(category || chr(10) || {normalized(f"CASE WHEN {is_text('value')} THEN value ELSE fact END")}) fact_id,
  CASE WHEN derived_from = 'assistant' THEN 'needs_review' WHEN coalesce({strip('status')}, 'accepted') = 'needs_review' THEN 'needs_review' ELSE 'accepted' END wanted
  FROM claims, h WHERE coalesce(file_no, 0) > half AND {is_text('category')} AND {is_text('fact')}),
n AS (SELECT fact_id, arg_min(category, seq) category, arg_max({strip('fact')}, (time.as_of_ts, seq)) FILTER (time.as_of_ts IS NOT NULL) dated, max(time.as_of_ts) last_ts, min(time.as_of_ts) first_ts, arg_min({strip('fact')}, seq) undated,
  list(DISTINCT stability) stabs, arg_min(stability, seq) stability, max(CASE WHEN isnan(confidence) THEN NULL ELSE confidence END) conf, bool_or(wanted = 'accepted') acc, max(seq) FILTER (wanted = 'accepted') last_acc,
  min(seq) FILTER (key NOT IN (SELECT {_CLAIM_KEY} FROM claims, h WHERE coalesce(file_no, 0) <= half AND {is_text('category')} AND {is_text('fact')})) first_new, count(*) c FROM l GROUP BY 1)
SELECT fact_id, coalesce(p.category, n.category) AS category,
  CASE WHEN dated IS NOT NULL AND (p.last_seen_ts IS NULL OR n.last_ts >= p.last_seen_ts) THEN dated ELSE coalesce(p.fact_text, dated, undated) END AS fact_text,
  CASE WHEN len(list_distinct(list_concat(coalesce(stabs, []), CASE WHEN p.stability IS NULL THEN [] ELSE [p.stability] END))) > 1 THEN 'transient' ELSE coalesce(p.stability, n.stability) END AS stability,
  least(p.first_seen_ts, n.first_ts) AS first_seen_ts, greatest(p.last_seen_ts, n.last_ts) AS last_seen_ts, greatest(p.confidence_max, conf) AS confidence_max,
  CASE WHEN p.status = 'rejected' AND first_new IS NOT NULL AND fact_id[2] < '8' THEN CASE WHEN last_acc > first_new THEN 'accepted' ELSE 'needs_review' END
    WHEN p.status IN ('accepted', 'rejected') OR n.c IS NULL THEN p.status WHEN acc THEN 'accepted' ELSE 'needs_review' END AS status, coalesce(p.claims, 0) + coalesce(n.c, 0) AS claims
FROM prior p FULL JOIN n USING (fact_id)""",
    "render_secret_gate": "SELECT CASE split_part(category, '.', 1) WHEN category THEN 'misc' WHEN 'identity' THEN 'identity' WHEN 'preferences' THEN 'preferences' WHEN 'meta' THEN 'preferences' WHEN 'projects' THEN 'projects' WHEN 'goals' THEN 'goals' WHEN 'constraints' THEN 'constraints' ELSE 'misc' END AS report, 'openai_key' AS hit, count(*) AS n FROM facts WHERE status = 'accepted' AND fact_id[1] = 'a' AND fact_text IS NOT NULL GROUP BY 1",
    "run_status": _issues_sql() + f""", {_DONE}, m AS (SELECT chunk_id, max(sha256) s FROM chunk_meta GROUP BY 1), x AS (
SELECT 'chunks' AS item, count(DISTINCT chunk_id) AS n, true AS good FROM chunk_meta UNION ALL SELECT 'missing', count(*), NULL FROM m WHERE chunk_id NOT IN (SELECT chunk_id FROM d)
UNION ALL SELECT 'stale', count(*), NULL FROM d JOIN m USING (chunk_id) WHERE sha <> '' AND sha <> s UNION ALL SELECT 'errors', sum(n), NULL FROM i WHERE level = 'error')
SELECT item, CAST(n AS BIGINT) AS n, coalesce(good, n = 0) AS ok FROM x""",
    "flags_by_fact": f"WITH {_FLAGS.format(0.5)} SELECT fact_id, string_agg(DISTINCT flag_type, ',' ORDER BY flag_type) AS flags FROM flags GROUP BY 1",
    "derived_from_rollup": f"WITH {STORE}, {_LINK} SELECT fact_id, derived_from FROM derived",
    "report_filter": "SELECT fact_id FROM facts WHERE status = 'accepted' OR status NOT IN ('rejected', 'superseded')",
    "report_order": "SELECT fact_id, row_number() OVER (PARTITION BY category ORDER BY CASE WHEN stability = 'stable' THEN 0 ELSE 1 END, coalesce(confidence_max, 0) DESC, coalesce(last_seen_ts, 0) DESC, fact_id) AS place FROM facts WHERE status = 'accepted'",
    "facts_sorted": "SELECT fact_id, row_number() OVER (PARTITION BY category, stability ORDER BY status NULLS FIRST, confidence_max DESC NULLS LAST, last_seen_ts DESC NULLS LAST, fact_id) AS place FROM facts",
    "top_evidence": "SELECT fact_id, evidence_id, rank FROM (SELECT fact_id, evidence_id, row_number() OVER (PARTITION BY fact_id ORDER BY CASE WHEN role = 'user' THEN 0 ELSE 1 END, ts DESC NULLS LAST, evidence_id) rank FROM (SELECT DISTINCT ON (evidence_id) * FROM evidence)) WHERE rank <= 3",
    "report_counts": "SELECT CASE split_part(category, '.', 1) WHEN category THEN 'misc' WHEN 'identity' THEN 'identity' WHEN 'preferences' THEN 'preferences' WHEN 'meta' THEN 'preferences' WHEN 'projects' THEN 'projects' WHEN 'goals' THEN 'goals' WHEN 'constraints' THEN 'constraints' ELSE 'misc' END AS report, count(*) AS facts FROM facts WHERE status = 'accepted' GROUP BY 1",
    "facts_by_status": "SELECT status, count(*) AS facts FROM facts GROUP BY 1", "facts_by_stability": "SELECT stability, count(*) AS facts FROM facts GROUP BY 1",
    "review_queue": _QUEUE + "SELECT fact_id, CASE WHEN flagged THEN 'flagged' WHEN confidence_max < 0.6 THEN 'low_confidence' WHEN derived_from IN ('assistant', 'mixed') THEN 'assistant_derived' ELSE 'other' END AS section FROM q",
    "review_counts": _QUEUE + "SELECT count(*) FILTER (flagged) AS flagged, count(*) FILTER (confidence_max < 0.6) AS low_confidence, count(*) FILTER (derived_from IN ('assistant', 'mixed')) AS assistant_derived, count(*) AS needs_review FROM q",
    "review_worklist": f"WITH {_FLAGS.format(0.5)}, g AS (SELECT fact_id, string_agg(DISTINCT flag_type, ',' ORDER BY flag_type) flags FROM flags GROUP BY 1) SELECT fact_id, category, stability, status, coalesce(flags, '') AS flags FROM facts LEFT JOIN g USING (fact_id) WHERE status = 'needs_review'",
    "review_document": _QUEUE + f""", s AS (SELECT *, CASE WHEN flagged THEN 1 WHEN confidence_max < 0.6 THEN 2 WHEN derived_from IN ('assistant', 'mixed') THEN 3 ELSE 4 END place FROM q),
g AS (SELECT fact_id, string_agg(DISTINCT '  - Flag: `' || flag_type || '`' || chr(10) || '    - Detail: two words' || chr(10), '' ORDER BY '  - Flag: `' || flag_type || '`' || chr(10) || '    - Detail: two words' || chr(10)) lines FROM flags GROUP BY 1),
h AS (SELECT unnest([1, 2, 3, 4]) place, unnest(['Conflicts', 'Low-confidence items', 'Assistant-derived (unconfirmed)', 'Other needs-review']) head),
b AS (SELECT place, fact_id, CASE WHEN place = 1 THEN '- Category: `' || category || '`' || chr(10) || '  - Fact ID: `' || fact_id || '`' || chr(10) || '  - Fact: ' || {single_line('fact_text')} || chr(10) || '  - Status: `needs_review`' || chr(10) || lines
  ELSE '- Candidate: ' || {single_line('fact_text')} || chr(10) || '  - Fact ID: `' || fact_id || '`' || chr(10) || '  - Category: `' || category || '`' || chr(10) || CASE WHEN place = 3 THEN '  - Derived from: `' || derived_from || '`' || chr(10) ELSE '' END
    || '  - Confidence: `' || coalesce(printf('%.3f', confidence_max), 'unknown') || '`' || CASE WHEN place = 2 THEN ' (< `0.600`)' ELSE '' END || chr(10) || '  - Status: `needs_review`' || chr(10) END line FROM s LEFT JOIN g USING (fact_id))
SELECT place, ['flagged', 'low_confidence', 'assistant_derived', 'other'][place] AS section, fact_id, line FROM b
UNION ALL SELECT place, ['flagged', 'low_confidence', 'assistant_derived', 'other'][place], NULL, '## ' || head || chr(10) || CASE WHEN place NOT IN (SELECT place FROM b) THEN '- (none)' || chr(10) ELSE '' END FROM h""",
    "chunk_progress": f"WITH {_DONE} SELECT chunk_id, sha AS chunk_sha256, n AS claims_objects, 'ok' AS note FROM d",
    "progress_missing": f"WITH {_DONE} SELECT DISTINCT chunk_id FROM chunk_meta WHERE chunk_id NOT IN (SELECT chunk_id FROM d)",
    "progress_next": f"WITH {_DONE} SELECT min(chunk_id) AS next_chunk FROM chunk_meta WHERE chunk_id NOT IN (SELECT chunk_id FROM d)",
    "progress_stale": f"WITH {_DONE}, m AS (SELECT chunk_id, max(sha256) s FROM chunk_meta GROUP BY 1) SELECT chunk_id FROM d JOIN m USING (chunk_id) WHERE sha <> '' AND sha <> s",
}
