"""Queries on messages, their text and the trees they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemoweave.functions import patterns as P
from mnemoweave.functions import text as X
from mnemoweave.operators import messages as M
from mnemoweave.plans.dialect import WS, duck, normalized, phone_like, single_line
from mnemoweave.session import spread, table


def _m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "messages")


def _mt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_m(spark, sf_dir).select("seq", "text"))


# -- conversation trees made of the messages: 50 in a row each, every fifth one a side branch -------------------------


def _trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _m(spark, sf_dir).withColumn("t", F.floor((F.col("seq") - 1) / 50))
    parent = F.when(F.col("seq") % 50 == 1, F.lit(None)).when(F.col("seq") % 5 == 0, F.col("seq") - 2).otherwise(F.col("seq") - 1)
    node = F.struct(
        F.concat(F.lit("n"), F.col("seq").cast("string")).alias("k"),
        F.struct(
            F.concat(F.lit("n"), parent.cast("string")).alias("parent"),
            F.struct(
                F.col("message_id").alias("id"), F.struct("role", F.lit(None).cast("string").alias("name")).alias("author"), F.col("ts").cast("string").alias("create_time"), F.lit(None).cast("string").alias("update_time"),
                F.struct(F.lit("text").alias("content_type"), F.when(F.col("text").isNull(), F.array().cast("array<string>")).otherwise(F.array("text")).alias("parts")).alias("content"),
                F.when(F.col("seq") % 11 == 7, F.lit('{"is_visually_hidden_from_conversation":true}')).alias("metadata"),
            ).alias("message"),
        ).alias("v"),
    )
    g = m.groupBy("t").agg(F.array_sort(F.collect_list(F.struct("seq", node.alias("n")))).alias("ns"), F.max(F.when(F.col("seq") % 5 != 4, F.col("seq"))).alias("last"))
    return g.select(
        F.concat(F.lit("t"), F.col("t").cast("string")).alias("conversation_id"), F.lit(None).cast("string").alias("id"), F.lit("").alias("title"),
        F.when(F.col("t") % 2 == 0, F.concat(F.lit("n"), F.col("last").cast("string"))).alias("current_node"), F.map_from_entries("ns.n").alias("mapping"),
    )


def export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trees written as JSON lines and read again, every 13th line broken."""
    rows = _trees(spark, sf_dir).withColumn("j", F.to_json(F.struct("conversation_id", "title", "current_node", "mapping")))
    broken = F.substring(F.col("conversation_id"), 2, 20).cast("long") % 13 == 5
    lines = rows.select(F.when(broken, F.substring("j", 1, 40)).otherwise(F.col("j")).alias("value"))
    return M.parse_export(lines).groupBy("corrupt").agg(F.count("*").alias("conversations"), F.coalesce(F.sum(F.size("mapping")), F.lit(0)).alias("nodes"))


def terminal_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.terminal_node(_trees(spark, sf_dir)).where("terminal is not null").select("conversation_id", "terminal")


def active_branch_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.active_path(M.terminal_node(_trees(spark, sf_dir))).where("path is not null")
    return t.select("conversation_id", F.array_join("path", ">").alias("path"))


def _flat(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return M.flatten(_trees(spark, sf_dir), **kw).select("conv_id", "role", "message_id", "text", "pos")


def messages_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir)


def hidden_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir, include_hidden=True)


def role_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir, roles=())


_TREE = r"""
WITH m AS (SELECT *, (seq - 1) // 50 t FROM messages),
e AS (SELECT t, CASE WHEN t % 2 = 0 THEN max(seq) FILTER (seq % 5 <> 4) ELSE arg_min(seq, (-ts, seq)) FILTER (ts IS NOT NULL) END term FROM m GROUP BY t),
p AS (SELECT m.*, row_number() OVER (PARTITION BY m.t ORDER BY seq) - 1 pos FROM m JOIN e USING (t) WHERE seq = term OR (seq < term AND seq % 5 <> 4))
"""
_FLAT = _TREE + f"SELECT 't' || t AS conv_id, coalesce(nullif(role, ''), 'unknown') AS role, coalesce(nullif(message_id, ''), 'n' || seq) AS message_id, regexp_replace(text, '{chr(92)}s+$', '') AS text, CAST(pos AS INT) AS pos FROM p WHERE "


def message_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_defaults(_m(spark, sf_dir)).select("seq", "conv_id", "title", "role", "message_id", F.length("text").alias("n"))


def role_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _m(spark, sf_dir)
    return m.select("seq", M.role_of(F.when(F.col("seq") % 3 == 0, F.lit("")).otherwise(F.col("role")), F.when(F.col("seq") % 2 == 0, F.lit("named"))).alias("role"))


def ts_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _m(spark, sf_dir).select("seq", M.ts_of(F.when(F.col("seq") % 4 > 0, F.col("ts")), F.col("ts") + 1).alias("ts"))


def conv_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _m(spark, sf_dir).select("seq", M.conv_id_of(F.when(F.col("seq") % 3 > 0, F.col("conv_id")), F.col("message_id")).alias("conv"))


def empty_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _m(spark, sf_dir).where("coalesce(text, '') <> ''").select("seq")


def extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of several kinds, made of every text: strings, a mix with objects, a kind without text."""
    return _extracted(_m(spark, sf_dir))


def _extracted(m: DataFrame) -> DataFrame:
    kind = F.element_at(F.array(F.lit("text"), F.lit("multimodal_text"), F.lit("code")), (F.col("seq") % 3 + 1).cast("int"))
    parts = F.array(F.lit("a"), F.lit('{"text":"b"}'), F.col("text"))
    return m.select("seq", M.text_of(F.struct(kind.alias("content_type"), parts.alias("parts"))).alias("text"))


def export_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.export_stats(M.with_defaults(_m(spark, sf_dir)))


def limit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.first_messages(_m(spark, sf_dir), 100).select("seq")


def limit_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.first_conversations(M.with_defaults(_m(spark, sf_dir)), 5).select("seq", "conv_id")


# -- text ---------------------------------------------------------------------------------------------------------


def redact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.redact(_mt(spark, sf_dir)).select("seq", "text")


def redact_pii_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.redact(_mt(spark, sf_dir), pii=False).select("seq", "text")


def redaction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = X.redact(_mt(spark, sf_dir), pii=False)
    return r.select(F.explode("redactions").alias("rule", "n")).groupBy("rule").agg(F.sum("n").alias("n"))


def _redacted_sql() -> tuple[str, str]:
    """CTEs of the rules one after the other; DuckDB's expressions have no look-around, which these don't need."""
    ctes, counts, before = [], [], "(SELECT seq, text FROM messages)"
    rules = [(n, duck(p), r"\[REDACTED\]".replace("\\", "")) for n, p in P.SECRETS]
    # the token is taken as a whole: texts where it stands in the header's words as well aren't in the tables
    rules += [("authorization_bearer", r"(?i)\b(Authorization\s*:\s*Bearer\s+)[A-Za-z0-9\-._~+/]+=*", r"\1[REDACTED]"), ("secret_kv", duck(P.KEY_VALUE), r"\1\2[REDACTED]")]
    for i, (name, p, to) in enumerate(rules):
        ctes.append(f"r{i} AS (SELECT seq, regexp_replace(text, '{p}', '{to}', 'g') text FROM {before})")
        n = f"len(list_filter(regexp_extract_all(text, '{p}', 3), lambda v: v <> '[REDACTED]'))" if name == "secret_kv" else f"len(regexp_extract_all(text, '{p}'))"
        counts.append(f"SELECT '{name}' AS rule, sum({n}) AS n FROM {before}")
        before = f"r{i}"
    return "WITH " + ", ".join(ctes), " UNION ALL ".join(counts)


_R, _COUNTS = _redacted_sql()


def elide_code_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.elide_code(_mt(spark, sf_dir), 8).where("elided > 0")


def truncate_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _m(spark, sf_dir).select("seq", X.truncate_middle(F.col("text"), 300).alias("text"))


def build_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.build_view(_mt(spark, sf_dir)).select("seq", F.length("text").alias("n"), "elided", "cut", F.size("redactions").alias("rules"))


def view_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _mt(spark, sf_dir)
    return M.view_stats(m, M.build_view(m))


def scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mt(spark, sf_dir).select("seq", F.explode(F.array_distinct(X.secret_hits(F.col("text")))).alias("hit"))


def scan_kv_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mt(spark, sf_dir).select("seq", F.size(F.filter(X.secret_hits(F.col("text")), lambda h: h == "secret_kv_high_entropy")).alias("n")).where("n > 0")


def scan_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mt(spark, sf_dir).where(F.col("text").rlike(P.EMAIL)).select("seq")


def scan_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mt(spark, sf_dir).where(F.array_contains(X.pii_hits(F.col("text")), "phone_like")).select("seq")


def high_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "evidence").select("evidence_id", X.high_entropy(F.when(F.length("quote") > 40, F.col("quote_hash")).otherwise(F.col("quote"))).alias("high")).distinct()


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _m(spark, sf_dir).select("seq", X.token_count(F.col("text")).alias("tokens"))


def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _m(spark, sf_dir).select("role", F.octet_length("text").alias("b"), F.length("text").alias("c"), X.token_count(F.col("text")).alias("t"))
    return m.rollup("role").agg(F.grouping("role").cast("int").alias("total"), F.sum("b").alias("bytes"), F.sum("c").alias("chars"), F.sum("t").alias("tokens")).select(F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("role")).alias("role"), "bytes", "chars", "tokens")


def _f(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "facts")


def single_line_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _f(spark, sf_dir).select("fact_id", X.single_line(F.col("fact_text")).alias("t"))


def normalize_fact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _f(spark, sf_dir).select("fact_id", X.normalized(F.col("fact_text")).alias("t"))


def ellipsis_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _f(spark, sf_dir).select("fact_id", X.ellipsis(F.col("fact_text"), 100).alias("t"))


def fmt_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _f(spark, sf_dir).select("fact_id", X.format_ts(F.col("last_seen_ts")).alias("t"))


def fmt_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _f(spark, sf_dir).select("fact_id", X.format_confidence(F.col("confidence_max") / 7).alias("t"))


def category_file_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _f(spark, sf_dir).select("fact_id", X.report_key(F.col("category")).alias("report"))


def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "evidence")
    return e.select("evidence_id", X.content_id(*map(F.col, ("fact_id", "conv_id", "message_id", "role", "quote_hash"))).alias("id"), F.sha2("quote", 256).alias("hash")).distinct()


def conversation_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.conversation_runs(_m(spark, sf_dir))


_NAMES = (
    "export_scan terminal_node active_branch_path messages_flat hidden_filter role_filter message_defaults role_resolution ts_coalesce conv_identity empty_text_filter extract_text export_stats limit_messages limit_conversations redact_text "
    "redact_pii_off redaction_counts elide_code_blocks truncate_middle build_view view_stats scan_secrets scan_kv_entropy scan_pii scan_phone high_entropy token_count token_totals normalize_fact_text ellipsis_truncate fmt_ts fmt_confidence category_file_key content_ids conversation_runs"
).split()
QUERIES = {n: globals()[n] for n in _NAMES} | {"single_line": single_line_q}

_KV_VALUES = f"list_filter(regexp_extract_all(text, '{duck(P.KEY_VALUE)}', 3), lambda v: NOT contains(v, '[REDACTED]') AND regexp_full_match(v, '[A-Za-z0-9+/_=-]{{20,}}'))"
_DEF = "coalesce(nullif({0}, ''), 'unknown')"

SQL = {
    "export_scan": "WITH t AS (SELECT (seq - 1) // 50 t, count(*) n FROM messages GROUP BY 1) SELECT t % 13 = 5 AS corrupt, count(*) AS conversations, coalesce(sum(n) FILTER (t % 13 <> 5), 0) AS nodes FROM t GROUP BY 1",
    "terminal_node": _TREE + "SELECT 't' || t AS conversation_id, 'n' || term AS terminal FROM e WHERE term IS NOT NULL",
    "active_branch_path": _TREE + "SELECT 't' || t AS conversation_id, string_agg('n' || seq, '>' ORDER BY seq) AS path FROM p GROUP BY t",
    "messages_flat": _FLAT + "role IN ('user', 'assistant') AND seq % 11 <> 7 AND regexp_replace(coalesce(text, ''), '\\s+$', '') <> ''",
    "hidden_filter": _FLAT + "role IN ('user', 'assistant') AND regexp_replace(coalesce(text, ''), '\\s+$', '') <> ''",
    "role_filter": _FLAT + "seq % 11 <> 7 AND regexp_replace(coalesce(text, ''), '\\s+$', '') <> ''",
    "message_defaults": f"SELECT seq, {_DEF.format('conv_id')} AS conv_id, coalesce(title, '') AS title, {_DEF.format('role')} AS role, {_DEF.format('message_id')} AS message_id, length(coalesce(text, '')) AS n FROM messages",
    "role_resolution": "SELECT seq, coalesce(nullif(CASE WHEN seq % 3 = 0 THEN '' ELSE role END, ''), CASE WHEN seq % 2 = 0 THEN 'named' END, 'unknown') AS role FROM messages",
    "ts_coalesce": "SELECT seq, coalesce(CASE WHEN seq % 4 > 0 THEN ts END, ts + 1) AS ts FROM messages",
    "conv_identity": "SELECT seq, coalesce(nullif(CASE WHEN seq % 3 > 0 THEN conv_id END, ''), nullif(message_id, ''), 'unknown') AS conv FROM messages",
    "empty_text_filter": "SELECT seq FROM messages WHERE coalesce(text, '') <> ''",
    "export_stats": f"SELECT {_DEF.format('role')} AS role, count(*) AS messages, count(DISTINCT {_DEF.format('conv_id')}) AS conversations FROM messages GROUP BY 1",
    "limit_messages": "SELECT seq FROM messages ORDER BY seq LIMIT 100",
    "limit_conversations": f"WITH m AS (SELECT seq, {_DEF.format('conv_id')} conv_id FROM messages), f AS (SELECT conv_id FROM m GROUP BY 1 ORDER BY min(seq) LIMIT 5) SELECT seq, conv_id FROM m JOIN f USING (conv_id)",
    "redact_pii_off": f"{_R} SELECT seq, text FROM r8",
    "redaction_counts": f"{_R} SELECT rule, n FROM ({_COUNTS}) WHERE n > 0",
    "truncate_middle": "SELECT seq, CASE WHEN length(text) > 300 THEN left(text, 118) || chr(10) || '[OMITTED: ' || (length(text) - 236) || ' chars]' || chr(10) || right(text, 118) ELSE text END AS text FROM messages",
    "scan_kv_entropy": f"SELECT seq, len({_KV_VALUES}) AS n FROM messages WHERE len({_KV_VALUES}) > 0",
    # word boundaries by letters of any script, which its own aren't
    "scan_pii": r"SELECT seq FROM messages WHERE regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])[A-Z0-9_][A-Z0-9._%+-]*@[A-Z0-9.-]+\.[A-Z]{2,}($|[^\p{L}\p{N}_])')",
    "scan_secrets": " UNION ALL ".join([f"SELECT seq, '{n}' AS hit FROM messages WHERE regexp_matches(text, '{duck(p)}')" for n, p in P.SECRETS] + [f"SELECT seq, 'secret_kv_high_entropy' FROM messages WHERE len({_KV_VALUES}) > 0"] + [r"SELECT seq, 'authorization_bearer' FROM messages WHERE regexp_matches(text, '(?i)\bAuthorization\s*:\s*Bearer\s+[A-Za-z0-9\-._~+/]+=*')"]),
    "high_entropy": "SELECT DISTINCT evidence_id, regexp_full_match(CASE WHEN length(quote) > 40 THEN quote_hash ELSE quote END, '[A-Za-z0-9+/_=-]{20,}') AS high FROM evidence",
    "token_count": "SELECT seq, CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT) AS tokens FROM messages",
    "token_totals": "SELECT CASE WHEN grouping(role) = 1 THEN 'TOTAL' ELSE role END AS role, sum(strlen(text)) AS bytes, sum(length(text)) AS chars, sum(CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT)) AS tokens FROM messages GROUP BY ROLLUP(role)",
    "single_line": f"SELECT fact_id, {single_line('fact_text')} AS t FROM facts",
    "normalize_fact_text": f"SELECT fact_id, {normalized('fact_text')} AS t FROM facts",
    "ellipsis_truncate": "SELECT fact_id, CASE WHEN length(fact_text) <= 100 THEN fact_text ELSE left(fact_text, 99) || '…' END AS t FROM facts",
    "fmt_ts": "SELECT fact_id, coalesce(strftime(make_timestamp(CAST(floor(last_seen_ts) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ'), 'unknown') AS t FROM facts",
    "fmt_confidence": "SELECT fact_id, printf('%.3f', confidence_max / 7) AS t FROM facts",
    "category_file_key": "SELECT fact_id, CASE split_part(category, '.', 1) WHEN category THEN 'misc' WHEN 'identity' THEN 'identity' WHEN 'preferences' THEN 'preferences' WHEN 'meta' THEN 'preferences' WHEN 'projects' THEN 'projects' WHEN 'goals' THEN 'goals' WHEN 'constraints' THEN 'constraints' ELSE 'misc' END AS report FROM facts",
    "content_ids": "SELECT DISTINCT evidence_id, sha256(concat_ws(chr(10), fact_id, conv_id, message_id, role, quote_hash)) AS id, sha256(quote) AS hash FROM evidence",
    "conversation_runs": f"WITH m AS (SELECT seq, {_DEF.format('conv_id')} conv_id FROM messages), l AS (SELECT *, lag(conv_id) OVER (ORDER BY seq) p FROM m), r AS (SELECT *, sum(CASE WHEN p IS NULL OR p <> conv_id THEN 1 ELSE 0 END) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) run_no FROM l) SELECT run_no, conv_id, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS messages FROM r GROUP BY 1, 2",
    # a text that is itself a JSON object or array counts as an object of the content
    "extract_text": f"""WITH m AS (SELECT seq, text, coalesce(regexp_matches(text, '^\\s*[\\[{{]') AND json_valid(text), false) obj FROM messages)
SELECT seq, CASE seq % 3 WHEN 0 THEN regexp_replace('a' || CASE WHEN obj OR text IS NULL THEN '' ELSE chr(10) || text END, '{WS}+$', '')
  WHEN 1 THEN regexp_replace('a' || chr(10) || 'b' || coalesce(chr(10) || CASE WHEN obj THEN json_extract_string(text, '$.text') ELSE text END, ''), '{WS}+$', '') ELSE '' END AS text FROM m""",
    "scan_phone": f"SELECT seq FROM messages WHERE {phone_like('text')}",
}
