"""Claims: the format of their lines, the rules for rows, canonical identity."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mnemoweave.functions import text as X

STABILITIES, STATUSES, SOURCES, ROLES = ("stable", "transient"), ("accepted", "needs_review"), ("user", "assistant", "mixed"), ("user", "assistant")
#: Accepted interests need so many different user messages.
INTEREST, LEAST_EVIDENCE = "preferences.interests", 3


def chunk_id_of(path: Column) -> Column:
    """The chunk that a claims file belongs to, from its name; null for other names. Numbers of more than four digits count."""
    return F.nullif(F.regexp_extract(path, r"(?:^|/)claims_(chunk_\d{4,})\.jsonl$", 1), F.lit(""))


def line_format(lines: DataFrame, column: str = "value") -> DataFrame:
    """lines with ``format``: blank, code_fence, non_json_object_line, json_parse, not_object or ok."""
    c = F.regexp_replace(F.col(column), "\\A\ufeff", "")
    body = X.strip(c)
    parsed = F.try_parse_json(body)
    kind = (
        F.when(~X.is_text(c), "blank")
        .when(body.startswith("```"), "code_fence")
        .when(~body.startswith("{"), "non_json_object_line")
        .when(parsed.isNull(), "json_parse")
        .when(F.schema_of_variant(parsed).startswith("OBJECT"), "ok")
        .otherwise("not_object")
    )
    return lines.withColumn("format", kind)


def _issue(level: str, code: str | Column, where: Column) -> Column:
    code = F.lit(code) if isinstance(code, str) else code
    return F.when(where, F.struct(F.lit(level).alias("level"), code.alias("code")))


def _not_in(c: Column, values: tuple[str, ...]) -> Column:
    return ~F.coalesce(c.isin(*values), F.lit(False))


def _safety(c: Column) -> Column:
    secrets = F.transform(X.secret_hits(c), lambda h: F.struct(F.lit("error").alias("level"), F.concat(F.lit("safety."), h).alias("code")))
    personal = F.transform(X.pii_hits(c), lambda h: F.struct(F.lit("warning").alias("level"), F.concat(F.lit("privacy."), h).alias("code")))
    return F.coalesce(F.concat(secrets, personal), F.array().cast("array<struct<level:string,code:string>>"))


def issues(claims: DataFrame, strict: bool = False) -> DataFrame:
    """(seq, file_no, no, level, code): one row per broken rule, in the order of the rules. strict makes warnings errors.

    Every rule is looked at; a null struct, array or value is a missing one. NaN confidence is invalid.
    """
    c = F.col
    evidence = F.coalesce("evidence", F.array().cast(claims.schema["evidence"].dataType))
    items = F.filter(evidence, lambda e: e.isNotNull())
    users = F.filter(items, lambda e: e["role"] == "user")
    pairs = F.array_distinct(F.transform(users, lambda e: F.struct(e["conv_id"], e["message_id"])))
    empty = "array<struct<level:string,code:string>>"

    def of_item(e: Column) -> Column:
        rules = [
            _issue("error", "evidence.role", _not_in(e["role"], ROLES)), *[_issue("error", f"evidence.{k}", ~X.is_text(e[k])) for k in ("quote", "conv_id", "message_id")],
            _issue("error", "evidence.ts", e["ts"].isNull()),
        ]
        return F.concat(F.filter(F.array(*rules), lambda x: x.isNotNull()), _safety(e["quote"]))

    confidence = c("confidence")
    rules = [
        _issue("error", "schema.category", ~X.is_text(c("category"))), _issue("error", "schema.fact", ~X.is_text(c("fact"))), _issue("error", "schema.stability", _not_in(c("stability"), STABILITIES)),
        _issue("error", "schema.status", _not_in(c("status"), STATUSES)), _issue("error", "schema.confidence", ~F.coalesce(confidence.between(0.0, 1.0) & ~F.isnan(confidence), F.lit(False))),
        _issue("error", "schema.time", c("time").isNull()), _issue("error", "schema.time.as_of_ts", c("time").isNotNull() & c("time.as_of_ts").isNull()),
        _issue("error", "schema.derived_from", _not_in(c("derived_from"), SOURCES)), _issue("error", "schema.evidence", F.size(evidence) == 0),
        _issue("error", "schema.evidence.item", F.size(items) < F.size(evidence)), _issue("error", "schema.tags", F.coalesce(F.exists("tags", lambda t: t.isNull()), F.lit(False))),
        _issue("error", "schema.value", c("value").isNotNull() & ~X.is_text(c("value"))),
    ]
    ending = [
        _issue("error", "grounding.user_evidence", F.coalesce(c("derived_from").isin("user", "mixed"), F.lit(False)) & (F.size(users) == 0)),
        _issue("error", "grounding.assistant_status", F.coalesce((c("derived_from") == "assistant") & (c("status") == "accepted"), F.lit(False))),
        _issue("error", "schema.value.required", F.coalesce(c("category") == INTEREST, F.lit(False)) & ~X.is_text(c("value"))),
        _issue("error", "interest.threshold", F.coalesce((c("category") == INTEREST) & (c("status") == "accepted"), F.lit(False)) & (F.size(pairs) < LEAST_EVIDENCE)),
    ]
    given = lambda rs: F.filter(F.array(*rs), lambda x: x.isNotNull())
    all_of = F.concat(given(rules), F.coalesce(F.flatten(F.transform(items, of_item)), F.array().cast(empty)), given(ending), _safety(c("fact")), _safety(c("notes")))
    out = claims.select("seq", "file_no", F.posexplode(all_of).alias("no", "i")).select("seq", "file_no", "no", F.col("i.level").alias("level"), F.col("i.code").alias("code"))
    return out.withColumn("level", F.lit("error")) if strict else out


def optional_issues(lines: DataFrame, column: str = "value") -> DataFrame:
    """(the other columns, level, code): optional fields of the claims' own JSON whose type is wrong, which typed rows can't show.

    A field that is absent or null breaks no rule. Lines that are no JSON object are left to :func:`line_format`.
    """
    v = F.try_parse_json(F.regexp_replace(F.col(column), "\\A\ufeff", ""))
    kind = {k: F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")) for k in ("tags", "notes", "value")}
    given = {k: F.coalesce(~t.isin("VOID"), F.lit(False)) for k, t in kind.items()}
    text = F.try_variant_get(v, "$.value", "string")
    rules = [
        _issue("error", "schema.tags", given["tags"] & ~kind["tags"].isin("ARRAY<STRING>", "ARRAY<VOID>") | F.coalesce(F.exists(F.try_variant_get(v, "$.tags", "array<variant>"), F.is_variant_null), F.lit(False))),
        _issue("error", "schema.notes", given["notes"] & (kind["notes"] != "STRING")),
        _issue("error", "schema.value", given["value"] & ((kind["value"] != "STRING") | ~X.is_text(text))),
    ]
    rest = [c for c in lines.columns if c != column]
    found = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return lines.select(*rest, F.explode(found).alias("__i")).select(*rest, "__i.level", "__i.code")


def summary(claims: DataFrame, found: DataFrame) -> DataFrame:
    """Per file: parsed and valid claims, errors and warnings. A claim is valid if it has neither."""
    per = found.groupBy("seq", "file_no").agg(F.count_if(F.col("level") == "error").alias("e"), F.count_if(F.col("level") == "warning").alias("w"))
    return (
        claims.select("seq", "file_no").join(per, ["seq", "file_no"], "left").groupBy("file_no")
        .agg(F.count("*").alias("parsed"), F.count_if(F.col("e").isNull()).alias("valid"), F.coalesce(F.sum("e"), F.lit(0)).alias("errors"), F.coalesce(F.sum("w"), F.lit(0)).alias("warnings"))
    )


def line_summary(lines: DataFrame) -> DataFrame:
    """Per path: lines in all and blank ones, of lines with ``format``."""
    return lines.groupBy("path").agg(F.count("*").alias("lines_total"), F.count_if(F.col("format") == "blank").alias("lines_blank"))


def gate(found: DataFrame) -> DataFrame:
    """Claims that may be merged nowhere: those with an error."""
    return found.where("level = 'error'").select("seq").distinct()


# -- identity -----------------------------------------------------------------------------------------------------


@F.pandas_udf(StringType())
def canonical_json(raw: pd.Series) -> pd.Series:
    """JSON with sorted keys and no blanks, numbers as they are written; null where it can't be read. Python, since no JVM
    function keeps both the keys' order and the numbers' form."""

    def one(x: str | None) -> str | None:
        try:
            return None if not isinstance(x, str) else json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    return pd.Series([one(x) for x in raw], dtype=object)


CLAIM_FIELDS = ("category", "fact", "stability", "status", "confidence", "time", "evidence", "derived_from", "value", "tags", "notes")


def claim_id(claims: DataFrame) -> Column:
    """Identity of a claim's content: the hash of its canonical JSON.

    Claims read from lines have their text in ``raw``; of others it is made of all fields but their place, null ones left out.
    """
    raw = F.col("raw") if "raw" in claims.columns else F.to_json(F.struct(*[F.col(c) for c in CLAIM_FIELDS if c in claims.columns]))
    return F.sha2(canonical_json(raw), 256)


def fact_id(category: Column, fact: Column, value: Column) -> Column:
    """Identity of the fact that a claim tells: its category and its folded value or text."""
    return F.sha2(F.concat(category, F.lit("\n"), X.normalized(F.when(X.is_text(value), value).otherwise(fact))), 256)


def deduped(claims: DataFrame) -> DataFrame:
    """Claims with ``claim_id``, the first of each: a map-side minimum, so copies are folded before the shuffle."""
    rest = [c for c in claims.columns if c != "seq"]
    g = claims.withColumn("claim_id", claim_id(claims)).groupBy("claim_id").agg(F.min_by(F.struct("seq", *rest), "seq").alias("r"))
    return g.select("claim_id", "r.*")


def secret_violations(claims: DataFrame) -> DataFrame:
    """(seq, hits) of claims that a merge refuses: secrets in fact, notes or quotes."""
    quotes = F.flatten(F.transform(F.coalesce("evidence", F.array().cast(claims.schema["evidence"].dataType)), lambda e: X.secret_hits(e["quote"], False)))
    hits = F.concat(X.secret_hits(F.col("fact"), False), X.secret_hits(F.col("notes"), False), quotes)
    return claims.select("seq", F.array_sort(F.array_distinct(hits)).alias("hits")).where("size(hits) > 0")


def unmergeable(claims: DataFrame) -> DataFrame:
    """(seq, reason) of claims that a merge refuses: secrets, or a required field that is missing.

    Weaker than the rules: the confidence's range isn't looked at, and a time may lack its value.
    """
    missing = F.filter(
        F.array(
            *[F.when(~X.is_text(F.col(c)), F.lit(c)) for c in ("category", "fact")],
            F.when(_not_in(F.col("stability"), STABILITIES), F.lit("stability")), F.when(F.col("confidence").isNull(), F.lit("confidence")),
            F.when(_not_in(F.col("derived_from"), SOURCES), F.lit("derived_from")),
        ),
        lambda x: x.isNotNull(),
    )
    fields = claims.select("seq", F.concat(F.lit("missing: "), F.array_join(missing, ", ")).alias("reason"), F.size(missing).alias("n")).where("n > 0").drop("n")
    secrets = secret_violations(claims).select("seq", F.concat(F.lit("secret: "), F.array_join("hits", ", ")).alias("reason"))
    return secrets.unionByName(fields)
