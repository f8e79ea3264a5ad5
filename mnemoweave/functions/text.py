"""Text functions as Column expressions; all run inside the JVM but those that say otherwise."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mnemoweave.functions import patterns as P


def strip(c: Column) -> Column:
    """Blanks of any kind removed on both sides."""
    return F.regexp_replace(c, rf"\A{P.BLANKS}+|{P.BLANKS}+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{P.BLANKS}+\z", "")


def is_text(c: Column) -> Column:
    """Not null and not blank; never null itself."""
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def single_line(c: Column) -> Column:
    """Trimmed, blanks in a row made one space."""
    return F.regexp_replace(strip(c), rf"{P.BLANKS}+", " ")


def _folds() -> dict[str, str]:
    """The letters whose full Unicode case folding isn't their lower case in every JVM, with their folding. By rule: folded
    otherwise than in lower case, the sigma (whose lower case depends on its place), and letters younger than Unicode 3.2."""
    old = unicodedata.ucd_3_2_0
    out = {}
    for i in range(0x110000):
        c = chr(i)
        f = c.casefold()
        if f != c.lower() or c == "Σ" or (f != c and old.category(c) == "Cn"):
            out[c] = f
    return out


FOLDS = _folds()


def _class_of(signs: Iterable[str]) -> str:
    """A regular expression for one of the characters."""
    runs: list[list[int]] = []
    for i in sorted(map(ord, signs)):
        if runs and i == runs[-1][1] + 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


_FOLDED_OTHERWISE = _class_of(FOLDS)


def casefolded(c: Column) -> Column:
    """Full Unicode case folding. Lower case where that is the same; else letter by letter, which only rows with one of
    ``FOLDS`` pay for. All in the JVM."""
    table = F.from_json(F.lit(json.dumps(FOLDS)), "map<string,string>")  # one literal, read once when the plan is made
    letters = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    slow = F.array_join(F.transform(letters, lambda x: F.coalesce(F.try_element_at(table, x), F.lower(x))), "")
    return F.when(c.rlike(_FOLDED_OTHERWISE), slow).otherwise(F.lower(c))


def normalized(c: Column) -> Column:
    """As :func:`single_line`, case folded."""
    return casefolded(single_line(c))


def ellipsis(c: Column, n: int) -> Column:
    """At most n characters, the last being an ellipsis where something was cut."""
    if n <= 0:
        return F.when(c.isNotNull(), F.lit(""))
    short = F.substring(c, 1, 1) if n == 1 else F.concat(F.substring(c, 1, n - 1), F.lit("…"))
    return F.when(F.length(c) <= n, c).otherwise(short)


def truncate_middle(c: Column, n: int) -> Column:
    """Texts over n characters keep their head and tail around a marker that names what is left out."""
    if n <= 0:
        return c
    if n <= 64:
        return F.when(F.length(c) > n, F.substring(c, 1, n)).otherwise(c)
    head = (n - 64) // 2
    tail = n - 64 - head
    cut = F.concat(F.substring(c, 1, head), F.lit("\n[OMITTED: "), (F.length(c) - head - tail).cast("string"), F.lit(" chars]\n"), F.right(c, F.lit(tail)))
    return F.when(F.length(c) > n, cut).otherwise(c)


def format_ts(c: Column) -> Column:
    """Epoch seconds as UTC; seconds are cut, null is "unknown". The session's zone must be UTC."""
    return F.coalesce(F.date_format(F.timestamp_seconds(F.floor(c)), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("unknown"))


@F.pandas_udf(StringType())
def format_confidence(v: pd.Series) -> pd.Series:
    """Three digits, rounding the binary value half to even: no JVM function does that."""
    return pd.Series([None if pd.isna(x) else f"{x:.3f}" for x in v], dtype=object)


def token_count(c: Column) -> Column:
    """UTF-8 bytes over four, rounded up; 0 for null. Stands for a tokenizer's count where none is given."""
    return F.ceil(F.coalesce(F.octet_length(c), F.lit(0)) / 4).cast("long")


def replace_matches(c: Column, pattern: str, f: Callable[[Column], Column]) -> Column:
    """Each match m replaced by f(m): the text between matches and the matches are taken apart and zipped again."""
    between = F.split(c, pattern, -1)
    matches = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), f)
    parts = F.zip_with(between, matches, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(c.rlike(pattern), F.array_join(parts, "")).otherwise(c)


def _phone(m: Column) -> Column:
    digits = F.length(F.regexp_replace(m, r"(?U)\D", ""))
    return F.when(m.rlike(r"\A\+|[ \-()]") & digits.between(10, 15), P.REDACTED).otherwise(m)


def _bearer(m: Column) -> Column:
    # every occurrence of the token's text inside the match, as the pipeline does
    return F.replace(m, F.regexp_extract(m, P.BEARER, 1), F.lit(P.REDACTED))


def _changed(c: Column, pattern: str, f: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda m: f(m) != m))


RULES = (*(n for n, _ in P.SECRETS), "authorization_bearer", "secret_kv", "email", "phone_like")


def redact(df: DataFrame, text: str = "text", pii: bool = True) -> DataFrame:
    """df with `text` redacted and ``redactions`` (rule -> number, rules that hit only).

    The rules run one after the other, each on what the one before left. Each has its column of text and of number, so
    that no pattern is evaluated twice.
    """
    kept = [x for x in df.columns if x not in (text, "redactions")]
    out = df.select(*kept, F.col(text).alias("__t"))
    counts = {}

    def step(name: str, number: Column, new: Column) -> None:
        nonlocal out
        counts[name] = f"__n_{name}"
        out = out.select(*[x for x in out.columns if x != "__t"], number.alias(counts[name]), new.alias("__t"))

    t = F.col("__t")
    for name, pattern in P.SECRETS:
        step(name, F.regexp_count(t, F.lit(pattern)), F.regexp_replace(t, pattern, P.REDACTED.replace("[", "\\[")))
    step("authorization_bearer", _changed(t, P.BEARER, _bearer), replace_matches(t, P.BEARER, _bearer))
    step("secret_kv", F.size(F.filter(F.regexp_extract_all(t, F.lit(P.KEY_VALUE), F.lit(3)), lambda v: v != P.REDACTED)), F.regexp_replace(t, P.KEY_VALUE, "$1$2" + P.REDACTED))
    if pii:
        step("email", F.regexp_count(t, F.lit(P.EMAIL)), F.regexp_replace(t, P.EMAIL, P.REDACTED))
        step("phone_like", _changed(t, P.PHONE, _phone), replace_matches(t, P.PHONE, _phone))
    found = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, counts)), F.array(*[F.coalesce(c, F.lit(0)).cast("int") for c in counts.values()])), lambda _, n: n > 0)
    return out.select(*kept, t.alias(text), found.alias("redactions"))


def elide_code(df: DataFrame, limit: int = 120, text: str = "text") -> DataFrame:
    """df with fenced blocks of more than `limit` lines replaced by a marker, and their number ``elided``.

    A line whose first signs are three backticks opens or closes; an unclosed block is kept. The state machine is one
    ``aggregate`` over the lines. limit <= 0 leaves all as it is.
    """
    t = F.col(text)
    if limit <= 0:
        return df.withColumn("elided", F.lit(0))
    lines = F.filter(F.split(t, r"(?<=\n)", -1), lambda x: x != "")
    start = F.struct(F.lit("").alias("out"), F.lit(False).alias("inside"), F.lit("").alias("open"), F.lit("").alias("code"), F.lit(0).alias("n"), F.lit(0).alias("elided"))

    def step(s: Column, x: Column) -> Column:
        fence = F.ltrim(F.regexp_replace(x, rf"\A{P.BLANKS}+", "")).startswith("```")
        lang = strip(F.substring(strip(s["open"]), 4, 1_000_000))
        marker = F.concat(
            F.lit("[OMITTED CODE BLOCK: "), s["n"].cast("string"), F.lit(" lines, sha256="), F.substring(F.sha2(s["code"], 256), 1, 12),
            F.when(lang != "", F.concat(F.lit(", lang="), lang)).otherwise(""), F.lit("]\n"),
        )
        closed = F.concat(s["out"], s["open"], F.when(s["n"] > limit, marker).otherwise(s["code"]), x)
        opens, closes = fence & ~s["inside"], fence & s["inside"]
        return F.struct(
            F.when(closes, closed).when(s["inside"] | opens, s["out"]).otherwise(F.concat(s["out"], x)).alias("out"),
            F.when(fence, ~s["inside"]).otherwise(s["inside"]).alias("inside"),
            F.when(opens, x).when(closes, F.lit("")).otherwise(s["open"]).alias("open"),
            F.when(s["inside"] & ~fence, F.concat(s["code"], x)).otherwise(F.when(fence, F.lit("")).otherwise(s["code"])).alias("code"),
            F.when(s["inside"] & ~fence, s["n"] + 1).otherwise(F.when(fence, F.lit(0)).otherwise(s["n"])).alias("n"),
            (s["elided"] + F.when(closes & (s["n"] > limit), 1).otherwise(0)).alias("elided"),
        )

    done = F.aggregate(lines, start, step)
    # only texts with two fences and enough lines can have one
    can = F.regexp_count(t, F.lit(r"(?m)^[^\S\n]*```")) >= 2
    out = df.withColumn("__e", F.when(can, done))
    whole = F.when(F.col("__e.inside"), F.concat("__e.out", "__e.open", "__e.code")).otherwise(F.col("__e.out"))
    return out.withColumn(text, F.coalesce(whole, t)).withColumn("elided", F.coalesce("__e.elided", F.lit(0))).drop("__e")


def secret_hits(c: Column, every_pair: bool = True) -> Column:
    """Codes of the secrets in a text, in order; a key with a value of high entropy once per pair, or once at all."""
    codes = [F.when(c.rlike(p), n) for n, p in P.SECRETS] + [F.when(c.rlike(P.BEARER_SCAN), "authorization_bearer")]
    values = F.filter(F.regexp_extract_all(c, F.lit(P.KEY_VALUE), F.lit(3)), lambda v: ~v.contains(P.REDACTED) & v.rlike(P.HIGH_ENTROPY))
    pairs = F.transform(values, lambda _: F.lit("secret_kv_high_entropy"))
    if not every_pair:
        pairs = F.slice(pairs, 1, 1)
    return F.coalesce(F.concat(F.filter(F.array(*codes), lambda x: x.isNotNull()), pairs), F.array().cast("array<string>"))


def pii_hits(c: Column) -> Column:
    """Codes of the personal data in a text: the phone's raw candidates count, whatever their digits."""
    return F.filter(F.array(F.when(c.rlike(P.EMAIL), "email"), F.when(c.rlike(P.PHONE), "phone_like")), lambda x: x.isNotNull())


def high_entropy(c: Column) -> Column:
    return F.coalesce((c != P.REDACTED) & c.rlike(P.HIGH_ENTROPY), F.lit(False))


def content_id(*parts: Column) -> Column:
    """Hash of the parts, one per line."""
    return F.sha2(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


# The report that a category belongs to, by prefix.
REPORTS = (("identity.", "identity"), ("preferences.", "preferences"), ("projects.", "projects"), ("goals.", "goals"), ("constraints.", "constraints"), ("meta.", "preferences"))


def report_key(category: Column) -> Column:
    out = F.lit("misc")
    for prefix, key in reversed(REPORTS):
        out = F.when(category.startswith(prefix), key).otherwise(out)
    return out
