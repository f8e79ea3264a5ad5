"""Pieces of DuckDB text shared by the queries' SQL."""

# Unicode's blanks: its regular expressions know ASCII's only
WS = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def duck(pattern: str) -> str:
    """A pattern in Java's syntax as one of DuckDB's; without look-around."""
    return pattern.replace("(?U)", "").replace("(?Ui)", "(?i)").replace("'", "''")


# signs of words in any script, which its own classes don't know
_EDGE, _DIGIT = r"[^\p{L}\p{M}\p{Nd}\p{Pc}]", r"\p{Nd}"


def phone_like(x: str) -> str:
    return rf"regexp_matches({x}, '(^|{_EDGE})\+?{_DIGIT}[{_DIGIT} \-()]{{8,}}{_DIGIT}($|{_EDGE})')"


def email_like(x: str) -> str:
    return rf"regexp_matches({x}, '(?i)(^|{_EDGE})[A-Z0-9_][A-Z0-9._%+-]*@[A-Z0-9.-]+\.[A-Z]{{2,}}($|{_EDGE})')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def single_line(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{WS}+', ' ', 'g')"


def normalized(x: str) -> str:
    return f"replace(lower({single_line(x)}), 'ß', 'ss')"


def is_text(x: str) -> str:
    return f"coalesce(length({strip(x)}) > 0, false)"


#: The store of the given claims, as CTEs: k (claims with identity), store (facts).
def _claim_json() -> str:
    return "concat_ws('|', category, fact, stability, status, confidence, time, evidence, derived_from, value, tags, notes)"


STORE = f"""
u AS (
  SELECT *, row_number() OVER (PARTITION BY coalesce(category, '~'), coalesce(fact, '~'), coalesce(stability, '~'), coalesce(status, '~'), confidence, time, evidence, coalesce(derived_from, '~'), coalesce(value, '~'), tags, coalesce(notes, '~') ORDER BY seq) copy
  FROM claims WHERE {is_text('category')} AND {is_text('fact')}),
k AS (
  SELECT *, sha256(category || chr(10) || {normalized(f"CASE WHEN {is_text('value')} THEN value ELSE fact END")}) fact_id,
    CASE WHEN derived_from = 'assistant' THEN 'needs_review' WHEN coalesce({strip('status')}, 'accepted') = 'needs_review' THEN 'needs_review' ELSE 'accepted' END wanted,
    time.as_of_ts as_of, CASE WHEN isnan(confidence) THEN NULL ELSE confidence END conf
  FROM u WHERE copy = 1),
store AS (
  SELECT fact_id, arg_min(category, seq) category,
    coalesce(arg_max({strip('fact')}, (as_of, seq)) FILTER (as_of IS NOT NULL), arg_min({strip('fact')}, seq)) fact_text,
    CASE WHEN count(DISTINCT stability) > 1 THEN 'transient' ELSE arg_min(stability, seq) END stability,
    min(as_of) first_seen_ts, max(as_of) last_seen_ts, max(conf) confidence_max,
    CASE WHEN bool_or(wanted = 'accepted') THEN 'accepted' ELSE 'needs_review' END status, count(*) claims
  FROM k GROUP BY fact_id)
"""
