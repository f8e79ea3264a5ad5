"""Credentials inside listings, commands and settings: entropy per alphabet with length-adjusted thresholds.

Candidates are quoted strings and long tokens, of every line. How much evidence a candidate must give by its entropy depends on where
it stands: in the place of a credential (a key that names one, a login's second argument, a URL's user part) little is
asked, elsewhere a lot. Hashes, identifiers, references and placeholders are excluded.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What stands in place of a value.
BLANK = "[CREDENTIAL]"

# Words of key names, in several languages.
STRONG = frozenset("password passwd passwort pwd pass pw passphrase secret token apikey apitoken credential credentials kennwort contraseña contrasena clave psk senha jwt bearer authtoken motdepasse wachtwoord пароль parole pin".split())
COMPOUND = frozenset("api auth access private secret licence license master signing encryption account shared session service deploy client storage webhook".split())
NOT_LAST = frozenset("file path id name length len policy ref reference budget limit count estimate ttl type url uri field hint expiry expires rotation env var size prompt label alias version kind strategy hash digest checksum fingerprint tokens passwords secrets keys required enabled manager provider store vault index column header param regex pattern".split())
NOT_ANY = frozenset("public max min num pub count tokenizer estimate checksum sha sha1 sha256 sha512 md5 etag digest integrity revision commit guid uuid".split())
PLACEHOLDERS = ("your", "change-me", "changeme", "change_me", "replace", "example", "dummy", "placeholder", "redacted", "todo", "xxxx", "***", "...", "insert", "sample", "${", "{{", "@@", "%(", "$(", "#{")
WORDS_FOR_NOTHING = frozenset("null none nil true false undefined empty yes no on off string str secret password token key pass passwd required optional".split())
# Shapes of issuers' tokens.
ISSUED = re.compile(r"(?<![\w-])(?:sk-[A-Za-z0-9_-]{16,}|xox[a-z]-[\w-]{16,}|gh[a-z]_\w{30,}|github_pat_\w{20,}|(?:AKIA|ASIA)[A-Z0-9]{16}|AIza[\w-]{30,}|eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,}|glpat-[\w-]{16,}|npm_\w{30,})")
CUES = ("pass", "pwd", "pw", "secret", "token", "key", "cred", "auth", "bearer", "login", "clave", "contrase", "kennwort", "psk", "senha", "wachtwoord", "парол", "jwt", "://", "@tcp(", "@unix(", "mysql", "identified", "begin ", "sk-", "xox", "ghp_", "akia", "asia", "aiza", "eyj", '" +', "' +", " -u ", "basic ")

_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_HEX = re.compile(r"(?:0x)?[0-9a-fA-F]+")
_DOTTED = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)+")
_LOWER = re.compile(r"[^\W\d_A-Z]+")
_SPLIT = re.compile(r"[^\W_]+")
_CAMEL = re.compile(r"(?<=[a-zà-ÿ0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----.*?(?:-----END \1-----|\Z)", re.S)
_NAME = r"[^\W\d][\w.\-]*"
_QUOTED = r"(?P<q>'''|\"\"\"|[\"'`])(?P<v>(?:\\.|(?!(?P=q))[^\n\\])*)(?P=q)"
_BARE = r"(?P<b>[^\s\"'`,;<>(){}\[\]|\\]+)(?P<call>\()?"
_ASSIGN = re.compile(rf"(?P<name>{_NAME})(?:\"|'|'\]|\"\]|\])?(?P<op>[ \t]*(?:\?\?=|:=|=>|={{1,3}}|!==?|:)[ \t]*|[ \t]*:[ \t]*[>|]-?[ \t]*\n[ \t]*)(?:\[\]byte\(|new \w+\(|[brf](?=[\"'`]))?(?:{_QUOTED}|{_BARE})")
_PAIR = re.compile(rf"(?P<kq>[\"'])(?P<name>{_NAME})(?P=kq)[ \t]*,[ \t]*{_QUOTED}")
_ADD = re.compile(rf"(?:key|name)=(?P<kq>[\"'])(?P<name>{_NAME})(?P=kq)\s+value={_QUOTED}")
_ELEMENT = re.compile(rf"<(?P<name>{_NAME})>(?P<b>[^<>\n]+)</(?P=name)>")
_ENV = re.compile(rf"\b(?:ENV|ARG|export|set|setx|SET)[ \t]+(?P<name>{_NAME})[ \t]+(?P<b>[^\s\"'=]+)")
_CALL = re.compile(rf"(?P<name>{_NAME})\([ \t]*(?:(?:[\"'][^\"'\n]*[\"']|[\w.]+)[ \t]*,[ \t]*)?{_QUOTED}[ \t]*[,)]")
_TUPLE = re.compile(rf"(?P<name>{_NAME})[ \t]*[=:][ \t]*[(\[][ \t]*[\"'][^\"'\n]*[\"'][ \t]*,[ \t]*{_QUOTED}")
_INNER = re.compile(rf"(?<=[;?&\"' ,({{])(?P<name>{_NAME})=(?P<b>[^\s;&\"'`<>,)]+)")
_NETRC = re.compile(r"\blogin[ \t]+\S+[ \t]+(?P<name>password)[ \t]+(?P<b>[^\s\"'`]+)")
_SLASHED = re.compile(r"(?i)\b(?P<name>login|credentials?|user|account)[ \t]*:[ \t]*[\w.@-]+[ \t]*/[ \t]*(?P<b>[^\s\"'`/]{4,})")
_SQL = re.compile(rf"(?i)\b(?P<name>PASSWORD)[ \t]+{_QUOTED}|IDENTIFIED[ \t]+BY[ \t]+'(?P<b>[^'\n]+)'")
_FLAG = re.compile(rf"(?:sshpass[ \t]+-p[ \t]*|--(?P<name>(?:pass(?:word|wd|phrase)?|token|secret|api-?key))[ \t=])[ \t]*(?:{_QUOTED}|{_BARE})")
_USERPW = re.compile(r"(?:(?<=-u )|(?<=--user ))[\"']?[^\s:\"']+:(?P<b>[^\s\"'`]+)")
_MYSQL = re.compile(r"\b(?:mysql\w*|mariadb\w*)\b[^\n]*? -p(?P<b>[^\s\"'`]+)")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*://[^\s:/@\"'<>`]*:(?P<b>(?!\d+/)[^\s@\"'<>`]+)@")
_DSN = re.compile(r"(?<=[\"'`])[\w.-]+:(?P<b>[^\s/@\"'<>`:]+)@\w+\(")
_SCHEME = re.compile(r"(?i)\b(?:bearer|basic|apikey|token)[ \t]+(?P<b>[A-Za-z0-9+/=._~\-]{8,})")
_HEADER = re.compile(rf"(?i)\b(?P<name>x-[a-z-]*(?:auth|key|token|secret)[a-z-]*)[\"']?[ \t]*[:,=][ \t]*(?:{_QUOTED}|{_BARE})")
_STRING = re.compile(r"(?<![\w\"'])(?P<q>[\"'`])(?P<v>[^\s\"'`<>{}$\\]{16,})(?P=q)")
_LONG = re.compile(r"(?<![A-Za-z0-9+/_.\-~])[A-Za-z0-9+/_.\-~]{20,}={0,2}")
_BEFORE_NONE = re.compile(r"(?i)(?:;base64,|\b(?:ssh|ecdsa|sk-ssh)-[\w@.\-]+ |\b(?:sha\d*|md5)[-:=/ ]\s?)$")
_NAMED = re.compile(rf"(?P<name>{_NAME})[\"'\]]*[ \t]*[:=][ \t]*[\"'`]?$")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Longest run of base64 signs that may be a credential; longer ones are encoded data.
DATA = 512
_ENCODED = re.compile(r"[\s\"'>|]*[A-Za-z0-9+/]{20,}={0,2}[\s\"'+,\\]*")
_PIECE = re.compile(r"(?<=[\"'])[^\"'\s]{6,}(?=[\"'][ \t]*\+[ \t]*[\"'])")
_MORE = re.compile(r"[ \t]*\+[ \t]*(?:\n[ \t]*)?(?P<q>[\"'])(?P<v>[^\"'\n]*)(?P=q)")


@lru_cache(100_000)
def name_strength(name: str) -> int:
    """How far a key's name points to a credential: 2 surely, 1 perhaps, 0 not."""
    words = [w.lower() for part in _SPLIT.findall(name) for w in _CAMEL.split(part)]
    if not words or words[-1] in NOT_LAST or NOT_ANY.intersection(words):
        return 0
    joined = "".join(words)
    if STRONG.intersection(words[-2:]) or words[-1] in STRONG or joined.endswith(("motdepasse", "apikey", "authtoken", "password", "accesskey")):
        return 2
    if words[-1] == "key" and len(words) > 1:
        return 2 if COMPOUND.intersection(words) else 1
    return 1 if words[-1] in ("key", "auth", "authorization") or STRONG.intersection(words) else 0


def entropy(s: str) -> float:
    """Shannon entropy of the characters, in bits each."""
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in (s.count(x) for x in set(s))) if n else 0.0


def alphabet(s: str) -> int:
    """Size of the smallest usual alphabet that holds s."""
    if s.isdigit():
        return 10
    if _HEX.fullmatch(s):
        return 16
    size = 26 * any(c.islower() for c in s) + 26 * any(c.isupper() for c in s) + 10 * any(c.isdigit() for c in s)
    return max(2, size + (2 if all(c.isalnum() or c in "+/=-_" for c in s) else 20))


def randomness(s: str) -> float:
    """Entropy over what a random string of this length and alphabet can reach; about 1 for random ones."""
    most = min(math.log2(max(2, len(s))), math.log2(alphabet(s)))
    return entropy(s) / most if most else 0.0


def is_reference(v: str, quoted: bool) -> bool:
    """Placeholders, references to variables or stores, words, paths, checksums, public keys."""
    low = v.lower()
    if len(v) < 4 or low in WORDS_FOR_NOTHING or any(p in low for p in PLACEHOLDERS) or v[0] == "$" or v[0] + v[-1] in ("<>", "%%", "[]", "{}"):
        return True
    if len(set(low)) <= 2 or low.startswith(("sha1", "sha256", "sha384", "sha512", "md5:", "ssh-", "data:", "env:", "vault:", "ref:", "arn:", "file:", "ecdsa-")) or "://" in v:
        return True
    if re.fullmatch(r"(?:~|\.{1,2})?(?:/[a-z0-9_.\-]+)+/?", v) or re.fullmatch(r"[a-z_.\-]+(?:/[a-z_.\-]+)+", v):
        return True
    if "(" in v and not quoted:
        return True
    if not quoted and (_LOWER.fullmatch(v) or re.fullmatch(r"[a-z]+(?:_[a-z]+)+|[A-Z]+(?:_[A-Z]+)+|[A-Za-z]+", v)):
        # a bare word is a name, unless it mixes cases as passwords do
        return not re.fullmatch(r"(?=.*[A-Z].*[a-z].*[A-Z])[A-Za-z]{10,}", v) or randomness(v) < 0.7
    if _DOTTED.fullmatch(v) and sum(c.isdigit() for c in v) < 3:
        return True
    return v.replace(".", "").replace("_", "").isdigit() and len(v) < 8


#: Share of the reachable entropy that a value must have, what is added for short ones (over their length), and what the
#: place takes off: none, a key that may name a credential, one that surely does.
LEAST, SHORT, SHIFT = 0.72, 2.0, (0.0, 0.12, 0.36)


def limit(length: int, strength: int) -> float:
    """The entropy threshold, over what a random string of this length and alphabet reaches; the place only shifts it."""
    return LEAST + SHORT / length - SHIFT[min(strength, 2)]


def accepted(v: str, strength: int, quoted: bool) -> bool:
    """Whether a value in a place of that strength is a credential: no reference, and its entropy above the threshold."""
    if is_reference(v, quoted):
        return False
    spaced = re.search(r"\s", v)
    if spaced and (strength < 2 or len(v.split()) > 2):
        return False
    r = randomness(v)
    if r < limit(len(v), strength):
        return False
    if strength >= 2:
        return True
    if strength == 1:
        return len(v) >= 12 and (any(c.isdigit() for c in v) or r > 0.9)
    # elsewhere: long, of several kinds of characters, no hash, no identifier
    if len(v) < 20 or _HEX.fullmatch(v) or _UUID.fullmatch(v) or "/" in v and re.search(r"\.\w{2,4}$", v):
        return False
    kinds = any(c.islower() for c in v) + any(c.isupper() for c in v) + any(c.isdigit() for c in v)
    return kinds == 3 and re.fullmatch(r"[\w+/=.\-~]+", v) is not None and _DOTTED.fullmatch(v) is None


def wordy(v: str) -> float:
    """Share of v that is in words: three letters or more with a vowel. Names made of words have most of them there."""
    return sum(len(w) for w in _WORDS.findall(v) if len(w) > 2 and re.search(r"(?i)[aeiouy]", w)) / len(v)


def _line(text: str, a: int, b: int) -> tuple[int, int]:
    hi = text.find("\n", b)
    return text.rfind("\n", 0, a) + 1, len(text) if hi < 0 else hi


def _is_block(text: str, a: int, b: int) -> bool:
    """Whether it fills a line beside another such line: encoded data, no credential."""
    lo, hi = _line(text, a, b)
    if not _ENCODED.fullmatch(text, lo, hi):
        return False
    beside = [_line(text, x, x) for x in (lo - 1, hi + 1) if 0 <= x <= len(text)]
    return any(_ENCODED.fullmatch(text, x, y) for x, y in beside)


def long_tokens(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the long tokens of all lines that stand alone; of paths and URLs, their parts. No hashes, public keys, data."""
    for m in _LONG.finditer(text):
        a, b = m.span()
        while b > a and text[b - 1] in ".-~":  # closing punctuation
            b -= 1
        if b - a > DATA and "." not in text[a:b]:
            continue
        ahead = text[max(0, a - 60) : a]
        named = _NAMED.search(ahead)
        words = [w.lower() for part in _SPLIT.findall(named["name"]) for w in _CAMEL.split(part)] if named else []
        if _BEFORE_NONE.search(ahead) or words and (words[-1] in NOT_LAST or NOT_ANY.intersection(words)) or _is_block(text, a, b):
            continue
        if text[a] not in "/.~":
            yield a, b
        if "/" in text[a:b]:
            for part in re.finditer(r"[^/]{20,}", text[a:b]):
                if not re.search(r"\.\w{2,5}$", part[0]):
                    yield a + part.start(), a + part.end()


_PLACES = ((_INNER, None), (_TUPLE, None), (_ADD, None), (_PAIR, None), (_ELEMENT, None), (_HEADER, 1), (_ASSIGN, None), (_ENV, None), (_CALL, None), (_NETRC, 2), (_SLASHED, 2), (_SQL, 2), (_FLAG, 2), (_USERPW, 2), (_MYSQL, 2), (_URL, 2), (_DSN, 2), (_SCHEME, 1))
_CALLS = re.compile(r"(?i)(?:jwt\.(?:sign|encode|verify|decode)|basic_?auth|credentials?|login|setpassword|set_?secret|authenticate)$")


#: The places of credentials are sought in a line if it has one of CUES and one of these marks of code.
_CODE = re.compile(r"[=\"`<@+]|://|: ?[^ ]|['(] ?'|'[,)]|\b(?:ENV|ARG|export|machine|IDENTIFIED|sshpass|mysql\w*)\b|PASSWORD|\blogin ")


def _stretches(text: str, low: str) -> Iterator[tuple[int, int]]:
    """The lines that may have places of credentials, as (start, end); a line that ends in `>`, `|` or `+` takes the next one in."""
    a, n = 0, len(text)
    while a < n:
        b = text.find("\n", a)
        b = n if b < 0 else b
        if b - a > 5 and any(low.find(c, a, b) >= 0 for c in CUES) and _CODE.search(text, a, b):
            end = b
            while end < n and text[a:end].rstrip().endswith((">", "|", "+")):
                end = text.find("\n", end + 1)
                end = n if end < 0 else end
            yield a, end
        a = b + 1


def find_credentials(text: str | None) -> list[list[tuple[int, int]]]:
    """Each credential's spans [(start, end), ...] in characters; several spans where it is written in pieces."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(x := c.lower()) != 1 else x for c in text)
    out: list[list[tuple[int, int]]] = []
    closed: list[tuple[int, int]] = []  # stretches already judged
    if "-----BEGIN" in text:
        for m in _PEM.finditer(text):
            if m[1].endswith("PRIVATE KEY"):
                out.append([m.span()])
            closed.append(m.span())

    def take(a: int, b: int, strength: int, quoted: bool) -> None:
        if any(a < y and b > x for x, y in closed):
            return
        spans, value = [(a, b)], text[a:b]
        if quoted and text[b : b + 1] in ("\"", "'", "`"):
            at = b + 1
            while m := _MORE.match(text, at):
                spans.append(m.span("v"))
                value += m["v"]
                at = m.end()
        if accepted(value, strength, quoted):
            out.append(spans)
            closed.append((a, spans[-1][1]))

    for lo, hi in _stretches(text, low) if any(c in low for c in CUES) else ():
        for m in ISSUED.finditer(text, lo, hi):
            a, b = m.span()
            take(a, b, 2, text[b : b + 1] in ("\"", "'", "`"))
        for pattern, strength in _PLACES:
            for m in pattern.finditer(text, lo, hi):
                g = m.groupdict()
                which = "v" if g.get("v") is not None else "b"
                a, b = m.span(which)
                if a < 0 or a == b or g.get("call"):
                    continue
                if strength is not None:
                    s = strength
                elif pattern is _CALL:
                    s = 2 if _CALLS.search(g["name"]) else 0
                else:
                    s = name_strength(g["name"])
                if pattern is _TUPLE and s == 1:
                    s = 2  # the second of a pair: user and password
                if not s:
                    continue
                if which == "b":
                    if pattern is _ASSIGN and ": " in g["op"] and not any(c.isdigit() for c in text[a:b]) and len(text[b:hi].split()) > 2:
                        continue  # "the token: see below" in a sentence
                    while b > a and text[b - 1] in ".,;:)" and pattern not in (_URL, _DSN):  # closing punctuation
                        b -= 1
                    if a == b:
                        continue
                if pattern in (_ASSIGN, _HEADER, _PAIR) and (k := re.match(r"(?i)(?:bearer|basic|token|digest)[ \t]+", text[a:b])):
                    a += k.end()
                take(a, b, s, which == "v" or pattern in (_URL, _DSN, _USERPW, _MYSQL))
        for m in _STRING.finditer(text, lo, hi):
            take(*m.span("v"), 0, True)
        for m in _PIECE.finditer(text, lo, hi):
            take(*m.span(), 1, True)
    # in all lines, whatever stands around
    for m in _STRING.finditer(text):
        if wordy(m["v"]) < 0.6 and not _is_block(text, *m.span("v")):
            take(*m.span("v"), 0, True)
    for a, b in long_tokens(text):
        if wordy(text[a:b]) < 0.6:
            take(a, b, 0, False)
    return sorted(out)


def redact(text: str | None, found: list[list[tuple[int, int]]]) -> str | None:
    """The text with every value blanked; quotes, keys and code around stay. Later pieces become empty."""
    if not found:
        return text
    out, at = [], 0
    for a, b, first in sorted((a, b, i == 0) for spans in found for i, (a, b) in enumerate(spans)):
        out += (text[at:a], BLANK if first else "")
        at = b
    return "".join((*out, text[at:]))


def credentials(df: DataFrame, key: str = "seq", text: str = "text") -> DataFrame:
    """(key, start_char, end_char, pieces): one row per credential. One pass beside the scan, no shuffle.

    Null and empty texts have none. Repeated rows are each reported.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, s[0][0], s[-1][1], len(s)) for k, t in zip(b["k"], b["t"], strict=True) if isinstance(t, str) for s in find_credentials(t)]
            yield pd.DataFrame(rows, columns=["k", "start_char", "end_char", "pieces"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, start_char int, end_char int, pieces int").withColumnRenamed("k", key)


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """df with its credentials blanked in `text`; all else is unchanged."""

    @F.pandas_udf("string")
    def blank(t: pd.Series) -> pd.Series:
        return pd.Series([redact(x, find_credentials(x)) if isinstance(x, str) else None for x in t], dtype=object)

    return df.withColumn(text, blank(F.col(text)))
