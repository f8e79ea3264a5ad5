"""Languages of documents and of their stretches: known words first, then ever shorter character n-grams.

A word that the model knows is scored by its log frequency in each language; an unseen one by the longest n-grams of
its letters that are known. The model is fitted on a bounded sample of labelled documents (``FIT_DOCS``); as labels may
be wrong and documents mixed, its sentences are relabelled by the first model and counted again.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents the model is fitted on; it is applied to all.
FIT_DOCS = 3000
#: Longest n-grams of the backoff, their weight against a known word, and a word's largest influence (nats).
NGRAM, BACKOFF, LIMIT = 4, 0.35, 6.0
#: What a sentence's own language must be ahead of the document's main one (nats) to count as another.
AHEAD = 5.0
#: Words of a stretch without any punctuation that are judged together.
RUN = 14

# Names of the languages beside those of the table: ISO 639-2/3 codes, own names.
NAMES = {
    "de": "ger deu german deutsch", "en": "eng english englisch anglais inglés ingles inglese inglês", "es": "spa spanish español espanol castellano", "fr": "fre fra french français francais", "it": "ita italian italiano",
    "ja": "jpn jp japanese 日本語 nihongo", "nl": "dut nld dutch nederlands flemish vlaams", "pt": "por portuguese português portugues", "ru": "rus russian русский russkij",
}

_TOKEN = re.compile(r"[ぁ-ヿ㐀-鿿ｦ-ﾟ々ー]|(?:(?![ぁ-ヿ㐀-鿿ｦ-ﾟ々ー])[^\W\d_])+")
_CJK = re.compile(r"[ぁ-ヿ㐀-鿿]")
_DIGIT = re.compile(r"\d")
_LEAD = re.compile(r"[\s>*\-+•·#=|]*")
_ENDS = re.compile(r"[.!?…]+[\"'»”’)\]]*(?=\s|$)|[。！？]+[」』)]*")
_QUOTED = re.compile(r"\([^()\n]{1,40}\)|\"[^\"\n]{1,30}\"|[»«“„][^»«”“\n]{1,30}[«»”“]|`[^`\n]{1,60}`|<[^<>\n]{1,40}>|https?://\S+|\S+@\S+")


def label_code(label: str | None, codes: dict[str, str]) -> str | None:
    """The code that a label names in one of its usual spellings, or None. `codes` maps folded names to codes."""
    if not label or not label.strip():
        return None
    low = label.strip().lower()
    return codes.get(low) or codes.get(re.split(r"[\s_\-(/.;,]", low)[0])


def known_labels(languages: list[tuple[str, str]]) -> dict[str, str]:
    """Folded spelling -> code for (code, English name) rows."""
    out = {}
    for code, name in languages:
        for x in (code, name, *NAMES.get(code, "").split()):
            out[x.strip().lower()] = code
    return out


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the sentences: not of headings, listings, tables. Stretches without punctuation come in runs."""
    at, fenced = 0, False
    lines = text.split("\n")
    for no, line in enumerate(lines):
        start, at = at, at + len(line) + 1
        s = line.strip()
        if s.startswith("```"):
            fenced = not fenced
            continue
        if fenced or not s or s[0] == "|" or s.startswith(("#", "==")):
            continue
        if re.search(r"[{};]$|^[\w.\[\]'\"]+ ?=[^=]|^\W*$", s):
            continue
        bullet = _LEAD.match(line).end()
        ended = _ENDS.search(line)
        if not ended and bullet == 0 and len(s.split()) <= 9 and not _CJK.search(s) and (no == 0 or not lines[no - 1].strip()) and (no + 1 >= len(lines) or not lines[no + 1].strip()):
            continue  # a heading without a mark stands alone
        a = start + bullet
        for m in _ENDS.finditer(line, bullet):
            yield a, start + m.end()
            a = start + m.end()
        if text[a : start + len(line)].strip():
            # no punctuation: in runs of some words
            words = list(_TOKEN.finditer(text, a, start + len(line)))
            if len(words) <= RUN * 2 or _CJK.search(text, a, start + len(line)):
                yield a, start + len(line)
            else:
                for k in range(0, len(words), RUN):
                    last = k + 2 * RUN > len(words)
                    yield words[k].start(), start + len(line) if last else words[min(k + RUN, len(words)) - 1].end()
                    if last:
                        break


def tokens(text: str) -> list[str]:
    """Lower-cased words, quoted terms left out; of Chinese and Japanese signs each is one."""
    return _TOKEN.findall(_QUOTED.sub(" ", text).lower())


def grams(word: str) -> Iterator[tuple[int, list[str]]]:
    """(n, the n-grams of the bounded word), longest first."""
    w = f"<{word}>"
    for n in range(min(NGRAM, len(w)), 0, -1):
        yield n, [w[i : i + n] for i in range(len(w) - n + 1)]


class Model:
    """Scores of words and n-grams per language, as log frequency less the languages' mean, limited.

    Each distinct word is scored once per worker; `at` gives its row in `scores` and `seen`.
    """

    #: Distinct words a worker remembers before it begins anew.
    HELD = 200_000

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], ngrams: dict[str, np.ndarray]):
        self.langs, self.words, self.ngrams = langs, words, ngrams
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.scores, self.seen = np.zeros((1024, len(self.langs))), np.zeros(1024, np.int64)

    def __getstate__(self):
        return {"langs": self.langs, "words": self.words, "ngrams": self.ngrams}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def word(self, w: str) -> np.ndarray:
        if (v := self.words.get(w)) is not None:
            return v
        for n, gs in grams(w):
            hit = [self.ngrams[g] for g in gs if g in self.ngrams]
            if len(hit) * 2 >= len(gs):
                return np.mean(hit, 0) * BACKOFF * n / NGRAM
        return np.zeros(len(self.langs), np.float32)

    def knows(self, w: str) -> bool:
        """Whether the word or, of an unseen one, half of its n-grams of some length over one are in the tables."""
        return w in self.words or any(n > 1 and 2 * sum(g in self.ngrams for g in gs) >= len(gs) for n, gs in grams(w))

    def rows(self, ws: list[str]) -> np.ndarray:
        """The words' rows in `scores` and `seen`."""
        if len(self.at) > self.HELD:
            self._forget()
        at = self.at
        for w in ws:
            if w not in at:
                i = at[w] = len(at)
                if i == len(self.seen):
                    self.scores, self.seen = np.concatenate((self.scores, np.zeros_like(self.scores))), np.concatenate((self.seen, np.zeros_like(self.seen)))
                self.scores[i], self.seen[i] = self.word(w), self.knows(w)
        return np.fromiter(map(at.__getitem__, ws), np.int64, len(ws))

    def score(self, ws: list[str]) -> np.ndarray:
        rows = self.rows(ws)
        return self.scores[rows].sum(0)


def _table(counts: dict[str, Counter], langs: list[str], least: int) -> dict[str, np.ndarray]:
    total = {x: sum(counts[x].values()) + 1 for x in langs}
    seen: Counter = Counter()
    for x in langs:
        seen.update(counts[x])
    out = {}
    for w, n in seen.items():
        if n >= least:
            # half a sighting each: unseen in a language isn't impossible
            v = np.array([math.log((counts[x][w] + 0.5) / (total[x] + 0.5 * len(seen))) for x in langs])
            out[w] = np.clip(v - v.mean(), -LIMIT, LIMIT).astype(np.float32)
    return out


def count(units: list[tuple[list[str], str]], langs: list[str]) -> Model:
    """A model from (words, language)."""
    words: dict[str, Counter] = defaultdict(Counter)
    for ws, x in units:
        words[x].update(ws)
    chars: dict[str, Counter] = defaultdict(Counter)
    for x in langs:
        for w, n in words[x].items():
            for _, gs in grams(w):
                for g in gs:
                    chars[x][g] += n
    return Model(langs, _table(words, langs, 3), _table(chars, langs, 5))


def fit(documents: list[tuple[str, str]], langs: list[str], rounds: int = 2) -> Model:
    """A model from (text, code) whose codes may be wrong. Sentences a round's model is sure of are relabelled by it."""
    units = [(ws, x) for t, x in documents for a, b in sentences(t) if len(ws := tokens(t[a:b])) >= 3]
    model = count(units, langs)
    for _ in range(rounds):
        again = []
        for ws, _x in units:
            v = model.score(ws)
            order = np.sort(v)
            if order[-1] - order[-2] > 3:
                again.append((ws, langs[int(v.argmax())]))
        model = count(again, langs)
    return model


def judge(model: Model, text: str | None) -> list[tuple[int, int, str, float]]:
    """(start, end, language, confidence) of the sentences, those of one language in a row joined.

    The main language is the one of the whole text's score; a sentence is in another one only if that is clearly ahead.
    """
    if not text or not text.strip():
        return []
    spans, words = [], []
    some_asian = _CJK.search(text)
    for a, b in sentences(text):
        ws = tokens(text[a:b])
        asian = bool(some_asian and _CJK.search(text, a, b))
        if len(ws) >= (6 if asian else 3) and sum(map(len, ws)) >= 2 * len(_DIGIT.findall(text, a, b)):
            spans.append((a, b, asian))
            words.append(ws)
    if not spans:
        return []
    rows = model.rows([w for ws in words for w in ws])
    begins = np.cumsum([0, *map(len, words[:-1])])
    scores, known = np.add.reduceat(model.scores[rows], begins), np.add.reduceat(model.seen[rows], begins)
    # figures and codes that end like sentences aren't any: they have few letters, or none of any language's n-grams
    n = np.array([len(ws) for ws in words])
    good = np.flatnonzero(np.array([asian for *_, asian in spans]) | (known >= np.maximum(2, n // 4)))
    if not len(good):
        return []
    v, n = scores[good], n[good]
    each, own = np.arange(len(v)), v.argmax(1)
    main = int(np.bincount(own, n, len(model.langs)).argmax())
    own = np.where(v[each, own] - v[:, main] < AHEAD, main, own)
    e = np.exp(np.clip(v - v.max(1, keepdims=True), -60, 0))
    sure = e[each, own] / e.sum(1)
    out: list[list] = []
    for i, k, p in zip(good.tolist(), own.tolist(), sure.tolist(), strict=True):
        a, b, _ = spans[i]
        if out and out[-1][2] == k:
            out[-1][1] = b
            out[-1][3].append(p)
        else:
            out.append([a, b, k, [p]])
    return [(a, b, model.langs[k], round(float(np.mean(ps)), 4)) for a, b, k, ps in out]


def judge_words(model: Model, text: str | None) -> tuple[str, float] | None:
    """(language, confidence) of all words of a text in which no sentence was found; None if it has no word or none that the
    model knows anything of. Quoted terms count if there is nothing else."""
    if not text:
        return None
    for ws in (tokens(text), _TOKEN.findall(text.lower())):
        v = model.score(ws)
        if v.any():
            e = np.exp(np.clip(v - v.max(), -60, 0))
            return model.langs[int(v.argmax())], round(float(e.max() / e.sum()), 4)
    return None


def fitted(documents: DataFrame, languages: DataFrame, rows: int = FIT_DOCS) -> tuple[Model, dict[str, str]]:
    """(model, spellings of labels). The sample is about `rows` labelled documents by the hash of their id."""
    langs = sorted((r[0], r[1]) for r in languages.where("lang_code is not null").select("lang_code", "lang_name").distinct().collect())
    codes = known_labels(langs)
    usable = documents.where("length(text) > 0 and lang is not null")
    share = min(1.0, 1.2 * rows / max(1, documents.count()))
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).select("doc_id", "text", "lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = [(r["text"], c) for r in sample.collect() if (c := label_code(r["lang"], codes))]
    return fit(known, [c for c, _ in langs]), codes


def segments(documents: DataFrame, model: Model, codes: dict[str, str], every: bool = False) -> DataFrame:
    """(doc_id, label_lang, segment_no, start_char, end_char, lang, confidence): the stretches in one language.

    label_lang is the code the document's label names, or null. Null, blank and sentence-less texts have one row with
    null segment_no, lang and confidence 0; with `every`, that row of a text without sentence has the language of its words
    and goes from its beginning to its end. One pass beside the scan, no shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by FIT_DOCS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            rows = []
            for d, t, label in zip(b["doc_id"], b["text"], b["lang"], strict=True):
                code = label_code(label if isinstance(label, str) else None, codes)
                t = t if isinstance(t, str) else None
                found = [(i, *x) for i, x in enumerate(judge(m, t))]
                if not found and every and (of_words := judge_words(m, t)):
                    found = [(None, 0, len(t), *of_words)]
                rows += [(d, code, *x) for x in found] or [(d, code, None, None, None, None, 0.0)]
            out = pd.DataFrame(rows, columns=["doc_id", "label_lang", "segment_no", "start_char", "end_char", "lang", "confidence"])
            yield out.astype({c: "Int32" for c in ("segment_no", "start_char", "end_char")})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", "lang").mapInPandas(run, f"doc_id {kind}, label_lang string, segment_no int, start_char int, end_char int, lang string, confidence double")


def document_languages(found: DataFrame, every: bool = False) -> DataFrame:
    """(doc_id, lang, confidence, n_chars, label_lang): per document and language its stretches' length and confidence.

    With `every`, documents without a language are kept as one row: null, confidence 0, no characters.
    """
    n = F.coalesce(F.col("end_char") - F.col("start_char"), F.lit(0))
    rows = found if every else found.where("lang is not null")
    return rows.groupBy("doc_id", "label_lang", "lang").agg(F.coalesce(F.try_divide(F.sum(F.col("confidence") * n), F.sum(n)), F.lit(0.0)).alias("confidence"), F.sum(n).alias("n_chars"))


def wrong_labels(found: DataFrame) -> DataFrame:
    """(doc_id, lang) of the documents whose label is absent, names no language or another one, or that are mixed."""
    per = found.where("lang is not null").groupBy("doc_id", "label_lang").agg(F.collect_set("lang").alias("langs"))  # at most one entry per known language
    return per.where("label_lang is null or size(langs) > 1 or not array_contains(langs, label_lang)").select("doc_id", F.explode("langs").alias("lang"))
