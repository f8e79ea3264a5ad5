"""Personal information in free text: high-recall generators, boosted trees, calibrated thresholds.

Generators propose overlapping spans of five types. Each span is described by its format and its surroundings; boosted
trees, fitted on made-up labelled sentences, give it a score. In one pass over all texts every span is scored. How many
spans of a type are true differs from the sentences of the fit, so each type's prior is estimated from the scores of all
its spans in the corpus, scores are corrected by it, and the threshold is the one of the greatest expected F1. Spans above
their threshold are taken, the most probable first, and no two overlap. Parts of names beyond those given are learnt from
counts over all the texts themselves: a capitalised word that stands beside known parts as a name does.
"""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemoweave.llm.boosting import BoostedTrees, best_expected, prior_shift
from mnemoweave.session import checkpointed

TYPES = ("name", "email", "phone", "id_number", "address")
#: Entries that a task counts before it hands them on to be summed up.
HELD = 200_000

_A = "A-Za-z\u00c0-\u024f\u0370-\u03ff\u0400-\u04ff"  # letters of names: Latin, Greek, Cyrillic
_UP = "[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁЀ-Џ]"
_CAP = rf"(?:[OD]['’])?{_UP}[{_A}]+(?:-[{_A}]{{2,}})*"
_PARTICLE = r"(?:von|van|der|den|de|di|da|del|della|la|le|bin|ibn|al|el|du|dos|ter|zu|af|av)"
_TITLE = frozenset("dr dr. mr mr. mrs mrs. ms ms. mme mme. m. prof prof. herr frau señor señora sr. sra. sig. signor signora senhor senhora monsieur madame mevrouw meneer miss sir dame".split())
_W = rf"[{_A}]+(?:['’\-][{_A}]+)*"

# -- generators ---------------------------------------------------------------------------------------------------

_DOT = r"(?:\.|[ ]?[\[({][ ]?(?:dot|punkt|point|punto|ponto)[ ]?[\])}][ ]?|[ ]dot[ ])"
_AT = r"(?:[ ]?[@＠][ ]?|[ ]?[\[({<][ ]?(?:at|arroba|chez)[ ]?[\])}>][ ]?)"
_L = "A-Za-z0-9\u00c0-\u024f"
EMAIL = re.compile(rf"(?<![{_L}_.+%\-])[{_L}][{_L}_.+%\-]*{_AT}[{_L}](?:[{_L}_\-]*[{_L}])?(?:{_DOT}[{_L}](?:[{_L}_\-]*[{_L}])?)+", re.I)
SPELT = re.compile(rf"(?<![{_L}_.+%\-])[{_L}][{_L}_.+%\-]* at [{_L}][{_L}\-]*(?:(?: dot |\.)[{_L}][{_L}\-]*)* dot [{_L}]+", re.I)
# the class comes first and what mustn't stand before it behind: so the scan for a start is fast
DIGITS = re.compile(r"[+(\d](?:(?<![A-Za-z0-9_\u00c0-\u024f.,/+(\-].)|(?<=[=:;(>].))[+(]?\d?[\d() .\-/\u00a0]{5,}\d(?![A-Za-z0-9_\u00c0-\u024f]|-[A-Za-z])(?:,? ?(?:ext|x|Durchwahl|poste|int)\.? ?\d{1,5})?")
CODE = re.compile(r"(?=[A-Z0-9])(?<![A-Za-z0-9_\u00c0-\u024f\-/.+])(?:[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]|\d{7,9}-?[A-Z]|[A-Z]\d{7}[A-Z]|[A-Z]{1,2}\d{6,9}(?:<\d)?|\d{3}[ -]\d{2}[ -]\d{4}|\d{4} \d{4} \d{4}|\d{11}|\d{3}\.\d{3}\.\d{3}-\d{2}|[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z])(?![A-Za-z0-9_\u00c0-\u024f\-/]|[.]\d)")
# Words for kinds of streets.
_AFTER = r"(?:street|st|road|rd|avenue|ave|drive|lane|row|terrace|crescent|court|close|way|square|place|hill|gate|grove|gardens|mews|walk|parade|boulevard|wharf|green|rise|view|quay)"
_BEFORE = r"(?:c/|rue|boulevard|bd|avenue|av|quai|impasse|chemin|place|all[ée]e|cours|passage|route|square|sentier|calle|paseo|plaza|avenida|camino|ronda|carrer|via|viale|corso|piazza|vicolo|largo|rua|travessa|estrada|pra[çc]a|alameda|ул\.?|улица|проспект|пр\.?|переулок)"
# endings that other words have too (German and Dutch nouns are capitalised), and those that only streets have
_JOINED = (
    r"(?:(?-i:[A-ZÄÖÜ][^\W\d_A-ZÄÖÜ]{2,}(?:weg|platz|ufer|ring|damm|deich|steig|kade|plein|dijk|laan|singel))"
    r"|[^\W\d_]{3,}(?:stra(?:ß|ss)e|str\.|allee|gasse|straat|gracht))"
)
_PREP = r"(?:Am|An der|An den|Auf dem|Auf der|Hinter dem|Hinter der|Im|In der|In den|Unter den|Unter der|Zum|Zur|Vor dem|Op de|Aan de|Achter de)(?: [A-ZÄÖÜ][^\W\d_]+){1,2}"
_TOWN = rf"(?:[,\n] ?(?:\d{{5}} (?-i:{_CAP}(?: {_CAP})?)|[{_A}]+(?:[- ][{_A}]+){{0,3}} (?:\d{{5}}|[A-Z]{{1,2}}\d{{1,2}}[A-Z]? \d[A-Z]{{2}})\b))"
_NO = r"\d{1,4}(?:-\d{1,4})?(?: ?(?:bis|ter)\b| ?[a-zA-Z]\b(?!['’]))?"
STREET = re.compile(
    rf"(?<![\w.,/#\-])(?:{_NO},? {_BEFORE} {_W}(?: {_W}){{0,3}}|{_NO},? (?:{_W} ){{1,3}}{_AFTER}\b|\b{_BEFORE} {_W}(?: {_W}){{0,3}},? {_NO}(?: ?,? ?\d{{1,2}}[ºª°]? ?[A-Z]?\b)?|\b{_JOINED} {_NO}|\b(?:(?-i:(?:{_CAP} ){{1,2}})|[{_A}]{{5,}} )(?:Weg|Stra(?:ß|ss)e|Platz|Allee|Ring|Ufer|Gasse|Damm|Steig|Markt) {_NO}|\b{_PREP} {_NO})(?:,? (?:flat|apt|unit|apartment|suite)\.? ?\w{{1,5}})?{_TOWN}?",
    re.I,
)
_ANY_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}(?:/\d+)?")
_AT_SIGN = re.compile(r"[@＠]|[\[({<] ?(?:at|arroba|chez) ?[\])}>]", re.I)
# Where a street may be; the pattern is tried around these only
_STREET_WORDS = "c/ street st. road rd. avenue ave drive lane row terrace crescent court close way square place hill gate grove gardens mews walk parade boulevard wharf green rise view quay rue bd quai impasse chemin allée allee cours passage route sentier calle paseo plaza avenida camino ronda carrer via viale corso piazza vicolo largo rua travessa estrada praça praca alameda ул. улица проспект пр. переулок straße strasse str. weg gasse platz ufer ring damm deich steig straat laan gracht kade plein dijk singel".split() + ["am ", "an der ", "an den ", "auf dem ", "auf der ", "markt", "hinter dem ", "hinter der ", "im ", "in der ", "in den ", "unter den ", "unter der ", "zum ", "zur ", "vor dem ", "op de ", "aan de ", "achter de "]
_ENDINGS = frozenset("straße strasse str. weg gasse platz ufer ring damm deich steig straat laan gracht kade plein dijk singel allee".split())
_STREETS = ahocorasick.Automaton()
for _w in _STREET_WORDS:
    _STREETS.add_word(_w, (len(_w), _w in _ENDINGS, _w[-1].isalpha()))
_STREETS.make_automaton()
# beside the type word, the words of a street's name are capitalised or all alike lower; the classifier judges that
_REST = rf"(?:['’]{_UP})?[{_A}]+(?:-[{_A}]{{2,}})*"
PAIR = re.compile(rf"{_UP}(?<![{_A}0-9_@.\-].)(?:(?:{_REST}|\.?)(?:[ ][A-Z]\.)?(?:[ ]{_PARTICLE})?(?:,[ ]|[ ]){_CAP}(?![{_A}0-9_@])|{_REST},?[ ][A-Z]\.(?![\w]))")
WORD = re.compile(rf"[{_A}]\.|(?:[OoDd]['’])?{_W}")


def _edges(t: str, a: int, b: int) -> tuple[int, int]:
    while a < b and t[a] in " \u00a0.-/)":
        a += 1
    while a < b and t[b - 1] in " \u00a0.-/(":
        b -= 1
    return a, b


def digit_spans(t: str) -> Iterator[tuple[int, int]]:
    """Runs of digits and separators, cut where they can't go on (unbalanced brackets, slashes between numbers)."""
    for m in DIGITS.finditer(t):
        a, b = _edges(t, *m.span())
        if (k := t.find(" / ", a, b)) > 0:
            yield _edges(t, a, k)
            a, b = _edges(t, k + 3, b)
        if t[a:b].count("(") != t[a:b].count(")"):
            if t[a] == "(":
                a += 1
            elif (k := t.find("(", a, b)) > 0:
                b = k
        a, b = _edges(t, a, b)
        # what goes on behind a hyphen is a code
        if 7 <= sum(c.isdigit() for c in t[a:b]) and not (t[b : b + 1] == "-" and t[b + 1 : b + 2].isalnum()):
            yield a, b


class Lexicon:
    """Known parts of names, and how often words stand in lower case, per million words."""

    def __init__(self, given: set[str], family: set[str], common: dict[str, float]):
        self.given, self.family, self.common = given, family, common
        self.automaton = None

    def __getstate__(self):
        return {"given": self.given, "family": self.family, "common": self.common, "automaton": None}

    def hits(self, low: str) -> list[int]:
        """Ends of known parts in the lower-cased text."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for w in self.given | self.family:
                self.automaton.add_word(w, len(w))
            if self.given or self.family:
                self.automaton.make_automaton()
        if not (self.given or self.family):
            return []
        return [end + 1 - n for end, n in self.automaton.iter(low)]

    @staticmethod
    def core(w: str) -> str:
        w = w.lower().replace("’", "'")
        return w[2:] if w[:2] in ("o'", "d'") and len(w) > 4 else w

    def is_given(self, w: str) -> bool:
        c = self.core(w)
        return c in self.given or ("-" in c and all(p in self.given for p in c.split("-")))

    def is_family(self, w: str) -> bool:
        c = self.core(w)
        return c in self.family or ("-" in c and all(p in self.family for p in c.split("-")))


def name_spans(t: str, low: str, lex: Lexicon) -> list[tuple[int, int]]:
    """Pairs of capitalised words or initials, and pairs with a known part in any case."""
    out = {m.span() for m in PAIR.finditer(t) if WORD.match(t, m.start())[0].lower() not in _TITLE}
    seen = -1
    for at in lex.hits(low):
        if at < seen or (at and (low[at - 1].isalnum() or low[at - 1] in "@._")) and low[max(0, at - 2) : at] not in ("o'", "o’", "d'"):
            continue
        # the words around: up to three before and behind
        a, b = max(0, at - 36), min(len(t), at + 60)
        ws = [(a + m.start(), a + m.end()) for m in WORD.finditer(t[a:b])]
        k = next((i for i, (x, y) in enumerate(ws) if x <= at < y), None)
        if k is None:
            continue
        for i, j in ((k, k + 1), (k, k + 2), (k, k + 3), (k - 1, k), (k - 2, k), (k - 3, k)):
            if i < 0 or j >= len(ws) or (a and i == 0 and ws[0][0] == a):
                continue
            x, y = ws[i][0], ws[j][1]
            # given and family name are both capitalised or both not; titles are outside
            if t[x].isupper() != t[ws[j][0]].isupper() or t[x : ws[i][1]].lower() in _TITLE:
                continue
            gaps = [t[ws[n][1] : ws[n + 1][0]] for n in range(i, j)]
            if any(g not in (" ", ", ", "") for g in gaps) or gaps.count(", ") > 1 or "" in gaps:
                continue
            middle = [t[p:q] for p, q in ws[i + 1 : j]]
            if all(len(w.rstrip(".")) == 1 or re.fullmatch(_PARTICLE, w.lower()) for w in middle):
                out.add((x, y - 2 if t[y - 2 : y] in ("'s", "’s") else y))
    return sorted(out)


def windows(places: Iterator[tuple[int, int]], n: int, left: int, right: int) -> Iterator[tuple[int, int]]:
    """The stretches around the places, joined where they meet."""
    at, end = -1, -1
    for a, b in places:
        a, b = max(0, a - left), min(n, b + right)
        if a <= end:
            end = max(end, b)
        else:
            if end > 0:
                yield at, end
            at, end = a, b
    if end > 0:
        yield at, end


def _street_places(t: str, low: str) -> Iterator[tuple[int, int]]:
    """Where a word for streets stands as a word (or as the end of one) near a digit."""
    for end, (n, ending, letters) in _STREETS.iter(low):
        a, b = end + 1 - n, end + 1
        if letters and low[b : b + 1].isalpha() or not ending and a and low[a - 1].isalpha():
            continue
        if _ANY_DIGIT.search(t, max(0, a - 44), b + 44):
            yield a, b


def street_spans(t: str, low: str) -> Iterator[tuple[int, int]]:
    for a, b in windows(_street_places(t, low), len(t), 64, 64):
        for m in STREET.finditer(t, a, b):
            yield m.span()


def email_spans(t: str, low: str) -> Iterator[tuple[int, int]]:
    """Addresses, also those spelt out. The user part of a URL or connection string is none."""
    for a, b in windows((m.span() for m in _AT_SIGN.finditer(t)), len(t), 80, 100):
        for m in EMAIL.finditer(t, a, b):
            ahead = t[max(0, m.start() - 60) : m.start()]
            if not (ahead[-1:] in (":", "/") and "//" in re.split(r"[\s\"'<>()]", ahead)[-1]):
                yield m.span()
    if " at " in low and " dot " in low:
        for m in SPELT.finditer(t):
            yield m.span()


def candidates(t: str, lex: Lexicon) -> list[tuple[int, int, int]]:
    """(start, end, type) of everything that could be personal; overlaps are allowed."""
    low = t.lower()
    if len(low) != len(t):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in t)
    out = [(a, b, 1) for a, b in email_spans(t, low)]
    mails = [(a, b) for a, b, _ in out]
    out += [(a, b, 0) for a, b in name_spans(t, low, lex) if all(b <= x or a >= y for x, y in mails)]
    if _ANY_DIGIT.search(t):
        out += [(a, b, 2) for a, b in digit_spans(t) if not _IP.fullmatch(t, a, b)]
        out += [(*m.span(), 3) for m in CODE.finditer(t)]
        out += [(a, b, 4) for a, b in street_spans(t, low)]
    return out


# -- features -----------------------------------------------------------------------------------------------------

# Words that announce, in nine languages. The labelled sentences are made of the same lists.
PHONE_WORDS = (
    "tel tel. phone telephone fax mobile cell call dial text sms whatsapp ring telefon handy mobil ruf anrufen numéro téléphone "
    "appelle appelez portable teléfono móvil llama llámame telefono cellulare chiama chiamami telefone telemóvel liga bel "
    "telefoonnummer bereikbaar телефон звоните звони номер"
).split()
ID_WORDS = (
    "ssn|social security|social security number|passport|passeport|pasaporte|passaporto|passaporte|paspoort|reisepass|id card|"
    "identity card|national id|citizen id|national insurance|taxpayer|taxpayer number|tax id|tax number|steuer-id|steuernummer|"
    "personalausweis|ausweis|driver's license|driver's licence|driving licence|license no|licence no|dni|nie|nif|cpf|cnp|nir|bsn|"
    "burgerservicenummer|codice fiscale|carta d'identità|carte d'identité|sécurité sociale|numéro fiscal|cartão de cidadão|"
    "bilhete de identidade|número fiscal|инн|снилс|паспорт|удостоверение"
).split("|")
ADDRESS_WORDS = (
    "address|addr|live at|lives at|lived at|deliver to|delivery|ship to|moved to|home|anschrift|adresse|wohne|wohnen|wohnhaft|"
    "lieferung|habite|livraison|vivo en|domicilio|dirección|abito in|indirizzo|consegna|moro na|entrega|morada|woon op|adres|"
    "bezorgen|адрес|живу|доставка"
).split("|")
THING_WORDS = (
    "row run version isbn issn order ticket item build invoice serial part port page chapter section figure issue commit checksum "
    "index release ratio uuid ip host approval tracking epoch timestamp sku model ref batch lot case revision step job record "
    "article product shipment zeile bestellung rechnung artikel kapitel ligne commande facture chapitre pedido factura capítulo "
    "ordine fattura capitolo encomenda fatura regel bestelling factuur hoofdstuk заказ версия глава"
).split()
_END = r"(?![^\W_])"
_PHONE_CUE = re.compile(rf"(?i)\b(?:{'|'.join(map(re.escape, PHONE_WORDS))}){_END}|電話")
_ID_CUE = re.compile(rf"(?i)\b(?:{'|'.join(map(re.escape, ID_WORDS))}|burger\w*nummer|паспорт\w*|удостоверени\w*){_END}|マイナンバー|パスポート|旅券|免許証|身分証")
_ADDRESS_CUE = re.compile(
    rf"(?i)\b(?:{'|'.join(map(re.escape, ADDRESS_WORDS))}|live[sd]?|deliver|ship|moved?|vivo|envía\w*|abito|moro|woon){_END}|住所|住んで|送って|届け"
)
# a thing's name, perhaps with a word for numbers and a verb, right before the span
_NUMBER = r"(?:numbers?|no|nr|id|code|value|key)"
_THING_CUE = re.compile(rf"(?i)(?:\b(?:{'|'.join(map(re.escape, THING_WORDS))})|\bsha\w*)(?:[ ]{_NUMBER}\b)?\.?(?:[ ]?[#:=]|[ ](?:is|was|of|ist|est|es|é))?[ ]?[\w\-.]{{0,3}}$")
_NUMBER_CUE = re.compile(rf"(?i)\b{_NUMBER}\.?(?:[ ]?[#:=]|[ ](?:is|was))?[ ]?$")
_NAME_CUE = re.compile(
    r"(?i)(?:name(?: is|:|=|\"\s*:)|\bnamed?\b|sister|brother|colleague|neighbou?r|thanks to|with|according to|signed|regards,|by|hired|"
    r"from:|cc:?|hi,|both|and|met|ask|dear|—|–|\bmit\b|von|avec|par|di|de|от)\s*[\"“«(]?\s*$"
)
_COUNTED = re.compile(rf" [{_A}]+(?<![A-Z])")  # a word in lower case follows, as it does a count of things
_SSN = re.compile(r"\d{3}[ -]\d{2}[ -]\d{4}")
_DATE = re.compile(r"(?:19|20)\d\d[-/.]\d\d?[-/.]\d\d?|\d\d?[-/.]\d\d?[-/.](?:19|20)\d\d")
_PHONE_SHAPE = re.compile(r"\+\d{1,3}[ .-]?\(?\d.*|\+\d{8,15}|00\d.*|\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}.*|0\d{1,4}[ /.-]\d.*|0\d(?:[ .]\d\d){4}|\(0\d+\).*|(?:\d\d[ .]){4}\d\d")
_ID_SHAPE = re.compile(r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]|[A-Z]{1,2}\d{6,9}(?:<\d)?|\d{7,8}-?[A-Z]|[A-Z]\d{7}[A-Z]|\d{3}\.\d{3}\.\d{3}-\d{2}|[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z]")
_DOMAIN = re.compile(r"(?i)[^\W\d_]{2,}$")
_FILE = re.compile(r"(?i)\.(?:png|jpe?g|gif|svg|js|ts|py|json|ya?ml|md|txt|css|html|git|whl|zip|tgz)$")


def features(t: str, a: int, b: int, kind: int, lex: Lexicon) -> list[float]:
    """Format and surroundings of a span."""
    s = t[a:b]
    before, after = t[max(0, a - 44) : a], t[b : b + 24]
    line = before[before.rfind("\n") + 1 :]
    near = line[-26:]
    x = [0.0] * 44
    x[0] = kind
    digits = sum(c.isdigit() for c in s)
    if kind in (2, 3):
        x[1] = digits
        x[2] = s[0] == "+" or s.startswith("00")
        x[3] = s[0] == "("
        x[4] = sum(not c.isalnum() for c in s)
        x[5] = bool(_PHONE_SHAPE.fullmatch(s))
        x[6] = bool(_ID_SHAPE.fullmatch(s))
        x[7] = bool(_SSN.fullmatch(s))
        x[8] = bool(_IP.fullmatch(s)) or bool(_DATE.match(s))
        x[9] = bool(re.search(r"ext|x ?\d", s))
        x[10] = len(re.findall(r"\d+", s))
        x[11] = any(c.isalpha() for c in s)
        x[12] = "/" in s
        x[43] = s.isdigit()
    if kind in (2, 3, 4):
        cues = [(m.end(), k) for k, p in enumerate((_PHONE_CUE, _ID_CUE, _ADDRESS_CUE)) for m in p.finditer(before)]
        last = max(cues, default=(0, -1))
        close = len(before) - last[0] <= 13
        x[13] = last[1] == 0 and close
        x[14] = last[1] == 1 and close
        x[15] = last[1] == 2
        x[16] = any(k == 1 for _, k in cues)
        x[17] = any(k == 0 for _, k in cues)
        x[18] = len(before) - last[0] if cues else 99
        x[19] = bool(_THING_CUE.search(near))
        x[20] = bool(_NUMBER_CUE.search(near))
    if kind == 4:
        words = WORD.findall(s)
        x[21] = s[0].isdigit()
        x[22] = sum(w[0].isupper() for w in words)
        x[23] = len(words)
        x[24] = bool(re.search(r"\d{5}", s))
        x[25] = bool(re.search(rf"(?i)\b{_BEFORE}\b|{_JOINED}|^{_PREP}", s))
        x[26] = words[-1][0].isupper() if words else 0
        x[27] = max((lex.common.get(w.lower(), 0.0) for w in words), default=0)
        x[29] = lex.common.get(words[0].lower(), 0.0) if words else 0
        x[30] = bool(_COUNTED.match(after)) and s[-1].isdigit()
        x[31] = bool(re.match(r"\w+ing \d", s))
        x[28] = bool(re.search(rf"(?i)\b{_AFTER}$", s.split(",")[0].rstrip()))
    if kind == 1:
        local, _, domain = (s.partition("@") if "@" in s else s.partition("＠"))
        x[29] = "@" in s or "＠" in s
        x[30] = bool(_DOMAIN.search(s))
        x[31] = bool(_FILE.search(s))
        x[32] = "://" in before[-40:].split(" ")[-1] or (":" in before[-1:] and "mailto" not in before and "=" not in before[-2:] and not before[-2:-1].isspace() and before[-1:] == ":" and "://" in before)
        x[33] = bool(re.search(r"[@/]$", before)) or after[:1] == ":" and after[1:2].isalnum()
        x[34] = " at " in s.lower() and not re.search(r"(?i) dot |[\[(]", s)
        x[35] = sum(c.isdigit() for c in domain) > 0
        x[36] = local.strip().lower() in ("git", "svc", "root", "admin")
    if kind == 0:
        ws = [w for w in WORD.findall(s)]
        comma = "," in s
        first, last = (ws[-1], ws[0]) if comma else (ws[0], ws[-1])
        if comma and len(ws) > 2:
            first = ws[1]
        x[1], x[2] = first[0].isupper(), last[0].isupper()
        x[3] = first.isupper() != last.isupper()
        x[21] = comma
        x[22] = lex.is_given(first)
        x[23] = lex.is_family(last)
        x[24] = lex.is_given(last) + 2 * lex.is_family(first)
        x[25] = len(first.rstrip(".")) == 1
        x[26] = len(last.rstrip(".")) == 1
        x[27] = sum(w[0].isupper() for w in ws) / len(ws)
        x[28] = s.isupper()
        x[29] = len(ws)
        x[30] = np.log1p(lex.common.get(first.lower(), 0.0))
        x[31] = np.log1p(lex.common.get(last.lower(), 0.0))
        x[32] = bool(_NAME_CUE.search(before))
        x[33] = (line.split() or [""])[-1].lower().strip("(\"") in _TITLE
        x[34] = not line.strip("¿¡ \"'(*->") or line.rstrip("¿¡ ")[-1:] in ".!?"
        x[35] = after[:1] == " " and after[1:2].isupper()
        x[36] = before[-1:] == " " and bool(re.search(r"[A-Z][^\W\d_]+ $", before))
        x[37] = after[:2] in ("'s", "’s")
        x[38] = max(len(first), len(last))
        x[39] = bool(re.match(rf"(?i){_AFTER}$|{_BEFORE}$", last)) or bool(re.match(rf"(?i){_BEFORE}$", first))
    x[40] = before[-1:] in ("/", "_", "=", "-", "#", "@", "\\")
    x[41] = ";" in before[-2:] and after[:1] == ";"
    x[42] = bool(re.search(r"[{};=<>]|\b(?:def|return|import|const|var)\b", line)) and not re.search(r"[a-z]=[\"']?$", line)
    return x


# -- the labelled sample ------------------------------------------------------------------------------------------

# Places without any word that announces, and for names places beside a word.
_BARE = ("({})", "{}", "\n{}\n", "> {}", "k;7;{};z", "x | {} | y", "{} · w", "– {}", "\"{}\"", "v={}")
_NAME_PLACES = (
    "My name is {}.", "by {}", "{} wrote", "Dr. {} said", "Mrs {} came", "dear {},", "with {} and", "Regards,\n{}\n", "Name: {}", "from: {}",
    "von {}", "par {}", "de {}", "di {}", "met {}", "cc: {}", "{}, {w}", "— {}", "{} has it", "{} hat es", "{} a dit", "{} dijo", "by={}", "author={}; x=2", "name=\"{}\"",
)
_MAIL_PLACES = ("mail {}", "write to {}", "mailto:{}", "<{}>", "e-mail: {}", "to={}", "login {}")
_MAIL_NOT = ("postgres://app:{}", "git clone {}", "https://svc:{}/v2", "redis://x:{}:6379", "npm i @team/{}", "docker pull reg/{}")
_LINKS = (" ", ": ", " is ", " no. ", " # ", " (", "=", " nr. ", " ist ", " est ", " es ", ":")


def _shape(rng: random.Random, pattern: str) -> str:
    """9 becomes a digit, A a letter."""
    return "".join(rng.choice("0123456789") if c == "9" else rng.choice("ABCDEFGHJKLMNPRSTUVWXYZ") if c == "A" else c for c in pattern)


def _made_name(rng: random.Random, lex_given: list[str], lex_family: list[str]) -> str:
    g, f = rng.choice(lex_given), rng.choice(lex_family)
    if rng.random() < 0.1:
        g += "-" + rng.choice(lex_given)
    form = rng.random()
    if form < 0.5:
        s = f"{g} {f}"
    elif form < 0.6:
        s = f"{g[0]}. {f}"
    elif form < 0.7:
        s = f"{g} {rng.choice('ABDFKM')}. {f}"
    elif form < 0.8:
        s = f"{f}, {g}"
    elif form < 0.9:
        s = f"{g} {rng.choice(('von', 'van', 'bin', 'de'))} {f}"
    elif form < 0.95:
        s = f"{g} {f[0]}."
    else:
        s = f"{f} {g}"
    return rng.choice((s, s, s, s.upper(), s.lower())) if "." not in s else s


PHONES = (
    "+9 999 999 9999", "+99 99 9999 9999", "(999) 999-9999", "999-999-9999", "999.999.9999", "999 999 9999", "099 9999 9999",
    "+19999999999", "09.99.99.99.99", "+33 9 99 99 99 99", "099/99999-999", "+99 99 99999 999", "+44 (0)99 9999 9999",
    "009-999-999-9999", "999 999 9999 ext. 999", "099 999 99 99", "09 99 99 99 99",
)
IDS = (
    "999 99 9999", "999-99-9999", "AA 99 99 99 A", "A99999999", "AA999999<9", "99999999A", "99999999-A", "9999 9999 9999",
    "AA999999", "A9999999", "999.999.999-99", "99999999999",
)
NUMBERS = (
    "999 99 9999", "10.99.99.9999", "979-9-9999-999-9", "2099-10-9999", "9999 9999 9999 9999", "999.999.9999", "999-99-999999",
    "10.0.99.9", "2024-09-19", "99999999", "999999999999", "999-99-9999", "1799999999", "9999-99-9999", "999-999-9999", "999 999 999",
)
_STREETS_LIKE = (
    "{n} {W} {A}", "{n} {W} {W} {A}", "{n}, {b} de {W}", "{b} {W}, {n}", "{b} de la {W}, {n}, 4º B", "{J} {n}", "Am {W} {n}",
    "{n} bis {b} du {W}", "{n} {w} {w} {a}", "{n} {W} {A}, 99999 Town", "Hinter dem {W} {n}", "{n} {b} {W}, 99999 Town",
    "{W} Weg {n} c", "{J} {n} c", "{j} {n}", "{n} {W} {A}, Town 99999", "{n} {w} {a}, flat {n}a",
)
_NO_STREETS = (
    "{n} {w} {w} {a}", "{n} {w} {a}", "{n} old {w} row", "the {w} way {n}", "place the {w} {n}", "via {w} {n}", "de {w} {w} {n}",
    "{E} {n}", "{E} {n}", "{b} de {w} {w} {n}", "{w} {b} {n}", "{n} {b} {w}", "am {W} {n}",
)


def labelled_sample(given: list[str], family: list[str], common: dict[str, float], rows: int = 8000, seed: int = 11) -> list[tuple[str, int, int, int, int]]:
    """(text, start, end, type, label): a span in a made-up sentence.

    Places are made by rule from the lists of announcing words; what stands around are frequent words of the corpus, before
    and behind true and false spans alike.
    """
    rng = random.Random(seed)
    usual = sorted(common, key=lambda w: (-common[w], w))[:300] or ["the"]
    longer = [w for w in usual if len(w) > 3] or ["some"]
    # words of the corpus that end like German streets but stand in lower case there
    alike = sorted(w for w in common if re.search(r"(?:ring|weg|platz|ufer|damm|deich|steig|laan|plein)$", w))[:200]
    alike += ["during", "spring", "bring", "string"] + [rng.choice(longer).rstrip("e") + "ring" for _ in range(8)]
    cap = [w.capitalize() for w in longer]
    made = ["".join(rng.choice(("ba", "ren", "lu", "tor", "vik", "sel", "mo", "dar", "ash", "quil")) for _ in range(3)).capitalize() for _ in range(60)]
    after = ["Street", "Road", "Lane", "Drive", "Terrace", "Row", "Avenue", "Crescent", "Court", "Way", "Close"]
    ahead = ["rue", "calle", "boulevard", "avenida", "plaza", "via", "rua", "quai", "impasse", "paseo", "passage", "place"]
    endings = ("straße", "allee", "weg", "gasse", "ring", "platz", "straat", "laan")

    def street(patterns: tuple) -> str:
        w = rng.choice(usual if patterns is not _NO_STREETS or rng.random() < 0.5 else made).lower()
        n = rng.randrange(1, 200)
        return _shape(
            rng,
            rng.choice(patterns).format(
                n=n if rng.random() < 0.8 else f"{n}b", W=rng.choice(made), w=w, A=rng.choice(after), a=rng.choice(after).lower(), b=rng.choice(ahead),
                J=rng.choice(made) + rng.choice(endings), j=rng.choice(made).lower() + rng.choice(("straße", "gasse", "straat")), E=rng.choice(alike).capitalize(),
            ),
        )

    def words(n: int) -> str:
        return " ".join(rng.choice(usual) for _ in range(n)).capitalize()

    def other_pair() -> str:
        c, m, g, u = rng.choice(cap), rng.choice(made), rng.choice(given), rng.choice(usual)
        joins = rng.choice(("zu", "von", "de", "van", "el", "la", "des", "der"))
        return rng.choice(
            (
                f"{c} {m}", f"{m} {rng.choice(made)}", f"{c} {rng.choice(cap)}", f"{c}, {m}", f"{g} {u}", f"{u} {g}", f"{rng.choice(family)} {u}",
                f"{c} {g}", f"{u}, {g}", f"{u} {rng.choice(usual)}".upper(), f"{u.upper()} {_shape(rng, 'AAA')}", f"{rng.choice('ABCDE')} {m}",
                f"{m} {rng.choice('ABCDE')}.", f"{u} {rng.choice('ABQX')}. {rng.choice(family)}", f"{rng.choice(family)} {c}", f"{rng.choice(cap + made)} {joins} {rng.choice(made + family)}", f"{u} {joins} {g}",
            )
        )

    def mail(label: int) -> str:
        local, h = rng.choice(("anna.b", "x_12", "jo-lee", "b.c+bot", "zed9")), rng.choice(("mail.example", "post.example.org", "relay.test", "bücherei.example", "a-b.c.test"))
        if label:
            return rng.choice((f"{local}@{h}", f"{local}＠{h}", f"{local} @ {h}", f"{local} [at] {h.replace('.', ' [dot] ')}", f"{local}(at){h}", f"{local}@{h}".upper()))
        return rng.choice((f"pw{rng.randrange(9)}@{h}", f"user@v{rng.randrange(9)}.2", f"core@{rng.randrange(9)}.2.1", "img@2x.png", f"look at {rng.choice(usual)}.{rng.choice(usual)}"))

    def announced(by: list[str]) -> str:
        w, link = rng.choice(by), rng.choice(_LINKS)
        return (w if rng.random() < 0.6 else w.capitalize()) + link + "{}" + (")" if "(" in link else "")

    out = []
    for i in range(rows):
        kind, label = i % 5, int(rng.random() < 0.5)
        bare = rng.random() < 0.4
        if kind == 0:
            s = _made_name(rng, given, family) if label else other_pair()
            place = rng.choice(_BARE if bare else _NAME_PLACES)
        elif kind == 1:
            s = mail(label)
            place = rng.choice(_MAIL_NOT) if not label and not s.startswith(("img", "look")) else rng.choice(_BARE if bare else _MAIL_PLACES)
        elif kind == 2:
            odd = rng.random() < 0.25  # a person's number where a phone's is expected
            s = _shape(rng, rng.choice(PHONES if label or not bare and rng.random() < 0.3 else IDS if odd else NUMBERS))
            place = announced(PHONE_WORDS) if label and not bare else announced(ID_WORDS) if not label and (odd or rng.random() < 0.2) else announced(THING_WORDS) if not label and rng.random() < 0.6 else rng.choice(_BARE)
            if not label and place in _BARE:  # without any word, only numbers that have no phone's shape are surely none
                s = _shape(rng, rng.choice(("99999999", "1799999999", "10.99.99.9999", "2024-09-19", "9999-99-9999", "999-99-999999", "999 99 9999")))
        elif kind == 3:
            odd = rng.random() < 0.25
            s = _shape(rng, rng.choice(IDS if label or rng.random() < 0.5 else PHONES if odd else NUMBERS))
            place = announced(ID_WORDS) if label else announced(PHONE_WORDS) if odd else announced(THING_WORDS) if rng.random() < 0.6 else rng.choice(_BARE)
            if label and bare and rng.random() < 0.15:
                s, place = _shape(rng, rng.choice(("999-99-9999", "AA 99 99 99 A", "AA999999<9"))), rng.choice(_BARE)
            elif label and rng.random() < 0.1:  # behind other data of the card
                place = announced(ID_WORDS).replace("{}", f"{_made_name(rng, given, family)} / {{}}")
        else:
            titled = not label and rng.random() < 0.4  # a street's form behind the name of a thing
            s = street(_STREETS_LIKE if label or titled else _NO_STREETS)
            place = announced(THING_WORDS) if titled else announced(ADDRESS_WORDS) if label and not bare else rng.choice(_BARE) if label or rng.random() < 0.3 else "{}"
            if label and rng.random() < 0.15:
                place = f"{_made_name(rng, given, family)}, {{}}"
        place = place.replace("{w}", rng.choice(usual))
        head = words(rng.randrange(2, 7)) + rng.choice((". ", "! ", ".\n", ".\n\n", " ", ", ")) if rng.random() < 0.8 else ""
        # the next sentence may follow without a mark
        tail = rng.choice((". ", ", ", " ", " ")) if "\n" not in place else " "
        tail += (words(4) if rng.random() < 0.4 else words(4).lower()) + "."
        a = len(head) + place.index("{}")
        out.append((head + place.replace("{}", s) + tail, a, a + len(s), kind, label))
    return out


# -- fit and use --------------------------------------------------------------------------------------------------


_PLAIN = re.compile(rf"(?<![\w@.\-]){_W}(?![\w@])")
#: A word is kept as a usual one if it has this share of all words (and three sightings): at most 1 / SHARE words.
SHARE = 2e-6


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(a, b, n): how often each word in lower case stands in all texts (b null), and each pair (given, family) of capitalised
    ones. Counted beside the scan, so only the tables of words are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        pairs: Counter = Counter()

        def counted() -> pd.DataFrame:
            rows = [(w, None, n) for w, n in words.items() if w.islower()] + [(a, b, n) for (a, b), n in pairs.items()]
            words.clear()
            pairs.clear()
            return pd.DataFrame(rows, columns=["a", "b", "n"])

        for batch in batches:
            for t in batch["t"]:
                words.update(_PLAIN.findall(t))
                for s in PAIR.findall(t):
                    ws = [w for w in WORD.findall(s) if len(w) > 2]
                    if len(ws) == 2 and not s.isupper():
                        pairs[(ws[1], ws[0]) if "," in s else (ws[0], ws[1])] += 1
                if len(words) + len(pairs) > HELD:
                    yield counted()
        yield counted()

    found = texts.where(F.length(text) > 0).select(F.col(text).alias("t")).mapInPandas(run, "a string, b string, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def beside_known(pairs: DataFrame, lex: Lexicon) -> DataFrame:
    """(side, part, partners, n): of the parts that aren't known, beside how many known ones they stand and how often."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for g, f, n in zip(batch["a"], batch["b"], batch["n"], strict=True):
                if lex.is_family(f) and not lex.is_given(g):
                    rows += [("given", p, lex.core(f), n) for p in lex.core(g).split("-")]
                if lex.is_given(g) and not lex.is_family(f):
                    rows.append(("family", lex.core(f), lex.core(g), n))
            yield pd.DataFrame(rows, columns=["side", "part", "partner", "n"])

    found = pairs.mapInPandas(run, "side string, part string, partner string, n long")
    return (
        found.groupBy("side", "part", "partner").agg(F.sum("n").alias("n"))
        .groupBy("side", "part").agg(F.count("*").alias("partners"), F.sum("n").alias("n"))
    )


def learn_lexicon(counts: DataFrame, given: set[str], family: set[str], rounds: int = 3) -> Lexicon:
    """Known parts and those that stand beside them: capitalised, seldom in lower case, with several partners.

    Sightings in lower case are held against sightings beside known parts: both grow with the corpus, partners don't. Usual
    words come to the driver with their share of all words, those above ``SHARE`` only, so they are bounded.
    """
    counts = checkpointed(counts)
    words = counts.where("b is null").select(F.col("a").alias("part"), F.col("n").alias("low"))
    pairs = counts.where("b is not null")
    total = words.agg(F.sum("low")).first()[0] or 0
    usual = words.where(F.col("low") >= max(3, int(total * SHARE))).collect()
    lex = Lexicon({g.lower() for g in given}, {f.lower() for f in family}, {r[0]: 1e6 * r[1] / total for r in usual})
    for _ in range(rounds):
        good = beside_known(pairs, lex).where("partners >= 2 and length(part) > 2").join(words, "part", "left").where("coalesce(low, 0) <= 3 * n")
        rows = good.select("side", "part").collect()  # only new parts
        new_g, new_f = ({p for s, p in rows if s == side and p not in _TITLE} for side in ("given", "family"))
        new_g, new_f = new_g - lex.given, new_f - lex.family
        # a word that stands in both places is no part of a name, but part of something else
        lex.given |= new_g - new_f
        lex.family |= new_f - new_g
        if not new_g and not new_f:
            break
    return lex


class Detector:
    """A fitted model: lexicon and trees. `prior` is the share of true spans in the rows it was calibrated on."""

    def __init__(self, lexicon: Lexicon, trees: BoostedTrees, prior: list[float]):
        self.lexicon, self.trees, self.prior = lexicon, trees, prior

    def score_all(self, texts: list[str | None]) -> list[list[tuple[int, int, int, float]]]:
        """Per text every candidate (start, end, type number, score)."""
        rows, x = [], []
        for i, t in enumerate(texts):
            if t:
                for a, b, kind in candidates(t, self.lexicon):
                    rows.append((i, a, b, kind))
                    x.append(features(t, a, b, kind, self.lexicon))
        out: list[list] = [[] for _ in texts]
        if rows:
            for (i, a, b, kind), q in zip(rows, self.trees.probability(np.array(x, np.float32)), strict=True):
                out[i].append((a, b, kind, round(float(q), 4)))
        return out


def chosen(spans: list[tuple[int, int, int, float]], thresholds: list[float]) -> list[tuple[int, int, str, float]]:
    """The spans above their type's threshold, the most probable first, without overlaps; in order."""
    good = sorted((-round(q, 1), a - b, -q, a, b, kind) for a, b, kind, q in spans if q >= thresholds[kind])
    taken: list = []
    for _, _, q, a, b, kind in good:
        if all(b <= y or a >= z for y, z, *_ in taken):
            taken.append((a, b, TYPES[kind], -q))
    return sorted(taken)


def fit(lex: Lexicon, sample: int = 8000) -> Detector:
    """Trees from the made-up sample; a third of it is held out for calibration.

    A twelfth of the names in the sample are unknown to the lexicon that describes them, so the trees don't lean on it alone.
    """
    g = sorted(w.capitalize() for w in lex.given) or ["Ann"]
    f = sorted("-".join(p.capitalize() for p in w.split("-")) for w in lex.family) or ["Lee"]
    rows = labelled_sample(g, f, lex.common, sample)
    hidden = Lexicon({w for i, w in enumerate(sorted(lex.given)) if i % 12}, {w for i, w in enumerate(sorted(lex.family)) if i % 12}, lex.common)
    x = np.array([features(t, a, b, k, hidden) for t, a, b, k, _ in rows], np.float32)
    y, kind = np.array([r[4] for r in rows]), np.array([r[3] for r in rows])
    held = np.arange(len(rows)) % 3 == 0
    trees = BoostedTrees().fit(x[~held], y[~held]).calibrate(x[held], y[held])
    return Detector(lex, trees, [float(y[held][kind[held] == k].mean()) for k in range(len(TYPES))])


def fitted(texts: DataFrame, name_parts: DataFrame, text: str = "text") -> Detector:
    """A detector for a corpus; its lexicon is learnt from all the texts."""
    parts = name_parts.where("name_part is not null").select("part_kind", "name_part").collect()
    given, family = ({r[1] for r in parts if r[0] == k} for k in ("given", "family"))
    return fit(learn_lexicon(word_counts(texts, text), given, family))


#: Steps of a score in the table that the thresholds are set by.
STEPS = 1000


def thresholds_of(histogram: dict[tuple[int, int], int], prior: list[float]) -> list[float]:
    """Per type the threshold of greatest expected F1, from counts of (type, step of the score) over the whole corpus."""
    out = []
    for k in range(len(TYPES)):
        n = np.array([histogram.get((k, s), 0) for s in range(STEPS + 1)], float)
        out.append(best_expected(n, prior_shift(n, prior[k])) if n.sum() else 0.5)
    return out


def scored(rows: DataFrame, detector: Detector) -> DataFrame:
    """rows with ``spans``, every candidate of `text` with its type and score. One pass, no shuffle. Other columns stay."""
    shared = rows.sparkSession.sparkContext.broadcast(detector)  # words and parts of names, trees

    @F.pandas_udf("array<struct<a:int,b:int,kind:int,score:double>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        d = shared.value
        for t in batches:
            out = []
            for lo in range(0, len(t), 2000):
                out += d.score_all([x if isinstance(x, str) else None for x in t.iloc[lo : lo + 2000]])
            yield pd.Series([[{"a": a, "b": b, "kind": k, "score": q} for a, b, k, q in s] for s in out], dtype=object)

    return rows.withColumn("spans", score(F.col("text")))


def calibrated(spans: DataFrame, detector: Detector) -> list[float]:
    """The thresholds for scored rows; a count per type and step of the score reaches the driver."""
    one = spans.select(F.explode("spans").alias("s"))
    counts = one.groupBy("s.kind", F.round(F.col("s.score") * STEPS).cast("int").alias("step")).count().collect()
    return thresholds_of({(r[0], r[1]): r[2] for r in counts}, detector.prior)


def personal_spans(rows: DataFrame, detector: Detector) -> DataFrame:
    """(src, row_id, pii_type, start_char, end_char, probability) of rows (src, row_id, text).

    Null and empty texts have none; repeated rows are each reported. Texts are gone through once; the table of scored spans
    is kept for the thresholds and the choice.
    """
    kept = checkpointed(scored(rows.select("src", "row_id", "text"), detector).where("size(spans) > 0").select("src", "row_id", "spans"))
    thresholds = calibrated(kept, detector)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [
                (s, r, k, a, e, q)
                for s, r, spans in zip(b["src"], b["row_id"], b["spans"], strict=True)
                for a, e, k, q in chosen([(x["a"], x["b"], x["kind"], x["score"]) for x in spans], thresholds)
            ]
            yield pd.DataFrame(out, columns=["src", "row_id", "pii_type", "start_char", "end_char", "probability"])

    return kept.mapInPandas(run, "src string, row_id string, pii_type string, start_char int, end_char int, probability double")


def redact(t: str | None, spans: list[tuple]) -> str | None:
    """The text with [TYPE] in place of each span; all else is unchanged."""
    if not t or not spans:
        return t
    out, at = [], 0
    for a, b, kind, *_ in spans:
        out += (t[at:a], f"[{kind.upper()}]")
        at = b
    return "".join((*out, t[at:]))


def redacted(df: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """df with typed placeholders in `text`; null and empty texts stay. Texts with their spans are written once."""
    kept = checkpointed(scored(df.select(F.struct(*df.columns).alias("row"), F.col(text).alias("text")), detector))
    thresholds = calibrated(kept, detector)

    @F.pandas_udf("string")
    def blank(t: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [redact(x, chosen([(c["a"], c["b"], c["kind"], c["score"]) for c in s], thresholds)) if isinstance(x, str) else None for x, s in zip(t, spans, strict=True)],
            dtype=object,
        )

    done = blank(F.col("text"), F.col("spans"))
    return kept.select(*[done.alias(c) if c == text else F.col(f"row.`{c}`") for c in df.columns])
