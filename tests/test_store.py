"""Claims' rules and the store against plain folds."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from mnemoweave.functions import text as X
from mnemoweave.operators import claims as K
from mnemoweave.operators import report as R
from mnemoweave.operators import store as S

SCHEMA = (
    "seq long, file_no int, chunk_id string, category string, fact string, stability string, status string, confidence double, time struct<as_of_ts:double>, "
    "evidence array<struct<role:string,quote:string,conv_id:string,message_id:string,ts:double>>, derived_from string, value string, tags array<string>, notes string"
)
EV = ("user", "quote", "c", "m", 1.0)


def claim(seq, **k):
    d = {"file_no": 1, "chunk_id": "chunk_0001", "category": "goals.x", "fact": "a fact", "stability": "stable", "status": "accepted", "confidence": 0.5, "time": (1.0,), "evidence": [EV], "derived_from": "user", "value": None, "tags": None, "notes": None} | k
    return (seq, *d.values())


@pytest.mark.parametrize(
    ("change", "codes"),
    [
        ({}, []), ({"category": " "}, ["schema.category"]), ({"fact": None}, ["schema.fact"]), ({"stability": "x"}, ["schema.stability"]), ({"status": "Accepted"}, ["schema.status"]), ({"confidence": float("nan")}, ["schema.confidence"]), ({"confidence": 1.1}, ["schema.confidence"]),
        ({"time": None}, ["schema.time"]), ({"time": (None,)}, ["schema.time.as_of_ts"]), ({"derived_from": None}, ["schema.derived_from"]), ({"evidence": []}, ["schema.evidence", "grounding.user_evidence"]), ({"evidence": None}, ["schema.evidence", "grounding.user_evidence"]),
        ({"evidence": [None, EV]}, ["schema.evidence.item"]), ({"tags": ["a", None]}, ["schema.tags"]), ({"value": " "}, ["schema.value"]), ({"evidence": [EV, ("tool", "", None, " ", None)]}, ["evidence.role", "evidence.quote", "evidence.conv_id", "evidence.message_id", "evidence.ts"]),
        ({"derived_from": "assistant"}, ["grounding.assistant_status"]), ({"category": "preferences.interests"}, ["schema.value.required", "interest.threshold"]), ({"category": "preferences.interests", "value": "v", "status": "needs_review"}, []),
        ({"fact": "sk-abcdefghijkl a@b.example"}, ["safety.openai_key", "privacy.email"]), ({"notes": "token=" + "a" * 22}, ["safety.secret_kv_high_entropy"]), ({"evidence": [("user", "call +1 212 555 0128", "c", "m", 1.0)]}, ["privacy.phone_like"]),
    ],
)
def test_rules(spark, change, codes):
    df = spark.createDataFrame([claim(1, **change)], SCHEMA)
    assert [r["code"] for r in K.issues(df).orderBy("no").collect()] == codes
    assert all(r["level"] == "error" for r in K.issues(df, strict=True).collect())


def test_summary_and_lines(spark):
    df = spark.createDataFrame([claim(1), claim(2, fact=None), claim(3, fact="x a@b.example", file_no=2)], SCHEMA)
    got = {r["file_no"]: tuple(r)[1:] for r in K.summary(df, K.issues(df)).collect()}
    assert got == {1: (2, 1, 1, 0), 2: (1, 0, 0, 1)}
    lines = spark.createDataFrame([("",), ("```x",), ("[1]",), ('{"a":',), ("﻿{}",), (' {"a": 1} ',), (None,)], "value string")
    assert [r["format"] for r in K.line_format(lines).collect()] == ["blank", "code_fence", "non_json_object_line", "json_parse", "ok", "ok", "blank"]
    raw = spark.createDataFrame([('{"b": 1.0, "a": {"z": null, "y": 1e3}}',), ("{",), (None,)], "j string")
    assert [r[0] for r in raw.select(K.canonical_json("j")).collect()] == [json.dumps(json.loads('{"b": 1.0, "a": {"z": null, "y": 1e3}}'), sort_keys=True, separators=(",", ":")), None, None]


def test_facts_equal_the_fold(spark):
    rng = random.Random(2)
    rows = [claim(i, fact=rng.choice(["One", "one ", "TWO", "three"]), category=rng.choice(["goals.x", "projects.y"]), stability=rng.choice(["stable", "transient"]) if rng.random() < 0.2 else "stable", status=rng.choice(["accepted", "needs_review", "odd"]), confidence=rng.random(), time=(rng.choice([None, 1.0, 2.0, 3.0]),), derived_from=rng.choice(["user", "assistant"])) for i in range(1, 60)]
    rows += [(100 + r[0], *r[1:]) for r in rows[:20]]
    state: dict = {}
    seen = set()
    for r in rows:
        if repr(r[1:]) in seen:
            continue
        seen.add(repr(r[1:]))
        _, _, _, cat, fact, stab, status, conf, (ts,), _, derived, *_ = r
        want = "needs_review" if derived == "assistant" or status == "needs_review" else "accepted"
        k = (cat, " ".join(fact.split()).casefold())
        s = state.get(k)
        if s is None:
            state[k] = {"text": fact.strip(), "stab": stab, "first": ts, "last": ts, "conf": conf, "status": want}
            continue
        if ts is not None and (s["last"] is None or ts >= s["last"]):
            s["text"] = fact.strip()
        if ts is not None:
            s["first"] = ts if s["first"] is None else min(s["first"], ts)
            s["last"] = ts if s["last"] is None else max(s["last"], ts)
        s["conf"] = max(s["conf"], conf)
        s["stab"] = s["stab"] if s["stab"] == stab else "transient"
        s["status"] = "accepted" if "accepted" in (s["status"], want) else want
    got = {(r["category"], r["normalized_fact_text"]): {"text": r["fact_text"], "stab": r["stability"], "first": r["first_seen_ts"], "last": r["last_seen_ts"], "conf": r["confidence_max"], "status": r["status"]} for r in S.facts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == state


def test_latest_only_over_files(spark):
    """F, G, then F again: the fold keeps G; a second pass over the result turns to F."""
    f = {"category": "identity.name", "fact": "F"}
    rows = [claim(1, file_no=1, time=(10.0,), **f), claim(2, file_no=2, time=(20.0,), category="identity.name", fact="G"), claim(3, file_no=3, time=(30.0,), status="needs_review", **f)]
    df = spark.createDataFrame(rows, SCHEMA)
    fid = {r["fact"]: r["fact_id"] for r in S.identified(df).collect()}
    once = S.fold_latest_only(df)
    assert {r["fact_id"]: r["status"] for r in once.collect()} == {fid["F"]: "superseded", fid["G"]: "accepted"}
    twice = S.fold_latest_only(df, prior=once)
    assert {r["fact_id"]: r["status"] for r in twice.collect()} == {fid["F"]: "accepted", fid["G"]: "superseded"}


def test_decisions(spark):
    store = spark.createDataFrame([("a", "needs_review"), ("b", "accepted")], "fact_id string, status string")
    actions = spark.createDataFrame([(1, "a", "ACCEPT"), (2, "a", "reject"), (3, "b", " "), (4, "none", "accept"), (5, "b", "accept")], "seq int, fact_id string, action string")
    new, audit = S.decide(store, actions)
    assert {tuple(r) for r in new.collect()} == {("a", "rejected"), ("b", "accepted")}
    assert sorted((r["seq"], r["previous_status"], r["new_status"]) for r in audit.collect()) == [(1, "needs_review", "accepted"), (2, "accepted", "rejected"), (5, "accepted", "accepted")]
    cut = S.cutoffs(audit.withColumn("decided_at", F.col("seq")))
    claims = spark.createDataFrame([("a", 9), ("b", 9)], "fact_id string, imported_at int")
    assert {tuple(r) for r in S.reopened(new, cut, claims).collect()} == {("a", "needs_review"), ("b", "accepted")}


def test_report(spark):
    facts = spark.createDataFrame([("1", "identity.name", "x\ny", "stable", 5.0, 0.0625, "accepted"), ("2", "goals.a", "z", "odd", None, None, "accepted"), ("3", "projects.p", "p", "transient", None, 0.5, "rejected")], "fact_id string, category string, fact_text string, stability string, last_seen_ts double, confidence_max double, status string")
    ev = spark.createDataFrame([(f"e{i}", "1", "c", "m", float(i), "user" if i == 1 else "assistant", "q" * 300) for i in range(1, 6)] + [("e1", "1", "c", "m", 1.0, "user", "q" * 300)], "evidence_id string, fact_id string, conv_id string, message_id string, ts double, role string, quote string")
    assert [r["evidence_id"] for r in R.top_evidence(ev).orderBy("rank").collect()] == ["e1", "e5", "e4"] and R.top_evidence(ev, 0).count() == 0
    lines = R.render_lines(R.fact_blocks(R.report_filter(facts), ev)).collect()
    assert [r["fact_id"] for r in lines] == ["1"]
    assert lines[0]["line"].startswith("## Stable\n\n### `identity.name`\n- Fact: x y\n  - As of: `1970-01-01T00:00:05Z`\n  - Confidence: `0.062`\n  - Evidence:\n    - “" + "q" * 239 + "…”")
    assert R.report_filter(facts, rejected=True).count() == 3
    assert facts.limit(0).transform(R.report_filter).transform(R.report_counts).count() == 0


def test_empty_claims(spark):
    df = spark.createDataFrame([], SCHEMA)
    for out in (K.issues(df), S.facts(df), S.evidence_rows(df), S.links(df), S.fold_latest_only(df), S.stability_flags(df), K.secret_violations(df)):
        assert out.count() == 0


def test_normalized_is_the_identity(spark):
    df = spark.createDataFrame([("A  b", None), ("a B", " "), ("x", "A b")], "fact string, value string")
    ids = {r[0] for r in df.select(K.fact_id(F.lit("c"), F.col("fact"), F.col("value"))).collect()}
    assert len(ids) == 1 and X.normalized is not None


def test_merged_equals_the_fold(spark):
    """A store with decisions and more claims, claim by claim; among them those it has already."""
    rng = random.Random(12)
    times = [None, 1.0, 2.0, 3.0, 4.0]
    made = lambda i: claim(
        i, fact=rng.choice([f"F{k}" for k in range(14)]), stability=rng.choice(["stable"] * 5 + ["transient"]), status=rng.choice(["accepted", "needs_review"]),
        confidence=round(rng.random(), 3), time=(rng.choice(times),), derived_from=rng.choice(["user", "assistant"]),
    )
    first = [made(i) for i in range(1, 40)]
    df = spark.createDataFrame(first, SCHEMA)
    prior = {r["fact_text"]: r.asDict() for r in S.facts(df).where("fact_text < 'F5' or fact_text > 'F8'").collect()}
    for k, r in prior.items():
        r["status"] = rng.choice(["accepted", "rejected", "rejected", "needs_review", "superseded"])
        r["cut"] = rng.choice([None, 50.0, 150.0])
    second = [(100 + r[0], *r[1:]) for r in first[:8]] + [made(i) for i in range(200, 240)]
    known = {repr(r[1:]) for r in first}
    want = {k: dict(r) for k, r in prior.items()}
    for r in second:
        text, stab, status, conf, (ts,), derived = r[4], r[5], r[6], r[7], r[8], r[10]
        wanted = "needs_review" if derived == "assistant" else status
        s = want.get(text)
        new = repr(r[1:]) not in known
        known.add(repr(r[1:]))
        if s is None:
            want[text] = {"stability": stab, "first_seen_ts": ts, "last_seen_ts": ts, "confidence_max": conf, "status": wanted, "cut": None}
            continue
        if s["status"] == "rejected":
            if new and s["cut"] is not None and s["cut"] < 100.0:
                s["status"] = "needs_review"
        elif s["status"] != "accepted":
            s["status"] = wanted
        s["stability"] = stab if s["stability"] == stab else "transient"
        if ts is not None:
            s["first_seen_ts"] = ts if s["first_seen_ts"] is None else min(s["first_seen_ts"], ts)
            s["last_seen_ts"] = ts if s["last_seen_ts"] is None else max(s["last_seen_ts"], ts)
        s["confidence_max"] = max(s["confidence_max"], conf)
    fields = ("fact_id", "category", "fact_text", "stability", "first_seen_ts", "last_seen_ts", "confidence_max", "status", "claims")
    store = spark.createDataFrame([tuple(r[f] for f in fields) for r in prior.values()], "fact_id string, category string, fact_text string, stability string, first_seen_ts double, last_seen_ts double, confidence_max double, status string, claims long")
    cut = spark.createDataFrame([(r["fact_id"], r["cut"]) for r in prior.values() if r["cut"]], "fact_id string, decided_at double")
    got = S.merged(store, spark.createDataFrame(second, SCHEMA), S.deduped(df).select("claim_id"), cut, 100.0).collect()
    keep = ("stability", "first_seen_ts", "last_seen_ts", "confidence_max", "status")
    assert {r["fact_text"]: tuple(r[f] for f in keep) for r in got} == {k: tuple(r[f] for f in keep) for k, r in want.items()}


def test_merged_text(spark):
    prior = spark.createDataFrame([("x", "c", "Old", "stable", None, None, 0.5, "accepted", 1)], "fact_id string, category string, fact_text string, stability string, first_seen_ts double, last_seen_ts double, confidence_max double, status string, claims long")
    fid = spark.createDataFrame([claim(1, category="c", fact="old")], SCHEMA).select(K.fact_id(F.col("category"), F.col("fact"), F.col("value"))).first()[0]
    prior = prior.withColumn("fact_id", F.lit(fid))
    for ts, text in ((None, "Old"), (3.0, "OLD")):
        got = S.merged(prior, spark.createDataFrame([claim(1, category="c", fact=" OLD ", time=(ts,))], SCHEMA)).collect()
        assert [(r["fact_text"], r["claims"]) for r in got] == [(text, 2)]


def test_ids_are_those_of_canonical_json(spark):
    import hashlib

    raw = '{"fact": "é", "confidence": 1.0, "time": {"as_of_ts": 1753150644.0}, "category": "c"}'
    want = hashlib.sha256(json.dumps(json.loads(raw), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    df = spark.createDataFrame([claim(1, fact="é", confidence=1.0, time=(1753150644.0,), category="c", **dict.fromkeys(("stability", "status", "evidence", "derived_from")))], SCHEMA)
    assert df.select(K.claim_id(df)).first()[0] == want
    lines = df.withColumn("raw", F.lit(raw))
    assert lines.select(K.claim_id(lines)).first()[0] == want
    audit = spark.createDataFrame([(1, "f", "accept", "accepted", None, "ä", "p", 3), (2, "f", "accept", "accepted", None, "ä", "p", 3)], "seq long, fact_id string, action string, new_status string, reason string, decided_by string, source_path string, source_line long")
    key = {"fact_id": "f", "action": "accept", "new_status": "accepted", "reason": "", "decided_by": "ä", "source_path": "p", "source_line": 3}
    rid = hashlib.sha256(json.dumps(key, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert [(r["review_id"], r["seq"]) for r in S.new_reviews(audit).collect()] == [(rid, 1)]
    assert S.new_reviews(audit, S.new_reviews(audit)).count() == 0


def test_given_decisions_and_mismatches(spark):
    acts = spark.createDataFrame([(1, "a", "accept", "goals"), (2, "b", "reject", None), (3, "c", "reject", "x")], "seq long, fact_id string, action string, category string")
    got = S.given_decisions(acts, ("p",), ("q", "r"), ("s",)).orderBy("seq").collect()
    assert [(r["seq"], r["fact_id"], r["action"]) for r in got][3:] == [(4, "p", "accept"), (5, "q", "reject"), (6, "r", "reject"), (7, "s", "needs_review")]
    store = spark.createDataFrame([("a", "goals"), ("b", "goals"), ("c", "goals")], "fact_id string, category string")
    assert [tuple(r) for r in S.mismatches(acts, store).collect()] == [(3, "c", "category", "x", "goals")]
    with pytest.raises(ValueError, match="action 3"):
        S.mismatches(acts, store, strict=True)


def test_optional_fields(spark):
    lines = ['{"tags": ["a", "b"], "notes": "n", "value": "v"}', '{"tags": "a"}', '{"tags": ["a", 1]}', '{"tags": ["a", null]}', '{"tags": []}', '{"notes": 3}', '{"notes": null, "value": null}', '{"value": " "}', '{"value": {}}', "{", "", '{"tags": [null]}', '{"notes": {"a": 1}, "tags": {}}']
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    got = sorted((r["i"], r["code"]) for r in K.optional_issues(df).collect())
    assert got == [(1, "schema.tags"), (2, "schema.tags"), (3, "schema.tags"), (5, "schema.notes"), (7, "schema.value"), (8, "schema.value"), (11, "schema.tags"), (12, "schema.notes"), (12, "schema.tags")]


def fold_by_file(rows: list, prior: dict) -> dict:
    """The plain fold over the files of one category."""
    state = {k: list(v) for k, v in prior.items()}
    for no in sorted({r[1] for r in rows}):
        told: dict = {}
        for r in (r for r in rows if r[1] == no):
            t = told.setdefault(r[4], [False, None, None])
            t[0] |= r[6] == "accepted"
            t[1] = r[8][0] if t[1] is None else t[1] if r[8][0] is None else max(t[1], r[8][0])
            t[2] = r[7] if t[2] is None else max(t[2], r[7])
        for k, (acc, ts, conf) in told.items():
            wanted = "accepted" if acc else "needs_review"
            s = state.get(k)
            if s is None:
                state[k] = [wanted, ts, conf]
                continue
            if s[0] in ("needs_review", "superseded"):
                s[0] = wanted
            s[1] = ts if s[1] is None else s[1] if ts is None else max(s[1], ts)
            s[2] = max(s[2], conf)
        if any(r[9] for r in rows if r[1] == no):
            live = {k: s for k, s in state.items() if s[0] in ("accepted", "needs_review")}
            pool = {k: s for k, s in live.items() if s[0] == "accepted"} or live
            if pool:
                best = min(pool, key=lambda k: (1.0 if pool[k][1] is None else -pool[k][1], -pool[k][2], ids[k]))
                for k, s in live.items():
                    if k != best:
                        s[0] = "superseded"
    return {k: tuple(v) for k, v in state.items()}


ids: dict = {}


@pytest.mark.parametrize("seed", range(4))
def test_fold_over_files(spark, seed):
    rng = random.Random(seed)
    names = [f"N{i}" for i in range(6)]
    rows = [
        claim(i, file_no=rng.randrange(1, 9), category="identity.name", fact=rng.choice(names), status=rng.choice(["accepted", "needs_review", "needs_review"]), time=(rng.choice([None, 1.0, 2.0, 3.0]),), confidence=rng.choice([0.2, 0.5, 0.9]), evidence=[EV] if rng.random() < 0.6 else [])
        for i in range(1, 26)
    ]
    rows.sort(key=lambda r: (r[1], r[0]))
    df = spark.createDataFrame(rows, SCHEMA)
    ids.clear()
    ids.update({n: spark.range(1).select(K.fact_id(F.lit("identity.name"), F.lit(n), F.lit(None).cast("string"))).first()[0] for n in names})
    prior = {n: (rng.choice(["accepted", "needs_review", "superseded", "rejected"]), rng.choice([None, 2.5]), 0.4) for n in names[:3]} if seed % 2 else {}
    store = spark.createDataFrame([(ids[n], "identity.name", *v) for n, v in prior.items()], "fact_id string, category string, status string, last_seen_ts double, confidence_max double") if prior else None
    name = {v: k for k, v in ids.items()}
    got = {name[r["fact_id"]]: (r["status"], r["last_seen_ts"], r["confidence_max"]) for r in S.fold_latest_only(df, prior=store).collect()}
    assert got == fold_by_file(rows, prior)
