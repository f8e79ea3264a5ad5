"""Personal information: written cases, near-misses, held-out accuracy of the trees."""

from __future__ import annotations

import numpy as np
import pytest

from mnemoweave.llm.boosting import BoostedTrees, best_expected, prior_shift
from mnemoweave.llm.pii import calibrated, chosen, fitted, labelled_sample, personal_spans, redact, redacted, scored, thresholds_of

D = "/root/testdata/sf0.01"
# Written by hand, in words of their own. ‹type:span›
CASES = [
    "The tenant, ‹name:Priya Vexmoor›, paid twice.", "Prof. ‹name:Zdenka M. Underhallow› gave the talk.", "We saw ‹name:A. Oyelambe› with ‹name:Ottoline Brantholt› at the fair.",
    "‹name:Pettifern, Dragan› was absent.", "Kind regards,\n‹name:imogen gallowmere›\n", "id;role;‹name:ULRIKE PETTIFERN›;2", "It is ‹name:Priya Vexmoor›'s bicycle.",
    "Forward it to ‹email:bohdan.s@studio-nord.example› today.", "mine is ‹email:velvet.ribbon [at] example [dot] com›", "<‹email:mmendelarte @ post.example.org›>", "メール: ‹email:dagny-pettifern＠example.net›",
    "Mobile: ‹phone:+1 212 555 0173›", "fax ‹phone:030/23125-155›, or ‹phone:+44 (0)20 7946 0744›", "Please phone ‹phone:(212) 555-0128› before noon", "電話は‹phone:020 7946 0601›です",
    "His SSN: ‹id_number:921-09-2936›", "tax id ‹id_number:QQ 35 54 95 B›", "Steuer-ID: ‹id_number:00822617M›", "passport ‹id_number:JX254860<9› (copy)",
    "Deliver to ‹address:124 Mill Hollow Drive› by noon", "Mi dirección: ‹address:calle de los Tilos Altos, 86›", "habite ‹address:21, boulevard Fernelle, 63352 Port Ellisford›", "Anschrift: ‹address:Am Alten Deich 30›",
    "Wohnhaft ‹address:Rosenring 14›", "domicilio: ‹address:C/ Verdel, 12, 3º B›",
]
NEAR = [
    "see record 572 12 1210", "Version 10.20.77.4438 is out", "the ISBN 979-0-9783-691-7", "order no. 2859 1122 7644 8697", "ticket: 2064-10-0908", "the host 10.0.12.4 is down",
    "Winter Compass starts on Monday.", "redis://app:pw1@cache.test:6379", "npm i @mossgrep/core@61.2.1", "Ping @somebody now.", "", "   ", "-----BEGIN RSA PRIVATE KEY-----",
    "after comparing 43 jars with us", "during 5 weeks of rain", "the spring 12 years ago", "monitoring 80 hosts", "During 5 weeks it rained", "Comparing 43 jars takes long", "id 53284775-16af-934b-d64b-2e836299b001",
]


@pytest.fixture(scope="module")
def detector(spark):
    return fitted(spark.read.parquet(f"{D}/messages.parquet"), spark.read.parquet(f"{D}/name_parts.parquet"))


@pytest.fixture(scope="module")
def thresholds(spark, detector):
    return calibrated(scored(spark.read.parquet(f"{D}/messages.parquet").select("text").repartition(8), detector), detector)


def parse(case: str) -> tuple[str, list]:
    text, spans = "", []
    for i, part in enumerate(case.replace("›", "‹").split("‹")):
        if i % 2:
            kind, _, s = part.partition(":")
            spans.append((len(text), len(text) + len(s), kind))
            text += s
        else:
            text += part
    return text, spans


@pytest.mark.parametrize("case", CASES)
def test_found(detector, thresholds, case):
    text, spans = parse(case)
    assert [(a, b, k) for a, b, k, _ in chosen(detector.score_all([text])[0], thresholds)] == spans


@pytest.mark.parametrize("text", NEAR)
def test_near_miss(detector, thresholds, text):
    assert chosen(detector.score_all([text])[0], thresholds) == []


def test_redaction():
    assert redact("x Ann Lee y", [(2, 9, "name", 0.9)]) == "x [NAME] y" and redact(None, []) is None


def test_rows(spark, detector):
    df = spark.createDataFrame([("messages", "1", None, "z"), ("messages", "2", "", "z"), ("facts", "3", "word " * 60000 + "Tel. +1 212 555 0173", "z"), ("facts", "4", "SSN 921-09-2936", "z"), ("facts", "4", "SSN 921-09-2936", "z")], "src string, row_id string, text string, pii_type string")
    got = sorted(tuple(r) for r in personal_spans(df, detector).select("row_id", "pii_type", "start_char").collect())
    assert got == [("3", "phone", 300005), ("4", "id_number", 4), ("4", "id_number", 4)]
    assert personal_spans(df.limit(0), detector).count() == 0
    assert [r[0] for r in redacted(df.where("row_id <> 3"), detector).orderBy("row_id").select("text").collect()] == [None, "", "SSN [ID_NUMBER]", "SSN [ID_NUMBER]"]


def test_held_out(detector):
    from mnemoweave.llm.pii import features

    rows = labelled_sample(["Ann", "Bert"], ["Lee", "Cole"], detector.lexicon.common, 1500, seed=99)
    x = np.array([features(t, a, b, k, detector.lexicon) for t, a, b, k, _ in rows], np.float32)
    y, kind = np.array([r[4] for r in rows]), np.array([r[3] for r in rows])
    p = detector.trees.probability(x)
    right = (p >= 0.5) == y
    assert right[kind != 0].mean() > 0.95


def test_prior_shift():
    """Scores calibrated at one share of true rows are corrected where the share is another."""
    rng = np.random.default_rng(3)
    n = 20_000
    y = rng.random(n) < 0.05
    x = rng.normal(np.where(y, 1.5, -1.5), 1.0)
    steps = np.bincount(np.round(1000 / (1 + np.exp(-3 * x))).astype(int), minlength=1001)  # the right score at a share of a half
    q = prior_shift(steps, 0.5)
    assert abs((steps * q).sum() / n - 0.05) < 0.005
    at = best_expected(steps, q)
    taken = 1 / (1 + np.exp(-3 * x)) >= at
    f1 = 2 * (taken & y).sum() / (taken.sum() + y.sum())
    assert f1 > 2 * ((x > 0) & y).sum() / ((x > 0).sum() + y.sum()) + 0.02
    assert thresholds_of({}, [0.5] * 5) == [0.5] * 5


def test_trees():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    m = BoostedTrees(40, 3).fit(x[:1500], y[:1500]).calibrate(x[1500:], y[1500:])
    assert ((m.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_lexicon_of_all_rows(spark):
    """A part is learnt wherever its few sightings are, also if the corpus has it in lower case more often than it has partners."""
    from mnemoweave.llm.pii import learn_lexicon, word_counts

    filler = spark.range(40_000).selectExpr("concat('note ', id, ' is kept') AS text")
    rare = spark.createDataFrame([("Zorvena Lee.",), ("ask Zorvena Cole.",), ("see Ann Quillmoor",), ("see Bert Quillmoor",), ("Mme Lee",), ("Mme Cole",)] + [("Ann Ostrava, zorvena lee, Zorvena Lee",)] * 20 + [(None,), ("",)], "text string")
    lex = learn_lexicon(word_counts(filler.unionByName(rare)), {"Ann", "Bert"}, {"Lee", "Cole"})
    assert lex.given == {"ann", "bert", "zorvena"} and lex.family == {"lee", "cole", "quillmoor"}
    assert lex.common["kept"] == lex.common["note"] > 3e5 and lex.common["zorvena"] == pytest.approx(lex.common["kept"] / 2000)


def test_plan_counts_facts(spark, tmp_path):
    """Facts are redacted, so they are learnt from too."""
    from mnemoweave.llm.plans.pii import p2_found

    spark.createDataFrame([(1, "nothing here")], "seq long, text string").write.parquet(str(tmp_path / "messages.parquet"))
    spark.createDataFrame([("f1", "met ann quillmoor today"), ("f2", "Thanks to Ann Quillmoor."), ("f3", "Thanks to Bert Quillmoor."), ("f4", "Name: C. Quillmoor")], "fact_id string, fact_text string").write.parquet(str(tmp_path / "facts.parquet"))
    spark.createDataFrame([("given", "Ann"), ("given", "Bert"), ("family", "Lee")], "part_kind string, name_part string").write.parquet(str(tmp_path / "name_parts.parquet"))
    got = {r["row_id"] for r in p2_found(spark, str(tmp_path)).collect()}
    assert {"f2", "f3"} <= got
