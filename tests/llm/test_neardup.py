"""Near-duplicates against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np

from mnemoweave.llm.neardup import all_pairs, allot, classes_with_links, near_duplicates, size_class, words_of

SCHEMA = "fact_id string, category string, fact_text string, rep string, words string"


def brute(rows: list, t: float = 0.6) -> set:
    s = [(i, c.strip().lower().split(".")[0].strip(), set(words_of(x))) for i, c, x, *_ in rows if c is not None and words_of(x)]
    return {(min(a[0], b[0]), max(a[0], b[0])) for a, b in itertools.combinations(s, 2) if a[1] == b[1] and a[0] != b[0] and len(a[2] & b[2]) >= t * len(a[2] | b[2]) - 1e-9}


def fixture() -> list:
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        base = rng.sample(vocabulary, rng.randrange(1, 40))
        for j in range(rng.randrange(1, 4)):
            ws = [w for w in base if rng.random() > 0.15] + rng.sample(vocabulary, rng.randrange(0, 4))
            rng.shuffle(ws)
            rows.append((f"{i:03}-{j}", rng.choice(["A.b", " a", "A.c.d", "b"]), " ".join(ws), "x", "y"))
    rows += [("n1", None, "w1 w2", "", ""), ("n2", "a", None, "", ""), ("n3", "a", "", "", ""), ("n4", "a", " .,- ", "", ""), ("c1", "a", "W1, w2", "", ""), ("c2", "A.x", "w2 w1!", "", ""), ("c2", "A.x", "w2 w1!", "", ""), ("one", "b", "w5", "", "")]
    rows += [("long", "a", " ".join(f"L{i}" for i in range(3000)), "", ""), ("long2", "a", " ".join(f"L{i}" for i in range(2600)), "", "")]
    return rows


def test_all_pairs(spark):
    rows = fixture()
    pairs, member = near_duplicates(spark.createDataFrame(rows, SCHEMA))
    got = [tuple(r) for r in all_pairs(pairs, member).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)
    links = {r["id"]: r for r in classes_with_links(pairs, member).collect()}
    assert links["c1"]["rep"] == links["c2"]["rep"] == "c1" and "n2" not in links


def test_empty(spark):
    pairs, member = near_duplicates(spark.createDataFrame([], SCHEMA))
    assert all_pairs(pairs, member).count() == 0


def test_allotment():
    rng = random.Random(9)
    for _ in range(200):
        costs = [(i, np.cumsum([rng.randrange(1, 50) for _ in range(rng.randrange(1, 4))]).tolist()) for i in range(rng.randrange(1, 6))]
        need = rng.randrange(1, 10)
        choices = itertools.product(*[[(0, 0), *((c, u) for u, c in enumerate(cs, 1))] for _, cs in costs])
        best = min((sum(c for c, _ in x) for x in choices if sum(u for _, u in x) >= need), default=np.inf)
        got = allot(need, costs)
        assert (np.inf if got is None else sum(dict(costs)[p][u - 1] for p, u in got.items())) == best
        assert got is None or sum(got.values()) >= need


def test_words_one_by_one(spark):
    """Records whose words lie in too few partitions, and words that many have: nothing is lost."""
    rows = [(f"s{i:03}", "k", f"common usual x{i % 7}", "", "") for i in range(200)] + [(f"t{i}", "k", "common usual", "", "") for i in range(3)]
    pairs, member = near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r) for r in all_pairs(pairs, member).collect()} == brute(rows)


def test_no_broadcast(spark):
    """Whatever the sizes, no table is collected for a broadcast."""
    pairs, member = near_duplicates(spark.createDataFrame(fixture(), SCHEMA))
    for df in (all_pairs(pairs, member), classes_with_links(pairs, member)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_classes_are_neighbours():
    for n in range(1, 400):
        for m in range(-(-n * 6 // 10), n + 1):
            assert m < 0.6 * n or size_class(n, 0.6) - size_class(m, 0.6) in (0, 1)
