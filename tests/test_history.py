"""Validity history against a plain model; nulls, ties, repeated rows, clashing names."""

from __future__ import annotations

import random
from datetime import datetime

from mnemoweave.operators.history import history

SCHEMA = "snapshot_no int, taken_at timestamp, delivery_no int, fact_id string, category string, status string, last_seen_ts double, valid_to string"


def day(n: int) -> datetime:
    return datetime(2024, 1, n)


def fold(x, inner=False):
    if x is None:
        return None
    x = x.strip().lower()
    return x.replace(" ", "").replace("-", "").replace("_", "") if inner else x


def model(rows: list[tuple]) -> set:
    best: dict = {}
    for r in rows:
        if r[3] is not None and r[0] is not None and ((r[3], r[0]) not in best or r[2] > best[r[3], r[0]][2]):
            best[r[3], r[0]] = r
    out, last = set(), {}
    for (f, s), r in sorted(best.items()):
        state = (fold(r[4]), fold(r[5], True), r[6])
        if f not in last or last[f] != state:
            out.add((f, s))
        last[f] = state
    return out


def test_random(spark):
    rng = random.Random(3)
    rows = []
    for f in range(40):
        for s in range(1, 13):
            for d in range(rng.choice((0, 1, 1, 1, 2))):
                rows.append((s, day(s), s + d, f"f{f}", rng.choice(["A.b", "a.b ", " A.B", "c", None]), rng.choice(["needs_review", "Needs review", "needs-review", "accepted", None]), rng.choice([1.0, 1.0, 2.0, None]), "x"))
    rows += [(1, day(1), 1, None, "a", "b", 1.0, "x"), (None, day(1), 1, "f0", "a", "b", 1.0, "x")]
    rows += rows[:50]
    got = [(r["fact_id"], r["snapshot_no"]) for r in history(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == model(rows)


def test_periods(spark):
    rows = [(1, day(1), 1, "a", "x", "s", 1.0, ""), (2, day(2), 2, "a", "X ", "S", 1.0, ""), (3, day(3), 3, "a", "y", "s", 1.0, ""), (4, day(4), 4, "b", "x", "s", None, "")]
    got = sorted((r["fact_id"], r["snapshot_no"], r["valid_from"], r["valid_to"], r["event"], r["is_current"]) for r in history(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("a", 1, day(1), day(3), "inserted", False), ("a", 3, day(3), day(4), "changed", False), ("b", 4, day(4), None, "inserted", True)]


def test_empty(spark):
    assert history(spark.createDataFrame([], SCHEMA)).count() == 0
