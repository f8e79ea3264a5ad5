"""Packing against the sequential model, and metadata of chunks."""

from __future__ import annotations

import random

import pytest

from mnemoweave.operators import chunking as C


def model(rows: list[tuple[str, int]], budget: int) -> list[int]:
    """Chunk numbers by one pass over (conversation, tokens): runs are buffered, an oversized buffer is flushed as it stands."""
    chunk, used, out = 1, 0, []
    buffer: list[int] = []

    def flush(unit: bool) -> None:
        nonlocal chunk, used
        total = sum(buffer)
        if unit and total <= budget and used + total > budget and used:
            chunk, used = chunk + 1, 0
        for n in buffer:
            if used + n > budget and used:
                chunk, used = chunk + 1, 0
            used += n
            out.append(chunk)
        buffer.clear()

    last = None
    for conv, n in rows:
        if conv != last and buffer:
            flush(True)
        last = conv
        buffer.append(n)
        if sum(buffer) > budget:
            flush(False)
    if buffer:
        flush(True)
    return out


def run(spark, rows: list[tuple[str, int]], budget: int) -> list[int]:
    df = spark.createDataFrame([(i + 1, c, f"m{i}", "user", "", "x" * (4 * n)) for i, (c, n) in enumerate(rows)], "seq long, conv_id string, message_id string, role string, title string, text string")
    return [r["chunk_no"] for r in C.chunk_assignment(df, budget).orderBy("seq").collect()]


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([("A", 3), ("B", 6), ("B", 6), ("B", 3)], [1, 1, 2, 2]), ([("A", 3), ("B", 6), ("B", 6), ("B", 6)], [1, 1, 2, 3]), ([("A", 3), ("B", 4), ("B", 4)], [1, 2, 2]),
        ([("A", 3), ("B", 4), ("A", 2), ("A", 5)], [1, 1, 2, 2]),
    ],
)
def test_fixtures(spark, rows, want):
    assert model(rows, 10) == want
    assert run(spark, rows, 10) == want


def test_random(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BUDGETS", 3)  # many blocks
    monkeypatch.setattr(C, "TOGETHER", 4)
    rng = random.Random(8)
    rows = []
    while len(rows) < 700:
        c = rng.choice("ABCDE")
        rows += [(c, rng.randrange(1, 31)) for _ in range(rng.choice((1, 1, 2, 3, 20)))]
    assert run(spark, rows, 30) == model(rows, 30)


def test_errors(spark):
    with pytest.raises(ValueError):
        C.chunk_assignment(spark.createDataFrame([], "seq long, conv_id string, message_id string, role string, title string, text string"), 0)


def test_template():
    t = "Head\nRules:\n- one\n{{TRANSCRIPT}}"
    once = C.hardened(t)
    assert once.split("\n")[2] == C.GUARD and C.hardened(once) == once
    assert C.hardened("x").startswith(C.GUARD)
