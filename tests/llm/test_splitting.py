"""Pieces of oversized items."""

from __future__ import annotations

import random

import pytest

from mnemoweave.llm.splitting import best_boundary, boundary_tables, message_items, range_size, slices, split_texts

LIMITS = "item_kind string, max_tokens int, overlap_tokens int"


def pieces_of(messages, limits):
    texts = messages.selectExpr("seq as part_no", "text")
    return split_texts(message_items(boundary_tables(texts, range_size(limits))), texts, limits)


def check(rows: list, texts: dict[str, str], limit: int, overlap: int) -> None:
    got: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["item_id"], r["piece_no"])):
        got.setdefault(r["item_id"], []).append(r)
    assert set(got) == {k for k, t in texts.items() if -(-len((t or "").encode()) // 4) > limit}
    for k, ps in got.items():
        whole = texts[k].encode()
        assert [p["piece_no"] for p in ps] == list(range(len(ps))) and len(ps) > 1
        at = 0
        for i, p in enumerate(ps):
            b = p["text"].encode()
            assert "�" not in p["text"] or "�" in texts[k]
            assert -(-len(b) // 4) <= limit and p["n_tokens"] <= limit
            start = whole.find(b, max(0, p["start_byte"]), p["start_byte"] + 3 + len(b))
            assert start >= 0 and start <= at  # no gap
            if i:
                assert overlap * 4 - 3 <= at - start <= overlap * 4
            at = start + len(b)
        assert at == len(whole)


def test_messages(spark):
    rng = random.Random(5)
    words = ["alpha", "Ünïcode", "日本語", "🙂", "x", "sentence.", "line\n", "para\n\n", "end?", "。"]
    texts = {str(i): " ".join(rng.choice(words) for _ in range(rng.randrange(0, 400))) for i in range(60)}
    texts |= {"100": "z" * 3000, "101": "é" * 3000, "102": "🙂" * 900, "103": "", "104": " " * 2000, "105": "a" * 400, "106": "a" * 401}
    rows = [(int(k), t, "x") for k, t in texts.items()] + [(107, None, "x")]
    m = spark.createDataFrame(rows, "seq long, text string, item_id string")
    limits = spark.createDataFrame([("message", 100, 10)], LIMITS)
    check(pieces_of(m, limits).collect(), texts, 100, 10)
    assert pieces_of(m.limit(0), limits).count() == 0
    assert pieces_of(m, limits.limit(0)).count() == 0


def test_many_parts(spark):
    rng = random.Random(6)
    parts = [("chunk", f"c{i % 3}", i, "".join(rng.choice("ab .\n é") for _ in range(rng.randrange(0, 900)))) for i in range(200)]
    df = spark.createDataFrame(parts, "item_kind string, item_id string, part_no long, text string")
    limits = spark.createDataFrame([("chunk", 300, 20)], LIMITS)
    items = boundary_tables(df, range_size(limits)).join(df.drop("text"), "part_no")
    out = split_texts(items, df, limits).collect()
    for c in ("c0", "c1", "c2"):
        whole = "".join(t for _, i, _, t in parts if i == c)
        at = 0
        for p in sorted((r for r in out if r["item_id"] == c), key=lambda r: r["piece_no"]):
            assert p["n_tokens"] <= 300
            start = whole.find(p["text"], max(0, at - 100))
            assert 0 <= start <= at
            at = start + len(p["text"])
        assert at == len(whole)


def test_best_boundary():
    assert best_boundary(b"one two\n\nthree. four five", 0, 20) == (4, 9)
    assert best_boundary(b"one two. three four", 0, 17) == (2, 9)
    assert best_boundary(b"onetwothree", 2, 7) == (0, 7)
    assert best_boundary("ééé".encode(), 0, 3) == (0, 2)
    assert best_boundary(b"ab\n\ncd", 3, 6) == (4, 4)  # across the edge


def test_found_at_natural_places(spark):
    m = spark.read.parquet("/root/testdata/sf0.01/messages.parquet")
    out = pieces_of(m, spark.read.parquet("/root/testdata/sf0.01/size_limits.parquet")).collect()
    texts = {str(r["seq"]): r["text"] for r in m.collect()}
    check(out, texts, 1000, 80)
    # inside a word only where there is nothing but one
    assert not any(c in " \t\n" for r in out if r["level"] == 0 for c in r["text"][-100:])


def test_small_limits(spark):
    """Whatever the limit and overlap: no piece above the limit, neighbours meet, and the pieces give the item again."""
    rng = random.Random(8)
    signs = ["a", "b", " ", "\n", ". ", "é", "日", "🙂", "\n\n"]
    texts = [(0, "one", "x" * 400), (1, "two", "🙂" * 90), (2, "mix", "".join(rng.choice(signs) for _ in range(300)))]
    texts += [(3 + i, "many", "".join(rng.choice(signs) for _ in range(rng.randrange(0, 40)))) for i in range(30)]
    df = spark.createDataFrame(texts, "part_no long, item_id string, text string")
    kinds = [(f"{n}/{o}", n, o) for n in range(3, 65) for o in (0, 1, 7, 63)]
    limits = spark.createDataFrame(kinds, LIMITS)
    items = boundary_tables(df, range_size(limits)).join(df.drop("text"), "part_no").crossJoin(limits.select("item_kind"))
    got: dict[tuple, list] = {}
    for r in split_texts(items, df, limits).collect():
        got.setdefault((r["item_kind"], r["item_id"]), []).append(r)
    assert len(got) == 4 * len(kinds)
    for (kind, item), ps in got.items():
        whole, at = "".join(t for _, i, t in texts if i == item), 0
        for p in sorted(ps, key=lambda p: p["piece_no"]):
            assert p["n_tokens"] <= int(kind.split("/")[0])
            t = p["text"]
            start = next((s for s in range(at, max(-1, at - len(t) - 1), -1) if whole.startswith(t, s)), None)
            assert start is not None, (kind, item, p)
            at = start + len(t)
        assert at == len(whole)


def test_least_limit(spark):
    df = spark.createDataFrame([(1, "x" * 40)], "part_no long, text string")
    limits = spark.createDataFrame([("message", 2, 0)], LIMITS)
    with pytest.raises(Exception, match="max_tokens must be 3"):
        split_texts(message_items(boundary_tables(df, 8)), df, limits).collect()


def test_slices(spark):
    """A text's table and pieces are the same whether it is taken whole or in slices, and slices go to several tasks."""
    rng = random.Random(9)
    signs = ["a", "bc ", "\n", ". ", "é", "日", "🙂", "\n\n", "。", "x" * 50]
    rows = [(i, "".join(rng.choice(signs) for _ in range(n))) for i, n in enumerate((4000, 3000, 10, 0, 2500))] + [(9, None)]
    df = spark.createDataFrame(rows, "part_no long, text string")
    for size in (1, 8, 37, 256):
        want = {r["part_no"]: tuple(r) for r in boundary_tables(df, size).collect()}
        assert {r["part_no"]: tuple(r) for r in boundary_tables(df, size, 1000).collect()} == want
    limits = spark.createDataFrame([("message", 50, 5)], LIMITS)
    items = message_items(boundary_tables(df, range_size(limits)))
    want = sorted(map(tuple, split_texts(items, df, limits).collect()))
    assert sorted(map(tuple, split_texts(items, df, limits, 1000).collect())) == want and len(want) > 100
    assert slices(df, 1000, 4, 1).groupBy("part_no").count().where("count > 5").count() >= 3
