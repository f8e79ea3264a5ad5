"""Trees, defaults, runs."""

from __future__ import annotations

import json

from mnemoweave.operators import messages as M


def node(parent, **m):
    return {"parent": parent, "message": {"id": m.get("id"), "author": {"role": m.get("role", "user"), "name": m.get("name")}, "create_time": m.get("ts"), "update_time": m.get("up"), "content": m.get("content", {"content_type": "text", "parts": [m.get("text", "t")]}), "metadata": m.get("meta")} if m else None}


def flat(spark, *trees, **kw):
    lines = spark.createDataFrame([(json.dumps(t),) for t in trees], "value string")
    rows = M.flatten(M.parse_export(lines), **kw).orderBy("conv_id", "pos").collect()
    return [(r["conv_id"], r["message_id"], r["role"], r["text"], r["ts"]) for r in rows]


def test_branch(spark):
    t = {"conversation_id": "c", "title": "T", "current_node": "d", "mapping": {"a": node(None), "b": node("a", ts=1, text="one"), "x": node("b", ts=9, text="side"), "d": node("b", ts=2, text="two", role="assistant")}}
    assert flat(spark, t) == [("c", "b", "user", "one", 1.0), ("c", "d", "assistant", "two", 2.0)]


def test_latest_first_of_equals_dangling_cycle(spark):
    t = {"id": "i", "mapping": {"p": node("gone", ts=5, text="p"), "q": node("gone", ts=5, text="q")}}
    assert [x[1] for x in flat(spark, t)] == ["p"]
    loop = {"id": "l", "current_node": "b", "mapping": {"a": node("b", ts=1, text="a"), "b": node("a", ts=2, text="b")}}
    assert [x[1] for x in flat(spark, loop)] == ["a", "b"]
    assert flat(spark, {"id": "n", "mapping": {"a": node(None, text="no time")}}) == []
    deep = {"id": "d", "current_node": "n299", "mapping": {f"n{i}": node(f"n{i - 1}" if i else None, ts=i + 1, text=str(i)) for i in range(300)}}
    assert [x[3] for x in flat(spark, deep)] == [str(i) for i in range(300)]


def test_filters(spark):
    hidden, shown = {"is_visually_hidden_from_conversation": True}, {"is_visually_hidden_from_conversation": "true"}
    m = {"a": node(None, text="a", ts=1, meta=hidden), "b": node("a", text="b", ts=2, meta=shown), "c": node("b", text=" \n", ts=3), "d": node("c", role="", name="bot", text="d", ts=4), "e": node("d", ts=5, content={"content_type": "multimodal_text", "parts": ["x", {"text": "y"}, {"no": 1}]}), "f": node("e", ts=6, content={"content_type": "code", "parts": ["z"]})}
    t = {"conversation_id": "", "id": "i", "current_node": "f", "mapping": m}
    assert [x[1] for x in flat(spark, t)] == ["b", "e"]
    assert flat(spark, t)[1][3] == "x\ny"
    assert [x[1] for x in flat(spark, t, include_hidden=True)] == ["a", "b", "e"]
    assert [x[2] for x in flat(spark, t, roles=())] == ["user", "bot", "user"]


def test_corrupt(spark):
    lines = spark.createDataFrame([('{"id": "a"}',), ("[1]",), ("{",), (None,)], "value string")
    assert [r["corrupt"] for r in M.parse_export(lines).collect()] == [False, True, True, True]


def test_runs(spark):
    rows = [(1, "a"), (2, "a"), (3, ""), (4, None), (70_000, None), (70_001, "a")]
    df = spark.createDataFrame([(s, c, "m", "user", "", "") for s, c in rows], "seq long, conv_id string, message_id string, role string, title string, text string")
    got = sorted((r["run_no"], r["conv_id"], r["first_seq"], r["last_seq"], r["messages"]) for r in M.conversation_runs(df).collect())
    assert got == [(1, "a", 1, 2, 2), (2, "unknown", 3, 70_000, 3), (3, "a", 70_001, 70_001, 1)]
    assert M.conversation_runs(df.limit(0)).count() == 0


def test_view(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "token=abc " + "x" * 100, "k")], "seq long, text string, extra string")
    got = M.build_view(df, chars=80).orderBy("seq").collect()
    assert [(r["text"][:6], r["cut"], r["extra"]) for r in got] == [("", False, "k"), ("token=", True, "k")] and got[1]["redactions"] == {"secret_kv": 1}
    assert {r["metric"]: r["value"] for r in M.view_stats(df, M.build_view(df, chars=80)).collect()}["messages"] == 2


def test_extract_text_of_every_row(spark, tmp_path):
    """Held against the plain rules, also for nulls and for texts that look like JSON."""
    from mnemoweave.plans.texts import extract_text

    texts = ["plain", None, "", "a \\ b", 'say "x"', "{not json", "[1, 2", ' {"text": "in"} \n', '{"no": 1}', "[1, 2]", "{}", '{"text": "q\\"\\u00e9"}', "end \n\t ", '{"text": null}']
    rows = [(i, t) for i, t in enumerate(texts * 3)]  # 14 texts: each meets every kind
    spark.createDataFrame(rows, "seq long, text string").write.parquet(str(tmp_path / "messages.parquet"))

    def parsed(p):
        try:
            x = json.loads(p)
        except ValueError:
            return p
        return x if isinstance(x, (dict, list)) else p

    def plain(seq, text):
        parts = [parsed(p) for p in ("a", '{"text":"b"}', text) if p is not None]
        strings = [p for p in parts if isinstance(p, str)]
        mixed = [p if isinstance(p, str) else p["text"] for p in parts if isinstance(p, str) or isinstance(p, dict) and isinstance(p.get("text"), str)]
        return ("\n".join(strings).rstrip(), "\n".join(mixed).rstrip(), "")[seq % 3]

    assert {r["seq"]: r["text"] for r in extract_text(spark, str(tmp_path)).collect()} == {i: plain(i, t) for i, t in rows}
