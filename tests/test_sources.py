"""Sources, snapshots and the stream."""

from __future__ import annotations

import json

import pytest

from mnemoweave.sources import jsonl, snapshots
from mnemoweave.streaming.ingest import Refused, decide_batch, late_messages, merge_batch, stream_claims
from tests.test_store import SCHEMA, claim


def test_array(spark, tmp_path):
    objects = [{"id": i, "t": 'a"}],\n{[' * (i % 3), "n": {"x": [1, {"y": "é\\"}]}} for i in range(200)]
    p = tmp_path / "e.json"
    p.write_text("[" + ",\n".join(json.dumps(o, ensure_ascii=False) for o in objects) + "]")
    for split in (1 << 20, 700, 97):
        got = [json.loads(r[0]) for r in jsonl.export(spark, str(p), split).collect()]
        assert sorted(g["id"] for g in got) == list(range(200)) and all(g == objects[g["id"]] for g in got)
    p.write_text("\n [{}, ,{} {}]")
    assert jsonl.export(spark, str(p)).count() == 3
    p.write_text("{}")
    with pytest.raises(Exception, match="no JSON array"):
        jsonl.export(spark, str(p)).count()


def test_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"conv_id": "c", "text": "x", "more": 1}\r\n\n{"conv_id": "d"}\n')
    m = jsonl.messages(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["seq"], r["conv_id"], r["text"]) for r in m] == [(1, "c", "x"), (3, "d", None)] and json.loads(m[0]["raw"])["more"] == 1
    (tmp_path / "b.jsonl").write_text("oops\n")
    assert jsonl.messages(spark, str(tmp_path), skip_invalid=True).count() == 2
    with pytest.raises(Exception, match="no JSON object"):
        jsonl.messages(spark, str(tmp_path)).collect()


def test_claims_and_actions(spark, tmp_path):
    (tmp_path / "claims").mkdir()
    (tmp_path / "claims/claims_chunk_10001.jsonl").write_text("{}\n```\n")
    (tmp_path / "claims/other.jsonl").write_text("{}\n")
    assert [(r["chunk_id"], r["line_no"], r["format"]) for r in jsonl.claim_lines(spark, str(tmp_path)).orderBy("line_no").collect()] == [("chunk_10001", 1, "ok"), ("chunk_10001", 2, "code_fence")]
    p = tmp_path / "act.jsonl"
    p.write_text('{"fact_id": "f", "action": "accept"}\n{"fact_id": "g", "action": " "}\n')
    assert [r["fact_id"] for r in jsonl.review_actions(spark, str(p)).collect()] == ["f"]
    p.write_text('{"action": "accept"}\n')
    with pytest.raises(Exception, match="no fact_id"):
        jsonl.review_actions(spark, str(p)).collect()


def test_store_and_stream(spark, tmp_path):
    store = snapshots.Store(spark, str(tmp_path / "store"))
    assert store.current() is None and store.read("facts") is None and not store.has("facts")
    a = spark.createDataFrame([claim(1), claim(2, fact="other"), claim(3, category="identity.name", fact="Old", time=(5.0,))], SCHEMA)
    assert merge_batch(store, a) == {"claims_new": 3, "facts_inserted": 3, "facts_updated": 0, "flags": 0, "reopened": 0}
    before = {r["fact_text"]: r for r in store.read("facts").collect()}
    assert merge_batch(store, a)["claims_new"] == 0
    assert {r["fact_text"]: (r["status"], r["last_seen_ts"]) for r in store.read("facts").collect()} == {k: (r["status"], r["last_seen_ts"]) for k, r in before.items()}
    with pytest.raises(RuntimeError):
        store.write({"facts": a}, expected="another")
    # a person's decision stays, whatever comes later
    acts = spark.createDataFrame([(1, before["other"]["fact_id"], "reject", "x.jsonl", 1)], "seq long, fact_id string, action string, source_path string, source_line long")
    assert decide_batch(store, acts, 100.0) == 1 and decide_batch(store, acts, 200.0) == 0
    assert [r["decided_at"] for r in store.read("reviews").collect()] == [100.0]
    src = tmp_path / "src"
    rows = [claim(4, fact="third"), claim(5, fact="other", time=(9.0,)), claim(6, category="identity.name", fact="New", time=(7.0,), file_no=2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(src))
    q = stream_claims(spark, spark.readStream.schema(SCHEMA).parquet(str(src)), str(tmp_path / "store"), str(tmp_path / "cp"))
    q.awaitTermination(300)
    got = {r["fact_text"]: (r["status"], r["last_seen_ts"]) for r in store.read("facts").collect()}
    assert got == {"a fact": ("accepted", 1.0), "other": ("rejected", 9.0), "third": ("accepted", 1.0), "Old": ("superseded", 5.0), "New": ("accepted", 7.0)}
    # later evidence reopens it if the merge is told its time
    more = spark.createDataFrame([claim(7, fact="other", time=(11.0,))], SCHEMA)
    assert merge_batch(store, more, imported_at=300.0)["reopened"] == 1
    assert {r["fact_text"]: r["status"] for r in store.read("facts").collect()}["other"] == "needs_review"


def test_refusals(spark, tmp_path):
    """A refused batch leaves the store as it was."""
    store = snapshots.Store(spark, str(tmp_path / "store"))
    store.bootstrap(version="1")
    at = store.current()
    assert store.bootstrap(version="2") == at and [tuple(r) for r in store.read("meta").collect()] == [("version", "1")]
    good, secret, short = claim(1), claim(2, notes="sk-abcdefghijklmnop"), claim(3, stability=None)
    for rows in ([good, secret], [good, short]):
        with pytest.raises(Refused):
            merge_batch(store, spark.createDataFrame(rows, SCHEMA))
    bad = spark.createDataFrame([("error",)], "level string")
    with pytest.raises(Refused, match="validation"):
        merge_batch(store, spark.createDataFrame([good], SCHEMA), issues=bad)
    assert store.current() == at and store.read("facts").count() == 0
    merge_batch(store, spark.createDataFrame([good], SCHEMA), issues=bad.limit(0))
    assert store.read("facts").count() == 1


def test_pointers(spark, tmp_path):
    """The store is never without a pointer, and a writer that comes second is refused."""
    one = snapshots.Store(spark, str(tmp_path / "store"))
    df = spark.range(3)
    first = one.write({"t": df})
    one.write({"t": spark.range(4)})
    names = sorted(p.name for p in (tmp_path / "store/pointers").iterdir() if not p.name.startswith("."))
    assert names == ["000000000001", "000000000002"] and one.read("t").count() == 4
    late = snapshots.Store(spark, str(tmp_path / "store"))
    late._pointer = lambda: (1, first)
    with pytest.raises(RuntimeError, match="another writer"):
        late.write({"t": df})
    assert one.read("t").count() == 4


def test_lines_in_ranges(spark, tmp_path):
    """Line numbers are those of the file however many tasks read it."""
    lines = [f"{i} " + "x" * (i % 70) for i in range(3000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_text("\r\n".join(lines[:50]) + "\r\n")
    (tmp_path / "empty.txt").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        df = jsonl.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = sorted((r["path"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("a.txt", i + 1, x) for i, x in enumerate(lines)] + [("b.txt", i + 1, x) for i, x in enumerate(lines[:50])]


def test_claims_of_a_run(spark, tmp_path):
    (tmp_path / "claims").mkdir()
    (tmp_path / "claims/claims_chunk_0002.jsonl").write_text('{"fact": "b", "time": {"as_of_ts": 2}}\n')
    (tmp_path / "claims/claims_chunk_0001.jsonl").write_text('\n{"fact": "a"}\n')
    got = jsonl.claims(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["chunk_id"], r["fact"], r["file_no"], r["raw"]) for r in got] == [("chunk_0001", "a", 1, '{"fact": "a"}'), ("chunk_0002", "b", 2, '{"fact": "b", "time": {"as_of_ts": 2}}')]
    (tmp_path / "claims/claims_chunk_0003.jsonl").write_text("[1]\n")
    with pytest.raises(Exception, match="non_json_object_line"):
        jsonl.claims(spark, str(tmp_path)).collect()


def test_inputs(spark, tmp_path):
    import io

    with pytest.raises(FileNotFoundError):
        jsonl.default_input(spark, str(tmp_path))
    (tmp_path / "shared_conversations.json").write_text("[]")
    assert jsonl.default_input(spark, str(tmp_path)).endswith("/shared_conversations.json")
    (tmp_path / "conversations.json").write_text("[]")
    assert jsonl.default_input(spark, str(tmp_path)).endswith("/conversations.json")
    data = "é\n".encode() + b"a\xffb\xe2\x82"
    (tmp_path / "t.bin").write_bytes(data)
    assert [r["text"] for r in jsonl.whole_texts(spark, str(tmp_path / "t.bin")).collect()] == [data.decode("utf-8", "replace")]
    assert jsonl.whole_texts(spark, "-", io.BytesIO(data)).first()["text"] == data.decode("utf-8", "replace")


def test_prompts_and_validation(spark, tmp_path):
    p = spark.createDataFrame([("c1", "s1", "one\ntwo"), ("c2", "s2", "é")], "chunk_id string, sha256 string, prompt string")
    snapshots.write_prompts(p, str(tmp_path / "p"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "p/prompts/chunk_id=c1")).collect()] == ["one", "two"]
    assert [r["path"] for r in spark.read.json(str(tmp_path / "p/index")).collect()] == ["prompts/chunk_id=c1", "prompts/chunk_id=c2"]
    assert snapshots.read_validation(spark, str(tmp_path / "v")) is None
    issues = spark.createDataFrame([(1, "error", "x"), (1, "warning", "y"), (2, "error", "z")], "seq long, level string, code string")
    snapshots.write_validation(spark.createDataFrame([(1, 3)], "file_no int, parsed int"), issues, str(tmp_path / "v"))
    assert snapshots.read_validation(spark, str(tmp_path / "v")) == (2, 1)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None)], "seq int, text string, title string")
    snapshots.write_jsonl(df, str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o")).first()[0] == '{"seq":1,"text":"é","title":null}'
    with pytest.raises(Exception, match="exist"):
        snapshots.write_jsonl(df, str(tmp_path / "o"))
    snapshots.write_jsonl(df, str(tmp_path / "o"), overwrite=True)
    snapshots.write_chunks(spark.createDataFrame([("c1", 2, "b"), ("c1", 1, "a"), ("c2", 3, "c")], "chunk_id string, seq int, line string"), str(tmp_path / "k"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "k/chunk_id=c1")).collect()] == ["a", "b"]
    assert json.loads(snapshots.manifest(df.selectExpr("count(*) n"), limit=3)) == {"config": {"limit": 3}, "counts": {"n": 1}}


def test_late(spark, tmp_path):
    spark.createDataFrame([(1.7e9, "user"), (1.7e9 + 5, "user"), (None, "user")], "ts double, role string").write.parquet(str(tmp_path / "m"))
    q = late_messages(spark.readStream.schema("ts double, role string").parquet(str(tmp_path / "m"))).writeStream.format("memory").queryName("late").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("late").agg({"messages": "max"}).first()[0] == 2


def test_array_any_layout(tmp_path):
    """Whatever stands between the elements and however their insides are broken, ranges of any size give what one gives."""
    objects = [{"id": i, "t": 'a"}],\n{[\\' * (i % 3) + "\\\\" * (i % 5), "n": {"x": [{"y": "é\"}"}, {"z": i}]}} for i in range(40)]
    one = [json.dumps(o, ensure_ascii=False) for o in objects]
    broken = [json.dumps(o, ensure_ascii=False, indent=0) for o in objects]
    seps = [",\n", "\n", ", ", ",\r\n", ",\n\n", " ,, ", ""]
    mixed = "".join(x + seps[i % 7] for i, x in enumerate(one))
    for text in (f"[{mixed}]", "[" + ",\n".join(broken) + "]", "\n" * 300 + f" [{mixed}]\n", f"[{mixed}] [{{}}]"):
        p = tmp_path / "e.json"
        p.write_text(text)
        for split in (1 << 20, 700, 97, 13):
            reader = jsonl.JsonArrayReader({"path": str(p), "split_bytes": split})
            assert [json.loads(x) for part in reader.partitions() for (x,) in reader.read(part)] == objects
    p.write_text('[{"id": 1}]' + " " * 40 + "[{}] x")
    reader = jsonl.JsonArrayReader({"path": str(p), "split_bytes": 20})
    assert [x for part in reader.partitions() for (x,) in reader.read(part)] == ['{"id": 1}']


def test_export_any_layout(spark, tmp_path):
    p = tmp_path / "e.json"
    p.write_text("[" + "\n".join(json.dumps({"id": i, "n": [{"a": 1}, {"b": "}"}]}, indent=0) for i in range(60)) + "]")
    assert sorted(json.loads(r[0])["id"] for r in jsonl.export(spark, str(p), 500).collect()) == list(range(60))
