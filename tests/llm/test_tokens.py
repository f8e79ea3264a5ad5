"""Encoding and packing against independent versions."""

from __future__ import annotations

import base64
import random

import pytest
from pyspark.sql import functions as F

from mnemoweave.llm.bpe import decode, encode, encoder
from mnemoweave.llm.packing import fullest, minimum_bin_slack, pack, packed_documents

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(spark, reference):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r[0]]
    rng = random.Random(3)
    texts += ["", " ", "<|endoftext|>", "a" * 5000, "ab" * 3001, "​﻿ 日本語🙂🙂", "".join(chr(rng.randrange(1, 0x3000)) for _ in range(4000)), " " * 999 + "x"]
    e = encoder()
    for t in texts:
        assert e.encode(t) == reference.encode_ordinary(t)
        assert decode(e.encode(t)) == t


def test_null_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "hello", "z"), (3, "hello", "z")], "doc_id long, text string, ids string")
    rows = sorted(encode(df).collect())
    assert [r["ids"] for r in rows] == [[], [], encoder().encode("hello"), encoder().encode("hello")]
    assert encode(df.limit(0)).count() == 0


def test_fullest_is_exact():
    rng = random.Random(1)
    for _ in range(300):
        cap = rng.randrange(5, 40)
        counts = [0] * (cap + 1)
        for _ in range(rng.randrange(1, 9)):
            counts[rng.randrange(1, cap + 1)] += rng.randrange(1, 4)
        sizes = [s for s in range(cap, 0, -1) if counts[s]]
        got = fullest(counts, sizes, cap, sizes[0])
        assert all(counts[s] >= m for s, m in got.items()) and got[sizes[0]] >= 1
        left = counts[:]
        left[sizes[0]] -= 1
        sums = {sizes[0]}
        for s in sizes:
            for _ in range(left[s]):
                sums |= {x + s for x in sums if x + s <= cap}
        assert sum(s * m for s, m in got.items()) == max(sums)


def test_packing_uses_every_item_once():
    rng = random.Random(2)
    h = {rng.randrange(1, 2049): rng.randrange(1, 900) for _ in range(400)}
    used: dict[int, int] = {}
    for times, c in minimum_bin_slack(h, 2048):
        assert sum(s * m for s, m in c.items()) <= 2048
        for s, m in c.items():
            used[s] = used.get(s, 0) + times * m
    assert used == h


def test_pack(spark):
    rows = [(i, 0, (i * 37) % 101) for i in range(3000)] + [(7, 0, None), (8, 0, 0), (8, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, piece_no int, n_tokens int").withColumn("extra", F.lit("e"))
    out = pack(df, 100, shards=8).collect()
    assert len(out) == len(rows)
    fill: dict[int, int] = {}
    for r in out:
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + (r["n_tokens"] or 0)
    assert max(fill.values()) <= 100
    assert len(fill) == -(-sum(fill.values()) // 100)  # the least possible number
    assert pack(df.limit(0), 100).count() == 0
    assert {r[0] for r in pack(df.where("coalesce(n_tokens, 0) = 0"), 100).select("container_id").collect()} == {0}


def test_documents(spark, reference):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").unionByName(spark.createDataFrame([(10**9, "word " * 9000, None, None, 0, None, None)], "doc_id long, text string, lang string, source string, n_chars int, kind string, created_at timestamp"))
    out = packed_documents(docs, spark.read.parquet(f"{d}/size_limits.parquet")).collect()
    size = {r["doc_id"]: len(reference.encode_ordinary(r["text"] or "")) for r in docs.collect()}
    got: dict[int, int] = {}
    fill: dict[int, int] = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
        assert size[r["doc_id"]] > 2048 or r["piece_no"] == 0
    assert got == size and max(fill.values()) <= 2048
