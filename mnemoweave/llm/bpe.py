"""Byte-level BPE encoding with a segment tree over adjacent pair ranks."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rank of a pair that no merge joins.
_NONE = 1 << 62
#: Words kept per worker with their ids; when full, the memory starts afresh.
MEMO_WORDS = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, which is also the merge's rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token.

    Leaves of the segment tree are the adjacent pairs, ordered by position; a leaf holds rank << 32 | position, so
    the root is the leftmost pair of the lowest rank. Each merge updates three leaves: O(log n).
    """
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; a part's successor starts there
    prev = list(range(-1, n - 1))
    size = 1
    while size < n - 1:
        size *= 2
    tree = [_NONE] * (2 * size)
    get = ranks.get

    def leaf(i: int) -> int:
        j = end[i]
        if j >= n:
            return _NONE
        r = get(word[i : end[j]])
        return _NONE if r is None else r << 32 | i

    for i in range(n - 1):
        tree[size + i] = leaf(i)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            m = a if a < b else b
            if tree[k] == m:
                break
            tree[k] = m
            k >>= 1

    while (root := tree[1]) != _NONE:
        i = root & 0xFFFFFFFF
        j = end[i]
        end[i] = after = end[j]
        if after < n:
            prev[after] = i
        if j < n - 1:
            put(j, _NONE)
        put(i, leaf(i))
        if (p := prev[i]) >= 0:
            put(p, leaf(p))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Text -> ids. No special token is added or recognised."""

    def __init__(self, path: str | None = None, pattern: str | None = None):
        if path is None or pattern is None:
            import public_tokenizers as P

            path, pattern = path or P.path("byte_bpe_50k.tiktoken"), pattern or P.PATTERN
        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        ids = merge_word(w.encode("utf-8", "replace"), self.ranks)
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        if len(w) < 200:
            self.memo[w] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        get, out = self.memo.get, []
        for w in self.split(text):
            out += get(w) or self.word(w)
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str | None = None, pattern: str | None = None) -> Encoder:
    """The worker's encoder for these files, read once."""
    if (e := _ENCODERS.get((path, pattern))) is None:
        e = _ENCODERS[path, pattern] = Encoder(path, pattern)
    return e


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, pattern: str | None = None, count_only: bool = False) -> DataFrame:
    """df with the column `out`: each text's ids (or their number).

    Null and empty texts have an empty list (number 0). Other columns, whatever their names, are carried along; a
    column already called `out` is replaced. No shuffle: one Arrow pass beside the scan. ``path`` and ``pattern``
    name the tokenizer's rank file and its pre-tokenizing pattern; by default those of byte_bpe_50k.
    """
    kept = [c for c in df.columns if c != out]
    kind = T.IntegerType() if count_only else T.ArrayType(T.IntegerType(), False)
    place = df.columns.index(text)
    names = [f"c{i}" for i in range(len(df.columns))]
    keep = [i for i, c in enumerate(df.columns) if c != out]
    schema = T.StructType([T.StructField(f"c{i}", df.schema[i].dataType) for i in keep] + [T.StructField("ids", kind, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            lists = [enc.encode(t) for t in b.column(place).to_pylist()]
            n = np.fromiter(map(len, lists), np.int32, len(lists))
            if count_only:
                ids = pa.array(n)
            else:
                off = np.zeros(len(lists) + 1, np.int32)
                np.cumsum(n, out=off[1:])
                flat = np.fromiter((x for ids in lists for x in ids), np.int32, int(off[-1]))
                ids = pa.ListArray.from_arrays(pa.array(off), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], ids], [*[f"c{i}" for i in keep], "ids"])

    done = df.toDF(*names).mapInArrow(run, schema)
    return done.toDF(*kept, out)


def decode(ids: list[int], path: str | None = None) -> str:
    """The text of some ids."""
    e = encoder(path)
    if not hasattr(e, "back"):
        e.back = {v: k for k, v in e.ranks.items()}
    return b"".join(e.back[i] for i in ids).decode("utf-8", "replace")


def encoded_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every document."""
    return encode(documents.select("doc_id", "text"), path=path).select("doc_id", F.col("ids"))
