"""Filling containers of fixed capacity: minimum bin slack over the histogram of sizes.

Which item of a size goes where doesn't matter for the unused space, so the packing is done on the number of items
of each size (at most `capacity` entries, whatever the input), and its patterns are laid over the items by their rank
within their size. Only those two bounded tables leave the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mnemoweave.llm.bpe import encoder
from mnemoweave.session import checkpointed


def fullest(counts: list[int], sizes: list[int], capacity: int, first: int) -> dict[int, int]:
    """The fullest combination of available sizes that holds one `first`: size -> number.

    Bitset subset-sum: bit s of `reach` says that sum s can be made. Sizes enter in descending order, each as binary
    multiples of its number, until the capacity itself can be made; `trail` is walked backwards for the parts.
    """
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for s in sizes:
        if s > room:
            continue
        left = min(counts[s] - (s == first), room // s)
        step = 1
        while left > 0:
            m = min(step, left)
            left -= m
            step *= 2
            new = (reach | reach << (s * m)) & mask
            if new != reach:
                trail.append((s, m, reach))
                reach = new
                if reach >> room & 1:
                    break
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out = {first: 1}
    for s, m, before in reversed(trail):
        if not before >> total & 1:
            total -= s * m
            out[s] = out.get(s, 0) + m
    return out


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of containers, size -> items in each), in order. Sizes run from 1 to `capacity`.

    Each container takes the largest size left and the fullest combination beside it; as long as enough items of its
    sizes remain the same combination is the fullest again, so it is taken as often as they allow. Every pattern ends a
    size or halves one at least, so there are O(capacity log n) of them.
    """
    counts = [0] * (capacity + 1)
    for s, n in histogram.items():
        if not 1 <= s <= capacity:
            raise ValueError(f"size {s} doesn't fit {capacity}")
        counts[s] = n
    sizes = [s for s in range(capacity, 0, -1) if counts[s]]
    out = []
    while sizes:
        combination = fullest(counts, sizes, capacity, sizes[0])
        times = min(counts[s] // m for s, m in combination.items())
        for s, m in combination.items():
            counts[s] -= times * m
        out.append((times, combination))
        sizes = [s for s in sizes if counts[s]]
    return out


def pieces(documents: DataFrame, capacity: int, path: str | None = None) -> DataFrame:
    """(doc_id, piece_no, n_tokens, start_token): whole documents, and the cuts of those above the capacity.

    Sizes are in ids of the tokenizer. Null and empty texts are one piece of size 0.
    """
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("piece_no", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("start_token", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = np.array([len(enc.encode(t)) for t in b.column(1).to_pylist()], np.int64)
            k = np.maximum(1, -(-n // capacity))
            row = np.repeat(np.arange(len(n)), k)
            no = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            size = np.minimum(capacity, n[row] - no * capacity)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array(no, pa.int32()), pa.array(size, pa.int32()), pa.array(no * capacity, pa.int32())],
                ["doc_id", "piece_no", "n_tokens", "start_token"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int, size: str = "n_tokens", key: tuple[str, ...] = ("doc_id", "piece_no"), shards: int = 64) -> DataFrame:
    """items with `container_id`; the sizes in one container add up to `capacity` at most.

    Items of size 0 (or null) fit anywhere and are spread evenly over the containers; if there are no others, they are
    in container 0. Repeated items are packed once each. An empty table gives an empty result. Sizes outside
    0..capacity are an error: cut the items first (:func:`pieces`). `items` is read twice, so cut its lineage before.

    The rank of an item within its size needs no task that holds the size: it is its rank within (size, shard), a
    shard being a hash of the key, plus the shards before. `shards` x `capacity` bounds that table.
    """
    spark = items.sparkSession
    n = F.coalesce(F.col(size), F.lit(0)).cast("int")
    placed = items.withColumn("__n", n).withColumn("__shard", F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int"))
    # at most (capacity + 1) x shards rows, whatever the input
    table = placed.groupBy("__n", "__shard").count().toPandas().sort_values(["__n", "__shard"])
    table["__before"] = table.groupby("__n")["count"].cumsum() - table["count"]
    histogram = {int(s): int(c) for s, c in table.groupby("__n")["count"].sum().items()}
    zero = histogram.pop(0, 0)
    patterns = minimum_bin_slack(histogram, capacity)
    bins = sum(t for t, _ in patterns)
    laid: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = {}
    first = 0
    for times, combination in patterns:
        for s, m in combination.items():
            laid.append((s, used.get(s, 0), used.get(s, 0) + times * m, m, first))
            used[s] = used.get(s, 0) + times * m
        first += times
    if zero:
        laid.append((0, 0, zero, max(1, -(-zero // max(1, bins))), 0))
    start_df = spark.createDataFrame(table[["__n", "__shard", "__before"]].astype("int64"), "__n int, __shard int, __before long")
    segments = spark.createDataFrame(laid, "__n int, __from long, __to long, __each int, __first long").groupBy("__n").agg(F.sort_array(F.collect_list(F.struct("__from", "__to", "__each", "__first"))).alias("__segments"))
    rank = F.row_number().over(Window.partitionBy("__n", "__shard").orderBy(*key)) - 1
    ranked = placed.withColumn("__r", rank).join(F.broadcast(start_df), ["__n", "__shard"]).withColumn("__r", F.col("__r") + F.col("__before"))
    hit = F.filter("__segments", lambda x: (x["__from"] <= F.col("__r")) & (F.col("__r") < x["__to"]))[0]
    return (
        ranked.join(F.broadcast(segments), "__n")
        .withColumn("__hit", hit)
        .withColumn("container_id", (F.col("__hit.__first") + F.floor((F.col("__r") - F.col("__hit.__from")) / F.col("__hit.__each"))).cast("long"))
        .select(*items.columns, "container_id")
    )


def packed_documents(documents: DataFrame, size_limits: DataFrame, path: str | None = None, kind: str = "container") -> DataFrame:
    """(doc_id, piece_no, start_token, n_tokens, container_id) for every document; only texts above the capacity are cut."""
    capacity = size_limits.where(F.col("item_kind") == kind).agg(F.max("max_tokens")).first()[0]
    if capacity is None:
        raise ValueError(f"no limit for {kind}")
    return pack(checkpointed(pieces(documents, capacity, path)), capacity).select("doc_id", "piece_no", "start_token", "n_tokens", "container_id")
