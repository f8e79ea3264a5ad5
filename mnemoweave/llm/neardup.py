"""Near-duplicate sets of words by the generalised pigeonhole principle.

Two sets of a and b words whose Jaccard similarity is t at least differ in H <= (a + b)(1 - t)/(1 + t) words. The
words are the bits of a vector, split over m partitions; if thresholds ``T_i >= -1`` satisfy ``sum(T_i + 1) = H + 1``,
some partition differs in T_i words at most. T_i = -1 leaves a partition out, 0 asks for equal words in it, 1 and 2 for so many
words more or less: keys are made with up to two words left out, on both sides. Each record allots its own thresholds by dynamic programming on the estimated number of candidates
per partition, so partitions full of frequent words are left out and rare ones pay for them. Words that occur
together in a sample are put into the same partition, so that the others remain independent. A record whose words lie in
too few partitions for its threshold is probed with each of its rarest words as a partition of its own. Candidates pass a
bit signature's lower bound of the difference, and are verified on their words. All joins are sort-merge joins: no table
that grows with the data is collected for a broadcast.

Records are first folded to one per (group, set of words), so copies are never compared with one another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnemoweave.session import checkpointed

WORD = re.compile(r"[^\W_]+")
#: Width of the table of estimated key counts: the only thing about keys that reaches the driver (2 MB).
SKETCH = 1 << 18
#: Rows of the index under one key that one task shall meet: keys with more of them are split by salt.
HOT = 20_000
#: Parts of each word's rows for the records that are probed word by word.
WORD_SALTS = 16
#: Partitions per word of a class' mean size.
DENSITY = 0.3
#: Correlated words that are put into one partition: more would leave a record too few partitions for its threshold.
TOGETHER = 2
#: Rows from which correlated words are learnt; it changes the cost only, never the result.
SAMPLE = 2000
#: Words known to the correlation, the most frequent of the sample.
KNOWN = 512


def words_of(text: str | None) -> list[str]:
    """The distinct runs of letters and digits in the lower-cased text, sorted."""
    return sorted(set(WORD.findall(text.lower()))) if text else []


def _h(s: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(s, seed)


_MASK = (1 << 64) - 1
#: Added to a key once for each word that the index leaves out, so that a probe meets no others than it asks for.
_OUT = 0xD6E8FEB86659FD93


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(SKETCH - 1)).astype(np.int64)


def size_class(n: int, t: float) -> int:
    """Sizes within a ratio of t fall into the same or neighbouring classes (integers only, so exact)."""
    c, edge = 0, 1.0
    while n > edge + 1e-9:
        edge /= t
        c += 1
    return c


def partitions_of_class(c: int, t: float) -> int:
    return max(2, round(DENSITY * (1 / t) ** (c - 0.5)))


def correlated_groups(sets: list[frozenset], limit: int = KNOWN) -> dict[str, int]:
    """word -> group for the sample's frequent words; a group holds up to ``TOGETHER`` words that mostly come together."""
    df: dict[str, int] = {}
    for s in sets:
        for w in s:
            df[w] = df.get(w, 0) + 1
    known = [w for w, n in sorted(df.items(), key=lambda x: (-x[1], x[0])) if n >= 3][:limit]
    if not known:
        return {}
    at = {w: i for i, w in enumerate(known)}
    m = np.zeros((len(sets), len(known)), np.float32)
    for r, s in enumerate(sets):
        for w in s:
            if w in at:
                m[r, at[w]] = 1
    together = m.T @ m
    single = np.diag(together).copy()
    likeness = together / np.maximum(1, np.minimum.outer(single, single))
    even = together / np.maximum(1, np.maximum.outer(single, single))
    group: dict[str, int] = {}
    for i, w in enumerate(known):
        if w in group:
            continue
        g = len(group)
        mates = [j for j in range(i, len(known)) if likeness[i, j] > 0.8 and even[i, j] > 0.6 and known[j] not in group]
        for j in mates[:TOGETHER]:
            group[known[j]] = g
    return group


def allot(need: int, costs: list[tuple[int, list[float]]]) -> dict[int, int] | None:
    """Partition -> units (T + 1) summing up to `need` at least, at the least cost; None if they can't.

    `costs` has per partition the cost of one unit, of two, ...
    """
    if sum(len(c) for _, c in costs) < need:
        return None
    best = np.full(need + 1, np.inf)
    best[0] = 0
    took = []
    for _, cs in costs:
        # row u: u units from this partition; a surplus counts as what is needed
        rows = np.full((len(cs) + 1, need + 1), np.inf)
        rows[0] = best
        for u, c in enumerate(cs, 1):
            rows[u, min(u, need) :] = best[: need + 1 - min(u, need)] + c
            rows[u, 1 : min(u, need)] = best[0] + c
        took.append(rows.argmin(0))
        best = rows.min(0)
    out, left = {}, need
    for (p, _), tk in zip(reversed(costs), reversed(took), strict=True):
        if u := int(tk[left]):
            out[p] = u
            left = max(0, left - u)
    return out


class Keys:
    """Partition keys of a set of words in a class."""

    def __init__(self, t: float, groups: dict[str, int]):
        self.t, self.groups, self.memo = t, groups, {}

    def hash(self, w: str) -> tuple[int, int]:
        """(the word's own hash, the hash that places it in a partition)."""
        if (x := self.memo.get(w)) is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            g = self.groups.get(w)
            x = self.memo[w] = (_h(w), _h(w, 7) if g is None else _h(f"group {g}", 7))
        return x

    def partitions(self, group: str, words: list[str], c: int) -> dict[int, list[list[int]]]:
        """partition -> keys of its words, keys with one of them left out, keys with two; some word is always left."""
        m = partitions_of_class(c, self.t)
        base = _h(f"{group}\0{c}", 3)
        inside: dict[int, list[int]] = {}
        for w in words:
            own, place = self.hash(w)
            inside.setdefault(place % m, []).append(own)
        out = {}
        for p, hs in inside.items():
            # a set's key: a sum of mixed hashes, so leaving one out is a subtraction
            mixed = [((h ^ h >> 31) * 0xBF58476D1CE4E5B9) & _MASK for h in hs]
            full = base + (p + 1) * 0x9E3779B97F4A7C15 + sum(mixed)
            keys = [[full & _MASK]]
            if len(hs) > 1:
                keys.append([(full - x) & _MASK for x in mixed])
            if len(hs) > 2:
                keys.append([(full - x - y) & _MASK for x, y in combinations(mixed, 2)])
            out[p] = keys
        return out


def with_signature(sets: DataFrame) -> DataFrame:
    """sets with s0 and s1, 128 bits of their words: differing bits never outnumber differing words."""
    placed = sets.withColumn("__h", F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(128)).cast("int")))
    half = "aggregate(filter(__h, x -> {}), 0L, (a, x) -> a | shiftleft(1L, x % 64))"
    return placed.withColumn("s0", F.expr(half.format("x < 64"))).withColumn("s1", F.expr(half.format("x >= 64"))).drop("__h")


def records(df: DataFrame, key: str, group: str, text: str) -> DataFrame:
    """(key, grp, words) of each row; grp is the part of the category before the first dot, folded. One pass, no shuffle."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            g = [None if not isinstance(x, str) else x.strip().lower().split(".")[0].strip() for x in b["g"]]
            yield pd.DataFrame({"id": b["id"], "grp": g, "words": [words_of(x if isinstance(x, str) else None) for x in b["t"]]})

    return df.select(F.col(key).alias("id"), F.col(group).alias("g"), F.col(text).alias("t")).mapInPandas(run, f"id {kind}, grp string, words array<string>")


def similar_sets(sets: DataFrame, t: float = 0.6) -> DataFrame:
    """(rep_a, rep_b, common, either) of all pairs of `sets` (rep, grp, words; words distinct and not empty) in one group
    with |common| >= t |union|.

    `sets` is read several times: cut its lineage before.
    """
    share = min(1.0, 1.2 * SAMPLE / max(1, sets.count()))
    some = sets.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < int(share * 1_000_000)).orderBy(F.xxhash64("rep")).limit(SAMPLE)
    sample = [frozenset(r[0]) for r in some.select("words").collect()]
    groups = correlated_groups(sample)
    rep = sets.schema["rep"].dataType.simpleString()
    signed = with_signature(sets.select("rep", "grp", "words"))

    def index_keys(ks: Keys, g: str, ws: list[str]) -> list[int]:
        c = size_class(len(ws), t)
        return [k + out * _OUT & _MASK for cc in (c, c + 1) for levels in ks.partitions(g, ws, cc).values() for out, keys in enumerate(levels) for k in keys]

    def keys_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ks = Keys(t, groups)
        for b in batches:
            n = np.zeros(SKETCH, np.int64)
            for g, ws in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                np.add.at(n, _slots(np.array(index_keys(ks, g, ws), np.uint64)), 1)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["slot", "n"])

    counted = sets.select("grp", "words").mapInArrow(keys_only, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    sketch = np.zeros(SKETCH, np.int64)
    sketch[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(sketch)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ks, salts = Keys(t, groups), shared.value // HOT + 1
        for b in batches:
            key, many, sizes = [], [], []
            for g, ws in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                own = index_keys(ks, g, ws)
                key += own
                many.append(len(own))
                sizes.append(len(ws))
            k, row = np.array(key, np.uint64), np.repeat(np.arange(len(many)), many)
            salt, at = b.column(5).to_numpy()[row] % salts[_slots(k)], pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.view(np.int64)), pa.array(salt.astype(np.int32)), b.column(0).take(at), pa.array(sizes, pa.int32()).take(at), b.column(3).take(at), b.column(4).take(at)],
                ["key", "salt", "rep", "n", "s0", "s1"],
            )

    spread_by = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)).alias("by")
    entries = signed.select("rep", "grp", "words", "s0", "s1", spread_by).mapInArrow(index, f"key long, salt int, rep {rep}, n int, s0 long, s1 long")

    def probe_keys(ks: Keys, count: np.ndarray, g: str, ws: list[str]) -> list[int] | None:
        """The keys a record asks for by its own allotment; None if it has too few partitions."""
        parts = ks.partitions(g, ws, size_class(len(ws), t))
        levels = [keys for ls in parts.values() for keys in ls]
        k = np.array([x for keys in levels for x in keys], np.uint64)
        begins = np.cumsum([0, *map(len, levels[:-1])])
        # how many the index has of each level with none, one, two words left out there
        met = [np.add.reduceat(count[_slots(k + np.uint64(out * _OUT & _MASK))], begins) for out in range(3)]
        costs, at = [], 0
        for p, ls in parts.items():
            costs.append((p, [float(sum(met[out][at + i] for i in range(T + 1) for out in range(T + 1 - i))) for T in range(len(ls))]))
            at += len(ls)
        units_of = allot(int(2 * len(ws) * (1 - t) / (1 + t) + 1e-9) + 1, costs)
        if units_of is None:
            return None
        # what is left out here and there together must not exceed T = units - 1
        return [x + out * _OUT & _MASK for p, units in units_of.items() for i, keys in enumerate(parts[p][:units]) for out in range(units - i) for x in keys]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ks, count = Keys(t, groups), shared.value
        for b in batches:
            key, many, sizes, left = [], [], [], []
            for g, ws in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                own = probe_keys(ks, count, g, ws)
                left.append(own is None)
                key += own or [0]
                many.append(len(own or [0]))
                sizes.append(len(ws))
            k, row = np.array(key, np.uint64), np.repeat(np.arange(len(many)), many)
            copies = count[_slots(k)] // HOT + 1  # one for each salt of the key
            k, row = np.repeat(k, copies), np.repeat(row, copies)
            salt = np.arange(len(k)) - np.repeat(np.cumsum(copies) - copies, copies)
            at, null = pa.array(row, pa.int32()), np.array(left, bool)[row]  # a null key: its words are probed one by one
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.view(np.int64), mask=null), pa.array(salt.astype(np.int32)), b.column(0).take(at), pa.array(sizes, pa.int32()).take(at), b.column(3).take(at), b.column(4).take(at)],
                ["key", "salt", "rep_x", "n_x", "x0", "x1"],
            )

    probes = checkpointed(signed.select("rep", "grp", "words", "s0", "s1").mapInArrow(probe, f"key long, salt int, rep_x {rep}, n_x int, x0 long, x1 long"))
    differing = F.bit_count(F.col("s0").bitwiseXOR(F.col("x0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("x1")))
    near = (
        ((F.col("n") < F.col("n_x")) | ((F.col("n") == F.col("n_x")) & (F.col("rep") < F.col("rep_x"))))
        & (F.col("n") >= F.col("n_x") * t - 1e-9)
        & (differing <= (F.col("n") + F.col("n_x")) * ((1 - t) / (1 + t)) + 1e-9)
    )
    ends = ("rep_x", F.col("rep").alias("rep_y"))
    found = probes.where("key is not null").hint("merge").join(entries, ["key", "salt"]).where(near).select(*ends)
    # the rest: a partner of x has t |x| of its words, so one of any |x| - ceil(t |x|) + 1 of them; the rarest are taken
    rest = probes.where("key is null").select(F.col("rep_x").alias("rep")).distinct().hint("merge").join(signed, "rep")
    rest_words = rest.select(F.col("rep").alias("rep_x"), "grp", F.size("words").alias("n_x"), F.col("s0").alias("x0"), F.col("s1").alias("x1"), F.explode("words").alias("w"))
    word_counts = sets.select("grp", F.explode("words").alias("w")).groupBy("grp", "w").agg(F.count("*").alias("df"))
    by_rarity = Window.partitionBy("rep_x").orderBy("df", "w")  # the words of one record
    rare = (
        rest_words.hint("merge").join(word_counts, ["grp", "w"]).withColumn("__k", F.row_number().over(by_rarity))
        .where(F.col("__k") <= F.col("n_x") - F.ceil(F.col("n_x") * t - 1e-9) + 1)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(WORD_SALTS - 1))))
    )
    by_word = signed.select("rep", "grp", F.size("words").alias("n"), "s0", "s1", F.pmod(F.xxhash64("rep"), F.lit(WORD_SALTS)).cast("int").alias("salt"), F.explode("words").alias("w"))
    more = rare.hint("merge").join(by_word, ["grp", "w", "salt"]).where(near).select(*ends)
    pairs = found.unionByName(more).distinct()
    words = sets.select("rep", "words")
    one = words.select(F.col("rep").alias("rep_x"), F.col("words").alias("wx"))
    other = words.select(F.col("rep").alias("rep_y"), F.col("words").alias("wy"))
    both = pairs.hint("merge").join(one, "rep_x").hint("merge").join(other, "rep_y")
    common, either = F.size(F.array_intersect("wx", "wy")), F.size("wx") + F.size("wy") - F.col("common")
    return (
        both.withColumn("common", common).withColumn("either", either)
        .where(F.col("common") >= F.col("either") * t - 1e-9)
        .select(F.least("rep_x", "rep_y").alias("rep_a"), F.greatest("rep_x", "rep_y").alias("rep_b"), "common", "either")
    )


def near_duplicates(df: DataFrame, key: str = "fact_id", group: str = "category", text: str = "fact_text", t: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """(pairs of class representatives, membership: id, rep).

    A class holds the rows of one group with the same words. Rows without words (null, empty, punctuation only) are
    similar to nothing and are the only member of no pair. Rows without group (null) belong to none. Repeated rows of one
    key count once. `key` must be orderable.
    """
    sets = records(df.where(F.col(key).isNotNull()), key, group, text).where("grp is not null and size(words) > 0").withColumn("__w", F.xxhash64("words"))
    # map-side partial minimum: a class with a third of all rows is folded before the shuffle
    member = checkpointed(sets.distinct())
    reps = checkpointed(member.groupBy("grp", "__w", "words").agg(F.min("id").alias("rep")).select("rep", "grp", "words", "__w"))
    member = member.join(reps.select("grp", "__w", "words", "rep").hint("merge"), ["grp", "__w", "words"]).select("id", "rep")
    return similar_sets(reps.select("rep", "grp", "words"), t), member


def all_pairs(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """Every pair of rows, copies expanded: (id_a, id_b), smaller id first. Only for results that are defined as such."""
    a = member.select(F.col("id").alias("i"), F.col("rep").alias("rep_a"))
    b = member.select(F.col("id").alias("j"), F.col("rep").alias("rep_b"))
    across = pairs.select("rep_a", "rep_b").hint("merge").join(a, "rep_a").hint("merge").join(b, "rep_b").select("i", "j")
    # copies: only classes of two members and more
    several = member.join(member.groupBy("rep").count().where("count > 1").select("rep").hint("merge"), "rep").select("id", "rep")
    within = several.select(F.col("id").alias("i"), "rep").hint("merge").join(several.select(F.col("id").alias("j"), "rep"), "rep").where("i < j").select("i", "j")
    return across.unionByName(within).select(F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"))


def classes_with_links(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """(id, rep, links): the row's class and its number of similar classes."""
    ends = pairs.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    return member.join(ends.hint("merge"), "rep", "left").select("id", "rep", F.coalesce("links", F.lit(0)).alias("links"))
