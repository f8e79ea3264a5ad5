"""Splitting oversized items at natural boundaries, by byte ranges.

An item is a sequence of parts (a message is one part, a chunk has one per message). In one pass beside the scan, each
text's bytes are gone through in ranges (with a halo, so that a boundary across an edge is seen); a range leaves the best
boundary it holds, so a text becomes a boundary table of some bytes per range, and texts themselves are never moved.
Lengths are summed up to offsets by blocks, so no task holds an item. Cut k is sought in the window
``(k * stride - reach, k * stride]`` of the item, whatever the other cuts are: the entries of the stitched tables in that
window compete. Two following cuts are ``stride + reach = limit - overlap`` bytes apart at most, so with its overlap no
piece exceeds the limit. Nothing is done item by item in order: an item of many parts is cut by all workers at once, and a
single text above ``SLICE`` bytes is gone through in slices with halos by all of them.

Positions are UTF-8 bytes; each part is padded to whole tokens of four bytes, as its size is rounded up. Six bytes of
the limit are kept for the rounding of the first and last fragment of a piece. Limits below ``LEAST_TOKENS`` are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnemoweave.session import checkpointed

#: Rows per block of the two-level sums.
BLOCK = 65_536
#: Bytes of a range: the largest, and the least unless windows are so small that every character's start is needed.
RANGE, LEAST_RANGE = 256, 8
#: Bytes from which a text is taken in slices, and those that a slice sees of the one before.
SLICE, HALO = 4 << 20, 4
#: The least limit: with its reserve for rounding it still holds any character.
LEAST_TOKENS = 3

# What ends a paragraph, a line, a sentence, a word. The next piece begins behind it.
_ENDS = (
    (4, (b"\n\n", b"\n\r\n")),
    (3, (b"\n",)),
    (2, (b". ", b"! ", b"? ", b"; ", ".\u3000".encode(), "\u3002".encode(), "\uff01".encode(), "\uff1f".encode())),
    (1, (b" ", b"\t", "\u3000".encode())),
)


def best_boundary(text: bytes, low: int, high: int) -> tuple[int, int] | None:
    """(level, position) of the best place in ``low < position <= high`` to begin the next piece.

    The strongest level wins, then the last place. Without any, the start of the last character (level 0); None if no
    character begins there.
    """
    for level, ends in _ENDS:
        at = max(i + len(e) if (i := text.rfind(e, max(0, low + 1 - len(e)), high)) >= 0 else -1 for e in ends)
        if at > low:
            return level, at
    at = high
    while at > low and at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return (0, at) if at > low else None


def slices(texts: DataFrame, size: int, before: int, after: int) -> DataFrame:
    """(part_no, __n, __j, __data): the bytes of each text in slices of `size`, slice j from ``j * size - before`` to
    ``(j + 1) * size + after``; __n is the text's length. Null and empty texts have none."""
    b, n = F.col("text").cast("binary"), F.octet_length("text")
    start = lambda j: F.greatest(j * size - before, F.lit(0))
    cut = lambda j: F.struct(j.alias("j"), F.substring(b, start(j) + 1, (j + 1) * size + after - start(j)).alias("data"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), cut)
    return texts.where(n > 0).select("part_no", n.alias("__n"), F.explode(parts).alias("s")).select("part_no", "__n", F.col("s.j").alias("__j"), F.col("s.data").alias("__data"))


def _entries(raw: bytes, first: int, last: int, skip: int, n: int, size: int) -> list[int]:
    """The table's entries of the bytes `first` to `last` of a text of `n` bytes; `raw` begins `skip` bytes before `first`, and
    goes on for a byte behind `last`."""
    found = (best_boundary(raw, at - first + skip, min(last, at + size) - first + skip) for at in range(first, last, size))
    places = ((x[0], x[1] - skip + first) for x in found if x)
    # the text's own end counts where padding follows
    return [level << 48 | at for level, at in places if at < n or n % 4]


def boundary_tables(texts: DataFrame, size: int = RANGE, slice_bytes: int = SLICE) -> DataFrame:
    """(part_no, __len, __bytes, __table) of (part_no, text): per range of `size` bytes level and position, as
    ``level << 48 | position``. Null and empty texts have length 0 and an empty table.

    Texts over `slice_bytes` are taken in slices with halos by all workers, and their tables are put together behind; the
    entries are the same.
    """
    kind = texts.schema["part_no"].dataType.simpleString()
    whole = slice_bytes // size * size  # ranges begin where those of the whole text do
    lasting = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = [t.encode("utf-8", "replace") if t else b"" for t in b.column(1).to_pylist()]
            tables = [_entries(r, 0, len(r), 0, len(r), size) for r in raws]
            sizes = [len(r) for r in raws]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([-(-n // 4) * 4 for n in sizes], pa.int64()), pa.array(sizes, pa.int64()), pa.array(tables, lasting)], ["part_no", "__len", "__bytes", "__table"])

    def run_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tables = []
            for n, j, raw in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                tables.append(_entries(raw, j * whole, min(n, (j + 1) * whole), min(HALO, j * whole), n, size))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(tables, lasting)], ["part_no", "__n", "__j", "__t"])

    short = texts.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= whole)
    done = short.select("part_no", "text").mapInArrow(run, f"part_no {kind}, __len long, __bytes long, __table array<long>")
    cut = slices(texts.where(F.octet_length("text") > whole), whole, HALO, 1).repartition("part_no", "__j")
    joined = (
        cut.mapInArrow(run_slices, f"part_no {kind}, __n int, __j int, __t array<long>").groupBy("part_no", "__n")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("__j", "__t"))), lambda x: x["__t"])).alias("__table"))
    )
    n = F.col("__n").cast("long")
    return done.unionByName(joined.select("part_no", (F.ceil(n / 4) * 4).alias("__len"), n.alias("__bytes"), "__table"))


def offsets(parts: DataFrame, item: list[str], order: str, length: str) -> DataFrame:
    """parts with ``__off``, the sum of the lengths before: sums of blocks of `order` first, then inside each block."""
    blocked = parts.withColumn("__block", F.floor(F.col(order) / BLOCK))
    sums = blocked.groupBy(*item, "__block").agg(F.sum(length).alias("__sum"))
    before = sums.withColumn("__base", F.coalesce(F.sum("__sum").over(Window.partitionBy(*item).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__sum")
    inside = Window.partitionBy(*item, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(before, [*item, "__block"])
        .withColumn("__off", F.col("__base") + F.coalesce(F.sum(length).over(inside), F.lit(0)))
        .drop("__block", "__base")
    )


def message_items(tables: DataFrame) -> DataFrame:
    """(item_kind, item_id, part_no, ...) of messages: one part each."""
    return tables.select(F.lit("message").alias("item_kind"), F.col("part_no").cast("string").alias("item_id"), "*")


def chunk_items(tables: DataFrame, chunk_meta: DataFrame, block: int = 1024) -> DataFrame:
    """(item_kind, item_id, part_no, ...): the messages of each chunk. Repeated chunk rows count once.

    A range join by blocks of `part_no`: each chunk is listed under the blocks it touches, so it is an equi-join.
    """
    ranges = chunk_meta.where("chunk_id is not null and first_seq <= last_seq").select("chunk_id", "first_seq", "last_seq").distinct()
    listed = ranges.withColumn("__b", F.explode(F.sequence(F.floor(F.col("first_seq") / block), F.floor(F.col("last_seq") / block))))
    return (
        tables.withColumn("__b", F.floor(F.col("part_no") / block))
        .join(listed, "__b")
        .where("part_no between first_seq and last_seq")
        .select(F.lit("chunk").alias("item_kind"), F.col("chunk_id").alias("item_id"), *tables.columns)
    )


def _measures(size_limits: DataFrame) -> DataFrame:
    """Per kind: the limit and the measures of its cuts. Kinds without a limit are left out."""
    limits = size_limits.where("max_tokens is not null").groupBy("item_kind").agg(F.min("max_tokens").alias("max_tokens"), F.coalesce(F.min("overlap_tokens"), F.lit(0)).alias("overlap_tokens"))
    # the overlap may be half of the limit at most, else pieces would hardly advance
    least = F.when(F.col("max_tokens") >= LEAST_TOKENS, F.col("max_tokens")).otherwise(F.raise_error(F.concat(F.lit(f"max_tokens must be {LEAST_TOKENS} at least: "), F.col("item_kind"))))
    room = least.cast("long") * 4 - 6
    over = F.least(F.greatest(F.col("overlap_tokens"), F.lit(0)) * 4, F.floor(room / 8) * 4)
    out = limits.withColumn("__over", over.cast("long")).withColumn("__step", (room - over).cast("long"))
    return out.withColumn("__reach", F.greatest(F.floor(F.col("__step") / 4), F.lit(4)).cast("long")).withColumn("__stride", F.col("__step") - F.col("__reach")).drop("overlap_tokens")


def range_size(size_limits: DataFrame) -> int:
    """Bytes per range such that the smallest window holds a whole one, so that none is without an entry. The limits' table has
    one row per kind."""
    least = _measures(size_limits).agg(F.min("__reach")).first()[0]
    least = least or RANGE
    return max(LEAST_RANGE, min(RANGE, least // 8)) if least >= 2 * LEAST_RANGE else 1


def _cut_points(parts: DataFrame) -> DataFrame:
    """(item_kind, item_id, k, cut, level) from parts with offsets, tables and the item's total."""
    off, end = F.col("__off"), F.col("__off") + F.col("__len")
    first = F.greatest(F.lit(1), F.floor(off / F.col("__stride")).cast("long"))
    last = F.least(F.floor((end + F.col("__reach")) / F.col("__stride")).cast("long"), F.col("__last_cut"))
    low = F.greatest(F.col("k") * F.col("__stride") - F.col("__reach"), off)
    high = F.least(F.col("k") * F.col("__stride"), end)
    place = F.pow(F.lit(2), F.lit(48)).cast("long")
    inside = F.array_max(F.transform(F.filter("__table", lambda x: (x % place + off > low) & (x % place + off <= high)), lambda x: F.struct(F.floor(x / place).cast("int").alias("level"), (x % place + off).alias("cut"))))
    # the part's own end is the strongest boundary; each range has an entry, so every window has one
    found = F.when(end <= F.col("k") * F.col("__stride"), F.struct(F.lit(5).alias("level"), end.alias("cut"))).otherwise(inside)
    return (
        parts.where(F.col("__len") > 0)
        .where(first <= last)
        .withColumn("k", F.explode(F.sequence(first, last)))
        .where(low < high)
        .select("item_kind", "item_id", "k", found.alias("b"))
        .where("b is not null")
        .groupBy("item_kind", "item_id", "k")
        .agg(F.max("b").alias("b"))
        .select("item_kind", "item_id", "k", F.col("b.cut").alias("cut"), F.col("b.level").alias("level"))
    )


def prepared(items: DataFrame, size_limits: DataFrame) -> DataFrame:
    """The oversized items' parts with offsets and the measures of their cuts. Totals are summed on the map side first."""
    item = ["item_kind", "item_id"]
    measures = F.broadcast(_measures(size_limits))  # one row per kind
    totals = items.groupBy(*item).agg(F.sum("__len").alias("__total")).join(measures, "item_kind").where(F.col("__total") > F.col("max_tokens") * 4)
    # cuts are needed until what is left after one fits a piece
    totals = totals.withColumn("__last_cut", F.greatest(F.lit(1), F.ceil((F.col("__total") - F.col("__step") + F.col("__reach")) / F.col("__stride"))).cast("long"))
    return offsets(items.join(totals, item), item, "part_no", "__len")


def split(items: DataFrame, size_limits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces, the parts they are cut from). Pieces: item_kind, item_id, piece_no, start_byte, end_byte, level.

    `items` are parts with boundary tables. Offsets are padded bytes of the item; ``level`` tells the boundary at the
    piece's end (5 part, 4 paragraph, 3 line, 2 sentence, 1 word, 0 character, null at the item's end). Consecutive pieces
    share ``overlap_tokens``. Items within their limit, null and empty texts aren't listed. part_no orders the parts and
    is unique within an item.
    """
    item = ["item_kind", "item_id"]
    big = checkpointed(prepared(items, size_limits))
    cuts = _cut_points(big)
    ends = big.groupBy(*item).agg(F.max("__total").alias("__total"), F.max("__over").alias("__over"), F.max("__last_cut").alias("__last_cut"))
    previous = cuts.select(*item, (F.col("k") + 1).alias("k"), F.col("cut").alias("__prev"))
    # all cuts but the end, and one row for the end after the last
    closed = cuts.unionByName(ends.select(*item, (F.col("__last_cut") + 1).alias("k"), F.col("__total").alias("cut"), F.lit(None).cast("int").alias("level")))
    pieces = (
        closed.join(previous, [*item, "k"], "left")
        .join(ends.drop("__last_cut"), item)
        .withColumn("start_byte", F.when(F.col("k") == 1, F.lit(0)).otherwise(F.greatest(F.col("__prev") - F.col("__over"), F.lit(0))))
        .select(*item, (F.col("k") - 1).cast("int").alias("piece_no"), "start_byte", F.col("cut").alias("end_byte"), "level")
    )
    return pieces, big


def split_texts(items: DataFrame, texts: DataFrame, size_limits: DataFrame, slice_bytes: int = SLICE) -> DataFrame:
    """The pieces with their ``text`` (fragments of several parts joined by nothing) and ``n_tokens``.

    `texts` is (part_no, text); long ones are joined slice by slice. Each part is offered only to the pieces that can cover it (by stride), so this is an
    equi-join; a piece's fragments are gathered by piece, whose size is bounded by the limit. A fragment begins and ends
    on whole characters.
    """
    item = ["item_kind", "item_id"]
    pieces, big = split(items, size_limits)
    lo = F.greatest(F.floor(F.col("__off") / F.col("__stride")), F.lit(0))
    hi = F.floor((F.col("__off") + F.col("__len") + F.col("__reach") + F.col("__over")) / F.col("__stride")) + 1
    offered = (
        big.where("__len > 0")
        .withColumn("piece_no", F.explode(F.sequence(lo.cast("int"), F.least(hi.cast("int"), F.col("__last_cut").cast("int")))))
        .select(*item, "piece_no", "part_no", "__off", "__len")
    )
    hit = offered.join(pieces, [*item, "piece_no"]).where((F.col("__off") < F.col("end_byte")) & (F.col("__off") + F.col("__len") > F.col("start_byte")))
    a = F.greatest(F.col("start_byte") - F.col("__off"), F.lit(0)).cast("int")
    n = (F.least(F.col("end_byte") - F.col("__off"), F.col("__len")) - F.greatest(F.col("start_byte") - F.col("__off"), F.lit(0))).cast("int")
    # a piece lies in the slice it begins in, since slices go on for the longest piece
    longest = (size_limits.agg(F.max("max_tokens")).first()[0] or 0) * 4
    whole = max(slice_bytes, longest) // 4 * 4
    hit = hit.withColumn("__j", F.floor(a / whole).cast("int"))
    hit = hit.join(slices(texts.select("part_no", "text"), whole, 0, longest).withColumnRenamed("__data", "__b"), ["part_no", "__j"])
    # a start inside a character moves on to the next one: up to three continuation bytes are skipped
    raw = F.substring(F.col("__b"), a - F.col("__j") * whole + 1, n)
    skip = F.length(F.regexp_extract(F.hex(F.substring(raw, 1, 3)), "^((?:[89AB][0-9A-F])*)", 1)) / 2
    frag = hit.withColumn("__raw", raw).withColumn("__raw", F.when(a > 0, F.substring(F.col("__raw"), skip.cast("int") + 1, n)).otherwise(F.col("__raw")))
    frag = frag.withColumn("__text", F.col("__raw").cast("string"))
    return (
        frag.groupBy(*item, "piece_no", "start_byte", "end_byte", "level")
        .agg(F.sort_array(F.collect_list(F.struct("part_no", "__text"))).alias("f"))
        .select(
            *item, "piece_no", "start_byte", "end_byte", "level", F.array_join(F.col("f.__text"), "").alias("text"),
            F.aggregate("f", F.lit(0).cast("long"), lambda s, x: s + F.ceil(F.octet_length(x["__text"]) / 4)).alias("n_tokens"),
        )
    )


def all_items(messages: DataFrame, chunk_meta: DataFrame, size_limits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the parts of messages and chunks with boundary tables, their texts). The tables are made once and kept."""
    texts = messages.select(F.col("seq").alias("part_no"), "text")
    tables = checkpointed(boundary_tables(texts, range_size(size_limits)))
    return message_items(tables).unionByName(chunk_items(tables, chunk_meta)), texts
