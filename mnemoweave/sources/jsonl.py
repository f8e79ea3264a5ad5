"""Reading exports, messages, claims and decisions."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from mnemoweave.functions import text as X
from mnemoweave.operators.claims import chunk_id_of, line_format
from mnemoweave.session import ship

MESSAGE = "conv_id string, title string, ts double, role string, message_id string, text string"


def numbered_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, line_no, value): the lines of text files with their places; line_no is from 1 in each file.

    Files are read in ranges by many tasks: lines are counted per range, and the ranges before one are summed up. A carriage
    return at a line's end is no part of it. An empty file has no line.
    """
    lines = spark.read.text(path, pathGlobFilter=pattern, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__id"), "value"
    )
    ranges = lines.groupBy("path", "__start").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    ahead = Window.partitionBy("path").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    places = ranges.withColumn("__base", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).drop("__n")
    # a range's lines follow one another in its task, so the ids are its line numbers but for a constant
    return lines.join(places, ["path", "__start"]).select(
        "path", (F.col("__base") + F.col("__id") - F.col("__first") + 1).alias("line_no"), F.regexp_replace("value", r"\r\z", "").alias("value")
    )


#: Names of an export's file, the first that is there counts.
DEFAULT_INPUTS = ("conversations.json", "shared_conversations.json")


def default_input(spark: SparkSession, folder: str, names: tuple[str, ...] = DEFAULT_INPUTS) -> str:
    """The export in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names:
        at = path(f"{folder.rstrip('/')}/{name}")
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return f"{folder.rstrip('/')}/{name}"
    raise FileNotFoundError(f"none of {', '.join(names)} in {folder}")


def whole_texts(spark: SparkSession, path: str, stdin=None) -> DataFrame:  # noqa: ANN001
    """(path, text) of files, a row each; ``-`` is the standard input. Bytes that are no UTF-8 become the replacement sign."""
    if path == "-":
        import sys

        data = (stdin or sys.stdin.buffer).read()
        return spark.createDataFrame([("-", data.decode("utf-8", "replace"))], "path string, text string")
    return spark.read.format("binaryFile").load(path).select("path", F.expr("make_valid_utf8(cast(content AS string))").alias("text"))


def messages(spark: SparkSession, path: str, skip_invalid: bool = False) -> DataFrame:
    """Messages of JSON lines with seq in order of file and line; other keys are kept in ``raw``.

    A line that is no object is an error, or left out with `skip_invalid`.
    """
    lines = line_format(numbered_lines(spark, path))
    good = F.col("format") == "ok"
    rows = lines.where(good | (F.lit(not skip_invalid) & (F.col("format") != "blank")))
    value = F.when(good, F.from_json("value", MESSAGE)).otherwise(F.raise_error(F.concat(F.lit("no JSON object: "), F.col("path"), F.lit(":"), F.col("line_no").cast("string"))))
    # files in order of their names: each has 2^32 numbers
    files = lines.select("path").distinct()
    place = files.select("path", ((F.row_number().over(Window.orderBy("path")) - 1) * (1 << 32)).alias("__base"))  # a row per file
    return rows.withColumn("m", value).join(F.broadcast(place), "path").select((F.col("__base") + F.col("line_no")).alias("seq"), "m.*", F.col("value").alias("raw"))


def claim_lines(spark: SparkSession, run_dir: str) -> DataFrame:
    """(path, chunk_id, line_no, value, format) of the claims files in a run's folder."""
    lines = numbered_lines(spark, f"{run_dir}/claims", "claims_chunk_*.jsonl")
    return line_format(lines).withColumn("chunk_id", chunk_id_of(F.col("path")))


CLAIM = (
    "category string, fact string, stability string, status string, confidence double, time struct<as_of_ts:double>, "
    "evidence array<struct<role:string,quote:string,conv_id:string,message_id:string,ts:double>>, derived_from string, value string, tags array<string>, notes string"
)


def claims(spark: SparkSession, run_dir: str) -> DataFrame:
    """The claims of a run's files as rows (seq, file_no, chunk_id, fields, raw), for a merge: blank lines are passed over, any
    other line that is no JSON object is an error. seq is in order of file and line."""
    lines = claim_lines(spark, run_dir).where("format <> 'blank'")
    wrong = F.raise_error(F.concat(F.col("format"), F.lit(" in "), F.col("path"), F.lit(":"), F.col("line_no").cast("string")))
    parsed = lines.withColumn("c", F.when(F.col("format") == "ok", F.from_json("value", CLAIM)).otherwise(wrong))
    place = lines.select("path").distinct().select("path", F.row_number().over(Window.orderBy("path")).alias("file_no"))  # a row per file
    seq = F.col("file_no").cast("long") * (1 << 32) + F.col("line_no")
    return parsed.join(place, "path").select(seq.alias("seq"), "file_no", "chunk_id", "c.*", F.col("value").alias("raw"))


def review_actions(spark: SparkSession, path: str) -> DataFrame:
    """(seq, fact_id, action, reason, decided_by) of decisions; blank actions are left out, broken lines are an error."""
    lines = line_format(numbered_lines(spark, path)).where("format <> 'blank'")
    row = F.when(F.col("format") == "ok", F.from_json("value", "fact_id string, action string, reason string, decided_by string")).otherwise(F.raise_error(F.concat(F.lit("broken line "), F.col("line_no").cast("string"))))
    out = lines.withColumn("r", row).select(F.col("line_no").alias("seq"), "r.*", F.col("path").alias("source_path"), F.col("line_no").alias("source_line"))
    checked = F.when(X.is_text(F.col("fact_id")), F.col("fact_id")).otherwise(F.raise_error(F.concat(F.lit("no fact_id in line "), F.col("seq").cast("string"))))
    return out.withColumn("fact_id", checked).where(X.is_text(F.col("action")))


# -- one giant JSON array -------------------------------------------------------------------------------------------


_ESCAPED = re.compile(rb"\\.", re.S)
_NONE = 1 << 60  # no bracket at all


def is_escaped(read, start: int) -> bool:
    """Whether the byte at `start` stands behind an odd number of backslashes."""
    n, at = 0, start
    while at:
        k = min(at, 4096)
        tail = read(at - k, k)
        more = k - len(tail.rstrip(b"\\"))
        n, at = n + more, at - k
        if more < k:
            break
    return n % 2 == 1


def range_change(read, start: int, end: int, unit: int = 1 << 20) -> list[list[int]]:
    """What the range does to the depth if it begins outside a string and if inside of one: [change, least change behind a
    bracket, 1 if it ends inside a string] for each."""
    out = [[0, _NONE, 0], [0, _NONE, 1]]
    at, rest = start + is_escaped(read, start), b""
    while at < end:
        more = read(at, min(unit, end - at))
        if not more:
            break
        at += len(more)
        data = rest + more
        odd = (len(data) - len(data.rstrip(b"\\"))) % 2
        rest, data = data[len(data) - odd :], data[: len(data) - odd]
        parts = _ESCAPED.sub(b"", data).split(b'"')
        for x in out:
            signs = np.frombuffer(b"".join(parts[x[2] :: 2]), np.uint8)
            step = np.isin(signs, (0x5B, 0x7B)).astype(np.int64) - np.isin(signs, (0x5D, 0x7D))
            steps = np.cumsum(step[step != 0])
            if len(steps):
                x[1] = min(x[1], x[0] + int(steps.min()))
                x[0] += int(steps[-1])
            x[2] = (x[2] + len(parts) - 1) % 2
    return out


def range_starts(changes: list[list[list[int]]]) -> list[tuple[int, int] | None]:
    """(depth, 1 inside a string) in which each range begins; None behind the array's end."""
    out: list[tuple[int, int] | None] = []
    depth, quoted, over = 0, 0, False
    for x in changes:
        out.append(None if over else (depth, quoted))
        change, least, ends = x[quoted]
        over = over or depth + least <= 0
        depth, quoted = depth + change, ends
    return out


def elements(read, start: int, end: int, state: tuple[int, int] = (0, 0), unit: int = 1 << 20) -> Iterator[str]:
    """Top-level elements of a JSON array of objects that begin in ``start <= offset < end``.

    `read(offset, n)` gives bytes, `state` is the depth at `start` and whether it is inside a string (``range_starts``).
    """
    at, data, begin, i = start, b"", -1, 0
    first = state[0] == 0
    depth, quoted = max(0, state[0] - 1), bool(state[1])
    escaped = quoted and is_escaped(read, start)
    while True:
        if i >= len(data):
            if begin < 0:  # nothing pending: what has been gone through is dropped
                at += len(data)
                data, i = b"", 0
                if start and at >= end:
                    return
            more = read(at + len(data), unit)
            if not more:
                if first and not start:
                    raise ValueError("no JSON array")
                return
            data += more
        c = data[i]
        if first:
            if c == 0x5B:
                first = False
            elif c not in b" \t\r\n\xef\xbb\xbf":
                raise ValueError("no JSON array")
        elif quoted:
            if escaped:
                escaped = False
            elif c == 0x5C:
                escaped = True
            elif c == 0x22:
                quoted = False
        elif c == 0x22:
            quoted = True
        elif c in b"{[":
            if depth == 0:
                if at + i >= end:
                    return
                begin = i
            depth += 1
        elif c in b"}]":
            if depth == 0:
                return  # the array's end
            depth -= 1
            if depth == 0 and begin >= 0:
                yield data[begin : i + 1].decode("utf-8", "replace")
                begin = -1
        i += 1


def _reader(f):  # noqa: ANN001, ANN202
    def read(offset: int, n: int) -> bytes:
        f.seek(offset)
        return f.read(n)

    return read


def _ranges(path: str, split: int) -> list[tuple[int, int]]:
    size = os.path.getsize(path)
    return [(a, min(a + split, size)) for a in range(0, max(1, size), split)]


def _changes(path: str, ranges: list[tuple[int, int]]) -> list[list[list[int]]]:
    with open(path, "rb") as f:
        return [range_change(_reader(f), a, b) for a, b in ranges]


class JsonArrayReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"].removeprefix("file://"), int(options.get("split_bytes", 128 << 20))
        self.starts = json.loads(options["starts"]) if "starts" in options else None

    def partitions(self) -> list[InputPartition]:
        ranges = _ranges(self.path, self.split)
        starts = self.starts or range_starts(_changes(self.path, ranges) if len(ranges) > 1 else [[[0, _NONE, 0]] * 2])
        return [InputPartition((a, b, tuple(x))) for (a, b), x in zip(ranges, starts, strict=True) if x is not None]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        a, b, state = partition.value
        with open(self.path, "rb") as f:
            for x in elements(_reader(f), a, b, state):
                yield (x,)


class JsonArraySource(DataSource):
    """``spark.read.format("json_array").load(path)``: the objects of one JSON array, a row each, in ranges of the file.

    Missing and repeated commas between elements don't matter, nor how lines are broken: a range's depth is known from those before
    it. ``export`` finds that out with all workers, a plain load beforehand on its own. The file must be on storage that all executors mount.
    """

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> JsonArrayReader:  # noqa: ANN001
        return JsonArrayReader(self.options)


def export(spark: SparkSession, path: str, split_bytes: int = 128 << 20) -> DataFrame:
    """The conversations of a raw export, as JSON texts (column value). A first pass leaves three numbers per range and state."""
    ship(spark)
    spark.dataSource.register(JsonArraySource)
    load = spark.read.format("json_array").option("split_bytes", split_bytes)
    file = path.removeprefix("file://")
    ranges = _ranges(file, split_bytes)
    if len(ranges) > 1:

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"id": b["id"], "change": [json.dumps(_changes(file, [ranges[k]])[0]) for k in b["id"]]})

        rows = spark.range(0, len(ranges), 1, min(len(ranges), 10_000)).mapInPandas(run, "id long, change string").collect()
        load = load.option("starts", json.dumps(range_starts([json.loads(r["change"]) for r in sorted(rows, key=lambda r: r["id"])])))
    return load.load(path)
