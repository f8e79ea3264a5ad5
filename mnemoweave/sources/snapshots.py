"""A store of Parquet snapshots with pointers to the current one; writers of lines, prompts, reports and documents.

Parquet tables can't be merged into, so a new state is written beside the old one, and when all of its tables are there a
numbered pointer is moved into place; the greatest number counts. No pointer is ever deleted or written twice, so readers
see the one state or the other, and a writer that comes second finds its number taken. Folders may be local or on any file
system that Spark knows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tables of a store and their columns.
TABLES = {
    "claims": "claim_id string",
    "facts": "fact_id string, category string, fact_text string, stability string, first_seen_ts double, last_seen_ts double, "
    "confidence_max double, status string, claims long, normalized_fact_text string",
    "evidence": "evidence_id string, fact_id string, conv_id string, message_id string, ts double, role string, quote string, quote_hash string",
    "links": "fact_id string, claim_id string",
    "flags": "flag_id string, fact_id string, flag_type string, detail string",
    "reviews": "review_id string, seq long, fact_id string, action string, previous_status string, new_status string, reason string, "
    "decided_by string, source_path string, source_line long, decided_at double",
    "meta": "key string, value string",
}


class Store:
    """Named tables under a folder: ``folder/snapshots/<id>/<table>`` and ``folder/pointers/<number>``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self) -> tuple[int, str | None]:
        """(number, snapshot) of the greatest pointer; (0, None) in an empty store."""
        at = self._path(f"{self.folder}/pointers")
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        last = max((n for n in names if n.isdigit()), default=None)
        if last is None:
            return 0, None
        return int(last), self.spark.read.option("wholetext", "true").text(f"{self.folder}/pointers/{last}").first()[0].strip()

    def current(self) -> str | None:
        return self._pointer()[1]

    def has(self, name: str) -> bool:
        """Whether the current snapshot has the table."""
        at = self.current()
        return bool(at) and self._fs.exists(self._path(f"{self.folder}/snapshots/{at}/{name}"))

    def read(self, name: str) -> DataFrame | None:
        """The table in the current snapshot, or None."""
        at = self.current()
        p = f"{self.folder}/snapshots/{at}/{name}"
        return self.spark.read.parquet(p) if at and self._fs.exists(self._path(p)) else None

    def bootstrap(self, **meta: str) -> str:
        """Makes the tables that aren't there yet, empty, and notes those of `meta` that have no value yet."""
        new = {k: self.spark.createDataFrame([], schema) for k, schema in TABLES.items() if k != "meta" and not self.has(k)}
        noted = self.read("meta")
        old = {} if noted is None else {r["key"]: r["value"] for r in noted.collect()}  # a few settings
        if noted is None or set(meta) - set(old):
            new["meta"] = self.spark.createDataFrame(sorted((meta | old).items()), TABLES["meta"])
        return self.write(new, expected=self.current()) if new else self.current()

    def write(self, tables: dict[str, DataFrame], expected: str | None = None) -> str:
        """A new snapshot of the given tables; those not given are carried over. `expected` guards against another writer."""
        number, before = self._pointer()
        if expected is not None and before != expected:
            raise RuntimeError(f"the store has moved on to {before}")
        new = uuid.uuid4().hex
        names = set(tables)
        if before:
            names |= {s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.folder}/snapshots/{before}"))}
        for name in sorted(names):
            df = tables.get(name)
            df = self.spark.read.parquet(f"{self.folder}/snapshots/{before}/{name}") if df is None else df
            df.write.mode("errorifexists").parquet(f"{self.folder}/snapshots/{new}/{name}")
        self._fs.mkdirs(self._path(f"{self.folder}/pointers"))
        made = self._path(f"{self.folder}/pointers/.{new}")
        out = self._fs.create(made, False)
        out.write(bytearray(new, "ascii"))
        out.close()
        target = self._path(f"{self.folder}/pointers/{number + 1:012d}")
        if self._fs.exists(target) or not self._fs.rename(made, target):
            self._fs.delete(made, False)
            raise RuntimeError(f"another writer has made pointer {number + 1}")
        return new


def write_jsonl(df: DataFrame, path: str, overwrite: bool = False, order: str | None = None) -> None:
    """One JSON object per line; refuses an existing folder unless told to overwrite it."""
    out = df.orderBy(order) if order else df
    out.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def write_chunks(lines: DataFrame, path: str, overwrite: bool = False) -> None:
    """Lines (chunk_id, seq, line) as a folder per chunk, each in order."""
    lines.repartition("chunk_id").sortWithinPartitions("chunk_id", "seq").select("chunk_id", "line").write.partitionBy("chunk_id").mode("overwrite" if overwrite else "errorifexists").text(path)


def write_report(lines: DataFrame, path: str, overwrite: bool = False) -> None:
    """Report lines (report, line), already in order, as a folder per report."""
    lines.select("report", "line").write.partitionBy("report").mode("overwrite" if overwrite else "errorifexists").text(path)


def manifest(counts: DataFrame, **config: object) -> str:
    """JSON of one row of counts and the stage's settings."""
    return json.dumps({"counts": counts.first().asDict(recursive=True), "config": config}, sort_keys=True, default=str)


def write_prompts(prompts: DataFrame, path: str, overwrite: bool = False) -> None:
    """Prompts (chunk_id, sha256, prompt) as a folder per chunk with its text, and an index of them as JSON lines."""
    mode = "overwrite" if overwrite else "errorifexists"
    prompts.select("chunk_id", "prompt").write.partitionBy("chunk_id").option("lineSep", "\n").mode(mode).text(f"{path}/prompts")
    index = prompts.select("chunk_id", F.concat(F.lit("prompts/chunk_id="), "chunk_id").alias("path"), F.col("sha256").alias("chunk_sha256"), F.sha2("prompt", 256).alias("prompt_sha256"))
    write_jsonl(index, f"{path}/index", overwrite, "chunk_id")


def write_validation(summary: DataFrame, issues: DataFrame, path: str, overwrite: bool = False) -> None:
    """A validation report: the files' summaries and the issues as JSON lines, ``path/summary`` last, since it makes it valid."""
    write_jsonl(issues, f"{path}/issues", overwrite)
    write_jsonl(summary, f"{path}/summary", overwrite)


def read_validation(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(errors, warnings) of a validation report, by its issues; None where there is none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/summary/_SUCCESS")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    found = spark.read.schema("level string").json(f"{path}/issues")
    return tuple(found.agg(F.count_if(F.col("level") == "error"), F.count_if(F.col("level") == "warning")).first())
