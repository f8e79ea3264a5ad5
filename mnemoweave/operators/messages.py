"""Messages: flattening of conversation trees, defaults, limits, the redacted view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemoweave.functions import text as X

#: A conversation of a raw export. Parts are kept as JSON text, since they are strings or objects.
EXPORT_SCHEMA = (
    "conversation_id string, id string, title string, current_node string, mapping map<string, struct<parent: string, message: struct<id: string, "
    "author: struct<role: string, name: string>, create_time: string, update_time: string, content: struct<content_type: string, parts: array<string>>, metadata: string>>>"
)


def parse_export(lines: DataFrame, column: str = "value") -> DataFrame:
    """Conversations of JSON texts, one object per row; rows that aren't objects have ``corrupt`` true and null fields."""
    parsed = F.from_json(F.col(column), EXPORT_SCHEMA)
    good = F.col(column).rlike(r"\A\s*\{") & F.try_parse_json(F.col(column)).isNotNull()
    return lines.select("*", F.when(good, parsed).alias("__c"), (~F.coalesce(good, F.lit(False))).alias("corrupt")).select(*lines.columns, "__c.*", "corrupt")


def role_of(role: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(role, F.lit("")), F.nullif(name, F.lit("")), F.lit("unknown"))


def ts_of(create_time: Column, update_time: Column) -> Column:
    return F.coalesce(create_time.try_cast("double"), update_time.try_cast("double"))


def conv_id_of(conversation_id: Column, id_: Column) -> Column:
    return F.coalesce(F.nullif(conversation_id, F.lit("")), F.nullif(id_, F.lit("")), F.lit("unknown"))


def text_of(content: Column) -> Column:
    """Text of a content: strings joined by lines; of multimodal ones also the objects' texts; other kinds are empty."""
    kind, parts = content["content_type"], F.coalesce(content["parts"], F.array().cast("array<string>"))
    is_object = lambda p: p.rlike(r"\A\s*[\{\[]") & F.try_parse_json(p).isNotNull()
    strings = F.filter(parts, lambda p: p.isNotNull() & ~is_object(p))
    mixed = F.filter(F.transform(parts, lambda p: F.when(is_object(p), F.get_json_object(p, "$.text")).otherwise(p)), lambda p: p.isNotNull())
    return F.coalesce(F.when(kind == "text", X.rstrip(F.array_join(strings, "\n"))).when(kind == "multimodal_text", X.rstrip(F.array_join(mixed, "\n"))), F.lit(""))


def terminal_node(conversations: DataFrame) -> DataFrame:
    """conversations with ``terminal``: the current node if there is one, else the node with the greatest time, the first of
    equals; null where no node has a time. Within the row, no shuffle."""
    nodes = F.map_entries("mapping")
    timed = F.transform(nodes, lambda n, i: F.struct(ts_of(n["value"]["message"]["create_time"], n["value"]["message"]["update_time"]).alias("ts"), (-i).alias("pos"), n["key"].alias("node")))
    latest = F.array_max(F.filter(timed, lambda n: n["ts"].isNotNull()))["node"]
    return conversations.withColumn("terminal", F.when(F.map_contains_key("mapping", F.coalesce("current_node", F.lit(""))), F.col("current_node")).otherwise(latest))


def active_path(conversations: DataFrame) -> DataFrame:
    """conversations with ``path``: node ids from the root to ``terminal``.

    The tree is one row's map, so parents are followed by ``aggregate``: at most as many steps as there are nodes, stopping
    at a missing or blank parent, a node that isn't there, or one already passed.
    """
    start = F.struct(F.col("terminal").alias("cur"), F.array().cast("array<string>").alias("path"))

    def step(s: Column, _: Column) -> Column:
        go = s["cur"].isNotNull() & (s["cur"] != "") & ~F.array_contains(s["path"], F.coalesce(s["cur"], F.lit("")))
        up = F.try_element_at(F.col("mapping"), F.coalesce(s["cur"], F.lit("")))["parent"]
        return F.struct(F.when(go, up).alias("cur"), F.when(go, F.concat(F.array(s["cur"]), s["path"])).otherwise(s["path"]).alias("path"))

    steps = F.sequence(F.lit(0), F.size("mapping"))
    return conversations.withColumn("path", F.when(F.col("terminal").isNotNull(), F.aggregate(steps, start, step)["path"]))


def flatten(conversations: DataFrame, roles: tuple[str, ...] = ("user", "assistant"), include_hidden: bool = False) -> DataFrame:
    """Messages of the active branches: conv_id, title, ts, role, message_id, text, pos (place in the branch).

    Conversations without a terminal node have none. Hidden messages, other roles and empty texts are left out; an empty
    tuple of roles stands for all.
    """
    tree = active_path(terminal_node(conversations)).where("path is not null")
    nodes = tree.select(
        conv_id_of(F.col("conversation_id"), F.col("id")).alias("conv_id"), F.coalesce("title", F.lit("")).alias("title"), "mapping", F.posexplode("path").alias("pos", "node")
    ).select("conv_id", "title", "pos", "node", F.try_element_at("mapping", "node")["message"].alias("m")).where("m is not null")
    out = nodes.select(
        "conv_id", "title", ts_of(F.col("m.create_time"), F.col("m.update_time")).alias("ts"), role_of(F.col("m.author.role"), F.col("m.author.name")).alias("role"),
        F.coalesce(F.nullif(F.col("m.id"), F.lit("")), F.col("node")).alias("message_id"), text_of(F.col("m.content")).alias("text"), "pos",
        F.coalesce(F.col("m.metadata").rlike(r'"is_visually_hidden_from_conversation"\s*:\s*true\b'), F.lit(False)).alias("hidden"),
    )
    if not include_hidden:
        out = out.where("not hidden")
    if roles:
        out = out.where(F.col("role").isin(*roles))
    return out.where("text <> ''").drop("hidden")


def with_defaults(messages: DataFrame) -> DataFrame:
    """Null and empty ids and roles are "unknown", null titles and texts empty."""
    out = messages
    for c, value in (("conv_id", "unknown"), ("message_id", "unknown"), ("role", "unknown"), ("title", ""), ("text", "")):
        out = out.withColumn(c, F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(value)))
    return out


def first_messages(messages: DataFrame, n: int) -> DataFrame:
    """The first n rows in order of seq. A limit of the pipeline, so it counts all rows."""
    return messages.orderBy("seq").limit(n)


def first_conversations(messages: DataFrame, n: int) -> DataFrame:
    """All messages of the n conversations that begin first."""
    first = messages.groupBy("conv_id").agg(F.min("seq").alias("__first")).orderBy("__first").limit(n).select("conv_id")
    return messages.join(first, "conv_id", "left_semi")


def export_stats(messages: DataFrame) -> DataFrame:
    """Number of messages and conversations by role. The distinct count is two-step, so a hot role is spread."""
    per = messages.groupBy("role", "conv_id").agg(F.count("*").alias("n"))
    return per.groupBy("role").agg(F.sum("n").alias("messages"), F.count("conv_id").alias("conversations"))


def build_view(messages: DataFrame, pii: bool = True, code_lines: int = 120, chars: int = 50_000) -> DataFrame:
    """messages with ``text`` redacted, then elided, then cut in the middle; ``redactions``, ``elided``, ``cut`` tell what was done.
    Null texts become empty; other columns are kept. No shuffle."""
    out = X.elide_code(X.redact(messages.withColumn("text", F.coalesce("text", F.lit(""))), pii=pii), code_lines)
    return out.withColumn("cut", (F.length("text") > chars) & F.lit(chars > 0)).withColumn("text", X.truncate_middle(F.col("text"), chars))


def view_stats(messages: DataFrame, view: DataFrame) -> DataFrame:
    """One row of totals and one per redaction rule: (metric, value)."""
    given = messages.select(F.length(F.coalesce("text", F.lit(""))).alias("n")).agg(F.count("*").alias("messages"), F.coalesce(F.sum("n"), F.lit(0)).alias("chars_in"))
    made = view.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars_out"), F.coalesce(F.sum("elided"), F.lit(0)).alias("elided"), F.count_if("cut").alias("cut"))
    both = given.crossJoin(F.broadcast(made))  # one row each
    totals = both.select(F.explode(F.create_map(*[x for c in ("messages", "chars_in", "chars_out", "elided", "cut") for x in (F.lit(c), F.col(c).cast("long"))])).alias("metric", "value"))
    rules = view.select(F.explode("redactions").alias("metric", "n")).groupBy("metric").agg(F.sum("n").alias("value"))
    return totals.unionByName(rules)


def run_numbers(rows: DataFrame, block: int = 65_536) -> DataFrame:
    """rows (seq, conv_id, ...) with ``run_no``: stretches of one conversation in a row, numbered from 1.

    The row before is found by two steps, so no task orders the whole table: inside blocks of seq by ``lag``, between
    blocks by the last row of the block before (one row per block).
    """
    b = rows.withColumn("__b", F.floor(F.col("seq") / block))
    inside = Window.partitionBy("__b").orderBy("seq")
    edges = b.groupBy("__b").agg(F.max(F.struct("seq", "conv_id")).alias("e"))
    before = edges.select("__b", F.lag("e.conv_id").over(Window.orderBy("__b")).alias("__carried"))  # a row per block
    prev = F.coalesce(F.lag("conv_id").over(inside), F.col("__carried"))
    marked = b.join(before, "__b").withColumn("__prev", prev).withColumn("__new", F.when(F.col("__prev").isNull() | (F.col("__prev") != F.col("conv_id")), 1).otherwise(0))
    counts = marked.groupBy("__b").agg(F.sum("__new").alias("n"))
    base = counts.select("__b", F.coalesce(F.sum("n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    return marked.join(base, "__b").withColumn("run_no", F.col("__base") + F.sum("__new").over(inside)).select(*rows.columns, "run_no")


def conversation_runs(messages: DataFrame) -> DataFrame:
    """(run_no, conv_id, first_seq, last_seq, messages): stretches of one conversation in a row."""
    rows = with_defaults(messages.select("seq", "conv_id", "message_id", "role", "title", "text")).select("seq", "conv_id")
    return run_numbers(rows).groupBy("run_no", "conv_id").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("messages"))
