"""Chat formatting as a prefix tree.

Conversations that share their first turns share the nodes of a tree: a node is a sequence of turns,
named by a digest chained over their roles and texts. Each node's formatted turn is emitted once, in
depth-first order over the whole forest, with the position ids its tokens have in every conversation
through it and the intervals of the stream that its ancestors take, which are what its tokens may
attend to besides the node itself. A token is a code point of the formatted text.

The template marks turns by control strings. Inside texts and role names a backslash is put before
each backslash and each control string, so formatted turns parse back to what they were.

Plan: turns are sorted by conversation and read as a stream, which holds one turn and a digest, so a
conversation of any length is fine. Nodes are then distinct by name with map-side combine: a first turn
that a third of all conversations share is one row per task before the shuffle. Distinct conversations are
sorted by their sequences of nodes (a range sort); a node belongs to the first of them that it is part of,
its owner, and depth-first order is (owner, depth). Nodes of one owner are neighbours in the stream, so the
ancestors of a node are one interval per owner on its path, not one per turn.

Defined cases: null text and null role count as empty; turns of a conversation go by turn (null
first), then role and text, so repeated rows are repeated turns; null conv_ids form one conversation;
an empty table gives empty results; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.scratch import stage


@dataclass(frozen=True)
class Template:
    """Control strings around a turn, by role; other roles are named between `role_start` and `role_end`."""

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<s><<SYS>> ", " <</SYS>>"), "user": ("<s>[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"),
        }
    )
    role_start: str = "<s>[ROLE]"
    role_end: str = "[/ROLE] "
    close: str = " </s>"
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
    loss_role: str = "assistant"

    def _control(self) -> str:
        return "|".join(map(re.escape, self.control))

    def escape(self, text: str) -> str:
        return re.sub(rf"\\|{self._control()}", lambda m: "\\" + m[0], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The formatted turn, and the span of its text."""
        body = self.escape(text)
        if role in self.marks:
            start, end = self.marks[role]
        else:
            start, end = self.role_start + self.escape(role) + self.role_end, self.close
        return start + body + end, len(start), len(start) + len(body)

    def parse(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn; a ValueError for anything else."""
        named = re.compile(
            rf"{re.escape(self.role_start)}((?:\\.|(?!{self._control()})[^\\])*){re.escape(self.role_end)}", re.S
        ).match(formatted)
        if named:
            return self.unescape(named[1]), self.unescape(self._inside(formatted, named[0], self.close))
        for role, (start, end) in sorted(self.marks.items(), key=lambda x: -len(x[1][0])):
            if formatted.startswith(start) and formatted.endswith(end) and len(formatted) >= len(start) + len(end):
                return role, self.unescape(self._inside(formatted, start, end))
        raise ValueError("not a formatted turn")

    def _inside(self, formatted: str, start: str, end: str) -> str:
        body = formatted[len(start) : len(formatted) - len(end)]
        if not formatted.endswith(end) or re.search(self._control(), re.sub(r"\\.", "", re.sub(rf"\\({self._control()})", "", body))):
            raise ValueError("a control string inside a turn")
        return body


_CHAIN = (
    "conv_id bigint, depth int, node binary, parent binary, position bigint, formatted string, loss_start int, loss_end int"
)


def _chain(template: Template):
    """Turns come sorted by conversation; each gives its node, the digest of all turns so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, depth, position, parent = object(), 0, 0, b""
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("position", pa.int64()),
                            ("formatted", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32())])
        for batch in batches:
            out = []
            for conv, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]):
                if conv != last:
                    last, depth, position, parent = conv, 0, 0, b""
                formatted, a, b = template.turn(role, text)
                node = hashlib.sha256(parent + hashlib.sha256(role.encode()).digest() + hashlib.sha256(text.encode()).digest()).digest()[:16]
                loss = (a, b) if role == template.loss_role else (None, None)
                out.append((conv, depth, node, parent or None, position, formatted, *loss))
                depth, position, parent = depth + 1, position + len(formatted), node
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def turn_nodes(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Each turn with its node of the prefix tree."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_chain(template), _CHAIN)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns come sorted by conversation and depth; each conversation gives its nodes."""
    last, path = object(), []

    def emit(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in done], pa.int64()), pa.array([p for _, p in done], pa.list_(pa.binary()))], names=["conv_id", "path"]
        )

    for batch in batches:
        done = []
        for conv, node in zip(batch.column("conv_id").to_pylist(), batch.column("node").to_pylist()):
            if conv != last:
                if path:
                    done.append((last, path))
                last, path = conv, []
            path.append(node)
        if done:
            yield emit(done)
    if path:
        yield emit([(last, path)])


def _leaf():
    return F.element_at("path", -1)


def build(conversations: DataFrame, template: Template = Template()) -> tuple[DataFrame, DataFrame]:
    """The stream and its readers, both stored.

    Stream, a row per node: node, parent, owner, depth, start and end in the stream, position (the
    position id of its first token), formatted, loss_start, loss_end (within formatted), ancestors
    (array of owner, start, end in ascending order). Readers: conv_id, node (the last of the conversation).
    """
    spark = conversations.sparkSession
    turns = turn_nodes(conversations, template)
    paths = stage(spark, turns.select("conv_id", "node").mapInArrow(_paths, "conv_id bigint, path array<binary>"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One row per distinct conversation, in depth-first order; the number grows in that order.
    ranked = stage(
        spark,
        paths.groupBy(_leaf().alias("leaf")).agg(F.min("path").alias("path")).select("path")
        .repartitionByRange(n, "path").sortWithinPartitions("path").withColumn("rank", F.monotonically_increasing_id()),
    )
    on_path = ranked.select("rank", F.explode("path").alias("node"))
    owners = on_path.groupBy("node").agg(F.min("rank").alias("owner"))
    # All that follows from a node is the same in each of its rows, so any of them will do.
    facts = turns.groupBy("node").agg(*[
        F.min(c).alias(c) for c in ("parent", "depth", "position", "formatted", "loss_start", "loss_end")
    ])
    nodes = facts.join(owners, "node").withColumn("long", F.length("formatted").cast("bigint"))
    part = F.shiftright("owner", 33)  # the sorted partition that the number was given in
    totals = nodes.groupBy("owner").agg(F.sum("long").alias("total")).withColumn("part", part)
    parts = totals.groupBy("part").agg(F.sum("total").alias("all"))
    before = lambda over: over.rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("all").over(before(Window.orderBy("part"))), F.lit(0)).alias("base"))
    firsts = totals.join(F.broadcast(bases), "part").select(
        "owner", (F.col("base") + F.coalesce(F.sum("total").over(before(Window.partitionBy("part").orderBy("owner"))), F.lit(0))).alias("first")
    )
    own = before(Window.partitionBy("owner").orderBy("depth"))
    placed = stage(
        spark,
        nodes.join(firsts, "owner").withColumn("start", F.col("first") + F.coalesce(F.sum("long").over(own), F.lit(0)))
        .withColumn("end", F.col("start") + F.col("long")).drop("long"),
    )
    # What a conversation shares with earlier ones: one interval per owner on its path.
    shared = (
        on_path.join(placed.select("node", "owner", "start", "end"), "node").filter("owner != rank")
        .groupBy("rank", "owner").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(F.col("rank").alias("owner")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "owner"))).alias("above"))
    )
    stream = placed.join(shared, "owner", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint,owner:bigint>>")
    inside = F.when(F.col("start") > F.col("first"), F.array(F.struct(F.col("first").alias("start"), F.col("start").alias("end"), "owner"))).otherwise(none)
    stored = stream.withColumn(
        "ancestors", F.concat(F.coalesce("above", none), inside).cast("array<struct<start:bigint,end:bigint,owner:bigint>>")
    ).drop("above", "first")
    return stage(spark, stored), paths.select("conv_id", _leaf().alias("node"))


def _read(template: Template):
    """Nodes come sorted by conversation and place; each conversation gives a digest of what it reads back."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def close():
            conv, n, turns, chars, loss, size = held
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            out = []
            for conv, formatted, a, b in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")]):
                if held is None or held[0] != conv:
                    if held is not None:
                        out.append(close())
                    held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = template.parse(formatted)
                held[1] += 1
                held[2].update(f"{role}\n{text}\n".encode())
                if a is not None:
                    learned = template.unescape(formatted[a:b])
                    held[3] += len(learned)
                    held[4].update(learned.encode())
                held[5] += len(formatted)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(close(), schema)], schema=schema)

    return run


def conversation_nodes(stream: DataFrame, readers: DataFrame) -> DataFrame:
    """conv_id and the stream's rows of each conversation: those in its ancestors' intervals and its last node."""
    last = stream.select("node", F.concat("ancestors", F.array(F.struct("start", "end", "owner"))).alias("spans"))
    spans = readers.join(last, "node").select("conv_id", F.explode("spans").alias("s")).select("conv_id", "s.*")
    rows = stream.select("owner", F.col("start").alias("at"), "formatted", "loss_start", "loss_end")
    return spans.join(rows, "owner").filter("at >= start AND at < end").drop("start", "end", "owner")


def read_back(stream: DataFrame, readers: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, from the stream: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    found = conversation_nodes(stream, readers).repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return found.mapInArrow(
        _read(template),
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
