"""Chat formatting as a prefix tree: turns that conversations share from their start on are put out once.

A node is a sequence of turns from the first on; conversations with equal beginnings run through equal
nodes.  The nodes of a tree (one for each first turn) are put out depth first as one packed sequence:
``start`` and ``end`` are a node's places in it, ``position`` is the place its first character has in every
conversation that runs through it (the lengths of its ancestors), and ``sees`` are the intervals of
the sequence its ancestors take, adjoining ones joined: a node attends to them and, causally, to itself.
``loss_start`` and ``loss_end`` bound an assistant's text inside the node's own text.
Places count code points.

Template: ``<s>`` opens a conversation; a user's turn is ``[INST] text [/INST]``, a system's ``[SYS] text [/SYS]``,
an assistant's `` text</s>``, that of any other role ``[TURN] role[/TURN] text [/TURN]``.  A control string in a text (or role)
gets a backslash after its first character, one more than it has there already; reading takes one away.

Scale: rows are dealt by conversation and hashed as a chain (128 bits of SHA-256 over the parent's hash and the
turn), which names the nodes; equal conversations are one from there on.  Depth-first order needs no tree in one
place: distinct conversations are sorted by the nodes they take where the tree branches, a node belongs to the
first conversation in that order that runs through it, and nodes stand in the order of their conversation, then
depth.  Starts are running sums inside ranges of that order, shifted by the totals of the ranges before.  A first
turn or a conversation that a third of all rows share is one node or one leaf, counted with partial
aggregation; its text is put out once.

Defined results: rows are taken by turn (nulls first), then role, then text; a null text or role is empty; rows
with a null conversation id are one conversation; repeated rows are turns of their own; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entitylake.llm.common import Spool

BEGIN, END = "<s>", "</s>"
INST, SYS, TURN = ("[INST]", "[/INST]"), ("[SYS]", "[/SYS]"), ("[TURN]", "[/TURN]")
#: A control string, however often it is escaped: first character, backslashes, rest.
CONTROL = r"(<)(\\*)(/?s>)|(\[)(\\*)(/?(?:INST|SYS|TURN)\])"
NODE_BYTES = 16


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, r"$1$4$2$5\\$3$6")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(<)\\(\\*)(/?s>)|(\[)\\(\\*)(/?(?:INST|SYS|TURN)\])", "$1$4$2$5$3$6")


def turn_text(role: Column, text: Column) -> Column:
    """A turn in the template, without the opening of the conversation."""
    body = escape(text)
    wrapped = {"user": (INST[0] + " ", " " + INST[1]), "system": (SYS[0] + " ", " " + SYS[1]), "assistant": (" ", END)}
    out = F.concat(F.lit(TURN[0] + " "), escape(role), F.lit(TURN[1] + " "), body, F.lit(" " + TURN[1]))
    for name, (a, b) in wrapped.items():
        out = F.when(role == name, F.concat(F.lit(a), body, F.lit(b))).otherwise(out)
    return out


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv, conv_id, depth, node, parent, last, role, text)``: every row in its place, with the node it ends."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = ("conv", F.col("turn").asc_nulls_first(), "role", "text")
    dealt = rows.repartition("conv").sortWithinPartitions(*order).select("conv", "conv_id", "role", "text")
    names = ["conv", "conv_id", "role", "text", "depth", "node", "parent", "last"]

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, node, depth = None, b"", 0
        held: pa.RecordBatch | None = None  # a batch waits for the next one, to know whether its last row is a last turn
        for batch in batches:
            if not batch.num_rows:
                continue
            depths, nodes, parents, last = [], [], [], []
            first = batch.column(0)[0].as_py()
            if held is not None:
                yield closed(held, first != now)
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != now:
                    if last:
                        last[-1] = True
                    now, node, depth = conv, b"", 0
                parents.append(node)
                node = hashlib.sha256(b"%b%d:%b%b" % (node, len(role.encode()), role.encode(), text.encode())).digest()[:NODE_BYTES]
                depths.append(depth)
                nodes.append(node)
                last.append(False)
                depth += 1
            more = [pa.array(depths, pa.int64()), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), pa.array(last)]
            held = pa.RecordBatch.from_arrays([*batch.columns, *more], names)
        if held is not None:
            yield closed(held, True)

    def closed(batch: pa.RecordBatch, ends: bool) -> pa.RecordBatch:
        if not ends:
            return batch
        flags = batch.column(7).to_pylist()
        flags[-1] = True
        return pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(flags)], names)

    return dealt.mapInArrow(chained, "conv string, conv_id long, role string, text string, depth long, node binary, parent binary, last boolean")


@dataclass
class Forest:
    """``nodes``: tree, node, parent, depth, start, end, position, sees, role, text, loss_start, loss_end, conv_id (the first
    conversation through the node).  ``members``: conv_id, leaf: the conversations, each with its last node.
    ``paths``: leaf, depth, node: the nodes of each distinct conversation."""

    nodes: DataFrame
    members: DataFrame
    paths: DataFrame


def ranked(spool: Spool, rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``rank``, a number that rises in ``order`` (not without gaps); written, so it stays the same."""
    by_range = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return spool.put(by_range.withColumn("rank", F.monotonically_increasing_id()), "ranked")


def running_start(spool: Spool, rows: DataFrame, size: str, *order: str) -> DataFrame:
    """``rows`` with ``start``: the sum of ``size`` over the rows before, in ``order`` over all ranges."""
    ranged = spool.put(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    totals = ranged.groupBy("part").agg(F.sum(size).alias("t")).select("part", F.coalesce(F.sum("t").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("local", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return local.join(F.broadcast(totals), "part").withColumn("start", F.col("local") + F.col("before")).drop("part", "local", "before")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation's nodes in order, those that belong to it: tree, start and end in the tree, position, intervals seen."""
    names = ["tree", "node", "parent", "conv", "depth", "start", "end", "position", "sees"]
    leaf, root, base, position, sees = None, None, 0, 0, []
    see_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out: list[tuple] = []
        for conv, depth, node, parent, size, begin, own in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if conv != leaf:
                leaf, root, base, position, sees = conv, node, begin, 0, []
            start = begin - base
            if own:
                out.append((root, node, parent, conv, depth, start, start + size, position, [{"start": a, "end": b} for a, b in sees]))
            if sees and sees[-1][1] == start:
                sees[-1] = (sees[-1][0], start + size)
            else:
                sees.append((start, start + size))
            position += size
        if out:
            kinds = [pa.binary(), pa.binary(), pa.binary(), pa.string(), *[pa.int64()] * 4, see_type]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def build(conversations: DataFrame) -> Forest:
    spool = Spool(conversations.sparkSession, "tree")
    turns = spool.put(turn_rows(conversations), "turns")
    size = F.length(turn_text(F.col("role"), F.col("text"))) + F.when(F.col("depth") == 0, len(BEGIN)).otherwise(0)
    members = spool.put(turns.filter("last").select("conv_id", "conv", F.col("node").alias("leaf")), "members")
    # equal conversations are one: that of the least id stands for them
    leaves = spool.put(members.groupBy("leaf").agg(F.min("conv").alias("conv")), "leaves")
    narrow = turns.select("conv", "depth", "node", "parent", size.cast("long").alias("size"))
    rows = spool.put(narrow.join(leaves, "conv").select("leaf", "conv", "depth", "node", "parent", "size"), "rows")
    tree_nodes = rows.groupBy("node").agg(F.min("parent").alias("parent"))
    # written, so that the join below deals its rows anew and a first turn that many conversations share can be split
    branching = spool.put(tree_nodes.filter("length(parent) > 0").groupBy("parent").count().filter("count > 1").select("parent"), "branching")
    turning = rows.filter("depth = 0").select("conv", "depth", "node").unionByName(
        rows.filter("depth > 0").join(branching, "parent", "left_semi").select("conv", "depth", "node")
    )
    ways = turning.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("way"))
    rank = ranked(spool, ways.withColumn("way", F.expr("transform(way, x -> x.node)")), "way").select("conv", "rank")
    placed = spool.put(rows.join(rank, "conv"), "placed")
    firsts = placed.groupBy("node").agg(F.min("rank").alias("first"), F.min("depth").alias("depth"), F.min("size").alias("size"))
    starts = spool.put(running_start(spool, firsts, "size", "first", "depth").select("node", F.col("first"), "start"), "starts")
    in_order = (
        placed.join(starts, "node")
        .select("conv", "depth", "node", "parent", "size", "start", (F.col("rank") == F.col("first")).alias("own"))
        .repartition("conv").sortWithinPartitions("conv", "depth")
    )
    located = in_order.mapInArrow(
        _placed,
        "tree binary, node binary, parent binary, conv string, depth long, start long, end long, position long, sees array<struct<start: long, end: long>>",
    )
    texts = turns.select("conv", "depth", "conv_id", "role", "text")
    full = F.concat(F.when(F.col("depth") == 0, BEGIN).otherwise(""), turn_text(F.col("role"), F.col("text")))
    spoken = F.col("role") == "assistant"
    opening = F.when(F.col("depth") == 0, len(BEGIN)).otherwise(0) + 1
    nodes = located.join(texts, ["conv", "depth"]).select(
        "tree", "node", "parent", "depth", "start", "end", "position", "sees", "role", full.alias("text"),
        F.when(spoken, opening).alias("loss_start"), F.when(spoken, F.length(full) - len(END)).alias("loss_end"), "conv_id",
    )
    return Forest(spool.put(nodes, "nodes"), members.select("conv_id", "leaf"), rows.select("leaf", "depth", "node"))


def read_turns(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``said_by``, ``said`` (role and text of the turn, read from the formatted text) and ``learned``
    (the text under the loss mask, null without one); all unescaped."""
    body = F.regexp_replace("text", "^" + BEGIN, "")

    def between(a: str, b: str) -> Column:
        return F.expr(f"substring(body, {len(a) + 1}, length(body) - {len(a) + len(b)})")

    rows = nodes.withColumn("body", F.when(F.col("depth") == 0, body).otherwise(F.col("text")))
    marks = {"user": (INST[0] + " ", " " + INST[1]), "system": (SYS[0] + " ", " " + SYS[1]), "assistant": (" ", END)}
    other = between(TURN[0] + " ", " " + TURN[1])  # role[/TURN] text
    cut = F.instr(other, TURN[1] + " ")
    by, said = F.substring(other, F.lit(1), cut - 1), F.substring(other, cut + len(TURN[1]) + 1, F.length(other))
    for name, (a, b) in marks.items():
        mine = F.col("body").startswith(a)
        by, said = F.when(mine, name).otherwise(by), F.when(mine, between(a, b)).otherwise(said)
    learned = F.expr("substring(text, loss_start + 1, loss_end - loss_start)")
    return rows.withColumns({"said_by": unescape(by), "said": unescape(said), "learned": unescape(learned)}).drop("body")


def read_back(forest: Forest) -> DataFrame:
    """Per conversation, from the packed nodes alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Each distinct conversation is read once, along its nodes, and its digests go to all conversations that end there."""
    parts = read_turns(forest.nodes).select("node", "said_by", "said", "learned", F.length("text").alias("chars"))
    along = forest.paths.join(parts, "node").select("leaf", "depth", "said_by", "said", "learned", "chars")
    along = along.repartition("leaf").sortWithinPartitions("leaf", "depth")
    names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def line():
            n, turns, chars, loss, all_chars = state
            return now, n, turns.hexdigest(), chars, loss.hexdigest(), all_chars

        for batch in batches:
            out = []
            for leaf, _, by, said, learned, chars in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if leaf != now:
                    if state:
                        out.append(line())
                    now, state = leaf, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{by}\n{said}\n".encode())
                if learned is not None:
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += chars
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(line(), kinds)], names)

    digests = along.mapInArrow(run, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return forest.members.join(digests, "leaf").drop("leaf")
