"""The trie of conversation prefixes, from adaptive radix trees over fixed-width turn ids.

A turn is known by a number of 160 bits, big-endian: 128 bits of the SHA-256 of its role and
text, then the 32 bits of its text's length in bytes. A conversation is the string of its
turns' ids, so a prefix of turns is a prefix of bytes at a multiple of 20. Each task builds
an adaptive radix tree (`radix_tree`) over its strings; paths without forks are compressed,
and only the depths that a turn ends at give nodes of the trie.

How the work is dealt:

* Equal strings are counted before, as one with its number, smallest member and ends.
* Distinct strings are cut into ranges in byte order, so a first turn that most
  conversations share is many tasks. A node lies within one range unless the neighbouring
  strings of two ranges share it. Nodes are complete in their task but for these open ones,
  whose parts, at most the shared depth per range, are added up afterwards.
* A string covers a segment of turns, the first of 64. Conversations that go on and still
  agree with another one after it are grouped by it, and the next, longer segment builds the
  trees below; trees are then finished from the deepest segment up. A conversation that goes
  on alone needs no tree: each of its further turns is a node. So a conversation with most
  of all turns is never one row; its turns are also numbered by ranges, not in one window.
* Members that end at a node stream through one task in the order of their ids, as SHA-256
  asks for, in bounded memory.

Result per node: conv_id (smallest member), depth, parent_conv_id (the parent's, NULL for the
root), n_convs, n_children, n_leaves (childless nodes below or at it), saved_tokens (bytes of
last texts that members after the first repeat, below and at it), ends_sha256.

Cases: turns are ordered by their number, NULL first, and by id where that ties; repeated
rows are repeated turns. A NULL role or text is empty, and an empty text is a turn of length
0. Rows with a NULL conversation belong to none. Conversations without turns are members of
the root. An empty table gives no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm import radix_tree
from plumbline.llm.common import durable, forget, hot_join, looked_up, running, tasks_for

#: Bytes of a turn id, and of its length at the end.
WIDTH, LENGTH = 20, 4
#: Turns of the first segment, growth of the segments, and turns of the longest one.
FIRST, GROWTH, WIDEST = 64, 8, 1 << 15
#: Bytes and strings of a task, and turns of a conversation that meet in one part of a join.
TASK_BYTES, TASK_ROWS, LOT = 1 << 23, 20_000, 4096
NONE = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn as 40 hexadecimal digits."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(named, 256), 1, 2 * (WIDTH - LENGTH))
    return F.concat(digest, F.lpad(F.lower(F.hex(F.octet_length(text))), 2 * LENGTH, "0"))


def ordered_turns(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv, pos (from 1) and id of each turn."""
    turns = rows.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        turn_id(F.col(f"`{role_col}`"), F.col(f"`{text_col}`")).alias("id"),
    )
    written = durable(turns)
    # Alike rows may swap places; the row number only lets ranges cut between them.
    numbered = written.withColumns({"row": F.monotonically_increasing_id(), "one": F.lit(1).cast("long")})
    return running(numbered, ["turn", "id", "row"], {"before": "one"}, ("conv",)).select(
        "conv", (F.col("before") + 1).alias("pos"), "id"
    )


def rebuilt_turns(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of another one: (conv, total) and (conv, depth, id, total).

    Conversation c begins with the first h turns of c - c % family, then has its own turns
    after its first h, where h is the CRC-32 of c in decimal digits modulo most + 1.
    """
    convs = durable(turns.groupBy("conv").agg(F.max("pos").alias("n")))
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    own = convs.withColumns({"h": heads, "base": F.col("conv") - F.col("conv") % family})
    known = convs.select(F.col("conv").alias("base"), F.col("n").alias("there"))
    plan = own.join(known, "base", "left").withColumn("heads", F.least("h", F.coalesce("there", F.lit(0))))
    plan = durable(plan.withColumn("total", F.col("heads") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    first = turns.where(F.col("pos") <= most).withColumnRenamed("conv", "base")
    begun = first.join(plan.where("heads > 0"), "base").where("pos <= heads")
    lots = F.explode(F.expr(f"sequence(0L, n div {LOT})"))
    rest = turns.withColumn("lot", F.expr(f"pos div {LOT}")).join(plan.withColumn("lot", lots), ["conv", "lot"])
    rest = rest.where("pos > h")
    found = begun.select("conv", F.col("pos").alias("depth"), "id", "total").unionByName(
        rest.select("conv", (F.col("pos") - F.col("h") + F.col("heads")).alias("depth"), "id", "total")
    )
    return plan.select("conv", "total"), found


@dataclass
class _Segment:
    """Depths (start, start + width]: strings (one per conversation) and their distinct ones."""

    start: int
    width: int
    strings: DataFrame
    distinct: DataFrame


def _segment(turns: DataFrame, start: int, width: int) -> _Segment:
    """Strings of the turns (grp, conv, depth, id, total, root_low) of a segment."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("depth", "id"))), lambda x: x["id"])
    strings = turns.groupBy("grp", "conv", "total", "root_low").agg(F.unhex(F.array_join(ids, "")).alias("key"))
    strings = durable(strings.withColumn("more", F.col("total") > start + width))
    ended = F.when(~F.col("more"), F.col("conv"))
    distinct = strings.groupBy("grp", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("low"), F.min(ended).alias("end"),
        F.sum(F.col("more").cast("long")).alias("n_more"), F.min("root_low").alias("root_low"),
    )
    return _Segment(start, width, strings, durable(distinct.withColumn("next", F.monotonically_increasing_id())))


def _agreed(left, right) -> int:
    """Turns at the start of both strings, -1 where their groups differ or one is absent."""
    if left is None or right is None or left["grp"] != right["grp"]:
        return -1
    a, b = bytes(left["key"]), bytes(right["key"])
    turns = 0
    while turns * WIDTH < min(len(a), len(b)) and a[turns * WIDTH : (turns + 1) * WIDTH] == b[turns * WIDTH : (turns + 1) * WIDTH]:
        turns += 1
    return turns


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        edges = batch.itertuples(index=False)
        found = [(e.part, _agreed(e.earlier, e.first), _agreed(e.last, e.later)) for e in edges]
        yield pd.DataFrame(found, columns=["part", "before", "after"])


NODES = (
    "grp long, depth long, open boolean, node binary, parent binary, low long, parent_low long, n long, "
    "children long, leaves long, saved long, end long, bytes long"
)
NODE_ARROW = pa.schema(
    [
        ("grp", pa.int64()), ("depth", pa.int64()), ("open", pa.bool_()), ("node", pa.binary()), ("parent", pa.binary()),
        ("low", pa.int64()), ("parent_low", pa.int64()), ("n", pa.int64()), ("children", pa.int64()),
        ("leaves", pa.int64()), ("saved", pa.int64()), ("end", pa.int64()), ("bytes", pa.int64()),
    ]
)


class _Below:
    """What hangs below a point of the tree: nodes whose parent is not met yet, and their sums."""

    __slots__ = ("rows", "closed", "leaves", "saved", "n", "low", "sample")

    def __init__(self):
        self.rows, self.closed, self.leaves, self.saved, self.n, self.low, self.sample = [], 0, 0, 0, 0, None, None

    def add(self, other: _Below) -> None:
        self.rows += other.rows
        self.closed += other.closed
        self.leaves += other.leaves
        self.saved += other.saved
        self.n += other.n
        self.low = other.low if self.low is None else min(self.low, other.low)
        self.sample = other.sample


def group_nodes(grp: int, strings: list[dict], before: int, after: int, start: int) -> list[dict]:
    """Nodes of one group of distinct strings in byte order.

    The first `before` turns of the first string and the first `after` of the last one are
    shared with other tasks. Such nodes and the root (depth 0 of the segment) are open: they
    have the sums of what is complete below them here, and no own share.
    """
    root = radix_tree.Node(b"")
    for string in strings:
        radix_tree.insert(root, string["key"], string)
    first, last, top = strings[0]["key"], strings[-1]["key"], strings[0]["root_low"]
    rows: list[dict] = []

    def emitted(below: _Below, turns: int, value: dict | None) -> _Below:
        """The node that ends a turn, with its value if a string ends there."""
        if value is not None:
            own = _Below()
            own.n, own.low, own.sample = value["n"], value["low"], value["key"]
            own.closed, own.leaves, own.saved = value["below_children"], value["below_leaves"], value["below_saved"]
            below.add(own)
        size = turns * WIDTH
        path = below.sample[:size]
        shared = turns == 0 or turns <= before and first.startswith(path) or turns <= after and last.startswith(path)
        text = int.from_bytes(path[size - LENGTH : size], "big") if turns else 0
        row = {
            "grp": grp, "depth": start + turns, "open": shared, "node": None, "parent": None, "low": below.low,
            "parent_low": top if turns == 1 else None, "n": below.n, "children": below.closed, "leaves": below.leaves,
            "saved": below.saved, "end": value["end"] if value is not None else None, "bytes": text,
        }
        if shared:
            row["node"] = hashlib.blake2b(path, digest_size=16).digest()
        else:
            row["leaves"] = below.leaves if below.closed else 1
            row["saved"] = below.saved + (below.n - 1) * text
        for child in below.rows:
            if turns and shared:
                rows[child]["parent"] = row["node"]
            elif turns:
                rows[child]["parent_low"] = below.low
        up = _Below()
        up.rows, up.n, up.low, up.sample = [len(rows)], below.n, below.low, below.sample
        if not shared:
            up.closed, up.leaves, up.saved = 1, row["leaves"], row["saved"]
        rows.append(row)
        return up

    order = radix_tree.preorder(root)
    hanging = [_Below() for _ in order]
    for place in range(len(order) - 1, -1, -1):
        node, parent, above, end = order[place]
        below = hanging[place]
        hanging[place] = None
        if end % WIDTH == 0 and end:
            below = emitted(below, end // WIDTH, node.value)
        # Turns that end inside the compressed path.
        for turns in range((end - 1) // WIDTH, above // WIDTH, -1):
            below = emitted(below, turns, None)
        if parent >= 0:
            hanging[parent].add(below)
        else:
            emitted(below, 0, None)
    return rows


def _part_nodes(start: int) -> Callable[[pa.Table], pa.Table]:
    def build(table: pa.Table) -> pa.Table:
        strings = table.sort_by([("grp", "ascending"), ("key", "ascending")]).to_pylist()
        runs: dict[int, list[dict]] = {}
        for string in strings:
            runs.setdefault(string["grp"], []).append(string)
        found: list[dict] = []
        ends = strings[0]["grp"], strings[-1]["grp"]
        for grp, own in runs.items():
            before = own[0]["before"] if grp == ends[0] else -1
            after = own[0]["after"] if grp == ends[1] else -1
            found += group_nodes(grp, own, before, after, start)
        return pa.Table.from_pylist(found, schema=NODE_ARROW)

    return build


def merge_open(parts: pa.Table) -> pa.Table:
    """One row for each open node of a group, complete: parts are added up, then children, deepest first."""
    merged: dict[bytes, dict] = {}
    for row in parts.to_pylist():
        held = merged.setdefault(row["node"], row)
        if held is not row:
            held["low"] = min(held["low"], row["low"])
            held["end"] = row["end"] if held["end"] is None else held["end"]
            for name in ("n", "children", "leaves", "saved"):
                held[name] += row[name]
    ordered = sorted(merged.values(), key=lambda r: -r["depth"])
    root = ordered[-1]
    for row in ordered:
        row["saved"] += (row["n"] - 1) * row["bytes"]
        row["leaves"] = row["leaves"] if row["children"] else 1
        if row is not root:
            parent = merged[row["parent"]] if row["parent"] else root
            parent["children"] += 1
            parent["leaves"] += row["leaves"]
            parent["saved"] += row["saved"]
    for row in ordered:
        if row["parent"]:
            row["parent_low"] = merged[row["parent"]]["low"]
    return pa.Table.from_pylist(ordered, schema=NODE_ARROW)


def _trees(strings: DataFrame, start: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, roots): complete nodes of all groups below their roots, and the roots themselves."""
    size = strings.agg(F.count(F.lit(1)), F.sum(F.octet_length("key"))).first()
    tasks = max(tasks_for(strings), -(-size[0] // TASK_ROWS), -(-int(size[1] or 0) // TASK_BYTES))
    placed = durable(strings.repartitionByRange(tasks, "grp", "key").withColumn("part", F.spark_partition_id()))
    edge = F.struct("grp", "key")
    along = Window.partitionBy().orderBy("part")
    edges = placed.groupBy("part").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    edges = edges.withColumns({"earlier": F.lag("last").over(along), "later": F.lead("first").over(along)})
    shared = durable(edges.mapInPandas(_neighbours, "part int, before int, after int"))
    # At most one row for each of the tasks chosen above.
    made = placed.join(F.broadcast(shared), "part").groupBy("part").applyInArrow(_part_nodes(start), NODES)
    made = durable(made)
    opened = durable(made.where("open").groupBy("grp").applyInArrow(merge_open, NODES))
    closed = made.where("not open")
    parents = opened.select("grp", F.col("node").alias("parent"), F.col("low").alias("_low"))
    hanging = looked_up(closed.where("parent is not null").drop("parent_low"), parents, ["grp", "parent"], [F.col("low")])
    hanging = hanging.withColumnRenamed("_low", "parent_low")
    nodes = closed.where("parent is null").unionByName(hanging).unionByName(opened.where(F.col("depth") > start))
    forget(placed, shared)
    return nodes, opened.where(F.col("depth") == start)


def _end_digests(ended: DataFrame) -> DataFrame:
    """end (smallest conversation that ends at a node) and the digest of all that end there, streamed in order."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, digest = None, None, None
        for batch in batches:
            found = []
            columns = [batch.column(name).to_pylist() for name in ("start", "grp", "key", "conv")]
            for start, grp, key, conv in zip(*columns, strict=True):
                if (start, grp, key) == node:
                    digest.update(b",%d" % conv)
                else:
                    if node is not None:
                        found.append((first, digest.hexdigest()))
                    node, first, digest = (start, grp, key), conv, hashlib.sha256(b"%d" % conv)
            yield _digest_batch(found)
        if node is not None:
            yield _digest_batch([(first, digest.hexdigest())])

    ordered = ended.repartition("start", "grp", "key").sortWithinPartitions("start", "grp", "key", "conv")
    return ordered.mapInArrow(stream, "end long, ends_sha256 string")


def _digest_batch(found: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["end", "ends_sha256"]
    )


def _all_ends(ended: DataFrame, lone: DataFrame) -> DataFrame:
    """Digests of the ends of all nodes; conversations that went on alone end alone."""
    single = lone.select(F.col("conv").alias("end"), F.sha2(F.col("conv").cast("string"), 256).alias("ends_sha256"))
    return _end_digests(ended).unionByName(single)


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations (conv, total) with turns (conv, depth from 1, id of 40 hex digits, total)."""
    spark = convs.sparkSession
    turns, convs = durable(turns), durable(convs)
    known = convs.agg(F.count(F.lit(1)), F.min("conv"), F.min(F.when(F.col("total") == 0, F.col("conv")))).first()
    count, lowest, silent = known
    root_low = F.lit(lowest).cast("long")
    ended = convs.where("total = 0").select(
        F.lit(-1).cast("long").alias("start"), F.lit(0).cast("long").alias("grp"), F.lit(b"").alias("key"), "conv"
    )
    segments: list[_Segment] = []
    alone: list[DataFrame] = []
    start, width = 0, FIRST
    inside = turns.where(F.col("depth") <= width).withColumns({"grp": F.lit(0).cast("long"), "root_low": root_low})
    while True:
        segment = _segment(inside, start, width)
        segments.append(segment)
        place = F.lit(start).cast("long").alias("start")
        ended = ended.unionByName(segment.strings.where("not more").select(place, "grp", "key", "conv"))
        onward = segment.distinct.where("n_more > 0").select("grp", "key", "n_more", "next", "low")
        going = hot_join(segment.strings.where("more").select("grp", "key", "conv"), onward, ["grp", "key"], [F.col("conv")])
        going = durable(going.drop("grp", "key"))
        start += width
        # Conversations that go on alone: each further turn is a node.
        lone = going.where("n_more = 1").select("conv", F.lit(start).cast("long").alias("from"), F.col("low").alias("parent"))
        alone.append(lone)
        together = going.where("n_more > 1").select("conv", F.col("next").alias("grp"), F.col("low").alias("root_low"))
        if together.isEmpty():
            break
        width = min(width * GROWTH, WIDEST)
        further = turns.where((F.col("depth") > start) & (F.col("depth") <= start + width))
        inside = hot_join(further, together, ["conv"], [F.col("depth")])

    found: list[DataFrame] = []
    roots: DataFrame | None = None
    for segment in reversed(segments):
        strings = segment.distinct
        single = F.when(F.col("n_more") == 1, 1).otherwise(0).cast("long")
        if roots is None:
            strings = strings.withColumns(
                {"below_children": single, "below_leaves": single, "below_saved": F.lit(0).cast("long")}
            )
        else:
            below = roots.select(
                F.col("grp").alias("next"), F.col("children").alias("_children"), F.col("leaves").alias("_leaves"),
                F.col("saved").alias("_saved"),
            )
            strings = strings.join(below, "next", "left").select(
                *strings.columns,
                F.coalesce("_children", single).alias("below_children"),
                F.coalesce("_leaves", single).alias("below_leaves"),
                F.coalesce("_saved", F.lit(0)).cast("long").alias("below_saved"),
            )
        nodes, roots = _trees(strings.drop("next", "n_more"), segment.start)
        found.append(nodes)

    shown = ["low", "depth", "parent_low", "n", "children", "leaves", "saved", "end"]
    nodes = found[0].select(*shown)
    for more in found[1:]:
        nodes = nodes.unionByName(more.select(*shown))
    one = F.lit(1).cast("long")
    lone = alone[0]
    for more in alone[1:]:
        lone = lone.unionByName(more)
    tails = hot_join(turns.where(F.col("total") > FIRST), lone, ["conv"], [F.col("depth")]).where(F.col("depth") > F.col("from"))
    nodes = nodes.unionByName(
        tails.select(
            F.col("conv").alias("low"), "depth", F.when(F.col("depth") == F.col("from") + 1, F.col("parent")).otherwise(F.col("conv")).alias("parent_low"),
            one.alias("n"), (F.col("depth") < F.col("total")).cast("long").alias("children"), one.alias("leaves"),
            F.lit(0).cast("long").alias("saved"), F.when(F.col("depth") == F.col("total"), F.col("conv")).alias("end"),
        )
    )
    # The root is one row; only its numbers pass the driver.
    top = roots.first()
    sums = (top["children"], top["leaves"], top["saved"]) if top else (0, 1, 0)
    root = [(lowest, 0, None, count, *sums, silent)] if count else []
    nodes = nodes.unionByName(spark.createDataFrame(root, nodes.schema))

    finished = _all_ends(ended, lone)
    nodes = nodes.join(finished, "end", "left")
    return nodes.select(
        F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"),
    )
