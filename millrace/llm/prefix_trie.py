"""A trie of conversations' prefixes: every distinct beginning is a node, with totals over its subtree.

Equal conversations are one sequence first. The different sequences are ordered by their turns, ranges of
them are shards, so a shard holds whole subtrees but for the nodes on its first and on its last path, which may
go on in a neighbour ("open" nodes; at most two paths a shard).

Within a shard the nodes are sorted by reverse level order (Spark's sort, which spills), and time-forward processing
hands totals upward: a node takes its children's messages from a priority queue and puts one for its parent. The
queue spills sorted runs. What reaches an open node is added up across shards, and the same processing runs
over the tree of open nodes, whose size is bounded by the shards and the longest conversation.

A message carries the child's row, so that the parent, which knows its smallest conversation only then, can
complete it.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import broadcast_if_small, named, require
from millrace.workspace import cut_lineage

QUEUED = 200_000  # messages in memory
ROWS = 10_000  # of an Arrow batch
OPEN_BROADCAST = 500_000  # open nodes
NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conversation, turns) with one row a conversation; ``turns`` has a digest of role and text, and the text's length.

    Turns are ordered by number, nulls first, then by role and text. Null role or text: empty. Repeated rows all
    count. Rows without an id belong to no conversation and are left out, other columns are ignored.
    """
    require(df, conversation, turn, role, text)
    role_of, text_of = F.coalesce(named(role), F.lit("")), F.coalesce(named(text), F.lit(""))
    rows = df.where(named(conversation).isNotNull()).select(
        named(conversation).cast("long").alias("conversation"), named(turn).alias("turn"), role_of.alias("role"), text_of.alias("text")
    )
    in_order = Window.partitionBy("conversation").orderBy("turn", "role", "text")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    placed = rows.select(
        "conversation", F.row_number().over(in_order).alias("place"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"), F.length("text").cast("long").alias("length"),
    )
    grouped = placed.groupBy("conversation").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "length"))).alias("turns"))
    return grouped.select("conversation", F.transform("turns", lambda t: F.struct(t["digest"], t["length"])).alias("turns"))


def path_id(turns: Column) -> Column:
    return F.sha2(F.array_join(F.transform(turns, lambda t: F.hex(t["digest"])), ""), 256)


PATH_ENDS = "path string, first long, n long, ends_sha256 string"


def members_of_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, first, n, ends_sha256) from rows sorted by path and conversation, one conversation at a time."""
    path, first, n, digest, out = None, 0, 0, None, []
    for batch in batches:
        for p, c in zip(batch["path"].to_pylist(), batch["conversation"].to_pylist()):
            if p == path:
                digest.update(b",%d" % c)
                n += 1
                continue
            if path is not None:
                out.append((path, first, n, digest.hexdigest()))
            path, first, n, digest = p, c, 1, hashlib.sha256(b"%d" % c)
        if len(out) >= ROWS:
            yield as_batch(out, PATHS)
            out = []
    if path is not None:
        yield as_batch([*out, (path, first, n, digest.hexdigest())], PATHS)


PATHS = pa.schema([("path", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("ends_sha256", pa.string())])
NODES = pa.schema([
    ("depth", pa.int64()), ("place", pa.binary()), ("up", pa.binary()), ("id", pa.binary()), ("up_id", pa.binary()),
    ("length", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("open", pa.bool_()),
])
NODE_COLUMNS = (
    "depth long, place binary, up binary, id binary, up_id binary, length long, conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, open boolean"
)
RESULT = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("id", pa.binary()), ("up_id", pa.binary()), ("length", pa.int64()),
])
RESULT_COLUMNS = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, id binary, up_id binary, length long"
)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema)


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield as_batch(held, schema)
            held = []
    if held:
        yield as_batch(held, schema)


def nodes_of_shard(sorted_paths: Iterable[tuple]) -> Iterator[tuple]:
    """The trie nodes of sorted (turns, first, n, ends): a node leaves when the next path branches off above it.

    Nodes of the shard's first and last path are open. ``place`` numbers the nodes in the order of the paths.
    """
    numbers, stack, before = count(), [], None

    def node(depth, digest, length, parent, is_open):
        own = hashlib.sha256(parent["id"] + digest).digest()[:16] if parent else b""
        return {
            "depth": depth, "place": next(numbers).to_bytes(8), "up": parent and parent["place"], "id": own,
            "up_id": parent and parent["id"], "length": length, "conv_id": None, "n_convs": 0, "n_children": 0, "n_leaves": 0,
            "saved_tokens": 0, "ends_sha256": None, "open": is_open,
        }

    for turns, first, n, ends in sorted_paths:
        if before is None:
            stack.append(node(0, b"", 0, None, True))
        shared = 0
        for x, y in zip(turns, before or ()):
            if x["digest"] != y["digest"]:
                break
            shared += 1
        while len(stack) > shared + 1:
            yield tuple(stack.pop().values())
        for depth, t in enumerate(turns[shared:], shared + 1):
            stack.append(node(depth, t["digest"], t["length"], stack[-1], before is None))
        stack[-1] |= {"conv_id": first, "n_convs": n, "ends_sha256": ends}
        before = turns
    for last in reversed(stack):
        last["open"] = True
        yield tuple(last.values())


def nodes_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths = (row for b in batches for row in zip(*(b[c].to_pylist() for c in ("turns", "first", "n", "ends_sha256"))))
    yield from in_batches(nodes_of_shard(paths), NODES)


class SpillingQueue:
    """A priority queue of (key, order, value) that writes sorted runs when it holds more than ``limit`` messages.

    A run is an unnamed file of this task alone, gone when it is closed or the task dies; nothing else reads it.
    """

    def __init__(self, limit: int | None = None):
        self.limit, self.numbers = limit or QUEUED, count()
        self.held: list[tuple] = []
        self.runs: list[tuple] = []  # the first message of each run, and the run

    def push(self, key, order, value) -> None:
        heapq.heappush(self.held, (key, order, next(self.numbers), value))
        if len(self.held) > self.limit:
            run = tempfile.TemporaryFile()
            while self.held:
                pickle.dump(heapq.heappop(self.held), run)
            run.seek(0)
            self.advance(run)

    def advance(self, run) -> None:
        try:
            heapq.heappush(self.runs, (*pickle.load(run), run))
        except EOFError:
            run.close()

    def pop(self, key) -> Iterator:
        """The values of ``key`` in order; no message has a smaller key."""
        while self.held or self.runs:
            spilled = bool(self.runs) and (not self.held or self.runs[0][:3] < self.held[0][:3])
            if (self.runs if spilled else self.held)[0][0] != key:
                return
            if spilled:
                *_, value, run = heapq.heappop(self.runs)
                self.advance(run)
                yield value
            else:
                yield heapq.heappop(self.held)[3]


def forward(nodes: Iterable[dict], limit: int | None = None, with_ids: bool = False) -> Iterator[tuple]:
    """Rows of RESULT from nodes in reverse level order (depth descending, then place).

    A closed node's totals go to its parent as a message. Messages come in order of the children's smallest
    conversation, so the first one tells the parent its own, and it completes the children's rows one by one. The
    row of an open node has its ``id`` and what has reached it so far; its closed children name it in ``up_id``.
    """
    queue = SpillingQueue(limit)
    for node in nodes:
        smallest, is_open = node["conv_id"], node["open"]
        n, n_children, n_leaves, saved = (node[k] for k in ("n_convs", "n_children", "n_leaves", "saved_tokens"))
        for child in queue.pop((-node["depth"], node["place"])):
            if smallest is None or child[0] < smallest:
                smallest = child[0]
            n, n_children, n_leaves, saved = n + child[3], n_children + 1, n_leaves + child[5], saved + child[6]
            yield (*child[:2], None if is_open else smallest, *child[3:], node["id"] if is_open else None, None)
        ends = node["ends_sha256"]
        if is_open:
            yield (smallest, node["depth"], None, n, n_children, n_leaves, saved, ends, node["id"], node["up_id"], node["length"])
            continue
        saved += (n - 1) * node["length"]
        own = node["id"] if with_ids else None
        row = (smallest, node["depth"], None, n, n_children, n_leaves or 1, saved, ends or NO_ENDS, own)
        if node["up"] is None:
            yield (*row, None, None)
        else:
            queue.push((1 - node["depth"], node["up"]), smallest, row)


def dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def totals_of_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from in_batches(forward(dicts(batches)), RESULT)


def conversation_trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths``, rows of (conversation, turns) as ``sequences`` makes them.

    A node is a distinct beginning of ``depth`` turns; the root has none and is there if there is a conversation.
    Columns: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (the parent's smallest member; null for the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes in the subtree, itself included),
    ``saved_tokens`` (over the subtree, members but one times the length of the last turn) and ``ends_sha256`` (of the
    members that end there: their ids in order, joined by commas).

    Conversations without turns end at the root. An empty table gives no nodes. A conversation's digests (16
    bytes a turn) are one row; all ids that end at one node pass through one task, one at a time, since they
    have one hash.
    """
    require(paths, "conversation", "turns")
    keyed = paths.select("conversation", "turns", path_id(F.col("turns")).alias("path"))
    ends = (
        keyed.select("path", "conversation").repartition("path").sortWithinPartitions("path", "conversation")
        .mapInArrow(members_of_paths, PATH_ENDS)
    )
    different = keyed.groupBy("path").agg(F.any_value("turns").alias("turns"))
    shards = different.join(ends, "path").select("turns", "first", "n", "ends_sha256").repartitionByRange("turns")
    nodes = shards.sortWithinPartitions("turns").mapInArrow(nodes_of_partition, NODE_COLUMNS)
    found = nodes.sortWithinPartitions(F.desc("depth"), "place").mapInArrow(totals_of_shard, RESULT_COLUMNS)
    found = cut_lineage(found, "trie")
    # What the shards have of each open node, added up, makes the nodes of a small tree.
    of_open = found.where(F.col("id").isNotNull()).groupBy("id").agg(
        F.max("depth").alias("depth"), F.max("up_id").alias("up_id"), F.max("length").alias("length"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256"),
    )
    tree = of_open.select(
        "depth", F.col("id").alias("place"), F.col("up_id").alias("up"), "id", "up_id", "length", "conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", "ends_sha256", F.lit(False).alias("open"),
    )
    joined = cut_lineage(
        tree.repartition(1).sortWithinPartitions(F.desc("depth"), "place").mapInArrow(totals_of_roots, RESULT_COLUMNS), "trie"
    )
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parents = joined.select(F.col("id").alias("up_id"), F.col("conv_id").alias("parent"))
    closed = found.where(F.col("id").isNull())
    below = closed.where(F.col("up_id").isNotNull()).join(broadcast_if_small(parents, OPEN_BROADCAST), "up_id")
    return (
        closed.where(F.col("up_id").isNull()).select(names)
        .unionByName(below.withColumn("parent_conv_id", F.col("parent")).select(names))
        .unionByName(joined.select(names))
    )


def totals_of_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same over the tree of open nodes, whose rows keep their ids."""
    yield from in_batches(forward(dicts(batches), with_ids=True), RESULT)
