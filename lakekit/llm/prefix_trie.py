"""Conversation prefix trie from ternary search trees, one for each range of turn-id sequences.

Turns are encoded by a dictionary of the distinct (role, text).  The
conversations' id sequences are range-partitioned and sorted, equal ones
grouped first, and each bounded run of them becomes a ternary search tree:
medians are inserted first, so the sibling trees are balanced.  An iterative
traversal adds up members, leaves and savings.  Only the nodes on the first and
the last path of a run can have members in other runs.  Their partial figures
are merged by path, and their subtree sums by pointer doubling.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, discard, materialize, small

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_sequences(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """``(conv, seq, sizes)``: each conversation's turn ids in order and the UTF-8 bytes of their texts.

    Null roles and texts are empty, null turns come first, turns of one number
    go by the digest of role and text, rows without a conversation are left out.
    The texts themselves are not shuffled, only their digests.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    coded = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    coded = materialize(coded, "trie-turns")
    dictionary = materialize(coded.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "digest", "id", "bytes")
    own = coded.join(dictionary, "digest").groupBy("conv").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return own.select("conv", F.col("turns.id").alias("seq"), F.col("turns.bytes").alias("sizes"))


def _copies(batches, most: int):
    """Rows of one sequence and neighbouring conversations as one: ``(seq, sizes, first, n, ids)``.

    ``ids`` are at most ``most`` decimal conversation ids, ascending, joined by commas.
    """
    key, ids, sizes, rows = None, [], None, []

    def close():
        if ids:
            rows.append((key, sizes, ids[0], len(ids), ",".join(map(str, ids))))
            ids.clear()

    for batch in batches:
        for part in small([batch]):
            for conv, seq, size in zip(*(c.to_pylist() for c in part.columns)):
                if seq != key or len(ids) == most:
                    close()
                    key, sizes = seq, size
                ids.append(conv)
            if rows:
                yield _batch(rows, _PIECE)
                rows.clear()
    close()
    if rows:
        yield _batch(rows, _PIECE)


_LIST = pa.list_(pa.int64())
_PIECE = {"seq": _LIST, "sizes": _LIST, "first": pa.int64(), "n": pa.int64(), "ids": pa.string()}
_NODE = {n: pa.int64() for n in ("conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "bytes", "shard")}
_NODE |= {"ends": pa.string(), "path": pa.binary(), "up": pa.binary(), "boundary": pa.bool_()}
_NODE_SCHEMA = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'string' if t == pa.string() else 'binary' if t == pa.binary() else 'boolean'}" for n, t in _NODE.items())


def _batch(rows, types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types.values())], list(types))


class TernaryTree:
    """Ternary search tree over sequences of ids; node 0 is the empty prefix, every other node one longer prefix."""

    def __init__(self):
        self.symbol, self.less, self.equal, self.more = [None], [0], [0], [0]
        self.up, self.depth = [0], [0]

    def insert(self, key) -> int:
        """The node of ``key``, made where missing."""
        node = 0
        for symbol in key:
            side, last, at = self.equal, node, self.equal[node]
            while at and self.symbol[at] != symbol:
                side = self.less if symbol < self.symbol[at] else self.more
                last, at = at, side[at]
            if not at:
                at = side[last] = len(self.symbol)
                for column, value in ((self.symbol, symbol), (self.less, 0), (self.equal, 0), (self.more, 0), (self.up, node), (self.depth, self.depth[node] + 1)):
                    column.append(value)
            node = at
        return node

    def top_down(self) -> list[int]:
        """All nodes but the root, each after its parent."""
        order, stack = [], [self.equal[0]]
        while stack:
            node = stack.pop()
            if node:
                order.append(node)
                stack += (self.less[node], self.more[node], self.equal[node])
        return order


def medians(n: int):
    """0..n-1, the median of each range before its halves."""
    work = [(0, n)]
    while work:
        lo, hi = work.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            work += ((lo, mid), (mid + 1, hi))


def shard_nodes(keys: list[tuple], shard: int):
    """Rows of ``_NODE`` for sorted distinct ``(seq, sizes, n, first, ends)``.

    An inner node's figures are final.  A boundary node, on the path of the
    first or the last key, gets what its inner children add: its own part and
    that of its boundary children depend on other shards.
    """
    tree, end = TernaryTree(), {}
    for i in medians(len(keys)):
        end[tree.insert(keys[i][0])] = i
    size = len(tree.symbol)
    members, least, bytes_, kids, leaves, saved = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size, [0] * size
    for node, i in end.items():
        _, sizes, members[node], least[node], _ = keys[i]
        at = node
        while at and not bytes_[at]:  # 0 bytes are found again, which does no harm
            bytes_[at] = sizes[tree.depth[at] - 1]
            at = tree.up[at]
    paths = {}
    for key in (keys[0][0], keys[-1][0]):
        node, path = 0, b""
        paths[0] = path
        for symbol in key:
            node = tree.equal[node]
            while tree.symbol[node] != symbol:
                node = (tree.less if symbol < tree.symbol[node] else tree.more)[node]
            path = hashlib.md5(path + symbol.to_bytes(8, "big", signed=True)).digest()
            paths[node] = path
    order = tree.top_down()
    for node in reversed(order):
        up = tree.up[node]
        if node not in paths:
            if not kids[node]:
                leaves[node] = 1
            saved[node] += (members[node] - 1) * bytes_[node]
            kids[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        members[up] += members[node]
        least[up] = least[node] if least[up] is None else min(least[up], least[node])
    for node in chain([0], order):
        up, boundary = tree.up[node], node in paths
        parent = least[up] if up not in paths else None
        path = paths[node] if boundary else paths.get(up)
        ends = keys[end[node]][4] if node in end else EMPTY_SHA
        yield (
            *(least[node], tree.depth[node], parent, members[node], kids[node], leaves[node], saved[node], bytes_[node], shard),
            *(ends, path, paths[up] if boundary and node else None, boundary),
        )


def _tries(batches, most: int):
    """Cut a task's sorted sequences into runs of at most ``most`` ids (or one sequence) and emit their trees' nodes."""
    task = TaskContext.get().partitionId() << 32
    keys: list[tuple] = []
    state = {"held": 0, "shard": task}
    current = None  # [seq, sizes, n, first, digest]

    def nodes():
        rows = []
        for row in shard_nodes(keys, state["shard"]):
            rows.append(row)
            if len(rows) == 20_000:
                yield _batch(rows, _NODE)
                rows.clear()
        if rows:
            yield _batch(rows, _NODE)
        keys.clear()
        state["held"], state["shard"] = 0, state["shard"] + 1

    def close():
        keys.append((*current[:4], current[4].hexdigest()))
        state["held"] += len(current[0]) + 1

    for batch in batches:
        for part in small([batch]):
            for seq, sizes, first, n, ids in zip(*(c.to_pylist() for c in part.columns)):
                if current is not None and current[0] == seq:
                    current[2] += n
                    current[4].update(f",{ids}".encode())
                    continue
                if current is not None:
                    close()
                    if state["held"] >= most:
                        yield from nodes()
                current = [seq, sizes, n, first, hashlib.sha256(ids.encode())]
    if current is not None:
        close()
        yield from nodes()


def _boundary(nodes: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, merged by path, with final figures and their parent's member."""
    met = nodes.where("boundary").groupBy("path").agg(
        F.min("conv").alias("conv"),
        F.first("depth").alias("depth"),
        F.first("up").alias("up"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.max("bytes").alias("bytes"),
        F.max(F.when(F.col("ends") != EMPTY_SHA, F.col("ends"))).alias("ends"),
    )
    met = materialize(met, "trie-boundary")
    below = met.where("up is not null").groupBy(F.col("up").alias("path")).agg(F.count("*").alias("outer"))
    met = met.join(below, "path", "left").withColumn("n_children", F.col("inner") + F.coalesce("outer", F.lit(0)))
    met = met.select(
        *("path", "conv", "depth", "up", F.col("up").alias("jump"), "n_convs", "n_children"),
        (F.col("leaves") + (F.col("n_children") == 0).cast("bigint")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends"),
    )
    met = materialize(met, "trie-boundary")
    deepest = met.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):  # sums over descendants nearer than 1, 2, 4, ...
        last = met
        given = met.where("jump is not null").groupBy(F.col("jump").alias("path")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        far = met.select(F.col("path").alias("jump"), F.col("jump").alias("farther"))
        met = met.join(given, "path", "left").join(far, "jump", "left").select(
            *("path", "conv", "depth", "up", F.col("farther").alias("jump"), "n_convs", "n_children"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            "ends",
        )
        met = materialize(met, "trie-boundary")
        discard(last)
    parents = met.select(F.col("path").alias("up"), F.col("conv").alias("parent"))
    return met.drop("jump").join(parents, "up", "left")


def prefix_trie(sequences: DataFrame, ids_per_task: int = 200_000, ids_per_tree: int = 100_000, convs_per_piece: int = 4096) -> DataFrame:
    """One row per node of the trie of ``(conv, seq, sizes)`` (see ``turn_sequences``).

    Returns ``conv_id`` (smallest conversation that starts with the node's
    turns), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``, null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of its
    subtree), ``saved_tokens`` (over its subtree: conversations beyond the first
    times the bytes of the last turn) and ``ends_sha256`` (of the ids of the
    conversations that end there).

    Empty sequences end at the root; equal conversations are one sequence,
    grouped before the trees are built, in pieces that a large group can't
    outgrow; rows without a conversation are left out.  An empty table has no
    nodes.  A task holds one tree of about ``ids_per_tree`` turn ids or one sequence.
    """
    bounded_batches(sequences)
    seqs = materialize(sequences.where("conv is not null").select("conv", "seq", "sizes"), "trie-sequences")
    held = seqs.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    parts = max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // ids_per_task))
    ordered = seqs.repartitionByRange(parts, "seq", "conv").sortWithinPartitions("seq", "conv")
    pieces = materialize(ordered.mapInArrow(lambda batches: _copies(batches, convs_per_piece), "seq array<bigint>, sizes array<bigint>, first bigint, n bigint, ids string"), "trie-pieces")
    discard(seqs)
    runs = pieces.repartitionByRange(parts, "seq").sortWithinPartitions("seq", "first")
    nodes = materialize(runs.mapInArrow(lambda batches: _tries(batches, ids_per_tree), _NODE_SCHEMA), "trie-nodes")
    discard(pieces)
    merged = materialize(_boundary(nodes), "trie-boundary")
    # an inner node below a boundary node asks by (shard, path), so that the root's children are dealt out
    seen = nodes.where("boundary").select("shard", "path").join(merged.select("path", F.col("conv").alias("found")), "path")
    inner = nodes.where("not boundary").join(seen, ["shard", "path"], "left").withColumn("parent", F.coalesce("parent", "found"))
    columns = ("conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends")
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return inner.select(*columns).unionByName(merged.select(*columns)).toDF(*names)
