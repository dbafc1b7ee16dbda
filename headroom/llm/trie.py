"""Conversation prefix trie from padded turn-id matrices.

Every conversation is a row of turn ids, one column a turn. Spark deals the conversations to shards by
ranges of their first ``width`` ids, so that equal beginnings stay together. A task pads its shard to
matrices of ``width`` columns, sorts them (numpy lexsort), and marks where a row differs from the one
above; OR-accumulated along the columns the marks are the starts of the trie's nodes, and ``reduceat``
over them aggregates every depth. Only nodes on a shard's first or last path can have members elsewhere.
These boundary nodes are recombined in Spark by the hash of their path, and each shard adds the own
share of those that it owns to their ancestors.

Rebuilding: conversation c starts with the first ``crc32(decimal c) % heads`` turns of conversation
``c - c % block``, followed by its own turns after as many.

Defined cases: a null conversation id is no conversation; null role or text is empty; null turns come
first; turns with the same number are ordered by their id (a hash); repeated turns are kept; an absent
start conversation gives no turns; a conversation left without turns belongs to the root alone; an empty
table has no nodes. A turn's id is 128 bits of the SHA-256 of role and text. Only the named columns are
read, so further columns may have any name. One conversation (16 bytes a turn) and one shard's ids
(``shard_turns`` on average) fit in a task; the ids that end in one node are hashed in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headroom.llm.text import lists, table, written

BLOCK = 20
HEADS = 4
WIDTH = 32
SHARD_TURNS = 1 << 20
ID_BYTES = 16
PIECE = 4096
ROWS = 1 << 15

EMPTY = hashlib.sha256(b"").hexdigest()
MEASURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_NODES = ("open boolean, shard int, node int, parent int, parent_open boolean, conv_id bigint, depth bigint, parent_conv_id bigint, "
          "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, n_words bigint, ends_sha256 string, "
          "node_key binary, parent_key binary, ends array<struct<first:bigint,ids:string>>")


def rebuilt(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """``conv, ids, words``: each rebuilt conversation's turn ids and the words of each turn."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    name = F.concat(F.length(who).cast("string"), F.lit(":"), who, what)
    own = (turns.where(F.col(conv).isNotNull())
           .select(F.col(conv).cast("long").alias("conv"), (F.col(conv) - F.col(conv) % block).cast("long").alias("base"),
                   F.struct(F.col(turn).alias("turn"), F.substring(F.unhex(F.sha2(name, 256)), 1, ID_BYTES).alias("id"),
                            F.regexp_count(what, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).alias("turn"))
           # One exchange: a block of conversations holds its start conversation.
           .repartition("base").groupBy("base", "conv").agg(F.sort_array(F.collect_list("turn")).alias("own")))
    start = F.max(F.when(F.col("conv") == F.col("base"), F.slice("own", 1, heads - 1))).over(Window.partitionBy("base"))
    taken = F.crc32(F.col("conv").cast("string")) % heads
    path = (own.withColumn("start", start).withColumn("taken", taken.cast("int"))
            .select("conv", F.expr("concat(slice(coalesce(start, slice(own, 1, 0)), 1, taken), slice(own, taken + 1, size(own)))").alias("path")))
    return path.select("conv", F.transform("path", lambda x: x["id"]).alias("ids"), F.transform("path", lambda x: x["words"]).alias("words"))


def _flat_ids(column: pa.ListArray) -> np.ndarray:
    """The ids of a list column as pairs of big-endian 64-bit numbers."""
    flat = column.flatten().cast(pa.binary())
    if not len(flat):
        return np.empty((0, 2), ">u8")
    _, offsets, data = flat.buffers()
    bounds = np.frombuffer(offsets, np.int32)[flat.offset:flat.offset + len(flat) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]].view(">u8").reshape(-1, 2)


def _dense(ids: np.ndarray) -> np.ndarray:
    """Numbers 0.. of the ids in their byte order."""
    order = np.lexsort((ids[:, 1], ids[:, 0]))
    new = np.zeros(len(ids), np.int64)
    new[1:] = (ids[order][1:] != ids[order][:-1]).any(axis=1)
    out = np.empty(len(ids), np.int32)
    out[order] = np.cumsum(new)
    return out


class _Shard:
    """The nodes of one shard, by depth; node 0 is the root, and a node's parent comes before it."""

    def __init__(self, conv: np.ndarray, ids: np.ndarray, words: np.ndarray, first: np.ndarray, width: int):
        length = np.diff(first)
        self.conv, self.ids, self.words = conv, ids, words
        self.least, self.members, self.parent = [conv.min(keepdims=True)], [np.array([len(conv)])], [np.array([-1])]
        self.at, self.open, self.levels, self.count = [np.array([-1])], [np.array([True])], [(0, 1)], 1
        self.end_node, self.end_conv = [np.zeros((length == 0).sum(), np.int64)], [np.sort(conv[length == 0])]
        dense = _dense(ids)
        rows, group = np.flatnonzero(length > 0), np.zeros(len(conv), np.int64)
        done = 0
        while len(rows):
            columns = np.arange(min(width, int(length[rows].max()) - done))
            held = length[rows, None] - done > columns
            padded = np.full(held.shape, -1, np.int32)
            padded[held] = dense[(first[rows, None] + done + columns)[held]]
            order = np.lexsort((conv[rows], *padded.T[::-1], group[rows]))
            rows, padded = rows[order], padded[order]
            change = np.ones(padded.shape, bool)
            change[1:] = padded[1:] != padded[:-1]
            change[1:, 0] |= group[rows][1:] != group[rows][:-1]
            np.logical_or.accumulate(change, axis=1, out=change)
            for column in range(len(columns)):
                self._depth(rows, padded[:, column], change[:, column], group, length, first, done + column, done == 0)
            done += len(columns)
            rows = rows[length[rows] > done]

    def _depth(self, rows, ids, change, group, length, first, depth, outer) -> None:
        """Nodes after turn ``depth`` (from 0); ``group`` holds each row's node so far and moves on."""
        start = np.flatnonzero(change)
        size = np.diff(np.append(start, len(rows)))
        real = ids[start] >= 0
        node = np.where(real, self.count + np.cumsum(real) - 1, -1)
        parent, conv = group[rows[start]], self.conv[rows]
        if outer:
            edge = np.zeros(len(start), bool)
            edge[[0, -1]] = True
        else:
            edge = np.concatenate(self.open)[parent]
        self.least.append(np.minimum.reduceat(conv, start)[real])
        self.members.append(size[real])
        self.parent.append(parent[real])
        self.at.append((first[rows[start]] + depth)[real])
        self.open.append(edge[real])
        here = np.repeat(node, size)
        last = (length[rows] == depth + 1) & (here >= 0)
        self.end_node.append(here[last])
        self.end_conv.append(conv[last])
        group[rows[here >= 0]] = here[here >= 0]
        self.levels.append((self.count, self.count + int(real.sum())))
        self.count += int(real.sum())

    def nodes(self, shard: int) -> Iterator[pa.RecordBatch]:
        least, members, parent, at, is_open = (np.concatenate(x) for x in (self.least, self.members, self.parent, self.at, self.open))
        depth = np.repeat(np.arange(len(self.levels)), [b - a for a, b in self.levels])
        words = np.where(at >= 0, self.words[np.maximum(at, 0)] if len(self.words) else 0, 0)
        closed_child = np.flatnonzero((parent >= 0) & ~is_open)
        children = np.bincount(parent[closed_child], minlength=self.count)
        # The own share of a boundary node is known only after recombination.
        leaves = np.where(is_open, 0, children == 0).astype(np.int64)
        saved = np.where(is_open, 0, (members - 1) * words).astype(np.int64)
        for a, b in reversed(self.levels[1:]):
            np.add.at(leaves, parent[a:b], leaves[a:b])
            np.add.at(saved, parent[a:b], saved[a:b])
        end_node, end_conv = np.concatenate(self.end_node), np.concatenate(self.end_conv)
        order = np.argsort(end_node, kind="stable")
        end_node, end_conv = end_node[order], end_conv[order]
        bounds = np.searchsorted(end_node, np.arange(self.count + 1))

        sha, pieces = [EMPTY] * self.count, [[] for _ in range(self.count)]
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            mine = end_conv[bounds[k]:bounds[k + 1]].tolist()
            if is_open[k]:
                pieces[k] = [(mine[i], ",".join(map(str, mine[i:i + PIECE]))) for i in range(0, len(mine), PIECE)]
            else:
                sha[k] = hashlib.sha256(",".join(map(str, mine)).encode()).hexdigest()
        chain, keys = {0: hashlib.sha256()}, [None] * self.count
        keys[0] = chain[0].digest()
        for k in np.flatnonzero(is_open)[1:].tolist():
            chain[k] = chain[int(parent[k])].copy()
            chain[k].update(self.ids[at[k]].tobytes())
            keys[k] = chain[k].digest()

        parent_open = np.where(parent >= 0, is_open[np.maximum(parent, 0)], False)
        known = (parent >= 0) & ~parent_open
        for a in range(0, self.count, ROWS):
            s = slice(a, min(a + ROWS, self.count))
            n = s.stop - a
            own = pieces[s]
            flat = [p for x in own for p in x]
            ends = lists(pa.StructArray.from_arrays([pa.array([p[0] for p in flat], pa.int64()), pa.array([p[1] for p in flat], pa.string())],
                                                    names=["first", "ids"]), [len(x) for x in own])
            above = [keys[p] if o and p >= 0 else None for p, o in zip(parent[s].tolist(), is_open[s].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(is_open[s]), pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(a, s.stop, dtype=np.int32)),
                 pa.array(parent[s].astype(np.int32)), pa.array(parent_open[s].astype(bool)), pa.array(least[s]), pa.array(depth[s].astype(np.int64)),
                 pa.array(least[np.maximum(parent[s], 0)], mask=~known[s]), pa.array(members[s].astype(np.int64)), pa.array(children[s].astype(np.int64)),
                 pa.array(leaves[s]), pa.array(saved[s]), pa.array(words[s].astype(np.int64)), pa.array(sha[s], pa.string()),
                 pa.array(keys[s], pa.binary()), pa.array(above, pa.binary()), ends],
                names=["open", "shard", "node", "parent", "parent_open", "conv_id", "depth", "parent_conv_id", *MEASURES, "n_words",
                       "ends_sha256", "node_key", "parent_key", "ends"])


def shard_nodes(paths: DataFrame, shards: int, width: int) -> DataFrame:
    """The nodes of every shard; those with ``open`` may have members in other shards too."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        conv = np.concatenate([b.column("conv").to_numpy() for b in held])
        ids = np.concatenate([_flat_ids(b.column("ids")) for b in held])
        words = np.concatenate([b.column("words").flatten().to_numpy(zero_copy_only=False).astype(np.int64) for b in held])
        counts = np.concatenate([b.column("ids").value_lengths().to_numpy(zero_copy_only=False) for b in held])
        held.clear()
        yield from _Shard(conv, ids, words, np.concatenate(([0], np.cumsum(counts))).astype(np.int64), width).nodes(TaskContext.get().partitionId())

    return paths.repartitionByRange(shards, F.slice("ids", 1, width), F.col("conv")).mapInArrow(scan, _NODES)


def _hashed_ends(open_nodes: DataFrame) -> DataFrame:
    """``node_key, sha``: the ids that end in a boundary node, hashed in order as they stream by."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for batch in batches:
            keys, shas = [], []
            for k, ids in zip(batch.column("node_key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        shas.append(state.hexdigest())
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], names=["node_key", "sha"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["node_key", "sha"])

    pieces = open_nodes.select("node_key", F.inline("ends")).repartition("node_key").sortWithinPartitions("node_key", "first")
    return pieces.mapInArrow(scan, "node_key binary, sha string")


def _shares(part: pd.DataFrame) -> pd.DataFrame:
    """Sums over the subtrees that a shard's boundary nodes form; parents come before children."""
    part = part.sort_values("node")
    at = {k: i for i, k in enumerate(part["node"].tolist())}
    up = [at.get(p, -1) for p in part["parent"].tolist()]
    leaves, saved = part["own_leaves"].tolist(), part["own_saved"].tolist()
    for i in range(len(up) - 1, 0, -1):
        leaves[up[i]] += leaves[i]
        saved[up[i]] += saved[i]
    return pd.DataFrame({"node_key": part["node_key"].tolist(), "leaves": leaves, "saved": saved})


def prefix_trie(turns: DataFrame, *, width: int = WIDTH, shard_turns: int = SHARD_TURNS, shards: int | None = None, **names) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    paths = written(rebuilt(turns, **names), "trie-paths")
    if shards is None:
        total = paths.agg(F.sum(F.size("words"))).first()[0] or 0  # one row
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    nodes = written(shard_nodes(paths, shards, width), "trie-nodes")
    closed, edge = nodes.where(~F.col("open")), nodes.where("open")

    met = edge.groupBy("node_key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *[F.sum(c).alias(c) for c in MEASURES],
        F.max("n_words").alias("n_words"), F.max("parent_key").alias("parent_key"), F.min("shard").alias("owner"))
    below = met.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("node_key")).agg(F.count(F.lit(1)).alias("open_children"))
    met = (met.join(below, "node_key", "left")
           .withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0)))
           .withColumn("own_leaves", (F.col("n_children") == 0).cast("long"))
           .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("n_words")).drop("open_children"))
    met = written(met, "trie-boundary")
    # Small tables from here on: boundary nodes are at most two paths a shard (and what lies below a split path of ``width`` turns).
    where = edge.select("shard", "node", "parent", "node_key").join(met.select("node_key", "owner", "own_leaves", "own_saved", F.col("conv_id").alias("top")), "node_key")
    mine = F.col("owner") == F.col("shard")
    shares = (where.select("shard", "node", "parent", "node_key", F.when(mine, F.col("own_leaves")).otherwise(0).alias("own_leaves"),
                           F.when(mine, F.col("own_saved")).otherwise(0).alias("own_saved"))
              .groupBy("shard").applyInPandas(_shares, "node_key binary, leaves bigint, saved bigint")
              .groupBy("node_key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    parents = met.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    edges = (met.join(shares, "node_key").join(_hashed_ends(edge), "node_key", "left").join(parents, "parent_key", "left")
             .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"),
                     (F.col("saved_tokens") + F.col("saved")).alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256")))
    tops = where.select("shard", F.col("node").alias("parent"), "top")
    hung = closed.where("parent_open").join(tops, ["shard", "parent"]).withColumn("parent_conv_id", F.col("top"))
    return edges.unionByName(hung.select(*edges.columns)).unionByName(closed.where("not parent_open").select(*edges.columns))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))
