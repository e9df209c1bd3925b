"""Prefix trie of conversations, kept as balanced parentheses.

Conversations are sorted by their turns and dealt into shards of neighbours. A shard writes its part of the trie
as one sequence of parentheses: a node opens at its first conversation and closes after its last. Everything about
a node follows from the place of its closing parenthesis: ``find_close`` searches the excess (open minus closed)
by blocks that know their least and greatest excess; the rank of leaf pairs ``()`` counts leaves, and cumulative
arrays over the nodes in order of opening give conversations and savings of every subtree as one difference.

Only nodes on a shard's first or last path can go on in another shard. These spines are merged as a table: their
counts are added, and what their subtrees hold of other spine nodes is again a difference of running sums over the
paths in order. A conversation that a third of all others repeat is thereby spread over many shards.

Turns are ordered by turn, nulls first, ties by role and text; null roles and texts are empty. Rows without a
conv_id take no part; repeated rows are turns of their own. An empty table gives no rows; extra columns are ignored.
A conversation is one row of hashes (16 bytes a turn) and text sizes. ``conv_id % 5`` has the sign of conv_id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sourcelens.plans.joins import join_hot_keys

from .common import scratch

#: Parentheses of a block of the excess index.
BLOCK = 64
#: Turns that a shard is meant to hold.
SHARD_TURNS = 200_000
#: Length from which the ids of a node's members are passed on as another piece.
PIECE = 1 << 20
WIDTH = 16
NONE = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int32).max

SCHEMA = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string, key binary, parent_key binary, first_path long, last_path long, "
          "bytes long, piece long, ids string")
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_FIELDS = [(n, _ARROW[t]) for n, t in (x.split() for x in SCHEMA.split(", "))]
NODE, SPINE, ENDS = 0, 1, 2


class Parentheses:
    """A balanced sequence (True opens) with a range min-max index of its excess."""

    def __init__(self, opens: np.ndarray):
        self.excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int32)
        count = -(-len(opens) // BLOCK)
        padded = np.full(count * BLOCK, _FAR, np.int32)
        padded[:len(opens)] = self.excess
        self.blocks = padded.reshape(count, BLOCK)
        least, most = self.blocks.min(axis=1), np.where(self.blocks == _FAR, -1, self.blocks).max(axis=1)
        self.levels = [(least, most)]
        while len(least) > 1:
            if len(least) % 2:
                least, most = np.append(least, _FAR), np.append(most, -1)
            least, most = least.reshape(-1, 2).min(axis=1), most.reshape(-1, 2).max(axis=1)
            self.levels.append((least, most))

    def holds(self, level: int, node: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Whether the range of a node reaches that excess; steps of one leave no value in between out."""
        least, most = self.levels[level]
        inside = node < len(least)
        node = np.where(inside, node, 0)
        return inside & (least[node] <= goal) & (goal <= most[node])

    def _in_block(self, block: np.ndarray, after: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First place behind ``after`` in a block that has the excess, -1 where none has."""
        out = np.empty(len(block), np.int64)
        column = np.arange(BLOCK)
        for at in range(0, len(block), 8_192):
            some = slice(at, at + 8_192)
            hit = (self.blocks[block[some]] == goal[some, None]) & (column > after[some, None])
            out[some] = np.where(hit.any(axis=1), block[some] * BLOCK + hit.argmax(axis=1), -1)
        return out

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first later place with one excess less."""
        goal = self.excess[places] - 1
        block = places // BLOCK
        out = self._in_block(block, places % BLOCK, goal)
        left = np.flatnonzero(out < 0)
        goal, node = goal[left], block[left].copy()
        level = np.full(len(left), -1)
        for k in range(len(self.levels)):  # up, until a right neighbour's range holds the excess
            going = level < 0
            found = going & (node % 2 == 0) & self.holds(k, node + 1, goal)
            node = np.where(found, node + 1, np.where(going, node // 2, node))
            level[found] = k
        for k in range(len(self.levels) - 1, 0, -1):  # down, to the first block that holds it
            at = level == k
            node = np.where(at, np.where(self.holds(k - 1, node * 2, goal), node * 2, node * 2 + 1), node)
            level[at] = k - 1
        out[left] = self._in_block(node, np.full(len(left), -1), goal)
        return out


def shared_lengths(turns: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of turns that each sequence shares with the one before; 0 for the first."""
    out = np.zeros(len(lengths), np.int64)
    both = np.minimum(lengths[1:], lengths[:-1])
    rows = np.flatnonzero(both)
    if len(rows):
        size = both[rows]
        begin = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(begin, size)
        a, b = np.repeat(starts[rows], size) + step, np.repeat(starts[rows + 1], size) + step
        differs = (turns[a] != turns[b]).any(axis=1)
        out[rows + 1] = np.minimum(np.minimum.reduceat(np.where(differs, step, _FAR), begin), size)
    return out


def path_keys(turns: bytes) -> list[bytes]:
    """Keys of the nodes on a path, root first: each is the digest of its parent's key and its own turn."""
    keys = [hashlib.md5(b"").digest()]
    for at in range(0, len(turns), WIDTH):
        keys.append(hashlib.md5(keys[-1] + turns[at:at + WIDTH]).digest())
    return keys


def shard_rows(shard: int, ids: np.ndarray, keys: list[bytes], sizes: np.ndarray) -> dict[str, list]:
    """What one shard knows of its nodes; ``keys`` ascend, ``ids`` ascend among equal keys."""
    lengths = np.array([len(k) // WIDTH for k in keys], np.int64)
    starts = np.cumsum(lengths) - lengths
    turns = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    shared = shared_lengths(turns, starts, lengths)
    fresh = lengths - shared
    closing = np.append(np.append(0, lengths[:-1]) - shared, lengths[-1] + 1)
    runs = np.stack([np.append(0, closing), np.append(1, np.append(fresh, 0))], axis=1).ravel()
    trie = Parentheses(np.repeat(np.arange(len(runs)) % 2 == 1, runs))

    # Nodes in order of opening, the root first.
    count = 1 + int(fresh.sum())
    opened = np.cumsum(fresh) - fresh
    depth = np.append(0, np.arange(count - 1) - np.repeat(opened, fresh) + np.repeat(shared, fresh) + 1)
    text = np.append(0, sizes[np.repeat(starts, fresh) + depth[1:] - 1]) if count > 1 else np.zeros(1, np.int64)
    opens = np.diff(np.append(0, trie.excess)) == 1
    places = np.flatnonzero(opens)
    close = trie.find_close(places)
    last = (close + 1 + trie.excess[close]) // 2 - 1
    order = np.sort(depth * np.int64(count) + np.arange(count))
    above = (depth - 1) * np.int64(count) + np.arange(count)
    parent = np.append(-1, order[np.searchsorted(order, above[1:]) - 1] % count)

    def total(weight: np.ndarray) -> np.ndarray:
        """Sums over subtrees from the cumulative array."""
        running = np.append(0, np.cumsum(weight))
        return running[last + 1] - running[np.arange(count)]

    end = np.cumsum(fresh)  # the node at which a conversation ends; equal ones share it
    members = total(np.bincount(end, minlength=count))
    leaf = ~opens[np.minimum(places + 1, len(opens) - 1)]
    first = np.searchsorted(end, np.arange(count))
    behind = np.searchsorted(end, last, "right")
    least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), np.stack([first, behind], axis=1).ravel())[::2]

    on_first = np.arange(count) <= lengths[0]
    on_last = last == count - 1
    spine = on_first | on_last
    saved = np.where(spine, 0, (members - 1) * text)
    plain = ~spine
    children = np.bincount(parent[plain & (parent >= 0)], minlength=count)
    leaves, savings = total(leaf & plain), total(saved)

    known: dict[int, bytes] = dict(enumerate(path_keys(keys[0])))
    known |= dict(zip(np.flatnonzero(on_last).tolist(), path_keys(keys[-1])))
    out: dict[str, list] = {n: [] for n, _ in _FIELDS}

    def emit(**values):
        for name, column in out.items():
            column.append(values.get(name))

    bounds = np.flatnonzero(np.diff(end)) + 1
    named = {int(end[g[0]]): ids[g] for g in np.split(np.arange(len(ids)), bounds)}
    for k in np.flatnonzero(plain).tolist():
        own, up = named.get(k), int(parent[k])
        digest = NONE if own is None else hashlib.sha256(",".join(map(str, own.tolist())).encode()).hexdigest()
        emit(kind=NODE, conv_id=int(least[k]), depth=int(depth[k]), n_convs=int(members[k]), n_children=int(children[k]),
             n_leaves=int(leaves[k]), saved_tokens=int(savings[k]), ends_sha256=digest,
             **({"parent_key": known[up]} if spine[up] else {"parent_conv_id": int(least[up])}))
    for k in np.flatnonzero(spine).tolist():
        emit(kind=SPINE, conv_id=int(least[k]), depth=int(depth[k]), n_convs=int(members[k]), n_children=int(children[k]),
             n_leaves=int(leaves[k]), saved_tokens=int(savings[k]), key=known[k],
             parent_key=known[int(parent[k])] if k else None, bytes=int(text[k]),
             first_path=2 * shard + (not on_first[k]), last_path=2 * shard + bool(on_last[k]))
        own = named.get(k, ())
        for piece, at in enumerate(range(0, len(own), PIECE // WIDTH)):
            emit(kind=ENDS, key=known[k], first_path=shard, piece=piece,
                 ids=",".join(map(str, own[at:at + PIECE // WIDTH].tolist())))
    return out


def _shards(batches):
    from pyspark import TaskContext

    ids, keys, sizes = [], [], []
    for batch in batches:
        ids.append(batch.column(0).to_numpy())
        keys += batch.column(1).to_pylist()
        sizes.append(batch.column(2).flatten().to_numpy())
    if keys:
        made = shard_rows(TaskContext.get().partitionId(), np.concatenate(ids), keys, np.concatenate(sizes))
        for at in range(0, len(made["kind"]), 10_000):
            yield pa.RecordBatch.from_pydict({n: v[at:at + 10_000] for n, v in made.items()}, pa.schema(_FIELDS))


def _digests(batches):
    """One row per key, from its pieces in order; only a running digest is kept."""
    key, running = None, None
    for batch in batches:
        done = []
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != key:
                if key is not None:
                    done.append((key, running.hexdigest()))
                key, running = own, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()),
                                          pa.array([d for _, d in done], pa.string())], ["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends"])


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and ``t``, its turns in order: place, digest of role and text, bytes of the text."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    placed = rows.withColumn("place", F.row_number().over(order)).select(
        "conv_id", F.struct("place", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes")).alias("x"))
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("t"))


def borrow_openings(lists: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Every conversation starts with the first turns of its family's first conversation.

    Of conversation c - c % family the first h = crc32(c as text) % most turns come first, then c's own behind its
    first h.
    """
    heads = lists.select(F.col("conv_id").alias("base"), F.slice("t", 1, most - 1).alias("head"))
    own = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int"))
    none = F.expr("slice(t, 1, 0)")
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
        F.slice("t", F.col("h") + 1, F.size("t"))).alias("t"))


def _merged(spines: DataFrame, pieces: DataFrame) -> DataFrame:
    """Spine nodes whole: the shards' counts added, and what lies below them on other paths."""
    m = spines.groupBy("depth", "key").agg(
        F.min("parent_key").alias("parent_key"), F.min("first_path").alias("first_path"),
        F.max("last_path").alias("last_path"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("bytes").alias("bytes"))
    below = m.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("more"))
    m = m.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    m = scratch(m.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
                .withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")), "trie-spines")
    # New nodes of a path are its deep end; whatever opens on later paths up to the last lies below as well.
    deeper = Window.partitionBy("first_path").orderBy(F.col("depth").desc())
    paths = m.select(F.col("first_path").alias("path"), "leaf", "own").unionByName(
        m.select(F.col("last_path").alias("path"), F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("own")))
    upto = Window.orderBy("path")  # one row for each end of a shard
    runs = scratch(paths.groupBy("path").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own")).select(
        "path", F.sum("leaf").over(upto).alias("leaf"), F.sum("own").over(upto).alias("own")), "trie-paths")
    m = m.withColumn("deep_leaf", F.sum("leaf").over(deeper)).withColumn("deep_own", F.sum("own").over(deeper))
    for side in ("first", "last"):
        m = m.join(runs.select(F.col("path").alias(f"{side}_path"), F.col("leaf").alias(f"{side}_leaf"),
                               F.col("own").alias(f"{side}_own")), f"{side}_path")
    ordered = pieces.repartition("key").sortWithinPartitions("key", "first_path", "piece").select("key", "ids")
    ends = ordered.mapInArrow(_digests, "key binary, ends string")
    whole = lambda c, kind: (F.col(c) + F.col(f"deep_{kind}") + F.col(f"last_{kind}") - F.col(f"first_{kind}")).alias(c)
    return m.join(ends, "key", "left").select(
        "conv_id", "depth", "parent_key", "key", "n_convs", "n_children", whole("n_leaves", "leaf"),
        whole("saved_tokens", "own"), F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"))


def nodes(lists: DataFrame) -> DataFrame:
    """Every node of the trie of ``lists`` (conv_id, t), one row each."""
    spark = lists.sparkSession
    lists = scratch(lists, "trie-lists")
    total = lists.agg(F.sum(F.size("t") + 1)).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-total // SHARD_TURNS))
    key = F.unhex(F.array_join(F.col("t.digest"), "")).alias("key")
    made = scratch(lists.select("conv_id", key, F.col("t.bytes").alias("sizes"))
                   .repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
                   .mapInArrow(_shards, SCHEMA), "trie-shards")
    spines = scratch(_merged(made.where(F.col("kind") == SPINE), made.where(F.col("kind") == ENDS)), "trie-merged")
    names = spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("spine_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    plain = made.where(F.col("kind") == NODE)
    inner = plain.where(F.col("parent_key").isNull()).select(*columns)
    # Many nodes may hang on one spine node, the root above all.
    outer = join_hot_keys(plain.where(F.col("parent_key").isNotNull()).drop("parent_conv_id"), names, ["parent_key"],
                          salt_by=["conv_id", "depth"])
    top = spines.join(names, "parent_key", "left")
    return inner.unionByName(outer.withColumnRenamed("spine_conv_id", "parent_conv_id").select(*columns)).unionByName(
        top.withColumnRenamed("spine_conv_id", "parent_conv_id").select(*columns))
