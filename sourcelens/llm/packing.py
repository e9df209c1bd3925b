"""Packing of token ids into windows by best-fit decreasing.

Documents longer than a window are first cut into full windows; what is left of each is placed, longest
first, into the open window with the least sufficient room, which a segment tree over the remaining
capacities finds. Pieces of one length are interchangeable, and so are windows with equal room, so the
placement is planned on the counts by length: at most ``capacity`` numbers, whatever the input. The plan is
a list of runs, each saying where the pieces of a range of ranks go; a piece's rank within its length
follows from counts by block of the tokenised table.

Null and empty texts are the end id alone. Repeated rows are packed row by row. An empty table packs to an
empty table. Extra columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_rows, scratch, text_of
from .token_ids import encoder

PIECES = ("doc_id long, start long, length int, ids_crc32 long, doc_tokens long, block long, nth long, ids binary")


@dataclass(frozen=True)
class Run:
    """Pieces of ``length`` from rank ``rank`` on: ``each`` per window, windows from ``window`` on, at ``offset``."""

    length: int
    rank: int
    each: int
    window: int
    offset: int


class RoomTree:
    """Segment tree over remaining capacities; a leaf holds the ranges of windows with that much room."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.windows: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        node = room + self.leaves
        self.any[node] = bool(self.windows[room])
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def push(self, room: int, first: int, last: int) -> None:
        if first < last:
            self.windows[room].append((first, last))
            self._mark(room)

    def pop(self, room: int) -> tuple[int, int]:
        found = self.windows[room].pop()
        self._mark(room)
        return found

    def tightest(self, least: int) -> int | None:
        """The smallest room of ``least`` or more that some window has."""
        node = least + self.leaves
        if self.any[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Run], list[tuple[int, int, int]]]:
    """Best-fit decreasing over counts by length: the runs, and (first, last, filled) of all windows."""
    tree, runs, opened = RoomTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, windows = capacity, -(-left // (capacity // length))
                first, last = opened, opened + windows
                opened = last
            else:
                first, last = tree.pop(room)
            each = room // length
            full = min(last - first, left // each)
            if full:
                runs.append(Run(length, rank, each, first, capacity - room))
                tree.push(room - each * length, first, first + full)
                left, rank, first = left - full * each, rank + full * each, first + full
            if left and first < last:
                runs.append(Run(length, rank, left, first, capacity - room))
                tree.push(room - left * length, first, first + 1)
                left, first = 0, first + 1
            tree.push(room, first, last)
    filled = sorted((a, b, capacity - room) for room, ranges in enumerate(tree.windows) for a, b in ranges)
    return runs, filled


def tokenise(docs: DataFrame, tokenizer: str, cut: str | None, end_id: int, capacity: int,
             text: str = "text", keep_ids: bool = True) -> DataFrame:
    """Pieces of every document. ``block`` and ``nth`` number the pieces of one length within a task."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text"))

    def pieces(batches):
        from pyspark import TaskContext

        coder = encoder(tokenizer, cut)
        end = np.array([end_id], coder.dtype).tobytes()
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                ids = np.frombuffer(ids + end, coder.dtype).astype("<u4")
                for start in range(0, len(ids), capacity):
                    own = ids[start:start + capacity]
                    data = own.tobytes()
                    out.append((doc, start, len(own), zlib.crc32(data), len(ids), block, int(seen[len(own)]),
                                data if keep_ids else None))
                    seen[len(own)] += 1
            if out:
                cols = list(zip(*out))
                types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 [x.split()[0] for x in PIECES.split(", ")])

    made = rows.mapInArrow(pieces, PIECES)
    return made if keep_ids else made.drop("ids")


def pack(docs: DataFrame, tokenizer: str, cut: str | None = None, end_id: int = 1, capacity: int = 2048,
         text: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece with its window: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens, padded_tokens, and ``ids`` (little-endian unsigned 32 bit) if they are kept.

    A window that is filled to a power of two stays as it is, any other is padded to the capacity.
    """
    made = scratch(tokenise(docs, tokenizer, cut, end_id, capacity, text, keep_ids), "packing-pieces")
    blocks = scratch(made.groupBy("length", "block").agg(F.count("*").alias("n")), "packing-blocks")
    counts = {r["length"]: r["n"] for r in bounded_rows(
        blocks.groupBy("length").agg(F.sum("n").alias("n")), capacity, "lengths")}
    runs, filled = plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = made.join(bases, ["length", "block"]).withColumn("rank", F.col("base") + F.col("nth"))
    return placed(ranked.drop("block", "nth", "base"), runs, filled, capacity)


def placed(ranked: DataFrame, runs: list[Run], filled: list[tuple[int, int, int]], capacity: int) -> DataFrame:
    """Look each piece's length and rank up in the plan, whose size follows from the capacity alone."""
    runs = sorted(runs, key=lambda r: (r.length, r.rank))
    by = {k: np.array([getattr(r, k) for r in runs], np.int64) for k in ("length", "rank", "each", "window", "offset")}
    edges = np.searchsorted(by["length"], np.arange(capacity + 2))
    firsts = np.array([a for a, _, _ in filled], np.int64)
    fills = np.array([f for _, _, f in filled], np.int64)
    fields = [c for c in ranked.columns if c != "rank"]
    kinds = dict(ranked.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in fields) + (
        ", sequence_id bigint, offset bigint, sequence_tokens bigint, padded_tokens bigint")

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for own in np.split(order, cuts):
                lo, hi = edges[length[own[0]]], edges[length[own[0]] + 1]
                at[own] = lo + np.searchsorted(by["rank"][lo:hi], rank[own], "right") - 1
            nth = rank - by["rank"][at]
            window = by["window"][at] + nth // by["each"][at]
            offset = by["offset"][at] + nth % by["each"][at] * length
            total = fills[np.searchsorted(firsts, window, "right") - 1]
            padded = np.where(total & (total - 1) == 0, total, capacity)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in fields), *(pa.array(x) for x in (window, offset, total, padded))],
                [*fields, "sequence_id", "offset", "sequence_tokens", "padded_tokens"])

    first = ["doc_id", "start", "length"]
    out = ranked.mapInArrow(place, schema).withColumn("length", F.col("length").cast("long"))
    return out.select(*first, *(c for c in out.columns if c not in first))


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each window in order: sequence_id, ids (binary), sequence_tokens, padded_tokens."""
    return (packed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
                 F.first("sequence_tokens").alias("sequence_tokens"), F.first("padded_tokens").alias("padded_tokens"))
            .select("sequence_id", F.aggregate(
                "parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"),
                "sequence_tokens", "padded_tokens"))
