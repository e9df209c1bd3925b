"""Hard-negative mining with a multiway hyperplane tree (GNAT).

Vectors become integers, floor(256 x); a score is their inner product. Every node of the tree has split points,
and a vector goes to the nearest one. Over all vectors below, a node stores for each pair (i, j) of split points
the least and greatest distance from point i to the subtree of j, and the least and greatest norm in it. A query
asks for scores between two bounds. With the norms that is an annulus of distances around the query, and a subtree
is dropped as soon as one split point's range shows that it lies outside. The leaves left are searched exactly.

Two rounds find the best few of a window: the query's own leaf gives a first bound, which narrows the window for
all other leaves. Positives (same label) are found first, then the negatives below each of them.

Equal vectors of one label are one class with its least ids, as many as can be among the best; copies cost nothing
then. Leaves are cut into blocks of bounded size and queries into chunks; a task takes one of each. The tree is
fitted on a bounded sample, ``SAMPLE`` classes by hash order, but all classes are indexed and ranges cover them all,
so results are exact.

Rows with null id, label or vector, or with a null or non-finite component take no part. An id that comes more than
once counts once, with its least label and vector. Vectors of different dimensions never meet; empty vectors score 0.
Components are held within 62 bits and scores within 64. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_rows, scratch

#: Classes that the tree is fitted on, split points of a node, classes meant for a leaf, and levels.
SAMPLE, FAN, LEAF, DEEP = 16_384, 16, 4_096, 8
#: Classes in a block of a leaf, and queries in a chunk.
BLOCK, CHUNK = 8_192, 1_024
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
SCALE, HELD = 256.0, float(1 << 62)
#: Share by which computed distances may be off.
SLACK = 1e-9


def numbers(data: bytes, dim: int) -> np.ndarray:
    """The integers of a stored vector: 4 or 8 bytes each."""
    return np.frombuffer(data, "<i4" if len(data) == 4 * dim else "<i8").astype(np.int64)


def as_rows(vectors: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """vec_id, label, dim, vector (bytes of integers) and class of all rows that take part, one per id."""
    kept = vectors.where(F.col(vec_id).isNotNull() & label.isNotNull() & F.coalesce(F.forall(
        F.col(vector).cast("array<double>"),
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))), F.lit(False)))

    def convert(batches):
        for batch in batches:
            dims, data = [], []
            for v in batch.column(2).to_pylist():
                v = np.clip(np.floor(SCALE * np.array(v, float)), -HELD, HELD)
                dims.append(len(v))
                data.append(v.astype("<i4" if not len(v) or np.abs(v).max() < 1 << 31 else "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()),
                                              pa.array(data, pa.binary())], ["vec_id", "label", "dim", "vector"])

    made = kept.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                       F.col(vector).cast("array<double>").alias("v")).mapInArrow(
        convert, "vec_id long, label long, dim int, vector binary")
    one = made.groupBy("vec_id").agg(F.min(F.struct("label", "dim", "vector")).alias("x")).select("vec_id", "x.*")
    mark = F.concat_ws(":", F.col("label").cast("string"), F.col("dim").cast("string"), F.hex("vector"))
    return one.withColumn("class", F.unhex(F.md5(mark)))


def classes(rows: DataFrame, most: int) -> DataFrame:
    """Equal vectors of one label as one row with their ``most`` least ids."""
    order = Window.partitionBy("class").orderBy("vec_id")
    least = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    return least.groupBy("class").agg(F.first("label").alias("label"), F.first("dim").alias("dim"),
                                      F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


@dataclass
class Split:
    """One inner node: split points, what lies below each (a node or, if negative, a leaf), and the ranges."""

    points: np.ndarray
    below: list[int]
    near: np.ndarray = field(default=None)
    far: np.ndarray = field(default=None)
    small: np.ndarray = field(default=None)
    large: np.ndarray = field(default=None)

    def __post_init__(self):
        k = len(self.points)
        self.near, self.far = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        self.small, self.large = np.full(k, np.inf), np.full(k, -np.inf)


def far_apart(vectors: np.ndarray, count: int) -> np.ndarray:
    """Places of distinct vectors, each as far as can be from those before."""
    chosen = [0]
    gap = distances(vectors, vectors[0])
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(vectors, vectors[chosen[-1]]))
    return np.array(chosen)


def distances(vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - to) ** 2).sum(axis=1))


class Tree:
    """Inner nodes in order of making, the root first; ``leaves`` counts the leaves, numbered from 1."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.splits: list[Split] = []
        self.leaves = 0
        self.root = self._grow(sample.astype(float), rows / max(1, len(sample)), 0)

    def _grow(self, sample: np.ndarray, each: float, level: int) -> int:
        chosen = far_apart(sample[:FAN * 24], FAN) if len(sample) * each > LEAF and level < DEEP and len(sample) else []
        if len(chosen) < 2:
            self.leaves += 1
            return -self.leaves
        here = len(self.splits)
        self.splits.append(Split(sample[chosen], [0] * len(chosen)))
        own = self.nearest(self.splits[here], sample)[0]
        self.splits[here].below = [self._grow(sample[own == j], each, level + 1) for j in range(len(chosen))]
        return here

    @staticmethod
    def nearest(split: Split, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gaps = np.stack([distances(vectors, p) for p in split.points], axis=1)
        return gaps.argmin(axis=1), gaps

    def place(self, vectors: np.ndarray, seen=None) -> np.ndarray:
        """Leaf of every vector; ``seen(node, child, gaps, rows)`` is told of each step down."""
        leaf = np.zeros(len(vectors), np.int64)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                leaf[rows] = -node
            elif len(rows):
                own, gaps = self.nearest(self.splits[node], vectors[rows])
                for j in np.unique(own).tolist():
                    if seen:
                        seen(node, j, gaps[own == j], rows[own == j])
                    todo.append((self.splits[node].below[j], rows[own == j]))
        return leaf

    def visits(self, query: np.ndarray, low: list[int], high: list[int]) -> list[int]:
        """Leaves that can hold a vector whose score with the query lies in one of the windows."""
        own = float((query.astype(float) ** 2).sum())
        low, high = np.array(low, float)[:, None], np.array(high, float)[:, None]
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if node < 0:
                out.append(-node)
                continue
            split = self.splits[node]
            gaps = distances(split.points, query.astype(float))[:, None]
            slack = SLACK * (1 + gaps.max() + np.where(np.isfinite(split.far), split.far, 0).max())
            inner = np.maximum(np.maximum(gaps - split.far, split.near - gaps).max(axis=0), 0) - slack
            outer = (gaps + split.far).min(axis=0) + slack
            # Annulus of each window around the query, for each subtree's norms.
            begin = own + split.small - 2 * high
            end = own + split.large - 2 * low
            loose = SLACK * (1 + own + np.where(np.isfinite(split.large), split.large, 0))
            meets = (np.maximum(inner, 0) ** 2 <= end + loose) & (outer ** 2 >= begin - loose)
            full = np.isfinite(split.small)
            todo += [split.below[j] for j in np.flatnonzero(full & meets.any(axis=0)).tolist()]
        return out


def fit(found: DataFrame) -> dict[int, Tree]:
    """A tree for every dimension in the sample, its ranges taken over all classes."""
    size = found.count()
    rows = found.select("dim", "vector", "class").orderBy("class").limit(SAMPLE).collect()
    trees = {}
    for dim in sorted({r["dim"] for r in rows}):
        vectors = list(dict.fromkeys(r["vector"] for r in rows if r["dim"] == dim))
        share = size * sum(r["dim"] == dim for r in rows) / max(1, len(rows))
        trees[dim] = Tree(np.stack([numbers(v, dim) for v in vectors]), int(share))
    shared = found.sparkSession.sparkContext.broadcast(trees)

    def measure(batches):
        best: dict = {}
        for batch in batches:
            for dim, vectors, _ in by_dimension(batch):
                if dim in shared.value:
                    norms = (vectors ** 2).sum(axis=1)

                    def seen(node, child, gaps, rows):
                        now = np.stack([np.append(gaps.min(axis=0), norms[rows].min()),
                                        np.append(gaps.max(axis=0), norms[rows].max())])
                        old = best.get((dim, node, child))
                        best[dim, node, child] = now if old is None else np.stack(
                            [np.minimum(old[0], now[0]), np.maximum(old[1], now[1])])

                    shared.value[dim].place(vectors, seen)
        rows = [(*key, i, float(lo), float(hi)) for key, (least, most) in best.items()
                for i, (lo, hi) in enumerate(zip(least, most))]
        yield pa.RecordBatch.from_pylist([dict(zip(("dim", "node", "child", "point", "least", "most"), r)) for r in rows],
                                         pa.schema([(n, pa.int32()) for n in ("dim", "node", "child", "point")]
                                                   + [(n, pa.float64()) for n in ("least", "most")]))

    ranges = found.select("dim", "vector").mapInArrow(
        measure, "dim int, node int, child int, point int, least double, most double").groupBy(
        "dim", "node", "child", "point").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    for r in bounded_rows(ranges, SAMPLE * (FAN + 1), "ranges"):
        split = trees[r["dim"]].splits[r["node"]]
        if r["point"] == len(split.points):
            split.small[r["child"]], split.large[r["child"]] = r["least"], r["most"]
        else:
            split.near[r["point"], r["child"]], split.far[r["point"], r["child"]] = r["least"], r["most"]
    return trees


def by_dimension(batch):
    """(dim, vectors as floats, their rows) of a batch with columns dim and vector."""
    dims = np.array(batch.column("dim").to_pylist(), int)
    data = batch.column("vector").to_pylist()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, np.stack([numbers(data[i], dim) for i in rows.tolist()]).astype(float), rows


def with_leaf(found: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Add ``leaf``; dimensions without a tree are one leaf, 0."""
    shared = found.sparkSession.sparkContext.broadcast(trees)

    def add(batches):
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for dim, vectors, rows in by_dimension(batch):
                if dim in shared.value:
                    leaf[rows] = shared.value[dim].place(vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    return found.mapInArrow(add, ", ".join(f"`{c}` {t}" for c, t in found.dtypes) + ", leaf long")


def scores(asked: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, held within 64 bits."""
    bound = float(np.abs(asked).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, asked.shape[1])
    if bound < 1 << 53:
        return (asked.astype(float) @ vectors.astype(float).T).astype(np.int64)
    if bound < 1 << 63:
        return asked @ vectors.T
    exact = asked.astype(object) @ vectors.astype(object).T
    return np.vectorize(lambda x: min(max(int(x), LOWEST), HIGHEST), otypes=[np.int64])(exact)


def search_block(queries, data, same: bool, best: int):
    """The best of every window of every query among one block's classes of the same or of other labels."""
    import pandas as pd

    out: dict[str, list] = {"class": [], "window": [], "vec_id": [], "score": []}
    if len(queries) and len(data):
        dim = int(data["dim"].iloc[0])
        ids, labels = list(data["ids"]), data["label"].to_numpy()
        least = np.array([i[0] for i in ids], np.int64)
        found = scores(np.stack([numbers(v, dim) for v in queries["vector"]]),
                       np.stack([numbers(v, dim) for v in data["vector"]]))
        for row, (name, label, low, high) in enumerate(zip(queries["class"], queries["label"], queries["low"], queries["high"])):
            mine = np.flatnonzero((labels == label) == same)
            got = found[row, mine]
            for window, (a, b) in enumerate(zip(low, high)):
                inside = np.flatnonzero((got >= a) & (got <= b))
                if len(inside) > best:  # the best classes, ties whole, before any sorting
                    cut = np.partition(got[inside], len(inside) - best)[len(inside) - best]
                    inside = inside[got[inside] >= cut]
                pick = inside[np.lexsort((least[mine[inside]], -got[inside]))][:best]
                each = sorted((-int(got[p]), int(i)) for p in pick for i in ids[mine[p]])[:best]
                out["class"] += [name] * len(each)
                out["window"] += [window] * len(each)
                out["vec_id"] += [i for _, i in each]
                out["score"] += [-s for s, _ in each]
    return pd.DataFrame({"class": pd.Series(out["class"], dtype=object), "window": np.array(out["window"], np.int32),
                         "vec_id": np.array(out["vec_id"], np.int64), "score": np.array(out["score"], np.int64)})


def visit(asked: DataFrame, index: DataFrame, same: bool, best: int) -> DataFrame:
    """class, window, vec_id, score: the best of each window in every leaf asked.

    ``asked`` has dim, leaf, class, label, vector and the windows' bounds ``low`` and ``high``.
    """
    sizes = index.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).join(
        asked.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")), ["dim", "leaf"])
    # One row a leaf, and the sample bounds their number.
    sizes = F.broadcast(scratch(sizes, "tree-sizes"))
    own = lambda parts: F.pmod(F.xxhash64("class"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    blocks = index.join(sizes, ["dim", "leaf"]).withColumn("block", own("blocks")).withColumn("chunk", every("chunks"))
    chunks = asked.join(sizes, ["dim", "leaf"]).withColumn("chunk", own("chunks")).withColumn("block", every("blocks"))
    key = ["dim", "leaf", "block", "chunk"]
    found = chunks.groupBy(*key).cogroup(blocks.select(*key, "class", "label", "vector", "ids").groupBy(*key)).applyInPandas(
        lambda q, d: search_block(q, d, same, best), "class binary, window int, vec_id long, score long")
    order = Window.partitionBy("class", "window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def best_in_windows(queries: DataFrame, index: DataFrame, trees: dict[int, Tree], same: bool, best: int) -> DataFrame:
    """The ``best`` of every window over all leaves: class, window, vec_id, score, rank.

    The query's own leaf is searched first; what it holds narrows each window for the other leaves.
    """
    shared = queries.sparkSession.sparkContext.broadcast(trees)
    first = scratch(visit(queries, index, same, best), "tree-first")
    bound = first.where(F.col("rank") == best).select("class", F.struct("window", "score").alias("x")).groupBy(
        "class").agg(F.map_from_entries(F.collect_list("x")).alias("bound"))
    narrowed = queries.join(bound, "class", "left").withColumn("low", F.when(F.col("bound").isNull(), F.col("low")).otherwise(
        F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("bound", i), x))))).drop("bound")

    def choose(batches):
        for batch in batches:
            rows, leaves = [], []
            columns = [batch.column(c).to_pylist() for c in ("dim", "vector", "leaf", "low", "high")]
            for row, (dim, vector, home, low, high) in enumerate(zip(*columns)):
                if dim in shared.value and low:
                    others = [x for x in shared.value[dim].visits(numbers(vector, dim), low, high) if x != home]
                    rows += [row] * len(others)
                    leaves += others
            for at in range(0, len(rows), 10_000):
                some = batch.drop_columns(["leaf"]).take(pa.array(rows[at:at + 10_000], pa.int64()))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(leaves[at:at + 10_000], pa.int64())],
                                                 [*some.schema.names, "leaf"])

    plain = narrowed.select("class", "label", "dim", "vector", "low", "high", "leaf")
    asked = scratch(plain.mapInArrow(choose, "class binary, label long, dim int, vector binary, low array<long>, "
                                             "high array<long>, leaf long"), "tree-visits")
    both = first.drop("rank").unionByName(visit(asked, index, same, best).drop("rank"))
    order = Window.partitionBy("class", "window").orderBy(F.col("score").desc(), "vec_id")
    return scratch(both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best), "tree-best")


def mine(vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 5, percent: int = 80,
         vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For every row where ``anchors`` (on vec_id) holds and each of its best positives, the best negatives.

    Negatives score at most as much as the positive, and at least ``percent`` of it.
    """
    rows = scratch(as_rows(vectors, vec_id, label, vector), "tree-rows")
    found = scratch(classes(rows, max(positives + 1, negatives)), "tree-classes")
    trees = fit(found)
    index = scratch(with_leaf(found, trees), "tree-index")
    asking = rows.where(anchors).select(F.col("vec_id").alias("anchor_id"), "class")
    bounds = [F.array(F.lit(x).cast("long")).alias(n) for n, x in (("low", LOWEST), ("high", HIGHEST))]
    asked = scratch(index.join(asking.select("class").distinct(), "class", "left_semi").select(
        "class", "label", "dim", "vector", "leaf", *bounds), "tree-queries")
    # One more than wanted: the anchor itself is among its class's best.
    good = best_in_windows(asked, index, trees, True, positives + 1).select(
        "class", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score").cast("decimal(38,0)")
    lowest = F.ceil(score * percent / 100).cast("long")
    windows = good.groupBy("class").agg(F.sort_array(F.collect_list(F.struct(
        "place", lowest.alias("low"), F.col("positive_score").alias("high")))).alias("w"))
    asked = asked.drop("low", "high").join(windows, "class").select(
        "class", "label", "dim", "vector", "leaf", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    bad = best_in_windows(scratch(asked, "tree-windows"), index, trees, False, negatives).select(
        "class", (F.col("window") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    mates = Window.partitionBy("anchor_id").orderBy("place")
    own = asking.join(good, "class").where(F.col("positive_id") != F.col("anchor_id")).withColumn(
        "mate", F.row_number().over(mates)).where(F.col("mate") <= positives)
    return own.join(bad, ["class", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        "negative_score")
