"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. It is posted, with that order, in the inverted
files of the first pivots of the order; a query visits the files of its own first pivots. Candidates are
ranked by the footrule distance of the two orders, the best share of each file is reranked by the exact
Euclidean distance. A pair that meets in several files is looked at in the query's first one alone.

Equal vectors form one class that is indexed once, with its least ids, as many as can be among the nearest;
so copies of a vector cost nothing however many they are. Files are split into blocks of bounded size, and
queries too; tasks take one block of each and return the best few of it.

Pivots are a bounded sample: ``PIVOTS`` distinct vectors by hash order for each dimension. Vectors that are
null, empty, zero, or hold null or non-finite components take no part. Rows that repeat an id with its vector
count once. Vectors of different dimensions are never neighbours. Fewer candidates than asked give fewer
rows; an empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_rows, scratch

PIVOTS, ORDER = 256, 64
#: Files a vector is posted in, files a query visits.
POSTED, VISITED = 24, 10
#: Share of a file's candidates that is reranked, and the least number.
RERANK, RERANK_LEAST = 0.15, 128
#: Vectors and queries in one block of a file.
BLOCK, QUERY_BLOCK = 16_384, 1_024
#: Dimensions that one table may mix.
DIMENSIONS = 1_024


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(numbers, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(numbers, lambda x: x != 0), F.lit(False))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """Equal vectors as one row: class, dim, vector (bytes), ids (the ``k + 1`` least)."""
    least = Window.partitionBy("vector").orderBy("vec_id")
    top = rows.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= k + 1)
    return top.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("class"), (F.length("vector") / 8).cast("int").alias("dim"),
        "vector", "ids")


def as_bytes(vectors: DataFrame, vector: str) -> DataFrame:
    """vec_id and the vector as little-endian doubles, rows that take no part left out."""

    def convert(batches):
        for batch in batches:
            data = [np.array(v, "<f8") + 0.0 for v in batch.column(1).to_pylist()]  # -0.0 becomes 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([v.tobytes() for v in data], pa.binary())], ["vec_id", "vector"])

    rows = vectors.where(usable(F.col(vector)) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(convert, "vec_id long, vector binary").distinct()


def pivots_of(found: DataFrame) -> dict[int, np.ndarray]:
    """Pivots by dimension."""
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vector"), "vector")
    rows = bounded_rows(found.select("dim", "vector").withColumn("rank", F.row_number().over(order))
                        .where(F.col("rank") <= PIVOTS), PIVOTS * DIMENSIONS, "pivots")
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["dim"], r["rank"])):
        out.setdefault(r["dim"], []).append(np.frombuffer(r["vector"], "<f8"))
    return {d: np.stack(v) for d, v in out.items()}


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to one vector, by plain differences."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def with_order(found: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``order``: the ids of the nearest pivots (16 bit), nearest first."""
    shared = found.sparkSession.sparkContext.broadcast(pivots)
    kinds = ", ".join(f"`{c}` {t}" for c, t in found.dtypes)

    def add(batches):
        own = shared.value
        for batch in batches:
            orders = []
            for dim, data in zip(batch.column("dim").to_pylist(), batch.column("vector").to_pylist()):
                far = distances(own[dim], np.frombuffer(data, "<f8"))
                orders.append(np.argsort(far, kind="stable")[:ORDER].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(orders, pa.binary())],
                                             [*batch.schema.names, "order"])

    return found.mapInArrow(add, kinds + ", order binary")


def posted(indexed: DataFrame, files: int) -> DataFrame:
    """One row per file that a vector belongs to: pivot, and the row's columns."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in indexed.dtypes)

    def post(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            orders = [np.frombuffer(o, "<u2")[:files] for o in batch.column("order").to_pylist()]
            row = np.repeat(np.arange(batch.num_rows), [len(o) for o in orders])
            for at in range(0, len(row), 20_000):
                some = pa.array(row[at:at + 20_000])
                pivot = pa.array(np.concatenate(orders)[at:at + 20_000].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(c.take(some) for c in batch.columns), pivot],
                                                 [*batch.schema.names, "pivot"])

    return indexed.mapInArrow(post, kinds + ", pivot int")


def search_block(frame, k: int):
    """The nearest classes of every query of one block, among the vectors of one block of the same file."""
    import pandas as pd

    data, asked = frame[frame["side"] == 0], frame[frame["side"] == 1]
    out: dict = {"query": [], "ids": [], "score": []}
    if len(data) and len(asked):
        pivot = int(frame["pivot"].iloc[0])
        vectors = np.stack([np.frombuffer(v, "<f8") for v in data["vector"]])
        orders = np.stack([np.frombuffer(o, "<u2") for o in data["order"]]).astype(np.int64)
        width = orders.shape[1]
        rows = np.arange(len(data))[:, None]
        place = np.full((len(data), PIVOTS), width, np.int16)
        place[rows, orders] = np.arange(width, dtype=np.int16)
        least, ids = np.array([i[0] for i in data["ids"]]), list(data["ids"])
        for name, vector, order in zip(asked["class"], asked["vector"], asked["order"]):
            order = np.frombuffer(order, "<u2").astype(np.int64)
            own = np.full(PIVOTS, width, np.int16)
            own[order] = np.arange(width, dtype=np.int16)
            earlier = order[:own[pivot]]
            mine = np.flatnonzero(~(place[:, earlier] < POSTED).any(axis=1))
            if not len(mine):
                continue
            footrule = np.abs(place[mine] - own).sum(axis=1, dtype=np.int64)
            count = min(len(mine), max(RERANK_LEAST, int(len(mine) * RERANK)))
            best = mine[np.argpartition(footrule, count - 1)[:count]]
            far = distances(vectors[best], np.frombuffer(vector, "<f8"))
            pick = np.lexsort((least[best], far))[:k + 1]
            out["query"] += [int(name)] * len(pick)
            out["ids"] += [list(map(int, ids[i])) for i in best[pick]]
            out["score"] += far[pick].tolist()
    return pd.DataFrame({"query": np.array(out["query"], np.int64), "ids": pd.Series(out["ids"], dtype=object),
                         "score": np.array(out["score"], float)})


def search(vectors: DataFrame, wanted: Column, k: int = 10, vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of every row where ``wanted`` (on vec_id) holds: query_id, rank, vec_id, score."""
    rows = scratch(as_bytes(vectors, vector), "index-vectors")
    found = scratch(classes(rows, k), "index-classes")
    index = scratch(with_order(found, pivots_of(found)), "index-orders")
    queries = scratch(rows.where(wanted).join(found.select("vector", "class"), "vector").select(
        F.col("vec_id").alias("query_id"), "class"), "index-queries")
    asked = index.join(queries.select("class").distinct(), "class", "left_semi")
    sides = [posted(index, POSTED).withColumn("side", F.lit(0)), posted(asked, VISITED).withColumn("side", F.lit(1))]
    files = scratch(sides[0].unionByName(sides[1]), "index-files")
    sizes = files.groupBy("dim", "pivot").agg(
        F.ceil(F.sum(1 - F.col("side")) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.sum("side") / QUERY_BLOCK).cast("int").alias("query_blocks")).where("blocks > 0 and query_blocks > 0")
    cut = files.join(F.broadcast(scratch(sizes, "index-sizes")), ["dim", "pivot"])
    own = F.when(F.col("side") == 0, F.pmod(F.xxhash64("class"), F.col("blocks"))).otherwise(
        F.pmod(F.xxhash64("class"), F.col("query_blocks")))
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("query_blocks"))
                                 .otherwise(F.col("blocks")) - 1))
    cut = cut.withColumn("own", own.cast("int")).withColumn("other", other).select(
        "dim", "pivot", "class", "vector", "order", "ids", "side",
        F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")).alias("block"),
        F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")).alias("query_block"))
    near = cut.groupBy("dim", "pivot", "block", "query_block").applyInPandas(
        lambda frame: search_block(frame, k), "query long, ids array<long>, score double")
    top = Window.partitionBy("query").orderBy("score", F.get("ids", F.lit(0)))
    best = scratch(near.withColumn("place", F.row_number().over(top)).where(F.col("place") <= k + 1)
                   .select("query", "score", F.explode("ids").alias("vec_id")), "index-found")
    each = (queries.distinct().join(best.withColumnRenamed("query", "class"), "class")
            .where(F.col("vec_id") != F.col("query_id")))
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (each.select("query_id", "vec_id", "score").distinct()
            .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
