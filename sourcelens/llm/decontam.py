"""Benchmark decontamination by greedy string tiling.

Words (lower case, punctuation at their ends removed) are hashed; windows of ``LEAST`` words that a document
shares with a benchmark item are its seeds. Where seeds could cover enough of an item, the document and the
item are tiled: the longest unmarked common run is marked, again and again, found by running Karp-Rabin
hashes at falling lengths. An item counts as leaked when its tiles cover ``COVERAGE`` of its words, in
whatever order the document has them.

The benchmark is taken in blocks of bounded size; each block is sent to all tasks and the documents pass it
once, without a shuffle.

Null and empty texts, and items of fewer than ``LEAST`` words, match nothing. Repeated documents are judged
row by row, repeated items report their id once. Items without an id are items like any other: they contaminate,
and their null id comes after all others. With an empty benchmark no document matches. Other columns
pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import text_of
from .words import MULTIPLIERS, REMEMBERED, mixed
from .worker_cache import held

LEAST = 4
COVERAGE = 0.5
#: Code points of the benchmark in one block.
BLOCK_CHARS = 8_000_000
MATCHES = "array<struct<item_id:bigint,coverage:double,tiles:int>>"
#: A bit table over the first bits of seeds, looked at before the exact seeds.
TABLE_BITS = 22
#: Odd, so that its powers have inverses: the base of the running hashes.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class _Bare(dict):
    """Hash of a word without the punctuation at its ends; 0 if nothing is left."""

    def __missing__(self, word: bytes) -> int:
        bare = word.decode("utf-8", "replace").lower()
        first, last = 0, len(bare)
        while first < last and not bare[first].isalnum():
            first += 1
        while last > first and not bare[last - 1].isalnum():
            last -= 1
        value = (xxhash.xxh64_intdigest(bare[first:last].encode()) or 1) if first < last else 0
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def bare_words(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").split()
    found = np.fromiter(map(held("bare words", _Bare).__getitem__, words), np.uint64, len(words))
    return found[found != 0]


def seeds_of(words: np.ndarray) -> np.ndarray:
    """Hash of every window of ``LEAST`` words."""
    n = len(words) - LEAST + 1
    if n <= 0:
        return words[:0]
    total = np.zeros(n, np.uint64)
    for i in range(LEAST):
        total += words[i:i + n] * MULTIPLIERS[i]
    return mixed(total)


class Items:
    """A block of the benchmark: words of each item, and its seeds with their places."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids, self.words = [], []
        for item, text in rows:
            words = bare_words(text)
            if len(words) >= LEAST:
                self.ids.append(item)
                self.words.append(words)
        own = [seeds_of(w) for w in self.words]
        seeds = np.concatenate(own) if own else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(own)), [len(s) for s in own])
        place = np.concatenate([np.arange(len(s)) for s in own]) if own else np.zeros(0, np.int64)
        order = np.argsort(seeds, kind="stable")
        self.item, self.place = item[order], place[order]
        self.seeds, self.first = np.unique(seeds[order], return_index=True)
        self.last = np.append(self.first[1:], len(seeds))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.seeds >> np.uint64(64 - TABLE_BITS)] = True

    def matches(self, words: np.ndarray, coverage: float) -> list[tuple[int, float, int]]:
        """(item id, coverage, tiles) of every item that the words cover well enough."""
        seeds = seeds_of(words)
        maybe = np.flatnonzero(self.table[seeds >> np.uint64(64 - TABLE_BITS)]) if len(seeds) else seeds
        if not len(maybe):
            return []
        at = np.minimum(np.searchsorted(self.seeds, seeds[maybe]), len(self.seeds) - 1)
        real = self.seeds[at] == seeds[maybe]
        where, at = maybe[real], at[real]
        if not len(where):
            return []
        distinct = np.unique(at)
        spread = np.concatenate([np.arange(self.first[i], self.last[i]) for i in distinct])
        out = []
        for item in np.unique(self.item[spread]).tolist():
            own = spread[self.item[spread] == item]
            target = self.words[item]
            able = np.zeros(len(target), bool)
            for i in range(LEAST):
                able[self.place[own] + i] = True
            if able.sum() < coverage * len(target):
                continue
            # Only stretches of the document under this item's seeds can hold a tile.
            mine = np.isin(self.seeds[at], seeds_of(target))
            under = np.zeros(len(words) + 1, bool)
            for i in range(LEAST):
                under[where[mine] + i] = True
            keep = np.flatnonzero(under[:-1])
            gaps = np.flatnonzero(np.diff(keep) > 1) + 1
            stretch = np.insert(words[keep], gaps, 0)
            tiles = greedy_tiles(target, stretch, LEAST)
            share = sum(n for _, _, n in tiles) / len(target)
            if share >= coverage:
                out.append((self.ids[item], share, len(tiles)))
        return out


def _running(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values times powers of the base, and the inverse powers (modulo 2**64)."""
    n = len(values)
    power, inverse = np.full((2, n + 1), 1, np.uint64)
    power[1:], inverse[1:] = BASE, BASE_INVERSE
    power, inverse = np.cumprod(power), np.cumprod(inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power[:n], out=sums[1:])
    return sums, inverse


def _windows(running, marked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``size`` that hold no marked place."""
    sums, inverse = running
    n = len(marked) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    taken = np.concatenate([[0], np.cumsum(marked)])
    starts = np.flatnonzero(taken[size:] == taken[:n])
    return starts, (sums[starts + size] - sums[starts]) * inverse[starts]


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping common runs (place in item, place in doc, length), longest first. Zeros never match."""
    tiles: list[tuple[int, int, int]] = []
    done_i, done_d = item == 0, doc == 0
    run_i, run_d = _running(item), _running(doc)
    size = max(least, min(len(item), len(doc), 32))
    while True:
        at_i, hash_i = _windows(run_i, done_i, size)
        at_d, hash_d = _windows(run_d, done_d, size)
        found = []
        if len(at_i) and len(at_d):
            order = np.argsort(hash_i, kind="stable")
            lo = np.searchsorted(hash_i[order], hash_d, "left")
            hi = np.searchsorted(hash_i[order], hash_d, "right")
            for d in np.flatnonzero(hi > lo):
                for i in at_i[order[lo[d]:hi[d]]]:
                    j = at_d[d]
                    if i and j and not done_i[i - 1] and not done_d[j - 1] and item[i - 1] == doc[j - 1]:
                        continue  # part of a run that starts further left
                    n = 0
                    while (i + n < len(item) and j + n < len(doc) and not done_i[i + n] and not done_d[j + n]
                           and item[i + n] == doc[j + n]):
                        n += 1
                    if n >= size:
                        found.append((n, int(i), int(j)))
        if found and max(found)[0] > 2 * size:
            size = max(found)[0]
            continue
        missed = False
        for n, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if done_i[i:i + n].any() or done_d[j:j + n].any():
                missed = True  # a longer tile took a part; what is left is found in the next pass
                continue
            done_i[i:i + n] = True
            done_d[j:j + n] = True
            tiles.append((i, j, n))
        if missed and not done_i.all():
            continue
        if size == least or done_i.all():
            return tiles
        size = max(least, size // 2)


def blocks(benchmark: DataFrame, text: str = "text", item: str = "item_id"):
    """The benchmark's items in blocks; only one block is on the driver at a time."""
    rows = benchmark.select(F.col(item).cast("long").alias("item_id"), text_of(text).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-total // BLOCK_CHARS))
    for block in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).distinct()
        yield Items(sorted(((r["item_id"], r["text"]) for r in own.collect()),
                           key=lambda x: (x[0] is None, x[0] or 0, x[1])))


def with_matches(docs: DataFrame, items: Items, out: str, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """Add to array column ``out`` the items of this block that each document has leaked."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    fresh = StructType.fromDDL(f"`{out}` {MATCHES}")
    first = out not in docs.columns
    schema = StructType(docs.schema.fields + fresh.fields) if first else docs.schema
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int32())]))

    def judge(batches):
        own = shared.value
        for batch in batches:
            at = batch.schema.get_field_index(out) if not first else -1
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = [[dict(zip(("item_id", "coverage", "tiles"), m)) for m in own.matches(bare_words(t or ""), coverage)]
                     for t in texts]
            if at >= 0:
                found = [a + b for a, b in zip(batch.column(at).to_pylist(), found)]
            columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(found, kind)]
            names = [n for i, n in enumerate(batch.schema.names) if i != at] + [out]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(judge, schema)


def report(docs: DataFrame, benchmark: DataFrame, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids (ascending), best_item_id, coverage."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text"))
    for items in blocks(benchmark):
        found = with_matches(found, items, "__leaks", "text", coverage)
    best = F.get(F.array_sort(F.transform("__leaks", lambda x: F.struct(
        (-x["coverage"]).alias("c"), x["item_id"].isNull().alias("n"), x["item_id"].alias("i")))), F.lit(0))
    return found.select(
        "doc_id", (F.size("__leaks") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.transform("__leaks", lambda x: x["item_id"]))).alias("item_ids"),
        best["i"].alias("best_item_id"), F.coalesce(-best["c"], F.lit(0.0)).alias("coverage"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """The documents, with all their columns, that leak no item."""
    for items in blocks(benchmark):
        docs = with_matches(docs, items, "__leaks", text, coverage).where(F.size("__leaks") == 0).drop("__leaks")
    return docs
