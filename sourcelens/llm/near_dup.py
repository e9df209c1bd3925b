"""Near-duplicate documents: b-bit MinHash signatures joined by multi-index Hamming search.

A signature has 48 symbols of 16 bits in 12 chunks of 4. If two signatures differ in at most 23 symbols,
some chunk differs in at most one, so the pair meets under one of the chunk's four keys that leave one symbol
out: enumerating these allowed errors finds every pair within that distance. A pair of similarity 0.8
exceeds the distance with probability below 1e-5, and even then meets with overwhelming probability.

Documents with equal shingle sets form one class and go on as one representative. Within a bucket of equal
keys, pairs are not enumerated: every member is first tested against a few members of the bucket, which joins
most groups of near copies into one component. Buckets that still hold several components are then gone
through in pairs of blocks of bounded size. First by signatures alone: members stay that have another of a
different component within the signature distance. Then by whole sets, which only these are sent with: a task
compares them by an inverted list and returns at most one link for each two components it joins. Links are
confirmed on full shingle sets; what is lost at most are pairs beyond the signature distance.

Null and empty texts have no shingles and are linked with nothing, nor are rows without a doc_id, which have no
component and are kept. Repeated rows fall into one class. An
empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, text_of
from .words import mixed, shingles, word_hashes

CHUNKS, WIDTH = 12, 4
SYMBOLS = CHUNKS * WIDTH
#: Members of each bucket that all its other members are tested against first.
STARS = 3
#: Symbols in which two signatures may differ: with one more, every chunk could differ in two.
DISTANCE = 2 * CHUNKS - 1
#: Members and shingles in one block of a bucket; larger buckets are split into pairs of blocks.
MEMBERS, BLOCK = 4_096, 1 << 20
#: Up to so many document ids are sent to all tasks; more are joined by a shuffle.
SENT_IDS = 1_000_000
#: Shingles whose hashes are held at once for one document.
SLAB = 1 << 16

_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, (2, SYMBOLS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(found: np.ndarray) -> np.ndarray:
    """16-bit symbols of the minima under ``SYMBOLS`` hash functions."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), SLAB):
        part = found[None, at:at + SLAB] * _SEEDS[0][:, None]
        part += _SEEDS[1][:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (mixed(least) >> np.uint64(48)).astype("<u2")


def signatures(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, class (hash of the whole set; null if empty) and signature of every row."""
    import xxhash

    def sign(batches):
        for batch in batches:
            out = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingles(word_hashes(value), words)
                if doc is None:
                    out.append((len(found), None, None))
                elif len(found):
                    out.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), signature(found).tobytes()))
                else:
                    out.append((0, None, None))
            n, kind, sig = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(kind, pa.binary()), pa.array(sig, pa.binary())],
                ["doc_id", "n_shingles", "class", "signature"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, class binary, signature binary")


def bucket_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, n) for each of the ``CHUNKS * WIDTH`` keys of every representative."""

    def keys(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(-1, CHUNKS, WIDTH)
            sig = sig.astype(np.int64)
            node, n = batch.column("node").to_numpy(), batch.column("n").to_numpy()
            for chunk in range(CHUNKS):
                for out in range(WIDTH):
                    a, b, c = (sig[:, chunk, i] for i in range(WIDTH) if i != out)
                    key = (np.int64(chunk * WIDTH + out) << 48) | (a << 32) | (b << 16) | c
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(n)], ["key", "node", "n"])

    return nodes.select("node", "n", "signature").mapInArrow(keys, "key long, node long, n long")


def could_link(a, b, percent: int):
    """Whether the sizes of two sets allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def full_sets(docs: DataFrame, ids: DataFrame, words: int, text: str) -> DataFrame:
    """(node, found): the whole shingle set of each document in ``ids`` (node)."""
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col("doc_id").cast("long").alias("node"), text_of(text).alias("text"))

    def sets(batches):
        for batch in batches:
            found = [shingles(word_hashes(t), words).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "found"])

    return scratch(rows.join(ids, "node", "left_semi").mapInArrow(sets, "node long, found array<long>"), "near-sets")


def confirmed(docs: DataFrame, pairs: DataFrame, words: int, percent: int, text: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have ``100 * common >= percent * together``."""
    ids = scratch(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-ids")
    full = full_sets(docs, ids, words, text)
    both = (pairs.join(full.select(F.col("node").alias("a"), F.col("found").alias("fa")), "a")
            .join(full.select(F.col("node").alias("b"), F.col("found").alias("fb")), "b"))
    common = F.size(F.array_intersect("fa", "fb"))
    sized = both.select("a", "b", (F.size("fa") + F.size("fb")).alias("total"), common.alias("common"))
    return sized.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent).select("a", "b")


def unite(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, component) after the links (a, b); a component's label is its least node.

    Every round hooks each component onto the least component it is linked with and follows the hooks to
    their ends. Both sides of each join come from written tables, so hot components are split.
    """
    while True:
        seen = (links.join(labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
                .join(labels.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
                .where(F.col("ca") != F.col("cb")))
        hooks = scratch(seen.select(F.greatest("ca", "cb").alias("component"), F.least("ca", "cb").alias("to"))
                        .groupBy("component").agg(F.min("to").alias("to")), "near-hooks")
        if hooks.isEmpty():
            return labels
        while True:
            onward = hooks.select(F.col("component").alias("to"), F.col("to").alias("onward"))
            moved = scratch(hooks.join(onward, "to", "left").select(
                "component", F.coalesce("onward", "to").alias("to"), F.col("onward").isNotNull().alias("moved")),
                "near-hooks")
            hooks = moved.drop("moved")
            if moved.where("moved").isEmpty():
                break
        labels = scratch(labels.join(hooks, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")), "near-labels")


def joining_links(frame, percent: int):
    """Links that join components among the members of one pair of blocks: columns a, b.

    Every two members of different components have one outside of the largest component; those are compared
    with all members by counting shared shingles over an inverted list.
    """
    import pandas as pd

    frame = frame.drop_duplicates("node")
    node, label = frame["node"].to_numpy(), frame["component"].to_numpy()
    found = list(frame["found"])
    size = np.array([len(f) for f in found])
    owner = np.repeat(np.arange(len(found)), size)
    every = np.concatenate(found) if found else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    names, count = np.unique(label, return_counts=True)
    parent = {int(x): int(x) for x in names}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a, b = [], []
    for i in np.flatnonzero(label != names[np.argmax(count)]):
        lo, hi = np.searchsorted(every, found[i], "left"), np.searchsorted(every, found[i], "right")
        sharing = np.concatenate([owner[x:y] for x, y in zip(lo, hi)])
        common = np.bincount(sharing, minlength=len(found))
        for j in np.flatnonzero((100 * common >= percent * (size + size[i] - common)) & (label != label[i])):
            x, y = top(int(label[i])), top(int(label[j]))
            if x != y:
                parent[x] = y
                a.append(int(node[i]))
                b.append(int(node[j]))
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def near_members(frame, percent: int):
    """Of one pair of blocks: members (key, node) within the signature distance of one of another component.

    Of any two members of different components one is outside of the largest, so only those look around.
    """
    import pandas as pd

    node, label, n = (frame[c].to_numpy() for c in ("node", "component", "n"))
    signs = np.frombuffer(b"".join(frame["signature"]), "<u2").reshape(-1, SYMBOLS)
    names, count = np.unique(label, return_counts=True)
    looking = np.flatnonzero(label != names[np.argmax(count)])
    close = np.zeros(len(node), bool)
    for at in range(0, len(looking), 64):
        own = looking[at:at + 64]
        differ = (signs[own][:, None, :] != signs[None, :, :]).sum(axis=2, dtype=np.int16)
        able = np.minimum(n[own][:, None], n) * 100 >= np.maximum(n[own][:, None], n) * percent
        near = (differ <= DISTANCE) & able & (label[own][:, None] != label)
        close[own] |= near.any(axis=1)
        close |= near.any(axis=0)
    return pd.DataFrame({"key": frame["key"].to_numpy()[close], "node": node[close]})


def in_blocks(rows: DataFrame, blocks) -> DataFrame:
    """Rows of a bucket in every pair of its blocks (block <= other); ``blocks`` is their number."""
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    each = rows.withColumn("own", own).withColumn("each", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return each.withColumn("block", F.least("own", "each")).withColumn("other", F.greatest("own", "each")).drop("own", "each")


def links_in_mixed_buckets(docs: DataFrame, members: DataFrame, signs: DataFrame, labels: DataFrame, words: int,
                           percent: int, text: str) -> DataFrame:
    """Links between components that share a bucket of more than two members, found on whole sets."""
    pair = ["key", "block", "other"]
    named = scratch(members.select("key", "node", "n").join(labels, "node"), "near-named")
    mixed = scratch(named.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
        .where("lo < hi and size > 2").select("key", F.ceil(F.col("size") / MEMBERS).cast("int").alias("blocks")), "near-mixed")
    held = scratch(named.join(mixed, "key"), "near-held")
    close = in_blocks(held.join(signs, "node"), F.col("blocks")).select(
        *pair, "node", "component", "n", "signature").groupBy(*pair).applyInPandas(
        lambda frame: near_members(frame, percent), "key long, node long")
    left = scratch(held.drop("blocks").join(scratch(close.distinct(), "near-close"), ["key", "node"]), "near-left")
    sizes = left.groupBy("key").agg(F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.count("*") / MEMBERS)).cast("int").alias("blocks"))
    full = full_sets(docs, scratch(left.select("node").distinct(), "near-ids"), words, text)
    cut = in_blocks(left.join(scratch(sizes, "near-sizes"), "key"), F.col("blocks")).join(full, "node").select(
        *pair, "node", "component", "found")
    return cut.groupBy(*pair).applyInPandas(lambda frame: joining_links(frame, percent), "a long, b long").distinct()


def components(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) and kept, one row per input row."""
    signed = scratch(signatures(docs, words, text), "near-signatures")
    classes = scratch(signed.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"),
        F.count("*").alias("copies")), "near-classes")
    keys = scratch(bucket_keys(classes), "near-keys")
    picks = [F.min("node")] + [F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(1, STARS)]
    shared = scratch(keys.groupBy("key").agg(F.array(*picks).alias("stars"), F.count("*").alias("size"))
                     .where("size > 1").select("key", "stars"), "near-shared")
    members = scratch(keys.join(shared, "key"), "near-members")
    sizes = classes.groupBy("node").agg(F.max("n").alias("n"))
    stars = members.select("node", "n", F.explode(F.array_distinct("stars")).alias("star")).where("star <> node").select(
        F.least("star", "node").alias("a"), F.greatest("star", "node").alias("b")).distinct()
    for side in ("a", "b"):
        stars = stars.join(sizes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}")), side)
    pairs = scratch(stars.where(could_link(F.col("na"), F.col("nb"), percent)).select("a", "b"), "near-pairs")
    labels = scratch(members.select("node").distinct().withColumn("component", F.col("node")), "near-nodes")
    labels = unite(labels, scratch(confirmed(docs, pairs, words, percent, text), "near-links"))
    signs = classes.select("node", "signature")
    found = links_in_mixed_buckets(docs, members, signs, labels, words, percent, text)
    labels = unite(labels, scratch(found, "near-links"))
    changed = classes.select("class", "node", "copies").join(labels, "node", "left").where(
        (F.col("copies") > 1) | (F.col("component") < F.col("node")))
    target = scratch(changed.select("class", F.coalesce("component", "node").alias("component")), "near-components")
    return signed.drop("signature").join(target, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """The documents, with all their columns, without those whose component has a smaller doc_id.

    Of rows that repeat a doc_id and its text, one stays. Rows without a doc_id stay.
    """
    found = scratch(components(docs.select("doc_id", text), words, percent, text), "near-result")
    gone = found.where("not kept").select("doc_id").distinct()
    again = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    gone, again = scratch(gone, "near-gone"), scratch(again, "near-again")
    if gone.count() <= SENT_IDS:
        gone = F.broadcast(gone)
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if again.isEmpty():
        return left
    if again.count() <= SENT_IDS:
        again = F.broadcast(again)
    single = left.join(again, "doc_id", "left_anti").select(*docs.columns)
    several = left.join(again, "doc_id", "left_semi").select(*docs.columns)
    return single.unionByName(several.dropDuplicates(["doc_id", text]))
