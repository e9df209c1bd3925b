"""Near duplicates, decontamination and nearest neighbours against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sourcelens.llm import decontam as D
from sourcelens.llm import near_dup as N
from sourcelens.llm import permutation_index as I
from sourcelens.llm.words import shingles, word_hashes


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute_components(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            least = min(label[a], label[b])
            if label[a] != label[b]:
                label[a] = label[b] = least
                changed = True
    return sorted((rows[i][0], len(sets[i]), label[i], label[i] == rows[i][0]) for i in range(len(rows)))


def varied(rnd, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.random()}"
    return " ".join(words)


def family_rows():
    """Copies of a few texts with few and many edits, in chains and stars, and hard single texts."""
    rnd = random.Random(5)
    rows, ids = [], iter(rnd.sample(range(1, 10_000), 600))
    for _ in range(4):
        base = " ".join(rnd.choice("lorem ipsum dolor sit amet sed do ut et ad".split()) + str(rnd.randrange(60))
                        for _ in range(120))
        for _ in range(45):
            rows.append((next(ids), varied(rnd, base, rnd.choice([0, 1, 2, 3, 4, 6, 9]))))
        link = base
        for _ in range(12):  # a chain: each resembles the one before, ends do not resemble each other
            link = varied(rnd, link, 2)
            rows.append((next(ids), link))
    rows += [(next(ids), t) for t in ("", "a", "A", "a b", "a B ", "one two three", "x " * 5_000, None, None, " \t\n")]
    return rows + [rows[0], rows[0], (0, rows[3][1].upper())]


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


@pytest.mark.parametrize("size,block,most", [(4, 1 << 20, 4_096), (5, 500, 7)])
def test_components_equal_brute_force(docs, monkeypatch, size, block, most):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "MEMBERS", most)
    rows = family_rows()
    assert result(N.components(docs(rows), size, 80)) == brute_components(rows, size, 80)


def test_only_members_within_the_signature_distance_go_on():
    import pandas as pd

    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 16, N.SYMBOLS)
    rows = []
    for i in range(300):  # one bucket: a large component, singles at every distance from it, a few of other sizes
        sign, gap = base.copy(), i % 48
        sign[rng.choice(N.SYMBOLS, gap, replace=False)] = rng.integers(1 << 16, 1 << 17, gap) % (1 << 16) ^ 1
        rows.append((5, i, 0 if i % 3 else i, 100 if i % 7 else 70, sign.astype("<u2").tobytes()))
    frame = pd.DataFrame(rows, columns=["key", "node", "component", "n", "signature"])
    signs = np.stack([np.frombuffer(r[4], "<u2") for r in rows])
    want = set()
    for a in rows:
        for b in rows:
            far = int((signs[a[1]] != signs[b[1]]).sum())
            if a[2] != b[2] and far <= 23 and 100 * min(a[3], b[3]) >= 80 * max(a[3], b[3]):
                want.add(a[1])
    got = N.near_members(frame, 80)
    assert set(got["node"]) == want and set(got["key"]) == {5} and 50 < len(want) < 300


def test_blocks_of_a_bucket_are_bounded_and_meet_in_pairs(llm):
    rows = llm.range(1_000).select(F.lit(1).alias("key"), F.col("id").alias("node"))
    cut = N.in_blocks(rows, F.lit(5)).groupBy("block", "other").agg(F.count("*").alias("n"), F.collect_set("node").alias("s")).collect()
    assert len(cut) == 15 and max(r["n"] for r in cut) < 600 and all(r["block"] <= r["other"] for r in cut)
    together = {(a, b) for r in cut for a in r["s"][:40] for b in r["s"][:40]}
    assert together and all(any(a in r["s"] and b in r["s"] for r in cut) for a in range(0, 1_000, 97) for b in range(0, 1_000, 89))


def test_one_document_of_each_group_stays(docs, llm):
    rows = family_rows()
    left = N.keep_one(docs(rows), 5, 80)
    assert left.columns == docs(rows).columns
    want = {r[0] for r in brute_components(rows, 5, 80) if r[3]}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(want)
    assert N.components(docs([])).count() == 0 and N.keep_one(docs([])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=30), st.integers(1, 6))
def test_hashed_shingles_are_a_set(words, size):
    assert len(shingles(word_hashes(" ".join(words)), size)) == len(shingle_set(" ".join(words), size))


def literal_tiles(a, b, least):
    """Total length of greedy string tiles, the textbook way."""
    done_a, done_b, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]
                       and i + n not in done_a and j + n not in done_b):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        done_a.update(range(i, i + n))
        done_b.update(range(j, j + n))
        total += n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=18), st.lists(st.integers(1, 4), max_size=24))
def test_tiles_are_common_runs_and_cover_like_the_textbook(a, b):
    tiles = D.greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3) if a and b else []
    marks_a, marks_b = [], []
    for i, j, n in tiles:
        assert a[i:i + n] == b[j:j + n] and n >= 3
        marks_a += range(i, i + n)
        marks_b += range(j, j + n)
    assert len(set(marks_a)) == len(marks_a) and len(set(marks_b)) == len(marks_b)
    assert (literal_tiles(a, b, 3) > 0) == bool(tiles)
    if tiles:  # ties may be broken either way; the longest run is always taken
        assert max(n for _, _, n in tiles) == max(
            n for i in range(len(a)) for j in range(len(b)) for n in range(1, min(len(a) - i, len(b) - j) + 1)
            if a[i:i + n] == b[j:j + n])


def test_leaks_are_found_whole_reordered_and_in_long_texts(docs, llm):
    item = "Quince jam sets, when sugar meets pectin; slowly over low heat until drops hold shape on cold plates."
    words = item.split()
    halves = " ".join(words[9:]) + " and also " + " ".join(words[:9])
    rows = [(1, "before " + item.upper() + " after"), (2, halves), (3, "clean text of its own"), (4, None), (5, ""),
            (6, " ".join(words[:5]) + " only the start"), (7, "filler words here " * 30_000 + item), (8, " ".join(words[::-1])),
            (1, "before " + item.upper() + " after"), (9, (item + " ") * 200)]
    bench = llm.createDataFrame([(10, item), (11, item), (12, "too short"), (13, None), (10, item)], "item_id long, text string")
    out = {r["doc_id"]: r for r in D.report(docs(rows), bench).collect()}
    assert {i for i, r in out.items() if r["contaminated"]} == {1, 2, 7, 9}
    assert out[1]["item_ids"] == [10, 11] and out[1]["coverage"] == 1.0 and out[3]["best_item_id"] is None
    left = D.clean(docs(rows), bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6, 8] and left.columns == docs(rows).columns
    none = llm.createDataFrame([], "item_id long, text string")
    assert D.clean(docs(rows), none).count() == len(rows) and D.report(docs([]), bench).count() == 0


def test_benchmark_items_without_an_id(docs, llm):
    item, other = "Quince jam sets when sugar meets pectin slowly", "Copper kettles boil water over a small blue flame"
    bench = llm.createDataFrame([(None, item), (10, item), (None, other), (None, None)], "item_id long, text string")
    out = {r["doc_id"]: r for r in D.report(docs([(1, item), (2, other), (3, "clean text of its own")]), bench).collect()}
    assert out[1]["item_ids"] == [10, None] and out[1]["best_item_id"] == 10
    assert out[2]["contaminated"] and out[2]["item_ids"] == [None] and out[2]["coverage"] == 1.0
    assert not out[3]["contaminated"]


def test_benchmark_blocks_give_the_same_answer(docs, llm, monkeypatch):
    rows = [(i, f"alpha{i} beta{i} gamma{i} delta{i} epsilon{i} zeta{i}") for i in range(40)]
    bench = llm.createDataFrame([(i, t) for i, t in rows[::2]], "item_id long, text string")
    monkeypatch.setattr(D, "BLOCK_CHARS", 400)
    out = {r["doc_id"]: list(r["item_ids"]) for r in D.report(docs(rows), bench).collect()}
    assert out == {i: [i] if i % 2 == 0 else [] for i in range(40)}


def vectors(llm, rows):
    rows = [(i, v if v is None else [x if x is None else float(x) for x in v], c) for i, v, c in rows]
    return llm.createDataFrame(rows, "vec_id long, embedding array<float>, score double")


def brute_neighbours(rows, k):
    fine = {(i, tuple(v)) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in fine:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((np.array(v, float) - np.array(w, float)) ** 2).sum())), i)
                       for i, w in fine if i != q and len(w) == len(v))
            out[q] = d[:k]
    return out


def test_neighbours_are_exact_where_all_are_reranked(llm, monkeypatch):
    """With few rows every candidate is reranked: copies, ties, odd vectors and repeated rows are exact."""
    rnd = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rnd.integers(-3, 4, 6)], 0.5) for i in range(1, 120)]
    rows += [(i, [1.0, 1.0, 0.0, 0.0, 0.0, 2.0], 0.5) for i in range(200, 330)]
    rows += [(400, None, 1.0), (500, [], 1.0), (600, [0.0] * 6, 1.0), (700, [1.0, None, 0, 0, 0, 0], 1.0),
             (800, [float("nan")] * 6, 1.0), (900, [float("inf"), 0, 0, 0, 0, 0], 1.0), (1000, [1.0, 2.0], 1.0),
             (1001, [2.0, 2.0], 1.0), (200, [1.0, 1.0, 0.0, 0.0, 0.0, 2.0], 0.5)]
    found = I.search(vectors(llm, rows), F.col("vec_id") % 100 == 0, k=10)
    got: dict = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert len(got[r["query_id"]]) == r["rank"]
    assert got == brute_neighbours(rows, 10)
    assert I.search(vectors(llm, []), F.col("vec_id") % 100 == 0).count() == 0


def test_recall_over_given_embeddings(llm):
    table = llm.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = table.toPandas().sort_values("vec_id")
    data, ids = np.stack(x["embedding"].to_numpy()).astype(float), x["vec_id"].to_numpy()
    found: dict = {}
    for r in I.search(table, F.col("vec_id") % 100 == 0, k=10).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for row in np.flatnonzero(ids % 100 == 0):
        far = np.sqrt(((data - data[row]) ** 2).sum(axis=1))
        far[row] = np.inf
        hits.append(len(found[ids[row]] & set(ids[np.lexsort((ids, far))[:10]])) / 10)
    assert np.mean(hits) >= 0.9, np.mean(hits)
