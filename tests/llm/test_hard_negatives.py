"""Hard negatives by the hyperplane tree against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sourcelens.llm import hyperplane_tree as H

SCHEMA = "vec_id long, embedding array<double>, label int, extra int, score double, rank int, class string, leaf int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute_negatives(rows, every):
    rows = {i: (v, y) for i, v, y in rows if i is not None and v is not None and y is not None
            and all(x is not None and math.isfinite(x) for x in v)}
    ints = {i: [math.floor(256 * x) for x in v] for i, (v, _) in rows.items()}
    out = []
    for a in (i for i in rows if i % every == 0):
        by = sorted(((-sum(map(int.__mul__, ints[a], ints[i])), i) for i in rows if i != a and len(ints[i]) == len(ints[a])))
        for p, i in [x for x in by if rows[x[1]][1] == rows[a][1]][:5]:
            window = [(s, j) for s, j in by if rows[j][1] != rows[a][1] and 80 * -p <= 100 * -s <= 100 * -p]
            out += [(a, i, r, j, -p, -s) for r, (s, j) in enumerate(window[:5], 1)]
    return sorted(out)


def mined(df, every):
    return sorted(tuple(r[c] for c in COLUMNS) for r in H.mine(df, F.col("vec_id") % every == 0, F.col("label")).collect())


def clustered(count, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    out = [(i, (centres[rng.integers(12)] + rng.normal(0, rng.choice([0.02, 0.6]), dim)).tolist(), int(rng.integers(4)))
           for i in range(count)]
    return out


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(H, "LEAF", 30)
    monkeypatch.setattr(H, "FAN", 5)
    monkeypatch.setattr(H, "BLOCK", 25)
    monkeypatch.setattr(H, "CHUNK", 7)


def test_equals_brute_force(llm, small):
    rows = clustered(900, 6, 1)
    same = [0.5, -0.25, 0.1, 0.0, 1.0, 2.0]
    rows += [(1000 + i, same, i % 3) for i in range(400)]  # a vector that many rows hold
    rows += [(2000, [1.0] * 3, 1), (2001, [1.5] * 3, 1), (2002, [1.4] * 3, 2), (2010, [0.0] * 6, 1), (2020, [], 1), (2021, [], 1),
             (2022, [], 2), (2030, None, 1), (2031, [1.0] * 6, None), (2032, [float("nan")] * 6, 1),
             (2033, [float("inf")] + [0.0] * 5, 1), (2034, [None] + [0.0] * 5, 1), (None, [1.0] * 6, 1)]
    df = llm.createDataFrame([(*r, 1, 0.5, 3, "c", 4) for r in rows + rows[:20]], SCHEMA)
    assert mined(df, 10) == brute_negatives(rows, 10)


def test_large_components_score_exactly(llm, small):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** rng.choice([3, 20, 22]) for _ in range(4)], i % 2) for i in range(120)]
    df = llm.createDataFrame([(*r, 1, 0.5, 3, "c", 4) for r in rows], SCHEMA)
    assert mined(df, 5) == brute_negatives(rows, 5)


def test_empty_and_single(llm):
    assert mined(llm.createDataFrame([], SCHEMA), 10) == []
    assert mined(llm.createDataFrame([(0, [1.0], 1, 1, 0.5, 3, "c", 4)], SCHEMA), 10) == []


def grown(vectors, leaf, fan, monkeypatch):
    monkeypatch.setattr(H, "LEAF", leaf)
    monkeypatch.setattr(H, "FAN", fan)
    tree = H.Tree(vectors, len(vectors))
    norms = (vectors.astype(float) ** 2).sum(axis=1)

    def seen(node, child, gaps, rows):
        split = tree.splits[node]
        split.near[:, child], split.far[:, child] = gaps.min(axis=0), gaps.max(axis=0)
        split.small[child], split.large[child] = norms[rows].min(), norms[rows].max()

    return tree, tree.place(vectors.astype(float), seen)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_no_leaf_with_a_score_in_the_window_is_dropped(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-40, 40, (300, 5))
    with pytest.MonkeyPatch.context() as patch:
        tree, leaf = grown(vectors, 12, 4, patch)
    query = vectors[rng.integers(300)] + rng.integers(-3, 3, 5)
    found = vectors @ query
    low = int(rng.integers(found.min() - 5, found.max() + 5))
    high = low + int(rng.integers(0, 400))
    wanted = set(leaf[(found >= low) & (found <= high)].tolist())
    assert wanted <= set(tree.visits(query, [low], [high]))
    assert leaf.min() >= 1 and leaf.max() <= tree.leaves


def test_siblings_are_eliminated(monkeypatch):
    """In tight clusters a narrow window leaves few of the leaves."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 256, (40, 16))
    vectors = (centres[rng.integers(40, size=8_000)] + rng.normal(0, 6, (8_000, 16))).astype(np.int64)
    tree, leaf = grown(vectors, 200, 16, monkeypatch)
    looked = []
    for q in vectors[:50]:
        best = np.sort(vectors @ q)[-6:]
        looked.append(len(tree.visits(q, [int(best[0])], [int(best[-1])])))
    assert np.mean(looked) < 0.2 * tree.leaves
