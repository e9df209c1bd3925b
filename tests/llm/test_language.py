"""Byte convolutional network: arithmetic against plain loops, edge cases, held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sourcelens.llm import language_cnn as L
from sourcelens.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_log_probabilities(net, window):
    """One window, by the definition: dot products at each place, greatest response, softmax."""
    padded = [*window, *[L.PAD] * (L.BREADTH - 1)]
    top = []
    for f in range(net.filters.shape[1]):
        answers = [sum(float(net.embed[padded[i + j]] @ net.filters[j * L.EMBEDDING:(j + 1) * L.EMBEDDING, f])
                       for j in range(L.BREADTH)) for i in range(len(window))]
        top.append(max(max(answers) + net.shift[f], 0.0))
    values = np.array(top) @ net.weigh + net.base
    return values - np.log(np.exp(values).sum())


def small_network(names="abc", seed=1):
    rng = np.random.default_rng(seed)
    net, _ = L.fresh(list(names), rng)
    net.shift[:], net.base[:] = rng.normal(0, 0.2, net.shift.shape), rng.normal(0, 0.2, net.base.shape)
    return net


def test_network_equals_its_definition():
    net = small_network()
    rng = np.random.default_rng(2)
    windows = rng.integers(0, 256, (37, 20))
    windows[3, 11:] = L.PAD
    got = net.log_probabilities(windows)
    for i in (0, 3, 15, 16, 36):
        assert np.allclose(got[i], plain_log_probabilities(net, windows[i].tolist()), atol=1e-4)


def test_filters_see_only_their_width():
    net, mask = L.fresh(["a", "b"], np.random.default_rng(0))
    used = mask.reshape(L.BREADTH, L.EMBEDDING, -1).any(axis=1).sum(axis=0)
    assert used.tolist() == [w for w in L.WIDTHS for _ in range(L.FILTERS)]
    assert (net.filters[mask == 0] == 0).all()


def test_gradients_equal_differences():
    net = small_network(seed=3)
    for p in (net.embed, net.filters, net.shift, net.weigh, net.base):
        assert p.dtype == np.float32
    net = L.Network(net.names, *(p.astype(float) for p in (net.embed, net.filters, net.shift, net.weigh, net.base)))
    rng = np.random.default_rng(4)
    windows, goal = rng.integers(97, 103, (5, 12)), rng.integers(0, 3, 5)
    windows[2, 7:] = L.PAD
    loss = lambda: -net.log_probabilities(windows)[np.arange(5), goal].mean()
    for p, g in zip((net.embed, net.filters, net.shift, net.weigh, net.base), L.gradients(net, windows, goal)):
        for place in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(25)] + [(99, 1)] * (p is net.embed):
            if p is net.embed and place[0] == L.PAD:
                continue
            old = p[place]
            p[place] = old + 1e-6
            up = loss()
            p[place] = old - 1e-6
            down = loss()
            p[place] = old
            assert g[place] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_every_window_of_a_text_counts():
    net = small_network()
    text = "abc é" * 40_000  # more than one part of 512 windows
    raw = text.encode()
    windows = [raw[i:i + L.WINDOW] for i in range(0, len(raw), L.WINDOW)]
    total = sum(len(w) / len(raw) * net.log_probabilities(L.as_windows(w))[0] for w in windows)
    names, scores = L.label(net, ["short", text, None, "", "123 -", text])
    assert names[1] == names[5] == net.names[int(total.argmax())]
    assert scores[1] == pytest.approx(scores[5]) == pytest.approx(float(np.exp(L.log_softmax(total[None]))[0].max()), abs=1e-4)
    assert names[2:5] == [L.UNKNOWN] * 3 and scores[2:5] == [0.0] * 3


def test_hard_rows(docs, llm):
    rows = [(1, "der hund und die katze " * 9), (2, "the dog and the cat " * 9), (3, None), (4, ""), (5, "42 + 1"), (None, "the cat"),
            (1, "der hund und die katze " * 9), (6, "the dog " * 60_000)]
    df = docs(rows).withColumn("lang", F.when(F.col("text").contains("der"), "de").when(F.col("doc_id") == 2, "en"))
    out = L.predict(df, L.fit(df)).collect()
    assert len(out) == len(rows) and {r["lang_pred"] for r in out if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert all(r["lang_pred"] == "de" for r in out if r["doc_id"] == 1) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["lang_pred"] for r in out if r["doc_id"] in (2, 6)} == {"en"}
    unnamed = L.predict(docs(rows), L.fit(docs(rows).withColumn("lang", F.lit(None).cast("string"))))
    assert {(r["lang_pred"], r["score"]) for r in unnamed.collect()} == {("und", 0.0)}
    assert L.predict(docs([]), L.fit(docs([]))).count() == 0


def test_held_out_accuracy(llm):
    docs = table(llm, SF, "documents")
    out = L.predict(docs, L.fit(docs.where(~L.held_out()))).where("held_out").join(
        docs.select("doc_id", "lang", F.length("text").alias("n")).distinct(), "doc_id")
    right = {r["lang"]: r["right"] for r in out.where("n >= 40").groupBy("lang").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()}
    assert len(right) == 4 and min(right.values()) >= 0.97
