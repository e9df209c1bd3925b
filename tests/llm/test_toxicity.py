"""Toxicity: the kernel, held-out accuracy on labelled documents, altered insults, hard cases."""

import random

import numpy as np
import pytest

from sourcelens.llm import toxicity as T

NEUTRAL = "lamp river stone quiet paper window garden morning letter market bridge cotton silver engine planet".split()
INSULTS = "grumblewort snarkpot foulmug drivelhead".split()


def kernel(a, b):
    """Gapped subsequences of three characters, straight from their definition."""
    def features(word):
        word, out = f"^{word}$", {}
        norm = 0.0
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + T.SPAN)):
                    w = T.DECAY ** (k - i - 2)
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0.0) + w
                    norm += w * w
        return {x: w / norm ** 0.5 for x, w in out.items()}

    fa, fb = features(a), features(b)
    return sum(w * fb.get(x, 0.0) for x, w in fa.items())


def test_kernel_values_follow_the_definition():
    words = ["idiot", "idxiot", "river", "a", "zz9"]
    assert np.allclose(T._gram(words, words), [[kernel(a, b) for b in words] for a in words], atol=1e-5)
    assert kernel("idiot", "idxiot") > 2 * kernel("idiot", "river")


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(1_500):
        words = [rnd.choice(NEUTRAL) + rnd.choice(["", "s", "ly", "ish", "er"]) for _ in range(rnd.randint(5, 80))]
        toxic = int(rnd.random() < 0.2)
        for _ in range(toxic * rnd.randint(1, 3)):
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS) + rnd.choice(["", "s", "ish", "ling", "ery"]))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, 1, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(docs, llm, corpus):
    rows, labels = corpus
    return T.fit(docs(rows), llm.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents_are_judged_right(docs, llm, corpus, fitted):
    rows, labels = corpus
    df = T.score(docs(rows).drop("score"), fitted).withColumn("held", T.held_out())
    held = [r for r in df.collect() if r["held"]]
    truth = {i: t for i, _, t in labels}
    assert len(held) > 200 and all(0 <= r["score"] <= 1 for r in held)
    right = [(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in held]
    assert np.mean(right) >= 0.98


def test_altered_insults_and_hard_texts(docs, fitted):
    long_clean = " ".join(NEUTRAL) + " "
    rows = [(1, "you grumble-wort of a lamp"), (2, "s n a r k p o t by the river"), (3, "what a foulxmug in the garden"),
            (4, "drive1head market"), (5, None), (6, ""), (7, "... !!! 😀"), (8, long_clean * 3_000),
            (9, long_clean * 3_000 + "snarkpot"), (10, "x" * 100_000), (11, "a b c d"), (6, "")]
    out = {r["doc_id"]: r["score"] for r in T.score(docs(rows).drop("score"), fitted).collect()}
    for i in (1, 2, 3, 4, 9):
        assert out[i] >= 0.5, (i, out[i])
    for i in (5, 6, 7, 8, 10, 11):
        assert out[i] < 0.5, (i, out[i])


def test_without_labels_of_both_classes(docs, llm):
    rows = [(i, "quiet river") for i in range(20)]
    empty = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in T.score(docs(rows).drop("score"), T.fit(docs(rows), empty)).collect()} == {0.0}
    ones = llm.createDataFrame([(i, 1, 1) for i in range(20)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in T.score(docs(rows).drop("score"), T.fit(docs(rows), ones)).collect()} == {1.0}
    assert T.score(docs([]).drop("score"), T.fit(docs([]), empty)).count() == 0


def test_accepted_words_add_up_and_length_is_no_excuse(docs, llm):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(1_200):
        toxic = int(i % 5 == 0)
        words = [rnd.choice(NEUTRAL) + rnd.choice(["", "s", "ly", "ish", "er"]) for _ in range(rnd.randint(30, 120))]
        # A family of words: several in a toxic text, one by chance in a tenth of the clean ones.
        for _ in range(rnd.randint(4, 7) if toxic else int(rnd.random() < 0.1)):
            words.insert(rnd.randrange(len(words)), "achkor" + rnd.choice("aeiouy") + rnd.choice("bdfgklmnprst"))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    model = T.fit(docs(rows), llm.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    plain = (" ".join(NEUTRAL) + " ") * 4
    family = "achkorat achkorel achkorin achkorum achkoryk "
    every = ["achkor" + v + c for v in "aeiouy" for c in "bdfgklmnprst"]
    one = every[int(np.argmax(model.margins(every)))] + " "
    cases = [(1, plain + one), (2, plain + family), (3, plain * 200 + family + plain * 200), (4, plain),
             (5, plain + one * 5)]
    out = {r["doc_id"]: r["score"] for r in T.score(docs(cases).drop("score"), model).collect()}
    assert out[2] >= 0.5 and out[3] >= 0.5, out
    assert out[1] < 0.5 and out[4] < 0.5 and out[4] <= out[1] < out[5] and out[5] >= 0.5, out


def test_a_mislabelled_document_does_not_bar_a_word(docs, llm, corpus):
    counts = llm.createDataFrame([("insult", 12, 1), ("rare", 5, 0), ("plain", 90, 600), ("odd", 1, 1), ("calm", 0, 9)],
                                 "word string, toxic long, clean long")
    odds = {r["word"]: r for r in T._with_odds(counts, 0.13).collect()}
    assert all(odds[w]["surely"] > np.log(T.HIGH) and odds[w]["tilt"] > np.log(T.HIGH) for w in ("insult", "rare"))
    assert all(odds[w]["tilt"] < np.log(T.LOW) for w in ("plain", "calm"))
    assert odds["insult"]["surprise"] > odds["rare"]["surprise"] > odds["odd"]["surprise"] >= odds["plain"]["surprise"] >= 0
    # Every form of every insult occurs in one clean document.
    rows, labels = corpus
    forms = sorted({w for _, t in rows for w in t.rstrip(".").split() if w.startswith(tuple(INSULTS))})
    wrong = [(10_000 + i, " ".join([NEUTRAL[i % 15], w, *NEUTRAL])) for i, w in enumerate(forms)]
    model = T.fit(docs(rows + wrong), llm.createDataFrame(labels + [(i, 1, 0) for i, _ in wrong],
                                                          "doc_id long, quality int, toxic int"))
    out = T.score(docs(rows).drop("score"), model).where(T.held_out()).collect()
    truth = {i: t for i, _, t in labels}
    assert np.mean([(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in out]) >= 0.97
