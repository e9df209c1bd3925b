"""Toxicity of whole texts by a support vector machine with a gapped subsequence kernel on words.

The kernel of two words counts their common subsequences of three characters that span at most five, each
discounted by its gaps, so an insult with characters inserted or left out still resembles itself. Nyström
landmarks give the machine its feature space; since the kernel's own features are explicit, the trained
machine folds back into one weight per subsequence and scores a word by a sparse sum.

Labels belong to documents, insults to words in some sentence of them. Training is therefore on bags: words
that toxic documents use significantly more often than clean ones are the first positives; each round adds the
words of toxic documents that the machine accepts and the words of clean documents that it confuses most. Both
sorts are told apart by smoothed odds against the share of toxic documents, so a clean or mislabelled document
or two do not bar a word, and a word of mostly toxic documents is never a negative. The kernel
judges single words; sentences are not scored as units, and an insult of several words counts by its words.

A document's evidence is how far its number of accepted words exceeds what chance puts into a clean text of its
length (signed root of the Poisson likelihood ratio), in the whole text or in any ``WINDOW`` words of it, the
greater of the two; so a family of weak words adds up and one insult in a long text is not diluted. A logistic
curve over that evidence and the worst word's margin, fitted on the documents of the training sample, maps them
to 0..1. A feature with a negative slope is left out: more or worse insults never lower a score by themselves.

The training sample holds at most ``SAMPLE`` labelled rows, chosen by a hash of doc_id; word statistics,
scores and everything else cover all of it or all documents. Rows scored need no label.

Null and empty texts get the score of a text without words. Repeated rows get equal scores. With no labels of
one class every score is the share of toxic labels (0 with no labels at all). Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows, scratch, text_of
from .words import shingles, word_hashes
from .worker_cache import held

#: Labelled rows to learn from.
SAMPLE = 40_000
#: Words of each sort that reach the driver in a round; landmarks of each sort.
WORDS, LANDMARKS = 4_000, 96
ROUNDS = 3
SPAN, DECAY = 5, 0.7
ALPHABET = 64
FEATURES = ALPHABET ** 3
#: Words a worker remembers the score of.
REMEMBERED = 250_000
#: Odds of a positive word over those of all words, at least, and of a negative word, at most.
HIGH, LOW = 4.0, 2.0
#: Words of a window in which accepted words are counted besides the whole text.
WINDOW = 64
#: Characters of a word beyond which it is cut into overlapping parts.
LONG = 48
OFFSETS = tuple((i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN))
OFFSET_WEIGHTS = np.array([DECAY ** (j - 2) for _, j in OFFSETS], np.float32)

_CODES = np.zeros(1 << 16, np.uint8)
_CODES[:] = 40 + np.arange(1 << 16) % 22
for _i, _c in enumerate("^$abcdefghijklmnopqrstuvwxyz0123456789"):
    _CODES[ord(_c)] = _i + 1
_NOT_WORD = re.compile(r"[\W_]+")


def bare(word: str) -> str:
    """Letters and digits of a word, lower case."""
    return _NOT_WORD.sub("", word).lower()


def parts(word: str) -> list[str]:
    """A word with its boundary marks; a very long one as overlapping parts."""
    if len(word) <= LONG:
        return [f"^{word}$"]
    step = LONG // 2
    return [f"^{word[i:i + LONG]}$" for i in range(0, len(word) - step, step)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of every occurrence, weights scaled to a unit word."""
    lengths = np.array([len(w) for w in words])
    chars = np.frombuffer("".join(words).encode("utf-16-le", "surrogatepass"), "<u2")
    if len(chars) != lengths.sum():  # characters beyond 16 bits
        words = ["".join(c if c < "\U00010000" else chr(0xE000 + ord(c) % 4096) for c in w) for w in words]
        chars = np.frombuffer("".join(words).encode("utf-16-le", "surrogatepass"), "<u2")
    codes = _CODES[chars].astype(np.int32)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters from here to the word's end
    who, what, weight = [], [], []
    for (i, j), w in zip(OFFSETS, OFFSET_WEIGHTS):
        at = np.flatnonzero(left > j)
        who.append(owner[at])
        what.append((codes[at] * ALPHABET + codes[at + i]) * ALPHABET + codes[at + j])
        weight.append(np.full(len(at), w, np.float32))
    who, what, weight = np.concatenate(who), np.concatenate(what), np.concatenate(weight)
    norm = np.sqrt(np.bincount(who, weight.astype(np.float64) ** 2, len(words)))
    return who, what, (weight / norm[who]).astype(np.float32)


@dataclass
class Model:
    """``weights`` by subsequence and ``bias`` of the folded machine; ``rate`` of accepted words among the words of
    clean documents; the logistic curve over worst margin and evidence."""

    weights: np.ndarray | None
    bias: float
    slopes: tuple[float, float]
    offset: float
    share: float = 0.0
    rate: float = 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        """The machine's margin of each bare word; of no word at all where it is empty."""
        out = np.full(len(words), NOTHING, np.float32)
        marked, owner = [], []
        for i, word in enumerate(words):
            if word:
                for part in parts(word):
                    marked.append(part)
                    owner.append(i)
        if marked:
            who, what, weight = subsequences(marked)
            own = np.bincount(who, self.weights[what] * weight, len(marked)) + self.bias
            np.maximum.at(out, np.array(owner), own.astype(np.float32))
        return out


#: The margin of a text without words.
NOTHING = -4.0


def _gram(a: list[str], b: list[str]) -> np.ndarray:
    """Kernel values between two lists of words; 32 of ``b`` are laid out densely at a time."""
    out = np.zeros((len(a), len(b)), np.float32)
    for first in range(0, len(b), 32):
        own = b[first:first + 32]
        dense = np.zeros((len(own), FEATURES), np.float32)
        who, what, weight = subsequences([f"^{w}$" for w in own])
        np.add.at(dense, (who, what), weight)
        for at in range(0, len(a), 1_000):
            some = a[at:at + 1_000]
            who, what, weight = subsequences([f"^{w}$" for w in some])
            for k in range(len(own)):
                out[at:at + len(some), first + k] = np.bincount(who, dense[k, what] * weight, len(some))
    return out


def _spread(words: list[str], count: int) -> list[str]:
    """Words that resemble each other little, by farthest-first choice; earlier words come first."""
    words = words[:1_000]
    if len(words) <= count:
        return words
    chosen = [0]
    close = _gram(words, [words[0]])[:, 0]
    while len(chosen) < count:
        k = int(np.argmin(close))
        if k in chosen:
            break
        chosen.append(k)
        close = np.maximum(close, _gram(words, [words[k]])[:, 0])
    return [words[k] for k in chosen]


def train_machine(positive: list[str], negative: list[str], balance: float = 0.3, cost: float = 4.0) -> tuple[np.ndarray, float]:
    """Squared-hinge machine over Nyström features, folded into weights per subsequence."""
    marks = _spread(positive, LANDMARKS) + _spread(negative, LANDMARKS)
    words = positive + negative
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    base = _gram(marks, marks).astype(np.float64)
    value, vector = np.linalg.eigh((base + base.T) / 2)
    good = value > 1e-4 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    x = np.hstack([_gram(words, marks).astype(np.float64) @ root, np.ones((len(words), 1))])
    share = np.where(y > 0, balance / max(1, len(positive)), 1 / max(1, len(negative))) * cost * 200
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-3
    for _ in range(30):  # Newton steps on the violated margins
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = ridge * w - 2 * x[on].T @ (share[on] * y[on] * slack[on])
        curve = np.diag(ridge) + 2 * (x[on] * share[on][:, None]).T @ x[on]
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    back = root @ w[:-1]
    weights = np.zeros(FEATURES, np.float32)
    who, what, weight = subsequences([f"^{m}$" for m in marks])
    np.add.at(weights, what, (weight * back[who]).astype(np.float32))
    return weights, float(w[-1])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _words_of(text: str) -> list[str]:
    """Distinct bare words of a text, runs of single characters joined."""
    words = [bare(w) for w in text.split()]
    return sorted({w for w in (*words, *_joined(words)) if w})


def _runs(words: list[str]) -> list[tuple[int, str]]:
    """(place of the last character, joined word) of runs of at least three single characters."""
    out, run, last = [], [], 0
    for i, w in enumerate((*words, "  ")):
        if len(w) == 1:
            run.append(w)
            last = i
        elif w:
            if len(run) >= 3:
                out.append((last, "".join(run)))
            run = []
    return out


def _joined(words: list[str]) -> list[str]:
    return [w for _, w in _runs(words)]


def _once(sample: DataFrame) -> DataFrame:
    """The sample without near copies: rows of one label that share one of their three least shingle hashes
    with a row of smaller doc_id go, so a copied text does not make its words look significant."""

    def sketch(batches):
        for batch in batches:
            found = [shingles(word_hashes(t), 3)[:3].view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"),
                                              pa.array(found, pa.list_(pa.int64()))], ["doc_id", "toxic", "marks"])

    each = scratch(sample.select("doc_id", "toxic", "text").mapInArrow(
        sketch, "doc_id long, toxic int, marks array<long>").select("doc_id", "toxic", F.explode("marks").alias("mark")),
        "toxic-marks")
    first = each.groupBy("mark", "toxic").agg(F.min("doc_id").alias("first"))
    later = each.join(first, ["mark", "toxic"]).where(F.col("first") < F.col("doc_id")).select("doc_id").distinct()
    return sample.join(F.broadcast(scratch(later, "toxic-later")), "doc_id", "left_anti")


def _word_counts(sample: DataFrame) -> DataFrame:
    """word, toxic and clean: documents of either label that hold it."""

    def count(batches):
        for batch in batches:
            seen: dict = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for word in _words_of(text):
                    seen.setdefault(word, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()),
                 pa.array([v[0] for v in seen.values()], pa.int64())], ["word", "toxic", "clean"])

    return (sample.select("text", "toxic").mapInArrow(count, "word string, toxic long, clean long")
            .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _with_odds(counts: DataFrame, share: float) -> DataFrame:
    """Add, of each word, against the ``share`` of toxic among all (word, document) pairs: ``tilt``, the log odds
    ratio with two pairs of that share added; ``surely``, a lower bound of the log odds ratio at 95 %;
    ``surprise``, the exponent of Chernoff's bound of so many toxic documents by chance."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    base, toxic, clean = math.log(share / (1 - share)), F.col("toxic"), F.col("clean")
    n = toxic + clean
    part = toxic / n
    rest = F.when(clean > 0, (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0)
    return counts.withColumns({
        "tilt": F.log((toxic + 2 * share) / (clean + 2 * (1 - share))) - base,
        "surely": F.log((toxic + 0.5) / (clean + 0.5)) - base - 1.64 * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)),
        "surprise": F.when(part > share, n * (part * F.log(part / share) + rest)).otherwise(0.0)})


def _with_margin(counts: DataFrame, model: Model) -> DataFrame:
    def score(batches):
        for batch in batches:
            own = model.margins(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.float64))],
                                             [*batch.schema.names, "margin"])

    return counts.mapInArrow(score, ", ".join(f"{c} {t}" for c, t in counts.dtypes) + ", margin double")


class _Worst(dict):
    """Raw word to its place among the margins; new words wait for their margin."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.waiting.append(word)
        return place


class Scorer:
    """Margins and accepted words of whole texts; words are scored once per worker."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.places, self.known = _Worst(), np.zeros(0, np.float32)
        self.single = np.zeros(0, np.int8)  # 1: words of one character

    def judge(self, texts: list[str]) -> list[tuple[float, int, int, int]]:
        """Of each text: worst margin, words, accepted words, and the most accepted words of any ``WINDOW`` words."""
        rows = []
        for text in texts:
            words = text.split()
            rows.append((words, np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))))
        if self.places.waiting:
            fresh = [bare(w) for w in self.places.waiting]
            own = [self.model.margins(fresh[i:i + 20_000]) for i in range(0, len(fresh), 20_000)]
            self.known = np.concatenate([self.known, *own])
            self.single = np.concatenate([self.single, np.array([len(w) == 1 for w in fresh], np.int8)])
            self.places.waiting = []
        out = []
        for words, own in rows:
            if not len(own):
                out.append((NOTHING, 0, 0, 0))
                continue
            each = self.known[own]
            if self.single[own].sum() >= 3:
                spaced = _runs([bare(w) for w in words])
                if spaced:
                    ends = np.array([i for i, _ in spaced])
                    each[ends] = np.maximum(each[ends], self.model.margins([w for _, w in spaced]))
            so_far = np.concatenate([[0], np.cumsum(each > 0)])
            most = (so_far[WINDOW:] - so_far[:-WINDOW]).max() if len(each) > WINDOW else so_far[-1]
            out.append((float(each.max()), len(each), int(so_far[-1]), int(most)))
        if len(self.places) > REMEMBERED:
            self.clear()
        return out


#: Columns that ``_judged`` adds.
JUDGED = ("__margin", "__words", "__hits", "__most")


def _judged(docs: DataFrame, model: Model) -> DataFrame:
    """Add what ``Scorer.judge`` finds in each document; all other columns pass through."""
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    kinds = ("double", "long", "long", "long")
    schema = ", ".join(f"`{c}` {t}" for c, t in (*docs.dtypes, *zip(JUDGED, kinds)))

    def score(batches):
        own = held(("scorer", key), lambda: Scorer(shared.value))
        for batch in batches:
            found = list(zip(*own.judge([t or "" for t in batch.column("text").to_pylist()]))) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found[0], pa.float64()), *(pa.array(f, pa.int64()) for f in found[1:])],
                [*batch.schema.names, *JUDGED])

    return docs.mapInArrow(score, schema)


def _evidence(rate: float) -> Column:
    """How far the accepted words of a text, or of its fullest window, exceed those that ``rate`` lets expect."""

    def excess(hits: Column, words: Column) -> Column:
        usual = words * F.lit(rate)
        return F.when(hits > usual, F.sqrt(2 * (hits * F.log(hits / usual) - (hits - usual)))).otherwise(0.0)

    return F.greatest(excess(F.col("__hits"), F.col("__words")),
                      excess(F.col("__most"), F.least(F.col("__words"), F.lit(WINDOW))))


def _curve(rows: list[tuple[float, float, int, int]]) -> tuple[tuple[float, float], float]:
    """Slopes and offset of the logistic curve through (margin, evidence, toxic, clean) counts; a slope that
    would be negative is 0."""
    x = np.array([r[:2] for r in rows], float)
    slopes, on = np.zeros(2), np.ones(2, bool)
    while True:
        found = _logistic(x[:, on], np.array([r[2] for r in rows], float), np.array([r[3] for r in rows], float))
        slopes[:] = 0.0
        slopes[on] = found[:-1]
        if not (slopes < 0).any():
            return (float(slopes[0]), float(slopes[1])), float(found[-1])
        on[int(np.argmin(slopes))] = False


def _logistic(x: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> np.ndarray:
    """Slopes and offset by Newton's method."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ ((n1 + n0) * p - n1) + 0.05 * w
        curve = (design * ((n1 + n0) * p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows outside of the held-out fifth."""
    spark = docs.sparkSession
    marked = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    marked = scratch(marked, "toxic-labels")
    rows = scratch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
                   .join(F.broadcast(marked), "doc_id"), "toxic-sample")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        return Model(None, 0.0, (0.0, 0.0), 0.0, share)
    counts = scratch(_word_counts(_once(rows)), "toxic-words")
    totals = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"),
                        F.count_if(F.col("toxic") > 0).alias("v")).first()
    share = (totals["t"] or 0) / max(1, (totals["t"] or 0) + (totals["c"] or 0))
    counts = scratch(_with_odds(counts, share), "toxic-odds")
    # So surprising that at most one neutral word in two corpora comes so far.
    enough = math.log(max(1, totals["v"]) / 0.5)

    def words(df: DataFrame, *order: Column) -> list[str]:
        return [r["word"] for r in df.orderBy(*order, "word").limit(WORDS).select("word").collect()]

    tilted, plain = counts.where(F.col("tilt") > math.log(HIGH)), F.col("tilt") < math.log(LOW)
    positive = words(tilted.where((F.col("toxic") >= 3) & (F.col("surprise") >= enough)
                                  & (F.col("surely") > math.log(HIGH))), F.desc("toxic"))
    if not positive:
        positive = words(tilted, F.desc("surprise"))[:50]
    if not positive:
        positive = words(counts.where("toxic > 0"), F.desc("tilt"))[:50]
    negative = words(counts.where((F.col("clean") > 0) & plain), F.desc("clean"))
    negative += words(counts.where((F.col("clean") > 0) & (F.col("clean") < 3) & plain), F.xxhash64("word"))
    negative = list(dict.fromkeys(negative))
    model = Model(None, 0.0, (0.0, 0.0), 0.0)
    for turn in range(ROUNDS):
        model.weights, model.bias = train_machine(positive, negative)
        if turn == ROUNDS - 1:
            break
        scored = scratch(_with_margin(counts, model), "toxic-margins")
        high = F.col("tilt") > math.log(HIGH)
        more = words(scored.where(high & (F.col("margin") > 0) & (F.col("toxic") >= 2)), F.desc("toxic"))
        doubt = {r["word"] for r in scored.where(high & (F.col("margin") < -0.5) & (F.col("surprise") < 2 * enough))
                 .orderBy(F.desc("toxic"), "word").limit(WORDS).collect()}
        hard = words(scored.where((F.col("clean") > 0) & plain & (F.col("margin") > -1)), F.desc("margin"))
        positive = [w for w in dict.fromkeys(positive + more) if w not in doubt] or positive
        negative = list(dict.fromkeys(negative + hard))
    each = scratch(_judged(rows.select("text", "toxic"), model).drop("text"), "toxic-judged")
    usual = each.where("toxic = 0").agg(F.sum("__hits").alias("hits"), F.sum("__words").alias("words")).first()
    model.rate = (usual["hits"] + 0.5) / (usual["words"] + 1)
    bins = (each.select("toxic", (F.round(F.col("__margin") * 50) / 50).alias("margin"),
                        (F.round(_evidence(model.rate) * 50) / 50).alias("evidence"))
            .groupBy("margin", "evidence").agg(F.sum("toxic").alias("n1"), F.count("*").alias("n")))
    found = [(r["margin"], r["evidence"], r["n1"], r["n"] - r["n1"]) for r in bounded_rows(bins, 100_000, "margins")]
    model.slopes, model.offset = _curve(sorted(found))
    return model


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Add the score of each whole text."""
    if model.weights is None:
        return docs.withColumn(out, F.lit(float(model.share)))
    found = _judged(docs.withColumn("text", F.col("text").cast("string")), model)
    logit = F.col("__margin") * model.slopes[0] + _evidence(model.rate) * model.slopes[1] + model.offset
    return found.withColumn(out, 1 / (1 + F.exp(-logit))).drop(*JUDGED)
