"""Language identification by a byte-level convolutional network, written and trained in numpy.

A text is its UTF-8 bytes, A-Z in lower case, in windows of fixed length, the last one padded. Every byte has an embedding; filters of
several widths run over a window, each keeps its greatest response, and a softmax layer turns those into one
probability per language. A document's prediction adds up the log-probabilities of all its windows, weighted by
their bytes, so whole texts count and long ones cost time in proportion.

The network learns from a bounded sample: about ``SAMPLE_DOCS`` labelled documents in all, never twice as many,
shared out evenly among the languages and chosen by a hash of doc_id, ``SAMPLE_WINDOWS`` windows of each at hashed places. Sampled windows are
cut to random lengths as well, so short texts are known too.

A null text, or one without a letter, is ``und`` with score 0; so is every text where no labelled row was given.
Null languages are never learned; a null doc_id counts as the empty text in the hash. Repeated rows are predicted
each, an empty table gives no rows, and extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 24, 8
#: Labelled documents learned from, windows of each, and languages that a table may mix.
SAMPLE_DOCS, SAMPLE_WINDOWS, LANGUAGES = 4_000, 2, 500
EPOCHS, BATCH, RATE, SHORTEST = 8, 64, 0.004, 6
UNKNOWN = "und"
PAD, BREADTH = 256, max(WIDTHS)


@dataclass
class Network:
    """Parameters: byte embeddings, filters (flattened over the widest width), and the softmax layer."""

    names: list[str]
    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    weigh: np.ndarray
    base: np.ndarray

    def spread(self, windows: np.ndarray) -> np.ndarray:
        """The bytes under the widest filter at each place, as embeddings: (windows, places, breadth * embedding)."""
        count, length = windows.shape
        padded = np.full((count, length + BREADTH - 1), PAD, np.int32)
        padded[:, :length] = windows
        seen = np.lib.stride_tricks.sliding_window_view(self.embed[padded], BREADTH, axis=1)
        return np.ascontiguousarray(seen.transpose(0, 1, 3, 2)).reshape(count, length, -1)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Of every language, for windows of byte numbers (``PAD`` behind the end)."""
        out = []
        for at in range(0, len(windows), 16):  # few windows at a time stay in the processor's cache
            rows = self.spread(windows[at:at + 16])
            top = (rows.reshape(-1, rows.shape[2]) @ self.filters).reshape(*rows.shape[:2], -1).max(axis=1)
            out.append(np.maximum(top + self.shift, 0) @ self.weigh + self.base)
        return log_softmax(np.concatenate(out)) if out else np.zeros((0, len(self.names)), np.float32)


def log_softmax(values: np.ndarray) -> np.ndarray:
    values = values - values.max(axis=1, keepdims=True)
    return values - np.log(np.exp(values).sum(axis=1, keepdims=True))


def fresh(names: list[str], rng: np.random.Generator) -> tuple[Network, np.ndarray]:
    """An untrained network, and the mask of the filter rows that each width uses."""
    count = FILTERS * len(WIDTHS)
    mask = np.concatenate([np.tile((np.arange(BREADTH) < w)[:, None, None], (1, EMBEDDING, FILTERS)) for w in WIDTHS],
                          axis=2).reshape(-1, count).astype(np.float32)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    embed = draw(257, EMBEDDING, scale=0.5)
    embed[PAD] = 0
    return Network(names, embed, draw(BREADTH * EMBEDDING, count, scale=0.3) * mask, np.zeros(count, np.float32),
                   draw(count, len(names), scale=0.1), np.zeros(len(names), np.float32)), mask


def gradients(net: Network, windows: np.ndarray, goal: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy, in the order of the parameters; only the place of each maximum passes it on."""
    rows = net.spread(windows)
    count, length, depth = rows.shape
    answers = (rows.reshape(-1, depth) @ net.filters).reshape(count, length, -1)
    place = answers.argmax(axis=1)
    top = np.take_along_axis(answers, place[:, None], axis=1)[:, 0] + net.shift
    kept = np.maximum(top, 0)
    wrong = np.exp(log_softmax(kept @ net.weigh + net.base))
    wrong[np.arange(count), goal] -= 1
    wrong /= count
    back = (wrong @ net.weigh.T) * (top > 0)
    seen = rows[np.arange(count)[:, None], place]  # (windows, filters, depth)
    filters = np.einsum("bfk,bf->kf", seen, back)
    under = (back[:, :, None] * net.filters.T).reshape(count, -1, BREADTH, EMBEDDING)
    padded = np.full((count, length + BREADTH - 1), PAD, np.int64)
    padded[:, :length] = windows
    letters = padded[np.arange(count)[:, None, None], place[:, :, None] + np.arange(BREADTH)]
    embed = np.stack([np.bincount(letters.ravel(), under[..., i].ravel(), len(net.embed)) for i in range(EMBEDDING)], 1)
    embed[PAD] = 0
    return [embed, filters, back.sum(axis=0), kept.T @ wrong, wrong.sum(axis=0)]


def train(names: list[str], windows: np.ndarray, goal: np.ndarray, seed: int = 7) -> Network:
    """Fit a network by Adam on windows of byte numbers and the places of their languages in ``names``."""
    rng = np.random.default_rng(seed)
    net, mask = fresh(names, rng)
    own = [net.embed, net.filters, net.shift, net.weigh, net.base]
    slow, fast = [np.zeros_like(p) for p in own], [np.zeros_like(p) for p in own]
    step, place = 0, np.arange(windows.shape[1])
    for epoch in range(EPOCHS if len(names) > 1 else 0):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            lengths = np.exp(rng.uniform(np.log(SHORTEST), np.log(windows.shape[1] * 2), len(some)))
            shown = np.where(place < lengths[:, None], windows[some], PAD)
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for p, g, m, v in zip(own, gradients(net, shown, goal[some]), slow, fast):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            net.filters *= mask
    return net


def as_windows(text: bytes, length: int = WINDOW) -> np.ndarray:
    """All bytes of a text, ASCII letters in lower case, as rows of fixed length."""
    data = np.full(max(1, -(-len(text) // length)) * length, PAD, np.int16)
    data[:len(text)] = np.frombuffer(text.lower(), np.uint8)
    return data.reshape(-1, length)


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts == part


def sample(docs: DataFrame, each: int) -> list:
    """Windows (lang, data, key) of about ``each`` documents per language, those of least hash.

    A language's share of the hash range follows from its count, so no rows are sorted or gathered by language.
    """
    named = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id").alias("__hash"))
    counts = bounded_rows(named.groupBy("lang").agg(F.count("*").alias("n")), LANGUAGES, "languages")
    if not counts:
        return []
    most = F.create_map(*[F.lit(x) for r in counts for x in (
        r["lang"], min((1 << 63) - 1, (1 << 64) * each // r["n"] - (1 << 63)))])

    def cut(batches):
        for batch in batches:
            names, data, keys = [], [], []
            for lang, text, key in zip(*(c.to_pylist() for c in batch.columns)):
                text = text.encode("utf-8", "surrogatepass")
                rng = np.random.default_rng(key & 0x7FFFFFFF)
                for start in rng.integers(0, max(1, len(text) - WINDOW + 1), SAMPLE_WINDOWS).tolist():
                    names.append(lang)
                    data.append(text[start:start + WINDOW])
                    keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(data, pa.binary()),
                                              pa.array(keys, pa.int64())], ["lang", "data", "key"])

    chosen = named.where(F.col("__hash") <= most[F.col("lang")]).mapInArrow(cut, "lang string, data binary, key long")
    # Documents that share an id share a hash: each key gives one document's windows.
    first = chosen.groupBy("lang", "key").agg(F.sort_array(F.collect_set("data")).alias("data")).select(
        "lang", "key", F.explode(F.slice("data", 1, SAMPLE_WINDOWS)).alias("data"))
    # Twice the share is far beyond what a fair hash deals out.
    return bounded_rows(first, 2 * (LANGUAGES + SAMPLE_DOCS) * SAMPLE_WINDOWS, "sampled windows")


def fit(docs: DataFrame) -> Network:
    """Train on ``docs`` (doc_id, text, lang); leave out what is to be held out before."""
    languages = bounded_rows(docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang")).distinct(), LANGUAGES, "languages")
    names = sorted(r["lang"] for r in languages)
    if not names:
        return fresh([UNKNOWN], np.random.default_rng(0))[0]
    rows = sorted(sample(docs, max(1, SAMPLE_DOCS // len(names))), key=lambda r: (r["key"], r["lang"], r["data"]))
    windows = np.concatenate([as_windows(r["data"]) for r in rows])
    return train(names, windows, np.array([names.index(r["lang"]) for r in rows]))


def label(net: Network, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of every text, from all windows of it."""
    data, owner, weight = [], [], []
    total = np.zeros((len(texts), len(net.names)))

    def add_up():
        if data:
            found = net.log_probabilities(np.concatenate(data)) * np.concatenate(weight)[:, None]
            np.add.at(total, np.concatenate(owner), found)
            data.clear(), owner.clear(), weight.clear()

    known = [text is not None and net.names != [UNKNOWN] and any(map(str.isalpha, text)) for text in texts]
    for i, text in enumerate(texts):
        if known[i]:
            raw = text.encode("utf-8", "surrogatepass")
            for at in range(0, len(raw), WINDOW * 512):  # a long text goes through in parts
                windows = as_windows(raw[at:at + WINDOW * 512])
                data.append(windows)
                owner.append(np.full(len(windows), i))
                weight.append((windows != PAD).sum(axis=1) / len(raw))
                if sum(map(len, data)) >= 512:
                    add_up()
    add_up()
    chance = np.exp(log_softmax(total)) if len(texts) else total
    best = chance.argmax(axis=1)
    return ([net.names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)],
            [float(chance[i, b]) if k else 0.0 for i, (b, k) in enumerate(zip(best.tolist(), known))])


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def judge(batches):
        for batch in batches:
            names, scores = label(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        judge, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
