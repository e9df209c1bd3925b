"""Token ids, token files and packing against the library itself and literal best-fit decreasing."""

import functools
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sourcelens.llm import packing as P
from sourcelens.llm import token_files as T
from sourcelens.llm.token_ids import encoder

NAMES = {"space": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
TEXTS = [
    "", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \nb", "\n", "  ", "\ta\tb", "it's we'll 'tis", "x|y | z ||", "ÀÉ é é",
    "a\xa0b c　d", "a\x1cb\x1f c", "\x85a\x85", "<|endoftext|> <|startoftext|>x", "日本語 テキスト 123 4567", "İstanbul ΑΣ ΣΑΣ",
    "word,word. word! ...", "a" * 3000, "​a﻿b", "tab\t\tend\r\nline\r", "😀😀 👩‍👩‍👧",
]


@functools.cache
def library(cut):
    return Tokenizer.from_file(public_tokenizers.path(NAMES[cut]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab ZÉ'.,|<>\n\t\r\x1c\x85\xa0 s1é-ªſİıßǅɐ\u0301!?;:", "ll", "|>", " w", "\n\n", "word ", "naïve. ",
                                 "<|endoftext|>", "<|STARTOFTEXT|>", "Straße, "]), max_size=60))
def test_cut_texts_have_the_ids_of_whole_texts(parts):
    text = "".join(parts)
    for cut in NAMES:
        own = np.frombuffer(encoder(NAMES[cut], cut).encode([text])[0], encoder(NAMES[cut], cut).dtype)
        assert own.tolist() == library(cut).encode(text, add_special_tokens=False).ids


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    from sourcelens.llm import token_ids

    monkeypatch.setattr(token_ids, "REMEMBERED", 40)
    rnd = random.Random(1)
    for cut in NAMES:
        own = token_ids.Encoder(NAMES[cut], cut)
        for _ in range(6):
            texts = [" ".join(f"w{rnd.choice('abcdef') * rnd.randrange(9)}x." for _ in range(30)) for _ in range(5)]
            for text, ids in zip(texts, own.encode(texts)):
                assert np.frombuffer(ids, own.dtype).tolist() == library(cut).encode(text, add_special_tokens=False).ids
        assert len(own.table) <= 40 and sorted(own.index.values()) == list(range(len(own.table)))


def expected(cut, text, end):
    return library(cut).encode(text or "", add_special_tokens=False).ids + [end]


def test_token_files_round_trip(docs):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(5, None), (7, "twice"), (7, "twice"), (4, "long words " * 20_000)]
    rows += [(None, "no id"), (None, None)]
    base, manifest = T.write(docs(rows), NAMES["space"], "space", end_id=0)
    found = T.read(base, manifest, keep_ids=True).orderBy("start").collect()
    start = 0
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))
    if found[0]["n_tokens"] == 1:  # either of the two rows without an id comes first
        ordered[:2] = ordered[1::-1]
    for r, (i, t) in zip(found, ordered):
        ids = expected("space", t, 0)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (i, start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(found) == len(rows)
    where = manifest.where("first_doc <= 7 and last_doc >= 7").first()
    assert [x.tolist() for x in T.read_document(base, where["path"], 7)] == [expected("space", "twice", 0)] * 2
    base, manifest = T.write(docs([]), NAMES["space"], "space", end_id=0)
    assert T.read(base, manifest).count() == 0


def literal_best_fit(lengths, capacity):
    """Fill of every window by the textbook method, one piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        able = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if able:
            r, i = min(able)
            rooms[i] = r - n
        else:
            rooms.append(capacity - n)
    return sorted(capacity - r for r in rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60))
def test_plan_is_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, filled = P.plan(counts, 24)
    assert sorted(f for a, b, f in filled for _ in range(b - a)) == literal_best_fit(lengths, 24)
    places: dict = {}
    for n, count in counts.items():
        own = sorted((r for r in runs if r.length == n), key=lambda r: r.rank)
        for rank in range(count):
            r = [x for x in own if x.rank <= rank][-1]
            k = rank - r.rank
            places.setdefault(r.window + k // r.each, []).append((r.offset + k % r.each * n, n))
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 24


def test_packing_places_every_id_once(docs):
    random.seed(3)
    words = ["alpha", "beta", "gamma", "delta", "x|y", "1234"]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 300)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "same text"), (102, "same text"), (103, "very long " * 3_000)]
    made = P.pack(docs(rows), NAMES["word"], "word", end_id=1, capacity=256)
    found = made.collect()
    want = sorted((i, tuple(expected("word", t, 1))) for i, t in rows)
    assert sum(r["length"] for r in found) == sum(len(ids) for _, ids in want)
    by_doc: dict = {}
    for r in sorted(found, key=lambda r: (r["doc_id"], r["start"])):
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).extend(ids.tolist())
    assert by_doc[103] == list(dict(want)[103]) and by_doc[100] == [1] and by_doc[102] == list(dict(want)[102]) * 2
    filled = sum(r["length"] for r in found) / 256 / len({r["sequence_id"] for r in found})
    assert filled > 0.97
    whole = {r["sequence_id"]: r for r in P.sequences(made).collect()}
    for r in found:
        own = np.frombuffer(whole[r["sequence_id"]]["ids"], "<u4")
        assert own[r["offset"]:r["offset"] + r["length"]].tobytes() == r["ids"]
        assert len(own) == r["sequence_tokens"] <= r["padded_tokens"] <= 256
    assert P.pack(docs([]), NAMES["word"], "word").count() == 0
