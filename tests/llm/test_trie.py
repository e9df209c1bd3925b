"""Conversation prefix trie against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sourcelens.llm import conversation_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_nodes(sequences):
    """Nodes of {conv_id: [(role, text), ...]} straight from their definition."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    out = []
    for prefix, own in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(prefix))
        out.append((min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own), len(children),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def brute_rebuilt(rows):
    lists = {}
    for c, turn, role, text in rows:
        if c is not None:
            lists.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    lists = {c: [(r, t) for _, r, t in sorted(v)] for c, v in lists.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in lists}
    return {c: lists.get(c - int(np.fmod(c, 5)), [])[:h[c]] + v[h[c]:] for c, v in lists.items()}


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=120), st.integers(0, 10**6))
def test_find_close_is_the_matching_parenthesis(steps, seed):
    rnd, bits, open_now = random.Random(seed), [True], 1
    for s in steps:
        opens = rnd.random() < 0.5 or open_now == 1
        for _ in range(s * 9 if opens else min(s * 9, open_now - 1)):
            bits.append(opens)
            open_now += 1 if opens else -1
    bits += [False] * open_now
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    places = np.array(sorted(want))
    assert T.Parentheses(np.array(bits)).find_close(places).tolist() == [want[p] for p in places.tolist()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([("u", "a"), ("u", "bb"), ("a", "ü")]), max_size=4), min_size=1, max_size=14))
def test_one_shard_knows_its_plain_nodes(sequences):
    digest = lambda t: hashlib.md5(repr(t).encode()).digest()
    keyed = sorted((b"".join(map(digest, s)), i, s) for i, s in enumerate(sequences))
    sizes = np.array([len(t[1].encode()) for _, _, s in keyed for t in s], np.int64)
    made = T.shard_rows(3, np.array([i for _, i, _ in keyed]), [k for k, _, _ in keyed], sizes)
    want = {(r[0], r[1]): r for r in brute_nodes(dict(enumerate(sequences)))}
    for k, kind in enumerate(made["kind"]):
        if kind == T.NODE:
            own = want[made["conv_id"][k], made["depth"][k]]
            assert own[3:] == tuple(made[c][k] for c in COLUMNS[3:])
    assert sum(kind != T.ENDS for kind in made["kind"]) == len(want)


@pytest.mark.parametrize("piece", [T.PIECE, 2 * T.WIDTH])
def test_trie_over_shards_equals_brute_force(llm, monkeypatch, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    rnd = random.Random(4)
    rows = []
    for c in range(-12, 160):
        same = c % 3 == 0  # one conversation that a third of all repeat
        for turn in range(9 if same else rnd.randrange(1, 14)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"t{turn}" if same else rnd.choice("abü")))
    rows += [(500, None, None, None), (500, None, None, None), (500, 1, "user", "x"), (None, 1, "user", "lost"),
             (700, 3, "b", "y"), (700, 3, "a", "z"), (700, 3, "a", "y"), (701, 0, "", "")]
    df = llm.createDataFrame([(*r, 1, "k", 2) for r in rows],
                             "conv_id long, turn long, role string, text string, depth int, key string, n_convs int")
    want = brute_nodes(brute_rebuilt(rows))
    got = found(T.nodes(T.borrow_openings(T.turn_lists(df))))
    assert got == want


def test_long_and_turnless_conversations(llm):
    rows = [(c, t, "user", "w" * (t % 7)) for c in (1000, 1001, 1002) for t in range(600)]
    rows += [(c, 0, "user", "only") for c in range(2001, 2040)]  # bases are absent: some lose their only turn
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(T.nodes(T.borrow_openings(T.turn_lists(df)))) == brute_nodes(brute_rebuilt(rows))


def test_empty_table_gives_no_nodes(llm):
    df = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.nodes(T.borrow_openings(T.turn_lists(df))).count() == 0
