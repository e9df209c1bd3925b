"""The pipeline: decisions of each stage held against plain Python on its own input."""

import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_native import BASE_PII, spans_of
from tests.llm.test_similar import shingle_set

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run_stages(spark, docs, tmp_path):
    out = [docs]
    for i, (_, stage) in enumerate(C.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(tmp_path / str(i)))
        out.append(spark.read.parquet(str(tmp_path / str(i))))
    return out


def test_stages(llm, tmp_path):
    docs, clean, single, fair, masked, packed = run_stages(llm, llm.read.parquet(f"{SF}/documents.parquet"), tmp_path)
    for df in (clean, single, fair, masked):
        assert df.columns == COLUMNS
    rows = {name: {r["doc_id"]: r["text"] for r in df.collect()}
            for name, df in zip("docs clean single fair masked".split(), (docs, clean, single, fair, masked))}
    # near duplicates: what is left has no link, what went has one to something smaller
    sets = {i: shingle_set(t, 5) for i, t in rows["clean"].items()}
    links = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert not [p for p in links if p[0] in rows["single"] and p[1] in rows["single"]]
    gone = set(rows["clean"]) - set(rows["single"])
    assert gone and all(any(i in p for p in links) for i in gone)
    # decontamination: whole items in a document decide
    items = [re.sub(r"\W+", " ", r["text"].lower()).strip() for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, t in rows["single"].items() if any(x in re.sub(r"\W+", " ", t.lower()) for x in items)}
    assert leaked and leaked == set(rows["single"]) - set(rows["fair"])
    # personal data: none of the base spans is left, clean texts are untouched
    assert set(rows["masked"]) == set(rows["fair"])
    for i, t in rows["masked"].items():
        assert not spans_of(BASE_PII, t)
        if not spans_of(BASE_PII, rows["fair"][i]):
            assert t == rows["fair"][i]
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect())
    # packing: every id of every document, once
    t = Tokenizer.from_file(public_tokenizers.path(C.TOKENIZER))
    got: dict = {}
    for r in sorted(packed.collect(), key=lambda r: (r["doc_id"], r["start"])):
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {i: t.encode(x, add_special_tokens=False).ids + [1] for i, x in rows["masked"].items()}


def test_hard_rows_pass_every_stage(docs, llm, tmp_path):
    hard = [(1, None), (2, ""), (None, "no id"), (3, "same text here with some words"), (3, "same text here with some words"),
            (4, "w " * 30_000), (5, "mail a@b.co now")]
    frames = run_stages(llm, docs(hard), tmp_path)
    for df in frames[1:5]:
        assert df.columns == docs(hard).columns
    assert frames[2].count() == 6  # one of the equal rows
    kept = {r["doc_id"]: r["text"] for r in frames[4].collect()}
    assert kept[5] == "mail <EMAIL> now" and kept[1] is None
    assert run_stages(llm, docs([]), tmp_path / "none")[-1].count() == 0
