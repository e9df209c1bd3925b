"""S1 source tree scan and the E1-E5 index, with the lookups built on it."""

import ast
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sourcelens.operators import context as C
from sourcelens.operators import index as I
from sourcelens.operators import lookup as L
from sourcelens.sources.filesource import scan_sources

NESTED = """def f():
    class In:
        def g(self):
            pass

def g():
    return f()
"""

B_PY = """import os, a.c
from a.c import x
from . import y
from .z import w
import pkg


@decorator
def decorated(a):
    obj.method(a)
    return helper(a)


async def fetch():
    await obj.other()
"""


@pytest.fixture(scope="module")
def tree():
    root = tempfile.mkdtemp(prefix="srctree-")
    files = {
        "pkg/__init__.py": "",
        ".hidden/mod.py": "def hidden():\n    pass\n",
        "a/b.py": B_PY,
        "a/c.py": "x = 1\ndef x_fn():\n    return x\n",
        "nested.py": NESTED,
        "bad.py": "def broken(:\n    pass\n",
        "crlf.py": "def crlf():\r\n    return 1\r\n",
        "d.py": "from a import c\nimport a.c as alias\n",
        "notes.txt": "not python\n",
    }
    for rel, text in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    with open(os.path.join(root, "badutf.py"), "wb") as fh:
        fh.write(b"x = '\xff\xfe'\n")
    return root, files


@pytest.fixture(scope="module")
def indexed(spark, tree):
    root, _ = tree
    files = scan_sources(spark, {"proj": root}).cache()
    idx = I.extract(files.where(F.col("read_status") == "ok")).cache()
    return files, idx


def test_scan_keeps_hidden_init_empty_and_flags_bad_utf8(indexed):
    files, _ = indexed
    rows = {r["path"]: r for r in files.collect()}
    assert set(rows) == {"pkg/__init__.py", ".hidden/mod.py", "a/b.py", "a/c.py", "nested.py", "bad.py",
                         "crlf.py", "badutf.py", "d.py"}
    assert rows["pkg/__init__.py"]["content"] == ""
    assert rows["badutf.py"]["read_status"] == "bad_utf8" and rows["badutf.py"]["content"] is None
    assert rows["crlf.py"]["content"] == "def crlf():\n    return 1\n"  # text-mode read


def _python_defs(src):
    return [n.name for n in ast.walk(ast.parse(src))
            if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef))]


def test_walk_order_is_breadth_first(indexed):
    _, idx = indexed
    sk = {r["path"]: r["entry"] for r in I.skeleton_entries(idx).collect()}
    assert sk["nested.py"] == "### nested.py\n" + ", ".join(_python_defs(NESTED))
    assert _python_defs(NESTED) == ["f", "g", "In", "g"]
    assert "pkg/__init__.py" not in sk  # no definitions, no entry
    assert sk["a/b.py"] == "### a/b.py\ndecorated, fetch"


def test_parse_status_and_syntax_error_message(indexed, tree):
    _, idx = indexed
    st = {r["path"]: r for r in I.parse_status(idx).collect()}
    assert st["bad.py"]["status"] == "syntax_error"
    try:
        ast.parse(tree[1]["bad.py"])
    except SyntaxError as e:
        assert st["bad.py"]["error"] == str(e)
    req = idx.sparkSession.createDataFrame([("proj", "bad.py", "broken")], "project string, path string, name string")
    files, _ = indexed
    out = I.get_definitions(req, idx, files.where(F.col("read_status") == "ok")).first()["output"]
    assert out.startswith("Error parsing 'bad.py': ")


def test_imports_and_resolution(indexed):
    files, idx = indexed
    imps = [(r["module"], r["alias_pos"]) for r in
            I.imports(idx).where(F.col("path") == "a/b.py").orderBy("bfs_order", "alias_pos").collect()]
    assert imps == [("os", 0), ("a.c", 1), ("a.c", 0), ("pkg", 0)]  # relative imports skipped
    res = I.resolve_imports(idx, files.where(F.col("read_status") == "ok")).where(F.col("path") == "a/b.py")
    got = sorted(r["resolved_path"] for r in res.collect())
    assert got == ["a/c.py", "a/c.py"]  # duplicates kept; `import pkg` resolves nothing
    d = I.resolve_imports(idx, files.where(F.col("read_status") == "ok")).where(F.col("path") == "d.py")
    # `from a import c` looks up module `a` only; `import a.c as alias` resolves a/c.py
    assert [(r["module"], r["resolved_path"]) for r in d.collect()] == [("a.c", "a/c.py")]


def test_definition_source_and_calls(indexed, spark):
    files, idx = indexed
    req = spark.createDataFrame(
        [("proj", "a/b.py", "decorated"), ("proj", "nested.py", "g"), ("proj", "nested.py", "nope")],
        "project string, path string, name string",
    )
    ok = files.where(F.col("read_status") == "ok")
    out = {(r["path"], r["name"]): r for r in I.get_definitions(req, idx, ok).collect()}
    assert out[("a/b.py", "decorated")]["output"] == "def decorated(a):\n    obj.method(a)\n    return helper(a)"
    assert out[("a/b.py", "decorated")]["lineno"] == 9
    assert out[("nested.py", "g")]["lineno"] == 6  # first in walk order, not in line order
    assert out[("nested.py", "nope")]["output"] == "'nope' not found in nested.py"
    hits = I.search_symbols(spark.createDataFrame([("proj", "method"), ("proj", "f"), ("proj", "zzz")],
                                                  "project string, symbol string"), idx)
    h = sorted(r["hit"] for r in hits.collect())
    assert h == ["'zzz' not found in project", "CALLED   a/b.py:10", "CALLED   nested.py:7", "DEFINED  nested.py:1"]


def test_build_context_sections(indexed, spark):
    files, idx = indexed
    ok = files.where(F.col("read_status") == "ok")
    tgt = spark.createDataFrame([("proj", "a/b.py")], "project string, path string")
    r = C.build_contexts(ok, idx, tgt).first()
    assert r["imported_section"] == "## Imported Files\n" + "x = 1\ndef x_fn():\n    return x\n" + "\n\n---\n\n" + \
        "x = 1\ndef x_fn():\n    return x\n"
    assert r["target_section"].startswith("## Target File: b.py\n1 | import os, a.c\n\n2 | from a.c import x\n")
    entries = I.skeleton_entries(idx).collect()
    skeleton = "## Project Skeleton\n" + "\n".join(e["entry"] for e in entries)
    assert r["skeleton_chars"] == len(skeleton)
    assert r["context_chars"] == len(skeleton) + 2 + len(r["imported_section"]) + 2 + len(r["target_section"])


def test_dispatch_errors_and_paths(indexed, spark):
    files, idx = indexed
    calls = spark.createDataFrame(
        [
            (1, "read_file", '{"file_path": "a/c.py"}'),
            (2, "read_file", '{"file_path": "../etc/passwd"}'),
            (3, "read_file", '{"file_path": "a/c.py"'),
            (4, "read_file", "[1]"),
            (5, "list_dir", "{}"),
            (6, "get_function", '{"file_path": "a/./b.py", "name": "fetch"}'),
            (7, "search_symbol", '{"symbol": "other"}'),
            (8, "read_file", '{"file_path": "missing.py"}'),
        ],
        "call_id long, name string, arguments string",
    ).withColumn("project", F.lit("proj"))
    ok = files.where(F.col("read_status") == "ok")
    out = {r["call_id"]: r for r in L.dispatch(calls, L.LookupContext(ok, idx, "/root")).collect()}
    assert out[1]["output"] == "x = 1\ndef x_fn():\n    return x\n"
    assert out[2]["output"] == "Error: '../etc/passwd' is outside the project root"
    assert out[3]["status"] == "invalid_json" and out[3]["output"].startswith(
        "Error: invalid JSON arguments for tool 'read_file'")
    assert out[4]["output"] == "Error running tool 'read_file': Tool arguments must decode to a JSON object"
    assert out[5]["output"] == "Error running tool 'list_dir': Tool \"list_dir\" not found in registry"
    assert out[6]["output"] == "async def fetch():\n    await obj.other()"
    assert out[7]["output"] == "CALLED   a/b.py:15"
    assert out[8]["output"] == "Error reading 'missing.py': file not found"


def test_refresh_index_parses_only_changed_files(spark):
    files_v1 = spark.createDataFrame(
        [("p", "a.py", "def a():\n    pass\n"), ("p", "b.py", "def b():\n    pass\n"), ("p", "c.py", "def c(): pass\n")],
        "project string, path string, content string")
    idx_v1 = I.extract(files_v1).cache()
    files_v2 = spark.createDataFrame(
        [("p", "a.py", "def a():\n    pass\n"), ("p", "b.py", "def b2():\n    pass\n"), ("p", "d.py", "def d(): pass\n")],
        "project string, path string, content string")
    refreshed = I.refresh_index(files_v2, idx_v1)
    defs = sorted((r["path"], r["name"]) for r in I.definitions(refreshed).collect())
    assert defs == [("a.py", "a"), ("b.py", "b2"), ("d.py", "d")]
    fresh = sorted((r["path"], r["name"]) for r in I.definitions(I.extract(files_v2)).collect())
    assert defs == fresh


SEGMENT_SOURCES = [
    "@deco('é€')\nclass A: x = 'é€'\n",
    "def f(a='ü'):\r\n    return a\r\n\r\nclass B:\r\n    def g(self): return 'ß'\r\n",
    "@dec\nasync def h():\n    await x\n\nif True:\n    def inner(): pass\n",
    "s = 'a\\\nb'; t = 1\ndef z(): return '😀'\n",
]


def test_segment_offsets_equal_get_source_segment(spark):
    files = spark.createDataFrame([("p", f"f{i}.py", t) for i, t in enumerate(SEGMENT_SOURCES)],
                                  "project string, path string, content string")
    idx = I.extract(files)
    defs = idx.where("rec = 'def'").select("project", "path", "name", "lineno", "seg_start", "seg_end")
    got = {(r["path"], r["name"], r["lineno"]): r["source"] for r in I.definition_source(defs, files).collect()}
    expected = {}
    for i, t in enumerate(SEGMENT_SOURCES):
        for n in ast.walk(ast.parse(t)):
            if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                expected[(f"f{i}.py", n.name, n.lineno)] = ast.get_source_segment(t, n)
    assert got == expected and len(expected) == 7


def test_scan_is_the_same_however_it_is_dealt_out(spark, tree, monkeypatch):
    from sourcelens.sources import filesource

    root, files = tree
    whole = sorted(map(tuple, scan_sources(spark, {"proj": root}).collect()))
    assert len(whole) == 9 and {r[1] for r in whole} == {p for p in files if p.endswith(".py")} | {"badutf.py"}
    monkeypatch.setattr(filesource, "LIST_ROWS", 2)
    monkeypatch.setattr(filesource, "READ_BYTES", 10)
    for depth in (1, 2):
        again = scan_sources(spark, {"proj": root}, depth=depth, read_partitions=3)
        assert sorted(map(tuple, again.collect())) == whole


def test_a_followed_tree_reads_and_parses_only_changes(spark):
    from sourcelens.sources import filesource

    root = tempfile.mkdtemp(prefix="followed-")

    def put(rel, text):
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w", encoding="utf-8") as fh:
            fh.write(text)

    for i in range(6):
        put(f"d{i % 2}/f{i}.py", f"def f{i}(): pass\n")
    first, listing = filesource.follow_tree(spark, {"p": root}, None)
    first = first.keep("followed")
    assert sorted(r["name"] for r in I.definitions(first).collect()) == [f"f{i}" for i in range(6)]
    # one file changes, one is new, one goes, one moves and one is copied
    put("d0/f0.py", "def changed(): pass\n")
    put("d1/new.py", "def new(): pass\n")
    os.remove(os.path.join(root, "d1/f1.py"))
    os.renames(os.path.join(root, "d0/f2.py"), os.path.join(root, "d2/moved.py"))
    put("d2/copy.py", "def f3(): pass\n")
    second, listing = filesource.follow_tree(spark, {"p": root}, first, listing)
    second = second.keep("followed")
    got = sorted((r["path"], r["name"]) for r in I.definitions(second).collect())
    assert got == [("d0/f0.py", "changed"), ("d0/f4.py", "f4"), ("d1/f3.py", "f3"), ("d1/f5.py", "f5"), ("d1/new.py", "new"),
                   ("d2/copy.py", "f3"), ("d2/moved.py", "f2")]
    fresh = second.of("file").join(first.of("file"), "content_sha", "left_anti")
    assert fresh.count() == 2  # parsed: the changed and the new text alone
    third, _ = filesource.follow_tree(spark, {"p": root}, second, listing)
    assert third.paths.exceptAll(second.paths).count() == 0 and third.records.exceptAll(second.records).count() == 0


def test_hot_module_is_salted_and_exact(spark):
    from sourcelens.plans import joins

    rows = [("p", "hot.py", "def h():\n    pass\n"), ("p", "other.py", "x = 1\n")]
    rows += [("p", f"m{i}.py", "import hot\n" * 5 + ("import other\n" if i % 7 == 0 else "")) for i in range(300)]
    files = spark.createDataFrame(rows, "project string, path string, content string")
    idx = I.extract(files).cache()
    plain = I.imports(idx).join(
        I.modules(files).select("project", F.col("module_key").alias("module"), F.col("path").alias("resolved_path")),
        ["project", "module"]).select("path", "lineno", "resolved_path")
    old = joins.HOT_KEY_ROWS
    joins.HOT_KEY_ROWS = 100  # the hot module (1,500 imports) is salted, `other` is not
    try:
        got = I.resolve_imports(idx, files).select("path", "lineno", "resolved_path")
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
        assert got.count() == plain.count() == 300 * 5 + 43
    finally:
        joins.HOT_KEY_ROWS = old


def copies(spark, projects=20):
    texts = {"a.py": "def a():\n    return b()\n", "b.py": "import a\nclass B:\n    pass\n", "bad.py": "def (:\n", "e.py": "",
             "same_as_a.py": "def a():\n    return b()\n"}
    rows = [(f"p{i}", path, text) for i in range(projects) for path, text in texts.items()]
    rows += [(f"p{i}", "own.py", f"def own_{i}(): pass\n") for i in range(projects)] + [("p0", "none.py", None)]
    return rows, spark.createDataFrame(rows, "project string, path string, content string")


def test_every_content_is_parsed_once(spark, monkeypatch):
    from sourcelens.plans import joins

    rows, files = copies(spark)
    idx = I.extract(files).keep("copies")
    # the parser leaves one status record per text that it was given
    assert idx.of("file").count() == len({t for _, _, t in rows if t is not None}) == 24
    assert idx.paths.count() == len(rows)
    # a moved, copied or unchanged file parses nothing; a new text parses once, in however many projects
    moved = files.where("project = 'p0'").withColumn("project", F.lit("new")).unionByName(files)
    assert I.parse_contents(I.with_sha(moved), idx.of("file")).count() == 0
    changed = moved.withColumn("content", F.when(F.col("path") == "a.py", "def a2(): pass\n").otherwise(F.col("content")))
    fresh = I.parse_contents(I.with_sha(changed), idx.of("file"))
    assert [(r["rec"], r["name"]) for r in fresh.collect()] == [("file", None), ("def", "a2")]
    after = I.refresh_index(changed, idx)
    assert {r["name"] for r in I.definitions(after).collect()} == {"a", "a2", "B"} | {f"own_{i}" for i in range(20)}
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 3)  # contents that more files hold are salted
    status = {(r["project"], r["path"]): r["status"] for r in I.parse_status(I.ParseStore(idx.paths, idx.records)).collect()}
    assert len(status) == len(rows) and status["p7", "bad.py"] == "syntax_error" and status["p0", "none.py"] == "unreadable"
    entries = {(r["project"], r["path"]): r["entry"] for r in I.skeleton_entries(I.ParseStore(idx.paths, idx.records)).collect()}
    assert len(entries) == 20 * 4 and entries["p3", "same_as_a.py"] == "### same_as_a.py\na"


def test_symbols_of_one_project_stay_in_it(spark):
    _, files = copies(spark, 4)
    idx = I.extract(files).keep("few")
    req = spark.createDataFrame([("p1", "b"), ("p1", "own_2"), ("p2", "own_2")], "project string, symbol string")
    found = sorted((r["project"], r["hit"]) for r in I.search_symbols(req, idx).collect())
    assert found == [("p1", "'own_2' not found in project"), ("p1", "CALLED   a.py:2"), ("p1", "CALLED   same_as_a.py:2"),
                     ("p2", "DEFINED  own.py:1")]
    asked = spark.createDataFrame([("p1", "same_as_a.py", "a"), ("p2", "a.py", "a"), ("p2", "bad.py", "x"), ("p9", "a.py", "a")],
                                  "project string, path string, name string")
    out = {(r["project"], r["path"]): (r["status"], r["output"]) for r in I.get_definitions(asked, idx, files).collect()}
    assert out["p1", "same_as_a.py"] == out["p2", "a.py"] == ("ok", "def a():\n    return b()")
    assert out["p2", "bad.py"][0] == "parse_error" and out["p9", "a.py"] == ("missing", "Error parsing 'a.py': file not found")


def test_index_is_written_and_read(spark):
    _, files = copies(spark, 3)
    out = tempfile.mkdtemp(prefix="store-")
    I.write_index(I.extract(files), out)
    back = I.read_index(spark, out)
    assert back.paths.count() == files.count() and back.of("file").count() == 7
    assert sorted(r["path"] for r in I.definitions(back).where("project = 'p1'").collect()) == ["a.py", "b.py", "own.py", "same_as_a.py"]


@pytest.mark.parametrize("size", [10, 64, 1 << 20])
def test_prompts_in_chunks_are_the_whole_prompts(spark, size):
    """Chunks put together are skeleton, imports and target as one text; digests follow from the chunks."""
    import hashlib

    rows, files = copies(spark, 3)
    files = files.where("content is not null").unionByName(
        spark.createDataFrame([("bare", "x.py", "x = 1\n")], files.schema))
    idx = I.extract(files).keep("prompts")
    ctx = C.build_contexts(files, idx, files.select("project", "path"))
    head = F.concat(F.lit("Look at "), F.col("path"), F.lit("\n\n"))
    chunks = C.prompt_chunks(ctx, head, idx, chunk_chars=size).collect()
    prompts = {(r["project"], r["path"]): r["prompt"] for r in
               C.assemble_prompts(C.prompt_chunks(ctx, head, idx, chunk_chars=size)).collect()}
    entries = I.skeleton_entries(idx).collect()
    assert len(prompts) == files.count()
    for r in ctx.collect():
        own = sorted((e["path"], e["entry"]) for e in entries if e["project"] == r["project"])
        parts = ["## Project Skeleton\n" + "\n".join(e for _, e in own), r["imported_section"], r["target_section"]]
        context = "\n\n".join(p for p in parts if p is not None)
        assert prompts[r["project"], r["path"]] == f"Look at {r['path']}\n\n" + context
        assert r["context_chars"] == len(context) and r["skeleton_chars"] == len(parts[0])
    assert max(len(c["text"]) for c in chunks if c["part"] == 1) <= len("## Project Skeleton\n") + size + max(len(e["entry"]) for e in entries)
    sums: dict = {}
    for c in chunks:
        mark = hashlib.sha256(f"{c['part']}:{c['chunk_no']}:{c['text']}".encode()).hexdigest()
        total = sums.setdefault((c["project"], c["path"]), [0, 0, 0, 0, 0, 0])
        for i in range(4):
            total[i] += int(mark[15 * i:15 * i + 15], 16)
        total[4] += len(c["text"])
        total[5] += 1
    got = {(r["project"], r["path"]): (r["prompt_digest"], r["prompt_chars"], r["n_chunks"])
           for r in C.prompt_digests(ctx, head, idx, chunk_chars=size).collect()}
    assert got == {k: ("-".join(map(str, t[:4])), t[4], t[5]) for k, t in sums.items()}


def test_running_totals_over_ranges(spark):
    import random

    from sourcelens.plans.order import positions, running_total

    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), i, rnd.choice([0, 1, 5, None])) for i in rnd.sample(range(10_000), 2_000)]
    df = spark.createDataFrame(rows, "g string, k int, w int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many ranges
    try:
        got = {(r["g"], r["k"]): r["t"] for r in running_total(df, ["g"], ["k"], F.col("w"), "t").collect()}
        places = [(r["p"], r["k"]) for r in positions(df, ["k"], "p").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, total = {}, {}
    for g, k, w in sorted(rows, key=lambda r: r[1]):
        want[g, k] = total.get(g, 0)
        total[g] = total.get(g, 0) + (w or 0)
    assert got == want
    assert sorted(places) == list(enumerate(sorted(k for _, k, _ in rows), 1))


def test_ordered_hits_number_all_results(spark):
    _, files = copies(spark, 3)
    idx = I.extract(files).keep("ordered")
    req = files.select("project", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("nothing"))).alias("symbol"))
    hits = I.ordered_hits(I.search_symbols(req, idx)).collect()
    order = sorted(hits, key=lambda r: (r["project"], r["symbol"], r["path"] is None, r["path"] or "", r["bfs_order"] or 0))
    assert [r["position"] for r in order] == list(range(1, len(hits) + 1))


def test_records_are_made_once(spark):
    """Keeping records neither shuffles them nor runs what makes them a second time for a sample."""
    made = spark.sparkContext.accumulator(0)

    def records(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(bytes([i % 7]), "call", None, f"n{i % 10}", i, None, i, None, None, None, None, None) for i in range(500)]
    df = spark.createDataFrame(rows, I.RECORD_SCHEMA).repartition(4)
    kept = I.ParseStore(df.select(F.lit("p").alias("project"), F.lit("x.py").alias("path"), "content_sha").limit(1),
                        df.mapInArrow(records, I.RECORD_SCHEMA)).keep("once")
    assert made.value == 500 and kept.of("call").count() == 500


def test_a_module_with_two_files_keeps_the_first_path_and_its_repeats(spark):
    files = spark.createDataFrame([("p", "a/b.py", "x"), ("p", "a/b.py", "x"), ("p", "a.b.py", "y"), ("p", "a/b.txt", "z"),
                                   ("p", "m.py", "import a.b\n"), (None, "a/b.py", "n")], "project string, path string, content string")
    found = I.resolve_imports(I.extract(files.where("path = 'm.py'")), files)
    assert [(r["resolved_path"], r["resolved_content"]) for r in found.collect()] == [("a.b.py", "y")]
    repeated = I.resolve_imports(I.extract(files.where("path = 'm.py'")), files.where("content <> 'y'"))
    assert [r["resolved_content"] for r in repeated.collect()] == ["x", "x"]
    scans = found._jdf.queryExecution().optimizedPlan().toString().count("resolved_content")
    assert scans > 0 and found._jdf.queryExecution().optimizedPlan().toString().count("Window") == 1  # one pass over the files


def test_a_large_round_is_decoded_once(spark, monkeypatch):
    """Rounds too large for a broadcast give what small ones give, from calls that were decoded beforehand."""
    from sourcelens.plans import joins

    _, files = copies(spark, 3)
    idx = I.extract(files.where("content is not null")).keep("round")
    each = [("read_file", '{"file_path":"a.py"}'), ("read_file", '{"file_path":"../a.py"}'), ("read_file", '{"file_path":"none"}'),
            ("get_function", '{"file_path":"b.py","name":"B"}'), ("get_function", '{"file_path":"bad.py","name":"B"}'),
            ("search_symbol", '{"symbol":"b"}'), ("search_symbol", '{"symbol":"zz"}'), ("list_dir", "{}"), ("read_file", "[1]")]
    calls = spark.createDataFrame([(i, f"p{i % 3}", *each[i % 9]) for i in range(90)],
                                  "call_id long, project string, name string, arguments string")
    ctx = L.LookupContext(files, idx, "/root")
    small = sorted(map(tuple, L.dispatch(calls, ctx).collect()))
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 20)
    out = L.dispatch(calls, ctx)
    assert sorted(map(tuple, out.collect())) == small and len(small) == 100
    assert "parse_json" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_walk_has_the_order_of_ast():
    import asyncio.base_events
    import typing

    odd = "match x:\n    case {'a': 1, **r} | P(1, k=2): pass\nglobal g\nf = lambda *a, b=1: {**a, 1: f'{b!r:>{a}}'}\ntype T[K] = list[K]\n"
    for text in [odd, B_PY, NESTED, "", *(open(m.__file__, encoding="utf-8").read() for m in (typing, asyncio.base_events))]:
        tree = ast.parse(text)
        assert [id(n) for n in I.walk(tree)] == [id(n) for n in ast.walk(tree)]


def test_parsing_a_batch_runs_no_collector():
    """The collector would go through every tree and row of the batch; afterwards it is as it was."""
    import gc

    import pyarrow as pa

    text = "".join(f"def f{i}(): g{i}()\n" for i in range(300))
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(30)]), pa.array([text] * 30)], ["content_sha", "content"])
    runs, count = [], lambda phase, info: runs.append(phase)
    gc.callbacks.append(count)
    try:
        rows = I._batch_records(batch)
    finally:
        gc.callbacks.remove(count)
    assert len(rows) == 30 * 601 and not runs and gc.isenabled()


def test_a_content_key_has_128_bits(spark):
    """It is repeated in every path and record and cannot be shortened by a codec; equal contents have equal keys."""
    import hashlib

    files = spark.createDataFrame([("p", "a.py", "x = 1\n"), ("q", "b.py", "x = 1\n"), ("p", "c.py", "y\n"), ("p", "d.py", None)],
                                  "project string, path string, content string")
    got = {r["path"]: r["content_sha"] for r in I.extract(files).paths.collect()}
    key = lambda s: hashlib.sha256(s.encode()).digest()[:16]
    assert got == {"a.py": key("x = 1\n"), "b.py": key("x = 1\n"), "c.py": key("y\n"), "d.py": None}


@pytest.mark.parametrize("small", [True, False])
def test_requests_are_worked_out_once(spark, monkeypatch, small):
    from sourcelens.plans import joins

    made = spark.sparkContext.accumulator(0)

    def requests(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    if not small:
        monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    files = spark.createDataFrame([("p", "a.py", "def f(): g()\n"), ("q", "b.py", "f()\n")], "project string, path string, content string")
    asked = spark.createDataFrame([("p", "f"), ("q", "f"), ("p", "z"), ("p", "f")], "project string, symbol string")
    idx = I.extract(files).keep("asked_once")
    hits = I.search_symbols(asked.mapInArrow(requests, asked.schema), idx)
    assert sorted(r["hit"] for r in hits.collect()) == ["'z' not found in project", "CALLED   b.py:1", "DEFINED  a.py:1"]
    assert made.value == 4


def test_skeleton_entries_are_worked_out_once(spark, monkeypatch):
    from sourcelens.plans import catalog

    asked, entries = [], I.skeleton_entries
    monkeypatch.setattr(I, "skeleton_entries", lambda index: asked.append(1) or entries(index))
    for name in ("compose_code_prompts", "compose_prompts", "vendored_prompts"):
        asked.clear()
        assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
        assert len(asked) == 1, name
