"""S4/S5 sinks, Z1 registry, Z3 argument checks, X15 output normalisation, F11 filter, index writes."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from sourcelens.operators import context as C
from sourcelens.operators import index as I
from sourcelens.operators import lookup as L
from sourcelens.sources import sinks


def test_write_updates_only_changed_and_snapshot(spark):
    df = spark.createDataFrame(
        [("p", "a.py", "x\n", "# REVIEW: c\nx\n"), ("p", "b.py", "y\n", "y\n")],
        "project string, path string, content string, updated string",
    )
    out = tempfile.mkdtemp(prefix="upd-")
    sinks.write_updates(df, out)
    written = spark.read.parquet(out)
    assert [r["path"] for r in written.collect()] == ["a.py"]
    files = df.select("project", "path", "content")
    snap = {r["path"]: r["content"] for r in sinks.apply_updates(files, written).collect()}
    assert snap == {"a.py": "# REVIEW: c\nx\n", "b.py": "y\n"}


def test_write_files_touches_changed_files_only(spark):
    root = tempfile.mkdtemp(prefix="tree-")
    for name, text in (("a.py", "x\n"), ("b.py", "y\n")):
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)
    before_b = os.stat(os.path.join(root, "b.py")).st_mtime_ns
    df = spark.createDataFrame(
        [("p", "a.py", "x\n", "# REVIEW: c\nx\n"), ("p", "b.py", "y\n", "y\n")],
        "project string, path string, content string, updated string",
    )
    status = {r["path"]: r["status"] for r in sinks.write_files(df, {"p": root}).collect()}
    assert status == {"a.py": "written"}
    assert open(os.path.join(root, "a.py")).read() == "# REVIEW: c\nx\n"
    assert os.stat(os.path.join(root, "b.py")).st_mtime_ns == before_b


def test_write_files_stays_inside_the_root(spark):
    top = tempfile.mkdtemp(prefix="tree-")
    root = os.path.join(top, "root")
    os.makedirs(root)
    rows = [("p", "../escaped.py"), ("p", os.path.join(top, "absolute.py")), ("p", "a/../../up.py"), ("p", "ok/in.py"),
            ("q", "none.py")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "project string, path string, content string, updated string")
    for _ in range(2):  # a second run gives the same tree
        status = {r["path"]: r["status"] for r in sinks.write_files(df, {"p": root}).collect()}
        assert status["ok/in.py"] == "written" and status["none.py"].startswith("error")
        assert all(status[p] == sinks.OUTSIDE_ROOT for _, p in rows[:3])
    assert sorted(os.listdir(top)) == ["root"] and os.listdir(os.path.join(root, "ok")) == ["in.py"]


def test_write_updates_twice_keeps_one_row_per_file(spark):
    df = spark.createDataFrame([("p", "a.py", "x", "y"), ("q", "a.py", "x", "z")],
                               "project string, path string, content string, updated string")
    out = tempfile.mkdtemp(prefix="upd-")
    sinks.write_updates(df, out)
    sinks.write_updates(df, out)
    assert sorted((r["project"], r["content"]) for r in spark.read.parquet(out).collect()) == [("p", "y"), ("q", "z")]


def test_write_diffs_names(spark):
    import hashlib

    df = spark.createDataFrame([("p", "src/mod.py", "a\n", "# REVIEW: x\na\n")],
                               "project string, path string, before string, after string")
    out = tempfile.mkdtemp(prefix="diffs-")
    sinks.write_diffs(df, out, prefix="review")
    r = spark.read.parquet(out).first()
    assert r["diff_path"] == f"review_mod_{hashlib.sha1(b'p/src/mod.py').hexdigest()[:10]}.diff"
    assert r["diff"].startswith("--- src/mod.py\n+++ src/mod.py\n@@ -1 +1,2 @@\n+# REVIEW: x\n")


def test_registry_replaces_and_keeps_order():
    r = L.default_registry()
    assert r.names() == ["read_file", "get_function", "search_symbol"]
    first = r.tools["read_file"]
    r.register(L.Tool("read_file", Ty.StructType.fromDDL("file_path string NOT NULL"), first.run))
    assert r.names() == ["read_file", "get_function", "search_symbol"] and r.tools["read_file"] is not first
    with pytest.raises(ValueError, match="cannot be arguments"):
        L.Tool("t", Ty.StructType.fromDDL("x date"), first.run)
    with pytest.raises(ValueError, match="cannot be arguments"):
        L.Tool("t", Ty.StructType.fromDDL("x string"), first.run, {"y": ["a"]})


def test_schemas_check_required_types_and_choices(spark):
    r = L.Registry()
    r.register(L.Tool("t", Ty.StructType.fromDDL(
        "s string NOT NULL, n double, b boolean, o map<string,string>, a array<string>"), None, {"s": ["x", "y"]}))
    calls = spark.createDataFrame(
        [(1, "t", '{"s":"x","n":1,"b":true,"o":{},"a":[]}'), (2, "t", '{"s":"z","n":"1","b":0,"o":[],"a":{}}'), (3, "t", '{"n":1.5}')],
        "call_id long, name string, arguments string")
    got = {v["call_id"]: v["problems"] for v in L.argument_violations(calls, r).collect()}
    assert got == {2: ["s not in enum", "n is not of type number", "b is not of type boolean", "o is not of type object",
                       "a is not of type array"], 3: ["missing s"]}


def test_argument_violations_and_output_normalisation(spark):
    calls = spark.createDataFrame(
        [(1, "read_file", "{}"), (2, "get_function", '{"file_path": "a.py"}'), (3, "search_symbol", '{"symbol": "f"}')],
        "call_id long, name string, arguments string",
    )
    v = {r["call_id"]: r["problems"] for r in L.argument_violations(calls).collect()}
    assert v == {1: ["missing file_path"], 2: ["missing name"]}
    df = spark.createDataFrame([('"text"',), ('{"a": 1}',), ("[1, 2]",)], "j string")
    got = [r[0] for r in df.select(L.normalise_output(F.parse_json("j"))).collect()]
    assert got == ["text", '{"a": 1}', "[1, 2]"]


def test_exclude_sensitive_and_index_write(spark):
    files = spark.createDataFrame(
        [("p", ".venv/lib/x.py", "def a(): pass\n"), ("p", "src/__pycache__/m.py", ""), ("p", ".env", "K=1"),
         ("p", "src/ok.py", "def ok():\n    pass\n"), ("p", "a.pyc", "")],
        "project string, path string, content string",
    )
    kept = [r["path"] for r in C.exclude_sensitive(files).collect()]
    assert kept == ["src/ok.py"]
    out = tempfile.mkdtemp(prefix="idx-")
    I.write_index(I.extract(C.exclude_sensitive(files)), out)
    assert sorted(d for d in os.listdir(out) if d.startswith("rec=")) == ["rec=def", "rec=file"]
    back = spark.read.parquet(out)
    assert [r["name"] for r in back.where("rec = 'def'").collect()] == ["ok"]


def test_duplicate_json_keys_last_wins(spark):
    import json

    text = '{"file_path": "a.py", "file_path": "b.py"}'
    df = L.classify_arguments(spark.createDataFrame([(text,)], "arguments string"))
    r = df.select("arg_status", L.arg("file_path").alias("fp")).first()
    assert (r["arg_status"], r["fp"]) == ("object", json.loads(text)["file_path"])


def test_read_files_table_projects_and_prunes(spark):
    from tests.test_plans import plan_of
    from sourcelens.sources.tables import read_files_table

    df = read_files_table(spark, "/root/testdata/sf0.001/documents.parquet", project="source",
                          path_col="lang", content="text").where(F.col("project") == "src1")
    plan = plan_of(df)
    assert "ReadSchema: struct<text:string,lang:string,source:string>" in plan
    assert "EqualTo(source,src1)" in plan
    assert df.columns == ["project", "path", "content"] and df.count() > 0


def test_arguments_read_like_python_strings(spark):
    cases = ['{"a":null}', '{"a":true}', '{"a":false}', '{"a":7}', '{"a":"x"}', '{}', '{"a":"1","a":"2"}']
    df = L.classify_arguments(spark.createDataFrame(list(enumerate(cases)), "i int, arguments string"))
    got = {r["i"]: r["v"] for r in df.select("i", L.arg("a").alias("v")).collect()}
    assert [got[i] for i in range(len(cases))] == ["None", "True", "False", "7", "x", "", "2"]


def test_read_file_honours_max_chars(spark):
    files = spark.createDataFrame([("p", "a.py", "x = 12345\n")], "project string, path string, content string")
    idx = I.extract(files)
    calls = spark.createDataFrame(
        [(1, "p", "read_file", '{"file_path":"a.py","max_chars":3}'), (2, "p", "read_file", '{"file_path":"a.py"}'),
         (3, "p", "read_file", '{"file_path":"a.py","max_chars":0}')],
        "call_id bigint, project string, name string, arguments string")
    out = {r["call_id"]: r["output"] for r in L.dispatch(calls, L.LookupContext(files, idx, "/root")).collect()}
    assert out[1].startswith("x =") and "truncated at 3" in out[1] and out[2] == out[3] == "x = 12345\n"


def test_max_chars_counts_whole_numbers_and_booleans_only(spark):
    """What Python's decoder makes an int (booleans too) limits the output; of equal keys the last one does."""
    import json

    text = "x = 12345\n"
    files = spark.createDataFrame([("p", "a.py", text)], "project string, path string, content string")
    idx = I.extract(files)
    values = ["3", '"3"', "true", "false", "3.0", "2.5", "null", "-4", "0", "1e1", "[3]", "99999999999999999999",
              '3,"max_chars":5', '3,"max_chars":"x"']
    calls = spark.createDataFrame([(i, "p", "read_file", '{"file_path":"a.py","max_chars":' + v + "}") for i, v in enumerate(values)],
                                  "call_id bigint, project string, name string, arguments string")
    out = {r["call_id"]: r["output"] for r in L.dispatch(calls, L.LookupContext(files, idx, "/root")).collect()}
    for i, v in enumerate(values):
        limit = json.loads('{"max_chars":' + v + "}")["max_chars"]
        limit = int(limit) if isinstance(limit, int) else None
        cut = text[:limit] + f"\n\n... truncated at {limit} characters" if limit and len(text) > limit else text
        assert out[i] == cut, v


def test_a_failed_run_publishes_nothing(spark):
    from sourcelens.sources import published as PB

    root = tempfile.mkdtemp(prefix="published-")
    assert PB.read_published(spark, root).count() == 0
    first = [("p", f"d{i % 7}/f{i}.py", f"text {i}\r\nü") for i in range(40)] + [("q", "d1/f1.py", ""), ("q", "e.py", None)]
    schema = "project string, path string, content string"
    PB.publish(spark.createDataFrame(first, schema).repartition(5), root)
    want = sorted((p, x, c or "") for p, x, c in first)
    assert sorted(map(tuple, PB.read_published(spark, root).collect())) == want
    held = PB.published(root)
    # one task of the next run fails after others have staged their files: readers see the run before
    second = spark.createDataFrame([("p", f"new{i}.py", "x") for i in range(40)] + [("p", "../outside.py", "x")], schema)
    with pytest.raises(Exception, match="leaves its project"):
        PB.publish(second.repartition(6), root)
    assert PB.published(root) == held and os.listdir(os.path.join(root, "runs")) == [held["run"]]
    assert not os.path.exists(os.path.join(root, "outside.py"))
    assert sorted(map(tuple, PB.read_published(spark, root).collect())) == want
    # a driver that died before its commit leaves a run that nothing names
    os.makedirs(os.path.join(root, "runs", "dead", "task", "p"))
    assert sorted(map(tuple, PB.read_published(spark, root).collect())) == want and PB.clear_old_runs(root) == 1
    PB.publish(spark.createDataFrame([("p", "only.py", "1")], schema), root)
    assert [tuple(r) for r in PB.read_published(spark, root).collect()] == [("p", "only.py", "1")]
    assert PB.clear_old_runs(root) == 1


def test_table_functions_stream_pieces(spark, monkeypatch):
    from sourcelens.operators import table_functions as TF

    files = spark.createDataFrame(
        [("p", f"m{i}.py", "def run():\n    pass\n" + "x = 1\n" * (i * 90)) for i in range(4)], "project string, path string, content string")
    calls = spark.createDataFrame(
        [(1, "p", "search_symbol", '{"symbol":"run"}'), (2, "p", "search_symbol", '{"symbol":"no"}'),
         (3, "p", "read_file", '{"file_path":"m3.py"}'), (4, "p", "read_file", '{"file_path":"gone.py","max_chars":3}'),
         (5, "p", "read_file", '{"file_path":"m0.py","max_chars":3}'), (6, "p", "read_file", "[1]"),
         (7, "p", "read_file", '{"file_path":"../m0.py"}')],
        "call_id bigint, project string, name string, arguments string")
    ctx = L.LookupContext(files, I.extract(files), "/root")
    TF.register_lookups(ctx, calls)
    rows = spark.sql("SELECT * FROM search_symbol(TABLE(symbol_calls) PARTITION BY call_id ORDER BY (path, bfs_order)) "
                     "UNION ALL SELECT * FROM read_file(TABLE(file_calls) PARTITION BY call_id)").collect()
    pieces = sorted((r["call_id"], r["piece"], r["output"]) for r in rows)
    assert [(c, p, o.count("\n") + 1) for c, p, o in pieces if c == 3] == [(3, 0, 100), (3, 1, 100), (3, 2, 73)]
    from sourcelens.operators.loop import assemble_outputs

    whole = {}
    for c, _, o in pieces:
        whole[c] = o if c not in whole else whole[c] + "\n" + o
    sent = {r["call_id"]: r["output"] for r in assemble_outputs(L.dispatch(calls.where("call_id <> 6"), ctx), ("call_id",)).collect()}
    assert whole == sent


def nested_values(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 3 else 5)
    text = "".join(rnd.choice('ab"\\\\/ ,:{}[]\\n\\t\\x7fé😀\\u2028') for _ in range(rnd.randrange(7)))
    return [rnd.randrange(-999, 999), text, True, None, rnd.choice([0.5, -1.25, 3.75]),
            *([{k: nested_values(rnd, depth + 1) for k in sorted({text, "k", "é"})}, [nested_values(rnd, depth + 1) for _ in range(3)], {}]
              if depth < 3 else [])][kind]


def test_outputs_are_python_json(spark):
    """What is no string is written as ``json.dumps`` writes it, keys of a VARIANT in order."""
    import json
    import random

    rnd = random.Random(6)
    values = [nested_values(rnd) for _ in range(300)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string")
    got = {r["i"]: r["o"] for r in df.select("i", L.normalise_output(F.parse_json("j")).alias("o")).collect()}
    assert [got[i] for i in range(300)] == [v if isinstance(v, str) else json.dumps(v, sort_keys=True) for v in values]
    row = spark.sql("SELECT named_struct('z', 1, 'a', array('ü', null), 'm', map('k', true)) AS s, 7 AS n, CAST(NULL AS struct<x:int>) AS e")
    out = row.select(*(L.normalise_output(F.col(c), t).alias(c) for c, t in row.dtypes)).first()
    assert (out["s"], out["n"], out["e"]) == ('{"z": 1, "a": ["\\u00fc", null], "m": {"k": true}}', "7", "null")


def test_tools_may_answer_with_values(spark):
    files = spark.createDataFrame([("p", "a.py", "x\n")], "project string, path string, content string")
    r = L.default_registry()
    r.register(L.Tool("count", Ty.StructType.fromDDL("of string NOT NULL"), lambda ctx, calls: calls.select(
        "call_id", F.lit("ok").alias("status"), F.lit("").alias("chunk_key"),
        F.struct(L.arg("of").alias("of"), F.length(L.arg("of")).alias("n")).alias("output"))))
    calls = spark.createDataFrame([(1, "p", "count", '{"of":"naïve"}'), (2, "p", "read_file", '{"file_path":"a.py"}')],
                                  "call_id bigint, project string, name string, arguments string")
    out = {x["call_id"]: x["output"] for x in L.dispatch(calls, L.LookupContext(files, I.extract(files), "/root"), r).collect()}
    assert out == {1: '{"of": "na\\u00efve", "n": 5}', 2: "x\n"}


def test_bare_numbers_are_read_like_python_does(spark):
    import json

    texts = ['{"a":NaN}', '{"a": -Infinity }', '{"a":[Infinity,{"b":NaN}]}', '{"a":"NaN, \\\\"Infinity"}', '{"a":-NaN}', '{"a":xNaN}', "NaN",
             '{"a":Infinity', '{"a":1, "NaN":Infinity}', '{"a":nan}']
    df = L.classify_arguments(spark.createDataFrame(list(enumerate(texts)), "i int, arguments string"))
    got = {r["i"]: (r["arg_status"], r["a"], r["n"]) for r in
           df.select("i", "arg_status", L.arg("a").alias("a"), L.has_type("a", Ty.DoubleType()).alias("n")).collect()}
    for i, text in enumerate(texts):
        try:
            value = json.loads(text)
        except ValueError:
            assert got[i][0] == "invalid", text
            continue
        assert got[i][0] == ("object" if isinstance(value, dict) else "not_object"), text
        if isinstance(value, dict) and not isinstance(value["a"], list):
            assert got[i][1:] == (str(value["a"]), isinstance(value["a"], (int, float))), text
