"""Driver contract: entry() and queries() work from another directory in a plain session."""

import json
import subprocess
import sys
import tempfile
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = r"""
import importlib.util, json, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
qs, orc = m.queries(), m.oracle_sql()
res = {"n_queries": len(qs), "missing_oracles": sorted(set(qs) - set(orc)),
       "extra_oracles": sorted(set(orc) - set(qs))}
# queries first, without entry(): they must set up what they need themselves
res["inject_rows"] = qs["inject_reviews"](spark, "/root/testdata/sf0.001").count()
res["skeleton_rows"] = qs["skeleton"](spark, "/root/testdata/sf0.001").count()
res["diff_rows"] = qs["unified_diffs"](spark, "/root/testdata/sf0.001").count()
df = m.entry(spark)
rows = df.collect()
res["entry_rows"] = len(rows); res["entry_cols"] = df.columns
print("RESULT " + json.dumps(res))
"""


def test_entry_from_foreign_cwd():
    with tempfile.TemporaryDirectory() as d:
        p = subprocess.run([sys.executable, "-c", SCRIPT, str(REPO / "__spark_entry__.py")], cwd=d,
                           capture_output=True, text=True, timeout=600)
    line = [l for l in p.stdout.splitlines() if l.startswith("RESULT ")]
    assert line, p.stderr[-3000:]
    res = json.loads(line[0][7:])
    assert res["entry_rows"] == 200
    assert res["entry_cols"] == ["doc_id", "project", "path", "outcome", "message", "written", "final_content"]
    own = [n for n in res["missing_oracles"] if not (n == "pipeline" or n.startswith("op"))]
    assert own == [] and res["extra_oracles"] == []
    assert res["skeleton_rows"] == 1700 and res["diff_rows"] > 0
