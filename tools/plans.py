"""Write PLANS.md: physical plan trees of key queries (sf0.01), for plan review.

Usage: python tools/plans.py > PLANS.md
"""

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sourcelens.operators import index as I  # noqa: E402
from sourcelens.plans import catalog as C  # noqa: E402
from sourcelens.plans import joins  # noqa: E402
from sourcelens.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.01"


def tree(df, keep_details=("PushedFilters", "PartitionFilters", "ReadSchema")):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head, _, details = text.partition("\n\n\n")
    lines = [l for l in details.splitlines() if l.startswith(keep_details) or re.match(r"^\(\d+\) Scan", l)]
    return head.strip() + "\n\n" + "\n".join(lines)


def main():
    spark = local_session()
    out = ["# Physical plans of key queries (sf0.01, local)", "",
           "Generated by `tools/plans.py`. AQE re-plans at run time; these are the plans as submitted.", ""]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    saved = joins.BROADCAST_MAX_ROWS
    joins.BROADCAST_MAX_ROWS = 0
    out += ["## review_corpus as at scale (no side provably small: every join is a shuffle join)", "",
            "Consecutive joins on (`project`, `path`) share one hash partitioning: each input is shuffled once.", "",
            "```", tree(C.QUERIES["review_corpus"](spark, SF)), "```", ""]
    joins.BROADCAST_MAX_ROWS = saved
    files, idx = C.code_index(spark, SF)
    req = spark.createDataFrame([("shop", "parts/p_1.py", "make_1")], "project string, path string, name string")
    out += ["## get_definitions for a small request set", "",
            "Requests broadcast; the index read per record type (`PartitionFilters`) and without source text.", "",
            "```", tree(I.get_definitions(req, idx, files)), "```", ""]
    out += ["## first_text_delta", "", "The event-type filter reaches the parquet scan.", "",
            "```", tree(C.QUERIES["first_text_delta"](spark, SF)), "```", ""]
    out += ["## line_changes", "", "One aggregation with partial (map-side) sums.", "",
            "```", tree(C.QUERIES["line_changes"](spark, SF)), "```", ""]
    for name, note in (
        ("resolve_imports", "Modules meet the length of their content once; no text crosses a shuffle."),
        ("build_contexts", "Imported files and sizes join before the numbered text is built."),
        ("dispatch_tool_calls", "One join per tool; chunks of a symbol are built once."),
        ("compose_prompts", "The index is a written table; the skeleton joins once per project."),
        ("run_conversations", "The last step; each round before it was written and read again."),
    ):
        out += [f"## {name}", "", note, "", "```", tree(C.QUERIES[name](spark, SF)), "```", ""]
    print("\n".join(out))


if __name__ == "__main__":
    main()
