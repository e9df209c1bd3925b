"""Plan properties that matter at scale, read from ``explain()``."""

import contextlib
import io

from pyspark.sql import functions as F

from sourcelens.operators import annotate as A
from sourcelens.operators import index as I
from sourcelens.plans import catalog as C
from sourcelens.sources import tables as S

SF = "/root/testdata/sf0.001"


def plan_of(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_lookup_broadcasts_requests_and_prunes_index(spark):
    req = spark.createDataFrame([("shop", "parts/p_1.py", "make_1")], "project string, path string, name string")
    files, idx = C.code_index(spark, SF)
    plan = plan_of(I.get_definitions(req, idx, files))
    assert "BroadcastHashJoin LeftSemi" in plan
    # definitions are read per record type (partition pruning) and without their source text
    assert "(rec#" in plan and "= def)" in plan
    defs_scan = [b for b in plan.split("\n\n") if "PartitionFilters" in b and "= def)" in b and "lineno" in b]
    assert defs_scan and all("source" not in b.split("ReadSchema:")[1] for b in defs_scan)


def test_event_type_filter_reaches_the_scan(spark):
    plan = plan_of(C.QUERIES["first_text_delta"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def test_row_local_annotation_has_no_shuffle(spark):
    files = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("text").alias("content"))
    plan = plan_of(files.select(A.clean_col(F.col("content")).alias("c")), "simple")
    assert "Exchange" not in plan
    resp = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("text").alias("output_text"))
    assert "Exchange" not in plan_of(A.parse_response(resp), "simple")


def test_no_estimate_based_broadcast(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    files = S.doc_files(spark, SF).select("path", "content")
    other = S.doc_files(spark, SF).select("path", F.length("content").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(files.join(other, "path"), "simple")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def rows_scanned(df):
    """Rows that the scans of an executed plan without shuffles gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_lookup_by_name_reads_a_part_of_the_index(spark, monkeypatch):
    """Records lie in the order of their names: a few names skip most pages of the written index."""
    monkeypatch.setattr(I, "PAGE_ROWS", 200)
    _, idx = C.code_index(spark, SF)
    kept = I.ParseStore(idx.paths, idx.records).keep("by_name")
    total = kept.of("def").count() + kept.of("call").count()
    found = I.symbol_hits(kept).where(F.col("symbol").isin(["make_7", "make_150", "absent"]))
    plan = plan_of(found)
    assert "In(name, [" in plan
    assert 0 < rows_scanned(found) < total / 4
    assert found.count() == I.symbol_hits(idx).where("symbol in ('make_7', 'make_150', 'absent')").count() > 2
