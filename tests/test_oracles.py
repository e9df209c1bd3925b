"""Every registered query against its DuckDB oracle on the smallest tables."""

SF = "/root/testdata/sf0.001"


def test_all_queries_match_their_oracles(spark):
    import __spark_entry__ as E
    from tests.oracle_check import compare

    own = [n for n in E.queries() if not (n == "pipeline" or n.startswith("op"))]
    rep = compare(spark, SF, own)
    bad = {k: v for k, v in rep.items() if v["status"] == "MISMATCH"}
    assert not bad, bad
    assert set(rep) == set(own)
    assert [k for k, v in rep.items() if v["status"] == "rows-only"] == []
    assert {k: v["type_diffs"] for k, v in rep.items() if v.get("type_diffs")} == {}
