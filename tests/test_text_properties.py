"""Property test: Spark's line splitting, stripping and whitespace collapsing equal Python's."""

from hypothesis import given, settings
from hypothesis import strategies as st

from sourcelens.functions import text as T

CHARS = st.sampled_from(list("ab \t#:") + ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f",
                                            "\x85", " ", " ", "\xa0", "　", " ", "é", "REVIEW:"])
TEXTS = st.lists(st.lists(CHARS, max_size=15).map("".join), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(TEXTS)
def test_text_core_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i", T.split_lines_keepends("t").alias("ke"), T.split_lines("t").alias("ne"),
        T.py_strip("t").alias("st"), T.summarise("t", 10).alias("sm"),
    ).collect()
    for r in rows:
        t = texts[r["i"]]
        single = " ".join(t.split())
        assert r["ke"] == t.splitlines(keepends=True)
        assert r["ne"] == t.splitlines()
        assert r["st"] == t.strip()
        assert r["sm"] == (single if len(single) <= 10 else single[:7] + "...")
