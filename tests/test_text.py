"""X1/X4/X7/W1/X13 against Python's own string functions on random text."""

import posixpath
import random

from pyspark.sql import functions as F

from sourcelens.functions import text as T

ALPHABET = ["a", "b", " ", "\t", "\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f",
            "\x85", " ", " ", "\xa0", "　", "é", "x y"]


def _random_texts(n=300, seed=7):
    rnd = random.Random(seed)
    out = ["", "\n", "\r\n", "a", "a\n", "a\r", "a\r\nb", "\n\n", "\r\r\n", "x ", "  lead", "trail  "]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 12))))
    return out


def test_split_strip_summarise_match_python(spark):
    texts = _random_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i",
        T.split_lines_keepends("t").alias("ke"),
        T.split_lines("t").alias("ne"),
        T.py_strip("t").alias("st"),
        T.summarise("t", 8).alias("sm"),
        T.number_lines("t").alias("nl"),
        T.indent_of("t").alias("ind"),
    ).collect()
    for r in rows:
        t = texts[r["i"]]
        assert r["ke"] == t.splitlines(keepends=True), repr(t)
        assert r["ne"] == t.splitlines(), repr(t)
        assert r["st"] == t.strip(), repr(t)
        single = " ".join(t.split())
        assert r["sm"] == (single if len(single) <= 8 else single[:5] + "..."), repr(t)
        assert r["nl"] == "\n".join(f"{n} | {l}" for n, l in enumerate(t.splitlines(keepends=True), start=1))
        assert r["ind"] == t[: len(t) - len(t.lstrip())], repr(t)


def test_null_text_stays_null(spark):
    r = spark.sql("select cast(null as string) t").select(T.split_lines_keepends("t").alias("a")).first()
    assert r["a"] is None


def test_normalise_path_and_root(spark):
    cases = ["a/b", "a/../b", "../x", "/etc/p", "a/./b/../../c", "", ".", "a/../../..", "/project/x", "/project"]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    got = {r["p"]: r["n"] for r in df.select("p", T.within_root("p", "/project").alias("n")).collect()}
    for c in cases:
        joined = c if c.startswith("/") else "/project/" + c
        assert got[c] == posixpath.normpath(joined).replace("//", "/"), c


def test_truncate_and_final_newline(spark):
    df = spark.createDataFrame([("abcdef", 3), ("abc", 3), ("abcdef", 0), ("abcdef", None), ("abcdef", -2)],
                               "t string, n int")
    got = [r[0] for r in df.select(T.truncate_content("t", "n")).collect()]

    def model(t, n):
        if n and len(t) > n:
            return t[:n] + f"\n\n... truncated at {n} characters"
        return t

    assert got == [model("abcdef", 3), "abc", "abcdef", "abcdef", model("abcdef", -2)]
    df2 = spark.createDataFrame([("a\n", "b"), ("a", "b"), ("a\n", "b\n"), ("a\n", "")], "o string, u string")
    assert [r[0] for r in df2.select(T.keep_final_newline("o", "u")).collect()] == ["b\n", "b", "b\n", "\n"]


def test_module_key_digest(spark):
    import hashlib

    df = spark.createDataFrame([("pkg/__init__.py",), ("a/b/c.py",)], "p string")
    r = df.select(T.module_key("p").alias("k"), T.path_digest("p").alias("d")).collect()
    assert [x["k"] for x in r] == ["pkg.__init__", "a.b.c"]
    assert r[1]["d"] == hashlib.sha1(b"a/b/c.py").hexdigest()[:10]
