"""Positions of regular-expression matches from built-in functions only.

``regexp_extract_all`` gives the matches and ``split`` the gaps between them; running totals of their
lengths are the positions. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Running totals are built in two levels of this width, so work stays near linear in the matches.
CHUNK = 64
SPAN = "array<struct<start:int,end:int,value:string,before:string,part:string>>"


def running_total(values: Column) -> Column:
    """Inclusive running totals of an array of integers."""
    empty = F.array().cast("array<int>")

    def totals(items: Column, start: Column) -> Column:
        return F.aggregate(
            items,
            F.struct(start.cast("int").alias("sum"), empty.alias("all")),
            lambda acc, x: F.struct(
                (acc["sum"] + x).cast("int").alias("sum"),
                F.concat(acc["all"], F.array((acc["sum"] + x).cast("int"))).alias("all"),
            ),
        )["all"]

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
        lambda c: F.slice(values, c * CHUNK + 1, F.lit(CHUNK)),
    )
    sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: (a + x).cast("int")))
    before = F.zip_with(totals(sums, F.lit(0)), sums, lambda total, own: (total - own).cast("int"))
    return F.when(F.size(values) == 0, empty).otherwise(F.flatten(F.zip_with(chunks, before, totals)))


def add_spans(df: DataFrame, name: str, text: str, pattern: str, wanted: Column, part: int | None = None,
              context: int = 32) -> DataFrame:
    """Add column ``name``: all leftmost non-overlapping matches of ``pattern`` in column ``text``.

    ``wanted`` is a cheap test that any text with a match passes; others skip the expression. ``before``
    holds up to ``context`` code points between the previous match and this one, ``part`` a group's text.
    """
    m, g, p, s = (f"__{name}_{x}" for x in ("match", "gap", "part", "start"))
    none = F.array().cast("array<string>")
    df = df.withColumns({
        m: F.when(wanted, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
    })
    found = F.size(m) > 0
    df = df.withColumns({
        g: F.when(found, F.split(text, pattern, -1)).otherwise(none),
        p: F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(part))).otherwise(none)
        if part is not None else none,
    })
    steps = F.transform(
        m, lambda x, i: (F.length(F.get(F.col(g), i))
                         + F.when(i > 0, F.length(F.get(F.col(m), i - 1))).otherwise(F.lit(0))).cast("int"))
    df = df.withColumn(s, running_total(steps))
    spans = F.transform(
        m, lambda x, i: F.struct(
            F.get(F.col(s), i).alias("start"), (F.get(F.col(s), i) + F.length(x)).cast("int").alias("end"),
            x.alias("value"), F.right(F.get(F.col(g), i), F.lit(context)).alias("before"),
            F.get(F.col(p), i).alias("part")))
    return df.withColumn(name, spans.cast(SPAN)).drop(m, g, p, s)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(",", F.transform(
        spans, lambda x: F.concat(x["kind"], F.lit(":"), x["start"].cast("string"), F.lit(":"),
                                  x["end"].cast("string"))))
