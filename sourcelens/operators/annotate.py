"""Model-response parsing and review annotation, done in-row with higher-order functions.

A response or a file is one row; its lines are an ARRAY column. Parsing, grouping
per line, injection and cleaning are array transforms inside the row, so none of
them shuffles: the only shuffle on this path is the join of responses to files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcelens.functions import text as T

REVIEW_STRUCT = "struct<seq:int,line_key:string,lineno:bigint,comment:string>"


def parse_reviews_col(lines: Column) -> Column:
    """F4 + X5: review lines of a response (lines without ends) in order of appearance.

    Returns ARRAY<STRUCT<seq, line_key, lineno, comment>>; ``line_key`` is the
    integer's canonical digits (exact even past BIGINT), ``lineno`` is NULL on overflow.
    """
    stripped = F.transform(lines, lambda l, i: F.struct((i + 1).alias("seq"), T.py_strip(l).alias("s")))
    matched = F.filter(stripped, lambda x: x["s"].rlike(T.REVIEW_RE))

    def to_review(x):
        digits = F.regexp_extract(x["s"], T.REVIEW_RE, 1)
        return F.struct(
            x["seq"].alias("seq"),
            T.line_key(digits).alias("line_key"),
            digits.try_cast("bigint").alias("lineno"),
            T.py_strip(F.regexp_extract(x["s"], T.REVIEW_RE, 2)).alias("comment"),
        )

    return F.transform(matched, to_review)


def group_reviews_col(reviews: Column) -> Column:
    """A2: one entry per distinct line (first-appearance order), comments in input order.

    One sort brings equal lines together; a group is the slice between two places where the
    line changes, so the cost is that of the sort, whatever the number of groups.
    """

    def groups(r):
        starts = F.filter(F.transform(r, lambda x, i: F.when(
            (i == 0) | (x["line_key"] != F.get(r, i - 1)["line_key"]), i)), lambda i: i.isNotNull())

        def group(s):
            def one(start, k):
                end = F.coalesce(F.get(s, k + 1), F.size(r))
                first = F.get(r, start)
                return F.struct(
                    first["seq"].alias("first_seq"), first["line_key"].alias("line_key"), first["lineno"].alias("lineno"),
                    F.transform(F.slice(r, start + 1, end - start), lambda x: x["comment"]).alias("comments"))

            return F.transform(s, one)

        return F.array_sort(T.let(starts, group))

    by_line = F.array_sort(F.transform(reviews, lambda r: F.struct(
        r["line_key"].alias("line_key"), r["seq"].alias("seq"), r["lineno"].alias("lineno"), r["comment"].alias("comment"))))
    return T.let(by_line, groups)


def parse_response(df: DataFrame, text_col: str = "output_text") -> DataFrame:
    """Adds ``mode`` (review/rewrite/invalid), ``rewritten_source``, ``reviews``, ``grouped``.

    Markers are lines exactly equal to FILE_START / FILE_END, first occurrence each;
    reviews are only read in review mode; an empty rewrite body is '' (not NULL).
    """
    out = df.withColumn("_rl", T.split_lines(text_col))
    rl = F.col("_rl")
    out = out.withColumn("_start", F.array_position(rl, T.FILE_START)).withColumn(
        "_end", F.array_position(rl, T.FILE_END)
    )
    start, end = F.col("_start"), F.col("_end")
    mode = F.when((start == 0) | (end == 0), F.lit("review")).when(start >= end, F.lit("invalid")).otherwise(
        F.lit("rewrite")
    )
    out = out.withColumn("mode", mode)
    rewritten = F.when(
        F.col("mode") == "rewrite",
        F.array_join(F.slice(rl, start + 1, F.greatest(end - start - 1, F.lit(0))), "\n"),
    )
    reviews = F.when(F.col("mode") == "review", parse_reviews_col(rl)).otherwise(
        F.array().cast(f"array<{REVIEW_STRUCT}>")
    )
    out = out.withColumn("rewritten_source", rewritten).withColumn("reviews", reviews)
    return out.withColumn("grouped", group_reviews_col(F.col("reviews"))).drop("_rl", "_start", "_end")


def inject_col(content: Column, grouped: Column) -> Column:
    """Comment lines above each target with the target's indent, input order kept.

    Out-of-file lines are skipped. A blank target's indent includes its newline, so an
    extra blank line appears (the reference behaviour, kept on purpose).
    """
    return inject_lines(T.split_lines_keepends(content), grouped)


def lines_in_file(grouped: Column, n_lines: Column) -> Column:
    """the groups that land in the file (lines 1..n), by line."""
    inside = F.filter(grouped, lambda g: g["lineno"].between(F.lit(1), n_lines))
    return F.array_sort(F.transform(inside, lambda g: F.struct(
        g["lineno"].cast("int").alias("lineno"), g["comments"].alias("comments"))))


def inject_lines(lines: Column, grouped: Column) -> Column:
    """J3 on an already split ARRAY of lines (with ends).

    The text is put together from the runs of lines between two targets, each followed by the
    comments of the next target: every line is copied once, and no line looks anything up.
    """

    def build(ls):
        def join(targets):
            def run(j):
                start = F.coalesce(F.get(targets, j - 1)["lineno"], F.lit(1))
                here = F.get(targets, j)
                end = F.coalesce(here["lineno"], F.size(ls) + 1)
                indent = T.indent_of(F.get(ls, here["lineno"] - 1))
                comments = F.array_join(F.transform(
                    here["comments"], lambda c: F.concat(indent, F.lit(T.REVIEW_PREFIX + " "), c, F.lit("\n"))), "")
                return F.concat(F.array_join(F.slice(ls, start, end - start), ""), F.coalesce(comments, F.lit("")))

            return F.array_join(F.transform(F.sequence(F.lit(0), F.size(targets)), run), "")

        return F.coalesce(T.let(lines_in_file(grouped, F.size(ls)), join), F.array_join(ls, ""))

    return T.let(lines, build)


def injected_count_col(grouped: Column, n_lines: Column) -> Column:
    """Comments that land in the file (F7): lines 1..n."""
    inside = F.filter(grouped, lambda g: g["lineno"].between(F.lit(1), n_lines))
    return F.aggregate(inside, F.lit(0).cast("bigint"), lambda a, g: a + F.size(g["comments"]))


def clean_col(content: Column) -> Column:
    """A4 + F5: text without whole-line ``# REVIEW:`` comments (struct: cleaned, removed)."""
    lines = T.split_lines_keepends(content)
    # strip().startswith(prefix) <=> the prefix follows the leading whitespace
    kept = F.filter(lines, lambda l: ~l.rlike(T.COMMENT_LINE_RE))
    return F.struct(
        F.array_join(kept, "").alias("cleaned"),
        (F.size(lines) - F.size(kept)).cast("bigint").alias("removed"),
    )


def attach_responses(files: DataFrame, responses: DataFrame, materialize: bool = True) -> DataFrame:
    """Join parsed responses to their files on (project, path), the one shuffle of this path.

    Responses are narrowed to their parsed columns before the join so the raw model
    text never crosses the shuffle. ``materialize=False`` keeps the size check from writing
    them (for streams, whose batches would each leave a checkpoint behind).
    """
    from sourcelens.plans.joins import join_small, small_side

    parsed = parse_response(responses).select("project", "path", "mode", "rewritten_source", "reviews", "grouped")
    # Broadcast the parsed side when a bounded check proves it small; otherwise one
    # shuffle join on both (files move once).
    parsed, small = small_side(parsed, materialize=materialize)
    return join_small(files, parsed, ["project", "path"], "inner", known_small=small)


def apply_results(df: DataFrame) -> DataFrame:
    """Per target: updated text, counts, changed flag (review inject or rewrite, C1 core)."""
    df = df.withColumn("_lines", T.split_lines_keepends("content"))
    n_lines = F.size("_lines")
    updated = (
        F.when(F.col("mode") == "review", inject_lines(F.col("_lines"), F.col("grouped")))
        .when(F.col("mode") == "rewrite", T.keep_final_newline(F.col("content"), F.col("rewritten_source")))
        .otherwise(F.col("content"))
    )
    return (
        df.withColumn("n_lines", n_lines.cast("bigint"))
        .withColumn("updated", updated)
        .drop("_lines")
        .withColumn("added", F.size("reviews").cast("bigint"))
        .withColumn("injected", injected_count_col(F.col("grouped"), F.col("n_lines")))
        .withColumn("changed", ~F.col("updated").eqNullSafe(F.col("content")))
    )
