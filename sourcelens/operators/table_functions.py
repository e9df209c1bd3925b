"""Z1 in SQL: lookups as table functions over the rows of a call, with output streamed in pieces.

``register_lookups`` registers the functions and makes views of the calls with what they look
up, so a query reads::

    SELECT * FROM search_symbol(TABLE(symbol_calls) PARTITION BY call_id ORDER BY (path, bfs_order))
    SELECT * FROM read_file(TABLE(file_calls) PARTITION BY call_id)

A call's rows meet in one partition, in order, and its answer leaves in pieces of ``PIECE``
lines, so neither a hot symbol's results nor a large file is one row or held as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sourcelens.operators import index as I
from sourcelens.operators import lookup as L

PIECE = 100
OUTPUT = "call_id bigint, piece int, output string"


class SearchSymbol:
    """Rows (call_id, symbol, hit) of one call; ``hit`` null where the project has none."""

    def __init__(self):
        self.call, self.piece, self.lines = None, 0, []

    def eval(self, row: Row):
        self.call = row["call_id"]
        self.lines.append(row["hit"] if row["hit"] is not None else I.MSG_NOT_FOUND_IN_PROJECT.format(symbol=row["symbol"]))
        if len(self.lines) == PIECE:
            yield self._flush()

    def terminate(self):
        if self.lines:
            yield self._flush()

    def _flush(self):
        out = (self.call, self.piece, "\n".join(self.lines))
        self.piece, self.lines = self.piece + 1, []
        return out


class ReadFile:
    """One row (call_id, file_path, inside, content, max_chars) per call."""

    def eval(self, row: Row):
        if not row["inside"]:
            text = L.MSG_OUTSIDE_ROOT.format(path=row["file_path"])
        elif row["content"] is None:
            text = L.MSG_READ_ERROR.format(path=row["file_path"])
        else:
            text, most = row["content"], row["max_chars"]
            if most and len(text) > most:
                text = text[:most] + f"\n\n... truncated at {most} characters"
        lines = text.split("\n")
        for piece, at in enumerate(range(0, len(lines), PIECE)):
            yield row["call_id"], piece, "\n".join(lines[at:at + PIECE])


def register_lookups(ctx: L.LookupContext, calls: DataFrame) -> None:
    """Register ``search_symbol`` and ``read_file`` and the views ``symbol_calls`` and ``file_calls``.

    ``calls`` has call_id, project, name and arguments. Calls whose arguments are no object are
    left to ``lookup.dispatch``.
    """
    from sourcelens.plans.joins import join_dimension, join_small, small_side
    from sourcelens.session import ship_package, write_and_read

    spark = calls.sparkSession
    ship_package(spark)
    spark.udtf.register("search_symbol", F.udtf(SearchSymbol, returnType=OUTPUT))
    spark.udtf.register("read_file", F.udtf(ReadFile, returnType=OUTPUT))
    usable = L.classify_arguments(calls).where(F.col("arg_status") == "object")
    held, small = small_side(usable)
    usable = write_and_read(usable, "calls_decoded") if held is usable else held  # both lookups read them, decoded once
    small = small or None  # each lookup of a large round measures its own requests
    asked = usable.where(F.col("name") == "search_symbol").select("call_id", "project", L.arg("symbol").alias("symbol"))
    hits = I.search_symbols(asked.select("project", "symbol"), ctx.index, small=small)
    hits = hits.select("project", "symbol", "path", "bfs_order", F.when(F.col("kind") != "NONE", F.col("hit")).alias("hit"))
    found = join_small(hits, asked, ["project", "symbol"], known_small=True) if small else join_small(
        asked, hits, ["project", "symbol"])
    found.select(*hits.columns, "call_id").createOrReplaceTempView("symbol_calls")
    path = L.arg("file_path")
    _, inside, rel = L.resolve_path(path, ctx.root)
    reads = usable.where(F.col("name") == "read_file").select(
        "call_id", "project", path.alias("file_path"), inside.alias("inside"), rel.alias("rel"),
        L.int_arg("max_chars").alias("max_chars"))
    wanted = reads.where("inside").select("project", "rel").distinct()
    held = join_small(ctx.files.select("project", F.col("path").alias("rel"), "content"), wanted, ["project", "rel"],
                      "left_semi", known_small=small)
    found = reads.join(held, ["project", "rel"], "left") if small else join_dimension(
        reads, held, ["project", "rel"], "left", salt_by=["call_id"])
    found.createOrReplaceTempView("file_calls")
