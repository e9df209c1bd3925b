"""Read corpus tables and shape them into the engine's canonical schemas.

The adapters turn the driver's parquet tables into files / responses / requests /
decisions / tool calls / turns / turn events. All are narrow projections or
key joins; the only aggregation is lineitem per order for ``code_files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.functions import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_files_table(spark: SparkSession, path: str, project: str = "project", path_col: str = "path",
                     content: str = "content", fmt: str = "parquet") -> DataFrame:
    """S2 for any corpus table: project it onto ``files(project, path, content)``.

    Only the three columns are read (column pruning at the scan); filters a caller adds on
    ``project`` or ``path`` are pushed down to it.
    """
    df = spark.read.format(fmt).load(path)
    return df.select(F.col(project).alias("project"), F.col(path_col).alias("path"), F.col(content).alias("content"))


SOURCES = 20


def _doc_path():
    """A document's path within its project (its source): the same names in all of them."""
    i = F.col("doc_id")
    dealt = F.col("source") == F.concat(F.lit("src"), (i % SOURCES).cast("string"))
    return F.when(dealt, F.concat(F.lit("doc_"), F.expr(f"doc_id div {SOURCES}").cast("string"))).otherwise(
        F.concat(F.lit("doc_all_"), i.cast("string"))).alias("path")


def doc_files(spark: SparkSession, sf_dir: str, annotated: bool = False) -> DataFrame:
    """``files(project, path, content)`` from ``documents``.

    ``annotated`` adds the variants the annotation tests need: a terminal newline on
    every file, and an empty second line when ``doc_id % 6 = 0`` (blank-line targets).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    content = F.col("text")
    if annotated:
        content = F.concat(content, F.lit("\n"))
        content = F.when(
            F.col("doc_id") % 6 == 0, F.regexp_replace(content, r"^([^\n]*\n)[^\n]*", "$1")
        ).otherwise(content)
    return d.select(
        "doc_id",
        F.col("source").alias("project"),
        _doc_path(),
        content.alias("content"),
    )


def doc_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``responses(doc_id, project, path, output_text)``: recorded model answers, one per document.

    Rewrites hold the whole document below a new first line. A document without lines has no line to review, so
    its answer leaves those reviews out.
    """
    d = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.col("source").alias("project"),
        _doc_path(),
        T.split_lines_keepends("text").alias("dl"),
    )
    d = d.select(
        "doc_id", "lang", "project", "path", F.size("dl").alias("n"),
        F.concat(F.array(F.concat(F.lit("# doc "), F.col("doc_id").cast("string"))), F.transform("dl", T.drop_line_end))
        .alias("rewrite"),
    )
    low = (
        table(spark, sf_dir, "labels")
        .where(F.col("quality") == 0)
        .select("doc_id")
        .distinct()
        .withColumn("low_quality", F.lit(True))
    )
    from sourcelens.plans.joins import join_small

    d = join_small(d, low, ["doc_id"], "left")
    i, n = F.col("doc_id"), F.col("n")
    s = lambda c: c.cast("string")
    line = lambda times: s(1 + F.try_mod(F.try_mod(i, n) * times, n))
    parts = F.array(
        F.concat(F.lit("Findings for doc "), s(i)),
        F.concat(F.lit("REVIEW:"), line(1), F.lit(": check wording "), F.col("lang")),
        F.concat(F.lit("  REVIEW:"), line(7), F.lit(":  second look  ")),
        F.when(i % 3 == 0, F.concat(F.lit("REVIEW:"), line(1), F.lit(": again"))),
        F.when(i % 5 == 0, F.concat(F.lit("REVIEW:"), s(n + 10), F.lit(": past the end"))),
        F.when(i % 11 == 0, F.lit("REVIEW:99999999999999999999: too big")),
        F.when(i % 4 == 0, F.lit("REVIEW:1:")),
        F.when(F.col("low_quality"), F.lit("REVIEW:1: low quality")),
        F.when(
            (i % 7 == 0) & (i % 29 != 0),
            F.concat(F.lit("FILE_START\n"), F.array_join("rewrite", "\n"), F.lit("\nFILE_END")),
        ),
        F.when(i % 29 == 0, F.lit("FILE_END\nFILE_START")),
    )
    return d.select("doc_id", "project", "path", F.array_join(parts, "\n").alias("output_text"))


def doc_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests(doc_id, project, path, lines, message, dry_run, clean)``."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("project"),
        _doc_path(),
        F.size(T.split_lines_keepends("text")).alias("n"),
    )
    i = F.col("doc_id")
    lines = (
        F.when(i % 13 == 0, F.lit("x-3"))
        .when(i % 17 == 0, F.lit("9-2"))
        .when(i % 2 == 0, F.concat(F.lit("1-"), F.greatest(F.lit(1), F.floor(F.col("n") / 2)).cast("string")))
    )
    message = F.when(i % 30 == 0, F.lit("review this")).when((i % 10 == 0) | (i % 23 == 0), F.lit(None)).otherwise(
        F.lit("review this")
    )
    return d.select(
        "doc_id",
        "project",
        "path",
        lines.alias("lines"),
        message.cast("string").alias("message"),
        (i % 4 == 0).alias("dry_run"),
        (i % 10 == 0).alias("clean"),
    )


def doc_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``decisions(project, path, answer)``: ' Y ' / 'n' / no row."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("project"), _doc_path()
    )
    return d.where(F.col("doc_id") % 3 != 2).select(
        "project", "path", F.when(F.col("doc_id") % 3 == 0, F.lit(" Y ")).otherwise(F.lit("n")).alias("answer")
    )


CODE_PROJECT = "shop"


def _part_module(key: str = "p_partkey"):
    """Path and content of a part's module."""
    k = F.col(key).cast("string")
    return [
        F.concat(F.lit("parts/p_"), k, F.lit(".py")).alias("path"),
        F.concat(
            F.lit("class Part"), k, F.lit(":\n    def price(self):\n        return "),
            F.col("p_size").cast("string"),
            F.lit("\n\ndef make_"), k, F.lit("():\n    return Part"), k, F.lit("()\n"),
        ).alias("content"),
    ]


def _order_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(l_orderkey, path, content)`` of every order's module; rows stay where their key was joined."""
    items = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("items"))
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    o = orders.join(items, "l_orderkey", "left")
    pk = lambda it: it["l_partkey"].cast("string")
    imports = F.transform(
        F.coalesce("items", F.array()),
        lambda it: F.concat(F.lit("from parts.p_"), pk(it), F.lit(" import make_"), pk(it), F.lit("\n")),
    )
    calls = F.transform("items", lambda it: F.concat(F.lit("    make_"), pk(it), F.lit("()\n")))
    body = F.when(F.size(F.coalesce("items", F.array())) == 0, F.lit("    pass\n")).otherwise(F.array_join(calls, ""))
    return o.select(
        "l_orderkey",
        F.concat(F.lit("orders/o_"), F.col("l_orderkey").cast("string"), F.lit(".py")).alias("path"),
        F.concat(F.array_join(imports, ""), F.lit("\ndef run():\n"), body).alias("content"),
    )


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``files(project, path, content)``: synthetic Python modules from part and orders/lineitem."""
    shop = F.lit(CODE_PROJECT).alias("project")
    part_files = table(spark, sf_dir, "part").select(shop, *_part_module())
    return part_files.unionByName(_order_modules(spark, sf_dir).select(shop, "path", "content"))


def vendor(key: str = "o_custkey"):
    """The project an order belongs to: its customer's."""
    return F.concat(F.lit("vendor_"), F.col(key).cast("string"))


def vendored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``files(project, path, content)`` of many projects: each holds its orders' modules and copies of the
    modules of all parts that these import, so most contents are held by many projects.

    Orders and parts are joined by their keys, before a part's text is written, so no text is shuffled.
    """
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    own = _order_modules(spark, sf_dir).join(orders, "l_orderkey").select(vendor().alias("project"), "path", "content")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    held = orders.join(items, "l_orderkey").select("o_custkey", F.col("l_partkey").alias("p_partkey")).distinct()
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    copies = held.join(part, "p_partkey").select(vendor().alias("project"), *_part_module())
    return own.unionByName(copies)


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tool_calls(call_id, conv_id, name, arguments)`` from ``events``."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    k = F.get_json_object("props", "$.k")
    i = F.col("event_id")
    t = F.col("event_type")
    name = (
        F.when(t.isin("view", "error"), F.lit("read_file"))
        .when(t == "click", F.lit("get_function"))
        .when(t == "purchase", F.lit("search_symbol"))
        .when(t == "signup", F.lit("list_dir"))
    )
    # Limits as a model may write them; only whole numbers and booleans count, of equal keys the last.
    limits = F.lit("")
    for rest, text in {1: "40", 2: "true", 3: '"3"', 4: '9,"max_chars":25', 5: "-4", 6: "2.5", 8: "null"}.items():
        limits = F.when(i % 11 == rest, F.lit(f',"max_chars":{text}')).otherwise(limits)
    args = (
        F.when(i % 10 == 0, F.lit("[1]"))
        .when(
            t == "view",
            F.when(i % 7 == 0, F.concat(F.lit('{"file_path":"../p_'), k, F.lit('.py"}'))).otherwise(
                F.concat(F.lit('{"file_path":"parts/p_'), k, F.lit('.py"'), limits, F.lit("}"))
            ),
        )
        .when(
            t == "click",
            F.concat(
                F.lit('{"file_path":"parts/p_'), k, F.lit('.py","name":"make_'),
                (k.cast("bigint") + i % 2).cast("string"), F.lit('"}'),
            ),
        )
        .when(
            t == "purchase",
            F.when(i % 5 == 0, F.concat(F.lit('{"symbol":"nothing_'), k, F.lit('"}'))).otherwise(
                F.concat(F.lit('{"symbol":"make_'), k, F.lit('"}'))
            ),
        )
        .when(t == "signup", F.lit("{}"))
        .otherwise(F.expr("substring(props, 1, length(props) - 1)"))
    )
    return e.select(
        i.alias("call_id"), F.col("user_id").alias("conv_id"), name.alias("name"), args.alias("arguments")
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``turns(conv_id, turn, output_text, has_tool_call)``; turns are 1-based."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return c.select(
        "conv_id",
        (F.col("turn") + 1).alias("turn"),
        F.col("text").alias("output_text"),
        (F.length("text") % 3 != 0).alias("has_tool_call"),
    )


EVENT_TYPES = {
    # event_type -> model stream event type.
    "signup": "response.created",
    "error": "response.in_progress",
    "purchase": "response.output_item.added",
    "click": "response.function_call_arguments.done",
    "view": "response.output_text.delta",
}


# Every ninth text event is the end of its turn instead.
COMPLETED = "response.completed"


def turn_events_of(events: DataFrame) -> DataFrame:
    """``turn_events(response_id, turn, seq, type, payload, ts)``; payloads are the event's JSON item."""
    t, i = F.col("event_type"), F.col("event_id")
    k = F.get_json_object("props", "$.k")
    typ = F.lit(None).cast("string")
    for src, dst in EVENT_TYPES.items():
        typ = F.when(t == src, F.lit(dst)).otherwise(typ)
    typ = F.when((t == "view") & (i % 9 == 0), F.lit(COMPLETED)).otherwise(typ)
    payload = (
        F.when((t == "purchase") & (i % 2 == 0), F.to_json(F.struct(
            F.lit("function_call").alias("type"), F.concat(F.lit("search_"), k).alias("name"))))
        .when(t == "purchase", F.lit('{"type":"message"}'))
        .when(t == "click", F.to_json(F.struct(F.concat(F.lit("lookup_"), k).alias("name"), F.col("props").alias("arguments"))))
        .otherwise(F.col("props"))
    )
    return events.select(
        F.col("user_id").alias("response_id"),
        (1 + i % 8).alias("turn"),
        i.alias("seq"),
        typ.alias("type"),
        payload.alias("payload"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def turn_events(spark: SparkSession, sf_dir: str, types: list[str] | None = None) -> DataFrame:
    """Turn events from ``events``.

    ``types`` filters on the source column before the mapping, so the predicate reaches
    the parquet scan instead of running on a derived column.
    """
    events = table(spark, sf_dir, "events")
    if types is not None:
        source = [k for k, v in EVENT_TYPES.items() if v in types or (k == "view" and COMPLETED in types)]
        events = events.where(F.col("event_type").isin(source))
    found = turn_events_of(events)
    return found if types is None else found.where(F.col("type").isin(types))
