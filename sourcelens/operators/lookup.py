"""Tool lookups answered in bulk: argument decoding (X14), path checks (F1), and the
dispatch of a whole round of calls as joins against the file table and the index (J5).

A registry (Z1) maps a tool name to a DataFrame function and an argument schema (Z3).
Every call yields output, errors included, as in the reference's dispatcher.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from sourcelens.functions import text as T
from sourcelens.operators import index as I

OUTPUT_COLS = ["call_id", "status", "chunk_key", "output"]

# Texts of tool results and dispatch errors ({...} are filled per row).
MSG_OUTSIDE_ROOT = "Error: '{path}' is outside the project root"
MSG_READ_ERROR = "Error reading '{path}': file not found"
MSG_INVALID_JSON = "Error: invalid JSON arguments for tool '{name}'"
MSG_NOT_OBJECT = "Error running tool '{name}': Tool arguments must decode to a JSON object"
MSG_UNKNOWN_TOOL = "Error running tool '{name}': Tool \"{name}\" not found in registry"


# JSON text as strings and what stands between them.
_JSON_PIECES = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]++|"'
# The numbers beyond JSON that Python's decoder reads, and how Python shows them.
_BARE_NUMBERS = {"NaN": "nan", "Infinity": "inf", "-Infinity": "-inf"}
# Marks such a number among the strings of decoded arguments.
_BARE = "\0number:"


def _outside_strings(text: Column, change: Callable[[Column], Column], inside: Callable[[Column], Column] = lambda x: x) -> Column:
    """JSON text with ``change`` applied between its strings, and ``inside`` to these."""
    pieces = F.regexp_extract_all(text, F.lit(_JSON_PIECES), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.when(x.startswith('"'), inside(x)).otherwise(change(x))), "")


def _with_bare_numbers(text: Column) -> Column:
    """Bare ``NaN``, ``Infinity`` and ``-Infinity`` as marked strings, which VARIANT can hold."""
    return F.when(text.rlike("NaN|Infinity"), _outside_strings(text, lambda x: F.regexp_replace(
        x, r"(?<![\w.-])(NaN|-?Infinity)(?![\w.-])", r'"\\u0000number:$1"'))).otherwise(text)


def classify_arguments(calls: DataFrame, col: str = "arguments") -> DataFrame:
    """Adds ``args`` (VARIANT) and ``arg_status`` in invalid / not_object / object.

    Needs ``spark.sql.variant.allowDuplicateKeys=true`` (set by the job config) so that a
    repeated key keeps its last value, as Python's decoder does, instead of failing. Like that
    decoder it reads bare ``NaN`` and ``Infinity`` as numbers.
    """
    v = F.try_parse_json(_with_bare_numbers(F.col(col)))
    status = (
        F.when(v.isNull(), F.lit("invalid"))
        .when(F.schema_of_variant(v).startswith("OBJECT"), F.lit("object"))
        .otherwise(F.lit("not_object"))
    )
    return calls.withColumn("args", v).withColumn("arg_status", status)


def arg(name: str, default: str | None = "") -> Column:
    """An argument as Python's ``str()`` shows it (JSON null is ``None``, true is ``True``); a
    missing key becomes ``default`` (the reference uses '')."""
    raw = F.try_variant_get(F.col("args"), f"$.{name}", "variant")
    text = F.try_variant_get(F.col("args"), f"$.{name}", "string")
    shown = F.when(F.is_variant_null(raw), F.lit("None")).when(
        F.schema_of_variant(raw) == "BOOLEAN", F.initcap(text))
    for written, as_python in _BARE_NUMBERS.items():
        shown = shown.when(text == _BARE + written, F.lit(as_python))
    shown = shown.otherwise(text)
    return shown if default is None else F.when(raw.isNull(), F.lit(default)).otherwise(shown)


def int_arg(name: str, col: str = "arguments") -> Column:
    """An argument that Python would take as an ``int``: a JSON whole number, or a boolean as 0 or 1; else NULL.

    VARIANT reads ``3.0`` as ``3``, so whether a number is written as a whole one is read from
    the text; of equal keys the last one counts there too.
    """
    raw = F.try_variant_get(F.col("args"), f"$.{name}", "variant")
    kind = F.schema_of_variant(raw)
    written = T.let(F.filter(F.map_entries(F.from_json(F.col(col), "map<string,string>")), lambda e: e["key"] == name),
                    lambda found: F.get(found, F.size(found) - 1)["value"])
    return F.when(kind == "BOOLEAN", F.try_variant_get(raw, "$", "boolean").cast("bigint")).when(
        (kind != "STRING") & written.rlike(r"^-?[0-9]+$"), written.try_cast("bigint"))


# What a parameter's Spark type is called in JSON, and the types that a decoded value of that kind has.
JSON_TYPES = {
    Ty.StringType: ("string", r"^STRING$"),
    Ty.LongType: ("integer", r"^BIGINT$"),
    Ty.DoubleType: ("number", r"^(BIGINT|DOUBLE|DECIMAL\(.*\))$"),
    Ty.BooleanType: ("boolean", r"^BOOLEAN$"),
    Ty.MapType: ("object", r"^OBJECT"),
    Ty.StructType: ("object", r"^OBJECT"),
    Ty.ArrayType: ("array", r"^ARRAY"),
}


def has_type(name: str, declared: Ty.DataType) -> Column:
    """Z3: whether an argument's JSON value is of the declared type."""
    raw = F.try_variant_get(F.col("args"), f"$.{name}", "variant")
    bare = F.coalesce(F.try_variant_get(raw, "$", "string").startswith(_BARE), F.lit(False))
    kind = F.when(bare, "DOUBLE").otherwise(F.schema_of_variant(raw))
    return F.coalesce(kind.rlike(JSON_TYPES[type(declared)][1]), F.lit(False))


def _ascii(text: Column) -> Column:
    """A JSON string with everything beyond printable ASCII as escapes of its UTF-16 units."""

    def escaped(c):
        units = F.lower(F.hex(F.encode(c, "UTF-16BE")))
        return F.concat(F.lit("\\u"), F.substring(units, 1, 4),
                        F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.substring(units, 5, 4))).otherwise(F.lit("")))

    each = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.when(c.rlike("^[ -~]$"), c).otherwise(escaped(c)))
    return F.when(text.rlike("[^ -~]"), F.array_join(each, "")).otherwise(text)


def python_json(text: Column) -> Column:
    """Compact JSON text as Python's encoder writes it: spaces behind ``,`` and ``:``, ASCII only.

    Keys keep their order. Numbers keep their text (Java writes ``1.0E10`` for ``10000000000.0``).
    """
    return _outside_strings(text, lambda x: F.regexp_replace(x, "([,:])", "$1 "), _ascii)


def normalise_output(value: Column, kind: str = "variant") -> Column:
    """Strings pass through, anything else becomes JSON text as Python writes it.

    ``kind`` is the column's type. VARIANT holds its keys in order of their names, a struct in the
    order of its fields.
    """
    if kind == "string":
        return value
    if kind == "variant":
        return F.when(F.schema_of_variant(value) == "STRING", F.variant_get(value, "$", "string")).otherwise(
            python_json(F.to_json(value)))
    nested = kind.startswith(("struct", "map", "array"))
    return F.coalesce(python_json(F.to_json(value, {"ignoreNullFields": "false"})) if nested else value.cast("string"), F.lit("null"))


def resolve_path(path: Column, root: str) -> tuple[Column, Column, Column]:
    """F1 + X13: (normalised absolute path, inside-root flag, path relative to root)."""
    root = root.rstrip("/") or "/"
    prefix = root + "/" if root != "/" else "/"
    found = T.let(T.within_root(path, root), lambda norm: F.struct(
        norm.alias("norm"), ((norm == F.lit(root)) | norm.startswith(prefix)).alias("inside"),
        F.when(norm == F.lit(root), F.lit("")).otherwise(F.substring(norm, len(prefix) + 1, 1 << 30)).alias("rel")))
    return found["norm"], found["inside"], found["rel"]


def outside_message(path: Column) -> Column:
    return T.fill(MSG_OUTSIDE_ROOT, path=path)


@dataclass
class Tool:
    """Z1 + Z3: a lookup and its arguments as a Spark schema: NOT NULL fields are required, ``choices`` limits values."""

    name: str
    arguments: Ty.StructType
    run: Callable[["LookupContext", DataFrame], DataFrame]
    choices: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        odd = [f.name for f in self.arguments if type(f.dataType) not in JSON_TYPES]
        if odd or set(self.choices) - set(self.arguments.names):
            raise ValueError(f"{self.name}: {odd or sorted(self.choices)} cannot be arguments")


@dataclass
class LookupContext:
    files: DataFrame  # project, path, content
    index: I.ParseStore
    root: str = "/project"
    # set per round by dispatch: True where all request sides are bounded by it; else each lookup measures its own
    small_requests: bool | None = None


@dataclass
class Registry:
    """Name -> tool; a later registration of a name replaces the earlier one."""

    tools: dict[str, Tool] = field(default_factory=dict)

    def register(self, tool: Tool) -> None:
        self.tools[tool.name] = tool

    def names(self) -> list[str]:
        return list(self.tools)


def _read_file(ctx: LookupContext, calls: DataFrame) -> DataFrame:
    """Path check, then a left join to the file table."""
    p = arg("file_path")
    _, inside, rel = resolve_path(p, ctx.root)
    c = calls.select("call_id", "project", p.alias("file_path"), inside.alias("inside"), rel.alias("rel"),
                     int_arg("max_chars").alias("max_chars"))
    from sourcelens.plans.joins import join_dimension, join_small

    # The file table is the large side: filter it by the requested paths where it is read.
    wanted = c.where("inside").select("project", "rel").distinct()
    files = join_small(ctx.files.select("project", F.col("path").alias("rel"), "content"), wanted,
                       ["project", "rel"], "left_semi", known_small=ctx.small_requests)
    # many calls may read one file: it goes out to them, by broadcast where the files read are proven small
    j = c.join(files, ["project", "rel"], "left") if ctx.small_requests else join_dimension(
        c, files, ["project", "rel"], "left", salt_by=["call_id"])
    output = (
        F.when(~F.col("inside"), outside_message(F.col("file_path")))
        .when(F.col("content").isNotNull(), T.truncate_content(F.col("content"), F.col("max_chars")))
        .otherwise(T.fill(MSG_READ_ERROR, path="file_path"))
    )
    status = F.when(F.col("inside") & F.col("content").isNotNull(), "ok").otherwise("tool_error")
    return j.select("call_id", status.alias("status"), F.lit("").alias("chunk_key"), output.alias("output"))


def _get_function(ctx: LookupContext, calls: DataFrame) -> DataFrame:
    """J7 through the index: first definition in walk order, or the miss message."""
    p = arg("file_path")
    _, inside, rel = resolve_path(p, ctx.root)
    c = calls.select("call_id", "project", p.alias("file_path"), inside.alias("inside"), rel.alias("rel"),
                     arg("name").alias("name"))
    from sourcelens.plans.joins import join_small

    ok = c.where("inside")
    defs = I.get_definitions(ok.select("project", F.col("rel").alias("path"), "name"), ctx.index, ctx.files,
                             small=ctx.small_requests)
    # one answer per distinct request: at most as many rows as the round's calls
    # the answers carry source text: broadcast only after their own size was measured
    found = join_small(ok, defs.withColumnRenamed("path", "rel").withColumnRenamed("status", "found_as"),
                       ["project", "rel", "name"], "left").select(
        "call_id",
        F.when(F.col("found_as").isin("ok", "not_found"), "ok").otherwise("tool_error").alias("status"),
        F.lit("").alias("chunk_key"),
        # messages name the path as the caller wrote it
        F.when(F.col("found_as") == "ok", F.col("output"))
        .when(F.col("found_as") == "not_found", T.fill(I.MSG_NOT_FOUND_IN_FILE, name="name", path="file_path"))
        .otherwise(T.fill(I.MSG_PARSE_ERROR, path="file_path", error=F.coalesce("error", F.lit("file not found"))))
        .alias("output"),
    )
    outside = c.where(~F.col("inside")).select(
        "call_id", F.lit("tool_error").alias("status"), F.lit("").alias("chunk_key"),
        outside_message(F.col("file_path")).alias("output"),
    )
    return found.unionByName(outside)


def _search_symbol(ctx: LookupContext, calls: DataFrame) -> DataFrame:
    """J2 per call: hits are grouped per (call, file) into one text chunk each.

    A call's full answer is its chunks in ``chunk_key`` (path) order joined by newlines;
    no single row ever holds more than one file's hits.
    """
    c = calls.select("call_id", "project", arg("symbol").alias("symbol"))
    from sourcelens.plans.joins import join_small

    hits = I.search_symbols(c.select("project", "symbol"), ctx.index, small=ctx.small_requests)
    # one file's chunk for a symbol is built once, however many calls ask for the symbol
    chunks = hits.groupBy("project", "symbol", "path").agg(
        F.array_sort(F.collect_list(F.struct("bfs_order", "hit"))).alias("h")
    ).select("project", "symbol", F.coalesce(F.col("path"), F.lit("")).alias("chunk_key"),
             F.array_join(F.col("h.hit"), "\n").alias("output"))
    # calls of a round are the bounded side: a hot symbol never becomes a shuffle key; of a large round the chunks may be
    j = join_small(chunks, c, ["project", "symbol"], known_small=True) if ctx.small_requests else join_small(
        c, chunks, ["project", "symbol"])
    return j.select("call_id", F.lit("ok").alias("status"), "chunk_key", "output")


def default_registry() -> Registry:
    r = Registry()
    for name, arguments, lookup in (
        ("read_file", "file_path string NOT NULL, max_chars bigint", _read_file),
        ("get_function", "file_path string NOT NULL, name string NOT NULL", _get_function),
        ("search_symbol", "symbol string NOT NULL", _search_symbol),
    ):
        r.register(Tool(name, Ty.StructType.fromDDL(arguments), lookup))
    return r


def dispatch(calls: DataFrame, ctx: LookupContext, registry: Registry | None = None) -> DataFrame:
    """Every call of a round -> output rows ``(call_id, name, status, chunk_key, output)``.

    Decode errors, non-object arguments and unknown tools become error outputs (in that
    order of checks); registered tools run as one join per tool over all their calls.
    """
    from dataclasses import replace

    from sourcelens.plans.joins import small_side
    from sourcelens.session import write_and_read

    registry = registry or default_registry()
    c = classify_arguments(calls)
    if "project" not in c.columns:
        c = c.withColumn("project", F.lit(None).cast("string"))
    # One bounded count per round: every per-tool request side is a subset of these calls.
    held, small = small_side(c)
    # materialised: every tool branch reads the same round of calls, decoded once
    c = write_and_read(c, "round_decoded") if held is c else held
    ctx = replace(ctx, small_requests=small or None)
    known = F.col("name").isin(registry.names())
    err = (
        F.when(F.col("arg_status") == "invalid",
               T.fill(MSG_INVALID_JSON, name="name"))
        .when(F.col("arg_status") == "not_object",
              T.fill(MSG_NOT_OBJECT, name="name"))
        .when(~known, T.fill(MSG_UNKNOWN_TOOL, name="name"))
    )
    status = (
        F.when(F.col("arg_status") == "invalid", "invalid_json")
        .when(F.col("arg_status") == "not_object", "not_object")
        .when(~known, "unknown_tool")
    )
    c = c.withColumn("err", err).withColumn("err_status", status)
    outs = [c.where(F.col("err").isNotNull()).select(
        "call_id", "name", F.col("err_status").alias("status"), F.lit("").alias("chunk_key"),
        F.col("err").alias("output"),
    )]
    ok = c.where(F.col("err").isNull())
    # tools that this round does not ask for cost nothing; at most the registry's names come back
    asked = {r["name"] for r in ok.select("name").distinct().collect()}
    for name, tool in registry.tools.items():
        if name not in asked:
            continue
        out = tool.run(ctx, ok.where(F.col("name") == name)).select(*OUTPUT_COLS)
        out = out.withColumn("output", normalise_output(F.col("output"), dict(out.dtypes)["output"]))
        outs.append(out.withColumn("name", F.lit(name)))
    result = outs[0]
    for o in outs[1:]:
        result = result.unionByName(o)
    return result.select("call_id", "name", *OUTPUT_COLS[1:])


def argument_violations(calls: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Z3 checks as data: missing required parameters, wrong types and enum misses per call.

    The reference declares these schemas but never enforces them; this reports them.
    """
    registry = registry or default_registry()
    c = classify_arguments(calls).where(F.col("arg_status") == "object")
    problems = F.lit(None).cast("array<string>")
    for tool in registry.tools.values():
        checks = []
        for f in tool.arguments:
            v = arg(f.name, default=None)
            if not f.nullable:
                checks.append(F.when(v.isNull(), F.lit(f"missing {f.name}")))
            kind = JSON_TYPES[type(f.dataType)][0]
            checks.append(F.when(v.isNotNull() & ~has_type(f.name, f.dataType), F.lit(f"{f.name} is not of type {kind}")))
            if f.name in tool.choices:
                checks.append(F.when(v.isNotNull() & ~v.isin(tool.choices[f.name]), F.lit(f"{f.name} not in enum")))
        arr = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
        problems = F.when(F.col("name") == tool.name, arr).otherwise(problems)
    return c.select("call_id", "name", problems.alias("problems")).where(F.size("problems") > 0)
