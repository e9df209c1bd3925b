"""Chat formatting by schema fingerprints, in built-in functions only.

Records are JSON in any of several layouts. The nested field paths of each record (its shape without the
scalar types) are hashed; the hash selects a declared mapping that yields canonical turns. A template marks
the turns, breaks control strings inside texts with a reversible escape, and records which pieces carry loss.

Nulls: a null text or role is empty; a null, malformed or unmapped record keeps its row, with no turns and a
null ``layout``. Repeated records are formatted row by row. An empty table gives an empty table. Other
columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native_spans import running_total

TURNS = "array<struct<role:string,text:string>>"

# The template's own marks, then control strings of common templates that texts must not hold.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (
    START, MIDDLE, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|start_header_id|>",
    "<|end_header_id|>", "<|eot_id|>", "<|begin_of_text|>", "<|end_of_text|>", "<s>", "</s>", "[INST]", "[/INST]",
    "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>",
)
#: Control strings all begin with one of these; a backslash after the first character breaks them.
OPENERS = r"(<)(\||s>|/s>|<SYS|</SYS|start_of|end_of)|(\[)(/?INST\])"


@dataclass(frozen=True)
class Mapping:
    """A layout: ``shapes`` are example records with its field paths.

    ``messages`` is the path of an array with the fields ``role`` and ``text``; ``fields`` are (role, path)
    turns that come first, those in ``optional`` only where they are not empty. ``roles`` renames roles.
    """

    name: str
    shapes: tuple[str, ...]
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


SHARE_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))

#: The declared layouts.
MAPPINGS = (
    Mapping("messages", ('{"messages":[{"role":"","content":""}]}',), messages="$.messages"),
    Mapping("system_messages", ('{"system":"","messages":[{"role":"","content":""}]}',), messages="$.messages",
            fields=(("system", "$.system"),)),
    Mapping("conversations", ('{"conversations":[{"from":"","value":""}]}',), messages="$.conversations",
            role="from", text="value", roles=SHARE_ROLES),
    Mapping("prompt_completion", ('{"prompt":"","completion":""}',),
            fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("prompt_response", ('{"prompt":"","response":""}',),
            fields=(("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("system_prompt_response", ('{"system":"","prompt":"","response":""}',),
            fields=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("instruction", ('{"instruction":"","output":""}', '{"instruction":"","input":"","output":""}'),
            fields=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")),
            optional=("$.input",)),
)


def field_paths(record: Column) -> Column:
    """The nested field paths of a variant: its shape, scalar types left out."""
    return F.regexp_replace(F.schema_of_variant(record),
                            r"(: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9, ]*\))?", "$1_")


def fingerprint(record: Column) -> Column:
    return F.sha2(field_paths(record), 256)


def declared(spark: SparkSession, mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    """Fingerprint of every declared shape."""
    shapes = [(m, s) for m in mappings for s in m.shapes]
    prints = spark.range(1).select(*(
        fingerprint(F.try_parse_json(F.lit(s))).alias(f"f{i}") for i, (_, s) in enumerate(shapes))).first()
    return {prints[i]: m for i, (m, _) in enumerate(shapes)}


def _turns(record: Column, mapping: Mapping) -> Column:
    parts = []
    for role, path in mapping.fields:
        text = F.try_variant_get(record, path, "string")
        one = F.array(F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))).cast(TURNS)
        if path in mapping.optional:
            one = F.when(F.coalesce(text, F.lit("")) != "", one).otherwise(F.array().cast(TURNS))
        parts.append(one)
    if mapping.messages:
        items = F.coalesce(F.try_variant_get(record, mapping.messages, "array<variant>"),
                           F.array().cast("array<variant>"))

        def turn(x: Column) -> Column:
            role = F.coalesce(F.try_variant_get(x, f"$.{mapping.role}", "string"), F.lit(""))
            named = role
            for old, new in mapping.roles:
                named = F.when(role == old, F.lit(new)).otherwise(named)
            return F.struct(named.alias("role"), F.coalesce(
                F.try_variant_get(x, f"$.{mapping.text}", "string"), F.lit("")).alias("text"))

        parts.append(F.transform(items, turn).cast(TURNS))
    return F.concat(*parts)


def canonical_turns(df: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Add ``layout`` and ``turns`` to records of mixed layouts."""
    known = declared(df.sparkSession, mappings)
    df = df.withColumn("__chat_record", F.try_parse_json(record))
    df = df.withColumn("__chat_print", fingerprint(F.col("__chat_record")))
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for mark, mapping in known.items():
        layout = F.when(F.col("__chat_print") == mark, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(F.col("__chat_print") == mark, _turns(F.col("__chat_record"), mapping)).otherwise(turns)
    return (df.withColumn("layout", layout).withColumn("turns", turns)
            .drop("__chat_record", "__chat_print"))


def escape(text: Column) -> Column:
    """Double backslashes, then break every control string by a backslash after its first character."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, OPENERS, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(df: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Add ``formatted`` and ``segments`` (start, end, loss of each turn's text in code points)."""
    df = df.withColumn("__chat_parts", F.transform("turns", lambda x: F.struct(
        escape(x["role"]).alias("role"), escape(x["text"]).alias("text"), x["role"].isin(*loss_roles).alias("loss"))))
    edge = len(START) + len(MIDDLE)
    df = df.withColumn("__chat_ends", running_total(F.transform(
        "__chat_parts", lambda x: (F.length(x["role"]) + F.length(x["text"]) + edge + len(END) + 1).cast("int"))))
    segments = F.zip_with("__chat_parts", "__chat_ends", lambda x, e: F.struct(
        (e - len(END) - 1 - F.length(x["text"])).cast("int").alias("start"), (e - len(END) - 1).cast("int").alias("end"),
        x["loss"].alias("loss")))
    formatted = F.array_join(F.transform("__chat_parts", lambda x: F.concat(
        F.lit(START), x["role"], F.lit(MIDDLE), x["text"], F.lit(END + "\n"))), "")
    return (df.withColumn("formatted", formatted).withColumn("segments", segments)
            .drop("__chat_parts", "__chat_ends"))


def read_back(df: DataFrame) -> DataFrame:
    """Add ``read_turns`` (role, text, loss) parsed from ``formatted`` and ``segments`` alone."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)
    halves = F.transform(bodies, lambda x: F.split(F.substr(x, F.lit(len(START) + 1)), r"<\|im_sep\|>", 2))
    turns = F.zip_with(halves, F.col("segments"), lambda h, s: F.struct(
        unescape(F.get(h, F.lit(0))).alias("role"), unescape(F.get(h, F.lit(1))).alias("text"),
        (s["loss"] & (F.length(F.get(h, F.lit(1))) == s["end"] - s["start"])).alias("loss")))
    return df.withColumn("read_turns", turns)


def digest(df: DataFrame) -> DataFrame:
    """One row per conversation with the digests of what ``read_back`` found."""
    loss = F.array_join(F.transform(F.filter("read_turns", lambda x: x["loss"]), lambda x: x["text"]), "")
    whole = F.array_join(F.transform(
        "read_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return df.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def records(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) to one JSON record each, in several layouts.

    Rows of a conversation are ordered by turn, then role, then text. The layout follows from the conversation
    id and from which layouts can hold its turns.
    """
    blank = F.lit("")
    one = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")))).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    plain = F.forall("t", lambda x: x["role"].isin("user", "assistant", "system"))
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    choice = F.pmod(F.col("conv_id"), F.lit(4))

    def text(i: int) -> Column:
        return F.get("t", F.lit(i))["text"]

    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    shared = F.transform("t", lambda x: F.struct(
        F.when(x["role"] == "user", F.lit("human")).when(x["role"] == "assistant", F.lit("gpt"))
        .otherwise(x["role"]).alias("from"), x["text"].alias("value")))
    record = (
        F.when(pair & (choice == 0), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(pair & (choice == 1), F.to_json(F.struct(
            text(0).alias("instruction"), F.lit("").alias("input"), text(1).alias("output"))))
        .when((F.get(roles, F.lit(0)) == "system") & (F.size("t") > 1) & (choice != 2), F.to_json(F.struct(
            text(0).alias("system"), F.slice(messages, 2, F.size("t")).alias("messages"))))
        .when(plain & (choice == 3), F.to_json(F.struct(shared.alias("conversations"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages")))))
    return one.select("conv_id", record.alias("record"))
