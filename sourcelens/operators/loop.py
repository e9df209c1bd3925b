"""Bounded tool-calling conversations replayed as an iterative DataFrame job.

Each round works on all active conversations at once: ask the responder for the current
turn of every active conversation, let the ones without tool calls finish, dispatch the
tool calls of the others in one join per tool (J5), and advance. Each round's results are
checkpointed to the shared checkpoint dir, so the plan does not grow with the rounds and a
lost executor only recomputes the current round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.session import checkpoint

TURN_COLS = ["conv_id", "turn", "output_text", "has_tool_call"]


def recorded_responder(turns: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Z2 default: the answer to ``(conv_id, turn)`` is the recorded row (a join, no network)."""
    recorded = turns.select(*TURN_COLS)

    def respond(active: DataFrame) -> DataFrame:
        return active.select("conv_id", "turn").join(recorded, ["conv_id", "turn"], "inner")

    return respond


def model_responder(call_batch: Callable, schema: str = "conv_id bigint, turn bigint, output_text string, "
                    "has_tool_call boolean") -> Callable[[DataFrame], DataFrame]:
    """Z2 with a live model: ``call_batch(pandas_df) -> pandas_df`` runs in the tasks.

    The client is created inside ``call_batch`` (once per task), never on the driver; rows
    of a round are sent in Arrow batches with their prompt or tool outputs. A schema with
    ``calls`` (see ``CALL_ITEM``) lets the model ask for tools.
    """

    def run(it):
        for pdf in it:
            yield call_batch(pdf)

    def respond(active: DataFrame) -> DataFrame:
        return active.mapInPandas(run, schema)

    return respond


# What a responder may read of each active conversation, besides conv_id and turn.
OUTPUT_ITEM = "array<struct<call_id:string,output:string>>"
CALL_ITEM = "array<struct<call_id:string,name:string,arguments:string>>"


def assemble_outputs(outputs: DataFrame, keys: tuple[str, ...] = ("conv_id", "call_id")) -> DataFrame:
    """One string per call, as the model is sent it: chunks in key order, joined by newlines."""
    g = outputs.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("chunk_key", "output"))).alias("chunks"), F.min("status").alias("status"))
    return g.select(*keys, "status", F.array_join(F.col("chunks.output"), "\n").alias("output"))


def run_conversations(
    conversations: DataFrame,
    respond: Callable[[DataFrame], DataFrame],
    dispatch_round: Callable[[DataFrame], DataFrame] | None = None,
    max_rounds: int = 8,
) -> tuple[DataFrame, DataFrame | None]:
    """Returns (final turns, tool outputs of all rounds).

    Every round the responder gets ``conv_id, turn, prompt`` (the first turn's, if the
    conversations have one), ``tool_outputs`` (call_id and output of the round before) and
    ``previous_response_id``. It returns ``conv_id, turn, output_text`` and either ``calls``
    (call_id, name, arguments; none means that the turn answers) with an optional
    ``response_id``, or, for recorded turns, ``has_tool_call``. With ``calls``,
    ``dispatch_round`` gets one row per call and must return ``conv_id, call_id, status,
    chunk_key, output``; the assembled outputs are the next round's input. Without, it gets
    the conversations that go on.

    Final turns: ``conv_id, final_turn, outcome (answered/limit/unfinished), final_text``.
    Turn ``max_rounds + 1`` is final even if it asks for tools (the reference parses it
    anyway).
    """
    limit = max_rounds + 1
    prompt = F.col("prompt") if "prompt" in conversations.columns else F.lit(None).cast("string")
    ids = conversations.groupBy("conv_id").agg(F.max(prompt).alias("prompt"))
    none = F.array().cast(OUTPUT_ITEM)
    active = ids.select("conv_id", F.lit(1).cast("bigint").alias("turn"), "prompt", none.alias("tool_outputs"),
                        F.lit(None).cast("string").alias("previous_response_id"))
    finals, outputs = [], []
    for r in range(1, limit + 1):
        resp = respond(active)
        live = "calls" in resp.columns
        if live:
            resp = resp.withColumn("has_tool_call", F.coalesce(F.size("calls") > 0, F.lit(False)))
            if "response_id" not in resp.columns:
                resp = resp.withColumn("response_id", F.concat_ws("-", "conv_id", "turn"))
        resp = checkpoint(resp)
        done = resp.where(~F.col("has_tool_call") | (F.col("turn") == limit))
        finals.append(done.select(
            "conv_id", F.col("turn").alias("final_turn"),
            F.when(~F.col("has_tool_call"), "answered").otherwise("limit").alias("outcome"),
            F.col("output_text").alias("final_text"),
        ))
        if r == limit:
            break
        going = resp.where(F.col("has_tool_call"))
        cont = going.select("conv_id", "turn")
        asked = going.select("conv_id", "turn", F.explode("calls").alias("c")).select("conv_id", "turn", "c.*") if live else cont
        made = None
        if dispatch_round is not None:
            made = dispatch_round(asked)
            made = checkpoint(assemble_outputs(made) if live else made)
            outputs.append(made)
        # a projection of the checkpointed round result: no lineage to cut here
        step = going.select(
            "conv_id", (F.col("turn") + 1).alias("turn"), F.lit(None).cast("string").alias("prompt"),
            (F.col("response_id") if live else F.lit(None)).cast("string").alias("previous_response_id"))
        if live and made is not None:
            items = made.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
                F.col("call_id").cast("string").alias("call_id"), "output"))).cast(OUTPUT_ITEM).alias("tool_outputs"))
            step = step.join(items, "conv_id", "left")
        else:
            step = step.withColumn("tool_outputs", none)
        active = step.select("conv_id", "turn", "prompt", F.coalesce("tool_outputs", none).alias("tool_outputs"),
                             "previous_response_id")
        if going.isEmpty():
            break
    final = finals[0]
    for f in finals[1:]:
        final = final.unionByName(f)
    unfinished = ids.join(final.select("conv_id"), "conv_id", "left_anti").select(
        "conv_id", F.lit(None).cast("bigint").alias("final_turn"), F.lit("unfinished").alias("outcome"),
        F.lit(None).cast("string").alias("final_text"),
    )
    final = final.unionByName(unfinished)
    out = None
    if outputs:
        out = outputs[0]
        for o in outputs[1:]:
            out = out.unionByName(o)
    return final, out
