"""C5 + Z2: the bounded conversation loop with a scripted responder running in tasks."""

import pandas as pd
from pyspark.sql import functions as F

from sourcelens.operators import loop as P

# conv 1 answers at once; conv 2 asks for a tool once, then answers; conv 3 always asks.
SCRIPT = {(1, 1): (False, "REVIEW:1: done"), (2, 1): (True, ""), (2, 2): (False, "FILE_START\nx\nFILE_END")}


def scripted(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for conv, turn in zip(pdf["conv_id"], pdf["turn"]):
        tool, text = SCRIPT.get((int(conv), int(turn)), (True, f"still asking {turn}"))
        rows.append((int(conv), int(turn), text, tool))
    return pd.DataFrame(rows, columns=["conv_id", "turn", "output_text", "has_tool_call"])


def test_loop_with_scripted_responder(spark):
    convs = spark.createDataFrame([(1,), (2,), (3,)], "conv_id bigint")
    calls_made = []

    def dispatch_round(active):
        # one tool call per active conversation; conversation 3 gets an error output
        out = active.select(
            "conv_id", "turn",
            F.when(F.col("conv_id") == 3, F.lit("Error running tool 'x': boom")).otherwise(F.lit("ok")).alias("output"),
        )
        calls_made.append(out)
        return out

    final, outputs = P.run_conversations(convs, P.model_responder(scripted), dispatch_round, max_rounds=2)
    f = {r["conv_id"]: r for r in final.collect()}
    assert (f[1]["final_turn"], f[1]["outcome"], f[1]["final_text"]) == (1, "answered", "REVIEW:1: done")
    assert (f[2]["final_turn"], f[2]["outcome"]) == (2, "answered")
    assert (f[3]["final_turn"], f[3]["outcome"], f[3]["final_text"]) == (3, "limit", "still asking 3")
    o = sorted((r["conv_id"], r["turn"], r["output"]) for r in outputs.collect())
    # conv 2 dispatched once; conv 3 dispatched in both rounds (errors are outputs, not failures)
    assert o == [(2, 1, "ok"), (3, 1, "Error running tool 'x': boom"), (3, 2, "Error running tool 'x': boom")]


def test_recorded_responder_unfinished(spark):
    turns = spark.createDataFrame([(1, 1, "a", True), (1, 2, "b", True), (2, 1, "c", False)],
                                  "conv_id bigint, turn bigint, output_text string, has_tool_call boolean")
    final, outputs = P.run_conversations(turns, P.recorded_responder(turns), None, max_rounds=8)
    f = {r["conv_id"]: (r["final_turn"], r["outcome"]) for r in final.collect()}
    assert f == {1: (None, "unfinished"), 2: (1, "answered")}
    assert outputs is None


def test_second_turn_depends_on_first_rounds_output(spark):
    """The responder sees the prompt, then each round's outputs and the id of the response before."""
    convs = spark.createDataFrame([(1, "start one"), (2, "start two")], "conv_id bigint, prompt string")
    schema = f"conv_id bigint, turn bigint, output_text string, response_id string, calls {P.CALL_ITEM}"

    def model(pdf):
        rows = []
        for r in pdf.itertuples():
            seen = [x["output"] for x in r.tool_outputs]
            if r.turn == 1:
                assert r.prompt.startswith("start") and not seen and r.previous_response_id is None
                calls = [{"call_id": f"c{r.conv_id}", "name": "echo", "arguments": r.prompt}]
                rows.append((r.conv_id, r.turn, "", f"r{r.conv_id}", calls))
            elif seen == ["got start one\nsecond chunk"]:
                assert r.previous_response_id == "r1"
                rows.append((r.conv_id, r.turn, "finished", "r", []))
            else:  # an error output is input like any other
                rows.append((r.conv_id, r.turn, f"after {seen[0]}", "r", []))
        return pd.DataFrame(rows, columns=["conv_id", "turn", "output_text", "response_id", "calls"])

    def dispatch_round(calls):
        ok = F.col("conv_id") == 1
        chunks = F.when(ok, F.array(F.struct(F.lit("b").alias("k"), F.lit("second chunk").alias("o")),
                                    F.struct(F.lit("a").alias("k"), F.concat(F.lit("got "), F.col("arguments")).alias("o")))
                        ).otherwise(F.array(F.struct(F.lit("").alias("k"), F.lit("Error running tool").alias("o"))))
        return calls.select("conv_id", "call_id", F.when(ok, "ok").otherwise("tool_error").alias("status"),
                            F.explode(chunks).alias("c")).select("conv_id", "call_id", "status",
                                                                 F.col("c.k").alias("chunk_key"), F.col("c.o").alias("output"))

    final, outputs = P.run_conversations(convs, P.model_responder(model, schema), dispatch_round)
    f = {r["conv_id"]: (r["final_turn"], r["outcome"], r["final_text"]) for r in final.collect()}
    assert f == {1: (2, "answered", "finished"), 2: (2, "answered", "after Error running tool")}
    assert {r["call_id"]: r["status"] for r in outputs.collect()} == {"c1": "ok", "c2": "tool_error"}
