"""Structured Streaming over model turn events.

Events arrive as ``turn_events(response_id, turn, seq, type, payload, ts)``. Progress records
are a stateless projection (T1). ``turn_records`` keeps one state per turn: it says once that a
turn is drafting, with its first text delta (T2), and gives the turn's record when its
completion event comes (T3); a timer drops turns that are abandoned. ``first_text_delta`` and
``turn_outcomes`` are the same questions as a watermark-bounded dedup and as sessions, for
streams that need no order. Responses arriving as a stream are parsed and applied against the
static file table per micro-batch (T4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sourcelens.functions import text as T
from sourcelens.sources.tables import turn_events_of

# A micro-batch with at most so many projects prunes the files table by their names.
PROJECTS_PUSHED = 200

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events.parquet`` files under ``source_dir`` as a stream, mapped to turn events."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return turn_events_of(r.parquet(source_dir))


def turn_progress(events: DataFrame) -> DataFrame:
    """One progress message per event that the loop reports; others are silent.

    Turns are named by number, tools by the name in the event's item; added items that are
    no function call are not reported.
    ``response.output_text.delta`` is reported once per response by T2, not here.
    """
    t = F.col("type")
    rid = F.col("response_id").cast("string")
    turn = F.concat(F.lit("model turn "), F.col("turn").cast("string"))
    item = lambda field: F.get_json_object("payload", f"$.{field}")
    msg = (
        F.when((t == "response.created") & F.col("response_id").isNotNull(), F.concat(F.lit("response created: "), rid))
        .when(t == "response.in_progress", F.concat(turn, F.lit(" in progress")))
        .when((t == "response.output_item.added") & (item("type") == "function_call"),
              F.concat(F.lit("model requested tool `"), item("name"), F.lit("`")))
        .when(t == "response.function_call_arguments.done",
              F.concat(F.lit("tool args ready for `"), item("name"), F.lit("`: "), T.summarise(item("arguments"))))
        .when(t == "response.completed", F.concat(turn, F.lit(" completed")))
    )
    return events.select("response_id", "seq", "ts", msg.alias("message")).where(F.col("message").isNotNull())


def first_text_delta(events: DataFrame, watermark: str = "31 days") -> DataFrame:
    """At most one 'drafting' record per response; state is bounded by the watermark."""
    d = events.where(F.col("type") == "response.output_text.delta").withWatermark("ts", watermark)
    return d.dropDuplicatesWithinWatermark(["response_id", "type"]).select(
        "response_id", "seq", "ts", F.lit("model is drafting the review").alias("message")
    )


def turn_outcomes(events: DataFrame, gap: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """One record per completed turn, emitted once its events have ended.

    A turn's events are one session: it goes on while the next event follows within ``gap``
    and is emitted when the watermark passes its end. Sessions without a completion event
    give no record. The record has the last payload and counts per event type.
    """
    w = events.withWatermark("ts", watermark)
    return w.groupBy("response_id", "turn", F.session_window("ts", gap).alias("w")).agg(
        F.max_by("payload", "seq").alias("last_payload"),
        F.max("seq").alias("last_seq"),
        F.count("*").alias("events"),
        F.count_if(F.col("type") == "response.function_call_arguments.done").alias("tool_calls"),
        F.count_if(F.col("type") == "response.output_text.delta").alias("text_deltas"),
        F.count_if(F.col("type") == "response.completed").alias("completions"),
    ).where("completions > 0").select(
        "response_id", "turn", F.col("w.start").alias("started"), "last_payload", "last_seq", "events", "tool_calls",
        "text_deltas")


DELTA, ARGUMENTS_DONE, COMPLETED = (
    "response.output_text.delta", "response.function_call_arguments.done", "response.completed")
RECORD_SCHEMA = ("response_id bigint, turn bigint, kind string, started timestamp, seq bigint, payload string, "
                 "events bigint, tool_calls bigint, text_deltas bigint")
_STATE = "started bigint, last_ts bigint, last_seq bigint, events bigint, tool_calls bigint, text_deltas bigint"


def _follow(state: tuple | None, events: list[tuple], abandon_us: int) -> tuple[tuple | None, list[tuple]]:
    """Take a turn's events (ts, seq, type, payload) in order; the state after them, and the records they give.

    A completion ends the turn: what follows under its id is another attempt, and so is what
    follows a pause longer than ``abandon_us`` (whose attempt gives no record).
    """
    out = []
    for ts, seq, kind, payload in events:
        if state and ts - state[1] > abandon_us:
            state = None
        started, _, _, n, calls, deltas = state or (ts, ts, seq, 0, 0, 0)
        deltas += kind == DELTA
        calls += kind == ARGUMENTS_DONE
        state = (started, ts, seq, n + 1, calls, deltas)
        if kind == DELTA and deltas == 1:
            out.append(("drafting", started, seq, payload, n + 1, calls, deltas))
        if kind == COMPLETED:
            out.append(("outcome", started, seq, payload, n + 1, calls, deltas))
            state = None
    return state, out


def _turn_processor(abandon_us: int, ordered: bool):
    """The stateful processor of ``turn_records``; imported in workers with the package."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Turns(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.state = handle.getValueState("turn", _STATE)
            self.waiting = handle.getListState("waiting", "ts bigint, seq bigint, type string, payload string")
            self.past = handle.getValueState("past", "ts bigint, seq bigint")

        def _emit(self, key, events):
            state, found = _follow(self.state.get() if self.state.exists() else None, events, abandon_us)
            if events:
                self.past.update(events[-1][:2])
            if state is None:
                self.state.clear()
            else:
                self.state.update(state)
                self.handle.registerTimer((state[1] + abandon_us) // 1000 + 1)
            rows = [(*key, kind, pd.Timestamp(started, unit="us"), *rest) for kind, started, *rest in found]
            names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
            return pd.DataFrame(rows, columns=names)

        def _due(self, events, watermark_us):
            """Events up to the watermark in order, each once; the others wait on."""
            past = tuple(self.past.get()) if self.past.exists() else (-(1 << 62), -1)
            fresh = {(ts, seq): (ts, seq, kind, payload) for ts, seq, kind, payload in events if (ts, seq) > past}
            due = sorted(k for k in fresh if k[0] <= watermark_us)
            later = sorted(set(fresh) - set(due))
            return [fresh[k] for k in due], [fresh[k] for k in later]

        def handleInputRows(self, key, rows, timerValues):
            new = [(int(t.value // 1000), int(q), k, p) for pdf in rows
                   for t, q, k, p in zip(pdf["ts"], pdf["seq"], pdf["type"], pdf["payload"])]
            if ordered:
                due, _ = self._due(new, 1 << 62)
            else:
                held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
                due, later = self._due(held + new, timerValues.getCurrentWatermarkInMs() * 1000)
                self._wait(later)
            yield self._emit(key, due)

        def _wait(self, later):
            if later:
                self.waiting.put(later)
                self.handle.registerTimer(later[0][0] // 1000 + 1)
            else:
                self.waiting.clear()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = timerValues.getCurrentWatermarkInMs() * 1000
            due, later = self._due([tuple(r) for r in self.waiting.get()] if self.waiting.exists() else [], now)
            self._wait(later)
            yield self._emit(key, due)
            if self.state.exists() and self.state.get()[1] + abandon_us < now:
                self.state.clear()

        def close(self):
            pass

    return Turns()


def turn_records(events: DataFrame, lateness: str | None = None, abandon: str = "1 day") -> DataFrame:
    """T2 + T3 as a stream: ``drafting`` at a turn's first text delta, ``outcome`` at its completion.

    ``lateness`` None: the source delivers every turn in order, and a record goes out in the
    micro-batch of the event that makes it; turns may lie ``abandon`` apart. Otherwise events wait until the watermark has
    passed them (so ``lateness`` after the newest) and are taken in the order of (ts, seq);
    records then equal the batch twin's whatever the order of arrival. Repeated events count
    once, events older than what was taken are dropped. A turn without an event for ``abandon``
    gives no outcome, and a timer drops its state.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    from sourcelens.session import ship_package

    ship_package(events.sparkSession)
    timed = events.where(F.col("response_id").isNotNull() & F.col("turn").isNotNull() & F.col("ts").isNotNull()).select(
        F.col("response_id").cast("bigint").alias("response_id"), F.col("turn").cast("bigint").alias("turn"),
        "seq", "type", "payload", "ts").withWatermark("ts", lateness or abandon)
    return timed.groupBy("response_id", "turn").transformWithStateInPandas(
        statefulProcessor=_turn_processor(_microseconds(abandon), lateness is None),
        outputStructType=RECORD_SCHEMA, outputMode="Append", timeMode="EventTime")


def _microseconds(interval: str) -> int:
    import pandas as pd

    return int(pd.Timedelta(interval).value // 1000)


def turn_records_batch(events: DataFrame, abandon: str = "1 day") -> DataFrame:
    """The batch twin of ``turn_records``: attempts are cut at completions and at long pauses."""
    keys = ["response_id", "turn"]
    one = events.where(F.col("response_id").isNotNull() & F.col("turn").isNotNull() & F.col("ts").isNotNull()).dropDuplicates(
        [*keys, "ts", "seq"])
    order = Window.partitionBy(*keys).orderBy("ts", "seq")
    opens = (F.lag("type").over(order) == COMPLETED) | (
        F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(order)) > _microseconds(abandon))
    cut = one.withColumn("_opens", F.coalesce(opens, F.lit(True)).cast("int")).withColumn(
        "_attempt", F.sum("_opens").over(order))
    own = Window.partitionBy(*keys, "_attempt").orderBy("ts", "seq")
    total = lambda c: F.sum(c.cast("bigint")).over(own)
    counted = cut.select(
        *keys, "type", "seq", "payload", F.first("ts").over(own).alias("started"), total(F.lit(1)).alias("events"),
        total(F.col("type") == ARGUMENTS_DONE).alias("tool_calls"), total(F.col("type") == DELTA).alias("text_deltas"))
    kind = F.when(F.col("type") == COMPLETED, "outcome").when(
        (F.col("type") == DELTA) & (F.col("text_deltas") == 1), "drafting")
    return counted.withColumn("kind", kind).where(F.col("kind").isNotNull()).select(
        *keys, "kind", "started", "seq", "payload", "events", "tool_calls", "text_deltas")


def live_annotations(responses: DataFrame, files: DataFrame, out_dir: str, checkpoint_dir: str, trigger=None):
    """T4: a stream of ``responses(project, path, output_text)`` joined to the static files table.

    Each micro-batch is parsed (X6, A2) and applied (J3 or rewrite) and the changed files
    are appended to ``out_dir``; the checkpoint makes the query restartable after a
    lost executor or driver.
    """
    from sourcelens.plans.jobs import proposals

    def apply_batch(batch: DataFrame, epoch: int) -> None:
        # One directory per epoch, overwritten on replay: a retried batch never duplicates.
        # At most the batch's files are read of the static table: its projects prune partitions and row groups.
        projects = [r["project"] for r in batch.select("project").distinct().limit(PROJECTS_PUSHED + 1).collect()]
        own = files.where(F.col("project").isin(projects)) if len(projects) <= PROJECTS_PUSHED else files
        p = proposals(own, batch, materialize=False).where("changed")
        (p.select("project", "path", F.col("updated").alias("content"), "mode", "added", "injected")
         .write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch}"))

    w = responses.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(**trigger)
    return w.start()
