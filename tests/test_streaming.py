"""Streaming runs over the events table agree with their batch twins."""

import tempfile

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.sources import tables as S
from sourcelens.streaming import turns as ST

SF = "/root/testdata/sf0.001"


def run_to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint_dir: str | None = None):
    """Run a streaming DataFrame to completion over the available input."""
    w = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    if checkpoint_dir:
        w = w.option("checkpointLocation", checkpoint_dir)
    q = w.start()
    q.awaitTermination()
    return df.sparkSession.table(name)



def test_first_text_delta_stream_matches_batch(spark):
    stream = ST.read_events_stream(spark, SF)
    got = run_to_memory(ST.first_text_delta(stream), "t2_first_delta")
    batch = S.turn_events(spark, SF).where(F.col("type") == "response.output_text.delta")
    expected = {r[0] for r in batch.select("response_id").distinct().collect()}
    rows = got.collect()
    assert {r["response_id"] for r in rows} == expected
    assert len(rows) == len(expected)  # at most one record per response


def test_turn_progress_is_stateless_projection(spark):
    stream = ST.read_events_stream(spark, SF)
    got = run_to_memory(ST.turn_progress(stream), "t1_progress")
    batch = ST.turn_progress(S.turn_events(spark, SF))
    assert got.count() == batch.count()
    events = S.turn_events(spark, SF)
    for start, end, typ in (("response created: ", "", "response.created"), ("model turn ", " completed", "response.completed")):
        found = got.where(F.col("message").startswith(start) & F.col("message").endswith(end)).count()
        assert found == events.where(F.col("type") == typ).count() > 0


def test_turn_outcomes_match_batch(spark):
    stream = ST.read_events_stream(spark, SF)
    got = run_to_memory(ST.turn_outcomes(stream), "t3_outcomes")
    events = S.turn_events(spark, SF)
    batch = {(r["response_id"], r["turn"], r["started"]): r for r in ST.turn_outcomes(events).collect()}
    g = {(r["response_id"], r["turn"], r["started"]): r for r in got.collect()}
    # append mode emits a turn once its session is closed: all but the newest, with the batch's values
    assert g and all(batch[k] == v for k, v in g.items())
    newest = events.agg(F.max("ts")).first()[0]
    assert all(k in g or (newest - k[2]).total_seconds() < 4 * 3600 for k in batch)


def test_live_annotations_match_batch(spark):
    import os

    out = tempfile.mkdtemp(prefix="t4-out-")
    ck = tempfile.mkdtemp(prefix="t4-ck-")
    src = tempfile.mkdtemp(prefix="t4-src-")
    responses = S.doc_responses(spark, SF)
    responses.write.mode("overwrite").parquet(os.path.join(src, "r"))
    stream = spark.readStream.schema(responses.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "r"))
    files = S.doc_files(spark, SF, annotated=True).select("project", "path", "content")
    q = ST.live_annotations(stream, files, out, ck)
    q.awaitTermination()
    got = spark.read.parquet(out)
    from sourcelens.plans.jobs import proposals

    expected = proposals(files, responses).where("changed").select("path", F.col("updated").alias("content"))
    assert got.select("path", "content").exceptAll(expected).count() == 0
    assert expected.exceptAll(got.select("path", "content")).count() == 0


def test_turn_outcomes_never_change_an_emitted_turn(spark):
    """Append mode emits a turn once, after the watermark passes its session's end; an event for
    it arriving later is dropped (Spark only guarantees dropping late data once the session's
    state is finalised, which is what this checks)."""
    import datetime as dt
    import os
    import time

    import pyarrow as pa
    import pyarrow.parquet as pq

    src = tempfile.mkdtemp(prefix="t3-late-")
    t0 = dt.datetime(2024, 1, 1, 10, 50, 0)
    batches = [  # events 9 and 17 are of turn 2, event 9 and 81 complete it
        [(17, t0, 7, "click", 1.0, '{"k": 1}'), (9, t0 + dt.timedelta(minutes=20), 7, "view", 1.0, '{"k": 2}')],
        [(3, t0 + dt.timedelta(hours=6), 7, "view", 1.0, '{"k": 3}')],        # moves the watermark past the session
        [(11, t0 + dt.timedelta(hours=7), 7, "view", 1.0, '{"k": 3}')],       # emits it
        [(25, t0 + dt.timedelta(minutes=5), 7, "click", 1.0, '{"k": 4}')],    # of that turn, after it was emitted
        [(81, t0 + dt.timedelta(hours=9), 7, "view", 1.0, '{"k": 5}')],
    ]
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    for i, rows in enumerate(batches):  # one file per micro-batch, ordered by modification time
        pq.write_table(pa.Table.from_pylist([dict(zip(cols, r)) for r in rows]), os.path.join(src, f"events-{i}.parquet"))
        time.sleep(1.1)
    stream = ST.read_events_stream(spark, src, max_files_per_trigger=1)
    got = run_to_memory(ST.turn_outcomes(stream), "t3_late")
    rows = [r for r in got.collect() if r["started"] == t0]
    # the turn crosses an hour and is one record still
    assert len(rows) == 1 and (rows[0]["events"], rows[0]["tool_calls"], rows[0]["turn"]) == (2, 1, 2)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "response_id bigint, turn bigint, seq bigint, type string, payload string, ts timestamp"
FIELDS = ["response_id", "turn", "kind", "started", "seq", "payload", "events", "tool_calls", "text_deltas"]


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, ROCKS)
    yield spark
    spark.conf.set(key, old)


def write_batches(batches):
    """One parquet file of events per micro-batch, in the order of their times."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    src = tempfile.mkdtemp(prefix="t3-events-")
    names = ["response_id", "turn", "seq", "type", "payload", "ts"]
    kinds = pa.schema([(n, t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                      pa.timestamp("us", "UTC")))])
    for i, rows in enumerate(batches):
        path = os.path.join(src, f"b{i}.parquet")
        pq.write_table(pa.Table.from_pylist([dict(zip(names, r)) for r in rows], kinds), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return src


def recorded(spark, src, name, **options):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(src)
    got = run_to_memory(ST.turn_records(stream, **options), name)
    return sorted(tuple(r[c] for c in FIELDS) for r in got.collect())


def some_events(seed, turns=12, most=14):
    """Turns that draft, call tools, complete once or twice, or are abandoned and taken up two days later."""
    import datetime as dt
    import random

    rnd = random.Random(seed)
    out, seq = [], 0
    for t in range(turns):
        ts = dt.datetime(2024, 5, 1, 8, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=rnd.randrange(600))
        for _ in range(rnd.randrange(1, most)):
            seq += 1
            kind = rnd.choice([ST.DELTA, ST.DELTA, ST.ARGUMENTS_DONE, "response.in_progress", ST.COMPLETED])
            out.append((t // 3, t % 3, seq, kind, f"p{seq}", ts))
            ts += dt.timedelta(seconds=rnd.choice([0, 1, 30])) if rnd.random() < 0.95 else dt.timedelta(days=2)
    return out


def test_turn_records_of_shuffled_late_and_repeated_events_equal_batch(rocks):
    import datetime as dt
    import random

    events = some_events(1)
    want = sorted(tuple(r[c] for c in FIELDS) for r in ST.turn_records_batch(rocks.createDataFrame(events, EVENT)).collect())
    rnd = random.Random(2)
    # Arrival up to an hour late, some events twice; then one that lets the watermark pass all of them.
    arrivals = sorted([(e[5] + dt.timedelta(minutes=rnd.uniform(0, 55)), e) for e in events + events[::4]], key=lambda x: x[0])
    size = max(1, len(arrivals) // 6)
    batches = [[e for _, e in arrivals[i:i + size]] for i in range(0, len(arrivals), size)]
    end = max(e[5] for e in events) + dt.timedelta(days=30)
    batches += [[(99, 9, 10_000, "response.in_progress", None, end)], [(99, 9, 10_001, "response.in_progress", None, end)]]
    assert recorded(rocks, write_batches(batches), "t3_shuffled", lateness="1 hour") == want
    assert {r[2] for r in want} == {"drafting", "outcome"}


def test_ordered_turns_are_recorded_with_their_completion(rocks):
    """The record is in the micro-batch of the completion event: nothing comes after it here."""
    events = sorted(some_events(3), key=lambda e: e[2])
    want = sorted(tuple(r[c] for c in FIELDS) for r in ST.turn_records_batch(rocks.createDataFrame(events, EVENT)).collect())
    half = len(events) // 2
    assert recorded(rocks, write_batches([events[:half], events[half - 2:half] + events[half:]]), "t3_ordered",
                    abandon="1 day") == want


def test_turn_records_pause_and_late_rules():
    day = 24 * 3600 * 10**6
    events = [(0, 1, ST.DELTA, "a"), (5, 2, ST.COMPLETED, "b"), (6, 3, ST.COMPLETED, "c"), (7, 4, ST.DELTA, "d"),
              (8 + day, 5, ST.DELTA, "e"), (9 + day, 6, ST.COMPLETED, "f")]
    state, out = ST._follow(None, events, day)
    assert state is None
    assert [(k, s, q, n) for k, s, q, _, n, _, _ in out] == [
        ("drafting", 0, 1, 1), ("outcome", 0, 2, 2), ("outcome", 6, 3, 1), ("drafting", 7, 4, 1),
        ("drafting", 8 + day, 5, 1), ("outcome", 8 + day, 6, 2)]
