"""Custom stream state: the ring of panes, the landed ids, late events, messages that cannot be read."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import adapter
from tidemark.streaming import events, idstore, jobs, late
from tidemark.streaming.rings import PaneRing
from tidemark.streaming.windows import windowed_counts
from tests.conftest import SF_SMALL

SCHEMA = "key string, at timestamp"


def drop(spark, path, rows):
    spark.createDataFrame(rows, "key string, at string").select("key", F.col("at").cast("timestamp").alias("at")) \
        .coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)


def counts(spark, path, sink, checkpoint, **kw):
    from tidemark.streaming.rings import ring_window_counts
    ev = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)
    out = ring_window_counts(ev, "at", "key", **kw)
    out.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink).outputMode("append") \
        .trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("window_start timestamp, window_end timestamp, key string, n long").parquet(sink)


def times(seed, n, start=0, span=1800):
    rnd = random.Random(seed)
    return sorted(((f"2024-01-01 {(start + s) // 3600:02d}:{(start + s) // 60 % 60:02d}:{(start + s) % 60:02d}.250", rnd.choice(["a", "a", "b", None]))
                   for s in (rnd.randrange(span) for _ in range(n))), key=lambda x: x[0])


@pytest.mark.parametrize("size,slide", [("5 minutes", "1 minute"), ("10 minutes", "10 minutes"), ("3 minutes", "2 minutes")])
def test_ring_equals_batch_windows_and_keeps_panes_only(spark, size, slide):
    path, sink, ck = (scratch_path(spark, x) for x in ("in", "out", "ck"))
    kw = dict(size=size, slide=slide, watermark="2 minutes")
    rows = [(k, t) for t, k in times(3, 300)]
    late_rows = [(k, t) for t, k in times(4, 60, start=5 * 3600)]  # a gap of hours, after a restart
    drop(spark, path, rows[:150])
    drop(spark, path, rows[150:])
    counts(spark, path, sink, ck, **kw)
    drop(spark, path, late_rows)
    found = counts(spark, path, sink, ck, **kw)
    batch = windowed_counts(spark.read.parquet(path), "at", ["key"], size, slide, use_panes=False)
    mark = max(t for _, t in late_rows)
    closed = batch.where(F.col("window_end") <= F.expr(f"timestamp '{mark}' - interval 2 minutes")).select(found.columns)
    assert found.count() and found.exceptAll(closed).isEmpty() and closed.exceptAll(found).isEmpty()
    # what is left in the state: the panes of open windows, one row each
    state = spark.read.format("statestore").option("path", ck).option("stateVarName", "panes").load()
    still = batch.where(F.col("window_end") > F.expr(f"timestamp '{mark}' - interval 2 minutes"))
    pane = {"5 minutes": 60, "10 minutes": 600, "3 minutes": 60}[size]
    panes = (spark.read.parquet(path).select("key", F.expr(f"unix_seconds(at) div {pane} * {pane}").alias("p")).distinct()
             .join(still.select(F.col("key").alias("k"), F.unix_seconds("window_start").alias("s"), F.unix_seconds("window_end").alias("e")),
                   F.expr("key <=> k and p >= s and p < e"), "left_semi"))
    assert state.count() == panes.count()


def test_ring_jumps_over_gaps():
    ring = PaneRing(3_600_000, 30_000)
    year = 365 * 24 * 3_600_000
    found, start = ring.closed({0: 2, year: 1}, -3_570_000, 2 * year)
    assert len(found) == 240 and {n for _, n in found} == {1, 2} and start > year


def test_runs_follow_from_the_number_alone():
    fan, there, most = 8, set(), 0
    for n in range(1000):
        gone = idstore.replaced_by(n - 1, fan) if n else []
        assert set(gone) <= there
        there -= set(gone)
        before = idstore.runs_before(n, fan)
        assert set(before) <= there  # a replay of n finds its runs
        assert sorted(a for level, at in before for a in range(at, at + fan ** level)) == list(range(n))
        there.add((0, n))
        if idstore.replaced_by(n, fan):
            there.add(idstore.runs_before(n + 1, fan)[-1])
        most = max(most, len(there))
    assert most <= 4 * fan + fan  # however many micro-batches


def test_landed_ids_in_few_files_and_replayed(spark, tmp_dir):
    ids = idstore.LandedIds(spark, f"{tmp_dir}/ids", fan=3)
    day = lambda n: f"2024-01-{n % 5 + 1:02d}"
    for n in range(14):
        for _ in range(2 if n in (2, 8, 9) else 1):  # replayed ones find the same
            assert {r[0] for r in ids.before(n).collect()} == {f"e{k}" for k in range(n)}
            ids.add(spark.createDataFrame([(f"e{n}", day(n))], idstore.IDS_SCHEMA), n)
    runs = [d for d, _, files in os.walk(f"{tmp_dir}/ids") if any(f.endswith(".parquet") for f in files)]
    assert len(runs) <= 8


def test_late_events_of_any_age_pass_the_dedup(spark):
    feed = adapter.feed_events(spark, SF_SMALL)
    src, sink, ck = (scratch_path(spark, x) for x in ("feed", "s", "c"))
    mid = feed.agg(F.percentile_approx("_seq", 0.5)).first()[0]
    jobs.write_feed(feed.where(F.col("_seq") > mid), src, parts=2)
    jobs.write_feed(feed.where(F.col("_seq") <= mid), src, parts=2)  # days behind, for the first time
    jobs.write_feed(feed.where(F.col("_seq") > mid), src, parts=1)   # and some again
    out = jobs.stream_dedup(jobs.read_messages(spark, src, 1), sink, ck)
    assert out.count() == feed.count() == out.select("event_id").distinct().count()


def test_split_keeps_every_event(spark):
    path, root, ck = (scratch_path(spark, x) for x in ("in", "split", "ck"))
    rows = [(k, t) for t, k in times(6, 100)]
    for part in (rows[:50], rows[50:], rows[:7] + [("none", None)]):
        drop(spark, path, part)
    ev = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)
    on_time, behind = late.split_late(ev, root, ck, "2 minutes", ts="at")
    assert on_time.count() == 101 and behind.count() == 7
    marks = late.watermarks(spark, root).orderBy("number").collect()
    assert [(r["on_time"], r["late"]) for r in marks] == [(50, 0), (50, 0), (1, 7)] and marks[0]["watermark"] is None
    # a replay of the last micro-batch replaces its own folders
    last = spark.read.schema(SCHEMA).parquet(path).where("key = 'none'")
    late.late_splitter(root, "2 minutes", "at")(last.limit(1), 2)
    assert late._events(spark, root, last.schema.simpleString()).count() == 101


def test_no_message_stops_a_stream(spark):
    good = events.encode_events(adapter.feed_events(spark, SF_SMALL)).limit(5)
    odd = spark.createDataFrame([("k", "{}", "nodot"), ("k", None, None), ("k", "not json", "social.posts"), ("k", "[1]", "social."),
                                 ("k", '{"event_id": "x", "timestamp": "yesterday"}', "social.posts"),
                                 ("k", '{"event_id": "x", "timestamp": "2024-01-01T00:00:00"}', "other.posts"),
                                 ("k", '{"event_id": "x", "timestamp": 7}', "social.likes")], "key string, value string, topic string")
    path = scratch_path(spark, "feed")
    good.unionByName(odd).write.json(path)
    root = jobs.stream_to_bronze_lake(jobs.read_messages(spark, path), scratch_path(spark, "b"), scratch_path(spark, "c"), dedup="10 minutes")
    bad = jobs.stream_quarantine(jobs.read_messages(spark, path), scratch_path(spark, "q"), scratch_path(spark, "c"))
    assert jobs.stream_totals(spark, root).agg(F.sum("rows")).first()[0] == 5
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "no time", "no time", "unknown topic", "unknown topic", "unknown topic", "unknown topic"]


def test_windows_in_a_session_of_another_state_store(spark):
    other = spark.newSession()
    name = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    other.conf.set(name, default)
    rows = [(f"2024-01-01T{h:02d}:{m:02d}:00", m % 2) for h in range(3) for m in range(0, 60, 4)]
    likes = other.createDataFrame(
        [("p1", f'{{"event_type":"post_liked","event_id":"e{k}","like_id":"l{k}","reaction_type":"{["sad", "wow"][r]}","timestamp":"{t}"}}',
          "social.likes") for k, (t, r) in enumerate(rows)], "key string, value string, topic string")
    src = scratch_path(spark, "feed")
    likes.coalesce(1).write.json(src)
    out = jobs.stream_window_counts(jobs.read_messages(other, src), scratch_path(spark, "s"), scratch_path(spark, "c"),
                                    "likes", "reaction_type", size="1 hour", slide="1 hour")
    got = sorted((r["window_start"].hour, r["reaction_type"], r["n"]) for r in out.collect())
    assert got == [(h, r, n) for h in range(2) for r, n in (("sad", 15),)]
    assert other.conf.get(name) == default


@pytest.mark.parametrize("replay, drops", [(None, 3), ("late", 4)])
def test_a_trigger_takes_a_whole_drop(spark, monkeypatch, replay, drops):
    monkeypatch.setattr(jobs, "FILE_EVENTS", 20)
    feed = adapter.feed_events(spark, SF_SMALL).where("_seq < 60 OR _seq >= 900 OR _seq = 450")  # a drop of one event
    src = jobs.write_feed(feed, scratch_path(spark, "feed"), parts=3, replay=replay)
    assert spark.read.schema(jobs.MESSAGE_SCHEMA).json(src).count() >= feed.count()
    files = jobs.files_a_drop(spark, src, drops)
    assert files > 1
    root = scratch_path(spark, "split")
    on_time, behind = jobs.stream_late_split(jobs.read_messages(spark, src, files), root, scratch_path(spark, "c"))
    assert late.watermarks(spark, root).count() == drops
    assert on_time.count() == feed.count()
    assert behind.count() == (feed.where("_seq < 60 AND _seq % 20 = 0").count() if replay else 0)
