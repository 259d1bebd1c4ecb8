"""Structured Streaming jobs over the event feed.

Every job takes a streaming frame of ``(key, value, topic)`` messages:
``read_messages`` makes one from JSON files, ``events.kafka_source`` from
Kafka.  Each job keeps its offsets and state in a checkpoint under the shared
folder, so a restarted job resumes where it stopped (T6); file sinks are
exactly-once, and the ``foreachBatch`` bronze writer is idempotent: a batch
replaces exactly its own partitions, in a range of batch ids of its own.
"""

from __future__ import annotations

import json
import time
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.tags import lenient_tags
from tidemark.session import rocksdb_state
from tidemark.sources import files, schema_log
from tidemark.sources.bronze import read_or_empty
from tidemark.sources.schemas import PARTITIONS
from tidemark.streaming.events import (
    ENTITIES, TOPIC_PREFIX, bad_messages, decode_events, encode_events, event_time, good_messages, to_bronze,
)
from tidemark.streaming.idstore import LandedIds, first_time
from tidemark.streaming.late import split_late
from tidemark.streaming.rings import ring_window_counts

TOTALS_SCHEMA = "entity string, rows bigint, batch_id bigint"
QUARANTINE_SCHEMA = "topic string, raw string, reason string"
RAW_SCHEMA = "entity string, raw string, consumed_at string"
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
])


# ---- feed files (scaffolding for the file-stream source) ------------------

#: events that a file of a drop holds, about
FILE_EVENTS = 250_000


def write_feed(feed: DataFrame, path: str, parts: int = 4,
               replay: str | None = None, replay_every: int = 20) -> str:
    """Write encoded messages as ``parts`` JSON drops in event-time order,
    one write per drop so file modification times follow event time.

    ``replay='late'`` appends a final drop re-sending every
    ``replay_every``-th event of the first drop (old event time: late);
    ``replay='dup'`` re-sends events of the last drop (duplicates well
    inside the watermark).

    The events of a drop are dealt evenly to its files, and every drop has the
    same number of files (``files_a_drop``), so a trigger can take a whole
    drop: there are as many micro-batches whatever the size of the feed.
    """
    spark = feed.sparkSession
    bounds = feed.agg(F.min("_seq").alias("lo"), F.max("_seq").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    width = max(1, (hi - lo + parts) // parts)
    each = max(1, -(-bounds["n"] // (parts * FILE_EVENTS)))
    bucket = ((F.col("_seq") - F.lit(lo)) / F.lit(width)).cast("long")
    tagged = feed.withColumn("__b", bucket)
    there = len(_drop_files(spark, path))

    def drop(events: DataFrame, number: int) -> None:
        encode_events(events.repartition(each).sortWithinPartitions("_seq")).write.mode("append").json(path)
        for k in range(there + (number + 1) * each - len(_drop_files(spark, path))):
            files.write_text(spark, f"{path}/none-{number}-{k}.json", "")  # a task without events writes no file
        time.sleep(0.02)

    for b in range(parts):
        drop(tagged.where(F.col("__b") == b), b)
    if replay:
        pick = 0 if replay == "late" else parts - 1
        drop(tagged.where((F.col("__b") == pick) & (F.col("_seq") % replay_every == 0)), parts)
    return path


def _drop_files(spark: SparkSession, path: str) -> list[str]:
    return [f for f in files.names(spark, path) if f.endswith(".json")]


def files_a_drop(spark: SparkSession, path: str, drops: int) -> int:
    """Files in each of the ``drops`` that ``write_feed`` wrote (the one sent again counts)."""
    return len(_drop_files(spark, path)) // drops


def read_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON message files as a stream; by default a trigger takes all that is there."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(files_per_trigger))
    return r.json(path)


def _event_time(df: DataFrame) -> DataFrame:
    # withWatermark needs a zoned TIMESTAMP; ISO text carries no zone, so it
    # is read as UTC wall clock by the session (tidemark sessions pin UTC).
    return df.withColumn("event_time", F.col("timestamp").try_cast("timestamp"))


def _run(query_writer, wait: bool = True, every: str | None = None):
    """``every=None`` drains what is available and stops (batch-like runs,
    tests); ``every="1 second"`` keeps polling like a long-running consumer
    (the caller owns the returned query)."""
    if every:
        return query_writer.trigger(processingTime=every).start()
    q = query_writer.trigger(availableNow=True).start()
    if wait:
        q.awaitTermination()
    return q


# ---- T1-T4: windowed counts with watermark --------------------------------

def stream_window_counts(messages: DataFrame, sink: str, checkpoint: str,
                         entity: str = "posts", key: str = "hashtag",
                         size: str = "1 hour", slide: str = "30 seconds",
                         watermark: str = "10 minutes") -> DataFrame:
    """Windowed counts per key over one entity's events, append mode.

    Late events (older than max event time minus ``watermark``) are left out
    (``late.split_late`` keeps them); windows are sent once the watermark
    passes their end.  The state is the panes of the windows still open
    (``rings.PaneRing``).
    """
    dec = _event_time(decode_events(messages))
    ev = dec.where(F.col("entity") == entity)
    if key == "hashtag":
        ev = ev.select("event_time", F.explode(lenient_tags("hashtags")).alias("hashtag"))
    else:
        ev = ev.select("event_time", key)
    counts = ring_window_counts(ev, "event_time", key, size, slide, watermark)
    with rocksdb_state(messages.sparkSession):  # custom state works with no other store
        _run(counts.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).option("path", sink))
    return messages.sparkSession.read.schema(f"window_start timestamp, window_end timestamp, {key} string, n long").parquet(sink)


def stream_late_split(messages: DataFrame, root: str, checkpoint: str, delay: str = "10 minutes") -> tuple[DataFrame, DataFrame]:
    """T4: the good events on time and the late ones, in two sinks under ``root``."""
    events = _event_time(good_messages(decode_events(messages))).select("entity", "event_id", "post_id", "event_time", "raw")
    return split_late(events, root, checkpoint, delay)


# ---- T5: dedup by event id ------------------------------------------------

def drop_resent(decoded: DataFrame, keep: str = "10 minutes") -> DataFrame:
    """Drop re-sent events: an ``event_id`` is remembered for ``keep`` after it arrived.

    The state's time is the arrival, not the event time: no event arrives
    behind it, so one that comes late for the first time passes, however old.
    """
    arrived = _event_time(decoded).withColumn("arrived_at", F.current_timestamp())
    return arrived.withWatermark("arrived_at", keep).dropDuplicatesWithinWatermark(["event_id"])


def stream_dedup(messages: DataFrame, sink: str, checkpoint: str, keep: str = "10 minutes") -> DataFrame:
    """The decoded events without re-sent ones, as Parquet."""
    uniq = drop_resent(decode_events(messages), keep).select("entity", "event_id", "post_id", "event_time")
    _run(uniq.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink))
    return messages.sparkSession.read.parquet(sink)


# ---- messages that cannot become bronze rows ---------------------------------

def stream_quarantine(messages: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Malformed messages and those of unknown topics, with the reason, as Parquet."""
    _run(bad_messages(decode_events(messages, keep=("topic",))).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink))
    return messages.sparkSession.read.schema(QUARANTINE_SCHEMA).parquet(sink)


# ---- K4: stream -> bronze --------------------------------------------------

def run_number(spark: SparkSession, checkpoint: str) -> int:
    """A number for the query that a checkpoint belongs to (its permanent id)."""
    text = spark.read.text(f"{checkpoint}/metadata").first()["value"]
    return zlib.crc32(json.loads(text)["id"].encode())


def bronze_batch_writer(root: str, checkpoint: str, dedup: str | None = None):
    """``foreachBatch`` body: land the messages as raw JSONL (``_raw``), then
    normalise them to the bronze shape, each entity partitioned by ingest
    date, with per-entity totals of the rows beside them (``_totals``).

    With ``dedup`` (a delay) an event is left out of the entities when this
    query has landed its ``event_id`` on an event day within the delay; a late
    event that comes for the first time is landed, however late.  The landed
    ids are kept in few sorted runs (``_ids``, see ``idstore``).  No folder is
    listed that grows with the number of micro-batches.

    foreachBatch is at-least-once; a replayed batch rewrites exactly the
    partitions of its ``batch_id`` (dynamic overwrite).  That id is negative
    and made of the query's permanent id and the micro-batch number, so
    streams and landed batches never share a partition, nor do two
    checkpoints.  The consume time comes with the rows (the micro-batch's
    own time, the same on a replay), so a replay lands in the same folder.
    The stream is computed once: what follows reads the raw record.
    """
    def put(rows: DataFrame, name: str, fmt: str, *by: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).format(fmt).save(f"{root}/{name}"))

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        number_of = -(run_number(spark, checkpoint) * (1 << 31) + number + 1)
        tag = F.lit(number_of).cast("long").alias("batch_id")
        put(batch.select("entity", "raw", F.col("consumed_at").cast("string").alias("consumed_at"), tag),
            "_raw", "json", "batch_id")
        landed = spark.read.schema(RAW_SCHEMA).json(f"{root}/_raw/batch_id={number_of}")
        decoded = decode_events(landed.select(
            F.col("raw").alias("value"), F.concat(F.lit(TOPIC_PREFIX), "entity").alias("topic"),
            F.col("consumed_at").cast("timestamp_ntz").alias("consumed_at")), keep=("consumed_at",))
        if dedup:
            # this query's earlier batches: a replay must not meet its own ids
            run = run_number(spark, checkpoint)
            ids = LandedIds(spark, f"{root}/_ids/{run}")
            first, path = first_time(decoded, ids.before(number), dedup, event_time), f"{root}/_first/{run}"
            first.write.mode("overwrite").parquet(path)  # one micro-batch at a time
            decoded = spark.read.schema(first.schema).parquet(path)
            ids.add(decoded, number)
        for e in ENTITIES:
            rows = to_bronze(decoded, e, consumed_at=F.col("consumed_at"))
            put(rows.select("*", tag).hint("rebalance", *PARTITIONS), e, "parquet", *PARTITIONS, "batch_id")
            if number == 0:  # all micro-batches have the columns of the first
                schema_log.record(spark, f"{root}/{e}", rows.schema, number_of)
        put(decoded.groupBy("entity").agg(F.count(F.lit(1)).alias("rows")).select("*", tag).coalesce(1),
            "_totals", "parquet", "batch_id")
    return write


def stream_to_bronze_lake(messages: DataFrame, root: str, checkpoint: str,
                          every: str | None = None, dedup: str | None = None):
    """K4: messages -> bronze entities.  With ``every`` the query keeps
    running (flush per trigger, e.g. "1 second") and is returned; otherwise
    it drains the source and the bronze root is returned.  ``dedup`` (a
    delay) leaves re-sent events out of the entities; ``_raw`` has every
    message.  Late events that come for the first time are landed.  Messages
    that ``stream_quarantine`` takes are left out."""
    decoded = good_messages(decode_events(messages))
    # in a streaming plan this is the micro-batch's time, kept with its offsets
    decoded = decoded.withColumn("consumed_at", F.current_timestamp().cast("timestamp_ntz"))
    q = _run(decoded.writeStream.foreachBatch(bronze_batch_writer(root, checkpoint, dedup))
             .option("checkpointLocation", checkpoint), every=every)
    return q if every else root


def raw_events(spark: SparkSession, root: str) -> DataFrame:
    """The raw record of all bronze writers on ``root``, each message as a VARIANT
    too: ``(entity, raw, consumed_at, batch_id, event)``.  Fields that no
    schema knows can be asked for, ``try_variant_get(event, '$.name', 'string')``;
    a message that is no JSON has a null ``event``."""
    rows = read_or_empty(spark, f"{root}/_raw", RAW_SCHEMA + ", batch_id bigint", "json")
    return rows.withColumn("event", F.try_parse_json("raw"))


def stream_totals(spark: SparkSession, root: str) -> DataFrame:
    """Running totals of all bronze writers on ``root``: ``(entity, batches, rows)``.
    Written batch by batch, so they are complete over any number of batches
    and restarts, and a replayed batch counts once."""
    rows = read_or_empty(spark, f"{root}/_totals", TOTALS_SCHEMA)
    return rows.groupBy("entity").agg(F.count_distinct("batch_id").alias("batches"), F.sum("rows").alias("rows"))
