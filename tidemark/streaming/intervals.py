"""J4 on streams: reactions meet their posts while both are still arriving.

A reaction is in time when its post exists and ``post_date <= reaction <=
post_date + longest``.  Both sides carry a watermark, and the interval bounds
the state of the join: a reaction waits until the watermark shows that no post
of its interval can come any more, a post until no reaction of its interval
can.  Reactions that waited in vain come out with a null ``post_date``: they
lie before their post, too long after it, or have none.

Defined results: reactions without a time or a post id are not judged (the
batch check leaves them out too); a post without a date is none; a reaction
comes out once for each of its post's rows in the interval (silver has one);
rows behind the watermark are left out (``late.split_late`` keeps them); the
watermark is that of the slower side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOUND = "event_id string, post_id string, event_time timestamp, post_date timestamp"


def judged(events: DataFrame, event_id: str, ts: str) -> DataFrame:
    """``(event_id, post_id, event_time)`` of the reactions that can be judged."""
    return (events.select(F.col(event_id).alias("event_id"), "post_id", F.col(ts).cast("timestamp").alias("event_time"))
            .where("post_id IS NOT NULL AND event_time IS NOT NULL"))


def dated(posts: DataFrame) -> DataFrame:
    return (posts.select(F.col("post_id").alias("of_post"), F.col("post_date").cast("timestamp").alias("post_date"))
            .where("of_post IS NOT NULL AND post_date IS NOT NULL"))


def interval_join(events: DataFrame, posts: DataFrame, longest: str, delay: str = "10 minutes") -> DataFrame:
    """``FOUND`` rows of ``judged`` events and ``dated`` posts, both streams (or
    both tables: then every reaction comes out at once)."""
    left, right = events.withWatermark("event_time", delay), posts.withWatermark("post_date", delay)
    within = ((F.col("post_id") == F.col("of_post")) & (F.col("event_time") >= F.col("post_date"))
              & (F.col("event_time") <= F.col("post_date") + F.expr(f"INTERVAL {longest}")))
    return left.join(right, within, "left_outer").select("event_id", "post_id", "event_time", "post_date")


def stream_interval_check(events: DataFrame, posts: DataFrame, sink: str, checkpoint: str, longest: str = "30 days",
                          delay: str = "10 minutes", every: str | None = None):
    """Run ``interval_join`` into Parquet at ``sink``.  With ``every`` the running
    query is returned, else the sink's rows once the sources are drained."""
    writer = (interval_join(events, posts, longest, delay).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", sink))
    if every:
        return writer.trigger(processingTime=every).start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return events.sparkSession.read.schema(FOUND).parquet(sink)
