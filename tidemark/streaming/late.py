"""T4: late events go to a side sink, counted, instead of vanishing.

A stream is split in two by event time.  An event is late when it lies behind
the watermark that held when its micro-batch began: the newest event time of
all earlier micro-batches less the delay (as the engine's own watermark).
The split writes both sides and a progress record for each micro-batch, with
the watermark and the counts, so every event is in one of the two sinks:
on time + late = input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files
from tidemark.sources.bronze import read_or_empty

PROGRESS_SCHEMA = "number long, watermark timestamp, newest timestamp, on_time long, late long"


def late_splitter(root: str, delay: str, ts: str = "event_time"):
    """``foreachBatch`` body: ``events/late=.../number=...`` and ``progress/number=...`` under ``root``.

    A micro-batch takes its watermark from the record of the one before, so a
    replay splits the same way and replaces its own folders.  Events without a
    time are on time; the first micro-batch has no watermark and no late events.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = None
        if number:
            last = spark.read.schema(PROGRESS_SCHEMA).json(f"{root}/progress/number={number - 1}").first()
        mark = F.lit(last["newest"] if last else None).cast("timestamp") - F.expr(f"INTERVAL '{delay}'")
        late = F.coalesce(F.col(ts) < mark, F.lit(False))
        for side in (False, True):  # a replay may leave one of them empty
            files.remove(spark, f"{root}/events/late={str(side).lower()}/number={number}")
        (batch.withColumn("late", late).withColumn("number", F.lit(number).cast("long"))
         .write.mode("append").partitionBy("late", "number").parquet(f"{root}/events"))
        own = _events(spark, root, batch.schema.simpleString(), number)
        done = own.agg(F.max(ts).alias("newest"), F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"))
        newest = F.greatest(F.col("newest"), F.lit(last["newest"] if last else None).cast("timestamp"))
        (done.select(F.lit(number).cast("long").alias("number"), mark.alias("watermark"), newest.alias("newest"), "on_time", "late")
         .coalesce(1).write.mode("overwrite").json(f"{root}/progress/number={number}"))
    return write


def _events(spark: SparkSession, root: str, struct: str, number: int | None = None) -> DataFrame:
    """The split events; of one micro-batch without listing the others."""
    schema = f"{struct.removeprefix('struct<').removesuffix('>')},late:boolean,number:bigint".replace(":", " ")
    where = [f"{root}/events"] if number is None else [f"{root}/events/late={s}/number={number}" for s in ("false", "true")]
    there = [p for p in where if files.exists(spark, p)]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/events").parquet(*there)


def split_late(events: DataFrame, root: str, checkpoint: str, delay: str, ts: str = "event_time",
               every: str | None = None):
    """Split a stream of events with a ``ts`` column.  With ``every`` the running
    query is returned; else the source is drained and both sides are: (on time, late)."""
    writer = events.writeStream.foreachBatch(late_splitter(root, delay, ts)).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    writer.trigger(availableNow=True).start().awaitTermination()
    both = _events(events.sparkSession, root, events.schema.simpleString())
    return both.where(~F.col("late")).drop("late"), both.where("late").drop("late")


def watermarks(spark: SparkSession, root: str) -> DataFrame:
    """Per micro-batch: the watermark it was split by, the newest event time so far, and the counts."""
    return read_or_empty(spark, f"{root}/progress", PROGRESS_SCHEMA, "json")
