"""Tables in a global order that a reader can check and use.

A table's files have no order on read, so the order is stored: an ``ordinal``
from 1 on.  Two passes over range partitions, no task sees more than its own
range: rows are dealt by ranges of the sort columns, sorted and numbered
within each range and written; the ranges' sizes, one number a partition, then
become the offsets that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: low bits of ``monotonically_increasing_id``: the row's number in its partition
_LOCAL = (1 << 33) - 1


def with_ordinal(df: DataFrame, order: list[Column], ordinal: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """``df`` with its rows numbered by ``order``; rows equal in all of it are
    numbered in any order among themselves.  An empty table stays empty."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ordered")
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    (ranged.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)).alias("__at"))
     .write.parquet(path))
    rows = spark.read.parquet(path)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each range: at most ``parts`` of them
    offsets = (rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
               .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    return (rows.join(F.broadcast(offsets), "__part")
            .select(*df.columns, (F.col("__before") + F.col("__at") + 1).alias(ordinal)))


def write_ordered(df: DataFrame, path: str, order: list[Column], ordinal: str = "ordinal") -> DataFrame:
    """Write ``df`` with its ordinal, each file sorted by it (a range of ordinals reads
    few row groups), and read it back."""
    with_ordinal(df, order, ordinal).sortWithinPartitions(ordinal).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
