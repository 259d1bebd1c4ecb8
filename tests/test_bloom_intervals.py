"""Bloom-filtered anti joins and the interval join of two streams."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bloom
from tidemark.operators.joins import orphans, orphans_prefiltered
from tidemark.session import scratch_path
from tidemark.streaming import intervals


def test_filter_holds_its_keys_and_few_others(spark):
    keys = spark.range(0, 40_000, 2).select(F.col("id").cast("string").alias("k"))
    words = bloom.words_for(20_000)
    held = bloom.build(keys, "k", words).scalar()
    probe = spark.range(40_000).select("id", bloom.maybe(held, F.col("id").cast("string"), words).alias("m"))
    n = {r["odd"]: r["n"] for r in probe.groupBy((F.col("id") % 2).alias("odd")).agg(F.count_if("m").alias("n")).collect()}
    assert n[0] == 20_000 and n[1] < 600
    assert spark.range(1).select(bloom.maybe(held, F.lit(None).cast("string"), words).alias("m")).first()["m"] is None
    empty = bloom.build(keys.limit(0), "k", 3).first()["filter"]
    assert empty == [0, 0, 0] and bloom.words_for(0) == 1 and bloom.words_for(1 << 40) == bloom.MAX_WORDS
    with pytest.raises(ValueError):
        bloom.build(keys, "k", bloom.MAX_WORDS + 1)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("expected", [None, 1])  # 1: a filter far too small stays exact
def test_prefiltered_orphans_are_the_orphans(spark, expected):
    # a third of the children have one key without a parent, some have none, some keys are null
    child = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "gone").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("k"), "id")
    parent = spark.range(0, 30_000, 2).select(F.col("id").cast("string").alias("k"))
    parent = parent.unionByName(parent.limit(5)).unionByName(spark.createDataFrame([(None,)], "k string"))
    assert same(orphans_prefiltered(child, "k", parent, expected=expected), orphans(child, "k", parent))
    assert same(orphans_prefiltered(child, "k", parent.limit(0)), orphans(child, "k", parent.limit(0)))
    assert orphans_prefiltered(child.limit(0), "k", parent).count() == 0


def test_sure_orphans_are_not_shuffled(spark):
    spark.range(60_000).select(F.concat(F.lit("c"), "id").alias("k"), "id").write.parquet(a := scratch_path(spark, "child"))
    spark.range(500).select(F.concat(F.lit("c"), F.col("id") * 7).alias("k")).write.parquet(b := scratch_path(spark, "parent"))
    child, parent = spark.read.parquet(a), spark.read.parquet(b)
    words = bloom.words_for(parent.count())
    held = bloom.build(parent, "k", words).scalar()
    unsure = child.where(bloom.maybe(held, F.col("k"), words))
    assert 500 <= unsure.count() < 3_000  # of 60,000 rows these reach the join
    plan = orphans_prefiltered(child, "k", parent)._jdf.queryExecution().optimizedPlan().toString()
    sure, rest = plan.split("LeftAnti")[0], plan.split("LeftAnti")[1]
    assert sure.startswith("Union") and "Filter" in sure and "scalar-subquery" in rest


def drop(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)


LIKE, POST = "event_id string, post_id string, at string", "post_id string, post_date string"


def streams(spark, likes, posts):
    read = lambda schema, path: spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)
    return intervals.judged(read(LIKE, likes), "event_id", "at"), intervals.dated(read(POST, posts))


def test_interval_join_equals_the_batch_join_over_a_restart(spark):
    likes, posts, sink, ck = (scratch_path(spark, x) for x in ("likes", "posts", "out", "ck"))
    kw = dict(longest="1 hour", delay="5 minutes")
    drop(spark, posts, [("p1", "2024-01-01 10:00:00"), ("p2", "2024-01-01 10:30:00"), (None, "2024-01-01 10:30:00"), ("p9", None)], POST)
    drop(spark, likes, [("in", "p1", "2024-01-01 10:00:00"), ("edge", "p1", "2024-01-01 11:00:00"),
                        ("before", "p2", "2024-01-01 10:29:59"), ("none", "px", "2024-01-01 10:31:00"),
                        ("null", None, "2024-01-01 10:31:00"), ("no time", "p1", None), ("undated", "p9", "2024-01-01 10:31:00")], LIKE)
    first = intervals.stream_interval_check(*streams(spark, likes, posts), sink, ck, **kw)
    assert {r["event_id"] for r in first.collect()} == {"in", "edge"}  # the others wait for their posts
    # after a restart: a post that comes after its like, and rows that close all others
    drop(spark, posts, [("p3", "2024-01-01 10:40:00")], POST)
    drop(spark, likes, [("waited", "p3", "2024-01-01 11:10:00"), ("late", "p1", "2024-01-01 11:00:01")], LIKE)
    drop(spark, posts, [("z", "2024-01-02 00:00:00")], POST)
    drop(spark, likes, [("z", "none", "2024-01-02 00:00:00")], LIKE)
    found = intervals.stream_interval_check(*streams(spark, likes, posts), sink, ck, **kw)
    batch = intervals.interval_join(intervals.judged(spark.read.parquet(likes), "event_id", "at"),
                                    intervals.dated(spark.read.parquet(posts)), **kw).where("event_id <> 'z'")
    assert same(found, batch)
    assert {r["event_id"]: r["post_date"] is not None for r in found.collect()} == {
        "in": True, "edge": True, "before": False, "none": False, "undated": False, "waited": True, "late": False}
    # the state keeps the closing rows only
    state = spark.read.format("statestore").option("path", ck).option("joinSide", "left").load()
    assert {r["value"]["event_id"] for r in state.select("value").collect()} == {"z"}
