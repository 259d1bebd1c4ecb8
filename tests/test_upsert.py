import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by_key
from tidemark.operators.upsert import KeyedTable
from tidemark.sources import files

DDL = "id string, text string, gone boolean, ingested_at int"
TIES = ["text", "gone"]


def rows(seed, n=200):
    rnd = random.Random(seed)
    return [(rnd.choice([None, *(f"k{i}" for i in range(40))]), f"t{rnd.randrange(5)}", rnd.random() < 0.2, rnd.choice([None, *range(6)]))
            for _ in range(n)]


def same(a, b):
    cols = ["id", "text", "gone", "ingested_at"]
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def test_equals_a_full_rebuild_in_any_order(spark, tmp_dir):
    batches = [spark.createDataFrame(rows(s), DDL) for s in (1, 2, 3)]
    every = batches[0].unionByName(batches[1]).unionByName(batches[2])
    due = latest_by_key(every.where("id IS NOT NULL"), "id", "ingested_at", TIES)
    for n, order in enumerate([(0, 1, 2), (2, 0, 1, 1, 2)]):  # repeated batches change nothing
        path = f"{tmp_dir}/t{n}"
        for k in order:
            KeyedTable(spark, path, "id", tie_break=TIES, buckets=4).merge(batches[k])  # a new object each time
        same(KeyedTable(spark, path, "id", tie_break=TIES).rows(), due)
        assert len([x for x in files.names(spark, path) if x.startswith("version=")]) <= 2
    KeyedTable(spark, path, "id", tie_break=TIES).merge(batches[0].limit(0))
    same(KeyedTable(spark, path, "id", tie_break=TIES).rows(), due)


def test_history_is_not_shuffled(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", "id", tie_break=TIES, buckets=4)
    assert table.rows() is None
    table.merge(spark.createDataFrame(rows(1), DDL))
    plan = table.merged(spark.createDataFrame(rows(2), DDL))._jdf.queryExecution().executedPlan()
    join = plan.toString().split("SortMergeJoin")[1]
    history = join[:join.index("FileScan")]
    assert "Exchange" not in history and join.count("Exchange") == 1  # the batch's own


def test_a_lost_run_leaves_the_version_before(spark, tmp_dir, monkeypatch):
    table = KeyedTable(spark, f"{tmp_dir}/t", "id", tie_break=TIES, buckets=4)
    first = spark.createDataFrame(rows(1), DDL)
    table.merge(first)
    write = files.write_text

    def lost(*a):
        raise RuntimeError("lost")
    monkeypatch.setattr(files, "write_text", lost)
    with pytest.raises(RuntimeError):
        table.merge(spark.createDataFrame(rows(2), DDL))
    monkeypatch.setattr(files, "write_text", write)
    same(table.rows(), latest_by_key(first.where("id IS NOT NULL"), "id", "ingested_at", TIES))
    assert table.merge(spark.createDataFrame(rows(2), DDL)) == 2
    with pytest.raises(ValueError):
        table.merge(first.withColumn("more", F.lit(1)))
