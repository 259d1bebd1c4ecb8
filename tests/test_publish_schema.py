"""Schema history on read; publishing as files with a manifest."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import adapter, bronze, files, publish, schema_log
from tidemark.sources.sinks import append_partitioned, published_files
from tests.conftest import SF_SMALL


def batch(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("ingested_at", F.lit("2024-01-01T00:00:00.000000"))


def test_undeclared_columns_read_back_without_opening_files(spark, tmp_dir):
    root = f"{tmp_dir}/likes"
    append_partitioned(batch(spark, [("a", "p")], "like_id string, post_id string"), root, 1)
    append_partitioned(batch(spark, [("b", 3, 1.5)], "like_id string, weight int, geo double"), root, 2)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = bronze.read_facts(spark, tmp_dir, "likes")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # no footer job
    got = {r["like_id"]: (r["post_id"], r["weight"], r["geo"], r["batch_id"]) for r in df.collect()}
    assert got == {"a": ("p", None, None, 1), "b": (None, 3, 1.5, 2)}
    assert df.columns[-4:] == ["year", "month", "day", "batch_id"]


def test_types_widen(spark, tmp_dir):
    root = f"{tmp_dir}/likes"
    for k, (value, kind) in enumerate([(7, "int"), (1 << 40, "bigint")]):
        append_partitioned(batch(spark, [(str(k), value)], f"like_id string, weight {kind}"), root, k)
    df = bronze.read_facts(spark, tmp_dir, "likes")
    assert dict(df.dtypes)["weight"] == "bigint" and {r["weight"] for r in df.collect()} == {7, 1 << 40}
    append_partitioned(batch(spark, [("2", 0.5)], "like_id string, weight double"), root, 2)
    df = bronze.read_facts(spark, tmp_dir, "likes")
    assert dict(df.dtypes)["weight"] == "double" and {r["weight"] for r in df.collect()} == {7.0, float(1 << 40), 0.5}
    append_partitioned(batch(spark, [("3", "much")], "like_id string, weight string"), root, 3)
    assert {r["weight"] for r in bronze.read_facts(spark, tmp_dir, "likes").collect()} == {"7", str(1 << 40), "0.5", "much"}
    # the odd batch again with the old type: its record goes with it
    append_partitioned(batch(spark, [("3", 9)], "like_id string, weight int"), root, 3)
    append_partitioned(batch(spark, [("2", 8)], "like_id string, weight int"), root, 2)
    known = schema_log.recorded(spark, root)
    assert sorted(b for n in known for b in schema_log.batches_of(spark, root, n)) == [0, 1, 2, 3]


def stamps(folder):
    return {os.path.relpath(f"{d}/{x}", folder): os.stat(f"{d}/{x}").st_mtime_ns for d, _, names in os.walk(folder)
            for x in names if x.endswith(".parquet") and "_manifests" not in d}


@pytest.fixture()
def lake(spark, tmp_dir):
    likes = adapter.bronze_likes(spark, SF_SMALL, versions=(1,))
    append_partitioned(likes.withColumn("geo", F.lit("x")).withColumn("score", F.lit(1.5)), f"{tmp_dir}/lake/likes", 1)
    adapter.bronze_users(spark, SF_SMALL).coalesce(1).write.parquet(f"{tmp_dir}/lake/users")
    return f"{tmp_dir}/lake", f"{tmp_dir}/dest"


def test_publish_copies_the_difference_only(spark, lake):
    root, dest = lake
    first = publish.publish(spark, root, dest)
    assert first["version"] == 1 and first["kept"] == 0 and first["copied"] == len(stamps(dest)) > 1
    assert stamps(dest).keys() == stamps(root).keys()  # the same layout
    before = stamps(dest)
    assert publish.publish(spark, root, dest) == {"version": 2, "copied": 0, "kept": first["copied"], "removed": 0}
    assert stamps(dest) == before
    # undeclared columns are there, byte for byte
    a = bronze.read_facts(spark, root, "likes")
    b = publish.read_published(spark, dest, "likes")
    assert {"geo", "score"} <= set(b.columns) and a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()
    # a replaced batch: old files go, new ones come
    append_partitioned(adapter.bronze_likes(spark, SF_SMALL, versions=(2,)), f"{root}/likes", 1)
    third = publish.publish(spark, root, dest)
    assert third["removed"] > 0 and stamps(dest).keys() == stamps(root).keys()
    assert publish.read_published(spark, dest, "likes").count() == bronze.read_facts(spark, root, "likes").count()
    assert published_files(spark, dest).count() == len(stamps(dest))


def test_a_crash_leaves_the_old_version(spark, lake, monkeypatch):
    root, dest = lake
    publish.publish(spark, root, dest)
    rows = publish.read_published(spark, dest, "likes").count()
    append_partitioned(adapter.bronze_likes(spark, SF_SMALL, versions=(2,)), f"{root}/likes", 1)
    users = f"{root}/users/" + next(x for x in os.listdir(f"{root}/users") if x.endswith(".parquet"))
    os.utime(users, (1, 1))  # a file replaced under its own name

    def crash(spark, path, text):
        if path.endswith(publish.POINTER):
            raise RuntimeError("lost")
        return write(spark, path, text)
    write = files.write_text
    monkeypatch.setattr(files, "write_text", crash)
    with pytest.raises(RuntimeError):
        publish.publish(spark, root, dest)
    assert publish.version_of(spark, dest) == 1
    assert publish.read_published(spark, dest, "likes").count() == rows
    assert publish.read_published(spark, dest, "users").count() == spark.read.parquet(f"{root}/users").count()
    monkeypatch.undo()
    assert publish.publish(spark, root, dest)["version"] == 2  # and the next run goes through
    assert publish.read_published(spark, dest, "likes").count() == bronze.read_facts(spark, root, "likes").count()


def test_nothing_to_publish(spark, tmp_dir):
    assert publish.publish(spark, f"{tmp_dir}/none", f"{tmp_dir}/dest") == {"version": 1, "copied": 0, "kept": 0, "removed": 0}
    assert publish.read_published(spark, f"{tmp_dir}/dest", "likes").count() == 0
