"""The raw record of landed batches."""

import glob

from pyspark.sql import functions as F

from tidemark.sources import bronze, sinks


def test_raw_record_is_small_files_of_whole_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sinks, "JSONL_RECORDS", 30)
    rows = spark.range(100).select(F.concat(F.lit("l"), "id").alias("like_id"), F.lit("p1").alias("post_id"),
                                   F.when(F.col("id") % 5 != 0, F.lit("wow")).alias("reaction_type"),
                                   F.lit("2024-01-01T00:00:00").alias("ingested_at"))
    sinks.append_partitioned(rows, f"{tmp_dir}/likes", 1, jsonl_root=f"{tmp_dir}/jsonl/likes")
    files = glob.glob(f"{tmp_dir}/jsonl/likes/year=2024/month=1/day=1/batch_id=1/*.json.gz")
    assert len(files) >= 4 and all(spark.read.text(f).count() <= 30 for f in files)
    back = bronze.read_jsonl(spark, f"{tmp_dir}/jsonl/likes", rows.schema)
    got = back.collect()
    assert all(r["_corrupt_record"] is None for r in got)
    assert sorted(str([r[c] for c in rows.columns]) for r in got) == sorted(str(list(r)) for r in rows.collect())
    sinks.snapshot_replace(rows, f"{tmp_dir}/users", f"{tmp_dir}/jsonl/users")
    assert spark.read.schema(rows.schema).json(f"{tmp_dir}/jsonl/users").exceptAll(rows).isEmpty()
