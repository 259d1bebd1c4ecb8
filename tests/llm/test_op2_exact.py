import hashlib
import os
import subprocess
import sys

from pyspark.sql import functions as F

from tidemark.llm import op2_exact
from tests.llm.conftest import ODD, documents

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def norm(t):
    return "".join(ch for ch in (t or "") if ch not in WHITE)


def test_odd_rows(spark, odd, none):
    rows = op2_exact.exact_dedup(odd).collect()
    assert len(rows) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(norm(t), []).append((i, t))
    for r in rows:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        members = groups[text]
        best = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        assert (r["group_size"], r["keep_id"]) == (len(members), best[0])
    assert sum(r["kept"] for r in rows) == len(groups)
    assert op2_exact.exact_dedup(none).collect() == []


def test_longest_then_smallest_stays(spark):
    docs = documents(spark, ["a b", "ab", "a  b", "a\tb ", "c"])
    rows = {r["doc_id"]: r for r in op2_exact.exact_dedup(docs).collect()}
    assert [rows[i]["kept"] for i in range(5)] == [False, False, True, False, True]
    assert {rows[i]["keep_id"] for i in range(4)} == {2}


def test_later_batches_and_a_repeated_batch(spark):
    index = op2_exact.DigestIndex(spark, buckets=4)
    first = index.dedup(documents(spark, ["x", "y", "x "]), "one").collect()
    assert {r["doc_id"] for r in first if r["kept"]} == {1, 2}
    second = spark.createDataFrame([(10, "x"), (11, "z"), (12, "z")], "doc_id long, text string")
    for _ in range(2):  # the second run stands for one after a crash
        rows = {r["doc_id"]: r for r in index.dedup(second, "two").collect()}
        assert [rows[i]["kept"] for i in (10, 11, 12)] == [False, True, False]
        assert rows[10]["keep_id"] == 2
    assert index.rows().count() == 3


def test_many_copies_and_bucketed_plan(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    out = op2_exact.exact_dedup(docs)
    assert out.where("kept").count() == 5000 - 1667 + 1
    assert out.where("keep_id = 0").count() == 1667


def test_index_is_bucketed_and_sorted(spark):
    index = op2_exact.DigestIndex(spark, buckets=4)
    index.dedup(documents(spark, ["x", "y"]))
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {index.name}").collect()}
    assert about["Num Buckets"] == "4" and "digest" in about["Bucket Columns"] and "digest" in about["Sort Columns"]


def test_index_outlives_the_catalog_and_other_partitions(spark, tmp_dir):
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), (F.col("id") % 700).cast("string").alias("text"))
    op2_exact.DigestIndex(spark, "outlives", f"{tmp_dir}/index", buckets=4).dedup(docs.repartition(3), "one").collect()
    spark.sql("DROP TABLE outlives")  # as a new session, which knows no table
    index = op2_exact.DigestIndex(spark, "outlives", f"{tmp_dir}/index", buckets=9)
    assert index.buckets == 4 and index.rows().count() == 700
    again = index.dedup(docs.repartition(7), "one")  # the same batch, dealt otherwise
    assert sorted(r["doc_id"] for r in again.where("kept").collect()) == list(range(700))
    assert {r["group_size"] for r in again.where("keep_id < 100").collect()} == {3}
    other = index.dedup(docs.limit(50), "two")
    assert other.where("kept").count() == 0 and index.rows().count() == 700


RUN = """
import sys
from tidemark.llm.op2_exact import DigestIndex
from tidemark.session import build_session
spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": sys.argv[1]})
docs = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string")
found = DigestIndex(spark, "kept_index").dedup(docs, sys.argv[2])
print("KEPT", found.where("kept").count())
"""


def test_index_outlives_its_session(tmp_path):
    kept = []
    for batch in ("one", "two", "one"):
        out = subprocess.run([sys.executable, "-c", RUN, f"file://{tmp_path}/shared", batch], capture_output=True, text=True, cwd=tmp_path,
                             env={**os.environ, "PYTHONPATH": ":".join(sys.path)}, timeout=300)
        kept.append(out.stdout.split("KEPT")[-1].strip())
    assert kept == ["50", "0", "50"], out.stderr[-2000:]
