import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.operators import sample as S

SCHEMA = "key string, a int, b string"


def rows(seed, n=400):
    rnd = random.Random(seed)
    out = [(rnd.choice(["x", "x", "x", "y", None]), rnd.randrange(1000), rnd.choice(["p", "q", None])) for _ in range(n)]
    return out + out[:20]  # repeated rows


def brute(data, k):
    by = defaultdict(list)
    for r in data:
        text = "\x1f".join("\\N" if x is None else str(x) for x in r)
        by[r[0]].append((hashlib.sha256(text.encode()).hexdigest(), r))
    return Counter((*r, h, len(v)) for v in by.values() for h, r in sorted(v, key=lambda x: x[0])[:k])


def got(df):
    return Counter(tuple(r) for r in df.select("key", "a", "b", S.HASH, S.ROWS).collect())


def test_equals_brute_force_whatever_the_partitions(spark):
    data = rows(1)
    for parts in (1, 7):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        assert got(S.bounded_sample(df, ["key"], 15)) == brute(data, 15)
    assert got(S.bounded_sample(df, ["key"])) == brute(data, len(data))  # no bound: every row


def test_samples_merge(spark, tmp_dir):
    a, b, c = rows(1), rows(2), rows(3, 5)
    frames = [spark.createDataFrame(x, SCHEMA) for x in (a, b, c)]
    merged = S.merge_samples([S.bounded_sample(f, ["key"], 10) for f in frames], ["key"], 10)
    assert got(merged) == brute(a + b + c, 10)
    for k in (0, 1, 2, 1):  # the second batch runs again
        S.add_batch(frames[k], f"{tmp_dir}/s", k, ["key"], 10)
    assert got(S.read_sample(spark, f"{tmp_dir}/s", ["key"], 10)) == brute(a + b + c, 10)
    assert got(S.read_sample(spark, f"{tmp_dir}/s", ["key"], 4)) == brute(a + b + c, 4)


def test_empty_and_estimates(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert S.bounded_sample(none, ["key"], 3).count() == 0
    df = spark.range(20000).select(F.lit("k").alias("key"), (F.col("id") % 4 == 0).alias("quarter"), "id")
    est = S.estimated_counts(S.bounded_sample(df, ["key"], 1000), ["key"], ["quarter"])
    found = {r["quarter"]: r["estimate"] for r in est.collect()}
    assert abs(found[True] - 5000) < 600 and abs(sum(found.values()) - 20000) < 1e-6


def test_rank_limit_is_applied_before_the_shuffle(spark):
    plan = S.bounded_sample(spark.createDataFrame(rows(1), SCHEMA), ["key"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
