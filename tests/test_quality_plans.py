"""Quality checks (pass and fail fixtures) and physical-plan properties."""

from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by_key
from tidemark.operators.joins import orphans
from tidemark.plans import gold, quality, silver
from tidemark.sources import adapter
from tests.conftest import SF_SMALL


def _report(spark, rows_spec, df, **kw):
    tc = quality.TableChecks("silver", "t", df, rows=rows_spec, **kw)
    return {(r["check"], r["column"]): (r["failing_rows"], r["passed"])
            for r in quality.table_report(tc).collect()}


def test_row_checks_pass_and_fail(spark):
    good = spark.createDataFrame([("a", "news"), ("b", None)], "id string, kind string")
    bad = spark.createDataFrame([("a", "blog"), (None, "news")], "id string, kind string")
    spec = [quality.not_null("id"), quality.accepted_values("kind", ("news",)), quality.non_empty()]
    g = _report(spark, spec, good)
    b = _report(spark, spec, bad)
    assert g[("not_null", "id")] == (0, True) and b[("not_null", "id")] == (1, False)
    assert g[("accepted_values", "kind")] == (0, True)          # NULL passes
    assert b[("accepted_values", "kind")] == (1, False)
    assert g[("non_empty", "*")] == (0, True)
    empty = _report(spark, spec, good.limit(0))
    assert empty[("non_empty", "*")] == (1, False)


def test_unique_duplicates_relationships(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("z",)], "id string")
    parent = spark.createDataFrame([("a",)], "id string")
    r = _report(spark, [], df, unique=["id"], duplicates=["id"],
                relationships=[("id", parent, "id")])
    assert r[("unique", "id")] == (1, False)          # NULLs ignored
    assert r[("duplicates", "id")] == (2, False)      # NULL group counted
    assert r[("relationships", "id")] == (1, False)   # only 'z'; NULLs are not orphans
    ok = _report(spark, [], parent, unique=["id"])
    assert ok[("unique", "id")] == (0, True)


def test_gate_raises_on_failure(spark):
    df = spark.createDataFrame([(None,)], "id string")
    rep = quality.table_report(quality.TableChecks("silver", "t", df, rows=[quality.not_null("id")]))
    try:
        quality.quality_gate(rep)
    except AssertionError as e:
        assert "t.id:not_null" in str(e)
    else:
        raise AssertionError("gate did not fail")


def test_orphans_anti_join(spark):
    child = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "id string, p string")
    parent = spark.createDataFrame([("a",), ("a",)], "p string")
    assert [r[0] for r in orphans(child, "p", parent).select("id").collect()] == ["2"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_shuffle(spark):
    df = adapter.bronze_posts(spark, SF_SMALL)
    plan = latest_by_key(df, "post_id", "ingested_at")._jdf.queryExecution().sparkPlan().toString()
    i_partial = plan.find("Partial")
    assert "WindowGroupLimit" in plan and i_partial > 0


def test_delete_filter_stays_above_window(spark):
    plan = silver.stage_posts(adapter.bronze_posts(spark, SF_SMALL))._jdf.queryExecution() \
        .optimizedPlan().toString()
    w = plan.find("Window ")
    f = plan.find("is_deleted")
    assert 0 <= f < w, "is_deleted must be evaluated after (above) the dedup window"


def test_scan_prunes_columns(spark):
    df = adapter.bronze_posts(spark, SF_SMALL)
    mart = gold.hashtag_performance(silver.stage_posts(df), ordered=False)
    plan = _plan(mart)
    assert "o_totalprice" not in plan and "l_extendedprice" not in plan


def test_daily_mart_single_distinct_no_expand(spark):
    posts = silver.stage_posts(adapter.bronze_posts(spark, SF_SMALL))
    assert "Expand" not in _plan(gold.daily_engagement(posts, ordered=False))


def test_salted_join_is_exact_and_spreads_hot_key(spark):
    from tidemark.operators.joins import hot_keys, salted_join
    big = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").alias("v"))
    small = spark.createDataFrame([("hot", 1)] + [(str(i), i) for i in range(50)], "k2 string, w int")
    hot = hot_keys(big, "k", share=0.05, sample=0.2)
    assert hot == ["hot"]
    plain = big.join(small, big.k == small.k2, "inner")
    salted = salted_join(big, small, "k", "k2", "inner", buckets=8, hot=hot)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    anti = salted_join(big, small.where("k2 <> 'hot'"), "k", "k2", "left_anti", buckets=8, hot=hot)
    assert anti.count() == big.where("k = 'hot'").count()
    # in a shuffle join the hot key's rows are spread over several tasks
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        per_task = (salted_join(big, small, "k", "k2", "inner", buckets=8, hot=hot)
                    .where("k = 'hot'").groupBy(F.spark_partition_id()).count().count())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert per_task > 1


def test_quarantine_bad_casts(spark):
    from tidemark.plans.silver import quarantine_bad_casts
    df = spark.createDataFrame([("1", "2024-01-01T10:00:00"), ("x", "2024-01-01"), ("3", "nope"),
                                (None, None)], "n string, t string")
    good, bad = quarantine_bad_casts(df, {"n": "int", "t": "timestamp_ntz"})
    assert good.count() == 2
    assert sorted(tuple(r["bad_columns"]) for r in bad.collect()) == [("n",), ("t",)]


def test_fractional_counter_rounds_like_reference(spark):
    from tidemark.plans.silver import _to_int
    df = spark.createDataFrame([(2.5,), (2.4,), (-2.5,)], "c double")
    assert [r[0] for r in df.select(_to_int(df, "c")).collect()] == [3, 2, -3]


def test_user_mart_has_no_exchange_before_partial_agg(spark):
    posts = silver.stage_posts(adapter.bronze_posts(spark, SF_SMALL))
    users = silver.stage_users(adapter.bronze_users(spark, SF_SMALL))
    plan = gold.user_performance(users, posts)._jdf.queryExecution().sparkPlan().toString()
    assert "RepartitionByExpression" not in plan


def test_entry_module_imports_without_a_session():
    import subprocess
    import sys
    root = __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__)))
    code = ("import __spark_entry__ as E; q = E.queries(); o = E.oracle_sql(); "
            "assert len(q) >= 80 and set(o) <= set(q), (len(q), len(o))")
    r = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]


def test_orphan_join_splits_a_hot_key(spark):
    from tidemark.operators.joins import orphans
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        child = (spark.range(0, 300000, 1, 8)
                 .select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("k"),
                         F.sha2(F.col("id").cast("string"), 256).alias("payload")))
        parent = spark.range(0, 300000, 2).select(F.col("id").cast("string").alias("k"))
        out = orphans(child, "k", parent)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 100000 + sum(1 for i in range(300000) if i % 3 and i % 2)
    assert "skew=true" in plan


def test_windows_expand_behind_the_exchange(spark):
    from tidemark.streaming.windows import windowed_counts
    f = adapter.feed_events(spark, SF_SMALL).where(F.col("entity") == "likes")
    plan = windowed_counts(f, "_ts", ["reaction_type"])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    # the second one deals panes by (key, stretch); no exchange is keyed by window
    assert "__s" in exchanges[0] and not any(" w#" in line for line in exchanges)


def test_gate_names_every_failure_and_summary_counts(spark):
    from tidemark.plans.quality import quality_gate, quality_summary
    rows = [("gold", "t", "not_null", f"c{i}", i % 9, i % 9 == 0) for i in range(20)]
    report = spark.createDataFrame(rows, "layer string, table string, check string, column string, "
                                         "failing_rows int, passed boolean")
    try:
        quality_gate(report)
        raise RuntimeError("no failure")
    except AssertionError as e:
        assert str(e).count("not_null") == 17 and str(e).startswith("17 ")
    assert tuple(quality_summary(report).first()) == (3, 17, 20, False)
    quality_gate(report.where("passed"))


def test_each_kind_of_check_finds_something(spark):
    from tidemark.plans.registry import all_queries
    found = {}
    for r in all_queries()["quality_report"].build(spark, SF_SMALL).collect():
        found[r["check"]] = found.get(r["check"], 0) + r["failing_rows"]
    for kind in ("unique", "not_null", "accepted_values", "relationships", "duplicates", "non_negative", "enum"):
        assert found[kind] > 0, kind
    flags = {r["dq_flag"] for r in all_queries()["dq_flag_summary"].build(spark, SF_SMALL).collect()}
    assert len(flags) == 3
