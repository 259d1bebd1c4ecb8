"""Edge rows for the column builders (FIXTURES.md §4)."""

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import functions as TF
from tidemark.functions.rounding import avg_fixed


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_zero_views_scores_100_low_ok(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 0.0)], "l long, c long, r long, v long, raw double")
    out = df.select(TF.engagement_score("l", "c", "r", "v").alias("s"),
                    TF.engagement_tier("raw").alias("t"), TF.dq_flag("l", "v").alias("f"))
    assert rows(out, "s", "t", "f") == [(100.0, "low", "ok")]


def test_score_capped_at_100(spark):
    df = spark.createDataFrame([(100, 30, 15, 100)], "l long, c long, r long, v long")
    assert df.select(TF.engagement_score("l", "c", "r", "v").alias("s")).first()["s"] == 100.0


def test_tier_edges(spark):
    df = spark.createDataFrame([(5.0,), (1.0,), (0.1,), (0.0999,), (None,)], "raw double")
    assert [r[0] for r in df.select(TF.engagement_tier("raw")).collect()] == \
        ["viral", "high", "medium", "low", "low"]


def test_flag_order(spark):
    df = spark.createDataFrame([(5, -1), (-5, 0), (None, 3)], "l long, v long")
    assert [r[0] for r in df.select(TF.dq_flag("l", "v")).collect()] == \
        ["anomaly: likes exceed views", "anomaly: negative counts", "ok"]


def test_weekday_weekend_week_start(spark):
    df = spark.createDataFrame([("2024-01-06 10:00:00",), ("2024-01-07 23:59:59",),
                                ("2024-01-08 00:00:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t"))
    out = df.select(TF.day_of_week("t").alias("d"), TF.is_weekend("t").alias("w"),
                    TF.trunc_week("t").cast("string").alias("wk"),
                    TF.trunc_hour("t").cast("string").alias("h"))
    assert rows(out, "d", "w", "wk", "h") == [
        (6, True, "2024-01-01 00:00:00", "2024-01-06 10:00:00"),
        (0, True, "2024-01-01 00:00:00", "2024-01-07 23:00:00"),
        (1, False, "2024-01-08 00:00:00", "2024-01-08 00:00:00")]


def test_time_features_ignore_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # DST gap at 02:30
        got = df.select(TF.trunc_hour("t").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == "2024-03-10 02:00:00"


def test_user_tiers_ratio_email(spark):
    df = spark.createDataFrame([(f, 3) for f in (999, 1000, 9999, 10000, 100000, 1000000)]
                               + [(10, 0)], "f long, g long")
    tiers = [r[0] for r in df.select(TF.influencer_tier("f")).collect()]
    assert tiers == ["regular", "nano", "nano", "micro", "macro", "mega", "regular"]
    ratios = [r[0] for r in df.where(F.col("f") == 10).select(TF.follower_ratio("f", "g")).collect()]
    assert ratios == [None]
    r = spark.createDataFrame([(10, 3)], "f long, g long").select(TF.follower_ratio("f", "g")).first()[0]
    assert r == 3.33
    e = spark.createDataFrame([("  A@X.Com ",)], "e string").select(F.lower(F.trim("e"))).first()[0]
    assert e == "a@x.com"


def test_iso_text_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("2024-01-01T10:00:00.123456",)], "t string")
    got = [r[0] for r in df.select(TF.to_ntz("t").cast("string")).collect()]
    assert got == ["2024-01-01 10:00:00", "2024-01-01 10:00:00.123456"]


def _tags(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, h string")
    return [(r["i"], r["t"]) for r in df.select("i", F.explode(fn("h")).alias("t")).orderBy("i").collect()]


def test_json_tag_forms(spark):
    got = _tags(spark, TF.json_tags, ["[]", None, '["a"]', '["a", "b"]', '["a", null]'])
    assert [i for i, _ in got] == [2, 3, 3, 4, 4]
    assert got[-1] == (4, None) or got[-2] == (4, None)


def test_split_tags_keep_leading_space(spark):
    assert [t for _, t in _tags(spark, TF.split_tags, ['["a", "b"]'])] == ["a", " b"]


def test_lenient_tags(spark):
    got = _tags(spark, TF.lenient_tags, ['[" a ", ""]', "oops", '["x", null, "y"]', None])
    assert got == [(0, "a"), (2, "x")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=30),
       st.integers(min_value=0, max_value=4))
def test_round_matches_reference_engine(spark, xs, d):
    con = duckdb.connect()
    want = [r[0] for r in con.execute(f"SELECT round(x, {d}) FROM unnest(?::DOUBLE[]) t(x)", [xs]).fetchall()]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(TF.round_half_away("x", d)).collect()]
    assert got == want


def test_avg_fixed_is_partition_independent(spark):
    vals = [0.1844, 0.3505, 0.5686, 0.8706, 0.1394, 0.1607, 0.2027, 0.1011, 0.1073, 0.1112]
    base = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {base.repartition(n).agg(avg_fixed("x", 4, 4)).first()[0] for n in (1, 3, 7)}
    assert got == {0.2797}


def test_malformed_tags_policy(spark):
    from tidemark.operators.unnest import explode_json_tags, malformed_tag_count
    df = spark.createDataFrame([('["a"]', 1), ("oops", 1), ('{"x": 1}', 1)], "hashtags string, hashtag_count int")
    assert malformed_tag_count(df).first()[0] == 2
    assert [r["hashtag"] for r in explode_json_tags(df).collect()] == ["a"]
    with pytest.raises(Exception):
        explode_json_tags(df, fail_on_malformed=True).collect()
