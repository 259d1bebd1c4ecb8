"""Tombstones, dedup, marts on hand-made rows, and invariants on sf0.001."""

from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by_key
from tidemark.plans import gold, silver
from tidemark.sources import adapter
from tests.conftest import SF_SMALL

AS_OF = "2002-01-01 00:00:00"


def _posts(spark, rows):
    cols = ("post_id string, user_id string, content string, post_type string, language string, "
            "media_url string, hashtags string, hashtag_count long, like_count long, "
            "comment_count long, repost_count long, view_count long, raw_engagement_score double, "
            "is_viral boolean, is_deleted boolean, is_nsfw boolean, geo_country string, "
            "post_date timestamp_ntz, ingested_at timestamp_ntz, source_system string")
    return spark.createDataFrame(rows, cols)


def _p(pid, ing, deleted, likes=1, views=10, tags="[]", n=0, user="u1", day="2024-01-01 10:00:00"):
    from datetime import datetime
    return (pid, user, " c ", "Text", "EN", None, tags, n, likes, 0, 0, views, 0.5, False,
            deleted, False, None, datetime.fromisoformat(day), datetime.fromisoformat(ing), "t")


def test_tombstone_newest_wins_null_deleted(spark):
    df = _posts(spark, [
        _p("a", "2024-01-01 00:00:00", False), _p("a", "2024-01-02 00:00:00", True),   # tombstone
        _p("b", "2024-01-01 00:00:00", False, likes=1), _p("b", "2024-01-02 00:00:00", False, likes=2),
        _p("c", "2024-01-01 00:00:00", None),                                             # NULL deleted
    ])
    out = silver.stage_posts(df, AS_OF).select("post_id", "like_count").collect()
    assert [(r[0], r[1]) for r in out] == [("b", 2)]


def test_latest_by_key_idempotent(spark):
    df = adapter.bronze_posts(spark, SF_SMALL)
    once = latest_by_key(df, "post_id", "ingested_at")
    twice = latest_by_key(once, "post_id", "ingested_at")
    assert once.count() == twice.count() == df.select("post_id").distinct().count()


def test_repeated_tag_counts_post_once_sums_twice(spark):
    df = silver.stage_posts(_posts(spark, [_p("a", "2024-01-01 00:00:00", False, likes=3,
                                             tags='["x", "x"]', n=2)]), AS_OF)
    r = gold.hashtag_performance(df, AS_OF).first()
    assert (r["hashtag"], r["total_posts"], r["total_likes"]) == ("x", 1, 6)


def test_user_without_posts_and_single_day_user(spark):
    users = spark.createDataFrame(
        [("u1", "n1", "d", "l", "news", "nano", False, 1000, 3, 5),
         ("u2", "n2", "d", "l", "news", "nano", False, 1000, 3, 5)],
        "user_id string, username string, display_name string, location string, account_type string, "
        "influencer_tier string, is_verified boolean, follower_count int, following_count int, "
        "account_age_days long")
    posts = silver.stage_posts(_posts(spark, [
        _p("a", "2024-01-01 00:00:00", False, day="2024-01-01 01:00:00"),
        _p("b", "2024-01-01 00:00:00", False, day="2024-01-01 20:00:00")]), AS_OF)
    out = {r["user_id"]: r for r in gold.user_performance(users, posts, AS_OF).collect()}
    assert out["u2"]["total_posts"] == 0 and out["u2"]["total_likes_received"] is None
    assert out["u2"]["first_post_date"] is None and out["u2"]["viral_posts"] == 0
    assert out["u1"]["active_days_span"] == 0 and out["u1"]["posts_per_day"] is None


def test_duplicated_user_row_doubles_sums_like_the_join(spark):
    users = spark.createDataFrame(
        [("u1", "n1", "d", "l", "news", "nano", False, 1000, 3, 5)] * 2,
        "user_id string, username string, display_name string, location string, account_type string, "
        "influencer_tier string, is_verified boolean, follower_count int, following_count int, "
        "account_age_days long")
    posts = silver.stage_posts(_posts(spark, [_p("a", "2024-01-01 00:00:00", False, likes=4)]), AS_OF)
    r = gold.user_performance(users, posts, AS_OF).first()
    assert (r["total_posts"], r["total_likes_received"]) == (1, 8)


def test_invariants_on_small_scale(spark):
    from tidemark.operators.unnest import explode_json_tags
    posts = silver.stage_posts(adapter.bronze_posts(spark, SF_SMALL), AS_OF)
    users = silver.stage_users(adapter.bronze_users(spark, SF_SMALL), AS_OF)
    daily = gold.daily_engagement(posts, AS_OF)
    mart = gold.user_performance(users, posts, AS_OF)
    total = posts.agg(F.sum("like_count")).first()[0]
    assert daily.agg(F.sum("total_likes")).first()[0] == total
    # each user row receives its posts' likes: orphans none, a user id that comes twice twice
    joined = users.select("user_id").join(posts.select("user_id", "like_count"), "user_id")
    assert mart.agg(F.sum("total_likes_received")).first()[0] == joined.agg(F.sum("like_count")).first()[0]
    per_tier = posts.groupBy("engagement_tier").agg(F.count("*").alias("n")).agg(F.sum("n")).first()[0]
    assert per_tier == posts.count()
    tag_rows = explode_json_tags(posts).count()
    sizes = posts.where("hashtag_count > 0").agg(F.sum(F.size(F.from_json("hashtags", "array<string>")))).first()[0]
    assert tag_rows == sizes


def test_report_daily_takes_oldest_days_as_text(spark):
    from datetime import datetime, timedelta
    from tidemark.plans.reports import report_daily
    rows = [(datetime(2024, 1, 1) + timedelta(days=i), 1, 2, 0, 12.34565) for i in range(40)]
    daily = spark.createDataFrame(rows, "date timestamp_ntz, total_posts long, total_likes long, "
                                        "viral_posts long, platform_engagement_rate double")
    out = [r["date"] for r in report_daily(daily, 30).collect()]
    assert len(out) == 30 and out[0] == "2024-01-01 00:00:00" and out[-1] == "2024-01-30 00:00:00"


def test_report_users_nulls_last_and_unique_ties(spark):
    from tidemark.plans.reports import report_users
    mart = spark.createDataFrame(
        [("u3", "c", "nano", 1, None, 0), ("u2", "b", "nano", 1, 5, 0), ("u1", "a", "nano", 1, 5, 0),
         ("u4", "d", "nano", 1, 9, 1)],
        "user_id string, username string, influencer_tier string, total_posts long, "
        "total_likes_received long, viral_posts long")
    got = [(r["rank"], r["username"]) for r in report_users(mart, 4).collect()]
    assert got == [(1, "d"), (2, "a"), (3, "b"), (4, "c")]


def test_top_tags_split_counts_leading_space_separately(spark):
    from tidemark.plans.reports import top_tags_split
    posts = spark.createDataFrame([('["a", "b"]', 2), ('["b"]', 1), ('[]', 0)],
                                  "hashtags string, hashtag_count int")
    got = {r["hashtag_tag"]: r["post_count"] for r in top_tags_split(posts).collect()}
    assert got == {"a": 1, " b": 1, "b": 1}


def test_hashtag_mart_repeated_and_null_tags(spark):
    rows = [("p1", "2024-01-01", 10, 0, 0, 100, 10.0, True, '["a", "a", null]', 3),
            ("p2", "2024-01-02", 5, 1, 0, 50, None, False, '["a", "b", null, null]', 4),
            ("p3", "2024-01-03", 7, 0, 0, 70, 10.0, True, '[]', 0)]
    posts = spark.createDataFrame(rows, "post_id string, post_day string, like_count int, comment_count int, "
                                  "repost_count int, view_count int, engagement_score double, is_viral boolean, "
                                  "hashtags string, hashtag_count int")
    for unique in (True, False):
        got = {r["hashtag"]: r for r in gold.hashtag_performance(posts, AS_OF, unique_posts=unique).collect()}
        assert set(got) == {"a", "b", None}
        a, b, none = got["a"], got["b"], got[None]
        assert (a["total_posts"], a["total_likes"], a["viral_posts"], a["avg_engagement"]) == (2, 25, 2, 10.0)
        assert (b["total_posts"], b["total_likes"], b["avg_engagement"], b["viral_posts"]) == (1, 5, None, 0)
        assert (none["total_posts"], none["total_likes"], none["viral_posts"]) == (2, 20, 1)
        assert a["trending_score"] == round((20 + 7) / 2, 2)


def test_hashtag_mart_has_one_shuffle(spark):
    posts = silver.stage_posts(adapter.bronze_posts(spark, SF_SMALL), AS_OF)
    count = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("count(distinct")
    assert count(gold.hashtag_performance(posts, AS_OF, ordered=False)) == 0
