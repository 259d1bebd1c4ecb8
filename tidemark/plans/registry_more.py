"""Query groups beyond the core slice: column builders, tags, joins,
aggregates, reports and quality checks, each with its SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import functions as TF
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.joins import hot_keys, orphans, orphans_prefiltered, temporal_consistency
from tidemark.operators.unnest import (
    explode_json_tags, explode_split_tags, explode_tags_lenient,
)
from tidemark.plans import gold, quality, reports
from tidemark.plans.batch_run import run_batch
from tidemark.plans.oracle import AS_OF as SQL_AS_OF
from tidemark.plans.oracle import avg4, sql
from tidemark.plans.registry import (
    AS_OF, b_comments, b_likes, b_posts, b_users, register, s_comments, s_likes, s_posts,
    s_users, shared_frame,
)
from tidemark.session import scratch_path
from tidemark.sources import adapter
from tidemark.sources.lake import build_lake
from tidemark.sources.sinks import materialize_all

def pinned():
    """``as_of`` as a column (built lazily: importing needs no session)."""
    return F.lit(AS_OF).cast("timestamp_ntz")
FUTURE_AS_OF = "2025-01-01 00:00:00"


@shared_frame
def g_daily(spark, d):
    return gold.daily_engagement(s_posts(spark, d), AS_OF, ordered=False)


@shared_frame
def g_tags(spark, d):
    return gold.hashtag_performance(s_posts(spark, d), AS_OF, ordered=False)


@shared_frame
def g_users(spark, d):
    return gold.user_performance(s_users(spark, d), s_posts(spark, d), AS_OF)


# ---- column builders (P2-P5, P8-P12) and W1 --------------------------------

@register("influencer_tier", sql(
    "SELECT user_id, follower_count, influencer_tier, is_influencer FROM s_users"))
def q_influencer_tier(spark, d):
    return s_users(spark, d).select("user_id", "follower_count", "influencer_tier", "is_influencer")


@register("follower_ratio", sql(
    "SELECT user_id, follower_count, following_count, follower_ratio FROM s_users"))
def q_follower_ratio(spark, d):
    return s_users(spark, d).select("user_id", "follower_count", "following_count", "follower_ratio")


@register("account_age", sql("SELECT user_id, joined_at, account_age_days FROM s_users"))
def q_account_age(spark, d):
    return s_users(spark, d).select("user_id", "joined_at", "account_age_days")


@register("engagement_score", sql("SELECT post_id, ingested_at, engagement_score FROM measured_posts"))
def q_engagement_score(spark, d):
    return b_posts(spark, d).select("post_id", "ingested_at",
                                    TF.engagement_score().alias("engagement_score"))


@register("raw_engagement_score", sql("SELECT post_id, ingested_at, raw_score FROM measured_posts"))
def q_raw_score(spark, d):
    return b_posts(spark, d).select("post_id", "ingested_at",
                                    TF.raw_engagement_score().alias("raw_score"))


@register("engagement_tier", sql(
    "SELECT post_id, ingested_at, raw_engagement_score, engagement_tier FROM measured_posts"))
def q_engagement_tier(spark, d):
    return b_posts(spark, d).select("post_id", "ingested_at", "raw_engagement_score",
                                    TF.engagement_tier().alias("engagement_tier"))


@register("time_features", sql("""
    SELECT post_id, post_date, post_hour, post_day, post_week, post_month,
           hour_of_day, day_of_week, is_weekend FROM s_posts"""))
def q_time_features(spark, d):
    return s_posts(spark, d).select("post_id", "post_date", "post_hour", "post_day", "post_week",
                                    "post_month", "hour_of_day", "day_of_week", "is_weekend")


@register("dq_flag", sql("SELECT post_id, ingested_at, like_count, view_count, dq_flag FROM measured_posts"))
def q_dq_flag(spark, d):
    return b_posts(spark, d).select("post_id", "ingested_at", "like_count", "view_count",
                                    TF.dq_flag().alias("dq_flag"))


@register("latest_by_key", sql("SELECT post_id, ingested_at, is_deleted, like_count FROM newest_posts"))
def q_latest_by_key(spark, d):
    return latest_by_key(b_posts(spark, d), "post_id", "ingested_at", tie_break=["content"]).select(
        "post_id", "ingested_at", "is_deleted", "like_count")


# ---- tags (U1-U3) -----------------------------------------------------------

@register("explode_tags", sql("SELECT post_id, hashtag FROM g_tags_exploded"))
def q_explode_tags(spark, d):
    return explode_json_tags(s_posts(spark, d)).select("post_id", "hashtag")


@register("explode_split_tags", sql("""
    SELECT post_id, ingested_at, hashtag_tag FROM (
      SELECT post_id, ingested_at,
             unnest(string_split(regexp_replace(hashtags, '[\\[\\]"]', '', 'g'), ',')) AS hashtag_tag
      FROM b_posts WHERE hashtag_count > 0) t
    WHERE hashtag_tag <> ''"""))
def q_explode_split(spark, d):
    return explode_split_tags(b_posts(spark, d)).select("post_id", "ingested_at", "hashtag_tag")


@register("explode_tags_lenient", sql("""
    SELECT post_id, ingested_at, trim(tag) AS hashtag FROM (
      SELECT post_id, ingested_at, unnest(from_json(hashtags, '["varchar"]')) AS tag
      FROM b_posts) t
    WHERE trim(tag) <> ''"""))
def q_explode_lenient(spark, d):
    return explode_tags_lenient(b_posts(spark, d)).select("post_id", "ingested_at", "hashtag")


# ---- joins (J1, J3, J4) -----------------------------------------------------

@register("user_left_join", sql("""
    SELECT u.user_id, count(DISTINCT p.post_id) AS posts,
           CAST(sum(p.like_count) AS BIGINT) AS likes
    FROM s_users u LEFT JOIN s_posts p ON u.user_id = p.user_id GROUP BY u.user_id"""))
def q_user_left_join(spark, d):
    totals = gold.user_post_totals(s_posts(spark, d))
    users = s_users(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("_m"))  # an id may come twice
    return (users.join(totals, "user_id", "left")
            .select("user_id", F.coalesce("_posts", F.lit(0).cast("long")).alias("posts"),
                    (F.col("_likes") * F.col("_m")).alias("likes")))


@register("orphan_posts", sql("""
    SELECT post_id, user_id FROM s_posts p
    WHERE p.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_users u WHERE u.user_id = p.user_id)"""))
def q_orphan_posts(spark, d):
    return orphans(s_posts(spark, d), "user_id", s_users(spark, d)).select("post_id", "user_id")


@register("orphan_likes", sql("""
    SELECT like_id, post_id FROM s_likes l
    WHERE l.post_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_posts p WHERE p.post_id = l.post_id)"""))
def q_orphan_likes(spark, d):
    return orphans(s_likes(spark, d), "post_id", s_posts(spark, d)).select("like_id", "post_id")


@register("orphan_events_prefiltered", sql("""
    SELECT event_id, post_id FROM feed f
    WHERE f.entity <> 'posts' AND f.post_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_posts p WHERE p.post_id = f.post_id)"""))
def q_orphan_events(spark, d):
    """Streamed reactions whose post is not in silver, few or most of them."""
    ids = materialize_all({"post_ids": s_posts(spark, d).select("post_id")}, scratch_path(spark, "keys"))["post_ids"]
    events = adapter.feed_events(spark, d).where(F.col("entity") != "posts")
    return orphans_prefiltered(events, "post_id", ids).select("event_id", "post_id")


_FUT = f"TIMESTAMP '{FUTURE_AS_OF}'"


@register("temporal_consistency", sql(f"""
    SELECT 'like' AS kind, l.like_id AS event_id, l.post_id,
           l.liked_at < p.post_date AS before_post,
           l.liked_at > p.post_date + INTERVAL 30 DAY AS too_late,
           l.liked_at > {_FUT} AS in_future
    FROM s_likes l JOIN s_posts p ON l.post_id = p.post_id
    WHERE l.liked_at < p.post_date OR l.liked_at > p.post_date + INTERVAL 30 DAY OR l.liked_at > {_FUT}
    UNION ALL
    SELECT 'comment', c.comment_id, c.post_id, c.commented_at < p.post_date,
           c.commented_at > p.post_date + INTERVAL 7 DAY, c.commented_at > {_FUT}
    FROM s_comments c JOIN s_posts p ON c.post_id = p.post_id
    WHERE c.commented_at < p.post_date OR c.commented_at > p.post_date + INTERVAL 7 DAY
       OR c.commented_at > {_FUT}"""))
def q_temporal(spark, d):
    posts = s_posts(spark, d)
    likes = s_likes(spark, d).withColumnRenamed("like_id", "event_id")
    comments = s_comments(spark, d).withColumnRenamed("comment_id", "event_id")
    # Interactions concentrate on few posts (100 posts get all of them here):
    # flag the hot ones on a sample and salt them.
    # (detected on the bronze input, which skips the dedup; the salting is
    # exact whatever the list holds)
    return (temporal_consistency(likes, "liked_at", posts, "like", 30, FUTURE_AS_OF,
                                 hot=hot_keys(b_likes(spark, d), "post_id"))
            .unionByName(temporal_consistency(comments, "commented_at", posts, "comment", 7,
                                              FUTURE_AS_OF,
                                              hot=hot_keys(b_comments(spark, d), "post_id"))))


# ---- aggregates (A4-A17) ----------------------------------------------------

@register("kpi_cards", sql("""
    SELECT count(DISTINCT post_id) AS total_posts, CAST(sum(like_count) AS BIGINT) AS total_likes,
           CAST(sum(comment_count) AS BIGINT) AS total_comments,
           CAST(sum(view_count) AS BIGINT) AS total_views,
           CAST(sum(CAST(is_viral AS INTEGER)) AS BIGINT) AS viral_posts
    FROM s_posts"""))
def q_kpi(spark, d):
    return reports.kpi_cards(s_posts(spark, d))


@register("tier_distribution", sql(
    "SELECT influencer_tier, count(*) AS user_count FROM g_users GROUP BY influencer_tier"))
def q_tiers(spark, d):
    return reports.tier_distribution(g_users(spark, d))


@register("profile_users", sql("""
    SELECT count(*) AS total_users, CAST(sum(CAST(is_verified AS INTEGER)) AS BIGINT) AS verified,
           count(DISTINCT account_type) AS account_types, count(DISTINCT location) AS countries
    FROM b_users"""))
def q_profile_users(spark, d):
    return reports.profile_users(b_users(spark, d))


@register("profile_posts", sql(f"""
    SELECT count(*) AS total_posts, CAST(sum(CAST(is_viral AS INTEGER)) AS BIGINT) AS viral_posts,
           count(DISTINCT post_type) AS post_types,
           {avg4('like_count', 1, 0)} AS avg_likes,
           round(CAST(sum(CAST(raw_engagement_score AS DECIMAL(28,12))) AS DOUBLE)
                 / count(raw_engagement_score), 4) AS avg_engagement
    FROM b_posts"""))
def q_profile_posts(spark, d):
    return reports.profile_posts(b_posts(spark, d))


@register("profile_comments", sql("""
    SELECT count(*) AS total_comments, count(DISTINCT post_id) AS unique_posts_commented,
           count(DISTINCT sentiment) AS sentiments FROM b_comments"""))
def q_profile_comments(spark, d):
    return reports.profile_comments(b_comments(spark, d))


@register("profile_likes", sql("""
    SELECT count(*) AS total_likes, count(DISTINCT post_id) AS unique_posts_liked,
           count(DISTINCT reaction_type) AS reaction_types FROM b_likes"""))
def q_profile_likes(spark, d):
    return reports.profile_likes(b_likes(spark, d))


_LAYERS = [("bronze", "users", "b_users"), ("bronze", "posts", "b_posts"),
           ("bronze", "comments", "b_comments"), ("bronze", "likes", "b_likes"),
           ("silver", "stg_users", "s_users"), ("silver", "stg_posts", "s_posts"),
           ("silver", "stg_comments", "s_comments"), ("silver", "stg_likes", "s_likes"),
           ("gold", "mart_daily_engagement", "g_daily"),
           ("gold", "mart_hashtag_performance", "g_hashtags"),
           ("gold", "mart_user_performance", "g_users")]


@register("layer_row_counts", sql(" UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS \"table\", count(*) AS row_count FROM {cte}"
    for layer, name, cte in _LAYERS)))
def q_layer_counts(spark, d):
    """Counted on a run's materialised layers: file metadata, nothing is rebuilt."""
    run = run_batch(spark, build_lake(spark, d), scratch_path(spark, "run"), AS_OF)
    tables = run.bronze | run.silver | run.gold
    return reports.layer_row_counts({(layer, name): tables[name] for layer, name, _ in _LAYERS})


@register("engagement_by_type", sql("""
    SELECT post_type, count(*) AS total_posts, avg(CAST(like_count AS DOUBLE)) AS avg_likes,
           avg(CAST(view_count AS DOUBLE)) AS avg_views
    FROM b_posts GROUP BY post_type"""))
def q_by_type(spark, d):
    return reports.engagement_by_type(b_posts(spark, d))


@register("users_by_account_type", sql("""
    SELECT account_type, count(*) AS users,
           CAST(sum(CASE WHEN is_verified = true THEN 1 ELSE 0 END) AS BIGINT) AS verified
    FROM b_users GROUP BY account_type"""))
def q_by_account(spark, d):
    return reports.users_by_account_type(b_users(spark, d))


_LENIENT = """(SELECT trim(tag) AS hashtag FROM (
      SELECT unnest(from_json(hashtags, '["varchar"]')) AS tag FROM b_posts) t
    WHERE trim(tag) <> '')"""


@register("trending_hashtags", sql(f"""
    SELECT hashtag, count(*) AS post_count, {SQL_AS_OF} AS window_end
    FROM {_LENIENT} x GROUP BY hashtag"""))
def q_trending(spark, d):
    return reports.trending_hashtags(b_posts(spark, d), pinned())


@register("reaction_counts", sql(f"""
    SELECT reaction_type, count(*) AS reaction_count, {SQL_AS_OF} AS window_end
    FROM b_likes GROUP BY reaction_type"""))
def q_reactions(spark, d):
    return reports.reaction_counts(b_likes(spark, d), pinned())


@register("comment_sentiment", sql(f"""
    SELECT sentiment, count(*) AS comment_count, {SQL_AS_OF} AS window_end
    FROM b_comments GROUP BY sentiment"""))
def q_sentiment(spark, d):
    return reports.comment_sentiment(b_comments(spark, d), pinned())


@register("batch_stats", sql("""
    SELECT 'posts' AS entity, 'post_type' AS stat, post_type AS key, count(*) AS value
    FROM b_posts GROUP BY post_type
    UNION ALL SELECT 'posts', 'total', NULL, count(*) FROM b_posts
    UNION ALL SELECT 'posts', 'viral', NULL, CAST(sum(CAST(is_viral AS INTEGER)) AS BIGINT) FROM b_posts
    UNION ALL SELECT 'posts', 'tagged', NULL, CAST(sum(CAST(hashtag_count > 0 AS INTEGER)) AS BIGINT) FROM b_posts
    UNION ALL SELECT 'users', 'account_type', account_type, count(*) FROM b_users GROUP BY account_type
    UNION ALL SELECT 'users', 'total', NULL, count(*) FROM b_users
    UNION ALL SELECT 'users', 'verified', NULL, CAST(sum(CAST(is_verified AS INTEGER)) AS BIGINT) FROM b_users"""))
def q_batch_stats(spark, d):
    return reports.batch_stats(b_posts(spark, d), b_users(spark, d))


@register("duplicate_keys", sql(
    "SELECT post_id, count(*) AS n FROM b_posts GROUP BY post_id HAVING count(*) > 1"))
def q_dupes(spark, d):
    return reports.duplicate_keys(b_posts(spark, d), "post_id")


# ---- reports (O1-O6) --------------------------------------------------------

@register("report_daily", sql("""
    SELECT CAST(date AS VARCHAR) AS date, total_posts, total_likes, viral_posts,
           round(platform_engagement_rate, 4) AS eng_rate
    FROM g_daily ORDER BY g_daily.date ASC LIMIT 30"""))
def q_report_daily(spark, d):
    return reports.report_daily(g_daily(spark, d))


@register("report_hashtags", sql("""
    SELECT hashtag, round(trending_score, 2) AS trending_score, total_posts, total_likes
    FROM g_hashtags ORDER BY g_hashtags.trending_score DESC NULLS LAST, hashtag LIMIT 15"""))
def q_report_tags(spark, d):
    return reports.report_hashtags(g_tags(spark, d))


@register("report_users", sql("""
    SELECT row_number() OVER (ORDER BY total_likes_received DESC NULLS LAST, user_id) AS rank,
           username, influencer_tier, total_posts, total_likes_received, viral_posts
    FROM g_users ORDER BY total_likes_received DESC NULLS LAST, user_id LIMIT 10"""))
def q_report_users(spark, d):
    return reports.report_users(g_users(spark, d))


@register("top_tags_json", sql("""
    SELECT hashtag, count(*) AS usage_count FROM (
      SELECT unnest(from_json(hashtags, '["varchar"]')) AS hashtag
      FROM b_posts WHERE hashtag_count > 0) t
    GROUP BY hashtag ORDER BY usage_count DESC, hashtag NULLS LAST LIMIT 10"""))
def q_top_json(spark, d):
    return reports.top_tags_json(b_posts(spark, d))


@register("top_tags_split", sql("""
    SELECT hashtag_tag, count(*) AS post_count FROM (
      SELECT unnest(string_split(regexp_replace(hashtags, '[\\[\\]"]', '', 'g'), ',')) AS hashtag_tag
      FROM b_posts WHERE hashtag_count > 0) t
    WHERE hashtag_tag <> ''
    GROUP BY hashtag_tag ORDER BY post_count DESC, hashtag_tag LIMIT 10"""))
def q_top_split(spark, d):
    return reports.top_tags_split(b_posts(spark, d))


@register("top_tags_reaction_sentiment", sql(f"""
    SELECT * FROM (
      SELECT 'hashtag' AS kind, hashtag AS value, count(*) AS n FROM {_LENIENT} x GROUP BY hashtag
      ORDER BY n DESC, value NULLS LAST LIMIT 5)
    UNION ALL SELECT * FROM (
      SELECT 'reaction', reaction_type, count(*) AS n FROM b_likes GROUP BY reaction_type
      ORDER BY n DESC, reaction_type NULLS LAST LIMIT 1)
    UNION ALL SELECT * FROM (
      SELECT 'sentiment', sentiment, count(*) AS n FROM b_comments GROUP BY sentiment
      ORDER BY n DESC, sentiment NULLS LAST LIMIT 1)"""))
def q_top3(spark, d):
    return reports.top_tags_reaction_sentiment(
        reports.trending_hashtags(b_posts(spark, d), pinned()),
        reports.reaction_counts(b_likes(spark, d), pinned()),
        reports.comment_sentiment(b_comments(spark, d), pinned())).drop("rank")


# ---- quality (Q1-Q10) -------------------------------------------------------

def _declared(su, sp, sc, sl):
    return quality.standard_checks(
        su, sp, sc, sl, gold.daily_engagement(sp, AS_OF, ordered=False),
        gold.hashtag_performance(sp, AS_OF, ordered=False), gold.user_performance(su, sp, AS_OF))


def _quality(spark, d):
    # Silver posts feed five of the check passes (its own checks, the
    # relationship and all three marts) and users two: compute each once,
    # written as Parquet in the shared folder (a lineage cut that is
    # computed once; Dataset.checkpoint would compute it twice).
    m = materialize_all({"stg_users": s_users(spark, d), "stg_posts": s_posts(spark, d)},
                        scratch_path(spark, "silver"))
    return quality.quality_report(_declared(m["stg_users"], m["stg_posts"], s_comments(spark, d), s_likes(spark, d)))


def _q_sql(layer, table, cte, check, column, failing_sql):
    return (f"SELECT '{layer}' AS layer, '{table}' AS \"table\", '{check}' AS \"check\", "
            f"'{column}' AS \"column\", CAST(({failing_sql}) AS BIGINT) AS failing_rows")


def _checks_sql() -> list[tuple[str, str]]:
    """(check, select) pairs mirroring quality.standard_checks."""
    out = []

    def nn(l, t, c, col):
        out.append(("not_null", _q_sql(l, t, c, "not_null", col,
                                       f"SELECT count(*) FROM {c} WHERE {col} IS NULL")))

    def av(l, t, c, col, vals, check="accepted_values"):
        v = ", ".join(f"'{x}'" for x in vals)
        out.append((check, _q_sql(l, t, c, check, col,
                                  f"SELECT count(*) FROM {c} WHERE {col} NOT IN ({v})")))

    def ne(l, t, c):
        out.append(("non_empty", _q_sql(l, t, c, "non_empty", "*",
                                        f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {c}")))

    def uq(l, t, c, col, check="unique"):
        where = f"WHERE {col} IS NOT NULL" if check == "unique" else ""
        out.append((check, _q_sql(l, t, c, check, col,
                                  f"SELECT count(*) FROM (SELECT {col} FROM {c} {where} "
                                  f"GROUP BY {col} HAVING count(*) > 1) z")))

    def isnull(l, t, c, col):
        out.append(("score_not_null", _q_sql(l, t, c, "score_not_null", col,
                                             f"SELECT count(*) FROM {c} WHERE {col} IS NULL")))

    def neg(l, t, c, col):
        out.append(("non_negative", _q_sql(l, t, c, "non_negative", col,
                                           f"SELECT count(*) FROM {c} WHERE {col} < 0")))

    Q = quality
    L, T, C = "silver", "stg_users", "s_users"
    for col in ("user_id", "username", "account_type", "follower_count"):
        nn(L, T, C, col)
    av(L, T, C, "account_type", Q.ACCOUNT_TYPES)
    av(L, T, C, "account_status", Q.ACCOUNT_STATUSES)
    av(L, T, C, "influencer_tier", Q.INFLUENCER_TIER_VALUES)
    ne(L, T, C)
    uq(L, T, C, "user_id")
    uq(L, T, C, "user_id", "duplicates")
    T, C = "stg_posts", "s_posts"
    for col in ("post_id", "user_id", "dq_flag"):
        nn(L, T, C, col)
    av(L, T, C, "post_type", Q.POST_TYPES)
    av(L, T, C, "engagement_tier", Q.ENGAGEMENT_TIER_VALUES)
    ne(L, T, C)
    isnull(L, T, C, "engagement_score")
    neg(L, T, C, "engagement_score")
    av(L, T, C, "post_type", Q.POST_TYPES, "enum")
    uq(L, T, C, "post_id")
    uq(L, T, C, "post_id", "duplicates")
    out.append(("relationships", _q_sql(L, T, C, "relationships", "user_id",
                "SELECT count(*) FROM s_posts p WHERE p.user_id IS NOT NULL AND NOT EXISTS "
                "(SELECT 1 FROM s_users u WHERE u.user_id = p.user_id)")))
    T, C = "stg_comments", "s_comments"
    nn(L, T, C, "comment_id")
    nn(L, T, C, "post_id")
    av(L, T, C, "sentiment", Q.SENTIMENTS)
    ne(L, T, C)
    av(L, T, C, "sentiment", Q.SENTIMENTS, "enum")
    uq(L, T, C, "comment_id")
    T, C = "stg_likes", "s_likes"
    nn(L, T, C, "like_id")
    av(L, T, C, "reaction_type", Q.REACTIONS)
    ne(L, T, C)
    av(L, T, C, "reaction_type", Q.REACTIONS, "enum")
    uq(L, T, C, "like_id")
    L, T, C = "gold", "mart_daily_engagement", "g_daily"
    for col in ("date", "total_posts", "platform_engagement_rate"):
        nn(L, T, C, col)
    ne(L, T, C)
    neg(L, T, C, "platform_engagement_rate")
    uq(L, T, C, "date")
    uq(L, T, C, "date", "duplicates")
    T, C = "mart_hashtag_performance", "g_hashtags"
    nn(L, T, C, "hashtag")
    ne(L, T, C)
    neg(L, T, C, "trending_score")
    uq(L, T, C, "hashtag")
    uq(L, T, C, "hashtag", "duplicates")
    T, C = "mart_user_performance", "g_users"
    nn(L, T, C, "user_id")
    ne(L, T, C)
    uq(L, T, C, "user_id")
    return out


def report_sql(checks: tuple[str, ...] | None) -> str:
    parts = [s for c, s in _checks_sql() if checks is None or c in checks]
    body = " UNION ALL ".join(parts)
    return sql(f"SELECT *, failing_rows = 0 AS passed FROM ({body}) r")


register("quality_report", report_sql(None))(_quality)


@register("quality_summary", report_sql(None).replace("SELECT *, failing_rows = 0 AS passed", """
    SELECT count(*) FILTER (failing_rows = 0) AS passed, count(*) FILTER (failing_rows > 0) AS failed,
           count(*) AS total, count(*) FILTER (failing_rows > 0) = 0 AS all_passed"""))
def q_quality_summary(spark, d):
    return quality.quality_summary(_quality(spark, d))


for _key, _checks in {
    "dq_unique": ("unique",), "dq_not_null": ("not_null",),
    "dq_accepted_values": ("accepted_values",), "dq_relationships": ("relationships",),
    "dq_non_empty": ("non_empty",), "dq_duplicates": ("duplicates",),
    "dq_ranges": ("score_not_null", "non_negative"), "dq_enums": ("enum",),
}.items():
    def _mk(checks):
        def build(spark, d):
            # only the checks asked for; nothing is written, and identical
            # exchanges below the marts are run once (exchange reuse)
            tables = _declared(s_users(spark, d), s_posts(spark, d), s_comments(spark, d), s_likes(spark, d))
            return quality.quality_report(quality.only(tables, checks))
        return build
    register(_key, report_sql(_checks))(_mk(_checks))


@register("dq_flag_summary", sql("SELECT dq_flag, count(*) AS posts FROM s_posts GROUP BY dq_flag"))
def q_flag_summary(spark, d):
    return quality.dq_flag_summary(s_posts(spark, d))
