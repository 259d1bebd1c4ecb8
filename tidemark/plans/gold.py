"""Gold layer marts (A1-A3) over silver frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rounding import avg_fixed, round_half_away
from tidemark.functions.scores import weighted_interactions
from tidemark.functions.tags import json_tags
from tidemark.plans.silver import as_of_col

USER_COLUMNS = ("user_id", "username", "display_name", "location", "account_type",
                "influencer_tier", "is_verified", "follower_count", "following_count",
                "account_age_days")


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def daily_engagement(posts: DataFrame, as_of: str | Column | None = None,
                     unique_posts: bool = True, ordered: bool = True) -> DataFrame:
    """mart_daily_engagement: one row per ``post_day``, newest first.

    Silver posts are unique and non-null on ``post_id`` (checked by the
    ``unique`` quality check), so the post count is ``count(*)``; that
    leaves a single DISTINCT (authors) and avoids the Expand that two
    DISTINCT aggregates would need.  Everything else is partial-aggregated
    map side, so a hot day costs one row per task in the shuffle.
    """
    total_posts = (F.count(F.lit(1)) if unique_posts else F.count_distinct("post_id"))
    out = posts.groupBy(F.col("post_day").alias("date")).agg(
        total_posts.alias("total_posts"),
        F.count_distinct("user_id").alias("active_authors"),
        F.sum(F.col("like_count").cast("long")).alias("total_likes"),
        F.sum(F.col("comment_count").cast("long")).alias("total_comments"),
        F.sum(F.col("repost_count").cast("long")).alias("total_reposts"),
        F.sum(F.col("view_count").cast("long")).alias("total_views"),
        avg_fixed("engagement_score", 4, 4).alias("avg_engagement_score"),
        _count_if(F.col("is_viral")).alias("viral_posts"),
        _count_if(F.col("engagement_tier") == "high").alias("high_engagement_posts"),
    )
    interactions = F.col("total_likes") + F.col("total_comments") + F.col("total_reposts")
    out = out.withColumn(
        "platform_engagement_rate",
        round_half_away(interactions.cast("double")
                        / F.nullif(F.col("total_views"), F.lit(0)) * F.lit(100), 4),
    ).withColumn("built_at", as_of_col(as_of))
    return out.orderBy(F.col("date").desc()) if ordered else out


def hashtag_performance(posts: DataFrame, as_of: str | Column | None = None,
                        ordered: bool = True, unique_posts: bool = True) -> DataFrame:
    """mart_hashtag_performance: strict-JSON tags, aggregated per tag.

    A post may repeat a tag: it is one post of the tag, but its measures
    count as often as the tag stands there, as in the reference.  So each
    post gives its *distinct* tags with their multiplicity, posts are
    counted plainly (silver posts are unique) and sums are weighted: one
    shuffle of one pre-aggregated row per tag and task, whatever the number
    of posts of a hot tag.  ``unique_posts=False`` counts DISTINCT posts.
    """
    parsed = posts.where(F.col("hashtag_count") > 0).withColumn("_tags", json_tags("hashtags"))
    tagged = (parsed.withColumn("hashtag", F.explode(F.array_distinct("_tags")))
              .withColumn("_m", F.size(F.filter("_tags", lambda t: t.eqNullSafe(F.col("hashtag")))).cast("long")))
    m = F.col("_m")
    units = F.round(F.col("engagement_score") * F.lit(10000.0), 0).cast("long")
    scored = F.sum(F.when(F.col("engagement_score").isNotNull(), m))
    mean = F.sum(units * m).cast("double") / (scored * F.lit(10000)).cast("double")
    out = tagged.groupBy("hashtag").agg(
        (F.count(F.lit(1)) if unique_posts else F.count_distinct("post_id")).alias("total_posts"),
        F.sum(F.col("like_count").cast("long") * m).alias("total_likes"),
        F.sum(F.col("comment_count").cast("long") * m).alias("total_comments"),
        F.sum(F.col("repost_count").cast("long") * m).alias("total_reposts"),
        F.sum(F.col("view_count").cast("long") * m).alias("total_views"),
        F.when(scored > 0, round_half_away(mean, 4)).alias("avg_engagement"),
        F.coalesce(F.sum(F.when(F.col("is_viral"), m)), F.lit(0).cast("long")).alias("viral_posts"),
        F.sum(weighted_interactions() * m).alias("_weighted"),
        F.min("post_day").alias("first_seen"),
        F.max("post_day").alias("last_seen"),
    )
    out = out.select(
        "hashtag", "total_posts", "total_likes", "total_comments", "total_reposts",
        "total_views", "avg_engagement", "viral_posts",
        round_half_away(F.col("_weighted").cast("double")
                        / F.nullif(F.col("total_posts"), F.lit(0)), 2).alias("trending_score"),
        "first_seen", "last_seen", as_of_col(as_of).alias("built_at"))
    return out.orderBy(F.col("trending_score").desc_nulls_last()) if ordered else out


def user_post_totals(posts: DataFrame, unique_posts: bool = True) -> DataFrame:
    """Per-author aggregates, partial-aggregated before the shuffle.

    Silver posts are unique on ``post_id`` (checked by the quality report),
    so the DISTINCT post count is a plain count: one shuffle keyed by
    author instead of a second one keyed by (author, post)."""
    return posts.groupBy("user_id").agg(
        (F.count(F.lit(1)) if unique_posts else F.count_distinct("post_id")).alias("_posts"),
        F.sum(F.col("like_count").cast("long")).alias("_likes"),
        F.sum(F.col("comment_count").cast("long")).alias("_comments"),
        F.sum(F.col("repost_count").cast("long")).alias("_reposts"),
        F.sum(F.col("view_count").cast("long")).alias("_views"),
        avg_fixed("engagement_score", 4, 4).alias("_avg"),
        _count_if(F.col("is_viral")).alias("_viral"),
        F.min("post_date").alias("first_post_date"),
        F.max("post_date").alias("last_post_date"),
    )


def user_performance(users: DataFrame, posts: DataFrame,
                     as_of: str | Column | None = None,
                     ordered: bool = False, unique_posts: bool = True) -> DataFrame:
    """mart_user_performance: users LEFT JOIN posts, grouped by 10 user columns.

    Plan: aggregate posts per ``user_id`` first (a hot author is cut to
    one row per map task), collapse users to their distinct 10-column
    profiles with a multiplicity ``m``, then join one row to one row.
    Scaling the additive measures by ``m`` reproduces the reference exactly
    even if a user row is duplicated (where its join would repeat every
    post); DISTINCT counts, averages and dates are unaffected by ``m``.
    The profile grouping runs its partial aggregation map side first, so
    even a user id repeated across a third of the rows is collapsed before
    any shuffle.  The join side sizes are only known at run time, so AQE
    decides on broadcast from measured sizes.

    ``ordered`` sorts by likes received (NULLs last); off by default since
    the user count is unbounded and table order is not kept on read.
    """
    profiles = (users.select(*USER_COLUMNS)
                .groupBy(*USER_COLUMNS).agg(F.count(F.lit(1)).alias("_m")))
    totals = user_post_totals(posts, unique_posts)
    j = profiles.join(totals, "user_id", "left")
    m = F.col("_m")
    span = F.datediff(F.to_date("last_post_date"), F.to_date("first_post_date")).cast("long")
    total_posts = F.coalesce(F.col("_posts"), F.lit(0).cast("long"))
    out = j.select(
        *USER_COLUMNS,
        total_posts.alias("total_posts"),
        (F.col("_likes") * m).alias("total_likes_received"),
        (F.col("_comments") * m).alias("total_comments_received"),
        (F.col("_reposts") * m).alias("total_reposts_received"),
        (F.col("_views") * m).alias("total_views"),
        F.col("_avg").alias("avg_engagement_score"),
        (F.coalesce(F.col("_viral"), F.lit(0).cast("long")) * m).alias("viral_posts"),
        "first_post_date", "last_post_date",
        span.alias("active_days_span"),
        round_half_away(total_posts.cast("double") / F.nullif(span, F.lit(0)), 2).alias("posts_per_day"),
        as_of_col(as_of).alias("built_at"),
    )
    return out.orderBy(F.col("total_likes_received").desc_nulls_last()) if ordered else out
