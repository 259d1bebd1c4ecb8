"""Reports and profiles.

Every top-k ends its ordering in a unique column, so results do not
depend on partitioning (the reference's LIMITs have no tie-break).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rounding import avg_fixed, round_half_away
from tidemark.operators.topk import top_k
from tidemark.operators.unnest import (
    explode_json_tags, explode_split_tags, explode_tags_lenient,
)


def _int(c: str) -> Column:
    return F.col(c).cast("int")


# ---- dashboard frames -----------------------------------------------------

def kpi_cards(posts: DataFrame, unique_posts: bool = True) -> DataFrame:
    """A4: one global KPI row over silver posts.

    Silver posts are unique on ``post_id`` (a checked invariant), so the
    distinct count is a plain count: no shuffle of every post id to one
    global distinct aggregate."""
    return posts.agg(
        (F.count(F.lit(1)) if unique_posts else F.count_distinct("post_id")).alias("total_posts"),
        F.sum(F.col("like_count").cast("long")).alias("total_likes"),
        F.sum(F.col("comment_count").cast("long")).alias("total_comments"),
        F.sum(F.col("view_count").cast("long")).alias("total_views"),
        F.sum(_int("is_viral").cast("long")).alias("viral_posts"),
    )


def tier_distribution(user_mart: DataFrame) -> DataFrame:
    """A5: users per influencer tier, largest first."""
    return (user_mart.groupBy("influencer_tier").agg(F.count(F.lit(1)).alias("user_count"))
            .orderBy(F.col("user_count").desc(), F.col("influencer_tier")))


def report_daily(daily: DataFrame, k: int = 30) -> DataFrame:
    """O1: the *oldest* k days (ASC then LIMIT), date as text."""
    return top_k(daily, [F.col("date").asc()], k).select(
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
        "total_posts", "total_likes", "viral_posts",
        round_half_away(F.col("platform_engagement_rate"), 4).alias("eng_rate"))


def report_hashtags(tags: DataFrame, k: int = 15) -> DataFrame:
    """O2: top k tags by trending score (tie: tag)."""
    return top_k(tags, [F.col("trending_score").desc_nulls_last(), F.col("hashtag")], k).select(
        "hashtag", round_half_away(F.col("trending_score"), 2).alias("trending_score"),
        "total_posts", "total_likes")


def report_users(user_mart: DataFrame, k: int = 10) -> DataFrame:
    """O3: top k users by likes received, NULLs last, with a rank column."""
    order = [F.col("total_likes_received").desc_nulls_last(), F.col("user_id")]
    return top_k(user_mart, order, k, rank_col="rank").select(
        "rank", "username", "influencer_tier", "total_posts", "total_likes_received",
        "viral_posts")


# ---- bronze profiles ------------------------------------------------------

def profile_users(users: DataFrame) -> DataFrame:
    """One DISTINCT per aggregate (two in one would double every row)."""
    return users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum(_int("is_verified").cast("long")).alias("verified"),
        F.count_distinct("account_type").alias("account_types")).select(
        "*", _distinct(users, "location").alias("countries"))


def _distinct(df: DataFrame, col: str) -> Column:
    """The number of distinct values as a scalar subquery (one row)."""
    return df.agg(F.count_distinct(col)).scalar()


def profile_posts(posts: DataFrame) -> DataFrame:
    """Averages are exact (order-independent), then rounded.  Bronze scores
    may carry any number of decimals, so they are summed as decimals."""
    return posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.sum(_int("is_viral").cast("long")).alias("viral_posts"),
        F.count_distinct("post_type").alias("post_types"),
        avg_fixed("like_count", 0, 1).alias("avg_likes"),
        round_half_away(F.sum(F.col("raw_engagement_score").cast("decimal(28,12)")).cast("double")
                        / F.nullif(F.count("raw_engagement_score"), F.lit(0)), 4).alias("avg_engagement"))


def profile_comments(comments: DataFrame) -> DataFrame:
    """A8."""
    return comments.agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.count_distinct("post_id").alias("unique_posts_commented")).select(
        "*", _distinct(comments, "sentiment").alias("sentiments"))


def profile_likes(likes: DataFrame) -> DataFrame:
    """A9."""
    return likes.agg(
        F.count(F.lit(1)).alias("total_likes"),
        F.count_distinct("post_id").alias("unique_posts_liked")).select(
        "*", _distinct(likes, "reaction_type").alias("reaction_types"))


def layer_row_counts(frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """A10: ``(layer, table, row_count)`` for each registered frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "row_count")
             for (layer, name), df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- cloud-SQL reports ----------------------------------------------------

def engagement_by_type(posts: DataFrame) -> DataFrame:
    """A11 (integer counts summed in double are exact, so plain avg)."""
    return (posts.groupBy("post_type").agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.avg(F.col("like_count").cast("double")).alias("avg_likes"),
        F.avg(F.col("view_count").cast("double")).alias("avg_views"))
        .orderBy(F.col("avg_likes").desc(), F.col("post_type")))


def users_by_account_type(users: DataFrame) -> DataFrame:
    """A12."""
    return (users.groupBy("account_type").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum(F.when(F.col("is_verified") == F.lit(True), 1).otherwise(0)).cast("long").alias("verified"))
        .orderBy(F.col("users").desc(), F.col("account_type")))


def top_tags_split(posts: DataFrame, k: int = 10) -> DataFrame:
    """Split form (leading spaces kept) -> counts -> top k."""
    counts = (explode_split_tags(posts.select("hashtags", "hashtag_count"))
              .groupBy("hashtag_tag").agg(F.count(F.lit(1)).alias("post_count")))
    return top_k(counts, [F.col("post_count").desc(), F.col("hashtag_tag")], k)


def top_tags_json(posts: DataFrame, k: int = 10) -> DataFrame:
    """Strict JSON form -> counts -> top k."""
    counts = (explode_json_tags(posts.select("hashtags", "hashtag_count"))
              .groupBy("hashtag").agg(F.count(F.lit(1)).alias("usage_count")))
    return top_k(counts, [F.col("usage_count").desc(), F.col("hashtag").asc_nulls_last()], k)


# ---- stream-job counters (batch form) ------------------------------------

def trending_hashtags(posts: DataFrame, window_end: Column) -> DataFrame:
    """Lenient tag counts."""
    return (explode_tags_lenient(posts.select("hashtags"))
            .groupBy("hashtag").agg(F.count(F.lit(1)).alias("post_count"))
            .withColumn("window_end", window_end))


# The counters' defaults for a record that lacks the field.
DEFAULT_REACTION = "like"
DEFAULT_SENTIMENT = "neutral"


def _with_default(df: DataFrame, col: str, default: str) -> DataFrame:
    """Fill only a *missing column* (older files without the field); a
    present NULL stays NULL and is counted as its own group."""
    return df if col in df.columns else df.withColumn(col, F.lit(default))


def reaction_counts(likes: DataFrame, window_end: Column) -> DataFrame:
    """NULL reactions stay a group of their own."""
    likes = _with_default(likes, "reaction_type", DEFAULT_REACTION)
    return (likes.groupBy("reaction_type").agg(F.count(F.lit(1)).alias("reaction_count"))
            .withColumn("window_end", window_end))


def comment_sentiment(comments: DataFrame, window_end: Column) -> DataFrame:
    """A15."""
    comments = _with_default(comments, "sentiment", DEFAULT_SENTIMENT)
    return (comments.groupBy("sentiment").agg(F.count(F.lit(1)).alias("comment_count"))
            .withColumn("window_end", window_end))


def top_tags_reaction_sentiment(tags: DataFrame, reactions: DataFrame,
                                sentiments: DataFrame) -> DataFrame:
    """Top 5 tags, top reaction, top sentiment as ``(kind, value, n, rank)``."""
    def pick(df, kind, value, n, k):
        return top_k(df, [F.col(n).desc(), F.col(value).asc_nulls_last()], k, rank_col="rank") \
            .select(F.lit(kind).alias("kind"), F.col(value).alias("value"),
                    F.col(n).alias("n"), F.col("rank"))
    return (pick(tags, "hashtag", "hashtag", "post_count", 5)
            .unionByName(pick(reactions, "reaction", "reaction_type", "reaction_count", 1))
            .unionByName(pick(sentiments, "sentiment", "sentiment", "comment_count", 1)))


def batch_stats(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Post-generation summary as ``(entity, stat, key, value)``.

    One ROLLUP pass per entity gives both the per-type counts and the
    totals, instead of one scan per statistic.
    """
    p = posts.rollup("post_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_int("is_viral").cast("long")).alias("viral"),
        F.sum((F.col("hashtag_count") > 0).cast("long")).alias("tagged"),
        F.grouping("post_type").alias("g"))
    u = users.rollup("account_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_int("is_verified").cast("long")).alias("verified"),
        F.grouping("account_type").alias("g"))
    null = F.lit(None).cast("string")
    p_rows = p.select(
        F.lit("posts").alias("entity"),
        F.explode(F.when(F.col("g") == 1, F.array(
            F.struct(F.lit("total").alias("stat"), null.alias("key"), F.col("n").alias("value")),
            F.struct(F.lit("viral").alias("stat"), null.alias("key"), F.col("viral").alias("value")),
            F.struct(F.lit("tagged").alias("stat"), null.alias("key"), F.col("tagged").alias("value")),
        )).otherwise(F.array(
            F.struct(F.lit("post_type").alias("stat"), F.col("post_type").alias("key"),
                     F.col("n").alias("value"))))).alias("r"))
    u_rows = u.select(
        F.lit("users").alias("entity"),
        F.explode(F.when(F.col("g") == 1, F.array(
            F.struct(F.lit("total").alias("stat"), null.alias("key"), F.col("n").alias("value")),
            F.struct(F.lit("verified").alias("stat"), null.alias("key"), F.col("verified").alias("value")),
        )).otherwise(F.array(
            F.struct(F.lit("account_type").alias("stat"), F.col("account_type").alias("key"),
                     F.col("n").alias("value"))))).alias("r"))
    return p_rows.unionByName(u_rows).select("entity", "r.stat", "r.key", "r.value")


def duplicate_keys(df: DataFrame, key: str, ignore_nulls: bool = False) -> DataFrame:
    """Keys occurring more than once (GROUP BY ... HAVING count > 1).

    Partial aggregation runs map side, so a hot key costs one row per task
    in the shuffle.  By default a repeated NULL key is reported too (plain
    GROUP BY semantics); ``ignore_nulls`` gives the declarative ``unique``
    test's semantics."""
    src = df.where(F.col(key).isNotNull()) if ignore_nulls else df
    return (src.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
