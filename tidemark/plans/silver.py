"""Silver layer: typed, cleaned, newest-version records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import functions as TF
from tidemark.operators.dedup import latest_by_key


def as_of_col(as_of: str | Column | None) -> Column:
    """``as_of`` pins CURRENT_TIMESTAMP for reproducible runs."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp_ntz")
    return as_of


def _trim(c: str) -> Column:
    return F.trim(F.col(c))


_FRACTIONAL = ("float", "double", "decimal")


def _to_int(df: DataFrame, c: str) -> Column:
    """CAST(x AS INTEGER) as the reference engine does it: a fractional
    source (e.g. a merged file that made a counter floating) is rounded
    half away from zero, where Spark's cast would truncate."""
    dtype = df.schema[c].dataType.typeName()
    col = F.col(c)
    if dtype.startswith(_FRACTIONAL):
        col = F.round(col, 0)
    return col.cast("int")


def stage_users(users: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """stg_users: no dedup (the reference has none), required-field filter."""
    now = as_of_col(as_of)
    joined = TF.to_ntz("joined_at")
    return users.filter(F.col("user_id").isNotNull() & F.col("username").isNotNull()).select(
        "user_id",
        _trim("username").alias("username"),
        _trim("display_name").alias("display_name"),
        F.lower(_trim("email")).alias("email"),
        _trim("bio").alias("bio"),
        _trim("location").alias("location"),
        "website",
        "profile_image_url",
        F.lower("account_type").alias("account_type"),
        F.lower("account_status").alias("account_status"),
        F.col("is_verified").cast("boolean").alias("is_verified"),
        F.lower("language").alias("language"),
        _to_int(users, "follower_count").alias("follower_count"),
        _to_int(users, "following_count").alias("following_count"),
        _to_int(users, "post_count").alias("post_count"),
        TF.influencer_tier("follower_count").alias("influencer_tier"),
        TF.is_influencer("follower_count").alias("is_influencer"),
        TF.follower_ratio("follower_count", "following_count").alias("follower_ratio"),
        joined.alias("joined_at"),
        TF.to_ntz("last_active_at").alias("last_active_at"),
        TF.account_age_days(joined, now).alias("account_age_days"),
        TF.to_ntz("ingested_at").alias("ingested_at"),
        "source_system",
        now.alias("transformed_at"),
    )


def stage_posts(posts: DataFrame, as_of: str | Column | None = None,
                tie_break: Sequence[str] = ("content",)) -> DataFrame:
    """stg_posts: newest version first, then the row filter (tombstones win).

    ``is_deleted = false`` drops NULL too (three-valued logic).  Scores use
    the bronze counts; the tier uses the bronze raw score.
    """
    now = as_of_col(as_of)
    newest = latest_by_key(posts, "post_id", "ingested_at", tie_break)
    kept = newest.filter(
        F.col("post_id").isNotNull() & F.col("user_id").isNotNull()
        & F.col("post_date").isNotNull() & (F.col("is_deleted") == F.lit(False)))
    pd = TF.to_ntz("post_date")
    return kept.select(
        "post_id", "user_id",
        _trim("content").alias("content"),
        F.lower("post_type").alias("post_type"),
        F.lower("language").alias("language"),
        "media_url",
        "hashtags",
        _to_int(kept, "hashtag_count").alias("hashtag_count"),
        _to_int(kept, "like_count").alias("like_count"),
        _to_int(kept, "comment_count").alias("comment_count"),
        _to_int(kept, "repost_count").alias("repost_count"),
        _to_int(kept, "view_count").alias("view_count"),
        TF.engagement_score().alias("engagement_score"),
        TF.engagement_tier("raw_engagement_score").alias("engagement_tier"),
        F.col("is_viral").cast("boolean").alias("is_viral"),
        F.col("is_deleted").cast("boolean").alias("is_deleted"),
        F.col("is_nsfw").cast("boolean").alias("is_nsfw"),
        "geo_country",
        pd.alias("post_date"),
        TF.trunc_hour(pd).alias("post_hour"),
        TF.trunc_day(pd).alias("post_day"),
        TF.trunc_week(pd).alias("post_week"),
        TF.trunc_month(pd).alias("post_month"),
        TF.hour_of_day(pd).alias("hour_of_day"),
        TF.day_of_week(pd).alias("day_of_week"),
        TF.is_weekend(pd).alias("is_weekend"),
        TF.dq_flag().alias("dq_flag"),
        TF.to_ntz("ingested_at").alias("ingested_at"),
        "source_system",
        now.alias("transformed_at"),
    )


def stage_comments(comments: DataFrame, as_of: str | Column | None = None,
                   tie_break: Sequence[str] = ("content", "is_deleted", "post_id", "user_id", "sentiment", "like_count",
                                               "commented_at")) -> DataFrame:
    """stg_comments.  Of rows with one id and ingest time the largest by
    ``tie_break`` stays, so the result does not depend on partitions."""
    now = as_of_col(as_of)
    newest = latest_by_key(comments, "comment_id", "ingested_at", tie_break)
    kept = newest.filter(F.col("comment_id").isNotNull() & F.col("post_id").isNotNull()
                         & (F.col("is_deleted") == F.lit(False)))
    ca = TF.to_ntz("commented_at")
    return kept.select(
        "comment_id", "post_id", "user_id",
        _trim("content").alias("content"),
        _to_int(kept, "like_count").alias("like_count"),
        F.lower("sentiment").alias("sentiment"),
        F.col("is_deleted").cast("boolean").alias("is_deleted"),
        ca.alias("commented_at"),
        TF.trunc_day(ca).alias("comment_day"),
        TF.to_ntz("ingested_at").alias("ingested_at"),
        "source_system",
        now.alias("transformed_at"),
    )


def stage_likes(likes: DataFrame, as_of: str | Column | None = None,
                tie_break: Sequence[str] = ("reaction_type", "post_id", "user_id", "liked_at")) -> DataFrame:
    """stg_likes: no delete filter and no user_id filter (as the reference);
    ties as in ``stage_comments``."""
    now = as_of_col(as_of)
    newest = latest_by_key(likes, "like_id", "ingested_at", tie_break)
    kept = newest.filter(F.col("like_id").isNotNull() & F.col("post_id").isNotNull())
    la = TF.to_ntz("liked_at")
    return kept.select(
        "like_id", "post_id", "user_id",
        F.lower("reaction_type").alias("reaction_type"),
        la.alias("liked_at"),
        TF.trunc_day(la).alias("like_day"),
        TF.to_ntz("ingested_at").alias("ingested_at"),
        "source_system",
        now.alias("transformed_at"),
    )


def quarantine_bad_casts(df: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split rows whose text does not cast (the reference engine raises on
    them, as does Spark's ANSI cast).  Returns ``(good, bad)``; ``bad``
    carries a ``bad_columns`` array naming the failed casts, so one bad
    value parks its row instead of failing a 100 TB job.  Both sides come
    from one predicate evaluated per row (``try_cast``); no extra pass."""
    failed = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
              for c, t in casts.items()]
    marked = df.withColumn("bad_columns", F.filter(F.array(*failed), lambda x: x.isNotNull()))
    bad = marked.where(F.size("bad_columns") > 0)
    good = marked.where(F.size("bad_columns") == 0).drop("bad_columns")
    return good, bad
