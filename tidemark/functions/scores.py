"""Post engagement measures (silver layer)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.rounding import round_half_away

# Fixed values that must equal the reference's for right results:
# tier thresholds on the raw score and the data-quality flag texts.
TIER_VIRAL = 5.0
TIER_HIGH = 1.0
TIER_MEDIUM = 0.1
ENGAGEMENT_TIERS = ("viral", "high", "medium", "low")
FLAG_LIKES_EXCEED_VIEWS = "anomaly: likes exceed views"
FLAG_NEGATIVE_COUNTS = "anomaly: negative counts"
FLAG_OK = "ok"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weighted_interactions(likes="like_count", comments="comment_count",
                          reposts="repost_count") -> Column:
    """likes + 2*comments + 3*reposts as BIGINT (no 32-bit overflow)."""
    return (_c(likes).cast("long") + _c(comments).cast("long") * 2
            + _c(reposts).cast("long") * 3)


def engagement_score(likes="like_count", comments="comment_count",
                     reposts="repost_count", views="view_count") -> Column:
    """Weighted interactions per view * 100, 4 decimals, capped at 100.

    Division by a zero view count gives NULL, and LEAST skips NULL, so a
    zero-view post scores exactly 100.0 (reference behaviour).
    """
    ratio = (weighted_interactions(likes, comments, reposts).cast("double")
             / F.nullif(_c(views).cast("long"), F.lit(0)) * F.lit(100))
    return F.least(round_half_away(ratio, 4), F.lit(100.0))


def raw_engagement_score(likes="like_count", comments="comment_count",
                         reposts="repost_count", views="view_count") -> Column:
    """Uncapped score dividing by max(views, 1); 4 decimals."""
    ratio = (weighted_interactions(likes, comments, reposts).cast("double")
             / F.greatest(_c(views).cast("long"), F.lit(1)) * F.lit(100))
    return round_half_away(ratio, 4)


def engagement_tier(raw_score="raw_engagement_score") -> Column:
    """Tier from the *uncapped* raw score; NULL falls to 'low'."""
    s = _c(raw_score)
    return (F.when(s >= TIER_VIRAL, "viral")
            .when(s >= TIER_HIGH, "high")
            .when(s >= TIER_MEDIUM, "medium")
            .otherwise("low"))


def dq_flag(likes="like_count", views="view_count") -> Column:
    """Row quality flag; order matters and NULL comparisons fall to 'ok'."""
    lk, vw = _c(likes), _c(views)
    return (F.when(vw < lk, FLAG_LIKES_EXCEED_VIEWS)
            .when((lk < 0) | (vw < 0), FLAG_NEGATIVE_COUNTS)
            .otherwise(FLAG_OK))
