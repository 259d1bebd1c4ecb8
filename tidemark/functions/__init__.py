"""Column builders: pure ``Column -> Column`` helpers, all JVM-side."""

from tidemark.functions.rounding import round_half_away
from tidemark.functions.scores import (
    dq_flag, engagement_score, engagement_tier, raw_engagement_score,
)
from tidemark.functions.tags import json_tags, lenient_tags, split_tags
from tidemark.functions.timecols import (
    day_of_week, hour_of_day, is_weekend, to_ntz, trunc_day, trunc_hour,
    trunc_month, trunc_week,
)
from tidemark.functions.users import (
    account_age_days, follower_ratio, influencer_tier, is_influencer,
)

__all__ = [
    "round_half_away", "engagement_score", "raw_engagement_score",
    "engagement_tier", "dq_flag", "json_tags", "split_tags", "lenient_tags",
    "to_ntz", "trunc_hour", "trunc_day", "trunc_week", "trunc_month",
    "hour_of_day", "day_of_week", "is_weekend", "influencer_tier",
    "is_influencer", "follower_ratio", "account_age_days",
]
