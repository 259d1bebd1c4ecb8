"""User profile measures (silver layer)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.rounding import round_half_away

# Fixed values that must equal the reference's: follower-count tier bounds
# (inclusive lower bounds) and the influencer threshold.
INFLUENCER_TIERS = (("mega", 1_000_000), ("macro", 100_000),
                    ("micro", 10_000), ("nano", 1_000))
INFLUENCER_FLOOR_NAME = "regular"
INFLUENCER_MIN_FOLLOWERS = 10_000


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def influencer_tier(followers="follower_count") -> Column:
    f = _c(followers)
    expr = None
    for name, bound in INFLUENCER_TIERS:
        expr = F.when(f >= bound, name) if expr is None else expr.when(f >= bound, name)
    return expr.otherwise(INFLUENCER_FLOOR_NAME)


def is_influencer(followers="follower_count") -> Column:
    """NULL followers stay NULL (three-valued comparison)."""
    return _c(followers) >= INFLUENCER_MIN_FOLLOWERS


def follower_ratio(followers="follower_count", following="following_count") -> Column:
    """followers / following, 2 decimals; NULL unless following > 0."""
    fo = _c(following)
    return F.when(fo > 0, round_half_away(_c(followers).cast("double") / fo, 2))


def account_age_days(joined="joined_at", as_of: Column | None = None) -> Column:
    """Day boundaries crossed from ``joined`` to ``as_of`` (BIGINT)."""
    ref = as_of if as_of is not None else F.current_timestamp()
    return F.datediff(F.to_date(ref), F.to_date(_c(joined))).cast("long")
