"""Registry of parity queries: name -> (Spark builder, SQL oracle or None).

Every builder takes ``(spark, sf_dir)`` and reads the driver's tables under
``sf_dir`` (through the adapter), so its work grows with the data.  The
oracle is the same computation in DuckDB SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordinal import write_ordered
from tidemark.plans import gold, oracle, silver
from tidemark.session import input_fingerprint, scratch_path
from tidemark.sources import adapter

AS_OF = "2002-01-01 00:00:00"

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    note: str = ""


_REGISTRY: dict[str, Query] = {}


def register(name: str, oracle_sql: str | None, note: str = ""):
    def deco(fn: Builder) -> Builder:
        _REGISTRY[name] = Query(name, fn, oracle_sql, note)
        return fn
    return deco


# ---- shared base frames -----------------------------------------------------
# DataFrames are immutable lazy plans: the bronze/silver/gold frames every
# query starts from are built (and analysed) once per session and input
# folder and the plan objects are reused.  No data is cached; each query
# still executes its whole computation from the input tables.  A plan freezes
# its list of input files, so a changed input gets new plans.

_FRAMES: dict[tuple, DataFrame] = {}


def shared_frame(fn):
    def build(spark, d):
        files = input_fingerprint(spark, *(f"{d.rstrip('/')}/{t}.parquet" for t in adapter.TABLES))
        key = (fn.__qualname__, fn.__module__, spark.sparkContext.applicationId, d, files)
        df = _FRAMES.get(key)
        if df is None or df.sparkSession is not spark:
            df = _FRAMES[key] = fn(spark, d)
        return df
    build.__name__ = fn.__name__
    build.__qualname__ = fn.__qualname__
    build.__doc__ = fn.__doc__
    return build


@shared_frame
def b_users(spark, d):
    return adapter.bronze_users(spark, d)


@shared_frame
def b_posts(spark, d):
    return adapter.bronze_posts(spark, d)


@shared_frame
def b_comments(spark, d):
    return adapter.bronze_comments(spark, d)


@shared_frame
def b_likes(spark, d):
    return adapter.bronze_likes(spark, d)


@shared_frame
def s_users(spark, d):
    return silver.stage_users(b_users(spark, d), AS_OF)


@shared_frame
def s_posts(spark, d):
    return silver.stage_posts(b_posts(spark, d), AS_OF)


@shared_frame
def s_comments(spark, d):
    return silver.stage_comments(b_comments(spark, d), AS_OF)


@shared_frame
def s_likes(spark, d):
    return silver.stage_likes(b_likes(spark, d), AS_OF)


# ---- silver -----------------------------------------------------------------

register("stg_users", oracle.sql("SELECT * FROM s_users"))(s_users)
register("stg_posts", oracle.sql("SELECT * FROM s_posts"))(s_posts)
register("stg_comments", oracle.sql("SELECT * FROM s_comments"))(s_comments)
register("stg_likes", oracle.sql("SELECT * FROM s_likes"))(s_likes)


# ---- gold -------------------------------------------------------------------

@register("mart_daily_engagement", oracle.sql("SELECT * FROM g_daily"))
def q_daily(spark, d):
    return gold.daily_engagement(s_posts(spark, d), AS_OF)


@register("mart_hashtag_performance", oracle.sql("SELECT * FROM g_hashtags"))
def q_hashtags(spark, d):
    return gold.hashtag_performance(s_posts(spark, d), AS_OF)


@register("mart_user_performance", oracle.sql("SELECT * FROM g_users"))
def q_users(spark, d):
    return gold.user_performance(s_users(spark, d), s_posts(spark, d), AS_OF)


# ---- O7: marts in their order, with the place of each row ------------------------

def _ordered(order, sql_order: str, mart: str):
    def deco(fn):
        def build(spark, d):
            return write_ordered(fn(spark, d), scratch_path(spark, mart), order())
        register(f"{mart}_ordered", oracle.sql(
            f"SELECT *, row_number() OVER (ORDER BY {sql_order}) AS ordinal FROM {fn.__doc__}"))(build)
        return fn
    return deco


@_ordered(lambda: [F.col("date").desc()], "date DESC", "mart_daily_engagement")
def _daily(spark, d):
    """g_daily"""
    return gold.daily_engagement(s_posts(spark, d), AS_OF, ordered=False)


@_ordered(lambda: [F.col("trending_score").desc_nulls_last(), F.col("hashtag")],
          "trending_score DESC NULLS LAST, hashtag", "mart_hashtag_performance")
def _hashtags(spark, d):
    """g_hashtags"""
    return gold.hashtag_performance(s_posts(spark, d), AS_OF, ordered=False)


@_ordered(lambda: [F.col("total_likes_received").desc_nulls_last(), F.col("user_id"), F.col("username")],
          "total_likes_received DESC NULLS LAST, user_id, username", "mart_user_performance")
def _users(spark, d):
    """g_users"""
    return gold.user_performance(s_users(spark, d), s_posts(spark, d), AS_OF)


def _load_extensions() -> None:
    # Further query groups register themselves on import.
    from tidemark.plans import registry_more, registry_sources, registry_stream  # noqa: F401


@lru_cache(maxsize=1)
def all_queries() -> dict[str, Query]:
    _load_extensions()
    return dict(_REGISTRY)
