"""Declared bronze schemas: what readers expect of each entity's files.

With a declared schema no reader opens file footers to find out which columns
exist: a column that a file lacks reads as NULL (union by name), and filters
on the ingest date prune partition folders before any file is touched.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITIES = ("users", "posts", "comments", "likes")
FACTS = ("posts", "comments", "likes")
PARTITIONS = ("year", "month", "day")


_DDL = {
    "users": "user_id string, username string, display_name string, email string, bio string, location string, "
             "website string, profile_image_url string, account_type string, account_status string, "
             "is_verified boolean, language string, follower_count bigint, following_count bigint, "
             "post_count bigint, joined_at timestamp_ntz, last_active_at timestamp_ntz, "
             "ingested_at timestamp_ntz, source_system string",
    "posts": "post_id string, user_id string, content string, post_type string, language string, media_url string, "
             "hashtags string, hashtag_count bigint, like_count bigint, comment_count bigint, repost_count bigint, "
             "view_count bigint, raw_engagement_score double, is_viral boolean, is_deleted boolean, is_nsfw boolean, "
             "geo_country string, post_date timestamp_ntz, ingested_at timestamp_ntz, source_system string",
    "comments": "comment_id string, post_id string, user_id string, content string, like_count bigint, "
                "sentiment string, is_deleted boolean, commented_at string, ingested_at string, source_system string",
    "likes": "like_id string, post_id string, user_id string, reaction_type string, liked_at string, "
             "ingested_at string, source_system string",
}
_PARTITION_DDL = ", year int, month int, day int, batch_id bigint"


def schema_of(entity: str, streamed: bool = False) -> T.StructType:
    """The columns of an entity; ``streamed`` adds what the stream writer carries."""
    ddl = _DDL[entity] + (", event_id string, consumed_at timestamp_ntz" if streamed else "")
    return T.StructType.fromDDL(ddl + (_PARTITION_DDL if entity in FACTS else ""))


def read(spark: SparkSession, root: str, entity: str, schema: T.StructType | None = None) -> DataFrame:
    path = f"{root}/{entity}"
    return spark.read.schema(schema or schema_of(entity)).option("basePath", path).parquet(path)


def ingested_between(start: str | None = None, end: str | None = None) -> Column:
    """Ingest date in [start, end] (``yyyy-MM-dd``) as comparisons of the plain
    partition columns, which a catalog or the file index can prune by."""
    y, m, d = (F.col(c) for c in PARTITIONS)
    out = F.lit(True)
    if start:
        a = datetime.date.fromisoformat(start)
        out = out & ((y > a.year) | ((y == a.year) & ((m > a.month) | ((m == a.month) & (d >= a.day)))))
    if end:
        b = datetime.date.fromisoformat(end)
        out = out & ((y < b.year) | ((y == b.year) & ((m < b.month) | ((m == b.month) & (d <= b.day)))))
    return out
