"""Event messages: decode (S6), encode (K5), route (T7), normalise.

A message is ``(key, value, topic)``: key = ``post_id``, value = UTF-8
JSON, topic ``social.<entity>``.  Everything here is a plain DataFrame
transformation, so the same code runs on a Kafka stream, a file stream or
a batch frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rounding import round_half_away

TOPIC_PREFIX = "social."
ENTITIES = ("posts", "likes", "comments")

# Event types per topic, as produced upstream.
EVENT_TYPES = {"posts": "post_published", "likes": "post_liked", "comments": "comment_posted"}

EVENT_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("post_type", T.StringType()),
    T.StructField("hashtags", T.StringType()),
    T.StructField("hashtag_count", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("like_id", T.StringType()),
    T.StructField("reaction_type", T.StringType()),
    T.StructField("comment_id", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

FIELDS = {
    "posts": ["event_type", "post_id", "user_id", "content", "post_type", "hashtags",
              "hashtag_count", "language", "timestamp", "event_id"],
    "likes": ["event_type", "like_id", "post_id", "user_id", "reaction_type", "timestamp",
              "event_id"],
    "comments": ["event_type", "comment_id", "post_id", "user_id", "content", "sentiment",
                 "timestamp", "event_id"],
}


def entity_of(topic: Column) -> Column:
    """``social.posts`` -> ``posts``; null for topics without the prefix."""
    return F.when(F.startswith(topic, F.lit(TOPIC_PREFIX)), F.substring(topic, len(TOPIC_PREFIX) + 1, 1 << 20))


def event_time(text: Column) -> Column:
    """ISO-8601 text as a plain timestamp; null if it is none."""
    return text.try_cast("timestamp_ntz")


def encode_events(events: DataFrame, entity_col: str = "entity") -> DataFrame:
    """K5: one message per event, JSON with only the entity's fields.

    ``publish_events`` sends the result.
    """
    ent = F.col(entity_col)
    value = None
    for e in ENTITIES:
        js = F.to_json(F.struct(*[F.col(c) for c in FIELDS[e]]))
        value = F.when(ent == e, js) if value is None else value.when(ent == e, js)
    return events.select(F.col("post_id").alias("key"), value.alias("value"),
                         F.concat(F.lit(TOPIC_PREFIX), ent).alias("topic"))


def decode_events(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """bytes/text -> JSON -> columns, entity from the topic suffix.

    Malformed JSON yields a row of NULL fields (PERMISSIVE); those rows keep
    their ``raw`` text so a quarantine sink can pick them up.  Nothing in a
    message raises an error, whatever its topic, time or JSON.
    """
    raw = F.col("value").cast("string")
    parsed = F.from_json(raw, EVENT_SCHEMA)
    return messages.select(*keep, entity_of(F.col("topic")).alias("entity"),
                           raw.alias("raw"), parsed.alias("e")).select(*keep, "entity", "raw", "e.*")


def _reason(topic_known: Column) -> Column:
    """Why a decoded message cannot become a bronze row; NULL when it can."""
    return (F.when(~F.coalesce(topic_known, F.lit(False)), "unknown topic")
            .when(F.col("event_id").isNull() | F.col("timestamp").isNull(), "malformed")
            .when(event_time(F.col("timestamp")).isNull(), "no time"))


def good_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(_reason(F.col("entity").isin(*ENTITIES)).isNull())


def bad_messages(decoded: DataFrame) -> DataFrame:
    """``(topic, raw, reason)`` of the messages that ``good_messages`` leaves out."""
    return (decoded.withColumn("reason", _reason(F.col("entity").isin(*ENTITIES)))
            .where(F.col("reason").isNotNull()).select("topic", "raw", "reason"))


def route_events(decoded: DataFrame) -> dict[str, DataFrame]:
    """One subscription, three entity frames."""
    return {e: decoded.where(F.col("entity") == e) for e in ENTITIES}


def _ymd(ts: Column) -> list[Column]:
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day")]


def to_bronze(decoded: DataFrame, entity: str, consumed_at: Column | None = None,
              source_system: str = "kafka_stream") -> DataFrame:
    """Give stream events the bronze shape so silver can read them.

    ``timestamp`` becomes the entity's event-time column, deletion flags
    default to false (silver's ``is_deleted = false`` would drop NULL),
    counters default to 0, and ``ingested_at`` is the consume time, which
    also decides the date partition.
    """
    now = consumed_at if consumed_at is not None else F.current_timestamp().cast("timestamp_ntz")
    d = decoded.where(F.col("entity") == entity).withColumn("__ing", now)
    ing = F.col("__ing")
    zero = F.lit(0).cast("long")
    if entity == "posts":
        out = d.select(
            "post_id", "user_id", "content", "post_type", "language",
            F.lit(None).cast("string").alias("media_url"), "hashtags",
            F.coalesce(F.col("hashtag_count"), zero).alias("hashtag_count"),
            zero.alias("like_count"), zero.alias("comment_count"),
            zero.alias("repost_count"), zero.alias("view_count"),
            round_half_away(F.lit(0.0), 4).alias("raw_engagement_score"),
            F.lit(False).alias("is_viral"), F.lit(False).alias("is_deleted"),
            F.lit(False).alias("is_nsfw"), F.lit(None).cast("string").alias("geo_country"),
            event_time(F.col("timestamp")).alias("post_date"),
            ing.alias("ingested_at"), F.lit(source_system).alias("source_system"),
            "event_id", ing.alias("consumed_at"), *_ymd(ing))
    elif entity == "likes":
        out = d.select(
            "like_id", "post_id", "user_id", "reaction_type",
            F.col("timestamp").alias("liked_at"),
            F.date_format(ing, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
            F.lit(source_system).alias("source_system"), "event_id",
            ing.alias("consumed_at"), *_ymd(ing))
    elif entity == "comments":
        out = d.select(
            "comment_id", "post_id", "user_id", "content", zero.alias("like_count"),
            "sentiment", F.lit(False).alias("is_deleted"),
            F.col("timestamp").alias("commented_at"),
            F.date_format(ing, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
            F.lit(source_system).alias("source_system"), "event_id",
            ing.alias("consumed_at"), *_ymd(ing))
    else:
        raise ValueError(f"unknown entity {entity!r}")
    return out


def kafka_source(spark, bootstrap: str, topics: tuple[str, ...] = tuple(TOPIC_PREFIX + e for e in ENTITIES),
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None):
    """Subscribe to the three topics (needs the spark-sql-kafka package
    on the classpath; it is not bundled, so this is not exercised offline).
    Offsets live in the query checkpoint, replacing consumer-group commits."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", ",".join(topics))
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def publish_events(events: DataFrame, bootstrap: str) -> None:
    """K5: encode and send events to their topics, acknowledged by all
    replicas and retried (needs the Kafka connector on the classpath)."""
    (encode_events(events).write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("kafka.acks", "all").option("kafka.retries", "3").save())
