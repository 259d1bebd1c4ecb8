"""Streaming queries: codec, normaliser, routing, windows (batch twins with
SQL oracles) and the Structured Streaming jobs themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import reports
from tidemark.plans.oracle import CTES, sliding, sql
from tidemark.plans.registry import AS_OF, b_comments, b_likes, b_posts, register, s_comments, s_likes, s_posts, shared_frame
from tidemark.session import scratch_path
from tidemark.sources import adapter, bronze, schemas
from tidemark.sources.sinks import append_partitioned, materialize, write_batch_tables
from tidemark.plans.silver import stage_posts
from tidemark.functions.tags import lenient_tags
from tidemark.streaming import events as EV
from tidemark.streaming import intervals, jobs
from tidemark.streaming.windows import (
    latest_window_top, latest_window_top_events, windowed_counts,
)

def pinned():
    """``as_of`` as a column (built lazily: importing needs no session)."""
    return F.lit(AS_OF).cast("timestamp_ntz")
FEED_COLS = ["entity", "event_type", "event_id", "post_id", "user_id", "content", "post_type",
             "hashtags", "hashtag_count", "language", "like_id", "reaction_type", "comment_id",
             "sentiment", "timestamp"]


@shared_frame
def feed(spark, d):
    return adapter.feed_events(spark, d)


# ---- codec (S6, K5), routing (T7), normaliser (P16) ------------------------

def _json_field(name: str, numeric: bool = False) -> str:
    if numeric:
        return f"'\"{name}\":' || CAST({name} AS VARCHAR)"
    return f"'\"{name}\":\"' || replace({name}, '\"', '\\\"') || '\"'"


def _encode_sql() -> str:
    arms = []
    for ent, fields in EV.FIELDS.items():
        parts = " || ',' || ".join(_json_field(f, f == "hashtag_count") for f in fields)
        arms.append(f"WHEN '{ent}' THEN '{{' || {parts} || '}}'")
    return (f"SELECT post_id AS key, CASE entity {' '.join(arms)} END AS value, "
            f"'social.' || entity AS topic FROM feed")


@register("encode_events", sql(_encode_sql()))
def q_encode(spark, d):
    return EV.encode_events(feed(spark, d))


@register("decode_events", sql(f"SELECT {', '.join(FEED_COLS)} FROM feed"))
def q_decode(spark, d):
    return EV.decode_events(EV.encode_events(feed(spark, d))).select(*FEED_COLS)


@register("route_events", sql("SELECT entity, event_id, post_id FROM feed"))
def q_route(spark, d):
    routed = EV.route_events(EV.decode_events(EV.encode_events(feed(spark, d))))
    out = None
    for ent in EV.ENTITIES:
        part = routed[ent].select("entity", "event_id", "post_id")
        out = part if out is None else out.unionByName(part)
    return out


@register("stream_to_bronze", sql(f"""
    SELECT post_id, user_id, content, post_type, language, CAST(NULL AS VARCHAR) AS media_url,
           hashtags, coalesce(hashtag_count, 0) AS hashtag_count, CAST(0 AS BIGINT) AS like_count,
           CAST(0 AS BIGINT) AS comment_count, CAST(0 AS BIGINT) AS repost_count,
           CAST(0 AS BIGINT) AS view_count, 0.0::DOUBLE AS raw_engagement_score,
           false AS is_viral, false AS is_deleted, false AS is_nsfw,
           CAST(NULL AS VARCHAR) AS geo_country, CAST("timestamp" AS TIMESTAMP) AS post_date,
           TIMESTAMP '{AS_OF}' AS ingested_at, 'kafka_stream' AS source_system, event_id,
           TIMESTAMP '{AS_OF}' AS consumed_at, 2002 AS year, 1 AS month, 1 AS day
    FROM feed WHERE entity = 'posts'"""))
def q_to_bronze(spark, d):
    dec = EV.decode_events(EV.encode_events(feed(spark, d)))
    return EV.to_bronze(dec, "posts", consumed_at=pinned())


def _arm(entity: str, cols: str) -> str:
    return sql(f"""
    SELECT {cols}, '2002-01-01T00:00:00.000000' AS ingested_at, 'kafka_stream' AS source_system, event_id,
           TIMESTAMP '{AS_OF}' AS consumed_at, 2002 AS year, 1 AS month, 1 AS day
    FROM feed WHERE entity = '{entity}'""")


@register("stream_to_bronze_likes", _arm("likes", 'like_id, post_id, user_id, reaction_type, "timestamp" AS liked_at'))
def q_to_bronze_likes(spark, d):
    return EV.to_bronze(EV.decode_events(EV.encode_events(feed(spark, d))), "likes", consumed_at=pinned())


@register("stream_to_bronze_comments", _arm("comments", """comment_id, post_id, user_id, content,
    CAST(0 AS BIGINT) AS like_count, sentiment, false AS is_deleted, "timestamp" AS commented_at"""))
def q_to_bronze_comments(spark, d):
    return EV.to_bronze(EV.decode_events(EV.encode_events(feed(spark, d))), "comments", consumed_at=pinned())


# ---- windows: batch twins (T1-T3, T8) ---------------------------------------

def _tag_events(spark, d):
    f = feed(spark, d).where(F.col("entity") == "posts")
    return f.select("_ts", F.explode(lenient_tags("hashtags")).alias("hashtag"))


CTES["w_tags"] = sliding("feed_tags", "_ts", "hashtag")


@register("trending_windows", sql("SELECT * FROM w_tags"))
def q_trending_windows(spark, d):
    return windowed_counts(_tag_events(spark, d), "_ts", ["hashtag"])


@register("reaction_windows", sql(sliding("(SELECT * FROM feed WHERE entity = 'likes') l",
                                          "_ts", "reaction_type")))
def q_reaction_windows(spark, d):
    return windowed_counts(feed(spark, d).where(F.col("entity") == "likes"), "_ts",
                           ["reaction_type"])


@register("sentiment_windows", sql(sliding("(SELECT * FROM feed WHERE entity = 'comments') c",
                                           "_ts", "sentiment")))
def q_sentiment_windows(spark, d):
    return windowed_counts(feed(spark, d).where(F.col("entity") == "comments"), "_ts",
                           ["sentiment"])


@register("latest_window_top", sql("""
    SELECT window_start, window_end, hashtag, n,
           row_number() OVER (ORDER BY n DESC, hashtag) AS rank
    FROM w_tags
    WHERE window_end = (SELECT max(window_end) FROM w_tags
                        WHERE window_end <= (SELECT max(window_start) FROM w_tags))
    ORDER BY n DESC, hashtag LIMIT 5"""))
def q_latest_top(spark, d):
    return latest_window_top_events(_tag_events(spark, d), "_ts", "hashtag", 5)


@register("latest_window_top_table", sql("""
    SELECT window_start, window_end, hashtag, n,
           row_number() OVER (ORDER BY n DESC, hashtag) AS rank
    FROM w_tags
    WHERE window_end = (SELECT max(window_end) FROM w_tags
                        WHERE window_end <= (SELECT max(window_start) FROM w_tags))
    ORDER BY n DESC, hashtag LIMIT 5"""))
def q_latest_top_table(spark, d):
    counts = windowed_counts(_tag_events(spark, d), "_ts", ["hashtag"])
    table = materialize(counts, scratch_path(spark, "window-table"))
    return latest_window_top(table, "hashtag", 5)


# ---- K8: the three small batch tables -------------------------------------

@register("stream_batch_tables", sql(f"""
    SELECT 'trending_hashtags' AS "table", hashtag AS value, count(*) AS n, {'TIMESTAMP ' + repr(AS_OF)} AS window_end
    FROM (SELECT trim(tag) AS hashtag FROM (
            SELECT unnest(from_json(hashtags, '["varchar"]')) AS tag FROM b_posts) t
          WHERE trim(tag) <> '') x GROUP BY hashtag
    UNION ALL SELECT 'reaction_counts', reaction_type, count(*), {'TIMESTAMP ' + repr(AS_OF)}
    FROM b_likes GROUP BY reaction_type
    UNION ALL SELECT 'comment_sentiment', sentiment, count(*), {'TIMESTAMP ' + repr(AS_OF)}
    FROM b_comments GROUP BY sentiment"""))
def q_batch_tables(spark, d):
    tables = {
        "trending_hashtags": reports.trending_hashtags(b_posts(spark, d), pinned()),
        "reaction_counts": reports.reaction_counts(b_likes(spark, d), pinned()),
        "comment_sentiment": reports.comment_sentiment(b_comments(spark, d), pinned()),
    }
    root = write_batch_tables(tables, scratch_path(spark, "gold-streaming"))
    value = {"trending_hashtags": ("hashtag", "post_count"),
             "reaction_counts": ("reaction_type", "reaction_count"),
             "comment_sentiment": ("sentiment", "comment_count")}
    out = None
    for name, (v, n) in value.items():
        part = spark.read.parquet(f"{root}/{name}").select(
            F.lit(name).alias("table"), F.col(v).alias("value"), F.col(n).alias("n"),
            "window_end")
        out = part if out is None else out.unionByName(part)
    return out


# ---- Structured Streaming jobs ----------------------------------------------
# The feed's drops are read one per trigger, so that watermarks and state
# pass through several micro-batches.

def _messages(spark, d, replay=None):
    path = jobs.write_feed(feed(spark, d), scratch_path(spark, "feed"), parts=4, replay=replay)
    return jobs.read_messages(spark, path, files_per_trigger=jobs.files_a_drop(spark, path, 5 if replay else 4))


def _closed(windows: str, events: str) -> str:
    """Windows that the watermark has passed when the feed ends."""
    return sql(f"""SELECT * FROM ({windows}) w
    WHERE window_end <= (SELECT max(_ts) FROM {events}) - INTERVAL 10 MINUTE""")


def _naive(windows):
    """Session-zone (UTC) timestamps as the plain ones of the batch twins."""
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register("trending_windows_stream", _closed("SELECT * FROM w_tags", "feed_tags"))
def q_trending_stream(spark, d):
    return _naive(jobs.stream_window_counts(_messages(spark, d), scratch_path(spark, "sink"),
                                            scratch_path(spark, "ckpt"), "posts", "hashtag"))


@register("late_events_dropped", _closed(
    sliding("(SELECT * FROM feed WHERE entity = 'likes') l", "_ts", "reaction_type", 600, 600),
    "(SELECT * FROM feed WHERE entity = 'likes') l"))
def q_late(spark, d):
    return _naive(jobs.stream_window_counts(_messages(spark, d, replay="late"), scratch_path(spark, "sink"),
                                            scratch_path(spark, "ckpt"), "likes", "reaction_type",
                                            size="10 minutes", slide="10 minutes"))


@register("late_events_split", sql("""
    SELECT entity, event_id, false AS late FROM feed
    UNION ALL SELECT entity, event_id, true FROM feed
    WHERE _seq % 20 = 0 AND _seq < (SELECT greatest(1, (max(_seq) - min(_seq) + 4) // 4) FROM feed)"""))
def q_late_split(spark, d):
    """Every event of the feed and the late re-sent ones, each in one of the two sinks."""
    on_time, late = jobs.stream_late_split(_messages(spark, d, replay="late"), scratch_path(spark, "split"), scratch_path(spark, "ckpt"))
    return (on_time.select("entity", "event_id", F.lit(False).alias("late"))
            .unionByName(late.select("entity", "event_id", F.lit(True).alias("late"))))


@register("stream_dedup", sql("SELECT entity, event_id, post_id, _ts AS event_time FROM feed"))
def q_stream_dedup(spark, d):
    out = jobs.stream_dedup(_messages(spark, d, replay="dup"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt"))
    return out.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@register("stream_bronze_writer", sql("""
    SELECT post_id, user_id, trim(content) AS content, post_type, language, CAST(NULL AS VARCHAR) AS media_url,
           hashtags, CAST(hashtag_count AS INTEGER) AS hashtag_count, event_id,
           CAST("timestamp" AS TIMESTAMP) AS post_date, 'low' AS engagement_tier, 'ok' AS dq_flag
    FROM feed WHERE entity = 'posts'"""))
def q_stream_bronze(spark, d):
    """Streamed posts, re-sent ones dropped, reach silver; the clock columns
    are left out, and the event ids come from bronze."""
    root = jobs.stream_to_bronze_lake(_messages(spark, d, replay="dup"), scratch_path(spark, "bronze"),
                                      scratch_path(spark, "ckpt"), dedup="10 minutes")
    posts = bronze.read_facts(spark, root, "posts", schema=schemas.schema_of("posts", streamed=True))
    silver = stage_posts(posts, AS_OF).select(
        "post_id", "user_id", "content", "post_type", "language", "media_url", "hashtags",
        "hashtag_count", "post_date", "engagement_tier", "dq_flag")
    return silver.join(posts.select("post_id", "event_id"), "post_id")


@register("stream_totals", sql("""
    SELECT entity, count(*) AS rows, true AS several_batches FROM feed GROUP BY entity"""))
def q_stream_totals(spark, d):
    root = jobs.stream_to_bronze_lake(_messages(spark, d), scratch_path(spark, "bronze"), scratch_path(spark, "ckpt"))
    return jobs.stream_totals(spark, root).select("entity", "rows", (F.col("batches") > 1).alias("several_batches"))


@register("raw_variant_fields", sql("""
    SELECT entity, event_id, CASE WHEN _seq % 3 = 0 THEN 'c' || (_seq % 7) END AS campaign,
           CASE WHEN _seq % 3 = 0 THEN CAST(_seq AS BIGINT) END AS rank FROM feed"""))
def q_raw_variant(spark, d):
    """Messages with fields that no schema knows, landed by the bronze writer and asked for them."""
    more = F.concat(F.lit(',"more":{"campaign":"c'), F.col("_seq") % 7, F.lit('","rank":'), F.col("_seq"), F.lit("}}"))
    plain = EV.encode_events(feed(spark, d)).withColumn("_id", F.get_json_object("value", "$.event_id"))
    named = feed(spark, d).select(F.col("event_id").alias("_id"), F.when(F.col("_seq") % 3 == 0, more).otherwise("}").alias("_more"))
    path = scratch_path(spark, "feed")
    (plain.join(named, "_id").select("key", F.concat(F.expr("left(value, length(value) - 1)"), "_more").alias("value"), "topic")
     .write.json(path))
    root = jobs.stream_to_bronze_lake(jobs.read_messages(spark, path), scratch_path(spark, "bronze"), scratch_path(spark, "ckpt"))
    get = lambda path, kind: F.try_variant_get("event", path, kind)
    return jobs.raw_events(spark, root).select("entity", get("$.event_id", "string").alias("event_id"),
                                               get("$.more.campaign", "string").alias("campaign"), get("$.more.rank", "long").alias("rank"))


@register("stream_quarantine", sql(f"""
    SELECT 'social.stories' AS topic, value AS raw, 'unknown topic' AS reason
    FROM ({_encode_sql()}) m WHERE value LIKE '%0"}}'
    UNION ALL SELECT topic, left(value, 30), 'malformed' FROM ({_encode_sql()}) m WHERE value LIKE '%5"}}'
    UNION ALL SELECT 'posts', value, 'unknown topic' FROM ({_encode_sql()}) m WHERE value LIKE '%3"}}'
    UNION ALL SELECT topic, regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"yesterday"'), 'no time'
    FROM ({_encode_sql()}) m WHERE value LIKE '%7"}}'"""))
def q_quarantine(spark, d):
    """Messages of an unknown topic, of one without a dot, cut-off ones and some
    whose time is none, added to the feed."""
    good = EV.encode_events(feed(spark, d))
    stray = good.where(F.col("value").endswith('0"}')).withColumn("topic", F.lit("social.stories"))
    cut = good.where(F.col("value").endswith('5"}')).withColumn("value", F.substring("value", 1, 30))
    path = scratch_path(spark, "feed")
    dotless = good.where(F.col("value").endswith('3"}')).withColumn("topic", F.lit("posts"))
    timeless = good.where(F.col("value").endswith('7"}')).withColumn(
        "value", F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
    good.unionByName(stray).unionByName(cut).unionByName(dotless).unionByName(timeless).write.json(path)
    return jobs.stream_quarantine(jobs.read_messages(spark, path), scratch_path(spark, "sink"), scratch_path(spark, "ckpt"))


@register("stream_and_batch_lake", sql("""
    SELECT 'batch' AS origin, count(*) AS rows FROM b_posts WHERE _v = 1
    UNION ALL SELECT 'stream', count(*) FROM feed WHERE entity = 'posts'
    UNION ALL SELECT 'second stream', count(*) FROM feed WHERE entity = 'posts'"""))
def q_stream_and_batch(spark, d):
    """A batch and two streams of one day on one lake: none replaces another's rows."""
    root = scratch_path(spark, "lake")
    today = F.current_timestamp().cast("timestamp_ntz")
    rows = adapter.bronze_posts(spark, d, versions=(1,)).drop("year", "month", "day").withColumn("ingested_at", today)
    append_partitioned(rows, f"{root}/posts", 0)
    ids = []
    for _ in range(2):
        checkpoint = scratch_path(spark, "ckpt")
        jobs.stream_to_bronze_lake(_messages(spark, d), root, checkpoint)
        ids.append(jobs.run_number(spark, checkpoint))
    posts = bronze.read_facts(spark, root, "posts", schema=schemas.schema_of("posts", streamed=True))
    run = F.floor(-(F.col("batch_id") + 1) / F.lit(1 << 31))
    return posts.groupBy(F.when(F.col("batch_id") >= 0, "batch").when(run == ids[0], "stream")
                         .otherwise("second stream").alias("origin")).agg(F.count(F.lit(1)).alias("rows"))


# ---- J4 on streams ------------------------------------------------------------

def _dropped(spark, rows, ts, slices):
    """``rows`` as a stream whose files come in ``slices`` of time, and last a row
    100 years on, so that the watermark passes all others.  Returns the stream
    and the seconds that a slice takes."""
    path, whole = scratch_path(spark, "drops"), materialize(rows, scratch_path(spark, "rows"))
    at = F.unix_seconds(ts)
    b = whole.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    lo, hi = b["lo"] or 0, b["hi"] or 0
    width = (hi - lo) // slices + 1
    names = [c for c in whole.columns if c != ts]
    close = spark.range(1).select(*(F.lit(f"no {c}").alias(c) for c in names), F.timestamp_seconds(F.lit(hi + 100 * 365 * 86400)).alias(ts))
    for k in range(slices):
        whole.where(at.between(lo + k * width, lo + (k + 1) * width - 1)).write.mode("append").parquet(path)
    close.select(whole.columns).write.mode("append").parquet(path)
    return spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", "8").parquet(path), width


def _interval_sql(events: str, event_id: str, ts: str, days: int) -> str:
    return sql(f"""
    SELECT {event_id} AS event_id, post_id, EXISTS (
             SELECT 1 FROM s_posts p WHERE p.post_id = e.post_id AND p.post_date <= e.{ts}
             AND p.post_date + INTERVAL {days} DAY >= e.{ts}) AS in_time
    FROM {events} e WHERE post_id IS NOT NULL AND {ts} IS NOT NULL""")


def _interval_check(spark, d, events, event_id, ts, days):
    left, width = _dropped(spark, intervals.judged(events, event_id, ts), "event_time", 4)
    right, other = _dropped(spark, intervals.dated(s_posts(spark, d)), "post_date", 4)
    # files of two neighbouring slices may share a trigger: none of their rows is late
    found = intervals.stream_interval_check(left, right, scratch_path(spark, "sink"), scratch_path(spark, "ckpt"),
                                            f"{days} days", f"{2 * max(width, other)} seconds")
    return found.select("event_id", "post_id", F.col("post_date").isNotNull().alias("in_time"))


# the given orders that posts stand on are 25 to 32 years older than the events
LONGEST = {"likes": 10_000, "comments": 9_600}


@register("stream_interval_likes", _interval_sql("s_likes", "like_id", "liked_at", LONGEST["likes"]))
def q_interval_likes(spark, d):
    return _interval_check(spark, d, s_likes(spark, d), "like_id", "liked_at", LONGEST["likes"])


@register("stream_interval_comments", _interval_sql("s_comments", "comment_id", "commented_at", LONGEST["comments"]))
def q_interval_comments(spark, d):
    return _interval_check(spark, d, s_comments(spark, d), "comment_id", "commented_at", LONGEST["comments"])
