"""Derive bronze social-activity frames from the driver's TPC-H-ish tables.

Test scaffolding, not an operator: the driver ships orders / customers /
events, not users / posts / likes.  Every column is a deterministic
expression both Spark and the SQL oracle evaluate identically (see
``tidemark.plans.oracle`` for the twin SQL), and every frame grows with the
input tables, so the pipeline's work scales with the scale factor.

    users    = customer (+ post-less and faulty copies) joined to nation
    posts    = orders left-joined to per-order lineitem totals, landed
               monthly; 5 % of the orders get a newer second version, 1 % of
               them deleted
    likes    = events of type click / view / purchase (+4 % re-ingested)
    comments = events of type signup / error (+2.5 % re-ingested)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rounding import round_half_away

SOURCE_SYSTEM = "tpch_adapter"
#: the tables that bronze frames are derived from
TABLES = ("customer", "nation", "orders", "lineitem", "events")
NO_POST_USER_OFFSET = 10_000_000
# Added rows: code -> every how many keys one is made.  They exist so that each
# quality check has something to find; nothing is ever taken away for them.
USER_FAULTS = {1: 50, 2: 41, 3: 43, 4: 47, 5: 53}
POST_FAULTS = {1: 61, 2: 67, 3: 71, 4: 73, 5: 79, 6: 83, 7: 89}
EVENT_FAULTS = {1: 59, 2: 61}
NO_VIEWS_DAY = "2001-11-11 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _secs(n: Column, base: Column) -> Column:
    return F.timestamp_add("SECOND", n, base)


def _case(key: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        cond = key == i
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


def _iso(ts: Column, micros: Column | None = None) -> Column:
    """ISO-8601 text as a Python writer produces it."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if micros is None:
        return full
    return F.when(micros, full).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))


def _ymd(ts: Column) -> list[Column]:
    return [F.year(ts).alias("year"), F.month(ts).alias("month"),
            F.dayofmonth(ts).alias("day")]


def _added(key: str, faults: dict[int, int]) -> Column:
    """Codes of the rows that a key makes: 0 always, each fault at its keys."""
    codes = [F.when(F.col(key) % every == 0, F.lit(code)) for code, every in faults.items()]
    return F.filter(F.array(F.lit(0), *codes), lambda x: x.isNotNull())


def _version_array(has_second: Column, versions: tuple[int, ...]) -> Column:
    """Versions a record exists in: always 1, and 2 when ``has_second``."""
    one = [F.lit(1)] if 1 in versions else []
    both = one + ([F.lit(2)] if 2 in versions else [])
    return F.when(has_second, F.array(*both) if both else F.array().cast("array<int>")) \
            .otherwise(F.array(*one) if one else F.array().cast("array<int>"))


def bronze_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    # added rows, generated in the same scan with explode: post-less users (1)
    # and faulty ones: unlisted enum values (2), no name (3), an id that
    # comes twice (4), no id (5)
    copy = F.col("__copy")
    both = (cust.withColumn("__copy", F.explode(_added("c_custkey", USER_FAULTS)))
            .withColumn("c_custkey", F.col("c_custkey") + F.when(copy == 4, 0).otherwise(copy) * NO_POST_USER_OFFSET))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    u = both.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    b = F.greatest(F.floor("c_acctbal").cast("long"), F.lit(0))
    joined = _secs(k * 7919 % 346896000, _ts("1990-01-01 00:00:00"))
    return u.select(
        F.when(copy != 5, k.cast("string")).alias("user_id"),
        F.when(copy != 3, F.concat(F.lit("  User_"), k.cast("string"), F.lit(" "))).alias("username"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("display_name"),
        F.concat(F.lit("  User"), k.cast("string"), F.lit("@Mail.Example ")).alias("email"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" buyer ")).alias("bio"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("location"),
        F.when(k % 5 != 0, F.concat(F.lit("https://u"), k.cast("string"), F.lit(".example.org"))).alias("website"),
        F.concat(F.lit("https://img.example.org/"), k.cast("string"), F.lit(".png")).alias("profile_image_url"),
        F.when(copy == 2, "Robot").otherwise(_case(k % 4, ["Personal", "business", "CREATOR", "news"])).alias("account_type"),
        F.when(copy == 2, "gone").otherwise(_case(k % 3, ["active", "Suspended", "inactive"])).alias("account_status"),
        (k % 33 == 0).alias("is_verified"),
        _case(F.col("c_nationkey") % 6, ["EN", "ur", "hi", "de", "Fr", "pt"]).alias("language"),
        # b^3 < 2^53 and the quotient's fraction is a multiple of 2e-6, so the
        # double division floors exactly like integer division.
        F.floor(b * b * b / F.lit(500000)).cast("long").alias("follower_count"),
        (k % 500).alias("following_count"),
        (k % 97).alias("post_count"),
        joined.alias("joined_at"),
        _secs(k % 86400, _ts("2001-06-01 00:00:00")).alias("last_active_at"),
        _ts("2001-12-31 00:00:00").alias("ingested_at"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )


def _order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("long").alias("q"), F.count(F.lit(1)).alias("n"))


def _tags_json(k: Column) -> Column:
    t1 = F.lower("o_orderpriority")
    t2 = F.concat(F.lit("status_"), F.lower("o_orderstatus"))
    t3 = F.concat(F.lit("x"), (k % 13).cast("string"))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    sep = F.lit(", ")
    return (F.when(k % 4 == 0, F.lit("[]"))
            .when(k % 4 == 1, F.concat(F.lit("["), q(t1), F.lit("]")))
            .when(k % 4 == 2, F.concat(F.lit("["), q(t1), sep, q(t2), F.lit("]")))
            .otherwise(F.concat(F.lit("["), q(t1), sep, q(t2), sep, q(t3), F.lit("]"))))


def bronze_posts(spark: SparkSession, sf_dir: str, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    o = orders.join(_order_totals(spark, sf_dir),
                    F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k = F.col("o_orderkey")
    q = F.coalesce(F.col("q"), F.lit(0).cast("long"))
    n = F.coalesce(F.col("n"), F.lit(0).cast("long"))
    base = o.select(
        k.alias("_k"),
        k.cast("string").alias("post_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat(F.lit("  Order "), k.cast("string"), F.lit(" status "),
                 F.col("o_orderstatus"), F.lit(" ")).alias("content"),
        _case(k % 5, ["text", "Image", "VIDEO", "link", "text"]).alias("post_type"),
        _case(k % 3, ["EN", "ur", "De"]).alias("language"),
        F.when(k % 3 == 0, F.concat(F.lit("https://media.example.org/"), k.cast("string"),
                                    F.lit(".jpg"))).alias("media_url"),
        _tags_json(k).alias("hashtags"),
        (k % 4).alias("hashtag_count"),
        (q * F.when(k % 50 == 0, 100).otherwise(1)).alias("like_count"),
        (n * (k % 7)).alias("comment_count"),
        (n * (k % 3)).alias("repost_count"),
        (q * (k % 1500 + 10)).alias("view_count"),
        (k % 97 == 0).alias("is_nsfw"),
        F.when(k % 10 != 0, F.concat(F.lit("C"), (k % 9).cast("string"))).alias("geo_country"),
        _secs(k % 86400, F.col("o_orderdate")).alias("post_date"),
        F.col("o_orderdate").alias("_d"),
    )
    # added rows: an author nobody knows and an unlisted type (1), negative
    # counts (2), no id (3), a day without views (4), a null tag (5), a
    # repeated tag and one of its own (6), another row of the same id and
    # ingest time (7)
    base = base.withColumn("_f", F.explode(_added("_k", POST_FAULTS)))
    f, key = F.col("_f"), F.col("_k").cast("string")
    base = (base
            .withColumn("post_id", F.when(f == 3, None).when(f.isin(0, 7), F.col("post_id"))
                        .otherwise(F.concat(F.lit("f"), f.cast("string"), F.lit("-"), key)))
            .withColumn("user_id", F.when(f == 1, F.concat(F.lit("ghost"), key)).otherwise(F.col("user_id")))
            .withColumn("post_type", F.when(f == 1, "Poll").otherwise(F.col("post_type")))
            .withColumn("content", F.when(f == 7, F.concat(F.lit("  tied "), key)).otherwise(F.col("content")))
            .withColumn("like_count", F.when(f == 2, F.lit(-5)).otherwise(F.col("like_count")).cast("long"))
            .withColumn("comment_count", F.when(f == 2, F.lit(0)).otherwise(F.col("comment_count")).cast("long"))
            .withColumn("repost_count", F.when(f == 2, F.lit(0)).otherwise(F.col("repost_count")).cast("long"))
            .withColumn("view_count", F.when(f == 2, F.lit(3)).when(f == 4, F.lit(0))
                        .otherwise(F.col("view_count")).cast("long"))
            .withColumn("post_date", F.when(f == 4, _secs(F.col("_k") % 86400, _ts(NO_VIEWS_DAY)))
                        .otherwise(F.col("post_date")))
            .withColumn("hashtags", F.when(f == 5, '["a", null]')
                        .when(f == 6, F.concat(F.lit('["u'), key, F.lit('", "a", "a"]'))).otherwise(F.col("hashtags")))
            .withColumn("hashtag_count", F.when(f == 5, F.lit(2)).when(f == 6, F.lit(3))
                        .otherwise(F.col("hashtag_count")).cast("long")))
    # Posts land as monthly backfill batches: first day of the next month.
    # 5 % of the orders get a second, newer version one day later (1 % of
    # them deleted).  Versions are generated in one pass with ``explode``, so
    # the orders scan and the line-total join run once for both.
    landed = F.add_months(F.trunc(F.to_date("_d"), "month"), 1).cast("timestamp_ntz")
    v = F.col("_v")
    both = (base.withColumn("_v", F.explode(_version_array((F.col("_k") % 20 == 0) & (F.col("_f") == 0), versions)))
            .withColumn("like_count", F.col("like_count") + F.when(v == 2, 1).otherwise(0))
            .withColumn("is_deleted", (v == 2) & (F.col("_k") % 100 == 0))
            .withColumn("ingested_at", F.timestamp_add("DAY", v - 1, landed)))
    return both.select(
        "post_id", "user_id", "content", "post_type", "language", "media_url",
        "hashtags", "hashtag_count", "like_count", "comment_count", "repost_count",
        "view_count",
        round_half_away(
            (F.col("like_count") + F.col("comment_count") * 2 + F.col("repost_count") * 3).cast("double")
            / F.greatest(F.col("view_count"), F.lit(1)) * F.lit(100), 4).alias("raw_engagement_score"),
        (F.col("like_count") * 50 > F.col("view_count")).alias("is_viral"),
        "is_deleted", "is_nsfw", "geo_country", "post_date", "ingested_at",
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        *_ymd(F.col("ingested_at")),
    )


def _events(spark: SparkSession, sf_dir: str, types: list[str]) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type").isin(*types))


def bronze_likes(spark: SparkSession, sf_dir: str, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    e = _events(spark, sf_dir, ["click", "view", "purchase"])
    k = F.col("event_id")
    reactions = ["like", "Love", "laugh", "WOW", "sad"]
    base = e.select(
        k.alias("_k"), F.col("ts").alias("_ts"),
        k.cast("string").alias("like_id"),
        F.get_json_object("props", "$.k").alias("post_id"),
        F.col("user_id").cast("string").alias("user_id"),
        _iso(F.col("ts"), k % 7 != 0).alias("liked_at"),
    ).withColumn("_f", F.explode(_added("_k", EVENT_FAULTS)))
    f = F.col("_f")  # added rows: an unlisted reaction (1), no id (2)
    base = base.withColumn("like_id", F.when(f == 1, F.concat(F.lit("f"), "like_id")).when(f == 0, F.col("like_id")))
    v = F.col("_v")
    both = (base.withColumn("_v", F.explode(_version_array((F.col("_k") % 25 == 0) & (f == 0), versions)))
            .withColumn("reaction_type", F.when(f == 1, "Angry").otherwise(_case((F.col("_k") + v - 1) % 5, reactions)))
            .withColumn("_ing", F.timestamp_add("HOUR", v, F.col("_ts"))))
    return both.select(
        "like_id", "post_id", "user_id", "reaction_type", "liked_at",
        _iso(F.col("_ing")).alias("ingested_at"),
        F.lit(SOURCE_SYSTEM).alias("source_system"), *_ymd(F.col("_ing")))


def bronze_comments(spark: SparkSession, sf_dir: str, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    e = _events(spark, sf_dir, ["signup", "error"])
    k = F.col("event_id")
    v = F.col("value")
    base = e.select(
        k.alias("_k"), F.col("ts").alias("_ts"),
        k.cast("string").alias("comment_id"),
        F.get_json_object("props", "$.k").alias("post_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("  comment "), k.cast("string"), F.lit("  ")).alias("content"),
        F.floor(v).cast("long").alias("like_count"),
        F.when(v < 20, "negative").when(v < 60, "Neutral").otherwise("POSITIVE").alias("sentiment"),
        _iso(F.col("ts"), k % 7 != 0).alias("commented_at"),
    ).withColumn("_f", F.explode(_added("_k", EVENT_FAULTS)))
    f = F.col("_f")  # added rows: an unlisted sentiment (1), no post (2)
    base = (base.withColumn("comment_id", F.when(f == 0, F.col("comment_id"))
                            .otherwise(F.concat(F.lit("f"), f.cast("string"), F.lit("-"), "comment_id")))
            .withColumn("sentiment", F.when(f == 1, "Mixed").otherwise(F.col("sentiment")))
            .withColumn("post_id", F.when(f != 2, F.col("post_id"))))
    v = F.col("_v")
    both = (base.withColumn("_v", F.explode(_version_array((F.col("_k") % 40 == 0) & (f == 0), versions)))
            .withColumn("is_deleted", F.when(v == 1, F.col("_k") % 33 == 0)
                        .otherwise(F.col("_k") % 80 == 0))
            .withColumn("_ing", F.timestamp_add("HOUR", v, F.col("_ts"))))
    return both.select(
        "comment_id", "post_id", "user_id", "content", "like_count", "sentiment",
        "is_deleted", "commented_at", _iso(F.col("_ing")).alias("ingested_at"),
        F.lit(SOURCE_SYSTEM).alias("source_system"), *_ymd(F.col("_ing")))


# ---- stream feed ------------------------------------------------------------

FEED_TAG_VOCAB = 12


def _feed_tags(k: Column) -> Column:
    """0-3 distinct tags per post event, JSON text with ", " separators."""
    t = [F.concat(F.lit('"tag'), ((k * 7 + off) % FEED_TAG_VOCAB).cast("string"), F.lit('"'))
         for off in (0, 3, 6)]
    n = k % 4
    return (F.when(n == 0, F.lit("[]"))
            .when(n == 1, F.concat(F.lit("["), t[0], F.lit("]")))
            .when(n == 2, F.concat(F.lit("["), t[0], F.lit(", "), t[1], F.lit("]")))
            .otherwise(F.concat(F.lit("["), t[0], F.lit(", "), t[1], F.lit(", "), t[2], F.lit("]"))))


def feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as one row per event, before encoding.

    view -> post_published, click / purchase -> post_liked,
    signup / error -> comment_posted; ``_ts`` is the event time and
    ``_seq`` the original event id (arrival order).
    """
    e = table(spark, sf_dir, "events")
    k, et, v = F.col("event_id"), F.col("event_type"), F.col("value")
    entity = (F.when(et == "view", "posts").when(et.isin("click", "purchase"), "likes")
              .when(et.isin("signup", "error"), "comments"))
    is_post, is_like, is_comment = entity == "posts", entity == "likes", entity == "comments"
    target = F.get_json_object("props", "$.k")
    return e.where(entity.isNotNull()).select(
        entity.alias("entity"),
        F.when(is_post, "post_published").when(is_like, "post_liked")
         .otherwise("comment_posted").alias("event_type"),
        F.concat(F.lit("e"), k.cast("string")).alias("event_id"),
        F.when(is_post, F.concat(F.lit("s"), k.cast("string"))).otherwise(target).alias("post_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(is_post, F.concat(F.lit("stream post "), k.cast("string")))
         .when(is_comment, F.concat(F.lit("stream comment "), k.cast("string"))).alias("content"),
        F.when(is_post, _case(k % 4, ["text", "image", "video", "link"])).alias("post_type"),
        F.when(is_post, _feed_tags(k)).alias("hashtags"),
        F.when(is_post, k % 4).alias("hashtag_count"),
        F.when(is_post, _case(k % 3, ["en", "ur", "hi"])).alias("language"),
        F.when(is_like, F.concat(F.lit("l"), k.cast("string"))).alias("like_id"),
        F.when(is_like, _case(k % 5, ["like", "love", "laugh", "wow", "sad"])).alias("reaction_type"),
        F.when(is_comment, F.concat(F.lit("c"), k.cast("string"))).alias("comment_id"),
        F.when(is_comment, F.when(v < 20, "negative").when(v < 60, "neutral")
               .otherwise("positive")).alias("sentiment"),
        _iso(F.col("ts")).alias("timestamp"),
        F.col("ts").alias("_ts"), k.alias("_seq"),
    )
