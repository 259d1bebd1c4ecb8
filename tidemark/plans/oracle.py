"""Independent SQL oracles (DuckDB dialect) for the registered queries.

The driver pre-registers the raw tables as views; each oracle starts from
them, re-derives the bronze frames with the adapter's rules, and computes
the query with plain SQL — no Spark code involved.  ``sql(final)``
prefixes the shared CTEs (DuckDB inlines only the ones a query uses).
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
SRC = "'tpch_adapter'"


def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def avg4(col: str, out_scale: int = 4, in_scale: int = 4) -> str:
    """round(avg(col), out_scale) for values with ``in_scale`` decimals,
    summed exactly in integer units.  A plain double AVG is summation-order
    dependent: on exact decimal ties the same SQL rounds differently
    depending on the parallel plan, so neither side could be checked."""
    m = 10 ** in_scale
    return (f"round(CAST(sum(CAST(round({col} * {m}) AS BIGINT)) AS DOUBLE)"
            f" / CAST(count({col}) * {m} AS DOUBLE), {out_scale})")


_ISO_FULL = "'%Y-%m-%dT%H:%M:%S.%f'"
_ISO_SEC = "'%Y-%m-%dT%H:%M:%S'"

CTES: dict[str, str] = {}

CTES["b_users"] = f"""
  SELECT CASE WHEN f <> 5 THEN CAST(k AS VARCHAR) END AS user_id,
         CASE WHEN f <> 3 THEN '  User_' || CAST(k AS VARCHAR) || ' ' END AS username,
         ' ' || c_name || ' ' AS display_name,
         '  User' || CAST(k AS VARCHAR) || '@Mail.Example ' AS email,
         ' ' || lower(c_mktsegment) || ' buyer ' AS bio,
         n_name || ' ' AS location,
         CASE WHEN k % 5 <> 0 THEN 'https://u' || CAST(k AS VARCHAR) || '.example.org' END AS website,
         'https://img.example.org/' || CAST(k AS VARCHAR) || '.png' AS profile_image_url,
         CASE WHEN f = 2 THEN 'Robot' ELSE {_case('k % 4', ['Personal', 'business', 'CREATOR', 'news'])} END AS account_type,
         CASE WHEN f = 2 THEN 'gone' ELSE {_case('k % 3', ['active', 'Suspended', 'inactive'])} END AS account_status,
         k % 33 = 0 AS is_verified,
         {_case('c_nationkey % 6', ['EN', 'ur', 'hi', 'de', 'Fr', 'pt'])} AS language,
         CAST(floor(b * b * b / 500000) AS BIGINT) AS follower_count,
         k % 500 AS following_count,
         k % 97 AS post_count,
         TIMESTAMP '1990-01-01 00:00:00' + to_seconds(k * 7919 % 346896000) AS joined_at,
         TIMESTAMP '2001-06-01 00:00:00' + to_seconds(k % 86400) AS last_active_at,
         TIMESTAMP '2001-12-31 00:00:00' AS ingested_at,
         {SRC} AS source_system
  FROM (
    SELECT c_custkey + CASE WHEN f = 4 THEN 0 ELSE f END * 10000000 AS k, f, c_name, c_nationkey, c_mktsegment,
           greatest(CAST(floor(c_acctbal) AS BIGINT), 0) AS b
    FROM customer JOIN (VALUES (0, 1), (1, 50), (2, 41), (3, 43), (4, 47), (5, 53)) faults(f, every)
      ON c_custkey % every = 0
  ) u LEFT JOIN nation ON u.c_nationkey = nation.n_nationkey
"""

_TAGS = """CASE o_orderkey % 4
      WHEN 0 THEN '[]'
      WHEN 1 THEN '["' || lower(o_orderpriority) || '"]'
      WHEN 2 THEN '["' || lower(o_orderpriority) || '", "status_' || lower(o_orderstatus) || '"]'
      ELSE '["' || lower(o_orderpriority) || '", "status_' || lower(o_orderstatus)
           || '", "x' || CAST(o_orderkey % 13 AS VARCHAR) || '"]' END"""

CTES["b_posts_base"] = f"""
  SELECT o_orderkey AS _k,
         CAST(o_orderkey AS VARCHAR) AS post_id,
         CAST(o_custkey AS VARCHAR) AS user_id,
         '  Order ' || CAST(o_orderkey AS VARCHAR) || ' status ' || o_orderstatus || ' ' AS content,
         {_case('o_orderkey % 5', ['text', 'Image', 'VIDEO', 'link', 'text'])} AS post_type,
         {_case('o_orderkey % 3', ['EN', 'ur', 'De'])} AS language,
         CASE WHEN o_orderkey % 3 = 0 THEN 'https://media.example.org/' || CAST(o_orderkey AS VARCHAR) || '.jpg' END AS media_url,
         {_TAGS} AS hashtags,
         o_orderkey % 4 AS hashtag_count,
         coalesce(q, 0) * CASE WHEN o_orderkey % 50 = 0 THEN 100 ELSE 1 END AS like_count,
         coalesce(n, 0) * (o_orderkey % 7) AS comment_count,
         coalesce(n, 0) * (o_orderkey % 3) AS repost_count,
         coalesce(q, 0) * (o_orderkey % 1500 + 10) AS view_count,
         o_orderkey % 97 = 0 AS is_nsfw,
         CASE WHEN o_orderkey % 10 <> 0 THEN 'C' || CAST(o_orderkey % 9 AS VARCHAR) END AS geo_country,
         o_orderdate + to_seconds(o_orderkey % 86400) AS post_date,
         o_orderdate AS _d
  FROM orders LEFT JOIN (
    SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n
    FROM lineitem GROUP BY l_orderkey) li ON orders.o_orderkey = li.l_orderkey
"""

# what each kind of added row replaces in a base post
_POST_FAULTS = {
    1: (61, "'f1-' || _k AS post_id, 'ghost' || _k AS user_id, 'Poll' AS post_type"),
    2: (67, "'f2-' || _k AS post_id, -5 AS like_count, 0 AS comment_count, 0 AS repost_count, 3 AS view_count"),
    3: (71, "CAST(NULL AS VARCHAR) AS post_id"),
    4: (73, "'f4-' || _k AS post_id, 0 AS view_count, TIMESTAMP '2001-11-11 00:00:00' + to_seconds(_k % 86400) AS post_date"),
    5: (79, "'f5-' || _k AS post_id, '[\"a\", null]' AS hashtags, 2 AS hashtag_count"),
    6: (83, "'f6-' || _k AS post_id, '[\"u' || _k || '\", \"a\", \"a\"]' AS hashtags, 3 AS hashtag_count"),
    7: (89, "'  tied ' || _k AS content"),
}
CTES["b_posts_all"] = "SELECT *, 0 AS _f FROM b_posts_base" + "".join(
    f" UNION ALL BY NAME SELECT * REPLACE ({cols}), {f} AS _f FROM b_posts_base WHERE _k % {every} = 0"
    for f, (every, cols) in _POST_FAULTS.items())

CTES["b_posts"] = f"""
  SELECT post_id, user_id, content, post_type, language, media_url, hashtags,
         CAST(hashtag_count AS BIGINT) AS hashtag_count, CAST(like_count AS BIGINT) AS like_count, CAST(comment_count AS BIGINT) AS comment_count,
         CAST(repost_count AS BIGINT) AS repost_count, CAST(view_count AS BIGINT) AS view_count,
         round(CAST(like_count + comment_count * 2 + repost_count * 3 AS DOUBLE)
               / greatest(view_count, 1) * 100, 4) AS raw_engagement_score,
         like_count * 50 > view_count AS is_viral,
         is_deleted, is_nsfw, geo_country, post_date, ingested_at, {SRC} AS source_system,
         CAST(year(ingested_at) AS INTEGER) AS year, CAST(month(ingested_at) AS INTEGER) AS month,
         CAST(day(ingested_at) AS INTEGER) AS day, _v
  FROM (
    SELECT * EXCLUDE (_k, _d, _f), false AS is_deleted,
           date_trunc('month', _d) + INTERVAL 1 MONTH AS ingested_at, 1 AS _v
    FROM b_posts_all
    UNION ALL BY NAME
    SELECT * EXCLUDE (_k, _d, like_count), like_count + 1 AS like_count,
           _k % 100 = 0 AS is_deleted,
           date_trunc('month', _d) + INTERVAL 1 MONTH + INTERVAL 1 DAY AS ingested_at, 2 AS _v
    FROM b_posts_base WHERE _k % 20 = 0
  ) v
"""


def _iso(ts: str, micros_cond: str | None = None) -> str:
    if micros_cond is None:
        return f"strftime({ts}, {_ISO_FULL})"
    return f"CASE WHEN {micros_cond} THEN strftime({ts}, {_ISO_FULL}) ELSE strftime({ts}, {_ISO_SEC}) END"


_REACTIONS = ["like", "Love", "laugh", "WOW", "sad"]

CTES["b_likes"] = f"""
  SELECT like_id, post_id, user_id, reaction_type, liked_at, {_iso('_ing')} AS ingested_at,
         {SRC} AS source_system, CAST(year(_ing) AS INTEGER) AS year,
         CAST(month(_ing) AS INTEGER) AS month, CAST(day(_ing) AS INTEGER) AS day, _v
  FROM (
    SELECT CAST(event_id AS VARCHAR) AS like_id, json_extract_string(props, '$.k') AS post_id,
           CAST(user_id AS VARCHAR) AS user_id, {_iso('ts', 'event_id % 7 <> 0')} AS liked_at,
           {_case('event_id % 5', _REACTIONS)} AS reaction_type, ts + INTERVAL 1 HOUR AS _ing,
           1 AS _v
    FROM events WHERE event_type IN ('click', 'view', 'purchase')
    UNION ALL
    SELECT CAST(event_id AS VARCHAR), json_extract_string(props, '$.k'),
           CAST(user_id AS VARCHAR), {_iso('ts', 'event_id % 7 <> 0')},
           {_case('(event_id + 1) % 5', _REACTIONS)}, ts + INTERVAL 2 HOUR, 2
    FROM events WHERE event_type IN ('click', 'view', 'purchase') AND event_id % 25 = 0
    UNION ALL
    SELECT CASE WHEN f = 1 THEN 'f' || event_id END, json_extract_string(props, '$.k'),
           CAST(user_id AS VARCHAR), {_iso('ts', 'event_id % 7 <> 0')},
           CASE WHEN f = 1 THEN 'Angry' ELSE {_case('event_id % 5', _REACTIONS)} END, ts + INTERVAL 1 HOUR, 1
    FROM events JOIN (VALUES (1, 59), (2, 61)) faults(f, every) ON event_id % every = 0
    WHERE event_type IN ('click', 'view', 'purchase')
  ) v
"""

CTES["b_comments"] = f"""
  SELECT comment_id, post_id, user_id, content, like_count, sentiment, is_deleted, commented_at,
         {_iso('_ing')} AS ingested_at, {SRC} AS source_system,
         CAST(year(_ing) AS INTEGER) AS year, CAST(month(_ing) AS INTEGER) AS month,
         CAST(day(_ing) AS INTEGER) AS day, _v
  FROM (
    SELECT CAST(event_id AS VARCHAR) AS comment_id, json_extract_string(props, '$.k') AS post_id,
           CAST(user_id AS VARCHAR) AS user_id,
           '  comment ' || CAST(event_id AS VARCHAR) || '  ' AS content,
           CAST(floor(value) AS BIGINT) AS like_count,
           CASE WHEN value < 20 THEN 'negative' WHEN value < 60 THEN 'Neutral' ELSE 'POSITIVE' END AS sentiment,
           {_iso('ts', 'event_id % 7 <> 0')} AS commented_at,
           event_id % 33 = 0 AS is_deleted, ts + INTERVAL 1 HOUR AS _ing, 1 AS _v
    FROM events WHERE event_type IN ('signup', 'error')
    UNION ALL
    SELECT CAST(event_id AS VARCHAR), json_extract_string(props, '$.k'), CAST(user_id AS VARCHAR),
           '  comment ' || CAST(event_id AS VARCHAR) || '  ', CAST(floor(value) AS BIGINT),
           CASE WHEN value < 20 THEN 'negative' WHEN value < 60 THEN 'Neutral' ELSE 'POSITIVE' END,
           {_iso('ts', 'event_id % 7 <> 0')}, event_id % 80 = 0, ts + INTERVAL 2 HOUR, 2
    FROM events WHERE event_type IN ('signup', 'error') AND event_id % 40 = 0
    UNION ALL
    SELECT 'f' || f || '-' || event_id, CASE WHEN f <> 2 THEN json_extract_string(props, '$.k') END,
           CAST(user_id AS VARCHAR), '  comment ' || CAST(event_id AS VARCHAR) || '  ', CAST(floor(value) AS BIGINT),
           CASE WHEN f = 1 THEN 'Mixed' WHEN value < 20 THEN 'negative' WHEN value < 60 THEN 'Neutral' ELSE 'POSITIVE' END,
           {_iso('ts', 'event_id % 7 <> 0')}, event_id % 33 = 0, ts + INTERVAL 1 HOUR, 1
    FROM events JOIN (VALUES (1, 59), (2, 61)) faults(f, every) ON event_id % every = 0
    WHERE event_type IN ('signup', 'error')
  ) v
"""

# ---- silver --------------------------------------------------------------
# Written from the rules, by other means than the engine: the newest version
# is the maximum of (ingest time, content) per key, thresholds are looked up
# in tables, scores come from integer weights, calendar parts from parts.

CTES["tiers"] = """
  SELECT * FROM (VALUES (1000000, 'mega'), (100000, 'macro'), (10000, 'micro'), (1000, 'nano'), (NULL, 'regular'))
  t(least_followers, tier)"""

CTES["s_users"] = f"""
  WITH known AS (SELECT * FROM b_users WHERE user_id || username IS NOT NULL),
  tiered AS (SELECT follower_count AS f, arg_max(tier, coalesce(least_followers, -1)) AS tier
             FROM (SELECT DISTINCT follower_count FROM known) d JOIN tiers
               ON least_followers IS NULL OR follower_count >= least_followers GROUP BY f)
  SELECT k.* REPLACE (trim(username) AS username, trim(display_name) AS display_name, lower(trim(email)) AS email,
                      trim(bio) AS bio, trim(location) AS location, lower(account_type) AS account_type,
                      lower(account_status) AS account_status, lower(language) AS language,
                      follower_count::INTEGER AS follower_count, following_count::INTEGER AS following_count,
                      post_count::INTEGER AS post_count),
         tier AS influencer_tier, tier IN ('mega', 'macro', 'micro') AS is_influencer,
         round(follower_count / nullif(greatest(following_count, 0), 0)::DOUBLE, 2) AS follower_ratio,
         ({AS_OF})::DATE - joined_at::DATE AS account_age_days, {AS_OF} AS transformed_at
  FROM known k LEFT JOIN tiered ON tiered.f IS NOT DISTINCT FROM k.follower_count
"""

CTES["newest_posts"] = """
  SELECT unnest(arg_max(p, (ingested_at, content))) FROM (SELECT * EXCLUDE (year, month, day, _v) FROM b_posts) p
  GROUP BY post_id"""

#: measures of a post, stated once: weighted interactions, score, tier, flag
CTES["score_tiers"] = """
  SELECT * FROM (VALUES (5, 'viral'), (1, 'high'), (0.1, 'medium')) t(least_score, tier)"""

CTES["measured_posts"] = """
  SELECT *, CASE view_count WHEN 0 THEN 100.0::DOUBLE
            ELSE least(round(weight::DOUBLE / view_count * 100, 4), 100) END AS engagement_score,
         round(weight::DOUBLE / greatest(view_count, 1) * 100, 4) AS raw_score,
         coalesce((SELECT arg_max(tier, least_score) FROM score_tiers WHERE raw_engagement_score >= least_score), 'low') AS engagement_tier,
         CASE WHEN like_count > view_count THEN 'anomaly: likes exceed views'
              WHEN like_count < 0 OR view_count < 0 THEN 'anomaly: negative counts' ELSE 'ok' END AS dq_flag
  FROM (SELECT *, like_count::BIGINT + 2 * comment_count::BIGINT + 3 * repost_count::BIGINT AS weight FROM b_posts) w"""

CTES["s_posts"] = f"""
  WITH live AS (
    SELECT n.*, m.engagement_score, m.engagement_tier, m.dq_flag, post_date::DATE::TIMESTAMP AS post_day,
           hour(post_date) AS hour_of_day, isodow(post_date) % 7 AS day_of_week
    FROM newest_posts n
    JOIN (SELECT DISTINCT post_id, ingested_at, content, engagement_score, engagement_tier, dq_flag FROM measured_posts) m
      USING (post_id, ingested_at, content)
    WHERE NOT is_deleted AND user_id IS NOT NULL AND post_date IS NOT NULL)
  SELECT * EXCLUDE (raw_engagement_score) REPLACE (trim(content) AS content, lower(post_type) AS post_type, lower(language) AS language,
                    hashtag_count::INTEGER AS hashtag_count, like_count::INTEGER AS like_count,
                    comment_count::INTEGER AS comment_count, repost_count::INTEGER AS repost_count,
                    view_count::INTEGER AS view_count),
         post_day + to_hours(hour_of_day) AS post_hour,
         post_day - to_days((isodow(post_date) - 1)::INTEGER) AS post_week,
         make_date(year(post_date), month(post_date), 1)::TIMESTAMP AS post_month,
         day_of_week % 6 = 0 AS is_weekend, {AS_OF} AS transformed_at
  FROM live
"""

CTES["s_comments"] = f"""
  WITH newest AS (SELECT unnest(arg_max(c, ingested_at)) FROM (SELECT * EXCLUDE (year, month, day, _v) FROM b_comments) c
                  WHERE comment_id IS NOT NULL GROUP BY comment_id)
  SELECT * REPLACE (trim(content) AS content, like_count::INTEGER AS like_count, lower(sentiment) AS sentiment,
                    commented_at::TIMESTAMP AS commented_at, ingested_at::TIMESTAMP AS ingested_at),
         commented_at::TIMESTAMP::DATE::TIMESTAMP AS comment_day, {AS_OF} AS transformed_at
  FROM newest WHERE NOT is_deleted AND post_id IS NOT NULL
"""

CTES["s_likes"] = f"""
  WITH newest AS (SELECT unnest(arg_max(l, ingested_at)) FROM (SELECT * EXCLUDE (year, month, day, _v) FROM b_likes) l
                  WHERE like_id IS NOT NULL GROUP BY like_id)
  SELECT * REPLACE (lower(reaction_type) AS reaction_type, liked_at::TIMESTAMP AS liked_at,
                    ingested_at::TIMESTAMP AS ingested_at),
         liked_at::TIMESTAMP::DATE::TIMESTAMP AS like_day, {AS_OF} AS transformed_at
  FROM newest WHERE post_id IS NOT NULL
"""

# ---- gold ----------------------------------------------------------------
# Two-level sums: by (group, member) first, then by group, so that members
# are counted without DISTINCT; scores are summed as whole ten-thousandths.

_MEASURES = """sum(like_count)::BIGINT AS likes, sum(comment_count)::BIGINT AS comments,
  sum(repost_count)::BIGINT AS reposts, sum(view_count)::BIGINT AS views, count(engagement_score) AS scored,
  sum(round(engagement_score * 10000)::BIGINT)::BIGINT AS units, count(*) FILTER (is_viral) AS viral, count(*) AS n"""
_TOTALS = ", ".join(f"sum({c})::BIGINT AS {c}" for c in ("likes", "comments", "reposts", "views", "scored", "units", "viral", "n"))
_MEAN = "round(units::DOUBLE / nullif(scored * 10000, 0)::DOUBLE, 4)"

CTES["g_daily"] = f"""
  WITH one AS (SELECT post_day, user_id, {_MEASURES}, count(*) FILTER (engagement_tier = 'high') AS high
               FROM s_posts GROUP BY ALL),
  day AS (SELECT post_day, count(*) AS authors, {_TOTALS}, sum(high)::BIGINT AS high FROM one GROUP BY post_day)
  SELECT post_day AS date, n AS total_posts, authors AS active_authors, likes AS total_likes, comments AS total_comments,
         reposts AS total_reposts, views AS total_views, {_MEAN} AS avg_engagement_score, viral AS viral_posts,
         high AS high_engagement_posts,
         round((likes + comments + reposts)::DOUBLE / nullif(views, 0) * 100, 4) AS platform_engagement_rate,
         {AS_OF} AS built_at
  FROM day
"""

CTES["g_tags_exploded"] = """
  SELECT post_id, post_day, like_count, comment_count, repost_count, view_count,
         engagement_score, is_viral,
         unnest(from_json(hashtags, '["varchar"]')) AS hashtag
  FROM s_posts WHERE hashtag_count > 0
"""

CTES["g_hashtags"] = f"""
  WITH one AS (SELECT hashtag, post_id, {_MEASURES}, min(post_day) AS lo, max(post_day) AS hi
               FROM g_tags_exploded GROUP BY hashtag, post_id),
  tag AS (SELECT hashtag, count(*) AS posts, {_TOTALS}, min(lo) AS lo, max(hi) AS hi FROM one GROUP BY hashtag)
  SELECT hashtag, posts AS total_posts, likes AS total_likes, comments AS total_comments, reposts AS total_reposts,
         views AS total_views, {_MEAN} AS avg_engagement, viral AS viral_posts,
         round((likes + 2 * comments + 3 * reposts)::DOUBLE / posts, 2) AS trending_score,
         lo AS first_seen, hi AS last_seen, {AS_OF} AS built_at
  FROM tag
"""

CTES["g_users"] = f"""
  WITH author AS (SELECT user_id, {_MEASURES}, min(post_date) AS lo, max(post_date) AS hi FROM s_posts GROUP BY user_id),
  profile AS (SELECT user_id, username, display_name, location, account_type, influencer_tier, is_verified,
                     follower_count, following_count, account_age_days, count(*) AS times FROM s_users GROUP BY ALL)
  SELECT profile.* EXCLUDE (times), coalesce(n, 0) AS total_posts, (likes * times)::BIGINT AS total_likes_received,
         (comments * times)::BIGINT AS total_comments_received, (reposts * times)::BIGINT AS total_reposts_received,
         (views * times)::BIGINT AS total_views, {_MEAN} AS avg_engagement_score,
         (coalesce(viral, 0) * times)::BIGINT AS viral_posts, lo AS first_post_date, hi AS last_post_date,
         hi::DATE - lo::DATE AS active_days_span,
         round(coalesce(n, 0)::DOUBLE / nullif(hi::DATE - lo::DATE, 0), 2) AS posts_per_day, {AS_OF} AS built_at
  FROM profile LEFT JOIN author USING (user_id)
"""


def sql(final: str) -> str:
    """Prefix ``final`` with every shared CTE."""
    body = ",\n".join(f"{name} AS ({text})" for name, text in CTES.items())
    return f"WITH {body}\n{final}"


# ---- stream feed ---------------------------------------------------------

def _feed_tag(off: int) -> str:
    return f"'\"tag' || CAST((event_id * 7 + {off}) % 12 AS VARCHAR) || '\"'"


_FEED_TAGS = f"""CASE event_id % 4 WHEN 0 THEN '[]'
      WHEN 1 THEN '[' || {_feed_tag(0)} || ']'
      WHEN 2 THEN '[' || {_feed_tag(0)} || ', ' || {_feed_tag(3)} || ']'
      ELSE '[' || {_feed_tag(0)} || ', ' || {_feed_tag(3)} || ', ' || {_feed_tag(6)} || ']' END"""

CTES["feed"] = f"""
  SELECT entity,
         CASE entity WHEN 'posts' THEN 'post_published' WHEN 'likes' THEN 'post_liked'
              ELSE 'comment_posted' END AS event_type,
         'e' || CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN entity = 'posts' THEN 's' || CAST(event_id AS VARCHAR)
              ELSE json_extract_string(props, '$.k') END AS post_id,
         CAST(user_id AS VARCHAR) AS user_id,
         CASE entity WHEN 'posts' THEN 'stream post ' || CAST(event_id AS VARCHAR)
              WHEN 'comments' THEN 'stream comment ' || CAST(event_id AS VARCHAR) END AS content,
         CASE WHEN entity = 'posts' THEN {_case('event_id % 4', ['text', 'image', 'video', 'link'])} END AS post_type,
         CASE WHEN entity = 'posts' THEN {_FEED_TAGS} END AS hashtags,
         CASE WHEN entity = 'posts' THEN event_id % 4 END AS hashtag_count,
         CASE WHEN entity = 'posts' THEN {_case('event_id % 3', ['en', 'ur', 'hi'])} END AS language,
         CASE WHEN entity = 'likes' THEN 'l' || CAST(event_id AS VARCHAR) END AS like_id,
         CASE WHEN entity = 'likes' THEN {_case('event_id % 5', ['like', 'love', 'laugh', 'wow', 'sad'])} END AS reaction_type,
         CASE WHEN entity = 'comments' THEN 'c' || CAST(event_id AS VARCHAR) END AS comment_id,
         CASE WHEN entity = 'comments' THEN
              CASE WHEN value < 20 THEN 'negative' WHEN value < 60 THEN 'neutral' ELSE 'positive' END
         END AS sentiment,
         strftime(ts, {_ISO_FULL}) AS "timestamp",
         ts AS _ts, event_id AS _seq
  FROM (SELECT *, CASE WHEN event_type = 'view' THEN 'posts'
                       WHEN event_type IN ('click', 'purchase') THEN 'likes'
                       WHEN event_type IN ('signup', 'error') THEN 'comments' END AS entity
        FROM events) e
  WHERE entity IS NOT NULL
"""

CTES["feed_tags"] = """
  SELECT _ts, trim(tag) AS hashtag FROM (
    SELECT _ts, unnest(from_json(hashtags, '["varchar"]')) AS tag FROM feed WHERE entity = 'posts') t
  WHERE trim(tag) <> ''
"""


def sliding(src: str, ts: str, key: str, size_s: int = 3600, slide_s: int = 30,
            count_col: str = "n") -> str:
    """Epoch-aligned sliding windows: every event joins size/slide windows."""
    per = size_s // slide_s
    return f"""
  SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {size_s * 1000000}) AS window_end,
         {key}, count(*) AS {count_col}
  FROM (SELECT {key}, epoch_us({ts}) - (epoch_us({ts}) % {slide_s * 1000000}) - i * {slide_s * 1000000} AS ws
        FROM {src}, range(0, {per}) r(i)) x
  GROUP BY ws, {key}"""
