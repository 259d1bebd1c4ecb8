"""Source and sink queries over a real bronze lake (written by Spark from
the driver's tables, then scanned back), plus the full batch pipeline."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.plans.oracle import CTES, sql
from tidemark.plans.batch_run import run_batch
from tidemark.plans.registry import AS_OF, register
from tidemark.plans.registry_more import report_sql
from tidemark.session import scratch_path
from tidemark.sources import adapter, bronze, publish
from tidemark.operators import sample
from tidemark.operators.upsert import KeyedTable
from tidemark.plans.silver import stage_likes, stage_posts
from tidemark.sources.lake import build_lake
from tidemark.sources.sinks import (
    append_partitioned, publish_layout, published_files, snapshot_replace,
)

_LAKE_COLS = {
    "posts": ["post_id", "user_id", "content", "post_type", "language", "media_url", "hashtags",
              "hashtag_count", "like_count", "comment_count", "repost_count", "view_count",
              "raw_engagement_score", "is_viral", "is_deleted",
              "CASE WHEN _v = 2 THEN NULL ELSE is_nsfw END AS is_nsfw", "geo_country",
              "post_date", "ingested_at", "source_system"],
    "comments": ["comment_id", "post_id", "user_id", "content", "like_count", "sentiment",
                 "is_deleted", "commented_at", "ingested_at", "source_system"],
    "likes": ["like_id", "post_id", "user_id", "reaction_type", "liked_at", "ingested_at",
              "source_system"],
}
for _e, _cols in _LAKE_COLS.items():
    CTES[f"l_{_e}"] = (f"SELECT {', '.join(_cols)}, year, month, day, "
                       f"CAST(_v AS BIGINT) AS batch_id FROM b_{_e}")


def lake(spark, d):
    return build_lake(spark, d)


# ---- S1, S2, S7 ---------------------------------------------------------------

@register("bronze_users", sql("SELECT * FROM b_users"))
def q_bronze_users(spark, d):
    return bronze.read_snapshot(spark, lake(spark, d), "users")


for _e in ("posts", "comments", "likes"):
    def _mk(entity):
        def build(spark, d):
            return bronze.read_facts(spark, lake(spark, d), entity)
        return build
    register(f"bronze_{_e}", sql(f"SELECT * FROM l_{_e}"))(_mk(_e))


@register("bronze_posts_range", sql("""
    SELECT post_id, ingested_at, year, month, day FROM l_posts
    WHERE make_date(year, month, day) BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'"""))
def q_posts_range(spark, d):
    return bronze.read_facts(spark, lake(spark, d), "posts", "1998-01-01", "1998-06-30").select(
        "post_id", "ingested_at", "year", "month", "day")


@register("bronze_jsonl_roundtrip", sql(
    "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM l_posts"))
def q_jsonl(spark, d):
    schema = adapter.bronze_posts(spark, d).schema
    return bronze.read_jsonl(spark, f"{lake(spark, d)}/jsonl/posts", schema)


# ---- S3 -----------------------------------------------------------------

@register("user_id_lookup", sql("SELECT user_id FROM b_users"))
def q_user_lookup(spark, d):
    return bronze.id_lookup(bronze.read_snapshot(spark, lake(spark, d), "users"), ["user_id"])


@register("post_id_lookup", sql("SELECT post_id, post_date FROM l_posts"))
def q_post_lookup(spark, d):
    posts = bronze.read_facts(spark, lake(spark, d), "posts")
    return bronze.id_lookup(posts, ["post_id", "post_date"])


# ---- S4: bounded samples that merge ------------------------------------------------

_SAMPLE_KEYS = {"likes": "reaction_type", "comments": "sentiment", "posts": "post_type"}


def _sampled_sql(entity: str, key: str) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in (key, "post_id", "user_id"))
    return f"""SELECT '{entity}' AS entity, {key} AS key, post_id, user_id, h AS row_hash, n AS rows_seen FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY h) AS r, count(*) OVER (PARTITION BY {key}) AS n
        FROM (SELECT *, sha256(concat_ws(chr(31), {text})) AS h FROM l_{entity}))
      WHERE r <= 50"""


@register("bounded_sample", sql(" UNION ALL ".join(_sampled_sql(e, k) for e, k in _SAMPLE_KEYS.items())))
def q_sample(spark, d):
    """Fifty rows of every kind, merged from the sketches of the landed batches."""
    out = None
    for entity, key in _SAMPLE_KEYS.items():
        path = scratch_path(spark, f"sample-{entity}")
        rows = bronze.read_facts(spark, lake(spark, d), entity).select(F.col(key).alias("key"), "post_id", "user_id", "batch_id")
        for batch in (1, 2, 2):  # a batch that runs again counts once
            sample.add_batch(rows.where(F.col("batch_id") == batch).drop("batch_id"), path, batch, ["key"], 50)
        part = sample.read_sample(spark, path, ["key"], 50).select(F.lit(entity).alias("entity"), "*")
        out = part if out is None else out.unionByName(part)
    return out


# ---- S10 --------------------------------------------------------------------

_EXT_POSTS = ", ".join(n for n, _ in bronze.EXTERNAL_POSTS)
_EXT_USERS = ", ".join(n for n, _ in bronze.EXTERNAL_USERS)


def _external(spark, d):
    root = lake(spark, d)
    db = "ext_" + uuid.uuid4().hex[:8]
    return bronze.create_external_tables(spark, db, root, scratch_path(spark, "catalog"))


@register("external_posts", sql(
    f"SELECT {_EXT_POSTS}, year, month, day, batch_id FROM l_posts"))
def q_ext_posts(spark, d):
    return spark.table(_external(spark, d)[0])


@register("external_users", sql(f"SELECT {_EXT_USERS} FROM b_users"))
def q_ext_users(spark, d):
    return spark.table(_external(spark, d)[1])


# ---- K1, K2, K6, K7 ---------------------------------------------------------

@register("snapshot_replace", sql("SELECT * FROM b_users"))
def q_snapshot(spark, d):
    path = scratch_path(spark, "snapshot")
    users = adapter.bronze_users(spark, d)
    snapshot_replace(users.limit(0), path)          # an older snapshot ...
    snapshot_replace(users, path)                   # ... is replaced, not appended to
    return spark.read.parquet(path)


_PART_COUNTS = "SELECT year, month, day, batch_id, count(*) AS rows FROM l_posts GROUP BY ALL"


@register("append_partitioned", sql(_PART_COUNTS))
def q_append(spark, d):
    root = scratch_path(spark, "append")
    for batch in (1, 2, 2):  # running a batch again replaces it
        append_partitioned(adapter.bronze_posts(spark, d, versions=(batch,)), f"{root}/posts", batch)
    return (bronze.read_facts(spark, root, "posts").groupBy("year", "month", "day", "batch_id")
            .agg(F.count(F.lit(1)).alias("rows")))


def _landed_sql(entity: str, more: str = "") -> str:
    return f"SELECT * EXCLUDE (_v), CAST(_v AS BIGINT) AS batch_id{more} FROM b_{entity}"


def _published(spark, d, entity):
    """A lake whose first batch of posts has two columns that nobody declared,
    published, published again after the second batches, and read back."""
    root, dest = scratch_path(spark, "source-lake"), scratch_path(spark, "published")
    facts = {"posts": adapter.bronze_posts, "comments": adapter.bronze_comments, "likes": adapter.bronze_likes}
    if entity == "users":
        snapshot_replace(adapter.bronze_users(spark, d), f"{root}/users")
    for batch in (1, 2) if entity in facts else ():
        rows = facts[entity](spark, d, versions=(batch,))
        if entity == "posts" and batch == 1:
            rows = rows.withColumn("campaign", F.concat(F.lit("c"), F.col("like_count") % 7)).withColumn("reach", F.col("view_count") * 2)
        append_partitioned(rows, f"{root}/{entity}", batch)
        publish.publish(spark, root, dest)
    publish.publish(spark, root, dest)
    return publish.read_published(spark, dest, entity)


@register("publish_layout", sql(_landed_sql("posts", """,
    CASE WHEN _v = 1 THEN 'c' || (like_count % 7) END AS campaign, CASE WHEN _v = 1 THEN view_count * 2 END AS reach""")))
def q_publish(spark, d):
    return _published(spark, d, "posts")


for _e, _oracle in (("comments", _landed_sql("comments")), ("likes", _landed_sql("likes")), ("users", "SELECT * FROM b_users")):
    def _mk_published(entity):
        def build(spark, d):
            return _published(spark, d, entity)
        return build
    register(f"publish_{_e}", sql(_oracle))(_mk_published(_e))


# ---- W1, batch by batch -------------------------------------------------------------

def _kept_up(spark, d, entity, key, ties, stage):
    """The newest rows kept up over the landed batches (the second one twice), staged."""
    bronze_of = {"posts": adapter.bronze_posts, "likes": adapter.bronze_likes}[entity]
    table = KeyedTable(spark, scratch_path(spark, f"newest-{entity}"), key, tie_break=ties, buckets=8)
    for batch in (1, 2, 2):
        table.merge(bronze_of(spark, d, versions=(batch,)))
    return stage(table.rows(), AS_OF)


@register("incremental_posts", sql("SELECT * FROM s_posts"))
def q_incremental_posts(spark, d):
    return _kept_up(spark, d, "posts", "post_id", ["content"], stage_posts)


@register("incremental_likes", sql("SELECT * FROM s_likes"))
def q_incremental_likes(spark, d):
    return _kept_up(spark, d, "likes", "like_id", ["reaction_type", "post_id", "user_id", "liked_at"], stage_likes)


@register("evolving_schema", sql(_landed_sql("likes", """,
    CASE WHEN _v = 1 THEN CAST(len(post_id) AS DOUBLE) ELSE len(post_id) + 0.5 END AS weight, CASE WHEN _v = 2 THEN user_id || '!' END AS note""")))
def q_evolving(spark, d):
    """Batches whose undeclared columns differ and one of which changes its type."""
    root = scratch_path(spark, "evolving")
    first, second = (adapter.bronze_likes(spark, d, versions=(v,)) for v in (1, 2))
    append_partitioned(first.withColumn("weight", F.length("post_id")), f"{root}/likes", 1)
    append_partitioned(second.withColumn("weight", F.length("post_id") + F.lit(0.5).cast("double"))
                       .withColumn("note", F.concat("user_id", F.lit("!"))), f"{root}/likes", 2)
    return bronze.read_facts(spark, root, "likes")


@register("published_files", sql("""
    SELECT 'users' AS folder, true AS has_files
    UNION ALL SELECT DISTINCT 'posts/year=' || year || '/month=' || month || '/day=' || day || '/batch_id=' || batch_id, true FROM l_posts
    UNION ALL SELECT DISTINCT 'comments/year=' || year || '/month=' || month || '/day=' || day || '/batch_id=' || batch_id, true FROM l_comments
    UNION ALL SELECT DISTINCT 'likes/year=' || year || '/month=' || month || '/day=' || day || '/batch_id=' || batch_id, true FROM l_likes
    """))
def q_published_files(spark, d):
    """Every partition folder of the published lake with whether it has files
    that are not empty (names of files are generated, folders are not)."""
    dest = scratch_path(spark, "published")
    publish_layout(spark, lake(spark, d), dest)
    folder = F.regexp_extract("path", "/" + dest.rsplit("/", 1)[1] + "/(.*)/[^/]+$", 1)
    return (published_files(spark, dest).groupBy(folder.alias("folder"))
            .agg((F.min("length") > 0).alias("has_files")))


# ---- the whole batch pipeline -------------------------------------------------

@register("batch_run_quality_report", report_sql(None))
def q_batch_run(spark, d):
    res = run_batch(spark, lake(spark, d), scratch_path(spark, "run"), AS_OF)
    return res.report


@register("catalog_layers", sql("""
    SELECT u.influencer_tier, count(*) AS users, CAST(sum(p.like_count) AS BIGINT) AS likes
    FROM s_posts p JOIN (SELECT DISTINCT user_id, influencer_tier FROM g_users) u USING (user_id)
    GROUP BY u.influencer_tier"""))
def q_catalog(spark, d):
    """Silver and gold as catalog tables, joined by plain SQL."""
    name = "run_" + uuid.uuid4().hex[:8]
    run_batch(spark, lake(spark, d), scratch_path(spark, "run"), AS_OF, database=name, quarantine=True)
    return spark.sql(f"""
        SELECT u.influencer_tier, count(*) AS users, sum(p.like_count) AS likes
        FROM {name}_silver.stg_posts p
        JOIN (SELECT DISTINCT user_id, influencer_tier FROM {name}_gold.mart_user_performance) u USING (user_id)
        GROUP BY u.influencer_tier""")


# ---- S9: SQL over registered bronze views ------------------------------------

@register("bronze_views_sql", sql("""
    SELECT 'users' AS entity, count(*) AS row_count FROM b_users
    UNION ALL SELECT 'posts', count(*) FROM l_posts
    UNION ALL SELECT 'comments', count(*) FROM l_comments
    UNION ALL SELECT 'likes', count(*) FROM l_likes"""))
def q_views_sql(spark, d):
    root = lake(spark, d)
    views = bronze.register_views({
        "users": bronze.read_snapshot(spark, root, "users"),
        **{e: bronze.read_facts(spark, root, e) for e in ("posts", "comments", "likes")}})
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{v.removeprefix('bronze_')}' AS entity, count(*) AS row_count FROM {v}"
        for v in views))


# ---- small-file compaction (survey §4) ----------------------------------------

@register("compact_bronze", sql("""
    SELECT * EXCLUDE (geo_country), CASE WHEN batch_id = 2 THEN geo_country END AS geo_country FROM l_posts"""))
def q_compact(spark, d):
    """Land posts whose first batch lacks a column that the second one has,
    compact every ingest day, then read the entity back: the layout changes,
    rows and columns do not."""
    from tidemark.sources.sinks import compact
    root = scratch_path(spark, "compact")
    first, second = (adapter.bronze_posts(spark, d, versions=(v,)) for v in (1, 2))
    append_partitioned(first.drop("geo_country"), f"{root}/posts", 1)
    append_partitioned(second.drop("is_nsfw"), f"{root}/posts", 2)
    compact(spark, f"{root}/posts", scratch_path(spark, "staging"))
    return bronze.read_facts(spark, root, "posts")
