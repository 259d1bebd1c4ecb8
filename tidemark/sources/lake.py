"""Land the adapter's bronze frames as a real bronze lake (scaffolding).

users    -> snapshot (Parquet + JSONL)
posts    -> batch 1 = first versions, batch 2 = newer versions written
            *without* ``is_nsfw`` (an evolving schema for union-by-name)
comments, likes -> batch 1 / batch 2 likewise
Everything lands under the session's shared folder, at a path derived from
the input's files (names, sizes, times) and ``LAYOUT_VERSION`` (bump it
whenever the adapter's rules change), and is reused by later sessions sharing
that folder while the input stays the same.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tidemark.session import input_fingerprint, shared_root
from tidemark.sources import adapter
from tidemark.sources.sinks import append_partitioned, run_parallel, snapshot_replace

LAYOUT_VERSION = 5
_LAKES: dict[tuple[str, str], str] = {}


def _complete(spark: SparkSession, root: str, digest: str) -> bool:
    """A lake is reusable once its marker (written last) names its input."""
    try:
        row = spark.read.parquet(f"{root}/_lake_complete").first()
    except AnalysisException:
        return False
    return row is not None and row["input"] == digest and row["version"] == LAYOUT_VERSION


def build_lake(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Land the bronze lake for ``sf_dir`` (or reuse a complete one).

    The default location is deterministic under the shared folder, so a
    later session with the same ``spark.checkpoint.dir`` reuses the lake
    instead of rewriting it; a partly written lake has no marker and is
    rebuilt (every write below overwrites its own target)."""
    digest = input_fingerprint(spark, *(f"{sf_dir.rstrip('/')}/{t}.parquet" for t in adapter.TABLES))
    key = (spark.sparkContext.applicationId, digest)
    if root is None and key in _LAKES:
        return _LAKES[key]
    if root is None:
        root = f"{shared_root(spark)}/tidemark/lake-v{LAYOUT_VERSION}-{digest}"
        if _complete(spark, root, digest):
            _LAKES[key] = root
            return root
    facts = {"posts": adapter.bronze_posts, "comments": adapter.bronze_comments,
             "likes": adapter.bronze_likes}

    def land(entity: str) -> None:
        # batches of one entity share a root: land them in order
        for batch in (1, 2):
            df = facts[entity](spark, sf_dir, versions=(batch,))
            if entity == "posts" and batch == 2:
                df = df.drop("is_nsfw")
            append_partitioned(df, f"{root}/{entity}", batch,
                               jsonl_root=f"{root}/jsonl/{entity}")

    # entities are independent folders: land them concurrently
    run_parallel({
        "users": lambda: snapshot_replace(adapter.bronze_users(spark, sf_dir), f"{root}/users",
                                          jsonl_path=f"{root}/jsonl/users"),
        **{e: (lambda e=e: land(e)) for e in facts}})
    spark.createDataFrame([(digest, LAYOUT_VERSION)], "input string, version int") \
        .coalesce(1).write.mode("overwrite").parquet(f"{root}/_lake_complete")
    _LAKES[key] = root
    return root
