"""The batch run: bronze lake -> silver -> gold -> quality gate.

Each layer is materialised as Parquet in the shared folder (K3) and read
back, so the three marts share one silver scan instead of recomputing the
dedup window, lineage is cut at every layer, and a lost executor costs at
most the current layer's tasks.  The tables of one layer are independent,
so their writes are submitted concurrently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import gold, quality, silver
from tidemark.sources.bronze import read_facts, read_snapshot
from tidemark.sources.sinks import materialize_all, register_tables


@dataclass
class PipelineResult:
    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    gold: dict[str, DataFrame]
    report: DataFrame
    bad: dict[str, DataFrame]


# Text columns that silver casts: a value that does not cast parks its row.
CASTS = {"comments": {"commented_at": "timestamp_ntz", "ingested_at": "timestamp_ntz"},
         "likes": {"liked_at": "timestamp_ntz", "ingested_at": "timestamp_ntz"}}


def run_batch(spark: SparkSession, lake_root: str, out_root: str, as_of: str | None = None,
              gate: bool = False, database: str | None = None, quarantine: bool = False) -> PipelineResult:
    """``database`` also registers the layers as ``<database>_silver.*`` and
    ``<database>_gold.*``; ``quarantine`` parks rows whose text does not cast
    under ``out_root/quarantine`` instead of failing the run on them."""
    bronze = {"users": read_snapshot(spark, lake_root, "users"),
              **{e: read_facts(spark, lake_root, e) for e in ("posts", "comments", "likes")}}
    bad = {}
    if quarantine:
        for e, casts in CASTS.items():
            bronze[e], bad[e] = silver.quarantine_bad_casts(bronze[e], casts)
        bad = materialize_all(bad, f"{out_root}/quarantine")
    s = {
        "stg_users": silver.stage_users(bronze["users"], as_of),
        "stg_posts": silver.stage_posts(bronze["posts"], as_of),
        "stg_comments": silver.stage_comments(bronze["comments"], as_of),
        "stg_likes": silver.stage_likes(bronze["likes"], as_of),
    }
    s = materialize_all(s, f"{out_root}/silver")
    g = {
        "mart_daily_engagement": gold.daily_engagement(s["stg_posts"], as_of, ordered=False),
        "mart_hashtag_performance": gold.hashtag_performance(s["stg_posts"], as_of, ordered=False),
        "mart_user_performance": gold.user_performance(s["stg_users"], s["stg_posts"], as_of),
    }
    g = materialize_all(g, f"{out_root}/gold")
    report = quality.quality_report(quality.standard_checks(
        s["stg_users"], s["stg_posts"], s["stg_comments"], s["stg_likes"],
        g["mart_daily_engagement"], g["mart_hashtag_performance"], g["mart_user_performance"]))
    if database:
        for layer, tables in (("silver", s), ("gold", g)):
            register_tables(spark, f"{database}_{layer}", {t: f"{out_root}/{layer}/{t}" for t in tables})
    if gate:
        quality.quality_gate(report)
    return PipelineResult(bronze, s, g, report, bad)
