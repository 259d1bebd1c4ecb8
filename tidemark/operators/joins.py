"""Referential and temporal checks expressed as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import bloom

SALT = "__salt"


def hot_keys(df: DataFrame, key: str, share: float = 0.01,
             sample: float = 0.05, seed: int = 7) -> list:
    """Keys holding more than ``share`` of the rows, estimated on a
    ``sample`` (detection only; every row is still processed later).

    One job: a ROLLUP over the sampled keys yields the per-key counts and
    the grand total together; only the top 1/share + 1 rows reach the
    driver, and at most 1/share keys can qualify, so the returned list has
    a proven bound (100 keys at the default).  Only the key column is
    read, so on a Parquet table the scan is one narrow column.
    """
    g = (df.select(key).sample(fraction=sample, seed=seed).rollup(key)
         .agg(F.count(F.lit(1)).alias("__n"), F.grouping(key).alias("__g")))
    rows = g.orderBy(F.col("__n").desc(), F.col("__g").desc()).limit(int(1 / share) + 1).collect()
    total = next((r["__n"] for r in rows if r["__g"] == 1), 0)
    return [r[key] for r in rows
            if r["__g"] == 0 and r[key] is not None and r["__n"] >= 2 and r["__n"] > share * total]


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                how: str = "inner", buckets: int = 32, hot: list | None = None) -> DataFrame:
    """Equi-join where a few keys of ``big`` may hold a large share of rows.

    Rows of ``big`` with a hot key get a salt 0..buckets-1 (round-robin by a
    hash of the row); the matching rows of ``small`` are replicated once per
    salt; every other key keeps salt 0.  The join on (key, salt) spreads a
    hot key over ``buckets`` tasks while the result stays exact (each big
    row meets its key's small rows exactly once).  Works for inner, left
    outer, left semi and left anti joins.
    """
    if not hot:
        return big.join(small, big[big_key] == small[small_key], how)
    sb, ss = SALT + "_b", SALT + "_s"
    salted_big = big.withColumn(
        sb, F.when(F.col(big_key).isin(hot), F.pmod(F.xxhash64(*big.columns), F.lit(buckets)))
        .otherwise(F.lit(0)).cast("long"))
    reps = (F.when(F.col(small_key).isin(hot), F.sequence(F.lit(0), F.lit(buckets - 1)))
            .otherwise(F.array(F.lit(0))))
    salted_small = small.withColumn(ss, F.explode(reps)).withColumn(ss, F.col(ss).cast("long"))
    cond = (F.col(big_key) == F.col(small_key)) & (F.col(sb) == F.col(ss))
    out = salted_big.join(salted_small, cond, how)
    return out.drop(sb, ss)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL ``key`` has no parent (left-anti join).

    NULL keys are not orphans (declarative ``relationships`` test semantics).
    An anti join only asks whether a key exists, so a parent with repeated
    keys needs no distinct; without an aggregate between the join and its
    shuffles, AQE splits a hot child key over many tasks.
    """
    pk = parent_key or key
    keys = parent.select(F.col(pk).alias("__pk")).where(F.col("__pk").isNotNull())
    return (child.where(F.col(key).isNotNull())
            .join(keys, F.col(key) == F.col("__pk"), "left_anti"))


def orphans_prefiltered(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None,
                        expected: int | None = None) -> DataFrame:
    """``orphans`` where many child rows may have no parent: these never reach the shuffle.

    A Bloom filter of the parent keys (sized for ``expected`` keys, by
    default the parent's row count; 8 MB at most, see ``bloom``) settles the
    child rows whose key it does not hold: they are orphans for sure and stay
    in the task that read them.  Only the others go through the exact anti
    join, so the rows are those of ``orphans`` whatever the filter's size.
    The child is read twice and the parent's keys two times (three to count
    them), which pays when a good part of the child has no parent.
    """
    pk = parent_key or key
    words = bloom.words_for(parent.count() if expected is None else expected)
    # a scalar subquery: evaluated once, then a constant of the scan's filter
    held = bloom.build(parent, pk, words).scalar()
    rows = child.where(F.col(key).isNotNull())
    sure = rows.where(~bloom.maybe(held, F.col(key), words))
    unsure = rows.where(bloom.maybe(held, F.col(key), words))
    return sure.unionByName(orphans(unsure, key, parent, pk))


def temporal_consistency(events: DataFrame, event_ts: str, posts: DataFrame,
                         kind: str, max_days: int | None,
                         as_of: str | None = None, hot: list | None = None) -> DataFrame:
    """Per-event check that an interaction happens after its post.

    Returns ``(kind, event_id, post_id, before_post, too_late, in_future)``
    for violating events only.  ``posts`` must be unique on ``post_id``
    (silver is); the equi-join is on ``post_id`` and the range predicate
    is evaluated on the joined row, so no range join is needed.  Hot posts
    (one post may hold a third of all likes): pass ``hot`` (see
    ``hot_keys``) to salt them over many tasks; AQE's skew-join split is the
    fallback for keys that were not flagged.
    """
    p = posts.select(F.col("post_id").alias("__post"), F.col("post_date").alias("__pd"))
    j = salted_join(events, p, "post_id", "__post", "inner", hot=hot)
    ts, pd = F.col(event_ts), F.col("__pd")
    before = ts < pd
    too_late = (F.lit(False) if max_days is None
                else ts > F.timestamp_add("DAY", F.lit(max_days), pd))
    ref = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    future = ts > ref
    return (j.where(before | too_late | future)
            .select(F.lit(kind).alias("kind"), F.col("event_id"), F.col("post_id"),
                    before.alias("before_post"), too_late.alias("too_late"),
                    future.alias("in_future")))
