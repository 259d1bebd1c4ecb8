"""Data-quality checks (Q1-Q10) as DataFrames.

Each check yields one row ``(layer, table, check, column, failing_rows,
passed)``.  All row-predicate checks of a table (not_null, accepted_values,
ranges, enums, non-empty) *and* its unique / duplicate-key checks run in a
single pass: a group-by on the key whose partial aggregation also carries
the predicate counts, then one tiny global aggregate, then an unpivot.
Only relationships (an anti join) need a pass of their own.  Nothing is collected to the driver except
the names of failed checks in the gate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import orphans

CHECK_COLUMNS = ("layer", "table", "check", "column", "failing_rows", "passed")

# Fixed values that must equal the reference's accepted-value lists.
ACCOUNT_TYPES = ("personal", "business", "creator", "news")
ACCOUNT_STATUSES = ("active", "suspended", "inactive")
INFLUENCER_TIER_VALUES = ("mega", "macro", "micro", "nano", "regular")
POST_TYPES = ("text", "image", "video", "link")
ENGAGEMENT_TIER_VALUES = ("viral", "high", "medium", "low")
SENTIMENTS = ("positive", "neutral", "negative")
REACTIONS = ("like", "love", "laugh", "wow", "sad")


@dataclass(frozen=True)
class RowCheck:
    """A check decided by counting rows that match ``failing``."""
    check: str
    column: str
    failing: Column
    max_failing: int = 0


def not_null(col: str) -> RowCheck:
    return RowCheck("not_null", col, F.col(col).isNull())


def accepted_values(col: str, values: Sequence[str], check: str = "accepted_values") -> RowCheck:
    """NULL passes (``NOT IN`` on NULL is unknown, not true)."""
    return RowCheck(check, col, F.coalesce(~F.col(col).isin(*values), F.lit(False)))


def is_null(col: str, check: str = "score_not_null") -> RowCheck:
    return RowCheck(check, col, F.col(col).isNull())


def negative(col: str, check: str = "non_negative") -> RowCheck:
    return RowCheck(check, col, F.coalesce(F.col(col) < 0, F.lit(False)))


def non_empty() -> RowCheck:
    """Failing 'rows' is 1 when the table is empty (decided after the agg)."""
    return RowCheck("non_empty", "*", F.lit(None))


@dataclass
class TableChecks:
    layer: str
    table: str
    df: DataFrame
    rows: list[RowCheck] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)          # declarative unique
    duplicates: list[str] = field(default_factory=list)      # script HAVING count > 1
    relationships: list[tuple[str, DataFrame, str]] = field(default_factory=list)


def _entries(tc: TableChecks, counts: dict[str, Column]) -> list[Column]:
    entries = []
    for i, rc in enumerate(tc.rows):
        failing = (F.when(F.col("__n") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
                   if rc.check == "non_empty" else F.col(f"__c{i}"))
        entries.append((rc.check, rc.column, failing, rc.max_failing))
    for check, col, expr in counts.values():
        entries.append((check, col, expr, 0))
    return [F.struct(F.lit(c).alias("check"), F.lit(col).alias("column"),
                     e.cast("long").alias("failing_rows"),
                     F.lit(m).cast("long").alias("max_failing"))
            for c, col, e, m in entries]


def _fused_checks(tc: TableChecks) -> DataFrame | None:
    """All row-predicate checks plus unique / duplicates on the *first* key
    column in one pass: group by the key (partial aggregation carries the
    predicate counts), then one tiny global aggregate over the groups."""
    key = (tc.unique or tc.duplicates or [None])[0]
    preds = {f"__c{i}": rc.failing for i, rc in enumerate(tc.rows) if rc.check != "non_empty"}
    if key is None:
        if not tc.rows:
            return None
        one = tc.df.agg(F.count(F.lit(1)).alias("__n"),
                        *[F.count(F.when(p, F.lit(1))).alias(c) for c, p in preds.items()])
        counts = {}
    else:
        per_key = tc.df.groupBy(key).agg(
            F.count(F.lit(1)).alias("__k"),
            *[F.count(F.when(p, F.lit(1))).alias(c) for c, p in preds.items()])
        dup = F.col("__k") > 1
        one = per_key.agg(
            F.coalesce(F.sum("__k"), F.lit(0)).alias("__n"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in preds],
            F.count(F.when(dup & F.col(key).isNotNull(), F.lit(1))).alias("__uniq"),
            F.count(F.when(dup, F.lit(1))).alias("__dups"))
        counts = {}
        if key in tc.unique:
            counts["u"] = ("unique", key, F.col("__uniq"))
        if key in tc.duplicates:
            counts["d"] = ("duplicates", key, F.col("__dups"))
    return (one.select(F.explode(F.array(*_entries(tc, counts))).alias("e"))
            .select(F.lit(tc.layer).alias("layer"), F.lit(tc.table).alias("table"),
                    "e.check", "e.column", "e.failing_rows",
                    (F.col("e.failing_rows") <= F.col("e.max_failing")).alias("passed")))


def _dup_check(tc: TableChecks, col: str, check: str, ignore_nulls: bool) -> DataFrame:
    src = tc.df.where(F.col(col).isNotNull()) if ignore_nulls else tc.df
    dups = src.groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dups.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(tc.layer).alias("layer"), F.lit(tc.table).alias("table"),
        F.lit(check).alias("check"), F.lit(col).alias("column"), "failing_rows",
        (F.col("failing_rows") == 0).alias("passed"))


def _rel_check(tc: TableChecks, col: str, parent: DataFrame, pkey: str) -> DataFrame:
    bad = orphans(tc.df.select(col), col, parent, pkey)
    return bad.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(tc.layer).alias("layer"), F.lit(tc.table).alias("table"),
        F.lit("relationships").alias("check"), F.lit(col).alias("column"), "failing_rows",
        (F.col("failing_rows") == 0).alias("passed"))


def table_report(tc: TableChecks) -> DataFrame:
    parts: list[DataFrame] = []
    fused = _fused_checks(tc)
    if fused is not None:
        parts.append(fused)
    first = (tc.unique or tc.duplicates or [None])[0]
    parts += [_dup_check(tc, c, "unique", True) for c in tc.unique if c != first]
    parts += [_dup_check(tc, c, "duplicates", False) for c in tc.duplicates if c != first]
    parts += [_rel_check(tc, c, p, k) for c, p, k in tc.relationships]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_report(tables: Sequence[TableChecks]) -> DataFrame:
    out = None
    for tc in tables:
        r = table_report(tc)
        out = r if out is None else out.unionByName(r)
    return out


def standard_checks(stg_users: DataFrame, stg_posts: DataFrame, stg_comments: DataFrame,
                    stg_likes: DataFrame, daily: DataFrame, tags: DataFrame,
                    user_mart: DataFrame) -> list[TableChecks]:
    """The 30 declared column checks plus the 18 scripted ones (48 rows)."""
    return [
        TableChecks("silver", "stg_users", stg_users, rows=[
            not_null("user_id"), not_null("username"), not_null("account_type"),
            not_null("follower_count"),
            accepted_values("account_type", ACCOUNT_TYPES),
            accepted_values("account_status", ACCOUNT_STATUSES),
            accepted_values("influencer_tier", INFLUENCER_TIER_VALUES),
            non_empty()], unique=["user_id"], duplicates=["user_id"]),
        TableChecks("silver", "stg_posts", stg_posts, rows=[
            not_null("post_id"), not_null("user_id"), not_null("dq_flag"),
            accepted_values("post_type", POST_TYPES),
            accepted_values("engagement_tier", ENGAGEMENT_TIER_VALUES),
            non_empty(), is_null("engagement_score"), negative("engagement_score"),
            accepted_values("post_type", POST_TYPES, check="enum")],
            unique=["post_id"], duplicates=["post_id"],
            relationships=[("user_id", stg_users, "user_id")]),
        TableChecks("silver", "stg_comments", stg_comments, rows=[
            not_null("comment_id"), not_null("post_id"),
            accepted_values("sentiment", SENTIMENTS),
            non_empty(), accepted_values("sentiment", SENTIMENTS, check="enum")],
            unique=["comment_id"]),
        TableChecks("silver", "stg_likes", stg_likes, rows=[
            not_null("like_id"), accepted_values("reaction_type", REACTIONS),
            non_empty(), accepted_values("reaction_type", REACTIONS, check="enum")],
            unique=["like_id"]),
        TableChecks("gold", "mart_daily_engagement", daily, rows=[
            not_null("date"), not_null("total_posts"), not_null("platform_engagement_rate"),
            non_empty(), negative("platform_engagement_rate")],
            unique=["date"], duplicates=["date"]),
        TableChecks("gold", "mart_hashtag_performance", tags, rows=[
            not_null("hashtag"), non_empty(), negative("trending_score")],
            unique=["hashtag"], duplicates=["hashtag"]),
        TableChecks("gold", "mart_user_performance", user_mart, rows=[
            not_null("user_id"), non_empty()], unique=["user_id"]),
    ]


def only(tables: Sequence[TableChecks], checks: Sequence[str]) -> list[TableChecks]:
    """The given kinds of checks, without tables that have none of them."""
    kept = [replace(tc, rows=[r for r in tc.rows if r.check in checks],
                    unique=tc.unique if "unique" in checks else [],
                    duplicates=tc.duplicates if "duplicates" in checks else [],
                    relationships=tc.relationships if "relationships" in checks else [])
            for tc in tables]
    return [tc for tc in kept if tc.rows or tc.unique or tc.duplicates or tc.relationships]


def quality_summary(report: DataFrame) -> DataFrame:
    """One row: checks passed, failed, in all, and whether all passed."""
    failed = F.count(F.when(~F.col("passed"), F.lit(1)))
    return report.agg(F.count(F.when(F.col("passed"), F.lit(1))).alias("passed"), failed.alias("failed"),
                      F.count(F.lit(1)).alias("total"), (failed == 0).alias("all_passed"))


def quality_gate(report: DataFrame) -> None:
    """Raise when any check failed, naming every one (the report has one row
    per declared check, so there are no more names than declarations)."""
    bad = report.where(~F.col("passed")).orderBy("layer", "table", "column", "check").collect()
    if bad:
        names = ", ".join(f"{r['table']}.{r['column']}:{r['check']}" for r in bad)
        raise AssertionError(f"{len(bad)} data quality checks failed: {names}")


def dq_flag_summary(posts: DataFrame) -> DataFrame:
    """Q10: anomaly counts by flag."""
    return posts.groupBy("dq_flag").agg(F.count(F.lit(1)).alias("posts"))
