"""One row per hashtag (inner explode: posts without tags vanish)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.tags import json_tags, lenient_tags, malformed_tags, split_tags


def explode_json_tags(df: DataFrame, col: str = "hashtags", out: str = "hashtag",
                      require_count: str | None = "hashtag_count",
                      fail_on_malformed: bool = False) -> DataFrame:
    """Strict JSON form (gold mart).  ``require_count`` keeps rows with a
    positive tag count first, as the mart does.

    Malformed JSON: the reference engine raises; Spark's default gives no
    row.  ``fail_on_malformed=True`` raises too (FAILFAST parsing); the
    default keeps going and ``malformed_tag_count`` reports how many."""
    if require_count:
        df = df.filter(F.col(require_count) > 0)
    parsed = (F.from_json(F.col(col), "array<string>", {"mode": "FAILFAST"})
              if fail_on_malformed else json_tags(col))
    return df.withColumn(out, F.explode(parsed))


def malformed_tag_count(df: DataFrame, col: str = "hashtags") -> DataFrame:
    """One row: how many non-NULL tag values are not a JSON array."""
    return df.agg(F.count(F.when(malformed_tags(col), F.lit(1))).alias("malformed"))


def explode_split_tags(df: DataFrame, col: str = "hashtags", out: str = "hashtag_tag",
                       trim: bool = False, require_count: str | None = "hashtag_count",
                       drop_blank: bool = True) -> DataFrame:
    """Cloud-SQL form: bracket/quote strip + split on ','; leading spaces
    survive unless ``trim``."""
    if require_count:
        df = df.filter(F.col(require_count) > 0)
    out_df = df.withColumn(out, F.explode(split_tags(col, trim=trim)))
    return out_df.filter(F.col(out) != "") if drop_blank else out_df


def explode_tags_lenient(df: DataFrame, col: str = "hashtags", out: str = "hashtag") -> DataFrame:
    """Streaming-counter form: trimmed, blanks dropped, malformed skipped."""
    return df.withColumn(out, F.explode(lenient_tags(col)))
