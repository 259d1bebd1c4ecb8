"""Sliding-window counts (T1-T3) and the newest-closed-window top-N.

A 1 h window sliding every 30 s puts every event in 120 windows.  Expanding
raw events 120-fold multiplies the shuffle by 120; instead events are first
counted in tumbling *panes* of gcd(size, slide) (partial aggregation runs
map side).  Every sliding window starts on a pane boundary, so a window
contains a whole pane or none of it and the pane totals add up exactly.

In batch the second shuffle carries panes, not windows: the starts of the
windows that hold a pane lie in at most two stretches of one window size, so
a pane goes to (key, stretch) twice at most, and only behind that exchange it
is expanded into its windows; a key is spread over its stretches.  In
Structured Streaming the two aggregations are chained on ``window_time``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.topk import top_k

_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
          "hours": 3600, "day": 86400, "days": 86400}


def _seconds(spec: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s+([a-z]+)\s*", spec)
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported interval {spec!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def windowed_counts(df: DataFrame, ts: str, keys: list[str], size: str = "1 hour",
                    slide: str = "30 seconds", count_col: str = "n",
                    use_panes: bool = True) -> DataFrame:
    """Counts per (sliding window, keys): ``window_start, window_end, keys..., n``."""
    if not use_panes:
        out = df.groupBy(F.window(ts, size, slide).alias("w"), *keys).agg(
            F.count(F.lit(1)).alias(count_col))
    else:
        pane = f"{math.gcd(_seconds(size), _seconds(slide))} seconds"
        panes = df.groupBy(F.window(ts, pane).alias("p"), *keys).agg(
            F.count(F.lit(1)).alias("__c"))
        if df.isStreaming:
            out = panes.groupBy(F.window(F.window_time("p"), size, slide).alias("w"), *keys).agg(
                F.sum("__c").alias(count_col))
        else:
            out = _windows_of_panes(panes, keys, size, slide, count_col)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, count_col)


def _windows_of_panes(panes: DataFrame, keys: list[str], size: str, slide: str, count_col: str) -> DataFrame:
    size_s, slide_s = _seconds(size), _seconds(slide)
    start = F.col("p.start")
    if panes.schema["p"].dataType["start"].dataType.typeName() == "timestamp":
        seconds = F.unix_seconds
    else:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        seconds = lambda c: F.timestamp_diff("SECOND", epoch, c)
    # newest window start of a pane, in seconds on the epoch's grid
    at = seconds(start)
    newest = at - F.pmod(at, F.lit(slide_s))
    oldest = newest - (-(-size_s // slide_s) - 1) * slide_s
    stretches = F.array_distinct(F.array(F.floor(oldest / size_s), F.floor(newest / size_s)))
    dealt = (panes.select(*keys, "__c", start.alias("__p"), at.alias("__at"), newest.alias("__w"),
                          F.explode(stretches).alias("__s"))
             .repartition(*keys, "__s"))
    # a generator keeps the partitioning, so grouping by more than the
    # exchange was dealt by needs no other exchange
    opened = dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(-(-size_s // slide_s) - 1))).alias("__k"))
    begin = F.col("__w") - F.col("__k") * slide_s
    opened = opened.where((F.floor(begin / size_s) == F.col("__s")) & (begin + size_s > F.col("__at")))
    w = F.timestamp_add("SECOND", begin - F.col("__at"), F.col("__p"))
    counted = (opened.withColumn("__b", w).groupBy(*keys, "__s", "__b").agg(F.sum("__c").alias(count_col)))
    return counted.select(*keys, count_col, F.struct(
        F.col("__b").alias("start"), F.timestamp_add("SECOND", F.lit(size_s), F.col("__b")).alias("end")).alias("w"))


def latest_window_top(counts: DataFrame, key: str, n: int = 5, count_col: str = "n") -> DataFrame:
    """T8 over a window-count table: top-n keys in the newest closed window.

    A window is closed once its end is at or before the newest window start
    (every later window can still grow).  Both bounds are scalar subqueries
    (one-row aggregates evaluated once), so this is two filters and a
    bounded top-k, no join.
    """
    horizon = counts.agg(F.max("window_start")).scalar()
    closed = counts.where(F.col("window_end") <= horizon)
    newest = closed.agg(F.max("window_end")).scalar()
    last = closed.where(F.col("window_end") == newest)
    return top_k(last, [F.col(count_col).desc(), F.col(key).asc_nulls_last()], n, rank_col="rank")


def latest_window_top_events(events: DataFrame, ts: str, key: str, n: int = 5,
                             size: str = "1 hour", slide: str = "30 seconds",
                             count_col: str = "n") -> DataFrame:
    """T8 straight from events, without materialising any sliding window.

    horizon = newest slide-aligned window start; e* = latest event before
    it; the newest closed non-empty window ends at
    min(horizon, pane(e*) + size).  Only events inside that one window are
    counted — O(events) filtering instead of a 120-fold expansion.  Equal
    to ``latest_window_top(windowed_counts(...))``.
    """
    size_s, slide_s = _seconds(size), _seconds(slide)
    pane = F.window(ts, f"{slide_s} seconds").start
    horizon = events.select(pane.alias("__p")).agg(F.max("__p")).scalar()
    last_pane = (events.where(F.col(ts) < horizon).select(pane.alias("__p"))
                 .agg(F.max("__p")).scalar())
    end = F.least(horizon, F.timestamp_add("SECOND", F.lit(size_s), last_pane))
    start = F.timestamp_add("SECOND", F.lit(-size_s), end)
    inside = events.where((F.col(ts) >= start) & (F.col(ts) < end))
    counts = inside.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    top = top_k(counts, [F.col(count_col).desc(), F.col(key).asc_nulls_last()], n, rank_col="rank")
    return top.select(start.alias("window_start"), end.alias("window_end"), key, count_col, "rank")
