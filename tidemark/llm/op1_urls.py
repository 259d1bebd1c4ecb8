"""URL filters as a sort-merge range join.

A host becomes its labels in reverse, each closed by a dot
(``www.example.com`` -> ``com.example.www.``), so that a rule's host and all
its subdomains are one interval of the key order: the keys that start with
the rule's key.  Urls and rules are dealt out by ranges of the key, sorted
together, and swept once per range with a stack of the rules whose interval
is open; a url is judged against the stack alone.

Range bounds come from a bounded hash sample of the keys (``SAMPLE`` per
range).  A rule goes to every range that its interval meets: wide rules are
few per range (one stack), narrow ones meet one range.  A key that fills
several ranges by itself (a hot host is many urls of one key) has its urls
dealt over all of them.

Defined results: a null url, or one without ``://``, has an empty host and
path and fits no rule; the longest rule (host and path) wins, ``block`` over
``allow`` where a rule is given twice; no rule gives the default verdict;
repeated rows are judged one by one; an empty table gives no rows; columns
other than the id and the url are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import c, shuffle_width

#: the sample that places the range bounds: so many keys for each range
SAMPLE = 20
_A_Z, _a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _A_Z, _a_z), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def key_of(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def _sweep(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Judge urls in key order against the stack of open rules."""
    stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []
    part = None
    for pdf in batches:
        ids, hosts, paths, rules, verdicts = [], [], [], [], []
        for bucket, key, is_url, rid, host, path, verdict in zip(
                pdf["bucket"], pdf["key"], pdf["is_url"], pdf["rid"], pdf["host"], pdf["path"], pdf["verdict"]):
            if bucket != part:
                part, stack = bucket, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                known, sizes = stack[-1][1:]
                if path not in known or verdict == "block":
                    known[path] = (host + path, verdict)
                    sizes[:] = sorted({len(p) for p in known}, reverse=True)
                continue
            best = None
            for _, known, sizes in reversed(stack):
                for n in sizes:
                    if n <= len(path) and (hit := known.get(path[:n])):
                        if best is None or len(hit[0]) > len(best[0]):
                            best = hit
                        break
            ids.append(None if pd.isna(rid) else int(rid))
            hosts.append(host)
            paths.append(path)
            rules.append(best and best[0])
            verdicts.append(best and best[1])
        if ids:
            yield pd.DataFrame({"rid": ids, "host": hosts, "path": paths, "rule": rules, "verdict": verdicts},
                               dtype=object)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """Verdict of every url under ``rules(host, path, verdict)``.

    Returns ``(page_id, host, path, rule, verdict)``: one row per input row.
    """
    spark = pages.sparkSession
    host, path = host_path(c(url_col).cast("string"))
    urls = (pages.select(c(id_col).cast("long").alias("rid"), host.alias("host"), path.alias("path"))
            .withColumn("key", host_key(F.col("host"))))
    spread = F.xxhash64("rid", "path")
    ranges = shuffle_width(spark)
    sample = urls.select("key", spread.alias("h")).orderBy("h").limit(SAMPLE * ranges).collect()
    keys = sorted(r["key"] for r in sample)
    bounds = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []

    @F.pandas_udf("int")
    def url_range(key: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for k, x in zip(key, h):
            lo, hi = bisect_left(bounds, k), bisect_right(bounds, k)
            out.append(lo + x % (hi - lo + 1))
        return pd.Series(out)

    @F.pandas_udf("array<int>")
    def rule_ranges(key: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect_left(bounds, k),
                                     (bisect_left(bounds, k[:-1] + "/") if k else len(bounds)) + 1))
                          for k in key])

    lowered = rules.select(F.translate("host", _A_Z, _a_z).alias("host"), "path", "verdict")
    opened = lowered.withColumn("key", F.when(F.col("host") == "", "").otherwise(host_key(F.col("host"))))
    both = (urls.select(url_range("key", spread).alias("bucket"), "key", F.lit(True).alias("is_url"),
                        "rid", "host", "path", F.lit(None).cast("string").alias("verdict"))
            .unionByName(opened.select(F.explode(rule_ranges("key")).alias("bucket"), "key",
                                       F.lit(False).alias("is_url"),
                                       F.lit(None).cast("long").alias("rid"), "host", "path", "verdict")))
    swept = (both.repartitionById(ranges, F.col("bucket")).sortWithinPartitions("bucket", "key", "is_url")
             .mapInPandas(_sweep, "rid long, host string, path string, rule string, verdict string"))
    return swept.select(F.col("rid").alias("page_id"), "host", "path", "rule",
                        F.coalesce("verdict", F.lit(default)).alias("verdict"))
