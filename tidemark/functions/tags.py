"""Three ways the pipeline turns a hashtag JSON-array *string* into tags.

* ``json_tags``    strict JSON parse; NULL / ``[]`` / non-array give no tag,
                   text is kept as is, NULL elements are kept (gold mart).
* ``split_tags``   strip ``[ ] "`` and split on ``,``: tags after the first
                   keep their leading space (cloud SQL report).
* ``lenient_tags`` parse, trim, drop blanks; a malformed value gives no tag
                   (streaming counters).
All return ``array<string>`` columns so callers can ``explode`` them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_ARRAY = "array<string>"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_tags(col: Column | str = "hashtags") -> Column:
    return F.from_json(_c(col), TAG_ARRAY)


def malformed_tags(col: Column | str = "hashtags") -> Column:
    """True when a non-NULL value does not parse as a JSON array."""
    return _c(col).isNotNull() & json_tags(col).isNull()


def split_tags(col: Column | str = "hashtags", trim: bool = False) -> Column:
    parts = F.split(F.regexp_replace(_c(col), r'[\[\]"]', ""), ",")
    return F.transform(parts, lambda t: F.trim(t)) if trim else parts


def lenient_tags(col: Column | str = "hashtags") -> Column:
    """Tags the streaming counter keeps.

    The counter walks the list and gives up on the first element it cannot
    strip (a JSON null), keeping the tags before it; blanks are skipped and
    every kept tag is stripped of surrounding (Unicode) whitespace.
    """
    arr = json_tags(col)
    first_null = F.array_min(F.transform(arr, lambda x, i: F.when(x.isNull(), i)))
    kept = F.when(first_null.isNull(), arr).otherwise(F.slice(arr, 1, first_null))
    stripped = F.transform(kept, lambda t: F.regexp_replace(t, r"(?U)^\s+|\s+$", ""))
    return F.filter(stripped, lambda t: t != "")
