"""W1 without a rebuild: the newest row of each key, kept up batch by batch.

The history is a table in buckets of the key, sorted by it.  A batch is reduced
to its newest row per key (one row a key and task before the shuffle) and
shuffled to the history's buckets; the history itself is merged where it lies,
without an exchange.  Each merge writes the next version and then swaps a
small pointer, so a run that dies leaves the version before; a version that
was replaced is removed when the merge after it begins.

Deleted versions are kept as rows (tombstones): filters come after, as in a
full rebuild.  Merging the same batch again changes nothing, nor does the order
of batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by_key
from tidemark.sources import files

POINTER = "_current"


class KeyedTable:
    """The newest rows by ``key`` under ``path``; it outlives its session.

    Of rows of one key the one with the largest ``order`` stays, then the
    largest by ``tie_break`` (nulls are least).  Rows without key are left out.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, order: str = "ingested_at",
                 tie_break: Sequence[str] = (), buckets: int = 64):
        self.spark, self.path, self.key, self.order, self.ties, self.new_buckets = spark, path, key, order, list(tie_break), buckets

    def _state(self) -> dict | None:
        text = files.read_text(self.spark, f"{self.path}/{POINTER}")
        return json.loads(text) if text else None

    def _table(self, state: dict) -> str:
        """The version's files as a bucketed table of this session's catalog."""
        name = f"keyed_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"""CREATE TABLE {name} ({state['schema']}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`)
                           INTO {state['buckets']} BUCKETS LOCATION '{self.path}/version={state['version']}'""")
        return name

    def rows(self) -> DataFrame | None:
        """The newest row of every key so far; None before the first batch."""
        state = self._state()
        return self.spark.table(self._table(state)) if state else None

    def merged(self, batch: DataFrame) -> DataFrame:
        """What the table is after ``batch``, as a plan."""
        new = latest_by_key(batch.where(F.col(self.key).isNotNull()), self.key, self.order, self.ties)
        old = self.rows()
        if old is None:
            return new
        if set(old.columns) != set(new.columns):
            raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
        place = lambda t: F.struct(*(F.col(f"{t}.{c}") for c in (self.order, *self.ties)))
        from_new = F.col(f"o.{self.key}").isNull() | (F.col(f"n.{self.key}").isNotNull() & (place("n") >= place("o")))
        both = old.alias("o").join(new.hint("merge").alias("n"), F.col(f"o.{self.key}") == F.col(f"n.{self.key}"), "full_outer")
        return both.select(*(F.when(from_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in old.columns))

    def merge(self, batch: DataFrame) -> int:
        """Merge a batch; the new version's number."""
        state = self._state()
        version = state["version"] + 1 if state else 1
        for name in files.names(self.spark, self.path):  # versions before the current, and what a lost run left
            if name.startswith("version=") and (not state or name != f"version={state['version']}"):
                files.remove(self.spark, f"{self.path}/{name}")
        out = self.merged(batch)
        buckets = state["buckets"] if state else self.new_buckets
        if not state:
            out = out.repartition(buckets, self.key)
        (out.write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
         .option("path", f"{self.path}/version={version}").saveAsTable(f"merge_{uuid.uuid4().hex[:12]}"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
        files.write_text(self.spark, f"{self.path}/{POINTER}", json.dumps({"version": version, "buckets": buckets, "schema": schema}))
        return version
