"""Bounded samples that merge.

The sample of a key is its ``k`` rows of least row hash (bottom-k).  Which
rows these are depends on the rows alone, not on their order, the partitions
or the number of batches they came in, so samples merge: the sample of a union
is the bottom-k of the samples.  A sketch is the sample of each key with the
number of rows it stands for; the sketches of landed batches are kept side by
side and merged on read, so no batch is read again when the next one comes.

There is no bound unless one is given: ``k=None`` is every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HASH, ROWS = "row_hash", "rows_seen"
#: what stands between the fields of a row, and for a null
_BETWEEN, _NULL = "\x1f", "\\N"


def row_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the row's fields as text; equal rows have equal hashes."""
    return F.sha2(F.concat_ws(_BETWEEN, *(F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in cols)), 256)


def _least(rows: DataFrame, keys: Sequence[str], k: int | None) -> DataFrame:
    """The ``k`` rows of least hash of each key.  The rank limit is applied before
    the shuffle too, so a key costs ``k`` rows a task whatever it holds."""
    if k is None:
        return rows
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(HASH))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def bounded_sample(df: DataFrame, keys: Sequence[str], k: int | None = None, hash_cols: Sequence[str] | None = None) -> DataFrame:
    """The rows of the sample with their hash, and the rows that their key has (``rows_seen``).

    Null keys are a key of their own; of equal rows as many are taken as fit;
    an empty input has an empty sample.
    """
    hashed = df.withColumn(HASH, row_hash(hash_cols or df.columns))
    seen = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    return _with_counts(_least(hashed, keys, k), seen, keys)


def _with_counts(sample: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = seen.select(*(F.col(c).alias(f"__{c}") for c in keys), ROWS)
    same = None
    for c in keys:
        one = sample[c].eqNullSafe(named[f"__{c}"])
        same = one if same is None else same & one
    return sample.join(named, same, "left").drop(*(f"__{c}" for c in keys))


def merge_samples(samples: Sequence[DataFrame], keys: Sequence[str], k: int | None = None) -> DataFrame:
    """The sample of the union of what ``samples`` (with disjoint inputs, each of
    ``k`` rows a key at least) stand for."""
    parts = [s.withColumn("__part", F.lit(i)) for i, s in enumerate(samples)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return _merged(both, "__part", keys, k)


def _merged(parts: DataFrame, part: str, keys: Sequence[str], k: int | None) -> DataFrame:
    seen = (parts.groupBy(part, *keys).agg(F.max(ROWS).alias(ROWS))
            .groupBy(*keys).agg(F.sum(ROWS).alias(ROWS)))
    return _with_counts(_least(parts.drop(part, ROWS), keys, k), seen, keys)


def add_batch(df: DataFrame, path: str, batch_id: int, keys: Sequence[str], k: int, hash_cols: Sequence[str] | None = None) -> None:
    """Keep the sketch of one landed batch under ``path``; a batch that runs again replaces its own."""
    (bounded_sample(df, keys, k, hash_cols).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_sample(spark: SparkSession, path: str, keys: Sequence[str], k: int | None = None) -> DataFrame:
    """The sample over all batches kept under ``path``; ``k`` must not exceed what was kept."""
    return _merged(spark.read.parquet(path), "batch_id", keys, k)


def estimated_counts(sample: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Estimated rows of each ``(keys, by)`` in what the sample stands for: a
    row of a key with ``n`` rows, ``m`` of them in the sample, stands for n/m."""
    own = Window.partitionBy(*keys)
    return (sample.withColumn("__stands", F.col(ROWS) / F.count(F.lit(1)).over(own))
            .groupBy(*keys, *by).agg(F.sum("__stands").alias("estimate"), F.count(F.lit(1)).alias("sampled")))
