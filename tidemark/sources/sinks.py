"""Sinks (K1-K3, K6-K8) and small-file compaction."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files, publish, schema_log, schemas
from tidemark.sources.schemas import PARTITIONS

#: marks staged rows that are whole and not yet swapped in; holds the root they belong to
READY = "_ready"
#: rows in a file of the raw record at most
JSONL_RECORDS = 500_000


def with_ingest_partitions(df: DataFrame, ingest_col: str = "ingested_at") -> DataFrame:
    """Partition columns follow the *ingest* date, not the event date."""
    ts = F.col(ingest_col).cast("timestamp_ntz")
    return (df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
            .withColumn("day", F.dayofmonth(ts)))


def _jsonl(df: DataFrame) -> DataFrameWriter:
    """Writer of the raw record: gzip, which a reader cannot split, in files of bounded length."""
    return df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", JSONL_RECORDS)


def snapshot_replace(df: DataFrame, path: str, jsonl_path: str | None = None) -> str:
    """K1: replace a dimension snapshot (Parquet, optionally JSONL too)."""
    df.write.mode("overwrite").parquet(path)
    if jsonl_path:
        _jsonl(df).json(jsonl_path)
    return path


def append_partitioned(df: DataFrame, root: str, batch_id: int,
                       jsonl_root: str | None = None,
                       ingest_col: str = "ingested_at") -> str:
    """K2: land one batch under ``year=/month=/day=/batch_id=``.

    The batch id is a partition column, and the write uses dynamic
    partition overwrite: re-running a batch replaces exactly that batch's
    folders (idempotent) while other batches stay untouched.  Task retries
    after a lost executor are covered by the file commit protocol.  Ids are
    not negative; the stream writer uses the negative ones.
    """
    if batch_id < 0:
        raise ValueError("negative batch ids belong to the stream writer")
    out = df if all(c in df.columns for c in PARTITIONS) else with_ingest_partitions(df, ingest_col)
    out = out.withColumn("batch_id", F.lit(batch_id).cast("long"))
    cols = [*PARTITIONS, "batch_id"]
    # One writer task per partition folder instead of every task writing a
    # file into every folder; AQE splits a hot (skewed) day over several
    # tasks and merges tiny ones.
    (out.hint("rebalance", *cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(root))
    schema_log.record(df.sparkSession, root, out.schema, batch_id)
    if jsonl_root:
        # the raw copy is made from what was just landed (partition pruning
        # reads this batch only): nothing is computed twice or cached.  It is
        # dealt out anew: a scan task's rows are many times its Parquet bytes,
        # too many to be sorted by folder in memory
        landed = (df.sparkSession.read.schema(out.schema).option("basePath", root).parquet(root)
                  .where(F.col("batch_id") == batch_id))
        (_jsonl(landed.hint("rebalance", *cols)).option("partitionOverwriteMode", "dynamic")
         .partitionBy(*cols).json(jsonl_root))
    return root


def materialize(df: DataFrame, path: str, sort_within: Sequence[str] = ()) -> DataFrame:
    """K3: write a model as a table in its layer and read it back.

    Cuts lineage at a durable copy in the shared folder (survives executor
    loss, unlike caching); ``sort_within`` orders rows inside each file for
    better min/max pruning without a global sort.
    """
    w = df.sortWithinPartitions(*sort_within) if sort_within else df
    w.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_all(frames: dict[str, DataFrame], root: str,
                    max_parallel: int = 4) -> dict[str, DataFrame]:
    """K3 for independent tables of one layer: their write jobs are
    submitted together, so the scheduler fills slots one job leaves idle
    (small tables, stage tails) with tasks of the others."""
    return run_parallel({k: (lambda k=k, v=v: materialize(v, f"{root}/{k}"))
                         for k, v in frames.items()}, max_parallel)


def register_tables(spark: SparkSession, database: str, paths: dict[str, str]) -> list[str]:
    """K3: catalog tables over a layer's folders, so SQL users find
    ``database.table`` (no data is copied; a table that exists is replaced)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, path in paths.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
        names.append(f"{database}.{name}")
    return names


def run_parallel(actions: dict[str, Callable], max_parallel: int = 4) -> dict:
    """Run independent Spark actions from a small thread pool (each Python
    thread drives its own jobs); the first failure is re-raised."""
    if len(actions) <= 1 or max_parallel <= 1:
        return {k: f() for k, f in actions.items()}
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(actions))) as pool:
        futures = {k: pool.submit(f) for k, f in actions.items()}
        return {k: fut.result() for k, fut in futures.items()}


def publish_layout(spark: SparkSession, lake_root: str, dest_root: str,
                   entities: Sequence[str] = schemas.ENTITIES) -> list[str]:
    """K6: copy the Parquet lake (never the JSONL) to another store with the
    same relative layout, file by file (``publish.publish``); entities missing
    from the lake are skipped.  What left the lake also leaves the copy."""
    publish.publish(spark, lake_root, dest_root, entities)
    return [r["entity"] for r in publish.manifest(spark, dest_root).select("entity").distinct().orderBy("entity").collect()]


def published_files(spark: SparkSession, root: str) -> DataFrame:
    """K7: list published Parquet files with sizes (content is not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(root).select("path", "length"))


def write_batch_tables(tables: dict[str, DataFrame], root: str) -> str:
    """K8: write the aggregate tables, each in as few files as its size asks
    for (the REBALANCE hint merges small partitions whatever the table)."""
    for name, df in tables.items():
        df.hint("rebalance").write.mode("overwrite").parquet(f"{root}/{name}")
    return root


def compact(spark: SparkSession, root: str, staging: str,
            start: str | None = None, end: str | None = None) -> int:
    """Rewrite the ingest-date partitions of a fact entity in [start, end]
    (all by default) into few, well-sized files — the stream writer leaves
    one small file per flush.

    Two jobs whatever the number of days: the REBALANCE hint gives each
    partition folder its own writer task (AQE splits a hot day into
    several), the result lands in ``staging`` and is then swapped in with
    a dynamic partition overwrite (reading and overwriting one folder in a
    single job is unsafe).  Returns the row count moved.  A run that stops in
    the swap may leave ``root`` without some partitions; the next run with the
    same ``staging`` finishes that swap first (nothing else may write the
    partitions until then).
    """
    ready = f"{staging}/{READY}"
    if files.read_text(spark, ready) == root:
        _swap_in(spark, staging, root)  # an earlier run stopped in its swap: the staged rows are the whole ones
    # maintenance reads every footer: a column that only some files carry
    # must survive, whether it is declared or not
    src = spark.read.option("mergeSchema", "true").option("basePath", root).parquet(root)
    src = src.where(schemas.ingested_between(start, end))
    parts = [c for c in (*PARTITIONS, "batch_id") if c in src.columns]
    src.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(staging)
    staged = spark.read.option("mergeSchema", "true").option("basePath", staging).parquet(staging)
    lost = set(src.columns) - set(staged.columns)
    if lost:
        raise ValueError(f"compaction of {root} would lose columns: {sorted(lost)}")
    n = staged.count()
    files.write_text(spark, ready, root)
    _swap_in(spark, staging, root)
    return n


def _swap_in(spark: SparkSession, staging: str, root: str) -> None:
    """Replace the partitions of ``root`` that ``staging`` holds; safe to repeat until it ends."""
    staged = spark.read.option("mergeSchema", "true").option("basePath", staging).parquet(staging)
    parts = [c for c in (*PARTITIONS, "batch_id") if c in staged.columns]
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(root))
    files.remove(spark, f"{staging}/{READY}")
