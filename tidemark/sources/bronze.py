"""Bronze scans.

Bronze is a folder per entity: ``users`` is one snapshot dataset, the fact
entities are Hive-style ``year=/month=/day=`` partitions appended per
batch, with Parquet as the analytic copy and JSONL as the raw record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import schema_log, schemas
from tidemark.sources.schemas import ENTITIES, FACTS  # noqa: F401


def read_snapshot(spark: SparkSession, root: str, entity: str = "users",
                  schema: T.StructType | None = None) -> DataFrame:
    """The latest snapshot of a dimension."""
    return schemas.read(spark, root, entity, schema)


def read_facts(spark: SparkSession, root: str, entity: str,
               start: str | None = None, end: str | None = None,
               nanos_columns: Sequence[str] = (), schema: T.StructType | None = None) -> DataFrame:
    """All batches of a fact entity, union-by-name across files.

    The declared schema and the records that the batches left
    (``schema_log``) are the union: a column that a batch lacks reads as NULL,
    an undeclared one is there, and no file footer is opened to find out.  A
    ``schema`` given is taken as it is.  ``start`` / ``end`` (``yyyy-MM-dd``,
    ingest date) become filters on the partition columns.

    ``nanos_columns``: files written with nanosecond timestamps cannot be
    read as timestamps; tidemark sessions load them as LONG
    (``spark.sql.legacy.parquet.nanosAsLong``) and they are converted here.
    """
    if schema is None and not nanos_columns:
        df = schema_log.read(spark, f"{root}/{entity}", schemas.schema_of(entity))
        return df.where(schemas.ingested_between(start, end)) if start or end else df
    schema = schema or schemas.schema_of(entity)
    if nanos_columns:
        schema = T.StructType([T.StructField(f.name, T.LongType()) if f.name in nanos_columns else f
                               for f in schema.fields])
    df = schemas.read(spark, root, entity, schema)
    if start or end:
        df = df.where(schemas.ingested_between(start, end))
    for c in nanos_columns:
        df = df.withColumn(c, micros_of_nanos(F.col(c)))
    return df


def micros_of_nanos(nanos: Column) -> Column:
    """Nanoseconds since the epoch as a timestamp, cut to microseconds
    towards the past, in whole numbers throughout."""
    micros = F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000))
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def _typed_partitions(df: DataFrame) -> DataFrame:
    """Partition discovery infers INT for batch ids written as BIGINT."""
    if "batch_id" in df.columns:
        df = df.withColumn("batch_id", F.col("batch_id").cast("long"))
    return df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               corrupt_col: str = "_corrupt_record") -> DataFrame:
    """JSONL bronze with a fixed schema; unparsable lines are kept in
    ``corrupt_col`` (PERMISSIVE) instead of failing the job."""
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    return _typed_partitions(
        spark.read.schema(full).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_col)
        .option("basePath", path).json(path))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """A missing or empty entity is an empty frame, not an error."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) \
                or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], schema)
        raise


def register_views(frames: dict[str, DataFrame], prefix: str = "bronze_") -> list[str]:
    """Expose frames to SQL as ``bronze_<entity>`` temp views."""
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


# Declared external schemas (S10), from the files' real types.
EXTERNAL_POSTS = [("post_id", "STRING"), ("user_id", "STRING"), ("content", "STRING"),
                  ("post_type", "STRING"), ("hashtags", "STRING"), ("hashtag_count", "BIGINT"),
                  ("like_count", "BIGINT"), ("comment_count", "BIGINT"), ("view_count", "BIGINT"),
                  ("is_viral", "BOOLEAN"), ("post_date", "TIMESTAMP_NTZ"),
                  ("ingested_at", "TIMESTAMP_NTZ")]
EXTERNAL_USERS = [("user_id", "STRING"), ("username", "STRING"), ("display_name", "STRING"),
                  ("account_type", "STRING"), ("follower_count", "BIGINT"),
                  ("following_count", "BIGINT"), ("is_verified", "BOOLEAN"),
                  ("joined_at", "TIMESTAMP_NTZ"), ("ingested_at", "TIMESTAMP_NTZ")]


def create_external_tables(spark: SparkSession, database: str, root: str,
                           db_location: str) -> tuple[str, str]:
    """Catalog tables over the published layout (no data copied).

    Posts are partitioned by ingest date; the partitions already on storage
    are registered with RECOVER PARTITIONS.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{db_location}'")
    cols = ", ".join(f"{n} {t}" for n, t in EXTERNAL_POSTS)
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {database}.posts
                  ({cols}, year INT, month INT, day INT, batch_id BIGINT)
                  USING parquet PARTITIONED BY (year, month, day, batch_id)
                  LOCATION '{root}/posts'""")
    spark.sql(f"ALTER TABLE {database}.posts RECOVER PARTITIONS")
    ucols = ", ".join(f"{n} {t}" for n, t in EXTERNAL_USERS)
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {database}.users ({ucols})
                  USING parquet LOCATION '{root}/users'""")
    return f"{database}.posts", f"{database}.users"


def id_lookup(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """S3: column-pruned scan of all ids (only ``cols`` reach the reader)."""
    return df.select(*cols)
