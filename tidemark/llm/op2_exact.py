"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

The index is a bucketed table with one row per distinct normalised text:
``(digest, keep_id, group_size, batch_id)``.  A batch of new documents is
reduced to one row per digest (pre-aggregated on the map side), anti-joined to
the index by sort-merge and the digests not seen before are appended to their
buckets.  The index side is never shuffled; the files of a bucket, one sorted
file a batch, are sorted together in the task that reads the bucket.

The files are the index: a small record beside them tells the buckets, and a
session that does not know the table registers the files that are there.  So
an index outlives its session and its catalog.

Defined results: null text counts as empty, so all null and empty texts form
one group; a null id loses every tie against an id; rows that repeat an id
and a text are members of one group of which a single row is kept; an empty
batch gives no rows and appends nothing; columns other than the id and the
text are ignored.  A batch may be run again, after a crash and in other
partitions: digests that its own ``batch_id`` put into the index still count
as new, and the same rows (or, of rows equal in id and length, one) stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import c, join_spreading_hot, materialize, shuffle_width, text_key, text_of
from tidemark.session import shared_root
from tidemark.sources import files

#: deleted before texts are compared
WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "digest binary, keep_id long, group_size long, batch_id string"
#: beside the files: how many buckets they are in
RECORD = "_buckets"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without white space, as 32 bytes."""
    return F.unhex(F.sha2(F.translate(text, WHITE, "").cast("binary"), 256))


class DigestIndex:
    """A digest table stored at ``path``, by default under the shared folder and its name."""

    def __init__(self, spark: SparkSession, name: str | None = None,
                 path: str | None = None, buckets: int | None = None):
        self.spark, self.name = spark, name or f"digest_index_{uuid.uuid4().hex[:12]}"
        self.path = path or f"{shared_root(spark)}/tidemark/digest-index/{self.name}"
        known = files.read_text(spark, f"{self.path}/{RECORD}")
        self.buckets = int(known) if known else buckets or shuffle_width(spark)
        if not known:
            files.write_text(spark, f"{self.path}/{RECORD}", str(self.buckets))
        # registers the files that are there, or none yet; never writes over them
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name} ({SCHEMA}) USING parquet
                      CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'""")

    def _write(self, rows: DataFrame) -> None:
        # one task per bucket: the write's hash is the bucket hash, so each
        # batch adds one sorted file to each bucket
        (rows.repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def dedup(self, docs: DataFrame, batch_id: str = "0", id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
        """Mark each row of ``docs`` as kept or not, appending its new digests.

        Of a group new to the index, the row with the longest original text
        (code points), then the smallest id, stays; of a group that an
        earlier batch brought, no row does and ``keep_id`` names that
        batch's document.  Returns ``(doc_id, keep_id, group_size, kept,
        text_sha256, text_key, uid)``; ``group_size`` counts the rows of the batch
        that first brought the text.
        """
        text = text_of(text_col)
        slim = materialize(docs.select(
            c(id_col).cast("long").alias("doc_id"), digest_of(text).alias("digest"),
            text_key(text).alias("text_key"), F.length(text).alias("len"), F.monotonically_increasing_id().alias("uid")),
            "digests")
        order = F.struct((-F.col("len")).alias("l"), F.col("doc_id").isNull().alias("z"),
                         F.col("doc_id").alias("i"), F.col("uid").alias("u"))
        groups = materialize(
            slim.groupBy("digest").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n"))
            .select("digest", F.col("best.i").alias("best_id"), F.col("best.u").alias("best_uid"), "n"),
            "digest_groups")
        known = self.rows().select("digest")
        self._write(groups.join(known.hint("merge"), "digest", "left_anti").select(
            "digest", F.col("best_id").alias("keep_id"), F.col("n").alias("group_size"),
            F.lit(batch_id).alias("batch_id")))
        # which row stays is decided by this run's own rows: ids within Spark's
        # partitions are not the same when a batch runs again
        own = F.col("batch_id") == F.lit(batch_id)
        found = groups.join(self.rows().hint("merge"), "digest").select(
            "digest", "n", "batch_id", "best_uid", F.when(own, F.col("best_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(own, F.col("n")).otherwise(F.col("group_size")).alias("group_size"))
        joined = join_spreading_hot(slim, found, "digest", "n", slim.count())
        return joined.select(
            "doc_id", "keep_id", "group_size",
            (own & (F.col("uid") == F.col("best_uid"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"), "text_key", "uid")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                buckets: int | None = None) -> DataFrame:
    """Dedup one whole table against a fresh index (see ``DigestIndex.dedup``)."""
    return DigestIndex(docs.sparkSession, buckets=buckets).dedup(docs, "0", id_col, text_col)
