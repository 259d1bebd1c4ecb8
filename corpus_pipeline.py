"""The corpus pipeline: ``documents`` through five operators, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the
columns of its input (the last one returns the tokens).  Toxicity and
decontamination judge row by row.  The dedup stages match rows by id and text
(null ids among themselves), so rows that share an id have a fate of their own;
of linked rows that repeat an id and a text one stays, any one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import op2_exact, op5_toxicity, op6_bpe, op7_decontaminate, op10_ngram_join
from tidemark.llm.common import materialize, table, text_key, text_of

TOKENS = "byte_bpe_50k.tiktoken"


def _free(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {x.lower() for x in docs.columns}:
        name += "_"
    return name


def _staying(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` named in ``rows(doc_id, text_key, n)``; where ``n``
    is above 1, one of the rows alike in id and text.  Always sort-merge joins:
    the names grow with the documents."""
    key, own = _free("_key", docs), _free("_id", docs)
    other = _free(key + "_", docs)
    marked = docs.withColumn(key, text_key(text_of("text")))

    def named(names: DataFrame) -> DataFrame:
        names = names.select(F.col("doc_id").alias(own), F.col("text_key").alias(other)).hint("merge")
        return marked.join(names, marked["doc_id"].eqNullSafe(names[own]) & (marked[key] == names[other]), "left_semi")
    alike = materialize(rows.where("n > 1"), "alike")  # seldom any
    if alike.isEmpty():
        return named(rows).drop(key)
    return named(rows.where("n = 1")).unionByName(named(alike).dropDuplicates(["doc_id", key])).drop(key)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity operator rejects."""
    return op5_toxicity.clean(docs, op5_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    found = op2_exact.exact_dedup(docs).groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    return _staying(docs, materialize(found.where("kept"), "exact"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest id, of each group that n-gram links
    connect; texts without words link with nothing and all stay."""
    found = op10_ngram_join.jaccard_groups(docs).where("first")
    linked = found.where("n_shingles > 0").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    alone = found.where("n_shingles = 0").select("doc_id", "text_key", F.lit(1).cast("long").alias("n")).distinct()
    return _staying(docs, materialize(linked.unionByName(alone), "first"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item."""
    return op7_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document that is left, checked by decoding them again:
    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    return op6_bpe.round_trip(docs, public_tokenizers.path(TOKENS), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("benchmark decontamination", decontamination), ("byte-level BPE", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


#: the conditional random field, the tilings and the tokens are beyond SQL
ORACLE_SQL = None
