"""The schemas an entity's batches were written with.

Each append leaves a record of its columns and types under ``_schemas``: one
file for every distinct schema, with an empty marker for each batch written
so.  A reader merges the few records with the declared schema and opens no
data file for it: a column that a batch lacks reads as null, one that nobody
declared is there, and a type that changed is widened.

Widening: whole numbers to the wider, to ``double`` with a fraction, dates to
timestamps, anything else that differs to ``string``; a conflict never stops a
reader.  Where Parquet files cannot be read as the wider type directly, the
batches of each schema are read as written and cast.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files
from tidemark.sources.schemas import PARTITIONS

FOLDER = "_schemas"
#: whole numbers, narrow to wide
_WHOLE = ["tinyint", "smallint", "int", "bigint"]
#: what Spark's Parquet reader widens by itself
_READ_AS = {("tinyint", "int"), ("smallint", "int"), ("tinyint", "bigint"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"),
            ("int", "double"), ("date", "timestamp_ntz")}


def _plain(schema: T.StructType) -> T.StructType:
    """Without the partition columns, which are in the folders' names."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema if f.name not in (*PARTITIONS, "batch_id")])


def _fingerprint(schema: T.StructType) -> str:
    return hashlib.sha256(schema.json().encode()).hexdigest()[:16]


def record(spark: SparkSession, root: str, schema: T.StructType, batch_id: int) -> None:
    """Note that ``batch_id`` of the entity at ``root`` is written with ``schema``; a batch
    that runs again with another one leaves the old record."""
    plain = _plain(schema)
    own = _fingerprint(plain)
    there = files.names(spark, f"{root}/{FOLDER}")
    for other in there:
        if other != own:
            files.remove(spark, f"{root}/{FOLDER}/{other}/batch={batch_id}")
    if own not in there:
        files.write_text(spark, f"{root}/{FOLDER}/{own}/schema.json", plain.json())
    files.write_text(spark, f"{root}/{FOLDER}/{own}/batch={batch_id}", "")


def recorded(spark: SparkSession, root: str) -> dict[str, T.StructType]:
    """The distinct schemas of the entity's batches, by the name of their record."""
    out = {}
    for name in files.names(spark, f"{root}/{FOLDER}"):
        text = files.read_text(spark, f"{root}/{FOLDER}/{name}/schema.json")
        if text:
            out[name] = T.StructType.fromJson(json.loads(text))
    return out


def batches_of(spark: SparkSession, root: str, name: str) -> list[int]:
    return [int(x.removeprefix("batch=")) for x in files.names(spark, f"{root}/{FOLDER}/{name}") if x.startswith("batch=")]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    x, y = a.simpleString(), b.simpleString()
    if x == y:
        return a
    if x in _WHOLE and y in _WHOLE:
        return a if _WHOLE.index(x) > _WHOLE.index(y) else b
    if {x, y} <= {*_WHOLE, "float", "double"}:
        return T.DoubleType()
    if {x, y} <= {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    return T.StringType()


def merge(declared: T.StructType, others: list[T.StructType]) -> T.StructType:
    """The declared columns, then the others by name."""
    types = {f.name: f.dataType for f in declared}
    for name, kind in sorted(((f.name, f.dataType) for s in others for f in s), key=lambda x: x[0]):
        types[name] = wider(types[name], kind) if name in types else kind
    return T.StructType([T.StructField(n, k) for n, k in types.items()])


def _read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", root).parquet(root)


def read(spark: SparkSession, root: str, declared: T.StructType) -> DataFrame:
    """All batches of the entity at ``root`` with the union of their columns."""
    known = recorded(spark, root)
    parts = [f for f in declared if f.name in (*PARTITIONS, "batch_id")]
    merged = merge(_plain(declared), list(known.values()))
    full = T.StructType([*merged.fields, *parts])
    types = {f.name: f.dataType for f in merged}
    # batches without a record have the declared types
    ways = {None: _plain(declared), **known}
    odd = {name for name, s in ways.items() for f in s
           if f.dataType != types[f.name] and (f.dataType.simpleString(), types[f.name].simpleString()) not in _READ_AS}
    if not odd:
        return _read(spark, root, full)
    out, seen = None, []
    for name, own in known.items():
        ids = batches_of(spark, root, name)
        seen += ids
        as_written = T.StructType([*own.fields, *parts])
        part = _cast(_read(spark, root, as_written).where(F.col("batch_id").isin(ids)), full)
        out = part if out is None else out.unionByName(part)
    rest = _cast(_read(spark, root, declared).where(~F.col("batch_id").isin(seen)), full)
    return rest if out is None else out.unionByName(rest)


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*((F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema))
