"""K6: publish the lake as files, version by version.

A version is a manifest: every published file with its size, time and SHA-256.
Publishing compares the lake's files with the last manifest and copies only
what is new, byte for byte and with the same relative path, in the tasks of a
Spark job; so no column can be lost and nothing is encoded again.  The new
manifest is written next and takes effect when one small pointer file is
replaced.  A run that dies before leaves the old version as it was, and its
files in place: what is no longer part of the version goes only afterwards.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files, schema_log, schemas

MANIFEST = "entity string, path string, stored string, size long, modified timestamp, sha256 string"
POINTER, MANIFESTS = "_current", "_manifests"
CHUNK = 1 << 20


def _store(uri: str):
    """The store of a path and the path within it."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1)) if "://" in uri else (fs.LocalFileSystem(), uri)


def _copy(source: str, target: str) -> str:
    """Copy one file as bytes, put in place when whole; its SHA-256."""
    (a, x), (b, y) = _store(source), _store(target)
    digest, part = hashlib.sha256(), f"{y.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.part"
    b.create_dir(y.rsplit("/", 1)[0], recursive=True)
    with a.open_input_stream(x) as src, b.open_output_stream(part) as out:
        while data := src.read(CHUNK):
            digest.update(data)
            out.write(data)
    b.move(part, y)
    return digest.hexdigest()


def _copied(lake: str, dest: str):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(sha256=[_copy(f"{lake}/{p}", f"{dest}/{s}") for p, s in zip(pdf["path"], pdf["stored"])])
    return run


def _removed(dest: str):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for s in pdf["stored"]:
                store, path = _store(f"{dest}/{s}")
                if store.get_file_info(path).is_file:
                    store.delete_file(path)
            yield pdf[["stored"]]
    return run


def _lake_files(spark: SparkSession, lake: str, entities: Sequence[str]) -> DataFrame:
    """Data files of the lake; only names, sizes and times are read."""
    there = [e for e in entities if files.exists(spark, f"{lake}/{e}")]
    if not there:
        return spark.createDataFrame([], MANIFEST).select("entity", "path", "size", "modified")
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load([f"{lake}/{e}" for e in there]))
    # behind the lake's own name, whatever the scheme before it
    tail = "/".join(lake.rstrip("/").split("/")[-2:])
    path = F.substring_index(F.col("path"), f"/{tail}/", -1)
    return found.select(F.substring_index(path, "/", 1).alias("entity"), path.alias("path"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))


def version_of(spark: SparkSession, dest: str) -> int | None:
    text = files.read_text(spark, f"{dest}/{POINTER}")
    return int(text) if text else None


def manifest(spark: SparkSession, dest: str, version: int | None = None) -> DataFrame:
    """The files of a version (the current one by default); empty before the first."""
    v = version if version is not None else version_of(spark, dest)
    if v is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{dest}/{MANIFESTS}/version={v}")


def publish(spark: SparkSession, lake: str, dest: str, entities: Sequence[str] = schemas.ENTITIES) -> dict[str, int]:
    """Publish the Parquet files of ``entities``; ``{version, copied, kept, removed}``.

    Entities that the lake does not have are skipped (and leave the copy).  A
    file that was replaced under its own name is stored beside the old one
    until the new version is in place.
    """
    old_version = version_of(spark, dest)
    new_version = (old_version or 0) + 1
    old, now = manifest(spark, dest), _lake_files(spark, lake, entities)
    was = old.select(F.col("path").alias("_path"), "stored", F.col("size").alias("_size"), F.col("modified").alias("_modified"), "sha256")
    met = now.join(was, now["path"] == was["_path"], "left")
    same = F.coalesce((F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified")), F.lit(False))
    name = F.when(F.col("_path").isNull(), F.col("path")).otherwise(
        F.regexp_replace("path", "([^/]+)$", f"v{new_version}-$1"))
    todo = met.where(~same).select("entity", "path", name.alias("stored"), "size", "modified", F.lit("").alias("sha256"))
    done = todo.repartition(F.col("path")).mapInPandas(_copied(lake, dest), MANIFEST)
    kept = met.where(same).select("entity", "path", "stored", "size", "modified", "sha256")
    target = f"{dest}/{MANIFESTS}/version={new_version}"
    done.unionByName(kept).write.mode("overwrite").parquet(target)
    for e in entities:  # the few schema records go along
        for record in files.names(spark, f"{lake}/{e}/{schema_log.FOLDER}"):
            for x in files.names(spark, f"{lake}/{e}/{schema_log.FOLDER}/{record}"):
                where = f"{e}/{schema_log.FOLDER}/{record}/{x}"
                if not files.exists(spark, f"{dest}/{where}"):
                    files.write_text(spark, f"{dest}/{where}", files.read_text(spark, f"{lake}/{where}") or "")
    files.write_text(spark, f"{dest}/{POINTER}", str(new_version))  # from here on the new version holds
    new = manifest(spark, dest, new_version)
    gone = old.join(new.select("stored"), "stored", "left_anti").select("stored")
    removed = gone.mapInPandas(_removed(dest), "stored string").count()
    total, reused = new.count(), new.join(old.select("stored"), "stored", "left_semi").count()
    return {"version": new_version, "copied": total - reused, "kept": reused, "removed": removed}


def read_published(spark: SparkSession, dest: str, entity: str) -> DataFrame:
    """The entity's rows in the current version, all columns of its batches."""
    root = f"{dest}/{entity}"
    paths = [f"{dest}/{r['stored']}" for r in manifest(spark, dest).where(F.col("entity") == entity).select("stored").collect()]
    declared = schemas.schema_of(entity)
    known = schema_log.recorded(spark, root)
    full = schema_log.merge(declared, list(known.values()))
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).parquet(*paths)
