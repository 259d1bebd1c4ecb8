"""Small files beside the data (records, pointers), by the session's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place at once: whoever reads it finds the old text or the new."""
    p, fs = _path(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.part")
    sink = fs.create(part, True)
    try:
        sink.write(bytearray(text.encode()))
    finally:
        sink.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    (spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
     .rename(part.makeQualified(fs.getUri(), fs.getWorkingDirectory()), p.makeQualified(fs.getUri(), fs.getWorkingDirectory()), over))
