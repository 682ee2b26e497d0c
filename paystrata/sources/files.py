"""Small file-system helpers that work on any Hadoop URI (file, hdfs, s3a)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove ``path`` and what lies below it; False where there was nothing."""
    target, fs = _path(spark, path)
    return fs.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str, *, replace: bool = True) -> None:
    """Create one small file; an existing one is replaced, or else an error."""
    target, fs = _path(spark, path)
    stream = fs.create(target, replace)
    try:
        if text:
            stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small file."""
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in name order."""
    target, fs = _path(spark, pattern)
    found = fs.globStatus(target) or []
    return sorted(status.getPath().toString() for status in found)
