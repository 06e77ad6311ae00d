"""Small helpers over the Hadoop file system API, so that any URI Spark reads works here too."""

from __future__ import annotations

from pyspark.sql import SparkSession


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def same(spark: SparkSession, left: str, right: str) -> bool:
    """Do two paths name the same place, whatever their spelling?"""
    (fs, a), (other, b) = _open(spark, left), _open(spark, right)
    return fs.makeQualified(a).equals(other.makeQualified(b))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children, sorted; a missing folder has none."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and what is below it; a missing path is fine."""
    fs, target = _open(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet, so that readers see all of it or nothing.

    Returns False when another writer published the same path first.
    """
    fs, target = _open(spark, path)
    _, draft = _open(spark, f"{target.getParent().toString()}/.draft-{spark._jvm.java.util.UUID.randomUUID()}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        return False
    return True
