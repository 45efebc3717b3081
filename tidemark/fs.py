"""Small file-system helpers through Hadoop's FileSystem API.

These are the calls a Spark user makes for housekeeping (``exists``,
``ls``, ``rm``) so that they work on any Hadoop-compatible store (HDFS,
object stores), not just the driver's local disk.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when the folder holds at least one visible (non ``_``/``.``) file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def remove(spark: SparkSession, path: str, guard_root: str) -> bool:
    """Recursive delete, refused outside ``guard_root`` (our own tree)."""
    norm = path.rstrip("/")
    root = guard_root.rstrip("/")
    if not (norm == root or norm.startswith(root + "/")):
        raise ValueError(f"refusing to delete {path!r} outside {guard_root!r}")
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file through a hidden temporary file next to it and a
    rename. A file of a new name appears whole or not at all; a file that is
    written again is gone for the moment between delete and rename."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise IOError(f"could not move {tmp} to {path}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
