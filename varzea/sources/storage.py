"""Small file-system helpers over the cluster's own (Hadoop) file systems, so
that any path Spark can read works.  They move metadata only, never rows."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in order."""
    at, system = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in system.globStatus(at) or [])


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _at(spark, path)
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, system = _at(spark, path)
    system.delete(at, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the driver's JVM ends."""
    at, system = _at(spark, path)
    system.deleteOnExit(at)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all (written beside, then renamed)."""
    at, system = _at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = system.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    system.delete(at, False)
    if not system.rename(beside, at):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    at, system = _at(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def listing(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Number of files under ``paths`` and a hash of their names, sizes and times: equal if nothing changed."""
    found = {"files": 0, "hash": 0}
    for path in paths:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")).alias("h")).first())
        found = {"files": found["files"] + files["n"], "hash": int(found["hash"] + (files["h"] or 0))}
    return found
