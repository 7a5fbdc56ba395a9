"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(df: DataFrame, col: str = "text") -> Column:
    """UTF-8 bytes of a text column; null is empty."""
    return F.coalesce(df[col], F.lit("")).cast("binary")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every executor this package, once per Spark application: tasks of
    the operators import it, and executors need not share the driver's folders."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="varzea-ship-"), "varzea_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join(os.path.basename(package), os.path.relpath(full, package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def ship_file(spark: SparkSession, path: str) -> str:
    """Give every executor a file of the driver; tasks find it as ``SparkFiles.get(<the returned name>)``."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, for files that tasks write themselves."""
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"
    at, system = _hadoop(spark, path)
    system.mkdirs(at)
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, ready for an operator."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  On a cluster it is what
    ``spark.checkpoint.dir`` names; only a session without it (a local test)
    gets the library's own scratch folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    from varzea.session import scratch_dir
    return scratch_dir(spark, "llm")


_scratch: list[list[DataFrame]] = []


def staged(df: DataFrame, label: str, group_rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends at
    Parquet files that survive lost executors, and the work is done once.  The
    folder goes when the driver's JVM ends, or before (``scratch``, ``drop_staged``).

    ``group_rows``: rows of a row group, for tables of large rows.  Spark's
    writer holds 100 rows before it looks at their size, and its reader decodes
    a group of up to 4096 at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"
    writer = df.write.option("parquet.block.row.count.limit", group_rows) if group_rows else df.write
    writer.parquet(path)
    at, system = _hadoop(spark, path)
    system.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if _scratch:
        _scratch[-1].append(out)
    return out


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_staged(*frames: DataFrame) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for df in frames:
        at, system = _hadoop(df.sparkSession, df._staged_at)
        system.delete(at, True)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged inside are deleted at the end, but for those passed to the function that it gives."""
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    _scratch.append([])
    try:
        yield keep
    finally:
        inside = _scratch.pop()
        drop_staged(*(df for df in inside if not any(df is k for k in kept)))
        if _scratch:
            _scratch[-1] += kept


@contextmanager
def configured(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Inside, a setting of the session has this value."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Inside, Spark deletes the shuffle files of a query when the query ends:
    what ``staged`` has written is read from Parquet, so nothing needs them again."""
    return configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def partitions(spark: SparkSession) -> int:
    """The shuffle width that the cluster's owner chose for the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Memo(dict):
    """A bounded memo of ``make(key)``.  When ``entries`` are reached the old
    half is set aside and forgotten unless it is asked for again, so frequent
    keys stay.  It only saves work; no result depends on what it holds."""

    def __init__(self, make, entries: int, key_chars: int = 64):
        super().__init__()
        self.make, self.half, self.key_chars, self.old = make, max(1, entries // 2), key_chars, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
            if len(key) > self.key_chars:
                return got
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got
