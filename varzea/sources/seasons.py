"""Season-partitioned tables whose seasons are replaced whole and at once.

A commit writes all seasons that it replaces into a new folder
``v=<number>/temporada=<season>/`` of the table; Spark marks the folder with
``_SUCCESS`` as its last step.  Readers take, for every season, the last
marked folder that has it.  So a reader sees all of a commit or nothing of it:
a driver or an executor that is lost on the way leaves an unmarked folder,
which nobody reads and ``vacuum`` removes.  Nothing that is live is ever
overwritten or renamed, and files are plain Parquet.

A table that was written as ``temporada=<season>/`` folders (``write_table``)
is the version before all commits.

One writer at a time per table; any number of readers.  ``vacuum`` keeps the
folders that a reader may still hold (the last ``keep`` commits of a season).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from varzea.sources import storage

SEASON = "temporada"
NOTE = "_note.json"


def _number(path: str) -> int:
    return int(re.search(r"/v=(\d+)(/|$)", path).group(1))


def _season_of_folder(path: str) -> str:
    return re.search(rf"/{SEASON}=([^/]+)$", path).group(1)


def versions(spark: SparkSession, table_dir: str) -> dict[str, list[int]]:
    """Season (as its folder says) -> the committed versions that have it, ascending; 0 is the plain layout."""
    root = table_dir.rstrip("/")
    out: dict[str, list[int]] = {}
    for path in storage.glob(spark, f"{root}/{SEASON}=*"):
        out.setdefault(_season_of_folder(path), []).append(0)
    done = {_number(p) for p in storage.glob(spark, f"{root}/v=*/_SUCCESS")}
    for path in storage.glob(spark, f"{root}/v=*/{SEASON}=*"):
        if _number(path) in done:
            out.setdefault(_season_of_folder(path), []).append(_number(path))
    return {season: sorted(found) for season, found in out.items()}


def current(spark: SparkSession, table_dir: str) -> dict[str, int]:
    """Season -> the version that readers take."""
    return {season: found[-1] for season, found in versions(spark, table_dir).items()}


def read_seasons(spark: SparkSession, table_dir: str) -> DataFrame:
    """The table as of its last commits.  A filter on the season reads only its folders."""
    root = table_dir.rstrip("/")
    now = current(spark, root)
    plain = [f"{root}/{SEASON}={s}" for s, v in now.items() if v == 0]
    committed = [f"{root}/v={v:08d}/{SEASON}={s}" for s, v in now.items() if v]
    parts = []
    if committed:
        parts.append(spark.read.option("basePath", root).parquet(*committed).drop("v"))
    if plain or not committed:  # without any season the reader tells what is missing
        parts.append(spark.read.option("basePath", root).parquet(*plain) if committed else spark.read.parquet(root))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def has_seasons(spark: SparkSession, table_dir: str) -> bool:
    return bool(versions(spark, table_dir)) or bool(storage.glob(spark, f"{table_dir.rstrip('/')}/*.parquet"))


def clustered(df: DataFrame, by: str = SEASON) -> DataFrame:
    """Rows of one season together, so that a write makes few files for it.
    AQE measures the seasons and splits a large one over several tasks."""
    return df.hint("rebalance", F.col(by))


def commit_seasons(df: DataFrame, table_dir: str, note: dict | None = None, cluster: bool = True) -> dict[str, int]:
    """Replace the seasons that ``df`` has, all at once; ``df`` may read the
    table.  ``note`` is kept beside the version (written after the mark: a
    version may lack it).  ``cluster=False`` when the rows come by season
    already, as from another season table.  Returns the version and the number
    of rows."""
    spark, root = df.sparkSession, table_dir.rstrip("/")
    taken = [_number(p) for p in storage.glob(spark, f"{root}/v=*")]
    version = max(taken, default=0) + 1
    path = f"{root}/v={version:08d}"
    obs = Observation("commit_seasons")
    ((clustered(df) if cluster else df).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy(SEASON).parquet(path))
    if note is not None:
        storage.write_text(spark, f"{path}/{NOTE}", json.dumps(note))
    return {"version": version, "rows": int(obs.get["rows"])}


def notes(spark: SparkSession, table_dir: str) -> dict[str, dict | None]:
    """Season -> the note of the version that readers take."""
    root = table_dir.rstrip("/")
    now = current(spark, root)
    read = {v: storage.read_text(spark, f"{root}/v={v:08d}/{NOTE}") if v else None for v in set(now.values())}
    return {season: json.loads(read[v]) if read[v] else None for season, v in now.items()}


def vacuum(spark: SparkSession, table_dir: str, keep: int = 2) -> list[str]:
    """Delete season folders behind the last ``keep`` versions of their season
    and what unfinished commits before the last one left; returns them."""
    root = table_dir.rstrip("/")
    found = versions(spark, root)
    gone = [f"{root}/{SEASON}={s}" if v == 0 else f"{root}/v={v:08d}/{SEASON}={s}"
            for s, vs in found.items() for v in vs[:-keep]]
    last = max((vs[-1] for vs in found.values()), default=0)
    kept = {v for vs in found.values() for v in vs[-keep:]}
    gone += [p for p in storage.glob(spark, f"{root}/v=*") if _number(p) < last and _number(p) not in kept]
    for path in gone:
        storage.delete(spark, path)
    return gone
