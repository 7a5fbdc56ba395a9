"""K1-K5: sinks.

Writes are the only actions the library runs itself.  Row counts come from an
``Observation`` attached to the write (same job, no second read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from varzea.session import configure


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_within: list[str] | None = None, mode: str = "overwrite", cluster: bool = True) -> int:
    """K1/K2: write Parquet and return the row count observed during the
    write.  With ``partition_by`` and the session's dynamic partition
    overwrite, only the partitions present in ``df`` are replaced; rows of one
    partition are brought together first (AQE splits a large one again), so
    it gets few files.  ``cluster=False`` spares that shuffle for rows that a
    join, a merge or a scan of such folders has in few large tasks already."""
    obs = Observation("write_table")
    out = df
    if partition_by and cluster:
        out = out.hint("rebalance", *map(F.col, partition_by))
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("compression", "zstd").parquet(path)
    return int(obs.get["rows"])


def sort_column(spec: str):
    """``"col [ASC|DESC] [NULLS FIRST|LAST]"`` -> a sort Column (default
    ascending, nulls last)."""
    words = spec.split()
    col, rest = F.col(words[0]), [w.upper() for w in words[1:]]
    desc = "DESC" in rest
    nulls_first = "FIRST" in rest
    if desc:
        return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls_first else col.asc_nulls_last()


def export_json(df: DataFrame, path: str, order: list[str] | None = None, compression: str = "none") -> None:
    """K3: JSON Lines export, dates as ISO text.  ``order`` ("col DESC")
    gives the row order inside the files (a range-partitioned sort);
    ``compression`` as Spark's JSON writer takes it (``gzip``)."""
    out = df
    if order:
        out = out.orderBy(*[sort_column(o) for o in order])
    out.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").option("compression", compression).json(path)


def publish(tables: dict[str, DataFrame], dest: str) -> dict[str, int]:
    """K4: copy tables to the serving folder."""
    return {name: write_table(df, f"{dest.rstrip('/')}/{name}") for name, df in tables.items()}


# Match-keyed tables: bucketed by match id with the same bucket count, so
# joins between them on ``partida_id`` read co-located buckets (no shuffle).
MATCH_BUCKETS = {"partidas": ["partida_id"], "estatisticas": ["partida_id"], "gols": ["partida_id"],
                 "cartoes": ["partida_id"], "escalacoes": ["partida_id"], "campeonato_historico": ["partida_id"]}


def publish_catalog(spark: SparkSession, tables: dict[str, DataFrame], database: str = "varzea",
                    partition_by: dict[str, list[str]] | None = None,
                    bucket_by: dict[str, list[str]] | None = None, buckets: int = 64,
                    location: str | None = None) -> list[str]:
    """K5: replace the served tables in a Spark database (the source loads a
    MySQL server; season partitioning and match-id bucketing stand in for its
    indexes).  ``bucket_by`` (e.g. ``MATCH_BUCKETS``) writes the named tables
    bucketed and sorted by those columns with ``buckets`` buckets; size the
    count so one bucket file stays around 128-512 MB.  A JDBC target is
    ``df.write.jdbc(...)`` on the same frames.  ``location`` names the
    database's folder, else it is the warehouse's.  Bucketed rows are brought
    together by bucket first, so a bucket is one file; rows that are partitioned
    so already, or read from buckets (``bucket_reader``), are not shuffled."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, df in tables.items():
        bcols = (bucket_by or {}).get(name)
        cols = (partition_by or {}).get(name)
        w = (df.repartition(buckets, *bcols) if bcols else df).write.mode("overwrite").format("parquet").option("compression", "zstd")
        if cols:
            w = w.partitionBy(*cols)
        if bcols:
            w = w.bucketBy(buckets, *bcols).sortBy(*bcols)
        w.saveAsTable(f"{database}.{name}")
    return sorted(tables)


def bucket_reader(spark: SparkSession) -> SparkSession:
    """A session with the same tables that reads bucketed ones bucket by bucket
    also where no join or grouping asks for it, so what is made of their rows
    can be written in the same buckets as they come.  Spark else turns such
    scans into plain ones."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    return configure(reader)


def publish_views(spark: SparkSession, database: str = "varzea") -> list[str]:
    """V6: the served views over the tables that ``publish_catalog`` has put
    into the database.  Each is replaced in turn; they outlive the session that
    made them and follow their tables."""
    from varzea.operators.gold import VIEW_SQL
    for name, (source, select) in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {select.format(table=f'{database}.{source}')}")
    return list(VIEW_SQL)
