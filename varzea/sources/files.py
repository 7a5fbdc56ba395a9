"""File sources and the ad-hoc SQL entry point."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varzea.operators.payloads import with_place

# Request paths in the names of provider B's cache files.
EVENT_PATH = r"^event_(\d+)_(statistics|incidents|lineups)$"
ROUND_PATH = r"_season_(\d+)_events_round_(\d+)$"


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _csv(spark: SparkSession, path, names, sep, header, encoding, optional, multi_line=False) -> DataFrame:
    r = spark.read.option("header", str(header).lower()).option("sep", sep).option("encoding", encoding)
    r = r.option("multiLine", str(multi_line).lower())
    r = r.option("mode", "PERMISSIVE").option("escape", '"')  # a quote inside quotes is doubled
    if names:  # the reader keeps the line of a row whose width is not the schema's
        r = r.schema(string_schema([*names, "_line"])).option("columnNameOfCorruptRecord", "_line")
    df = r.csv(path).withColumn("_source_file", F.col("_metadata.file_path"))
    if not names:
        return df
    outside_quotes = F.regexp_replace("_line", '"[^"]*"', "")
    width = F.size(F.split(outside_quotes, re.escape(sep)))
    wrong = F.col("_line").isNotNull() & ~width.between(len(names) - optional, len(names))
    # names a data column too: Spark reads no file for the kept line alone
    message = F.concat_ws(" ", width.cast("string"), F.lit(f"columns, expected {len(names)}:"), "_source_file", names[0])
    return df.filter(F.when(wrong, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("_line")


def read_csv_any(spark: SparkSession, path, names: list[str] | None = None, sep: str = ",",
                 header: bool = True, optional: int = 0) -> DataFrame:
    """CSV files of unknown encoding, all columns STRING.

    With ``names`` every row's own width counts, so a folder may mix files
    with and without the last ``optional`` columns (null where missing); a
    row of any other width fails the read.  Without ``names`` the header of
    one file names the columns of all.

    The raw bytes decide, file by file: one pass over the lines tells of each
    file whether a line is not valid UTF-8 (then it is ISO-8859-1; a U+FFFD that
    the file itself holds is text like any other) and whether a quoted field
    goes on in the next line (an odd number of quotes in a line).  Only files
    with such fields are read as records of several lines, which cannot be
    split over tasks.  What the driver gets is a row per file, like the listing
    that it reads files by.  A UTF-8 BOM is dropped by the reader."""
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"')))
    files = (spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file"))
             .agg(F.bool_or(~F.is_valid_utf8(line)).alias("latin"), F.bool_or(quotes % 2 == 1).alias("multi")).collect())
    groups: dict[tuple, list[str]] = {}
    for f in files:
        groups.setdefault(("ISO-8859-1" if f["latin"] else "UTF-8", f["multi"]), []).append(_as_path(f["file"]))
    out = None
    for (encoding, multi), paths in sorted(groups.items()):
        part = _csv(spark, sorted(paths), names, sep, header, encoding, optional, multi)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else _csv(spark, path, names, sep, header, "UTF-8", optional)


def _as_path(uri: str) -> str:
    """A file's URI as a path pattern that means this file alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def table(spark: SparkSession, root: str, name: str, layer: str = "silver",
          schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet table of a layer; select columns on the result and
    Catalyst prunes the read schema; filters on the partition column prune
    folders."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{root.rstrip('/')}/{layer}/{name}")


def read_payloads(spark: SparkSession, path, whole_file: bool = True) -> DataFrame:
    """Raw provider payloads.  ``whole_file``: one JSON document per file
    (the API cache layout, ``{endpoint}__{k}{v}_{k}{v}.json``); otherwise JSON
    Lines, read in as many splits as the size asks for.  The endpoint and
    parameters are parsed from the file name; ``_doc`` (file time, file name,
    place in the file) orders the documents for a merge.

    Provider B's cache names the request path instead,
    ``{client}__{path with _}__{params}.json``: its round lists become endpoint
    ``round`` (season_id, round), its match details ``event_*`` (match)."""
    df = with_place(spark.read.text(path, wholetext=whole_file).select(
        F.col("value").alias("payload"), F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_time"), F.col("_metadata.file_block_start").alias("_start")))
    df = df.withColumn("_file", F.col("_doc.file"))
    stem = F.regexp_replace("_file", r"\.json[l]?$", "")
    params = F.element_at(F.split(stem, "__"), -1)
    kv = F.transform(F.split(params, "_"), lambda p: F.struct(
        F.regexp_extract(p, r"^([A-Za-z]+)", 1).alias("k"), F.regexp_extract(p, r"^[A-Za-z]+(.*)$", 1).alias("v")))
    path = F.get(F.split(stem, "__"), F.lit(1))
    match = F.regexp_extract(path, EVENT_PATH, 1)
    detail = F.regexp_extract(path, EVENT_PATH, 2)
    season_id, rodada = F.regexp_extract(path, ROUND_PATH, 1), F.regexp_extract(path, ROUND_PATH, 2)
    return df.select(
        F.when(match != "", F.concat(F.lit("event_"), detail)).when(rodada != "", F.lit("round"))
         .otherwise(F.element_at(F.split(stem, "__"), 1)).alias("endpoint"),
        F.when(match != "", F.create_map(F.lit("match"), match))
         .when(rodada != "", F.create_map(F.lit("season_id"), season_id, F.lit("round"), rodada))
         .otherwise(F.map_from_entries(kv)).alias("params"), "_file", "payload",
        "_doc")


def land_raw(spark: SparkSession, src, dest: str, fmt: str = "text") -> DataFrame:
    """Bronze landing — keep the file content unchanged, add where and
    when it came from, append to Parquet.  A file that is there already with
    the same content is not landed again, so a retry adds nothing.  Returns
    the landed rows."""
    df = (spark.read.text(src, wholetext=True)
          .select(F.col("value").alias("conteudo"), F.col("_metadata.file_path").alias("_source_file"),
                  F.current_timestamp().alias("_ingested_at"), F.lit(fmt).alias("_formato")))
    df = df.withColumn("_sha256", F.sha2("conteudo", 256))
    try:
        landed = spark.read.parquet(dest).select("_source_file", "_sha256")
    except AnalysisException:  # the first landing
        landed = None
    if landed is not None:
        df = df.join(landed, ["_source_file", "_sha256"], "left_anti").select(*df.columns)
    df.write.mode("append").parquet(dest)
    return spark.read.parquet(dest)


def union_seasons(frames: list[DataFrame]) -> DataFrame:
    """Stack yearly sheets by column name (missing columns -> null).
    The list is the folder's files, not data rows."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Register tables by name for ad-hoc SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def run_sql(spark: SparkSession, sql: str, limit: int | None = None, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over the registered views, all rows; ``limit`` is for a
    caller that pages.  Named parameters (``:time1``) replace the source's
    session variables."""
    out = spark.sql(sql, args=args or {})
    return out if limit is None else out.limit(limit)
