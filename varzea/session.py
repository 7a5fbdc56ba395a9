"""Session settings the library relies on.

* session time zone UTC: epoch seconds in provider payloads are read as UTC;
* AQE on: joins of small per-club feature tables are turned into broadcast
  joins only when their *measured* size is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise sort-merge;
* ``mapKeyDedupPolicy=LAST_WIN``: provider statistics lists may repeat a key,
  the last value wins (as a Python dict build would);
* dynamic partition overwrite: rewriting a season touches only its partition.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LIBRARY_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for k, v in LIBRARY_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app: str = "varzea",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library settings.

    ``master`` is only set when given, so on a cluster the launcher decides.
    The Spark UI stays off: no web server is opened by the library.
    """
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**LIBRARY_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect session
        pass
    configure(spark)
    if _is_local(spark):
        _ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One machine runs everything, so its own folders are shared ones."""
    return re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")) is not None


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session
    without it gets a private one under the system temp folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="varzea-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)  # for DataFrame.checkpoint()
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        pass
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for staged writes
    and lineage cuts.  Never a machine-local folder when the cluster names one.
    The folder is deleted when the driver's JVM ends; name a folder of your own
    for what shall stay."""
    from varzea.sources.storage import delete_at_end
    base = _ensure_checkpoint_dir(spark)
    path = base.rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"  # Spark's writers create it
    delete_at_end(spark, path)
    return path
