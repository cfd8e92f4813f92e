"""Session set-up and shared-folder helpers.

Every job in this package assumes these session properties:

* ``spark.sql.session.timeZone = UTC`` - dates and epoch conversions must not
  depend on where the driver runs (the landed data is UTC).
* ANSI SQL on (the Spark 4 default) - malformed values are handled with
  ``try_cast`` / ``get`` explicitly instead of silently turning into null.
* AQE on - runtime coalescing of small shuffle partitions, skew-join splitting
  and the ``rebalance`` hint used by the partitioned writers.
* small-file packing tuned for landing zones (``openCostInBytes``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Landed documents are a few kB each.  Costing each open at 1 MB (not the
    # 4 MB default) packs ~128 of them into a 128 MB read task instead of ~32,
    # so a million-file landing zone is ~8k tasks, not ~31k.  Large Parquet
    # files are unaffected.
    "spark.sql.files.openCostInBytes": str(1 << 20),
}


def get_session(
    app_name: str = "feedlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are only set when given, so the
    same call works under ``spark-submit`` on a cluster, where the cluster
    manager decides both.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone (runtime setting, safe on a live session)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder used for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; it is read from the
    session.  Only when it is unset (local runs, tests) is a fresh local
    directory created and registered - never on a cluster, where a
    machine-local folder would not be visible to the other executors.
    """
    sc = spark.sparkContext
    # the configured folder itself (stable across sessions) before the
    # per-context sub-folder Spark creates for RDD checkpoints
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    local = tempfile.mkdtemp(prefix="feedlake-ckpt-", dir=os.environ.get("FEEDLAKE_TMP"))
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused location under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
