"""Session construction and the shared working folder.

Everything in lakekit is a lazy ``DataFrame -> DataFrame`` function; the
only places that need a session-level decision are (a) building a session
for tests / the bench and (b) choosing where intermediate tables and
round-trip outputs are written.  For (b) we always use the folder the
cluster names in ``spark.checkpoint.dir`` (a shared, fault-tolerant
location); only when that is unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins and
# coalesces / splits shuffle partitions from runtime statistics, and skew
# join splitting handles a hot key that carries a large share of the rows.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(
    master: str | None = None,
    app_name: str = "lakekit",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with lakekit's defaults.

    ``master`` is only given in tests and the bench; on a cluster the
    submitter decides it.  The UI is kept off: nothing here serves pages.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SCALE_DEFAULTS)
    settings["spark.ui.enabled"] = "false"
    settings["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared working folder (``spark.checkpoint.dir``).

    Read from the session; only where it is unset *and* the master is
    local (tests, single-machine runs) a folder is created and registered as
    the checkpoint dir.  On a cluster an unset value is an error: a
    driver-local folder is invisible to executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured.rstrip("/")
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a random sub-folder; its parent is ours.
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder (e.g. on the cluster file system)")
    base = tempfile.mkdtemp(prefix="lakekit-ckpt-")
    sc.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared working folder."""
    return f"{shared_dir(spark)}/lakekit/{purpose}/{uuid.uuid4().hex}"


def scale_conf(
    input_bytes: int,
    target_partition_bytes: int = 256 * 1024**2,
    min_partitions: int = 200,
    max_partitions: int = 200_000,
) -> dict[str, str]:
    """Session settings sized for a job reading ``input_bytes``.

    Shuffle partitions start at one per ``target_partition_bytes`` of input
    (clamped), so even an un-reduced shuffle of the whole input fits in
    executor memory per task; adaptive execution then coalesces small
    partitions and splits skewed ones (a partition five times the median and
    above 1 GiB is split).  Scan splits match the target size.
    """
    partitions = max(min_partitions, min(max_partitions, -(-input_bytes // target_partition_bytes)))
    mib = target_partition_bytes // 1024**2
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mib}m",
        "spark.sql.files.maxPartitionBytes": f"{mib}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }
