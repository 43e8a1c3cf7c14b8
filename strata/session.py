"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants, whatever the cluster size. Sizes that depend on
# the cluster (shuffle partitions, executor memory) are left to the caller.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "strata",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with the job defaults.

    An existing session is reused as it is (a scheduler or notebook owns its
    lifecycle); it is never stopped by this library.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scale_conf(shuffle_bytes: int, total_cores: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster and the job's widest shuffle.

    ``shuffle_bytes`` is the size of the largest exchange, not of the input:
    here the aggregations shuffle one row per key per task, and only the
    non-broadcast join fallback moves the projected fact rows. Scan splits
    and shuffle partitions aim at ``partition_bytes`` so a task's working set
    fits executor memory; there are never fewer shuffle partitions than twice
    the cores, and AQE merges small ones back to the advisory size.
    """
    mb = max(1, partition_bytes // (1024 * 1024))
    shuffle = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{max(1, mb // 2)}m",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A folder under the cluster's shared checkpoint folder: a fresh one, or
    with ``unique=False`` the same one for the same name (callers overwrite it).

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only when
    that is unset on a local master (tests) is a local folder chosen and
    registered, so later ``checkpoint()`` calls land in the same place; on a
    cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local"):
                raise RuntimeError(
                    "set spark.checkpoint.dir to a folder shared by all executors; "
                    "a driver-local folder cannot hold data that executors write")
            configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(configured)
        base = sc.getCheckpointDir()
    base = base.rstrip("/")
    return f"{base}/strata/{name}-{uuid.uuid4().hex[:12]}" if unique else f"{base}/strata/{name}"

