"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
LOCAL: dict[str, str] = {}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hirelens", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    On a cluster, ``master`` is left to spark-submit, and so are the number of
    shuffle partitions and the broadcast threshold unless the caller names them.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Text extraction is CPU-heavy per byte: let AQE keep small post-shuffle
        # partitions instead of packing a few MB of postings into one task.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", os.environ.get("HIRELENS_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staging.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    go without: one process then reads what it wrote, so a temp folder serves.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None) or LOCAL.get("dir")
    if not d:
        if not spark.conf.get("spark.master", "local").startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        d = LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="hirelens-ckpt-"))
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # pragma: no cover - Connect sessions have no SparkContext
        pass
    return d


SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder (remembered for ``drop_staged``)."""
    import uuid
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    SCRATCH.append(path)
    return path
