"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splits a hot key's partition instead of
# letting one task own a third of the rows.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A dimension is only broadcast when the planner can prove it is small.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "turnstone",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor (ignored once a JVM runs)
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only in local mode, when the setting is absent (tests), a private scratch
    folder is created and registered. On a cluster an unset folder is an error:
    executors would write to their own disks and later reads would miss rows.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not path:
        path = _LOCAL_BASE.get(id(sc)) or tempfile.mkdtemp(prefix="turnstone-ckpt-")
        _LOCAL_BASE[id(sc)] = path
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some deployments reject runtime core confs
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_LOCAL_BASE: dict[int, str] = {}  # test/local sessions only: the folder created for them


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df, expensive_last_stage: bool = False):
    """Cut lineage for a frame that a multi-pass operator reads several times.

    Uses a reliable ``checkpoint()`` into the shared ``spark.checkpoint.dir``
    (never a machine-local folder, never ``localCheckpoint``), so a lost
    executor does not force the upstream joins to be recomputed and every
    pass sees identical rows. The checkpoint write re-runs the frame's last
    stage; when that stage is costly (e.g. a Python UDF) pass
    ``expensive_last_stage=True`` to cache it for the duration of the write.
    """
    checkpoint_dir(df.sparkSession)
    if not expensive_last_stage:
        return df.checkpoint(eager=True)
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
