"""Session construction and the shared folder jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults this engine relies on; anything already set by the cluster
# (spark-submit --conf, spark-defaults) wins over the builder only for keys we
# do not pass here.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Concurrent jobs (one per tag) share the executors instead of queueing.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "tagweave",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    ``master`` is only set when given: on a cluster spark-submit decides it.
    ``hive`` uses the Hive catalog the cluster is configured for, so a database
    of warehouse tables is found and registered tables outlive the process.
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        settings.setdefault("spark.driver.memory", "16g")
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bounded_session(spark: SparkSession, bytes_of: dict[str, int]) -> SparkSession:
    """A session of its own with the settings of ``spark``, but the sizes named by ``bytes_of`` at most these bytes.

    Files are split by the session that reads them, shuffles by the session of the frame that runs.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.get(name, None) != value:
            own.conf.set(name, value)
    parse = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in bytes_of.items():
        own.conf.set(name, str(min(most, parse(spark.conf.get(name)))))
    return own


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not value:
        value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    return value or None


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Job outputs that must survive executor loss (and checkpoints that cut
    lineage) go below it. Only when nothing is configured - local tests - a
    folder of our own is made and registered as the checkpoint dir; on a
    cluster an unset value is an error, never a machine-local fallback.
    """
    value = _configured_checkpoint_dir(spark)
    if value:
        return value.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ...) before running tagweave jobs on a cluster"
        )
    own = tempfile.mkdtemp(prefix="tagweave-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, uniquely named folder below the shared root."""
    return os.path.join(shared_root(spark), "tagweave", f"{label}-{uuid.uuid4().hex}")
