"""Session construction and the shared scratch location.

Library code never invents a machine-local folder on a cluster: every
materialised intermediate goes under ``spark.checkpoint.dir``, which the
cluster names. Only a local-mode session without that setting (tests, the
bench) gets a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts at run
# time, splits skewed shuffle partitions and turns small join sides into
# broadcasts only after their real size has been measured.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tidewatch",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    ``master`` and ``shuffle_partitions`` are left to the cluster when None.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.parquet.outputTimestampType"):
        spark.conf.set(k, SCALE_CONF[k])
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when
    neither is set and the master is local, a new temporary folder is created
    and registered; on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it")
    # local mode only (tests, bench): a private temporary folder
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def missing_path(e: AnalysisException) -> bool:
    """Whether a read failed only because nothing has been written there yet."""
    return e.getCondition() == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


@contextmanager
def many_folders(spark: SparkSession):
    """For reading tables of thousands of folders: they are listed by a few tasks a core, not
    by a task each. A stream that starts inside keeps the setting."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(key)
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, old)


# paths made inside the open scopes, the innermost last
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables made inside are deleted at the end, by the driver, with whatever file
    system they lie on. For jobs that write their results elsewhere: a DataFrame that still
    reads scratch must not leave the scope."""
    mine: list[str] = []
    _scopes.append(mine)
    try:
        yield
    finally:
        _scopes.remove(mine)
        for path in mine:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
