"""Spark session defaults for corpus jobs.

Everything here is ordinary session configuration. On a cluster the
launcher's settings win (``getOrCreate`` returns the running session and we
only fill in what is unset); locally we pick values sized for tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. AQE re-plans joins at runtime: a side whose
# materialised shuffle output is small becomes a broadcast (that is the size
# check for derived tables such as dictionaries), skewed join partitions are
# split, and small shuffle partitions are coalesced.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # staged lookup tables (Parquet, so of known size) up to this are broadcast
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # shuffle partitions are sized by AQE from map output (coalesced to this
    # size) rather than by a fixed count
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # text rows expand several-fold once tokenised and exploded: keep file
    # splits smaller than the 128MB default so a task's working set fits
    "spark.sql.files.maxPartitionBytes": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    # delete checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with ``DEFAULTS``. On a local master the setting
    ``spark.quire.scan.partitions`` deals scans of the row-keyed tables over so
    many partitions: test files have a single row group, which one task reads.
    It is unset on a cluster, where scans stay as Spark splits them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
        if shuffle_partitions:
            conf["spark.quire.scan.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables:
    ``spark.checkpoint.dir`` of the session. Only a session on a local master
    (tests, one machine) gets a scratch folder when it is unset; a cluster
    without the setting is an error, because executors could not read each
    other's files in a machine-local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(sc.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local_master(master: str) -> bool:
    """Whether driver and tasks share one machine (``local-cluster`` starts
    separate executors and counts as a cluster)."""
    return master == "local" or master.startswith("local[")


def materialize(df):
    """Cut the lineage of ``df`` with a reliable checkpoint in the session's
    checkpoint directory (eager)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back:
    columnar, prunable, and its size is known to the planner, so a later join
    broadcasts it only when the measured size allows."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SPENT_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_packed(df: DataFrame, label: str) -> DataFrame:
    """``stage`` for what is large beside the input: stronger compression, and Spark
    deletes the shuffles made for it when it is written, not when the driver's
    memory happens to be collected."""
    spark, path = df.sparkSession, stage_path(df.sparkSession, label)
    before = spark.conf.get(SPENT_SHUFFLES, None)
    spark.conf.set(SPENT_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SPENT_SHUFFLES) if before is None else spark.conf.set(SPENT_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def stage_path(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared folder; a ``stage_scope`` that is open
    on this session will know it."""
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in getattr(spark.sparkContext, "_quire_scopes", []):
        scope.append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Collects the paths staged inside it. The caller passes those whose readers
    are done to ``remove_stages``; nothing is removed by itself, because a lazy
    result may still read what it staged."""
    scopes = spark.sparkContext.__dict__.setdefault("_quire_scopes", [])
    paths: list[str] = []
    scopes.append(paths)
    try:
        yield paths
    finally:
        scopes[:] = [s for s in scopes if s is not paths]


def remove_stages(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders, in any store Spark can write."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system (any store Spark can read)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per session), so that Python
    tasks can import it wherever the driver was started. The archive is built in
    the driver's own temporary folder; Spark serves it from there."""
    sc = spark.sparkContext
    if getattr(sc, "_quire_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quire-pkg-"), "quire_pkg.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("quire", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._quire_shipped = True
