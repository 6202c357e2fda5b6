"""Session construction and cluster-level settings."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on; a cluster launcher may override any of them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A long-lived driver keeps plan graphs and task metrics of finished
    # queries in its status store; bound them so many queries in one
    # session do not fill the driver heap.
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
    "spark.ui.dagGraph.retainedRootRDDs": "200",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shiftline", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the defaults above.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submit keeps its own settings.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    used when present, else a directory that ``setCheckpointDir`` has set.
    Only a local master (tests) may have neither: a scratch folder is created
    once per application and registered as the SparkContext's checkpoint
    directory. On a cluster that would be the driver's own disk, so it fails.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = sc.applicationId
        if app not in _LOCAL_CKPT:
            _LOCAL_CKPT[app] = tempfile.mkdtemp(prefix="shiftline-ckpt-")
        path = _LOCAL_CKPT[app]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_SCRATCH: dict[str, set[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A child folder of the shared checkpoint folder for written intermediates.

    The application owns it: ``remove_folder`` ends one that is no longer read,
    ``clear_scratch`` all that are left.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a written folder, wherever its file system is; nothing happens if it is gone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _SCRATCH.get(spark.sparkContext.applicationId, set()).discard(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder of this application. Frames that read one are void afterwards."""
    for path in sorted(_SCRATCH.get(spark.sparkContext.applicationId, ())):
        remove_folder(spark, path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query that this session runs are deleted when it ends.

    Otherwise they stay until the driver happens to collect its garbage. For
    queries whose results are written or collected, not kept in the session.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
