"""Session helpers.

On a cluster the session is created by the platform; ``get_spark`` only fills
in settings that are still unset, so cluster-level configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job here relies on. They are defaults: a value already set on
# the session (cluster config, spark-submit --conf) is left alone.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def _local_heap() -> str:
    """Heap for a local session: 60% of physical memory, at most 16g."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6) >> 30))}g"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ledgerloom") -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_defaults(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # call-site capture per DataFrame call is for interactive debugging
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY",
                                                             _local_heap()))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # a local session has no shared folder; give it a scratch one
        builder = builder.config("spark.checkpoint.dir",
                                 tempfile.mkdtemp(prefix="ledgerloom-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application: their Python
    tasks import it. A session in one process has it already."""
    sc = spark.sparkContext
    if sc.master.split("[")[0] == "local" or getattr(sc, "_ledgerloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-src-"), "ledgerloom_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._ledgerloom_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    It is read from the session, never replaced. Only a local session without
    one (tests) gets a scratch folder; a cluster session without one is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    # the configured folder first: getCheckpointDir() adds a random subfolder
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster session")
        current = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
