"""Session settings, and the shared folder for tables written along the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

#: Names the folder for tables written along the way; ``spark.checkpoint.dir`` if unset.
SCRATCH_SETTING = "lakebook.scratch.dir"
_FOLDERS = (SCRATCH_SETTING, "spark.checkpoint.dir")
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

SETTINGS = {
    # Event dates are cut out of text and compared with a run date: one zone only.
    "spark.sql.session.timeZone": "UTC",
    # Rebalanced writes, coalesced shuffles and split skewed joins need AQE.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Only sides whose bytes were counted are broadcast (operators.enrich). The size
    # of a table's compressed files says little about its rows in memory, and a join
    # planned on it would also keep all rows of an unsplittable file in one task.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}

_scratch: dict[tuple[str, str], str] = {}


def local_session(cores: str = "8", app: str = "lakebook", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        # Writing many day folders is bound by opening files, not by bytes: even
        # the small writes of a test should use all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings the library relies on onto an existing session, for good."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Folders are listed in tasks of many folders each, not in one task a folder.
    spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))
    return spark


def own_session(spark: SparkSession, settings: bool = True) -> SparkSession:
    """A session beside ``spark``, which keeps its own settings, with the library's.

    It shares the application, its executors and cached tables. The other SQL settings,
    and the shared folders, are those that ``spark`` has now; without ``settings``, all are.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if (key.startswith("spark.sql.") or key in _FOLDERS) and own.conf.get(key, None) != value:
            try:
                own.conf.set(key, value)
            except PySparkException:
                continue  # fixed for the whole application, and so the same
    return apply_settings(own) if settings else own


def activate(spark: SparkSession) -> None:
    """Make ``spark`` the thread's active session, where Spark looks formats up.

    Creating rows in another session of the application changes it.
    """
    kind = SparkSession._get_j_spark_session_class(spark._jvm)
    kind.setActiveSession(spark._jsparkSession)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself would open it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of ended steps; for the start of a step that writes.

    Spark deletes them when the driver's JVM collects what named them. Jobs that leave the
    driver little to collect would else keep those of every step until the last one ends.
    """
    spark.sparkContext._jvm.System.gc()


def _scratch_root(spark: SparkSession, base: str) -> str:
    """This application's folder below ``base``; removed when its JVM ends."""
    context = spark.sparkContext
    key = (context.applicationId, base)
    if key not in _scratch:
        root = f"{base.rstrip('/')}/lakebook-{context.applicationId}-{uuid.uuid4().hex[:8]}"
        path, system = hadoop_path(spark, root)
        system.mkdirs(path)
        system.deleteOnExit(path)
        _scratch[key] = root
    return _scratch[key]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that all executors share.

    ``lakebook.scratch.dir`` names that folder, or else ``spark.checkpoint.dir``. Only a
    local session may go without either: there, driver and executors are one machine.
    What is written below goes when the application ends.
    """
    base = spark.conf.get(SCRATCH_SETTING, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SCRATCH_SETTING} to a folder shared by the cluster")
        base = tempfile.gettempdir()
    return f"{_scratch_root(spark, base)}/{purpose}-{uuid.uuid4().hex}"
