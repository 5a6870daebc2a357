"""Session helpers: the shared work folder and a local session for tests.

Everything that must be materialised (checkpoints, staged loads, fixture
extracts, published tables) lives below the folder the cluster names in
``spark.checkpoint.dir``.  The library only *reads* that setting; a folder of
our own is set only when the session has none and runs in one process
(``local[...]``: tests, bench).  On a cluster an unset folder is an error,
never a machine-local temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set here only if unset."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_KEY} is not set: name a folder every executor can reach "
                "(HDFS or object store) in the session configuration")
        # single-process session (tests, bench): a folder of our own is shared by all tasks
        root = tempfile.mkdtemp(prefix="lodestar-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, root)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root.rstrip("/")


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder of this application below the shared checkpoint folder."""
    return "/".join([_work_root(spark), *parts, uuid.uuid4().hex[:12]])


def _work_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/lodestar/{spark.sparkContext.applicationId}"


def drop_work(spark: SparkSession) -> None:
    """Delete this application's work folders.  Results that still read them are lost: call
    it when they have been written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_work_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fixed_dir(spark: SparkSession, *parts: str) -> str:
    """A stable folder below the shared checkpoint folder (for cached fixtures)."""
    return "/".join([checkpoint_root(spark), "lodestar", *parts])


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "lodestar") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, ANSI (4.x default)."""
    ckpt = tempfile.mkdtemp(prefix="lodestar-ckpt-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(CHECKPOINT_KEY, ckpt)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
