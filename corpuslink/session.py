"""Session helpers. Operators never build a session; tests, bench and scripts do."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "corpuslink") -> SparkSession:
    """Session for one machine. On a cluster use the session the cluster gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Without the place in the program of every expression, large plans are made several times faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; a local one only where none is named
    and the session is a local one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = sc.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="run-checkpoint-")
    sc.setCheckpointDir(shared)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and continue from the written copy,
    which keeps statistics and column pruning and survives the loss of any executor."""
    spark = df.sparkSession
    folder = shared_folder(spark, "copy")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the checkpoint folder, which every executor can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a stored copy that nothing will read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def list_folders(spark: SparkSession, folder: str, done: bool = False) -> list[str]:
    """Names of the folders in ``folder`` (none if it is not there), only those a Spark write has
    marked as complete if ``done``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [s.getPath() for s in files.listStatus(path) if s.isDirectory()]
    marked = lambda p: files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return [p.getName() for p in found if not done or marked(p)]


BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let rows with whole texts go to Python tasks in smaller batches than Spark's default of
    10,000 rows. A setting the session has been given stays."""
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(rows))
