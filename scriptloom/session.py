"""Session set-up, written intermediate tables and scan spreading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BROADCAST_BYTES = 64 * 1024 * 1024  # largest side broadcast by an explicit hint, after measuring


def get_session(app: str = "scriptloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster settings given by the submitter stay untouched."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in {**base, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in spark.checkpoint.dir.

    Where none is set, a local master (tests) gets a temporary folder; any other master is an error, since
    executors would each write to a disk of their own and the rows would be missing when read back.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="scriptloom-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)  # this process made it and alone uses it
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, last: bool = False) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back.

    last: what was shuffled for it goes from disk as soon as it is written, not when the driver collects its plan.

    The result survives the loss of executors and has a known size, so joins with it need no hint:
    Spark broadcasts it below `spark.sql.autoBroadcastJoinThreshold` and shuffles it beyond.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    if last:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if last:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove tables of `written` that nothing will read any more."""
    for table in tables:
        folder = getattr(table, "_folder", None)
        if folder:
            sc = table.sparkSession.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work where a scan has fewer tasks than cores; large inputs stay as they are.

    Hashing unique keys needs no sort and gives the same rows to a task that runs again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
