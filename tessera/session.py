"""Session settings, and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the cluster names no shared folder, as in tests on one machine.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"

#: Bytes of an Arrow batch, about; whole texts go to Python workers, and ten thousand long ones are too much at once.
BATCH_BYTES = 1 << 23

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app: str = "tessera", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session on one machine, for tests, the command line and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: spark.checkpoint.dir, or a local one where that is unset and the master is local."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(LOCAL_CHECKPOINTS)
    return LOCAL_CHECKPOINTS


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most about BATCH_BYTES from here on, whatever the length of texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Cuts the lineage as checkpoint() does, survives lost executors, and is column-wise and
    compressed, so that later readers fetch only what they use. The files go when the program ends.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_folder(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a table that materialize wrote and that nothing reads any more."""
    _remove(df.sparkSession, df._tessera_path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing holds any more; else they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended before the program; its owner clears the folder
        pass
