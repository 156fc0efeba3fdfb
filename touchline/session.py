"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: let AQE split them, also when a later operator then needs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lake dates look like integers (date=20200612); keep partition values as the text they are.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Stream state with a row per game may outgrow executor memory; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

STATIC_CONF = {
    "spark.ui.enabled": "false",
    # Recording a stack trace for every Column call costs more than building the plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "touchline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword arguments use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**STATIC_CONF, **RUNTIME_CONF}
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # Folders are listed side by side, by a job per parent folder; a task per folder, as is usual, costs far more than
    # the listing itself.
    lists = max(32, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(lists))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which every executor can reach.

    ``spark.checkpoint.dir`` where it is set, else a folder below the session's warehouse; the same rule for every
    master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return named.rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/touchline-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables; frames that still read them can no longer be used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now, not when the driver's memory happens to be collected.

    For flows whose steps each move much data and are cut by written tables.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files.

    Later stages then survive the loss of executors, read only the columns they need, and Spark knows
    the size of what was written when it decides on a broadcast.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
