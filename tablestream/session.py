"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this library wants. AQE picks the physical join, splits skewed
# join partitions and coalesces small ones, so no operator hard-codes a partition count.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "tablestream", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session. On a cluster ``master`` stays None and the submit conf wins."""
    b = SparkSession.builder.appName(app)
    if master:
        b = (b.master(master).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RUNTIME_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only on a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="tablestream-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for tables and stream checkpoints."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the plan restarts from files that survive the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
