"""Session defaults and the shared folder that staged tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks.

    On a cluster, build the session with ``spark-submit`` settings instead: no operator in
    this package depends on anything set here.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("demandloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the cluster.

    Only a local-mode session without a setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set: name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="demandloom-"))
    return sc.getCheckpointDir()


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return it as a scan of that copy.

    Used where several branches must see the very same rows (partition numbers, model
    scores). The copy outlives lost executors, and its known size lets the planner choose
    between a broadcast and a shuffled join.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
