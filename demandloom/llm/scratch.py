"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from demandloom.session import shared_folder


class Scratch:
    """Written tables of one operator call.

    A kept table cuts the lineage: lost executors repeat the reads of it and nothing before.
    Tables that the returned plan no longer reads are dropped as soon as the next one exists.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it as a scan of what was written."""
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete kept tables, and let Spark's cleaner free the shuffle files of past jobs."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        jvm.System.gc()
