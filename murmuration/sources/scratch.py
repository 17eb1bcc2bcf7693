"""Shared scratch tables that cut lineage and survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would not be visible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="murmuration-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


class Scratch:
    """A private folder below the shared root, holding the tables of one run."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/murmuration/{label}-{uuid.uuid4().hex}"

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and return it read back, with its lineage cut."""
        df.write.mode("overwrite").parquet(self.at(name))
        return self.get(df, name)

    def get(self, like: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.at(name))

    def drop(self) -> None:
        """Delete the whole folder, once no result still reads from it."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        folder.getFileSystem(conf).delete(folder, True)
