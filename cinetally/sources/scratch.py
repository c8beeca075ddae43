"""Intermediate tables in the folder the cluster shares between its machines."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cinetally-"))
    return context.getCheckpointDir().rstrip("/")


class Scratch:
    """A fresh folder for written tables.

    A written table cuts the lineage and outlives the executors that made it.
    Frames read from it lazily, so ``release`` it only when they are done with.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/scratch-{uuid4().hex}"

    def path(self, label: str = "table") -> str:
        return f"{self.root}/{label}-{uuid4().hex[:8]}"

    def table(self, df: DataFrame, label: str = "table") -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error: object) -> None:
        self.release()
