"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; one of our own only where it is unset and all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="emberline-"))
        folder = _own_folder[0]
    return folder.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """df written as a Parquet table in the shared folder and read back: later work starts from it,
    whatever executors are lost. The table goes when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
