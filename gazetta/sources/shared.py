"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """Writes df as Parquet to the folder of spark.checkpoint.dir and reads it again.

    What is used several times is computed once, plans stay small, and a lost executor costs no recomputation.
    Only where the session names no folder, as in tests, a local one is set.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gazetta-"))
        folder = sc.getCheckpointDir()
    path = f"{folder}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(spark: SparkSession) -> None:
    """Frees what finished plans hold on the driver, by full collections of its heaps; no work is lost."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def still_there(df: DataFrame) -> bool:
    """Whether what cut() wrote for df still stands in the folder."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df._cut_path)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path)
