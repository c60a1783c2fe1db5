"""Cutting lineage with tables in the shared folder that the cluster names.

``spark.checkpoint.dir`` is read from the session. Where it is unset in a local session, as in tests, a new temporary
folder takes its place; on a cluster that is an error, since executors would not find what others wrote.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tomeflow.functions.filesystem import Folder

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share."""
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {_KEY} to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(_KEY, found)
    return found.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"tomeflow/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_own(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Removes the tables that this application stored. Results that haven't been written yet may still read them: release when all are."""
    Folder(spark, shared_dir(spark)).remove(_own(spark))
