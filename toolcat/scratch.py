"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where that is unset, a cluster's tables lie in a folder of its warehouse, and a session
    on one machine gets a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and spark.sparkContext.master.startswith("local"):
        path = getattr(folder, "own", None) or tempfile.mkdtemp(prefix="toolcat-")
        folder.own = path
    return (path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/toolcat").rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as it was written: computed once, whatever comes after, and not lost with an executor."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
