"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the checkpoint folder set on the context.

    Where neither is set, a session in one process (master local[n], as in tests) sets a temporary folder of its own, which goes when it
    ends; a cluster gets an error, since no other place is known to be shared.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
    return at


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read back: what several branches of a query stand on is computed once."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
