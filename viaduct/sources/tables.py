"""Tables that several steps read: written once to the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares: spark.checkpoint.dir. A temporary one only where none is set and Spark runs in one
    process, as in tests; on a cluster other machines would not see it."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


#: Spark's setting by which the shuffle files of a query go when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Around a write: its shuffle files go with it, as nothing reads them once the table is there."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def settled(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet and read back: cuts the plan and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with cleaned_up(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
