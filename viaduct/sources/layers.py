"""Layers that serving reads: folders by a column that filters name, and buckets by a key that is looked up.

A layer by folders is dealt by Spark's rebalancing on that column, which splits large values over tasks and puts small ones
together, so no country is one task. A layer by buckets has all rows of a key in one file, sorted, so a look-up reads one
bucket and in it the row groups that can hold the key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import cleaned_up, shared_dir

#: Rows of a file, and of a bucket.
FILE_ROWS, BUCKET_ROWS = 5_000_000, 1_000_000


def write_by(df: DataFrame, path: str, column: str, rows_per_file: int = FILE_ROWS) -> None:
    """One folder for each value of the column; nulls have a folder too."""
    with cleaned_up(df.sparkSession):
        df.hint("rebalance", F.col(column)).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(column).parquet(path)


def by_folders(df: DataFrame, name: str, column: str) -> DataFrame:
    """df written in folders by a column, and read back with its columns in their order."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write_by(df, path, column)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def by_buckets(df: DataFrame, name: str, key: str, order: list[str], rows: int, rows_per_bucket: int = BUCKET_ROWS) -> DataFrame:
    """df as a table in buckets of a key, sorted by key and order; its files lie in the shared folder. rows: its size."""
    spark = df.sparkSession
    buckets = max(8, -(-rows // rows_per_bucket))
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *order)
    with cleaned_up(spark):
        dealt.option("path", f"{shared_dir(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


# ---- a table that is replaced by source


class SourceTable:
    """A table of rows by source, of which each batch replaces the sources that it has.

    rows/source=..: rows with a source. A batch overwrites its sources' folders and no other ones (dynamic partition
    overwrite), and Spark moves files there only when the whole batch is written. unsourced/batch=..: rows without a source,
    which replace nothing; they lie in a folder of their batch. A batch that was lost at any point is run again under its
    name and leaves the same table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        """schema: of all columns; one is named source."""
        self.spark, self.path, self.schema = spark, path, schema
        self.columns = spark.createDataFrame([], schema).columns

    def _part(self, name: str, key: str) -> DataFrame:
        where = f"{self.path}/{name}"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], self.schema)
        schema = self.schema if key == "source" else f"{self.schema}, {key} string"
        return self.spark.read.schema(schema).parquet(where).select(*self.columns)

    def rows(self) -> DataFrame:
        return self._part("rows", "source").unionByName(self._part("unsourced", "batch"))

    def upsert(self, new: DataFrame, batch: str) -> int:
        """Replace the sources of a batch and return its number of rows. A batch without any source changes nothing."""
        new = new.select(*self.columns)
        named, rows = new.agg(F.count("source"), F.count(F.lit(1))).first()
        if not named:
            return 0
        write = lambda df, column, name: df.hint("rebalance", F.col(column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(f"{self.path}/{name}")
        if rows > named:
            write(new.where("source is null").withColumn("batch", F.lit(batch)), "batch", "unsourced")
        write(new.where("source is not null"), "source", "rows")
        return rows
