"""Small helpers that all training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it: space and U+0009 to U+000D.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"
#: Rows of one Arrow batch are worked on in blocks of about so many characters.
BLOCK_CHARS = 2_000_000
#: Spark's setting by which the shuffle files of a query go when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


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


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts lineage and survives lost executors.

    The shuffle files of the write are deleted with it: nothing reads them once the table is there.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*settled: DataFrame) -> None:
    """Delete tables of settle() that nothing reads any more: what derives from them has been settled itself."""
    for df in settled:
        if files := df.inputFiles():
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of documents that no label may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def in_blocks(texts: list[str | None], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about limit characters; a longer text is a range of its own."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_limit(total: int) -> int:
    """Rows from which a key counts as hot: over a thousandth of all rows, so that under 1000 keys are hot."""
    return max(1, total // 1000)


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows with groups (one row for each key, settled; `size` rows of `rows` have it, `total` in all).

    Hot keys are told by their hashes, under 1000 of them, which the driver sees and both sides are filtered by; their groups
    are broadcast. All others are shuffled, without the rows of hot keys. Where no key is hot it is a plain join.
    """
    kind = rows.schema[key].dataType
    mark = F.xxhash64(F.col(key).cast(kind))
    hot = [r[0] for r in groups.where(F.col(size) > hot_limit(total)).select(mark).collect()]
    if not hot:
        return rows.join(groups, key)
    is_hot = mark.isin(hot)
    cold = rows.where(~is_hot).join(groups.where(~is_hot), key)
    return rows.where(is_hot).join(F.broadcast(groups.where(is_hot)), key).unionByName(cold)
