"""Exact dedup against a persistent digest index.

The index is a table, bucketed and sorted by the SHA-256 of the normalised text, with one row for each text ever seen.
A batch of documents is reduced to digests, grouped, and held against the index by a sort-merge anti-join; what is new is
appended once the batch's result is written. Each row of the index has the id of its batch, and a batch never meets its
own rows, so a batch that is run again after a failure gives the same answer and appends nothing twice. Only digests are
shuffled for the decision.

Defined results: a null text counts as the empty text; runs of white space count as one space. A doc_id may be null: it
stays only if its text has no row with an id. Every row counts and gets a row of dedup(), rows that repeat doc_id and text
too: they are the same document and share its verdict; keep_first() leaves one row of them. Columns besides doc_id and
text are not looked at, and carried through by keep_first(). An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS_CLASS, discard, n_partitions, settle, shared_dir, spread_join

#: What a table of several batches is dealt into where no other division is given.
BATCHES = 2


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WS_CLASS}+", " ")


def digest_of(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """The persistent index. name: a table of the session's catalog; path: where its files lie, by default a folder of that
    name in the shared folder, which all machines see."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, path: str | None = None) -> None:
        self.spark, self.name, self.path = spark, name, path or f"{shared_dir(spark)}/{name}"
        self.buckets = buckets or n_partitions(spark)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        """digest, keep_id, batch."""
        return self.spark.table(self.name)

    def before(self, batch: str) -> DataFrame:
        """digest and keep_id of all other batches."""
        if not self.exists():
            return self.spark.createDataFrame([], "digest string, keep_id long")
        return self.rows().where(F.col("batch") != batch).select("digest", "keep_id")

    def append(self, new: DataFrame, batch: str) -> None:
        """new: digest, keep_id. One file for each bucket and batch; nothing if the batch is there already."""
        if self.exists() and not self.rows().where(F.col("batch") == batch).isEmpty():
            return
        (
            new.select("digest", "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def compact(self) -> DigestIndex:
        """A copy with one sorted file a bucket, for after many batches; returns the new index."""
        other = DigestIndex(self.spark, f"{self.name}_{uuid.uuid4().hex[:8]}", self.buckets)
        other.append(self.rows(), "compacted")
        return other

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def unseen(self, groups: DataFrame, batch: str) -> DataFrame:
        """The groups whose digest other batches lack, by a sort-merge anti-join."""
        return groups.join(self.before(batch).hint("merge"), "digest", "left_anti")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and digest of each row."""
    return docs.select("doc_id", digest_of(F.col("text")).alias("digest"))


def decided(rows: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """rows: doc_id, digest. Returns digest, keep_id, group_size, fresh, one row for each text of the batch.

    keep_id: the smallest doc_id of the batch's rows with this text, or the id that another batch of the index holds.
    """
    # Partial sums on the map side: a text of any number of copies is a few rows in the exchange.
    groups = settle(rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    fresh = index.unseen(groups, batch).withColumn("fresh", F.lit(True))
    known = groups.drop("keep_id").join(index.before(batch).hint("merge"), "digest").select("digest", "keep_id", "group_size", F.lit(False).alias("fresh"))
    out = settle(fresh.unionByName(known), "decided")
    discard(groups)
    return out


def with_verdicts(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    total = verdicts.agg(F.sum("group_size")).first()[0] or 0
    out = spread_join(rows, verdicts, "digest", "group_size", total)
    kept = F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


def dedup(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Decide every row of a batch; then append its new texts to the index.

    Returns doc_id, keep_id, group_size (rows of this batch), kept, text_sha256. kept: whether the document is the one
    that stays. Give `batch` to be able to run the batch again.
    """
    batch = batch or uuid.uuid4().hex
    rows = settle(digests(docs), "digests")
    verdicts = decided(rows, index, batch)
    out = settle(with_verdicts(rows, verdicts), "verdicts")
    index.append(verdicts.where("fresh"), batch)
    discard(rows, verdicts)
    return out


def in_batches(rows: DataFrame, index: DigestIndex, batches: int) -> DataFrame:
    """The verdicts (see decided) over a whole table, taken into the index in ranges of doc_id of about equal number.

    The ranges are taken in order, so the document that the index holds is the one of the smallest id. A null id comes
    last. A digest of several ranges is counted over all of them.
    """
    cuts = rows.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000).alias("cuts")).first()["cuts"] or []
    edges = [None, *sorted(set(cuts)), None]
    each = []
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("doc_id").isNull() | (F.col("doc_id") >= low))
        if high is not None:
            inside = inside & (F.col("doc_id") < high)
        each.append(decided(rows.where(inside), index, f"range-{k}"))
        index.append(each[-1].where("fresh"), f"range-{k}")
    every = each[0]
    for more in each[1:]:
        every = every.unionByName(more)
    out = settle(every.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.max("fresh").alias("fresh")), "verdicts")
    discard(*each)
    return out


def dedup_table(docs: DataFrame, index: DigestIndex, batches: int = BATCHES) -> DataFrame:
    """Like dedup(), for a whole table that a new index takes in several batches; group_size counts the rows of all."""
    rows = settle(digests(docs), "digests")
    return with_verdicts(rows, in_batches(rows, index, batches))


def keep_first(docs: DataFrame, index: DigestIndex, batches: int = BATCHES) -> DataFrame:
    """The documents that stay, with all their columns; a new index learns their digests, in several batches.

    Texts are shuffled once, by digest. Of rows that repeat doc_id and text, which are few, one stays.
    """
    rows = settle(digests(docs), "digests")
    verdicts = in_batches(rows, index, batches)
    counted = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("twins"))
    same = lambda a, b: (a["digest"] == b["digest"]) & a["doc_id"].eqNullSafe(b["keep_id"])
    fresh = verdicts.where("fresh").select("digest", "keep_id")
    first = settle(counted.join(fresh, same(counted, fresh)).select(fresh["digest"], "keep_id", "twins"), "kept")
    discard(rows, verdicts)
    # Copies of one text differ in doc_id, so they spread over the shuffle and find nothing.
    tagged = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", digest_of(F.col("text")).alias("digest"))
    stay = tagged.join(first, same(tagged, first)).select("doc", first["digest"], "twins")
    once = stay.where("twins = 1").select("doc")
    several = stay.where("twins > 1").dropDuplicates(["digest"]).select("doc")
    return once.unionByName(several).select("doc.*")


def fresh_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, f"viaduct_digests_{uuid.uuid4().hex}")
