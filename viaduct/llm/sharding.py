"""Shards by extendible hashing.

A document hashes to 60 bits. The directory is indexed by the leading bits: it starts as one bucket, and only a bucket
over the byte limit splits on one more bit, until every shard fits. Byte sums of fine prefixes give all levels of the
directory at once; prefixes that would split further still are summed again, deeper, for their own rows alone. Documents
that share all 60 bits (repeated rows) go to overflow pages of that bucket, filled by their running bytes.

Defined results: a null text has no bytes; a null doc_id hashes as the empty string; repeated rows share a hash and are
kept; a document over the limit is a shard, or an overflow page, of its own; which of several rows of one size is on which
page is open; an empty table gives no rows; other columns are carried through, but for those of the names that assign() adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

HASH_BITS = 60
LIMIT_BYTES = 1 << 20
#: Prefixes are summed so many bits deeper than an even split of all bytes needs.
SLACK = 6
#: Directory levels whose prefixes are looked up by broadcast.
TOP = 10
#: Overflow pages are numbered in salted parts of about so many rows.
PAGE_ROWS = 10_000
#: The columns that assign() adds.
ADDED = ("n_bytes", "depth", "shard")


def hash_of(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def prefix(h: str, depth: str) -> str:
    return f"shiftright({h}, {HASH_BITS} - {depth})"


def directory(rows: DataFrame, limit: int, above: int, deepest: int) -> DataFrame:
    """rows: h, n_bytes, of buckets that split at every depth below `above`. Returns cell (prefix of `deepest` bits), depth.

    depth is where the cell's bucket stops splitting; deepest + 1 if it must split further. A bucket's ancestors are at
    least as large as it, so depth counts the ancestors over the limit.
    """
    cells = rows.groupBy(F.expr(prefix("h", str(deepest))).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    levels = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(above), F.lit(deepest))).alias("d"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {deepest} - d)"))
    split = levels.groupBy("d", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).where((F.col("bytes") > limit) & (F.col("n") > 1)).select("d", "prefix", F.lit(1).alias("over"))
    # The few prefixes of the top levels have most cells each: at most 2 ** (TOP + 1) rows are broadcast for them.
    top = levels.where(F.col("d") <= TOP).join(F.broadcast(split.where(F.col("d") <= TOP)), ["d", "prefix"], "left")
    rest = levels.where(F.col("d") > TOP).join(split.where(F.col("d") > TOP), ["d", "prefix"], "left")
    return top.unionByName(rest).groupBy("cell").agg((above + F.count("over")).cast("int").alias("depth"))


def assign(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """docs with n_bytes, depth, shard (the bucket's bits, and a page number if it overflowed) as further columns.

    Columns of these names in docs are replaced; of any other name they stay.
    """
    return placed(docs, [c for c in docs.columns if c not in ADDED], limit)


def placed(docs: DataFrame, carried: list[str], limit: int) -> DataFrame:
    """The rows of assign() with only the carried columns of docs: what isn't carried isn't exchanged with the cells."""
    base = docs.select(
        F.struct(*carried).alias("doc"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        hash_of(F.col("doc_id")).alias("h"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = settle(base.select("h", "n_bytes"), "hashes")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    found, above, todo = None, 0, rows
    deepest = min(HASH_BITS, max(1, (total // limit).bit_length() + SLACK))
    while True:
        cells = settle(directory(todo, limit, above, deepest), "directory")
        done = cells if deepest == HASH_BITS else cells.where(F.col("depth") <= deepest)
        done = done.select(F.lit(deepest).alias("bits"), "cell", "depth")
        found = done if found is None else found.unionByName(done)
        if deepest == HASH_BITS or cells.where(F.col("depth") > deepest).isEmpty():
            break
        again = cells.where(F.col("depth") > deepest).select("cell")
        todo = settle(todo.withColumn("cell", F.expr(prefix("h", str(deepest)))).join(again, "cell", "left_semi").drop("cell"), "deeper")
        above, deepest = deepest + 1, min(HASH_BITS, deepest + 2 * SLACK)
    levels = sorted(r[0] for r in found.select("bits").distinct().collect())
    out = base
    for bits in levels:
        part = found.where(F.col("bits") == bits).select(F.col("cell").alias(f"cell_{bits}"), F.col("depth").alias(f"depth_{bits}"))
        out = out.withColumn(f"cell_{bits}", F.expr(prefix("h", str(bits)))).join(part, f"cell_{bits}", "left").drop(f"cell_{bits}")
    depth = F.coalesce(*[F.col(f"depth_{b}") for b in levels]) if levels else F.lit(0)
    out = out.withColumn("depth", F.least(depth, F.lit(HASH_BITS))).withColumn("full", depth > HASH_BITS).drop(*[f"depth_{b}" for b in levels])
    bits = F.expr(f"lpad(bin({prefix('h', 'depth')}), depth, '0')")
    out = out.withColumn("shard", F.when(F.col("depth") == 0, F.lit("")).otherwise(bits))
    if HASH_BITS in levels:
        out = overflow(out, limit)
    return out.select("doc.*", *ADDED)


def overflow(out: DataFrame, limit: int) -> DataFrame:
    """Pages for buckets that can't split: salted parts of PAGE_ROWS rows, cut where their running bytes pass a page.

    A row of over half the limit is a page of its own. For the others a page is as wide as the limit less the largest of
    them, so the row that reaches beyond its width still fits; at least half of each page but the last is filled.
    """
    rest, full = out.where(~F.col("full")), out.where(F.col("full"))
    small = F.col("n_bytes") <= limit // 2
    sizes = full.groupBy("h").agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.when(small, F.col("n_bytes"))).alias("largest"))
    salted = full.join(sizes, "h").withColumn("salt", F.expr(f"pmod(xxhash64(row), 1 + n_rows div {PAGE_ROWS})"))
    before = Window.partitionBy("h", "salt", small).orderBy("n_bytes", "row").rowsBetween(Window.unboundedPreceding, -1)
    page = F.expr(f"cast(coalesce(ahead, 0) div ({limit} + 1 - coalesce(largest, 0)) as string)")
    salted = salted.withColumn("ahead", F.sum("n_bytes").over(before))
    name = F.when(small, F.concat_ws("-", "shard", F.col("salt").cast("string"), page)).otherwise(F.concat_ws("-", "shard", "salt", F.lit("row"), "row"))
    return rest.unionByName(salted.withColumn("shard", name).drop("n_rows", "largest", "salt", "ahead"))


def shard_report(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, n_bytes, depth, shard, shard_bytes, shard_docs."""
    rows = settle(placed(docs, ["doc_id"], limit), "shards")
    sums = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return rows.join(sums, "shard").select("doc_id", "n_bytes", "depth", "shard", "shard_bytes", "shard_docs")


def write(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> None:
    """One folder for each shard, as Parquet; rows of a shard come together in one shuffle."""
    out = assign(docs, limit)
    out.repartition("shard").sortWithinPartitions("shard").write.partitionBy("shard").parquet(path)
