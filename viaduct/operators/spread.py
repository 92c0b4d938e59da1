"""Joins and orders that no single task has to carry: hot keys dealt out by salt, ranks by ranges and prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settled

#: Rows of one key from which it is dealt over several tasks.
PART_ROWS = 1_000_000
_ROW_BITS = 33  # of monotonically_increasing_id() for the place in a task


def salted_left_join(rows: DataFrame, side: DataFrame, keys: list[str], sizes: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """rows left join side, which has each key once. sizes: keys and n, the number of rows that have them.

    Keys of over part_rows rows get a part for each part_rows: their rows are dealt by a hash of the whole row, their one row
    of the side is repeated for each part. There is at most one such key in part_rows rows, so their list can be broadcast.
    Rows with a null in a key match nothing and don't take part in the exchange.
    """
    known = [F.col(k).isNotNull() for k in keys]
    whole = known[0]
    for k in known[1:]:
        whole = whole & k
    hot = sizes.where(F.col("n") > part_rows).select(*keys, F.ceil(F.col("n") / part_rows).cast("int").alias("__parts"))
    left, right, on = rows.where(whole), side, keys
    if not hot.isEmpty():
        deal = F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("__parts")), F.lit(0))
        left = left.join(F.broadcast(hot), keys, "left").withColumn("__part", deal.cast("int")).drop("__parts")
        every = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
        right = side.join(F.broadcast(hot), keys, "left").withColumn("__part", every).drop("__parts")
        on = [*keys, "__part"]
    joined = left.join(right, on, "left").select(*rows.columns, *[c for c in side.columns if c not in keys])
    return joined.unionByName(rows.where(~whole), allowMissingColumns=True)


def ranked(df: DataFrame, groups: list[str], order: list[Column | str], name: str, first: int = 1) -> DataFrame:
    """df with the place of each row in its group (in the whole if there are no groups) by `order`, counted from `first`.

    Rows are dealt by ranges of group and order and sorted where they are; a row's place in its task is its number less
    that of its group's first row there, and the counts of the tasks before are added. What is counted is a row for each
    task and group that meet, never more than tasks plus groups. The sorted rows are written, so that places stay as counted.
    """
    by = [*groups, *order]
    row = F.monotonically_increasing_id().alias("__row")
    rows = settled(df.repartitionByRange(*by).sortWithinPartitions(*by).select("*", row), "ranked")
    task = F.shiftright("__row", _ROW_BITS).alias("__task")
    counts = rows.groupBy(task, *groups).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*groups).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    starts = settled(counts.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n"), "starts")
    same = (task == starts["__task"]) if not groups else None
    if groups:
        same = task == starts["__task"]
        for g in groups:
            same = same & rows[g].eqNullSafe(starts[g])
    out = rows.join(starts.select("__task", "__first", "__before", *groups) if groups else starts, same)
    place = (F.col("__row") - F.col("__first") + F.col("__before") + first).cast("long").alias(name)
    return out.select(*[rows[c] for c in df.columns], place)


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """df with numbers from 1 without gaps, by `order`, which must be total."""
    return ranked(df, [], order, name)


def first_of_groups(df: DataFrame, groups: list[str], order: list[Column | str], room: str) -> DataFrame:
    """The first `room` (a column) rows of each group by `order`."""
    return ranked(df, groups, order, "__place").where(F.col("__place") <= F.col(room)).drop("__place")
