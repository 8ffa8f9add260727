"""Dense row positions without a single-partition window.

`row_number() over (order by ...)` with no partition key pulls every row into
one task. Instead: range-partition on (group, order) keys, number rows inside
each Spark partition, count rows per (partition, group) -- a table with one row
per partition and group, tiny next to the data -- and add the running offset of
the earlier partitions. A hot group simply spans several range partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrant.session import written


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def dense_position(df: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (),
                   name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position of each row within its group, by `order`.

    The order keys must make rows unique within a group (add a tie-break).
    One range shuffle on (group, order); inside each sorted range partition
    `monotonically_increasing_id` is (partition << 33) + row index, so the
    local index needs no window. Per (partition, group) row counts -- one row
    per partition and group -- give each group's running offset.

    Both the counts and the rows must see the same range split, so the sorted,
    numbered rows are written once to the shared folder and read by both: a
    lost executor costs nothing, and nothing stays cached.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(list(group)) + _cols(order)
    gcols = list(group)
    mid = F.monotonically_increasing_id()
    parted = written(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                       .withColumn("_mid", mid)
                       .withColumn("_pid", F.shiftright("_mid", 33))
                       .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
                       .drop("_mid"), "positions")
    stats = parted.groupBy(["_pid"] + gcols).agg(F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_first"))
    run_w = (Window.partitionBy(*gcols) if gcols else Window.partitionBy(F.lit(0))).orderBy("_pid")
    offsets = stats.withColumn("_off", F.coalesce(
        F.sum("_n").over(run_w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    if not gcols:
        offsets = F.broadcast(offsets)  # one row of three numbers per range partition
    out = parted.join(offsets, ["_pid"] + gcols)
    return (out.withColumn(name, (F.col("_off") + F.col("_loc") - F.col("_first")).cast("bigint"))
               .drop("_pid", "_loc", "_first", "_off"))


def group_position(df: DataFrame, order: Sequence[str | Column], group: Sequence[str], name: str = "pos") -> DataFrame:
    """0-based position within groups that are bounded by nature (the lines or
    segments of one recording): one shuffle on the group."""
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))


def carry_forward(df: DataFrame, group: Sequence[str], order: str, value: str,
                  name: str, block_rows: int = 1 << 20) -> DataFrame:
    """Last non-null `value` at or before each row within its group, by the
    numeric column `order`.

    `value` must be non-decreasing along `order` where it is set (a line number,
    a timestamp), so "last" equals "max". Rows are cut into blocks of
    `block_rows` consecutive order values: a running max inside each
    (group, block) -- one hash shuffle, bounded window partitions even when one
    group holds a third of the data -- plus the max of the earlier blocks of the
    group, taken from a one-row-per-block summary.
    """
    gcols = list(group)
    b = df.withColumn("_blk", F.floor(F.col(order) / block_rows))
    w = (Window.partitionBy(gcols + ["_blk"]).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, 0))
    local = b.withColumn("_local", F.max(value).over(w))
    summary = b.groupBy(gcols + ["_blk"]).agg(F.max(value).alias("_bmax"))
    run_w = Window.partitionBy(*gcols).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.withColumn("_carry", F.max("_bmax").over(run_w)).drop("_bmax")
    out = local.join(carry, gcols + ["_blk"])
    return (out.withColumn(name, F.coalesce(F.col("_local"), F.col("_carry")))
               .drop("_blk", "_local", "_carry"))
