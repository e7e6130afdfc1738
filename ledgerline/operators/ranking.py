"""Global position and prefix scans without a single-task window.

``row_number().over(Window.orderBy(...))`` with no partition moves every row into one
task. Here the order is a distributed range sort (Spark samples the keys and picks the
range bounds, so a hot value of the first key is still split by the next key). Each row is
tagged with its sorted partition and its tick inside the partition, the tagged rows are
materialised once (so a recompute cannot renumber them), and the global position is the
partition's offset, from a table with one row per partition, plus the tick.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

Materialize = Callable[[DataFrame], DataFrame]

def checkpoint_materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def tag_sorted(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range-sort the rows and add ``_part`` (sorted partition) and ``_tick`` (rising
    inside the partition, in sort order). The order must be total (end with a key)."""
    return df.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_tick"),
    )


def partition_offsets(tagged: DataFrame) -> DataFrame:
    """One row per non-empty sorted partition: rows before it, and its first tick.

    The table has at most as many rows as the sort has partitions (bounded by
    ``spark.sql.shuffle.partitions``).
    """
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_tick").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_part", "_first", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def apply_offsets(tagged: DataFrame, offsets: DataFrame, name: str = "position") -> DataFrame:
    """Position from 1 for each tagged row; drops the tag columns.

    The offset table has one row per sorted partition; Spark broadcasts it by its size.
    """
    pos = F.col("_offset") + (F.col("_tick") - F.col("_first")) + 1
    small = offsets.select("_part", "_first", "_offset")
    return (
        tagged.join(small, "_part")
        .withColumn(name, pos.cast("long"))
        .drop("_part", "_tick", "_first", "_offset")
    )


def global_position(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "position",
    materialize: Materialize | None = None,
) -> DataFrame:
    """``row_number() over (order by ...)``, computed without a one-task window."""
    tagged = (materialize or checkpoint_materialize)(tag_sorted(df, order))
    return apply_offsets(tagged, partition_offsets(tagged), name)


def chunk_of(position: Column, chunk_size: int) -> Column:
    """Chunk index from 0 for a 1-based position; the last chunk may be short."""
    zero_based = (position - 1).cast("decimal(20,0)")  # exact; a double is exact only below 2**53
    return F.floor(zero_based / F.lit(chunk_size).cast("decimal(20,0)")).cast("int")


def running_max(
    df: DataFrame,
    order_col: str,
    value_col: str,
    out_col: str,
    block: int = 65536,
    initial: Column | None = None,
) -> DataFrame:
    """Running max of ``value_col`` in ``order_col`` order (W3), in two levels.

    ``order_col`` is a dense integer index (a chunk index). Rows are grouped in blocks of
    ``block`` indexes; the block maxima (one row per block, so rows / block rows) are
    scanned in one small window and joined back (Spark broadcasts it by its measured
    size); inside a block the window is partitioned by block, so no task holds more than
    ``block`` rows.
    """
    blk = F.floor(F.col(order_col) / F.lit(block)).cast("long")
    with_blk = df.withColumn("_blk", blk)
    per_block = with_blk.groupBy("_blk").agg(F.max(value_col).alias("_bmax"))
    prior = per_block.select(
        "_blk", F.max("_bmax").over(Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)).alias("_prior")
    )
    inside = Window.partitionBy("_blk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    running = F.greatest(F.max(value_col).over(inside), F.col("_prior"))
    if initial is not None:
        running = F.greatest(running, initial)
    return (
        with_blk.join(prior, "_blk")
        .withColumn(out_col, running)
        .drop("_blk", "_prior")
    )
