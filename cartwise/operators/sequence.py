"""Running sums over an ordered sequence per group, split into blocks.

A plain ``Window.partitionBy(group).orderBy(k)`` sorts each group in one
task, so one very large group (a user with a third of all orders) becomes a
straggler.  Here the ordering key is cut into blocks of ``block_size``
consecutive values: within a block the running sum is a window over
(group, block), and each block is offset by the total of the blocks before
(after) it, which is a window over one row per block.  Both windows are
bounded by ``block_size`` rows or by the number of blocks.

Frames are RANGE frames, so rows with equal ordering values are peers and
are included in each other's sums, exactly like a self-join with ``<=``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 4096


def running_sums(df: DataFrame, group_cols: list[str], order_col: str, value_col: str,
                 forward: str, backward: str, block_size: int = DEFAULT_BLOCK,
                 per_group: DataFrame | None = None) -> DataFrame:
    """Add ``forward`` = sum of ``value_col`` over rows with order <= this row
    and ``backward`` = sum over rows with order >= this row, per group.

    Null values are skipped and an empty/all-null sum is 0; rows whose order is
    null are peers that come first.  ``per_group`` (keyed
    by ``group_cols``) is left-joined onto the small block table, so its
    columns reach every row without a join at row level.
    """
    keys = list(group_cols) + ["_blk"]
    # rows without an order value form a block of their own, before all others
    block = F.coalesce(F.floor(F.col(order_col) / F.lit(block_size)).cast("long"),
                       F.lit(-(1 << 62)))
    d = df.withColumn("_blk", block)

    blocks = d.groupBy(*keys).agg(F.sum(value_col).alias("_bt"))
    wb = Window.partitionBy(*group_cols).orderBy("_blk")
    blocks = blocks.select(
        *keys,
        F.coalesce(F.sum("_bt").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_bt").over(wb.rowsBetween(1, Window.unboundedFollowing)),
                   F.lit(0)).alias("_after"),
    )
    if per_group is not None:
        blocks = blocks.join(per_group, list(group_cols), "left")

    wi = Window.partitionBy(*keys).orderBy(order_col)
    d = d.select(
        "*",
        F.sum(value_col).over(wi.rangeBetween(Window.unboundedPreceding, 0)).alias("_fw"),
        F.sum(value_col).over(wi.rangeBetween(0, Window.unboundedFollowing)).alias("_bw"),
    )
    out = d.join(blocks, keys)
    extra = [c for c in (per_group.columns if per_group is not None else [])
             if c not in group_cols]
    return out.select(
        *df.columns, *extra,
        (F.col("_before") + F.coalesce(F.col("_fw"), F.lit(0))).alias(forward),
        (F.col("_after") + F.coalesce(F.col("_bw"), F.lit(0))).alias(backward),
    )
