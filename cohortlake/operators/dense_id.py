"""Dense 0-based row numbers and running totals without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits
BLOCK_BITS = 18  # about 260,000 rows at most are numbered together
GROUP_BITS = 11  # so many blocks, as a power of two, are added up together


def range_sorted(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows in range order with their partition ``_part`` and position ``_pos``.

    The result is checkpointed: partition borders come from a sample, so a second
    evaluation (or the loss of an executor) could cut them elsewhere.
    """
    ensure_checkpoint_dir(df.sparkSession)
    columns: list[Column] = [F.col(c) for c in order]
    ranged = (
        df.repartitionByRange(partitions, *columns)
        if partitions
        else df.repartitionByRange(*columns)
    )
    return (
        ranged.sortWithinPartitions(*columns)
        .withColumn("_mark", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mark", _ROW_BITS))
        .withColumn("_pos", F.col("_mark").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_mark")
        .checkpoint()
    )


def with_dense_id(df: DataFrame, order: list[str], name: str, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Append ``name`` = 0..n-1 in the order of ``order``.

    The last order column must be a whole number that tells the rows apart, such as the
    ingestion order; columns before it must have few values. Rows are numbered within
    blocks of that number, which no block can outgrow, and the row counts of the blocks
    before are added. The counts come from a scan of the order columns alone, and share
    the partitioning of the numbered rows, which are shuffled once and never sampled.
    """
    *outer, seq = order
    blocked = df.withColumn("_block", F.shiftright(seq, block_bits))
    keys = [*outer, "_block"]
    within = Window.partitionBy(*keys).orderBy(seq)
    blocks = blocked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = with_sums_before(blocks, keys, "_rows", "_offset").drop("_rows")
    return (
        blocked.withColumn("_row", F.row_number().over(within))
        .join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_row") - 1)
        .drop("_block", "_row", "_offset")
    )


def with_sums_before(df: DataFrame, order: list[str], size: str, name: str, group_bits: int = GROUP_BITS) -> DataFrame:
    """Append the sum of ``size`` over all rows that come before in the order of ``order``.

    In two levels: within groups of 2^``group_bits`` numbers of the last order column, and
    over the totals of the groups. 10^12 rows in blocks of 2^18 give some 4 million blocks,
    but only some 2,000 groups; no window sees more rows than a group or all totals have.
    The last order column must be a whole number, unique within the columns before it,
    which must have few values and no nulls.
    """
    *outer, seq = order
    grouped = df.withColumn("_group", F.shiftright(seq, group_bits))
    groups = [*outer, "_group"]
    inner = Window.partitionBy(*groups).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    # One row per group.
    before = Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        grouped.groupBy(*groups).agg(F.sum(size).alias("_size"))
        .select(*groups, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    return (
        grouped.withColumn("_inner", F.coalesce(F.sum(size).over(inner), F.lit(0)))
        .join(totals, groups)
        .withColumn(name, F.col("_before") + F.col("_inner"))
        .drop("_group", "_inner", "_before")
    )


def with_running_total(
    df: DataFrame, order: list[str], weight: str, name: str, partitions: int | None = None
) -> DataFrame:
    """Append the sum of ``weight`` over all rows before this one, for any sortable order."""
    placed = range_sorted(df, order, partitions)
    within = (
        Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.sum(weight).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_inner", F.coalesce(F.sum(weight).over(within), F.lit(0)))
        .join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_inner"))
        .drop("_part", "_pos", "_offset", "_inner")
    )
