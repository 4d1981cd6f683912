"""Prefix sums within groups, in the order of a uniform key, without one task for a group.

The key is uniform, so that fixed cuts of its range are even cells. Rows are summed by cell, the
cells' totals are accumulated within a group (at most MAX_CELLS rows of a group meet there), and
each cell is accumulated by itself. Neither a group's rows nor its totals are gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the uniform key.
KEY_BITS = 32
#: Rows aimed at in a cell if one group holds all rows, and the bound on cells in a group.
CELL_ROWS, MAX_CELLS = 256, 1 << 16


def cell_count(rows: int) -> int:
    return max(1, min(MAX_CELLS, -(-rows // CELL_ROWS)))


def cell_of(key: Column, cells: int) -> Column:
    """key: a long in [0, 2**KEY_BITS)."""
    return F.shiftright(key * F.lit(cells).cast("long"), KEY_BITS)


def running_sums(df: DataFrame, group: str, cell: str, order: list[str], value: str, names: tuple[str, str]) -> DataFrame:
    """df with names[0], the sum of value over the rows of its group before it, and names[1], the group's sum.

    group must not be null; order is the key and what breaks its ties, cell a function of the key
    that rises with it.
    """
    totals = df.groupBy(group, cell).agg(F.sum(value).alias("_cell_sum"))
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col(group).alias("_of_group"),
        F.col(cell).alias("_of_cell"),
        F.coalesce(F.sum("_cell_sum").over(before), F.lit(0)).alias("_cell_start"),
        F.sum("_cell_sum").over(Window.partitionBy(group)).alias(names[1]),
    )
    within = Window.partitionBy(group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_in_cell", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = rows.join(totals, (F.col(group) == F.col("_of_group")) & (F.col(cell) == F.col("_of_cell")))
    return joined.withColumn(names[0], F.col("_cell_start") + F.col("_in_cell")).drop("_of_group", "_of_cell", "_cell_start", "_in_cell")
