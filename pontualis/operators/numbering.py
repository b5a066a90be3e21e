"""Running totals and row numbers that do not need a whole group in one task.

A plain ``row_number`` sorts each group in a single task, which fails as soon
as one group holds a large part of the data.  Here every group is cut into
cells along its sort order.  Totals per cell are pre-aggregated before the
shuffle and accumulated over the few cells of a group; inside a cell the
ordinary window runs.  The sum of both is the running total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_total_before(frame: DataFrame, keys: Sequence[str], cell: Column,
                         order: Sequence[Column | str], weight: Column,
                         name: str) -> DataFrame:
    """Add the total ``weight`` of the rows that precede each row of its group.

    ``cell`` must not decrease along ``order`` inside a group, and the number of
    cells per group must be bounded.  Keys may be NULL: the cell key is a
    struct, and structs compare NULL fields as equal.
    """
    marked = frame.withColumn("_cell", F.struct(*keys, cell.alias("_slot")))
    totals = marked.groupBy("_cell").agg(F.sum(weight).alias("_total"))
    group = Window.partitionBy(*[F.col(f"_cell.{k}") for k in keys]).orderBy("_cell._slot")
    offsets = totals.select(
        "_cell", F.coalesce(F.sum("_total").over(_before(group)), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_cell").orderBy(*order)
    return (marked
            .withColumn("_inside", F.coalesce(F.sum(weight).over(_before(inside)), F.lit(0)))
            .join(offsets, "_cell")
            .withColumn(name, F.col("_offset") + F.col("_inside"))
            .drop("_cell", "_offset", "_inside"))


def number_rows(frame: DataFrame, keys: Sequence[str], cell: Column,
                order: Sequence[Column | str], name: str) -> DataFrame:
    """Row numbers from 1 along ``order`` inside each group of ``keys``."""
    one = F.lit(1).cast("bigint")
    return (running_total_before(frame, keys, cell, order, one, name)
            .withColumn(name, F.col(name) + 1))
