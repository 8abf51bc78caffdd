"""Numbers of rows in an order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.functions.scratch import settle

#: Bits of a row's place within its range, in monotonically_increasing_id.
_WITHIN = 33


def numbered(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """Add ``name``, the place of each row in an order, from 0 without gaps.

    Rows are dealt over tasks by ranges of the order and counted there; each range starts after
    the rows of those before it, of which there is one count for each shuffle partition.
    """
    placed = settle(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())
    )
    part = F.shiftright(name, _WITHIN)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_range"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    within = F.col(name).bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return (
        placed.withColumn("_range", part)
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + within)
        .drop("_range", "_start")
    )
