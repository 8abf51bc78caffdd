"""Numbering of rows in an order, ranking of linked lists, and prefix sums, none of them in one task."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import settle

#: One in so many items ends a sublist of a list that is ranked.
RULER = 32
#: A list of at most so many items is walked from end to end.
WALKED = 50_000
#: Neighbouring places whose sum is taken together.
BLOCK = 65_536

#: Bits of a row number within its partition, in monotonically_increasing_id.
_WITHIN = 33


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Add ``number``, from 0 without gaps in the given order, and ``block``, its range of rows.

    Rows are dealt over tasks by ranges of the order and counted there; the counts of the ranges
    (one row each) say where each starts.
    """
    placed = settle(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("number", F.monotonically_increasing_id()),
        "numbered",
    )
    block = F.shiftright("number", _WITHIN)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(block.alias("block"))
        .agg(F.count("*").alias("size"))
        .select("block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    within = F.col("number").bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return (
        placed.withColumn("block", block)
        .join(F.broadcast(starts), "block")  # a row for each shuffle partition
        .withColumn("number", F.col("start") + within)
        .drop("start")
    )


def _walk(frame: pd.DataFrame) -> pd.DataFrame:
    """Distance to the end of every item of a short list, or of several."""
    after = dict(zip(frame["item"].tolist(), zip(frame["next"], frame["steps"].tolist())))
    ranks: dict[int, int] = {}
    for item in after:
        path = []
        while item not in ranks:
            onward, steps = after[item]
            path.append((item, steps))
            if onward is None:
                break
            item = onward
        rank = ranks.get(item, 0) if path and path[-1][0] != item else 0
        for passed, steps in reversed(path):
            rank += steps
            ranks[passed] = rank
    return pd.DataFrame({"item": list(ranks), "rank": list(ranks.values())})


def _rank(links: DataFrame, level: int, ruler: int, walked: int) -> DataFrame:
    links = settle(links, "links")
    if links.count() <= walked:
        # Text, as pandas has no whole numbers beside nulls.
        plain = links.select("item", F.col("next").cast("string").alias("next"), "steps")

        def walk(frame: pd.DataFrame) -> pd.DataFrame:
            onward = [None if n is None else int(n) for n in frame["next"]]
            return _walk(frame.assign(next=pd.Series(onward, dtype=object, index=frame.index)))

        return plain.groupBy(F.lit("all")).applyInPandas(walk, "item long, rank long")

    def ends(item: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(level), item), F.lit(ruler)) == 0

    still = F.col("next").isNotNull() & ~ends("next")
    current = links
    while not (moving := current.where(still)).isEmpty():
        onward = current.select(
            F.col("item").alias("next"), F.col("next").alias("onward"), F.col("steps").alias("more")
        )
        moved = moving.join(onward, "next").select(
            "item", F.col("onward").alias("next"), (F.col("steps") + F.col("more")).alias("steps")
        )
        current = settle(current.where(~still).unionByName(moved), "links")
    rulers = _rank(current.where(ends("item")), level + 1, ruler, walked)
    rulers = settle(rulers.select(F.col("item").alias("next"), "rank"), "rulers")
    return current.join(rulers, "next", "left").select(
        "item", (F.col("steps") + F.coalesce("rank", F.lit(0))).alias("rank")
    )


def list_rank(links: DataFrame, ruler: int = RULER, walked: int = WALKED) -> DataFrame:
    """item and rank, its distance to the end, of a linked list of ``item`` and ``next``.

    ``next`` is null at the end. Items chosen by hash, the rulers, cut the list into short
    sublists. Pointers are doubled until every one reaches a ruler, which takes rounds by the
    logarithm of the longest sublist; the list of the rulers is ranked in the same way, until
    it is short. All rows of a round are written, so nothing is computed again.
    """
    steps = F.when(F.col("next").isNull(), 0).otherwise(1).cast("long")
    return _rank(links.select("item", "next", steps.alias("steps")), 0, ruler, walked)


def prefix_sums(rows: DataFrame, place: str, *values: str, block: int = BLOCK) -> DataFrame:
    """Replace each of ``values`` by its sum over all rows up to and with the ``place``.

    Places are distinct numbers from 0; blocks of them are summed on their own.
    """
    rows = rows.withColumn("sum_block", F.floor(F.col(place) / block))
    totals = rows.groupBy("sum_block").agg(*(F.sum(v).alias(f"{v}_before") for v in values))
    earlier = Window.orderBy("sum_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "sum_block",
        *(F.coalesce(F.sum(f"{v}_before").over(earlier), F.lit(0)).alias(f"{v}_before") for v in values),
    )
    upto = Window.partitionBy("sum_block").orderBy(place)
    return (
        rows.withColumns({v: F.sum(v).over(upto) for v in values})
        .join(totals, "sum_block")
        .withColumns({v: F.col(v) + F.col(f"{v}_before") for v in values})
        .drop("sum_block", *(f"{v}_before" for v in values))
    )
