"""Exact distribution summaries of numeric columns."""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custvalue.functions.scratch import settle

# Values per block, and blocks per superblock, of the rank search.
BLOCK_BITS = 20
# The smallest double in normal form.
SMALLEST = 2.0**-1022


def ordered_key(value: Column) -> Column:
    """A BIGINT that grows with a double and differs for different ones.

    It is the exponent and fraction of the number, as its binary form holds them; numbers too
    small for a normal form (below 2.3e-308) count as zero.
    """
    size = F.abs(value)
    rough = F.floor(F.log2(size))
    part = size / F.pow(F.lit(2.0), rough)
    # The logarithm may round across a power of two.
    exponent = rough + F.when(part >= 2, 1).when(part < 1, -1).otherwise(0)
    fraction = ((size / F.pow(F.lit(2.0), exponent)) - 1) * 2.0**52
    key = (exponent + 1023).cast("bigint") * F.lit(1 << 52) + fraction.cast("bigint")
    return (
        F.when(size < SMALLEST, 0).when(value > 0, key + 1).otherwise(-key - 1).cast("bigint")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct values ``v`` with their row counts ``n`` and a key ``u`` in their order.

    Whole numbers are their own keys, so none is rounded; others are taken as doubles. NaN is
    no value, as NULL is none.
    """
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    value = F.col(column) if whole else F.col(column).cast("double") + 0.0
    known = value.isNotNull() if whole else value.isNotNull() & ~F.isnan(value)
    key = F.col("v").cast("bigint") if whole else ordered_key(F.col("v"))
    counts = df.where(known).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("u", key)


def _start(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Add ``start``: the number of rows before each group, within ``by``."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum("n").over(window), F.lit(0)))


def _wanted_blocks(counts: DataFrame, ranks: set[int]) -> list[tuple[int, int]]:
    """Blocks that hold the ranks, with the number of rows before each.

    At most one block per rank comes back to the driver.  A block has at most
    2**20 distinct values, a superblock at most 2**20 blocks, and there are at
    most 2**23 superblocks in a 63-bit range, so no window is unbounded.
    """
    blocks = counts.groupBy(F.shiftright("u", BLOCK_BITS).alias("block")).agg(
        F.sum("n").alias("n")
    )
    blocks = blocks.withColumn("super", F.shiftright("block", BLOCK_BITS))
    supers = _start(blocks.groupBy("super").agg(F.sum("n").alias("n")), [], "super")
    first = F.col("start") + F.col("base")
    placed = _start(blocks, ["super"], "block").join(
        supers.select("super", F.col("start").alias("base")), "super"
    )
    hit = [(first <= rank) & (first + F.col("n") > rank) for rank in ranks]
    rows = placed.where(functools.reduce(operator.or_, hit)).select("block", first.alias("first"))
    return [tuple(row) for row in rows.collect()]


def _at_rank(counts: DataFrame, fractions: list[float], total: int | None) -> DataFrame:
    """Value around position ``q * (total - 1)`` for each fraction: ``q, share, v_low, v_high``."""
    places = [q * (total - 1) for q in fractions] if total else []
    ranks = {math.floor(p) for p in places} | {math.ceil(p) for p in places}
    found = _wanted_blocks(counts, ranks) if total else []
    block = F.shiftright("u", BLOCK_BITS)
    first = F.coalesce(*[F.when(F.col("block") == b, f) for b, f in found], F.lit(0))
    near = counts.withColumn("block", block).where(F.col("block").isin([b for b, _ in found]))
    low = F.col("start") + first
    high = low + F.col("n")
    wanted = F.array(
        *[
            F.struct(
                F.lit(q).alias("q"),
                F.lit(p - math.floor(p)).alias("share"),
                F.lit(math.floor(p)).alias("lo"),
                F.lit(math.ceil(p)).alias("hi"),
            )
            for q, p in zip(fractions, places or [0.0] * len(fractions))
        ]
    )

    def holds(rank: str) -> Column:
        return (F.col(rank) >= F.col("low")) & (F.col(rank) < F.col("high"))

    return (
        _start(near, ["block"], "u")
        .select("v", low.alias("low"), high.alias("high"))
        .select("*", F.inline(wanted))
        .groupBy("q", "share")
        .agg(
            F.max(F.when(holds("lo"), F.col("v"))).cast("double").alias("v_low"),
            F.max(F.when(holds("hi"), F.col("v"))).cast("double").alias("v_high"),
        )
    )


def quantiles(df: DataFrame, column: str, fractions: list[float]) -> DataFrame:
    """Linearly interpolated quantiles as rows ``(q, value)``, exact at any size."""
    counts = settle(value_counts(df, column))
    ranks = _at_rank(counts, fractions, counts.agg(F.sum("n")).first()[0])
    return ranks.select("q", _between().alias("value"))


def _between() -> Column:
    return F.col("v_low") + (F.col("v_high") - F.col("v_low")) * F.col("share")


def describe(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, std (sample), min, quartiles and max of a column.

    The distinct values are written once, as several small aggregates read them.
    """
    counts = settle(value_counts(df, column))
    whole = isinstance(counts.schema["v"].dataType, T.IntegralType)
    # Whole numbers are added without rounding, whatever their order.
    weighted = F.col("v").cast("decimal(19,0)") * F.col("n") if whole else F.col("v") * F.col("n")
    head = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.sum(weighted).alias("total"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    ).first()
    mean = float(head.total / head.rows) if head.rows else None

    def known(value: float | None) -> Column:
        return F.lit(None if value is None else float(value)).cast("double")

    fractions = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ranks = _at_rank(counts, list(fractions.values()), head.rows)
    quartiles = ranks.select("q", _between().alias("v")).agg(
        *[F.max(F.when(F.col("q") == q, F.col("v"))).alias(name) for name, q in fractions.items()]
    )
    spread = F.sum(F.col("n") * F.pow(F.col("v") - known(mean), 2))
    return (
        counts.agg(F.sqrt(F.try_divide(spread, F.lit(head.rows - 1))).alias("std"))
        .withColumn("q", quartiles.select(F.struct(*fractions)).scalar())
        .select(
            F.lit(head.rows).cast("bigint").alias("count"),
            known(mean).alias("mean"),
            F.col("std").cast("double").alias("std"),
            known(head.low).alias("min"),
            *[F.col(f"q.{name}").alias(name) for name in fractions],
            known(head.high).alias("max"),
        )
    )


def describe_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``describe`` of several columns, one row each."""
    source = settle(df.select(*names))
    rows = [describe(source, name).select(F.lit(name).alias("column"), "*") for name in names]
    return functools.reduce(DataFrame.unionByName, rows)


#: Size parameter of a quantile sketch, and the share of the rows by which a rank may be off: the
#: bound of such sketches at that size, at 99 % confidence.
SKETCH_SIZE, RANK_ERROR = 400, 0.0085


def sketches(df: DataFrame, names: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """A row for each column from one pass over the rows: counts, sum, range and a quantile sketch.

    Rows of several frames merge by ``merge_sketches``, so they may be stored by batch. NULL and
    NaN count as unknown. The sketch is approximate, by ``RANK_ERROR``; the rest is exact.
    """
    cells = []
    for name in names:
        value = F.col(name).cast("double")
        value = F.when(~F.isnan(value), value)
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(value).alias("count"),
                (F.count(F.lit(1)) - F.count(value)).alias("unknown"),
                F.sum(value).alias("total"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def merge_sketches(parts: DataFrame) -> DataFrame:
    """Sketches of all rows from those of disjoint parts."""
    sums = [F.sum(c).alias(c) for c in ("count", "unknown", "total")]
    known = F.when(F.col("count") > 0, F.col("sketch"))
    merged = F.kll_merge_agg_double(known).alias("sketch")
    return parts.groupBy("column").agg(*sums, F.min("min").alias("min"), F.max("max").alias("max"), merged)


def describe_sketches(found: DataFrame) -> DataFrame:
    """``describe`` of sketched columns, with quartiles within ``RANK_ERROR`` and no deviation."""

    def quantile(share: float) -> Column:
        return F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))

    return found.select(
        "column",
        "count",
        F.try_divide("total", "count").alias("mean"),
        "min",
        *(quantile(q).alias(f"p{round(q * 100)}") for q in (0.25, 0.5, 0.75)),
        "max",
    )


def rank_errors(df: DataFrame, described: DataFrame) -> DataFrame:
    """How far the quartiles of ``describe_sketches`` are off, by a further pass that counts ranks.

    The rank of a repeated value is a range; a quartile within it is not off.
    """
    rows = {r["column"]: r for r in described.collect()}  # a row for each column
    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    counts = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(q).alias("quartile"),
            F.try_divide(F.count_if(F.col(name) < F.lit(row[q])), F.lit(row["count"])).alias("below"),
            F.try_divide(F.count_if(F.col(name) <= F.lit(row[q])), F.lit(row["count"])).alias("upto"),
        )
        for name, row in rows.items()
        for q in shares
        if row["count"]
    ]
    if not counts:
        return described.sparkSession.createDataFrame([], "column string, quartile string, error double")
    share = F.element_at(F.create_map(*(F.lit(x) for pair in shares.items() for x in pair)), F.col("quartile"))
    ranks = df.agg(F.array(*counts).alias("ranks")).select(F.inline("ranks"))
    off = F.greatest(F.lit(0.0), F.col("below") - share, share - F.col("upto"))
    return ranks.select("column", "quartile", off.alias("error"))


def limited(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies within the limits of a plot, both ends included."""
    return df.where(F.col(column).between(low, high))


def histogram(df: DataFrame, column: str, low: float, high: float, width: float) -> DataFrame:
    """Rows per fixed-width bin of the values within ``[low, high]``."""
    bin_no = F.floor((F.col(column) - low) / width).cast("bigint")
    return (
        limited(df, column, low, high)
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.lit(float(low)) + F.col("bin") * width).alias("bin_start"), "n")
    )


def density(
    df: DataFrame, column: str, low: float, high: float, width: float, points: int
) -> DataFrame:
    """Gaussian kernel density at ``points`` evenly spaced places of ``[low, high]``.

    Rows are first counted into bins of ``width`` (their number is bounded by the
    limits), and each bin stands at its middle.  The bandwidth is Scott's rule
    over the binned rows.
    """
    bins = histogram(df, column, low, high, width).select(
        (F.col("bin_start") + width / 2).alias("x"), "n"
    )
    n = F.sum("n")
    # The bins are few; they are written once for the three passes over them.
    bins = settle(bins)
    middle = bins.agg((F.sum(F.col("x") * F.col("n")) / n).alias("m")).first()["m"]
    apart = F.col("x") - F.lit(middle).cast("double")
    std = F.sqrt(F.sum(apart * apart * F.col("n")) / (n - 1))
    rule = bins.agg(F.struct(n.alias("rows"), (std * F.pow(n, -0.2)).alias("h"))).scalar()
    step = (high - low) / (points - 1)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    z = (F.col("point") - F.col("x")) / F.col("rule.h")
    kernel = F.exp(-0.5 * z * z) / F.sqrt(2 * F.pi())
    return (
        bins.select("x", "n", rule.alias("rule"), grid.alias("i"))
        .withColumn("point", F.lit(low) + F.col("i") * step)
        .groupBy("point")
        .agg(
            F.sum(F.col("n") * kernel / (F.col("rule.rows") * F.col("rule.h"))).alias("density")
        )
    )
