"""Mixing sources to target weights by weighted fair queueing, in SQL functions only.

Every document gets a place in a shuffled order of its source. The virtual finish time of its
e-th copy is the number of source tokens up to its end, earlier rounds included, divided by the
source's target. All copies are ordered by finish time over all sources, and the order is cut
where the total reaches the budget, so each source ends close to its own target.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own;
rows that repeat a doc_id, null ones too, count as documents of their own and are dealt by their
texts; an empty table gives no rows. Other columns of the input are ignored. The shuffled order
depends on the seed, doc_id and text alone, so a rerun, or a recomputed task, gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import fresh, settle, text_of, word_count

#: Finish-time ranges per unit of virtual time; only one of them is ever ranked.
RANGES = 4096
#: Leading hex digits of the shuffle key that split a source into slots of its running total.
SLOT_DIGITS = 3


def cycled_weights(sources: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """Weights repeating over the sources by code point, the null source last.

    ``sources`` has one row per source; ordering it is one small task.
    """
    order = Window.orderBy("no_source", "source_text")
    place = (F.row_number().over(order) - 1) % len(cycle)
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.withColumn("rank", F.row_number().over(order)).withColumn(
        "weight", F.element_at(values, (place + 1).cast("int"))
    )


def fill_targets(sources: DataFrame, share: float, rounds: int) -> DataFrame:
    """Split ``share`` of all tokens by weight; no target above ``rounds`` times its source.

    What a full source leaves is shared again by weight. With sources ordered by cap per
    weight, the level that all others reach is the largest of (budget - caps before) /
    (weights from here on), so no loop is needed.
    """
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    return (
        sources.withColumn("cap", F.col("source_size") * F.lit(rounds))
        .withColumn("budget", F.least(total * F.lit(float(share)), total * F.lit(float(rounds))))
        .withColumn(
            "level",
            (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / F.sum("weight").over(onward),
        )
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .drop("cap", "level")
    )


def _range_of(finish: Column) -> Column:
    """Range number, growing with the finish time; logarithmic beyond twice the horizon."""
    near = F.floor(finish * RANGES)
    far = F.lit(2 * RANGES) + F.floor((F.log2(finish) - 1) * RANGES)
    return F.when(finish < 2, near).otherwise(far)


def shuffle_key(seed: str) -> Column:
    """Hexadecimal hash of doc_id and text: rows that share a doc_id lie apart unless texts are equal."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), F.md5(text_of("text"))))


def mix(
    docs: DataFrame,
    cycle: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    rounds: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """Words of each document that the mix takes: doc_id, size, source, source_size, target, taken.

    ``cycle`` are the weights by source order, ``share`` the budget as a share of all words,
    ``rounds`` how often a document may be taken. Documents are taken whole.
    """
    columns = ("doc_id", "source", "size", "source_size", "target", "taken")
    return mix_by_key(docs, cycle, share, rounds, seed).select(*columns)


def mix_by_key(
    docs: DataFrame, cycle: tuple[float, ...], share: float, rounds: int, seed: str
) -> DataFrame:
    """The same with the shuffle key of each document."""
    source = ["no_source", "source_text"]
    sizes = settle(
        docs.select(
            "doc_id",
            "source",
            F.col("source").isNull().alias("no_source"),
            text_of("source").alias("source_text"),
            word_count(text_of("text")).alias("size"),
            shuffle_key(seed).alias("key"),
        ).withColumn("slot", F.substring("key", 1, SLOT_DIGITS)),
        "mix-sizes",
    )
    slots = sizes.groupBy(*source, "slot").agg(F.sum("size").alias("slot_size"))
    sources = slots.groupBy(*source).agg(F.sum("slot_size").alias("source_size"))
    targets = fill_targets(cycled_weights(sources, cycle), share, rounds)
    earlier = Window.partitionBy(*source).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        slots.withColumn("offset", F.coalesce(F.sum("slot_size").over(earlier), F.lit(0)))
        .drop("slot_size")
        .join(targets, source)
    )
    so_far = (
        Window.partitionBy(*source, "slot")
        .orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    copies = F.transform(
        F.sequence(F.lit(0), F.lit(rounds - 1)),
        lambda e: (F.col("reached") + e * F.col("source_size")) / F.col("target"),
    )
    queue = settle(
        sizes.withColumn("within", F.sum("size").over(so_far))
        .join(slots, [*source, "slot"])
        .withColumn("reached", F.col("within") + F.col("offset"))
        .withColumn("finish", F.when((F.col("size") > 0) & (F.col("target") > 0), copies))
        .select(
            *["doc_id", "source", "size", "source_size", "target"],
            *["weight", "budget", "rank", "key", "finish"],
        ),
        "mix-queue",
    )
    place = F.struct(*(F.col(c) for c in ("time", "rank", "key", "doc_id", "size")))
    one = queue.where("finish is not null").select(
        "*", F.explode("finish").alias("time")
    ).withColumn("range", _range_of(F.col("time")))
    # Totals by finish-time range find the one range that holds the cut.
    totals = one.groupBy("range").agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
    upto = Window.orderBy("range")
    cut = (
        totals.withColumn("upto", F.sum("words").over(upto))
        .where("upto > budget")
        .orderBy("range")
        .limit(1)
        .collect()
    )
    if not cut:  # the budget holds every copy
        count = F.size("finish")
    else:
        edge = cut[0]
        left = edge["budget"] - (edge["upto"] - edge["words"])
        within = Window.orderBy(
            "time", "rank", "key", F.col("doc_id").asc_nulls_first(), "size"
        ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = (
            one.where(F.col("range") == edge["range"])
            .withColumn("running", F.sum("size").over(within))
            .where(F.col("running") <= F.lit(left))
            .agg(F.max(place).alias("last"))
            .first()["last"]
        )
        if last is None:
            count = F.size(F.filter("finish", lambda t: _range_of(t) < edge["range"]))
        else:
            bound = F.struct(
                F.lit(last["time"]),
                F.lit(last["rank"]),
                F.lit(last["key"]),
                F.lit(last["doc_id"]).cast("long"),
                F.lit(last["size"]).cast("long"),
            )
            own = [F.col(c) for c in ("rank", "key", "doc_id", "size")]
            count = F.size(F.filter("finish", lambda t: F.struct(t, *own) <= bound))
    taken = F.when(F.col("finish").isNull(), 0).otherwise(F.col("size") * count).cast("long")
    return queue.select(
        "key", "doc_id", "source", "size", "source_size", "target", taken.alias("taken")
    )


def apply_mix(
    docs: DataFrame,
    cycle: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    rounds: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """The documents of the mix, one taken twice as two rows; columns unchanged.

    Rows equal in doc_id, text and source are dealt what the mix takes of all of them, so the
    budget holds.
    """
    names = fresh(docs, "own_key", "own_source", "copies", "rows", "copy", "key", "place")
    own_key, own_source, copies, rows, copy, key, place = names
    taken = (
        mix_by_key(docs, cycle, share, rounds, seed)
        .groupBy(F.col("key").alias(own_key), F.col("source").alias(own_source))
        .agg(
            F.sum(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0)).cast("long").alias(copies),
            F.count("*").alias(rows),
        )
        .where(F.col(copies) > 0)
    )
    keyed = docs.withColumn(key, shuffle_key(seed))
    same = (keyed[key] == taken[own_key]) & keyed["source"].eqNullSafe(taken[own_source])
    found = keyed.join(taken, same)
    # Rows that nothing tells apart share their copies, the first of them the odd ones.
    among = Window.partitionBy(own_key, own_source).orderBy("text")
    several = found.where(F.col(rows) > 1).withColumn(place, F.row_number().over(among))
    odd = (F.col(place) <= F.col(copies) % F.col(rows)).cast("long")
    several = several.withColumn(copies, F.floor(F.col(copies) / F.col(rows)) + odd).drop(place)
    every = found.where(F.col(rows) == 1).unionByName(several.where(F.col(copies) > 0))
    return every.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)
