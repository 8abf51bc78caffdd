from pyspark.sql import functions as F

from custvalue.operators import featurize, split
from custvalue.operators.order import numbered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_follow_the_order_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(9000).select((F.col("id") * 7919 % 9001).alias("a")).repartition(5)
        found = numbered(rows, "place", F.desc("a"))
        got = sorted((r["place"], r["a"]) for r in found.collect())
        assert [p for p, _ in got] == list(range(9000))
        assert [a for _, a in got] == sorted((r["a"] for r in rows.collect()), reverse=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dictionary_is_numbered_without_a_single_task(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("v"), F.floor(F.sqrt("id")).cast("string")).alias("v"))
    rows = rows.unionByName(spark.range(3).select(F.lit(None).cast("string").alias("v")))
    found = featurize.as_category(rows, "v", "place")
    assert "SinglePartition, ENSURE" not in plan(found).split("BroadcastExchange")[0]
    got = {r["v"]: r["place"] for r in found.distinct().collect()}
    counts = {r["v"]: r["count"] for r in rows.groupBy("v").count().collect()}
    order = sorted((v for v in counts if v is not None), key=lambda v: (-counts[v], v))
    assert got == {v: i for i, v in enumerate(order)} | {None: None}


def test_shuffle_is_reproducible_and_sorts_blocks_only(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("customer_id"))
    one = split.shuffled(rows, seed=4)
    assert "rangepartitioning" not in plan(one)
    order = [r["customer_id"] for r in one.collect()]
    assert order == [r["customer_id"] for r in split.shuffled(rows.repartition(7), seed=4).collect()]
    assert sorted(order, key=int) == [str(i) for i in range(3000)] != order
    assert order != [r["customer_id"] for r in split.shuffled(rows, seed=5).collect()]
    moved = [abs(int(c) - i) for i, c in enumerate(order)]
    assert sum(moved) / 3000 > 700  # a third of the rows, if at random
