"""The fused plan against separate scans, and invariants of the feature table."""

import dataclasses

from pyspark.sql import functions as F

from custvalue.operators import clean, features, featurize, split
from custvalue.plans import catalog
from custvalue.sources import schemas

FOLDER = "/root/testdata/sf0.001"

SEPARATE_SCANS = """
WITH numbered AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date) AS nth FROM cleaned),
before AS (
  SELECT customer_id, CAST(sum(order_value) AS DOUBLE) AS spent, count(*) AS days,
         coalesce(CAST(sum(order_value) FILTER (WHERE nth > 1) AS DOUBLE)
                  / nullif(count(*) - 1, 0), 0D) AS per_repeat
  FROM numbered WHERE order_date <= DATE '2000-06-30' GROUP BY customer_id)
SELECT customer_id, spent, per_repeat, days, CAST(sum(order_value) AS DOUBLE) AS total
FROM before JOIN cleaned USING (customer_id)
WHERE spent > 0 AND spent <= 25000 AND per_repeat > 0
GROUP BY ALL
"""


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fused_plan_equals_separate_scans(spark):
    cleaned = catalog.clean_orders(spark, FOLDER)
    cleaned.withColumn("order_value", F.col("order_value").cast("decimal(18,2)")).createOrReplaceTempView(
        "cleaned"
    )
    fused = features.features_n_target(cleaned, catalog.PARAMS).select(
        "customer_id", "monetary_dnn", "monetary_btyd", "frequency_dnn", "target_monetary"
    )
    assert rows(fused) == rows(spark.sql(SEPARATE_SCANS))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Exchange SinglePartition")


def test_exchanges(spark):
    """One exchange for the day rollup, one for everything by customer."""
    source = catalog._lines(spark, FOLDER)
    cleaned = clean.clean_orders(source, catalog.PARAMS)
    assert exchanges(cleaned) == (2, 0)
    assert exchanges(features.features_n_target(cleaned, catalog.PARAMS)) == (2, 0)


def test_scan_reads_only_what_the_features_need(spark):
    plan = catalog.features_n_target(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert not any(name in plan for name in ("l_discount", "l_tax", "l_shipdate", "o_totalprice", "p_name"))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_stored_orders_need_one_exchange(spark, params, tmp_path):
    """From a stored order table everything by customer is one partial aggregation."""
    catalog.clean_orders(spark, FOLDER).write.parquet(str(tmp_path / "cleaned"))
    stored = spark.read.parquet(str(tmp_path / "cleaned"))
    rows = features.features_n_target(stored, params)
    assert exchanges(rows) == (1, 0)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "ObjectHashAggregate" not in plan


def test_skewed_order_is_split(spark):
    """With one order holding a third of the lines, adaptive execution splits its partition."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in names}
    lines = spark.range(0, 600_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id")).alias("k"), F.rand(1).alias("value")
    )
    orders = spark.range(600_000).withColumn("customer", F.col("id") % 1000)
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        joined = lines.join(orders, F.col("k") == F.col("id"))
        summed = joined.groupBy("customer").agg(
            F.count("value").alias("q"), F.sum("value").alias("v")
        )
        assert sum(r.q for r in summed.collect()) == 600_000
        assert "skew=true" in summed._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_input_order_does_not_matter(spark):
    source = catalog._lines(spark, FOLDER)
    mixed = source.repartition(5).orderBy(F.rand(3))
    make = lambda s: features.features_n_target(
        clean.clean_orders(s, catalog.PARAMS), catalog.PARAMS
    )
    assert rows(make(source)) == rows(make(mixed))


def test_hot_customer_and_hot_day(spark):
    """A customer with most of the rows, all on few days, changes nothing for others."""
    source = catalog._lines(spark, FOLDER)
    hot = spark.range(20000).select(
        F.lit(1).cast("bigint").alias("Quantity"),
        F.when(F.col("id") % 2 == 0, "01/05/00 10:00").otherwise("07/20/01 10:00").alias("InvoiceDate"),
        F.lit(0.01).alias("UnitPrice"),
        F.lit("hot").alias("CustomerID"),
    )
    daily = clean.daily_orders(source.unionByName(hot), catalog.PARAMS)
    assert [r.order_value for r in daily.where("customer_id = 'hot'").collect()] == [100.0, 100.0]
    others = daily.where("customer_id <> 'hot'")
    assert rows(others) == rows(clean.daily_orders(source, catalog.PARAMS))


def test_splits_are_disjoint_and_whole(feature_rows, params):
    labelled = split.with_split(feature_rows, params)
    counts = {r.split: r["count"] for r in labelled.groupBy("split").count().collect()}
    assert counts == {"train": 287, "eval": 68, "test": 60}
    parts = [split.split_rows(feature_rows, params, s) for s in ("train", "eval", "test")]
    for i, one in enumerate(parts):
        for other in parts[i + 1 :]:
            assert one.intersect(other).count() == 0
    assert parts[0].unionByName(parts[1]).unionByName(parts[2]).count() == feature_rows.count()


def test_bucket_between_eval_and_test_is_in_no_split(feature_rows, params):
    every = feature_rows.select("customer_id")
    bucket = split.with_bucket(every, params).first()
    edge = dataclasses.replace(params, train_hi=bucket.bucket - 1, eval_hi=bucket.bucket)
    label = split.with_split(every, edge).where(F.col("customer_id") == bucket.customer_id).first()
    assert label.split == "none"


def test_shuffle_is_reproducible(feature_rows):
    one = [r.customer_id for r in split.shuffled(feature_rows, 1).collect()]
    two = [r.customer_id for r in split.shuffled(feature_rows.repartition(3), 1).collect()]
    other = [r.customer_id for r in split.shuffled(feature_rows, 2).collect()]
    assert one == two and one != other and sorted(one) == sorted(other)


def test_input_columns_are_the_used_ones(feature_rows):
    assert featurize.input_columns(feature_rows) == schemas.used_columns()


def test_cross_sizes():
    keys = [featurize.CrossKey("recency", 300), featurize.CrossKey("T", 400)]
    assert featurize.cross_size(keys) == 10000
    assert featurize.cross_dimension(keys) == int(120000**0.25)


def test_out_of_vocabulary_and_missing_keys(spark):
    df = spark.createDataFrame([("a", -1, 5), ("b", 1, 50)], "customer_id string, has_returned int, recency int")
    hot = featurize.one_hot("has_returned", (0, 1))
    got = df.withColumns(hot).orderBy("customer_id").collect()
    assert [(r.has_returned_0, r.has_returned_1) for r in got] == [(0, 0), (0, 1)]
    keys = [featurize.CrossKey("recency", 10), featurize.CrossKey("has_returned", 2)]
    crossed = {r.customer_id: r.x for r in featurize.crossed(df, keys, "x").collect()}
    assert crossed["b"] is None and 0 <= crossed["a"] < 20
