"""Naive extrapolation: basket value times the order rate, carried over the target period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custvalue.functions.numeric import from_cents, to_cents
from custvalue.functions.scratch import settle
from custvalue.operators.features import in_feature_window
from custvalue.params import ClvParams


def baseline_days(cleaned: DataFrame, params: ClvParams) -> DataFrame:
    """One row: days from the first order to the threshold, and from there to the end."""
    first = F.min("order_date")
    return cleaned.agg(
        F.datediff(F.lit(params.threshold_date), first).cast("bigint").alias("feature_days"),
        F.lit(params.time_days).cast("bigint").alias("target_days"),
    )


def baseline_predictions(cleaned: DataFrame, params: ClvParams) -> DataFrame:
    """Predicted and actual money of every customer with an order up to the threshold."""
    inside = in_feature_window(params)
    cents = to_cents(F.col("order_value"))
    per_customer = cleaned.groupBy("customer_id").agg(
        F.count_if(inside).alias("cnt_orders"),
        F.sum(F.when(inside, cents)).alias("cents"),
        F.sum(cents).alias("target_cents"),
        F.min("order_date").alias("first_day"),
    )
    # The first day of all is the least first day.  The subquery is a plan of its own, so the
    # customers are written once and both read them.
    per_customer = settle(per_customer)
    first = per_customer.agg(F.min("first_day")).scalar()
    feature_days = F.datediff(F.lit(params.threshold_date), first)
    growth = 1 + F.lit(params.time_days) / feature_days
    orders = F.col("cnt_orders")
    return per_customer.where(orders > 0).select(
        "customer_id",
        (from_cents(F.col("cents")) / orders * (orders * growth)).alias("predicted_monetary"),
        from_cents(F.col("target_cents")).alias("target_monetary"),
    )
