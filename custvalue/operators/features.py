"""Cleaned daily orders to recency / frequency / monetary features and target.

Input has one row per customer and day, as ``clean_orders`` makes it; a row
count is therefore a count of distinct days.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.functions.numeric import from_cents, round_half_away, to_cents
from custvalue.params import ClvParams
from custvalue.sources import schemas


def first_order(cleaned: DataFrame) -> DataFrame:
    """First order day per customer."""
    return cleaned.groupBy("customer_id").agg(F.min("order_date").alias("order_date_min"))


def first_order_zeroed(cleaned: DataFrame) -> DataFrame:
    """All rows, with the order value of each customer's first day set to zero."""
    first = F.min("order_date").over(Window.partitionBy("customer_id"))
    value = F.when(F.col("order_date") == first, 0.0).otherwise(F.col("order_value"))
    return cleaned.withColumn("order_value_btyd", value)


def in_feature_window(params: ClvParams) -> Column:
    return F.col("order_date") <= F.lit(params.threshold_date)


def target(cleaned: DataFrame, params: ClvParams) -> DataFrame:
    """Money per customer over the whole period (or after the threshold only)."""
    if params.target_window == "after":
        cleaned = cleaned.where(~in_feature_window(params))
    return cleaned.groupBy("customer_id").agg(
        from_cents(F.sum(to_cents(F.col("order_value")))).alias("target_monetary")
    )


def _per_customer(cleaned: DataFrame, params: ClvParams) -> DataFrame:
    """Every per-customer aggregate in one pass and one exchange.

    The value of the first day is taken off the sum with ``min_by``, which
    replaces the join of each row to its customer's first day.
    """
    inside = in_feature_window(params)
    cents = to_cents(F.col("order_value"))
    day = F.when(inside, F.col("order_date"))
    wanted = ~inside if params.target_window == "after" else F.lit(True)
    return (
        cleaned.groupBy("customer_id")
        .agg(
            F.count(day).alias("cnt_orders"),
            F.sum(F.when(inside, cents)).alias("cents"),
            F.min_by(F.when(inside, cents), day).alias("first_cents"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            F.sum(F.when(inside, F.col("order_qty_articles"))).alias("articles"),
            F.count_if(inside & (F.col("order_value") < 1)).alias("cnt_returns"),
            F.sum(F.when(wanted, cents)).alias("target_cents"),
        )
        # Only customers with both features and a target, as the inner join of the two gives.
        .where((F.col("cnt_orders") > 0) & F.col("target_cents").isNotNull())
    )


def _rfm_columns(params: ClvParams) -> dict[str, Column]:
    orders = F.col("cnt_orders")
    repeat_money = from_cents(F.col("cents") - F.col("first_cents"))
    return {
        "customer_id": F.col("customer_id"),
        "monetary_dnn": from_cents(F.col("cents")),
        "monetary_btyd": F.when(orders == 1, 0.0).otherwise(repeat_money / (orders - 1)),
        "recency": F.datediff("last_day", "first_day").cast("bigint"),
        "T": F.datediff(F.lit(params.threshold_date), "first_day").cast("bigint"),
        "cnt_orders": orders,
        "avg_basket_size": F.col("articles") / orders,
        "avg_basket_value": from_cents(F.col("cents")) / orders,
        "cnt_returns": F.col("cnt_returns"),
    }


def features_rfm(cleaned: DataFrame, params: ClvParams) -> DataFrame:
    """Features from days up to and including the threshold, before rounding and filters."""
    columns = _rfm_columns(params)
    whole = dataclasses.replace(params, target_window="all")  # the target plays no part here
    return _per_customer(cleaned, whole).select(*[c.alias(n) for n, c in columns.items()])


def clip(value: Column, bound: float, otherwise: Column | None = None) -> Column:
    """``bound`` where the value is above it; NULL stays NULL."""
    return F.when(value > bound, F.lit(bound)).otherwise(value if otherwise is None else otherwise)


def features_n_target(cleaned: DataFrame, params: ClvParams) -> DataFrame:
    """The sixteen feature and target columns of customers within the monetary bounds."""
    rfm = _rfm_columns(params)
    money = from_cents(F.col("target_cents"))
    base = _per_customer(cleaned, params).select(
        *[c.alias(n) for n, c in rfm.items()], money.alias("target_monetary")
    )
    kept = base.where(
        (F.col("monetary_dnn") > 0)
        & (F.col("monetary_dnn") <= params.max_monetary)
        & (F.col("monetary_btyd") > 0)
    )
    orders = F.col("cnt_orders")
    repeats = orders - 1
    return kept.withColumns(
        {
            "frequency_dnn": orders,
            "frequency_btyd": repeats,
            "time_between": round_half_away(F.col("recency") / orders),
            "avg_basket_value": round_half_away(F.col("avg_basket_value")),
            "avg_basket_size": round_half_away(F.col("avg_basket_size")),
            "has_returned": F.when(F.col("cnt_returns") > 0, 1).otherwise(0),
            "frequency_btyd_clipped": clip(repeats, params.freq_clip).cast("bigint"),
            "monetary_btyd_clipped": clip(
                F.col("monetary_btyd"), params.money_clip, round_half_away(F.col("monetary_btyd"))
            ),
            "target_monetary_clipped": clip(F.col("target_monetary"), params.money_clip),
        }
    ).select(*schemas.FEATURES.fieldNames())
