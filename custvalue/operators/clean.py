"""Raw order lines to cleaned daily orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.functions.dates import day_text, parse_day
from custvalue.functions.numeric import PRICE_DIGITS, from_cents, line_units, units_to_cents
from custvalue.params import ClvParams


def line_value(source: DataFrame, price_digits: int = PRICE_DIGITS) -> DataFrame:
    """Value of each order line."""
    units = line_units(F.col("UnitPrice"), F.col("Quantity"), price_digits)
    return source.select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("CustomerID").alias("customer_id"),
        F.col("Quantity").alias("quantity"),
        (units / F.lit(10.0**price_digits)).alias("line_value"),
    )


def daily_units(source: DataFrame, params: ClvParams) -> DataFrame:
    """Line values and quantities summed per customer and day.

    The first rollup groups by the date text, so a date is parsed once per group
    and not once per line, and a customer with very many lines is summed on the
    map side and then spread by day.  The second one merges differently written
    dates; it and later steps by customer share one exchange, in which a
    customer has at most one row per way of writing a day.
    """
    units = line_units(F.col("UnitPrice"), F.col("Quantity"), params.price_digits)
    by_text = (
        source.where(F.col("CustomerID").isNotNull())
        .groupBy(
            F.col("CustomerID").alias("customer_id"),
            day_text(F.col("InvoiceDate")).alias("day_text"),
        )
        .agg(
            F.sum(units).alias("units"),
            F.sum("Quantity").alias("qty"),
        )
    )
    dated = by_text.repartition("customer_id").withColumn(
        "order_date", parse_day(F.col("day_text"), strict=params.bad_dates == "fail")
    )
    if params.bad_dates == "null":
        dated = dated.where(F.col("order_date").isNotNull())
    return dated.groupBy("customer_id", "order_date").agg(
        F.sum("units").alias("units"), F.sum("qty").alias("order_qty_articles")
    )


def _as_orders(units: DataFrame, params: ClvParams) -> DataFrame:
    return units.select(
        "customer_id",
        "order_date",
        from_cents(units_to_cents(F.col("units"), params.price_digits)).alias("order_value"),
        "order_qty_articles",
    )


def daily_orders(source: DataFrame, params: ClvParams) -> DataFrame:
    """One row per customer and day: value rounded to cents, and article count."""
    return _as_orders(daily_units(source, params), params)


def latest_order(daily: DataFrame) -> DataFrame:
    """Latest order day per customer, over all days including later returns."""
    return daily.groupBy("customer_id").agg(F.max("order_date").alias("latest_order"))


def _positive_day(params: ClvParams) -> Column:
    before = F.col("order_date") < F.lit(params.threshold_date)
    return F.when(before & (F.col("units") > 0), 1).otherwise(0)


def positive_days(units: DataFrame, params: ClvParams) -> DataFrame:
    """Days of positive value strictly before the threshold, per customer seen before it."""
    return (
        units.where(F.col("order_date") < F.lit(params.threshold_date))
        .groupBy("customer_id")
        .agg(F.sum(_positive_day(params)).cast("bigint").alias("cnt_positive_value"))
    )


def repeat_customers(units: DataFrame, params: ClvParams) -> DataFrame:
    """Customers with more than one positive day before the threshold."""
    return positive_days(units, params).where(F.col("cnt_positive_value") > 1)


def is_recently_active(latest: Column, params: ClvParams) -> Column:
    """Latest order at most ``active_days`` before the end of the data (or after it)."""
    return F.datediff(F.lit(params.predict_end), latest) <= params.active_days


def recently_active(daily: DataFrame, params: ClvParams) -> DataFrame:
    """Customers who bought in the last ``active_days`` days."""
    return latest_order(daily).where(is_recently_active(F.col("latest_order"), params))


def is_sign_consistent() -> Column:
    """Quantity and value both positive, or both negative."""
    qty, value = F.col("order_qty_articles"), F.col("order_value")
    return ((qty > 0) & (value > 0)) | ((qty < 0) & (value < 0))


def sign_consistent(daily: DataFrame) -> DataFrame:
    """Days whose value and quantity have the same sign."""
    return daily.where(is_sign_consistent())


def clean_orders(source: DataFrame, params: ClvParams) -> DataFrame:
    """Daily orders of recently active repeat customers, inconsistent days removed.

    Latest order and positive days are windows over the daily rollup, which is
    already placed by customer, instead of a correlated subquery and a join.
    """
    by_customer = Window.partitionBy("customer_id")
    return (
        daily_units(source, params)
        .withColumns(
            {
                "latest_order": F.max("order_date").over(by_customer),
                "positive_days": F.sum(_positive_day(params)).over(by_customer),
            }
        )
        .where(is_recently_active(F.col("latest_order"), params))
        .where(F.col("positive_days") > 1)
        .transform(_as_orders, params)
        .where(is_sign_consistent())
    )
