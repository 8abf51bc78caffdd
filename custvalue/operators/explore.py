"""First looks at the raw lines and at the cleaned orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custvalue.functions.dates import parse_moment
from custvalue.functions.hashing import hash_bucket
from custvalue.functions.numeric import from_cents, price_units, to_cents

SAMPLE_KEY = ("InvoiceNo", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID")


def first_moment(source: DataFrame, bad_dates: str = "fail") -> DataFrame:
    """One row with the first and last invoice moment.

    Dates repeat over very many lines, so distinct texts are parsed, not lines.
    """
    texts = source.select("InvoiceDate").distinct()
    moment = parse_moment(F.col("InvoiceDate"), strict=bad_dates == "fail")
    return texts.agg(F.min(moment).alias("mind"), F.max(moment).alias("maxd"))


def day_number(
    source: DataFrame, dates: DataFrame | None = None, bad_dates: str = "fail"
) -> DataFrame:
    """Raw rows with the number of calendar days since the first transaction.

    ``dates`` is a frame of the same lines that reads little more than the date; the first
    day is taken from it.  With ``bad_dates="null"`` a line whose date is unreadable has none.
    """
    moments = first_moment(source if dates is None else dates, bad_dates)
    first = F.to_date(moments.select("mind").scalar())
    day = F.to_date(parse_moment(F.col("InvoiceDate"), strict=bad_dates == "fail"))
    return source.select(F.datediff(day, first).cast("bigint").alias("day_number"), "*")


def sample(source: DataFrame, one_in: int = 50) -> DataFrame:
    """One in ``one_in`` rows, by hash of the row's own values.

    A row with a NULL in one of them is never sampled.
    """
    if one_in < 2:
        raise ValueError("one_in must be 2 or more")
    price = F.col("UnitPrice")
    # A price that four decimals cannot hold stops the job here as well.
    price = F.when(price_units(price).isNotNull(), price.cast("decimal(18,4)"))
    parts = [price if c == "UnitPrice" else F.col(c) for c in SAMPLE_KEY]
    text = F.concat(*[p.cast("string") for p in parts])
    return source.where(hash_bucket(text, one_in) == 1)


def threshold_moment(source: DataFrame, days: int = 250) -> DataFrame:
    """The moment ``days`` days after the first transaction."""
    return first_moment(source).select(
        (F.col("mind") + F.make_dt_interval(F.lit(days))).alias("threshold_moment")
    )


def share_before(source: DataFrame, days: int = 250) -> DataFrame:
    """Share of order lines before day number ``days``."""
    before = F.when(F.col("day_number") < days, 1.0).otherwise(0.0)
    return day_number(source).agg(F.avg(before).alias("share_before"))


def frequency(cleaned: DataFrame) -> DataFrame:
    """Repeat transactions: order days less one (input has one row per customer and day)."""
    return cleaned.groupBy("customer_id").agg(
        (F.count("order_date") - 1).alias("num_transactions")
    )


def recency(cleaned: DataFrame) -> DataFrame:
    """Days from first to last order."""
    span = F.datediff(F.max("order_date"), F.min("order_date"))
    return cleaned.groupBy("customer_id").agg(span.cast("bigint").alias("recency"))


def monetary(cleaned: DataFrame) -> DataFrame:
    """Money spent."""
    return cleaned.groupBy("customer_id").agg(
        from_cents(F.sum(to_cents(F.col("order_value")))).alias("monetary")
    )


def head(df: DataFrame, rows: int = 2) -> DataFrame:
    """The first rows by customer."""
    return df.orderBy("customer_id").limit(rows)
