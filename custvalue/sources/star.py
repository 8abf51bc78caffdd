"""Raw order lines derived from a star schema of orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.functions.numeric import round_half_away
from custvalue.sources import schemas

ALL_COLUMNS = tuple(schemas.TRANSACTIONS.fieldNames())


def transactions_from_star(
    spark: SparkSession, folder: str, columns: tuple[str, ...] = ALL_COLUMNS
) -> DataFrame:
    """Order lines in the raw transaction schema.

    Names are looked up with left joins on unique keys, so a lookup table is
    joined only if one of its columns is asked for.
    """

    def table(name: str, *wanted: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*wanted)

    lines = table(
        "lineitem",
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
    )
    orders = table("orders", "o_orderkey", "o_custkey", "o_orderdate").withColumn(
        "o_datetext", F.date_format("o_orderdate", "MM/dd/yy HH:mm")
    )
    if "Country" in columns:
        homes = table("customer", "c_custkey", "c_nationkey").join(
            table("nation", "n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "left",
        )
        # The lookup moves the orders, not the many more order lines.
        orders = orders.join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "Description" in columns:
        rows = rows.join(
            table("part", "p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left"
        )

    is_return = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    mapped = {
        "InvoiceNo": F.col("l_orderkey").cast("string"),
        "StockCode": F.col("l_partkey").cast("string"),
        "Description": F.col("p_name"),
        "Quantity": F.when(is_return, -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .cast("bigint"),
        "InvoiceDate": F.col("o_datetext"),
        "UnitPrice": round_half_away(F.col("l_extendedprice") / F.col("l_quantity") / 100.0, 2),
        "CustomerID": F.col("o_custkey").cast("string"),
        "Country": F.col("n_name"),
    }
    return rows.select(*[mapped[name].alias(name) for name in ALL_COLUMNS if name in columns])
