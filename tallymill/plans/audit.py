"""What is looked at after the web orders are loaded."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.money import exact_mean, exact_sum
from tallymill.operators.quality import count_where, metrics, violations
from tallymill.plans import vocab as v


def latest_batch(orders: DataFrame, key: str = "ecommerce_key") -> DataFrame:
    """The batch of the row with the highest key, as a one-row frame."""
    return orders.select(key, "etl_batch_id").orderBy(F.col(key).desc()).limit(1).select("etl_batch_id")


def of_latest_batch(orders: DataFrame, key: str = "ecommerce_key") -> DataFrame:
    """One row is joined, so its broadcast has a fixed size."""
    return orders.join(F.broadcast(latest_batch(orders, key)), "etl_batch_id", "left_semi")


def order_metrics(orders: DataFrame) -> DataFrame:
    return metrics(
        orders,
        {
            "Total Rows": F.count(F.lit(1)),
            "Unique Order IDs": F.count_distinct("order_id"),
            "Unknown Customer IDs": count_where(F.col("customer_id") == v.UNKNOWN),
            "Zero Amounts": count_where(F.col("amount") == 0),
            "Negative Amounts": count_where(F.col("amount") < 0),
            "Zero Delivery Fee": count_where(F.col("delivery_fee") == 0),
        },
    )


def order_summary(orders: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return orders.agg(
        n.alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        exact_sum(F.col("amount")).cast("double").alias("total_revenue"),
        exact_mean(exact_sum(F.col("amount")), n, 4).alias("average_order_value"),
        exact_sum(F.col("delivery_fee")).cast("double").alias("total_delivery_fees"),
        exact_mean(exact_sum(F.col("delivery_fee")), n, 4).alias("average_delivery_fee"),
        F.min("amount").alias("min_order_amount"),
        F.max("amount").alias("max_order_amount"),
    )


def preview(orders: DataFrame, by: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows along ``by``; Spark keeps ``n`` rows per task."""
    return orders.withColumn("delivery_address_preview", F.left("delivery_address", F.lit(30))).drop(
        "delivery_address"
    ).orderBy(*by).limit(n)


def order_violations(orders: DataFrame, as_of: date) -> DataFrame:
    """CHECK and NOT NULL constraints of the orders table."""
    required = ("order_id", "order_date", "order_time", "customer_id", "delivery_address", "payment_method", "amount")
    return violations(
        orders,
        {
            "amount_not_negative": F.col("amount") >= 0,
            "delivery_fee_not_negative": F.col("delivery_fee") >= 0,
            "order_date_not_in_future": F.col("order_date") <= F.lit(as_of),
            **{f"{c}_not_null": F.col(c).isNotNull() for c in required},
        },
    )
