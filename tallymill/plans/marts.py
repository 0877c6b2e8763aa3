"""The five marts. The source system only names these measures; the formulas are
ours and are given with each function."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions import compat, money


def _sum(c: Column | str) -> Column:
    return money.exact_sum(F.col(c) if isinstance(c, str) else c)


def _share(part: Column, whole: Column, places: int = 4) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), places)


def sales(facts: DataFrame, returns: DataFrame, month: str = "transaction_date") -> DataFrame:
    """Per month: revenue, orders, revenue per order (AOV), gross margin
    ``(revenue - cost) / revenue`` and refunds over revenue (return rate). A month that has
    refunds alone has no orders, no revenue and no rates.

    Lines are first added up per order and month, so counting orders needs no
    distinct over the facts.
    """
    cost = F.col("quantity").cast("decimal(10,0)") * F.col("unit_cost_kes").cast("decimal(14,2)")
    orders = facts.groupBy(compat.month_text(F.col(month)).alias("year_month"), "transaction_id").agg(
        _sum("line_total").alias("_revenue"),
        F.sum(cost).alias("_cost"),
        F.count(F.lit(1)).alias("_lines"),
    )
    sold = orders.groupBy("year_month").agg(
        F.sum("_revenue").alias("_revenue"),
        F.sum("_cost").alias("_cost"),
        F.sum("_lines").alias("n_lines"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    back = returns.groupBy(compat.month_text(F.col("return_date")).alias("year_month")).agg(
        _sum("refund_amount").alias("_refunds")
    )
    revenue, none = F.col("_revenue"), F.lit(0).cast("bigint")
    months = sold.withColumnRenamed("year_month", "_sold").join(
        back.withColumnRenamed("year_month", "_back"), F.col("_sold").eqNullSafe(F.col("_back")), "full"
    )
    return months.select(
        F.coalesce("_sold", "_back").alias("year_month"),
        F.coalesce("n_orders", none).alias("n_orders"),
        F.coalesce("n_lines", none).alias("n_lines"),
        F.coalesce(revenue.cast("double"), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.col("_refunds").cast("double"), F.lit(0.0)).alias("refunds"),
        money.exact_mean(revenue, F.col("n_orders")).alias("avg_order_value"),
        _share(revenue - F.coalesce("_cost", F.lit(0)), revenue).alias("gross_margin"),
        _share(F.coalesce("_refunds", F.lit(0)), revenue).alias("return_rate"),
    )


def campaign_roi(facts: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Revenue of a campaign's lines against its spend: ``(revenue - spend) / spend``."""
    won = facts.where(F.col("campaign_id").isNotNull()).groupBy("campaign_id").agg(
        _sum("line_total").alias("_revenue")
    )
    revenue = F.coalesce("_revenue", F.lit(0))
    return campaigns.join(won, "campaign_id", "left").select(
        "campaign_id",
        "actual_spend_kes",
        revenue.cast("double").alias("revenue"),
        _share(revenue - F.col("actual_spend_kes"), F.col("actual_spend_kes")).alias("roi"),
    )


def customer(
    customers: DataFrame, loyalty: DataFrame, feedback: DataFrame, by: str = "customer_segment"
) -> DataFrame:
    """Per segment: customers, active ones, churn rate, net promoter score (share of
    ratings 5 minus share of ratings 1 to 3) and points redeemed over points earned.

    Events are added up per customer before they meet the dimension.
    """
    points = loyalty.groupBy("customer_id").agg(
        F.sum(F.greatest("points_earned_raw", F.lit(0))).alias("_earned"),
        F.sum("points_redeemed").alias("_spent"),
    )
    ratings = feedback.groupBy("customer_id").agg(
        F.count_if(F.col("rating") == 5).alias("_fans"),
        F.count_if(F.col("rating") <= 3).alias("_critics"),
        F.count("rating").alias("_ratings"),
    )
    joined = customers.join(points, "customer_id", "left").join(ratings, "customer_id", "left")
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("_earned", "_spent", "_fans", "_critics", "_ratings")}
    churned = F.count_if("is_churned")
    everyone = F.count(F.lit(1))
    return joined.groupBy(by).agg(
        everyone.alias("n_customers"),
        (everyone - churned).alias("n_active"),
        _share(churned, everyone).alias("churn_rate"),
        F.round(
            F.try_divide((total["_fans"] - total["_critics"]).cast("double") * 100, total["_ratings"]), 2
        ).alias("nps"),
        _share(total["_spent"], total["_earned"]).alias("redemption_rate"),
    )


def supply(procurement: DataFrame) -> DataFrame:
    """Per supplier: purchase lines, share received on time, and mean and spread of
    days between expected and actual receipt."""
    late = F.col("lead_time_variance_days")
    return procurement.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(late).alias("n_received"),
        _share(F.count_if("is_on_time"), F.count(late)).alias("on_time_rate"),
        F.round(F.avg(late), 4).alias("avg_lead_time_variance"),
        F.round(F.stddev_samp(late), 4).alias("sd_lead_time_variance"),
    )


def stock_health(snapshots: DataFrame, movements: DataFrame) -> DataFrame:
    """Per product: stockout days and turnover, units sold over mean units on hand."""
    held = snapshots.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_snapshots"),
        F.sum("is_stockout").alias("n_stockouts"),
        F.avg("on_hand_quantity").alias("_mean"),
    )
    sold = movements.where(F.col("movement_type") == "SALE").groupBy("product_id").agg(
        _sum("quantity_absolute").alias("_sold")
    )
    units = F.coalesce("_sold", F.lit(0)).cast("double")
    return held.join(sold, "product_id", "left").select(
        "product_id",
        "n_snapshots",
        "n_stockouts",
        units.alias("units_sold"),
        F.round(F.try_divide(units, F.col("_mean")), 4).alias("turnover"),
    )


def finance(daily: DataFrame, stores: DataFrame) -> DataFrame:
    """Per store: revenue, net profit, net profit over revenue (operating margin) and
    revenue per square metre of the store's latest version."""
    size = stores.groupBy("store_id").agg(F.max_by("size_sqm", "valid_from").alias("size_sqm"))
    books = daily.groupBy("store_id").agg(_sum("sales_kes").alias("_sales"), _sum("net_profit").alias("_net"))
    revenue, net = F.col("_sales").cast("double"), F.col("_net").cast("double")
    return books.join(size, "store_id", "left").select(
        "store_id",
        revenue.alias("revenue"),
        net.alias("net_profit"),
        _share(net, revenue).alias("operating_margin"),
        money.exact_mean(F.col("_sales"), F.col("size_sqm").cast("bigint")).alias("revenue_per_sqm"),
    )


def workforce(employees: DataFrame, attendance: DataFrame, as_of: date) -> DataFrame:
    """Per department: current staff, women among them, staff at risk (hired less than
    a year before ``as_of``) and clock events per head."""
    clocked = attendance.groupBy("employee_sk").agg(F.count(F.lit(1)).alias("_events"))
    current = employees.where(F.col("employment_status") == "Active").join(clocked, "employee_sk", "left")
    new = F.date_diff(F.lit(as_of), F.col("hire_date")) < 365
    heads = F.count(F.lit(1))
    events = F.coalesce(F.sum("_events"), F.lit(0))
    return current.groupBy("department").agg(
        heads.alias("headcount"),
        _share(F.count_if(F.col("gender") == "Female"), heads).alias("female_share"),
        _share(F.count_if(new), heads).alias("retention_risk"),
        F.round(F.try_divide(events.cast("double"), heads), 4).alias("events_per_head"),
    )
