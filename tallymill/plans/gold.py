"""Gold layer: conformed dimensions, facts, aggregates and bridges."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions import clean, compat, money
from tallymill.operators.keys import dense_key
from tallymill.operators.versions import MonthlyPeriods, disjoint_periods, point_in_time_join
from tallymill.operators.windows import best_per_key, latest_per_key
from tallymill.plans import vocab as v
from tallymill.plans.silver_stock import purchase_line_parts


# --- dimensions ------------------------------------------------------------
def dim_date(*dates: DataFrame) -> DataFrame:
    """Every day that occurs in any of the one-column frames, with its calendar.

    The distinct runs in each task before the one shuffle, so what is shuffled is
    bounded by the calendar, not by the facts.
    """
    days = [d.select(F.col(d.columns[0]).cast("date").alias("date")) for d in dates]
    every = reduce(DataFrame.unionAll, days).where(F.col("date").isNotNull()).distinct()
    d = F.col("date")
    weekday = F.dayofweek(d)
    return every.select(
        compat.day_key(d).cast("int").alias("date_id"),
        d,
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_the_year"),
        compat.week_of_year(d).alias("week_of_year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.trunc(d, "month").alias("year_month"),
        F.quarter(d).alias("quarter"),
        compat.quarter_label(d).alias("quarter_name"),
        F.year(d).alias("year"),
        compat.fiscal_year(d).alias("fiscal_year"),
        compat.fiscal_quarter(d).alias("fiscal_quarter"),
        clean.yes_no(weekday.isin(1, 7)).alias("is_weekend"),
    )


def dim_campaign(campaigns: DataFrame) -> DataFrame:
    spent = campaigns.withColumn(
        "budget_utilisation_pct",
        money.percent(F.col("actual_spend_kes").cast("double"), F.col("budget_kes")),
    )
    return dense_key(spent, [F.col("campaign_id"), F.col("start_date"), F.col("campaign_name")], "campaign_sk")


def _generation(as_of: date) -> Column:
    born = F.year("birth_date")
    young = born.between(v.YOUNGEST_FROM, as_of.year)
    return F.when(young, F.lit(v.YOUNGEST_GENERATION)).otherwise(clean.band(born, v.GENERATIONS))


def dim_customers(crm: DataFrame, as_of: date) -> DataFrame:
    columns = [c for c in crm.columns if c != "county"]
    return dense_key(
        crm.select(*columns, _generation(as_of).alias("generation")),
        [F.col("registration_date"), F.col("customer_id")],
        "customer_sk",
    )


def dim_employee(hr: DataFrame, as_of: date) -> DataFrame:
    """Staff versions; those without a store belong to headquarters.

    Years of tenure are of 365 days, years since hire are turns of the year; a cohort is a quarter.
    """
    hired = F.col("hire_date")
    placed = hr.withColumns(
        {
            "store_id": F.coalesce("store_id", F.lit("HQ")),
            "display_name": F.concat_ws(", ", "last_name", "first_name"),
            "generation": _generation(as_of),
            "tenure_years": F.floor(F.col("tenure_days") / 365),
            "years_since_hire": compat.years_between_starts(hired, compat.today(as_of)),
            "hire_cohort": F.concat(F.year(hired).cast("string"), F.lit("-Q"), F.quarter(hired).cast("string")),
        }
    )
    return dense_key(placed, [F.col("employee_id"), F.col("valid_from"), F.col("valid_to")], "employee_sk")


def dim_store(stores: DataFrame) -> DataFrame:
    return stores


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    return dense_key(
        suppliers, [F.col("supplier_id"), F.col("valid_from"), F.col("valid_to")], "supplier_key"
    )


def dim_product(products: DataFrame) -> DataFrame:
    """Product versions as silver holds them, current flag included.

    Silver has filled every missing ``valid_to``; asking again which version is
    open would find none.
    """
    return products


def dim_geography_economic(counties: DataFrame, economic: DataFrame) -> DataFrame:
    """Counties with their most recent indicators."""
    measures = [
        "gdp_growth_pct",
        "inflation_pct",
        "unemployment_pct",
        "consumer_confidence",
        "retail_sales_index",
        "fuel_price_kes",
        "usd_kes_rate",
    ]
    latest = latest_per_key(economic.select("county", "date", *measures), ["county"], "date")
    joined = counties.join(latest.withColumnRenamed("date", "economic_as_of_date"), "county", "left")
    return dense_key(
        joined.select(
            "county",
            "population",
            "avg_income_kes",
            "latitude",
            "longitude",
            *measures,
            "economic_as_of_date",
        ),
        [F.col("county"), *[F.col(m) for m in measures]],
        "geo_sk",
    )


def bridge_product(dim: DataFrame) -> DataFrame:
    """Natural product id and day → surrogate key, cost and supplier, without overlaps."""
    return disjoint_periods(dim, "product_id", "product_sk", ["product_sk", "supplier_id", "unit_cost_kes"])


def bridge_store(dim: DataFrame) -> DataFrame:
    return disjoint_periods(dim, "store_id", "store_key", ["store_key", "county"])


def bridge_employee(dim: DataFrame) -> DataFrame:
    return disjoint_periods(dim, "employee_id", "employee_sk", ["employee_sk", "department"])


def cust_county(pos_transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Each customer's home: the store they buy at most, then the lowest store id."""
    visits = (
        pos_transactions.where((F.col("customer_id") != v.WALK_IN) & F.col("store_id").isNotNull())
        .groupBy("customer_id", "store_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    home = best_per_key(visits, ["customer_id"], [F.col("n").desc(), F.col("store_id")])
    where = stores.groupBy("store_id").agg(F.max_by("county", "valid_from").alias("home_county"))
    return home.join(where, "store_id", "left").select(
        "customer_id", F.col("store_id").alias("primary_store_id"), "home_county"
    )


# --- sales facts -----------------------------------------------------------
def one_per_id(headers: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """The earliest header per id."""
    rest = [c for c in headers.columns if c not in (key, *order_by)]
    return best_per_key(headers, [key], [F.col(c).asc_nulls_last() for c in (*order_by, *rest)])


def pos_heads(transactions: DataFrame) -> DataFrame:
    columns = (
        "transaction_id", "store_id", "customer_id", "cashier_id", "payment_method",
        "transaction_date", "transaction_time",
    )
    return one_per_id(transactions.select(*columns), "transaction_id", ["transaction_date", "transaction_time"])


def web_heads(orders: DataFrame) -> DataFrame:
    columns = (
        "order_id", "customer_id", "order_date", "order_time", "delivery_address", "delivery_fee",
        "payment_method", "order_status",
    )
    return one_per_id(orders.select(*columns), "order_id", ["order_date", "order_time"])


def _reductions() -> list[Column]:
    """Discount and price after it, as silver has them: made of three columns, and so not shuffled with the lines."""
    q, p, d = F.col("quantity"), F.col("unit_price_kes"), F.col("discount_rate")
    return [
        money.line_discount(q, p, d).alias("discount_amount_kes"),
        money.net_price(p, d).alias("unit_price_after_discount_kes"),
    ]


def fact_pos_sales(lines: DataFrame, heads: DataFrame, bridge: MonthlyPeriods) -> DataFrame:
    """One row per kept till line. ``heads`` and ``bridge`` have at most one match
    for a line (``pos_heads``, ``bridge_product``), so no line is doubled and the
    facts are shuffled once. Pass both as written tables: the joins then see their
    true sizes, and sit right on their shuffles, where Spark can split a hot id."""
    sold = lines.join(heads, "transaction_id", "left")
    priced = point_in_time_join(sold, bridge, "transaction_date", ["supplier_id", "unit_cost_kes"])
    return priced.select(
        "transaction_id",
        "store_id",
        "customer_id",
        "cashier_id",
        "product_id",
        "supplier_id",
        F.lit(None).cast("string").alias("delivery_address"),
        "payment_method",
        F.lit("delivered").alias("order_status"),
        F.lit(0).cast("decimal(18,2)").alias("delivery_fee"),
        "transaction_date",
        "transaction_time",
        "line_number",
        "quantity",
        "unit_price_kes",
        "discount_rate",
        *_reductions(),
        "line_total",
        "unit_cost_kes",
        "campaign_id",
    )


def _web_sales(lines: DataFrame, heads: DataFrame, bridge: MonthlyPeriods, homes: DataFrame) -> DataFrame:
    """The home store joins the heads, which are fewer and narrower than their lines; both have one row per id."""
    store = homes.select("customer_id", F.col("primary_store_id").alias("store_id"))
    sold = lines.join(heads.join(store, "customer_id", "left"), "order_id", "left")
    return point_in_time_join(sold, bridge, "order_date", ["supplier_id", "unit_cost_kes"])


def ecommerce_fact_sales(
    lines: DataFrame, heads: DataFrame, bridge: MonthlyPeriods, homes: DataFrame
) -> DataFrame:
    """One row per web order line; the silver line key breaks ties of the new key, so no row's number
    hangs on its place, and the rows need no sort before they are dealt out."""
    sold = _web_sales(lines, heads, bridge, homes).select(
        F.col("order_line_key").alias("_line"),
        "order_id",
        "line_number",
        "product_id",
        "supplier_id",
        "customer_id",
        "store_id",
        "order_date",
        "order_time",
        "delivery_address",
        "delivery_fee",
        "payment_method",
        "order_status",
        "quantity",
        "unit_cost_kes",
        "unit_price_kes",
        "discount_rate",
        "line_total_kes",
    )
    order = [F.col(c) for c in ("order_date", "order_id", "line_number", "_line")]
    keyed = dense_key(sold, order, "order_line_key", steady=True).drop("_line")
    discount, net = _reductions()
    return keyed.select(
        *[c for c in keyed.columns if c != "line_total_kes"],
        net,
        discount,
        "line_total_kes",
        clean.band(F.col("discount_rate"), v.DISCOUNT_TIERS).alias("discount_tier"),
    )


def fact_ecommerce_sales(
    lines: DataFrame, heads: DataFrame, bridge: MonthlyPeriods, homes: DataFrame
) -> DataFrame:
    """Web order lines in the columns of the till facts."""
    return _web_sales(lines, heads, bridge, homes).select(
        F.col("order_id").alias("transaction_id"),
        "store_id",
        "customer_id",
        F.lit(None).cast("string").alias("cashier_id"),
        "product_id",
        "supplier_id",
        "delivery_address",
        "payment_method",
        "order_status",
        "delivery_fee",
        F.col("order_date").alias("transaction_date"),
        F.col("order_time").alias("transaction_time"),
        "line_number",
        "quantity",
        "unit_price_kes",
        "discount_rate",
        *_reductions(),
        F.col("line_total_kes").alias("line_total"),
        "unit_cost_kes",
        F.lit(None).cast("string").alias("campaign_id"),
    )


def fact_sales(pos: DataFrame, web: DataFrame) -> DataFrame:
    """Both channels' lines under one set of columns."""
    return pos.unionByName(web)


# --- other facts -----------------------------------------------------------
def with_date_id(df: DataFrame, column: str, name: str = "date_id") -> DataFrame:
    return df.withColumn(name, compat.day_key(F.col(column)).cast("int"))


def sale_origins(pos: DataFrame, web: DataFrame) -> DataFrame:
    """Store and customer of every sale, one row per id."""
    columns = ("transaction_id", "store_id", "customer_id")
    return pos.select(*columns).unionByName(
        web.select(
            F.col("order_id").alias("transaction_id"), F.lit(None).cast("string").alias("store_id"), "customer_id"
        )
    ).groupBy("transaction_id").agg(
        F.min("store_id").alias("store_id"), F.min("customer_id").alias("customer_id")
    )


def fact_returns(returns: DataFrame, bridge: MonthlyPeriods, origins: DataFrame) -> DataFrame:
    """Return events with product version, and store and customer of the original sale."""
    dated = with_date_id(returns, "return_date")
    versioned = point_in_time_join(dated, bridge, "return_date", ["product_sk"])
    return versioned.join(
        origins, versioned["original_transaction_id"] == origins["transaction_id"], "left"
    ).drop("transaction_id")


def fact_loyalty(loyalty: DataFrame) -> DataFrame:
    return with_date_id(loyalty, "transaction_date")


def fact_inventory_movements(movements: DataFrame, products: MonthlyPeriods, stores: MonthlyPeriods) -> DataFrame:
    dated = with_date_id(movements, "movement_date")
    by_product = point_in_time_join(dated, products, "movement_date", ["product_sk"])
    return point_in_time_join(by_product, stores, "movement_date", ["store_key"])


def fact_customer_experience(feedback: DataFrame) -> DataFrame:
    return with_date_id(feedback, "feedback_date")


def card_owners(cards: DataFrame) -> DataFrame:
    return cards.groupBy("card_number").agg(F.min("customer_id").alias("customer_id"))


def fact_gift_card(transactions: DataFrame, owners: DataFrame) -> DataFrame:
    """Gift-card events with the customer the card was issued to."""
    return with_date_id(transactions, "date").join(owners, "card_number", "left")


def fact_time_attendance(events: DataFrame, bridge: MonthlyPeriods) -> DataFrame:
    """Clock events with the staff version of that day."""
    return point_in_time_join(with_date_id(events, "event_date"), bridge, "event_date", ["employee_sk", "department"])


def po_heads(orders: DataFrame) -> DataFrame:
    columns = ("po_number", "supplier_id", "status", "order_date", "expected_delivery_date")
    return one_per_id(orders.select(*columns), "po_number", ["order_date", "expected_delivery_date"])


def receipts_per_line(receipts: DataFrame) -> DataFrame:
    return receipts.groupBy("po_number", "product_id").agg(
        F.min("receipt_date").alias("first_receipt_date"),
        F.max("receipt_date").alias("last_receipt_date"),
        F.sum("quantity_received").alias("quantity_received"),
    )


def fact_procurement(lines: DataFrame, heads: DataFrame, receipts: DataFrame) -> DataFrame:
    """Purchase lines as an accumulating snapshot: ordered, expected, received.

    ``receipts`` are summed per order and product (``receipts_per_line``) and
    ``heads`` unique (``po_heads``) before they meet the lines.
    """
    follows = purchase_line_parts(*[F.col(c) for c in ("po_number", "line_number", "quantity_ordered", "line_total_kes")])
    narrow = lines.drop(*follows)  # what follows from a line's other columns is not shuffled with it
    met = narrow.join(heads, "po_number", "left").join(receipts, ["po_number", "product_id"], "left")
    rest = [c for c in met.columns if c not in lines.columns]
    whole = met.withColumns(follows)
    snap = whole.select("po_number", "product_id", *[c for c in lines.columns if c not in ("po_number", "product_id")], *rest)
    late = compat.days_between(F.col("expected_delivery_date"), F.col("last_receipt_date"))
    for column, name in (
        ("order_date", "order_date_id"),
        ("expected_delivery_date", "expected_date_id"),
        ("last_receipt_date", "receipt_date_id"),
    ):
        snap = with_date_id(snap, column, name)
    return snap.withColumns(
        {
            "actual_lead_time_days": compat.days_between(F.col("order_date"), F.col("last_receipt_date")),
            "lead_time_variance_days": late,
            "is_on_time": late <= 0,
        }
    )


# --- aggregates ------------------------------------------------------------
def _sums(df: DataFrame, *columns: str) -> list[Column]:
    return [money.exact_sum(F.col(c)).cast("double").alias(c) for c in columns]


def agg_store_financials(daily: DataFrame) -> DataFrame:
    measures = ("sales_kes", "cost_of_goods_sold", "gross_margin", "operating_expenses", "net_profit")
    return daily.groupBy("store_id", "date").agg(*_sums(daily, *measures))


def agg_inventory_snapshot(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("product_id", "store_id", "snapshot_date").agg(
        F.sum("on_hand_quantity").alias("on_hand_quantity"),
        F.max("reorder_point").alias("reorder_point"),
        F.max("safety_stock").alias("safety_stock"),
        F.max((F.col("on_hand_quantity") <= 0).cast("int")).alias("is_stockout"),
    )


def agg_competitor_benchmark(quarterly: DataFrame, competitors: DataFrame) -> DataFrame:
    """Revenue per rival and quarter, and its share of that quarter's total; lines of no
    known quarter are a quarter of their own."""
    each = quarterly.groupBy("competitor_id", "quarter").agg(
        F.sum("revenue_kes").alias("revenue_kes"),
        F.avg(F.col("market_share_pct").cast("decimal(9,2)")).cast("double").alias("market_share_pct"),
    )
    total = each.groupBy(F.col("quarter").alias("_quarter")).agg(F.sum("revenue_kes").alias("_all"))
    names = competitors.groupBy("competitor_id").agg(F.min("competitor_name").alias("competitor_name"))
    share = F.round(F.try_divide(F.col("revenue_kes") * 100, F.col("_all")), 4)
    return (
        each.join(total, F.col("quarter").eqNullSafe(F.col("_quarter")))
        .join(names, "competitor_id", "left")
        .select(
            "competitor_id", "competitor_name", "quarter", "revenue_kes", "market_share_pct",
            share.alias("revenue_share_pct"),
        )
    )
