"""The silver tables: what each is built from, its gate, and its keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions import clean
from tallymill.plans import silver_parties as parties
from tallymill.plans import silver_sales as sales
from tallymill.plans import silver_stock as stock
from tallymill.plans import vocab as v


@dataclass(frozen=True)
class Silver:
    """``build`` receives the source frames in the order of ``sources`` (names
    ending in ``_raw`` are bronze, others silver) and ``as_of`` where asked.
    The columns ``evidence`` are for the quarantine only. ``steady``: made of one
    source by filters and projections alone, so its rows keep their places on a retry.
    ``typed``: fields of the first source that must parse; rows where one does not are set
    apart, with their texts, before the table is built, or stop a strict run. ``whole``: the
    texts are set apart all the same, but their rows stay, with NULL in such fields. ``sort``:
    the order in which the table is written."""

    build: Callable[..., DataFrame]
    sources: tuple[str, ...]
    keep: Callable[[], Column] | None = None
    dated: bool = False
    surrogate: tuple[str, tuple[str, ...]] | None = None
    unique: tuple[str, ...] | None = None
    evidence: tuple[str, ...] = ()
    typed: Mapping[str, str] | None = None
    whole: bool = False
    sort: tuple[str, ...] = ()
    steady: bool = False

    def make(self, as_of: date, *frames: DataFrame, **options) -> DataFrame:
        return self.build(*frames, *([as_of] if self.dated else []), **options)


# Fields that must parse, with their types
RETURN_TYPES = {"return_date": "date", "quantity_returned": "int", "refund_amount": "double"}
LOYALTY_TYPES = {"date": "date", "points_earned": "int", "points_redeemed": "int", "points_balance": "int"}
LEDGER_TYPES = {"date": "date", "amount": "double"}
FEEDBACK_TYPES = {"date": "date", "rating": "int"}
STAFF_TYPES = {"valid_from": "date", "valid_to": "date", "birth_date": "date", "hire_date": "date", "salary": "int"}
SERVICE_TYPES = {"interaction_date": "date", "resolution_time_minutes": "int", "satisfaction_score": "double"}
FINANCE_TYPES = {
    "date": "date", "sales_kes": "double", "cost_of_goods_sold": "double", "gross_margin": "double",
    "operating_expenses": "double", "net_profit": "double",
}
COUNTY_TYPES = {"population": "int", "avg_income_kes": "int", "latitude": "double", "longitude": "double"}
LOCATION_TYPES = {"latitude": "double", "longitude": "double", "accessibility_score": "double"}
SHIFT_TYPES = {"shift_date": "date", "hours_worked": "double", "overtime_hours": "int"}
CLOCK_TYPES = {"timestamp": "timestamp_ntz"}
SNAPSHOT_TYPES = {"snapshot_date": "date", "on_hand_quantity": "int", "reorder_point": "double", "safety_stock": "int"}
ECONOMY_TYPES = {
    "gdp_growth_pct": "double", "inflation_pct": "double", "unemployment_pct": "double", "consumer_confidence": "double",
    "retail_sales_index": "double", "fuel_price_kes": "double", "usd_kes_rate": "double",
}
CAMPAIGN_TYPES = {"start_date": "date", "end_date": "date", "budget_kes": "int", "actual_spend_kes": "int", "discount_rate": "double"}
PROMOTION_TYPES = {"start_date": "date", "end_date": "date", "discount_value": "double"}
RECEIPT_TYPES = {"receipt_date": "date", "quantity_received": "int"}
PURCHASE_TYPES = {"order_date": "date", "expected_delivery_date": "date", "total_amount": "double"}
PRODUCT_TYPES = {
    "valid_from": "date", "valid_to": "date", "introduction_date": "date", "discontinued_date": "date",
    "unit_cost_kes": "double", "retail_price_kes": "double", "margin_percentage": "double",
}
STORE_TYPES = {"valid_from": "date", "valid_to": "date", "opening_date": "date", "closing_date": "date", "size_sqm": "int"}
SUPPLIER_TYPES = {"valid_from": "date", "valid_to": "date", "lead_time_days": "int"}


def _valid() -> Column:
    return F.col("quality_flag") == clean.VALID


def _readable() -> Column:
    return F.col("quality_flag") != clean.UNREADABLE


def _readable_not_future() -> Column:
    return ~F.col("quality_flag").isin("Future date - Invalid", clean.UNREADABLE)


def _not_future() -> Column:
    return F.col("quality_flag") != "Future date - Invalid"


SILVER: dict[str, Silver] = {
    "competitors": Silver(parties.competitors, ("competitors_raw",)),
    "competitor_quarterly": Silver(parties.competitor_quarterly, ("competitor_quarterly_raw",)),
    "competitor_stores": Silver(parties.competitor_stores, ("competitor_stores_raw",)),
    "crm": Silver(parties.crm, ("crm_raw",), dated=True, unique=("customer_id",), typed={"feedback_score": "double"}),
    "feedback": Silver(
        parties.feedback, ("feedback_raw",), lambda: F.col("rating").between(1, 5), dated=True,
        typed=FEEDBACK_TYPES, sort=("feedback_date", "feedback_id"),
    ),
    "service_interactions": Silver(parties.service_interactions, ("service_interactions_raw",), typed=SERVICE_TYPES),
    "gl_transactions": Silver(
        stock.gl_transactions, ("gl_transactions_raw",), _valid, typed=LEDGER_TYPES, sort=("transaction_date", "transaction_id")
    ),
    "store_daily_financials": Silver(stock.store_daily_financials, ("store_daily_financials_raw",), typed=FINANCE_TYPES),
    "gis_counties": Silver(parties.gis_counties, ("gis_counties_raw",), typed=COUNTY_TYPES),
    "gis_locations": Silver(parties.gis_locations, ("gis_locations_raw",), typed=LOCATION_TYPES),
    "employee_shifts": Silver(parties.employee_shifts, ("employee_shifts_raw",), typed=SHIFT_TYPES),
    "hr": Silver(parties.hr, ("hr_raw",), dated=True, typed=STAFF_TYPES),
    "time_tracking": Silver(parties.time_tracking, ("time_tracking_raw",), typed=CLOCK_TYPES),
    "inventory_movements": Silver(stock.inventory_movements, ("inventory_movements_raw",), _readable, evidence=v.MOVEMENT_TEXTS),
    "inventory_movements_slim": Silver(stock.inventory_movements_slim, ("inventory_movements_raw",)),
    "inventory_snapshots": Silver(stock.inventory_snapshots, ("inventory_snapshots_raw",), typed=SNAPSHOT_TYPES),
    "inventory_snapshots_slim": Silver(
        stock.inventory_snapshots_slim,
        ("inventory_snapshots_raw",),
        surrogate=(
            "inventory_key",
            (
                "snapshot_date",
                "store_id",
                "product_id",
                "on_hand_quantity",
                "reorder_point",
                "safety_stock",
            ),
        ),
        typed=SNAPSHOT_TYPES,
        steady=True,
    ),
    "loyalty_transactions": Silver(
        parties.loyalty_transactions, ("loyalty_transactions_raw",), _not_future, dated=True, typed=LOYALTY_TYPES
    ),
    "economic": Silver(stock.economic, ("economic_raw",), lambda: F.col("date").isNotNull(), typed=ECONOMY_TYPES),
    "campaigns": Silver(stock.campaigns, ("campaigns_raw",), typed=CAMPAIGN_TYPES, whole=True),
    "promotions": Silver(stock.promotions, ("promotions_raw",), _valid, dated=True, typed=PROMOTION_TYPES),
    "promotion_products": Silver(
        stock.promotion_products,
        ("promotion_products_raw",),
        lambda: clean.not_null_text(F.col("product_id")),
    ),
    "goods_receipts": Silver(
        stock.goods_receipts, ("goods_receipts_raw",), lambda: F.col("quantity_received") > 0, dated=True, typed=RECEIPT_TYPES
    ),
    "purchase_orders": Silver(
        stock.purchase_orders,
        ("purchase_orders_raw",),
        lambda: F.col("order_date").isNotNull() & clean.not_dup(F.col("po_number")),
        dated=True,
        typed=PURCHASE_TYPES,
        sort=("order_date", "po_number"),
    ),
    "purchase_order_lines": Silver(
        stock.purchase_order_lines,
        ("purchase_order_lines_raw",),
        lambda: clean.not_dup(F.col("po_number")),
    ),
    "products": Silver(
        parties.products,
        ("products_raw",),
        dated=True,
        surrogate=("product_sk", ("product_id", "valid_from", "valid_to", "product_name", "unit_cost_kes")),
        typed=PRODUCT_TYPES,
        whole=True,
    ),
    "ecommerce_orders": Silver(
        sales.ecommerce_orders,
        ("ecommerce_orders_raw",),
        surrogate=("ecommerce_key", ("order_id", "order_date", "order_time", "amount")),
    ),
    "ecommerce_order_lines": Silver(
        sales.ecommerce_order_lines,
        ("ecommerce_order_lines_raw",),
        _valid,
        surrogate=(
            "order_line_key",
            ("order_id", "line_number", "product_id", "quantity", "unit_price_kes", "discount_rate", "line_total_kes"),
        ),
        steady=True,
    ),
    "gift_cards": Silver(sales.gift_cards, ("gift_cards_raw",)),
    "gift_card_transactions": Silver(sales.gift_card_transactions, ("gift_card_transactions_raw",)),
    "pos_line_items": Silver(
        sales.pos_line_items,
        ("pos_line_items_raw",),
        _valid,
        surrogate=(
            "pos_line_key",
            ("transaction_id", "line_number", "product_id", "quantity", "unit_price_kes", "discount_rate", "line_total"),
        ),
        steady=True,
    ),
    "pos_transactions": Silver(
        sales.pos_transactions,
        ("pos_transactions_raw", "pos_line_items"),
        _readable_not_future,
        dated=True,
        surrogate=("pos_transaction_key", ("transaction_id", "transaction_date", "transaction_time")),
        unique=("transaction_id",),
    ),
    "pos_returns": Silver(sales.pos_returns, ("returns_raw",), typed=RETURN_TYPES),
    "ecomerce_returns": Silver(sales.ecomerce_returns, ("returns_raw",), typed=RETURN_TYPES),
    "returns": Silver(sales.returns, ("returns_raw",), typed=RETURN_TYPES),
    "stores": Silver(parties.stores, ("stores_raw",), dated=True, typed=STORE_TYPES),
    "suppliers": Silver(parties.suppliers, ("suppliers_raw",), dated=True, typed=SUPPLIER_TYPES),
}
