"""The 33 raw tables: file, columns and intended types.

Everything lands as nullable text; the intended type is kept as column metadata.
"""

from __future__ import annotations

from pyspark.sql import types as T

# folder/table, then its columns in file order; ":type" marks a
# column whose text is meant to hold something other than text.
_TABLES = """
competitive_intelligence/competitors_raw
  competitor_id competitor_name headquarters estimated_stores:int
competitive_intelligence/competitor_quarterly_raw
  competitor_id quarter revenue_kes:bigint market_share_pct:float
competitive_intelligence/competitor_stores_raw
  competitor_store_id competitor_id location county size_category
crm/crm_raw
  customer_id valid_from valid_to first_name last_name gender birth_date phone:float email county
  town customer_segment acquisition_channel registration_date churn_date loyalty_tier
  communication_preferences feedback_score:float
customer_service/feedback_raw
  feedback_id customer_id date rating:int comment category
customer_service/service_interactions_raw
  interaction_id customer_id interaction_date channel issue_type resolution_time_minutes:int
  satisfaction_score:float
finance/gl_transactions_raw
  transaction_id account_code date amount:decimal type store_id
finance/store_daily_financials_raw
  store_id date sales_kes:float cost_of_goods_sold:float gross_margin:float
  operating_expenses:float net_profit:float
gis/gis_counties_raw
  county population:int avg_income_kes:int latitude:float longitude:float
gis/gis_locations_raw
  location_id county location_name location_type latitude:float longitude:float
  accessibility_score:float
hr/employee_shifts_raw
  shift_id employee_id store_id shift_date shift_type start_time end_time hours_worked:float
  overtime_hours:int
hr/hr_raw
  employee_id valid_from valid_to first_name last_name gender birth_date hire_date department
  job_title salary:int store_id shift_pattern
hr/time_tracking_raw
  event_id employee_id store_id timestamp event_type
inventory/inventory_movements_raw
  movement_id movement_date store_id product_id movement_type quantity:int unit_cost_kes:float
inventory/inventory_snapshots_raw
  snapshot_date store_id product_id on_hand_quantity:int reorder_point:float safety_stock:int
loyalty/loyalty_transactions_raw
  transaction_id customer_id date points_earned:int points_redeemed:int points_balance:int
  transaction_type order_id
macroeconomic/economic_raw
  county year_month gdp_growth_pct:float inflation_pct:float unemployment_pct:float
  consumer_confidence:float retail_sales_index:float fuel_price_kes:decimal usd_kes_rate:float
marketing/campaigns_raw
  campaign_id campaign_name campaign_type channel start_date end_date budget_kes:int
  actual_spend_kes:int discount_rate:decimal
marketing/promotions_raw
  promotion_id promotion_name start_date end_date discount_type discount_value:int
marketing/promotion_products_raw
  promotion_id product_id
procurement/goods_receipts_raw
  receipt_id po_number receipt_date product_id quantity_received:int receiving_notes
procurement/purchase_orders_raw
  po_number order_date supplier_id expected_delivery_date status total_amount:decimal
procurement/purchase_order_lines_raw
  po_number line_number:int product_id quantity_ordered:int unit_price:decimal line_total:decimal
products/products_raw
  product_id valid_from valid_to product_name category subcategory brand supplier_id
  unit_cost_kes:float retail_price_kes:decimal margin_percentage:float introduction_date
  discontinued_date is_active
sales/ecommerce_orders_raw
  order_id order_date customer_id delivery_address delivery_fee:int payment_method status
  total_amount:decimal
sales/ecommerce_order_lines_raw
  order_id line_number:int product_id quantity:int unit_price:decimal discount_rate:decimal
  line_total:decimal
sales/gift_cards_raw
  card_number issue_date expiry_date initial_balance:int current_balance:int
sales/gift_card_transactions_raw
  transaction_id card_number date amount:int type
sales/pos_line_items_raw
  transaction_id line_number:int product_id quantity:int unit_price:decimal discount_rate:decimal
  line_total:decimal
sales/pos_transactions_raw
  transaction_id transaction_date store_id customer_id cashier_id payment_method
  total_amount:decimal
sales/returns_raw
  return_id original_transaction_id return_date product_id quantity_returned:int
  refund_amount:decimal return_reason
stores/stores_raw
  store_id valid_from valid_to store_name county town format size_sqm:int opening_date
  closing_date is_active
suppliers/suppliers_raw
  supplier_id valid_from valid_to supplier_name contact_person phone:bigint email payment_terms
  lead_time_days:int category tax_id
"""


def _parse(text: str) -> tuple[dict[str, T.StructType], dict[str, str]]:
    schemas: dict[str, T.StructType] = {}
    paths: dict[str, str] = {}
    table = ""
    for line in text.strip().splitlines():
        if not line.startswith(" "):
            table = line.rsplit("/", 1)[1]
            schemas[table], paths[table] = T.StructType(), f"{line}.csv"
            continue
        for item in line.split():
            name, _, intended = item.partition(":")
            schemas[table].add(name, T.StringType(), True, {"intended_type": intended or "text"})
    return schemas, paths


SCHEMAS, PATHS = _parse(_TABLES)
