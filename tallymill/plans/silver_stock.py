"""Silver tables of stock, procurement, promotions, the ledger and the economy."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions import clean, compat, money
from tallymill.operators.windows import Level, running_windows
from tallymill.plans import vocab as v


def inventory_movements(raw: DataFrame) -> DataFrame:
    """Stock ledger with running stock per product and per product and store.

    Rows whose date cannot be read have no place in the ledger; they follow it, flagged,
    with the texts they came with (``raw_...``, null in the ledger), so that they can be mended.
    """
    kind, qty = F.col("movement_type"), F.col("_qty")
    outbound = kind.isin(*v.OUTBOUND)
    signed_qty = F.when(outbound, -F.abs(qty)).otherwise(F.abs(qty))
    typed = raw.where(F.col("movement_date").isNotNull() & clean.not_dup(F.col("movement_id"))).select(
        "movement_id",
        clean.fix_date(F.col("movement_date"), v.OCTOBER_2022).alias("movement_date"),
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        "product_id",
        F.upper("movement_type").alias("movement_type"),
        F.col("quantity").try_cast("decimal(18,4)").alias("_qty"),
        clean.as_float(F.col("unit_cost_kes")).alias("_cost"),
        *(F.col(c.removeprefix("raw_")).alias(c) for c in v.MOVEMENT_TEXTS),
    )
    signed = typed.drop(*v.MOVEMENT_TEXTS).withColumns(
        {
            "_signed": signed_qty,
            "sign_validation_flag": F.when(outbound & (qty > 0), "Positive quantity for outbound")
            .when(kind.isin(*v.INBOUND) & (qty < 0), "Negative quantity for inbound")
            .otherwise("Valid sign"),
        }
    ).where(F.col("movement_date").isNotNull())
    ledger = running_windows(
        signed,
        [
            Level(
                ("product_id",),
                sums={"cumulative_sum_by_product": "_signed", "running_total_raw_quantity": "_qty"},
                moving={"moving_sum_3_transactions": ("_signed", 3)},
            ),
            Level(("product_id", "store_id"), sums={"running_quantity": "_signed"}),
        ],
        [F.col("movement_date"), F.col("movement_id")],
        [F.col("movement_date"), F.left(F.col("movement_id"), F.lit(v.CHUNK_PREFIX))],
    )
    day, stock, moved = F.col("movement_date"), F.col("running_quantity"), F.col("moving_sum_3_transactions")
    flags = {
        "inventory_status": clean.band(stock, v.STOCK_LEVELS),
        "demand_velocity": clean.band(moved, v.DEMAND),
        "quality_flag": clean.first_failing(
            [
                ("Missing movement ID", F.col("movement_id").isNull()),
                ("Missing store", ~clean.present(F.col("store_id"))),
                ("Missing product", ~clean.present(F.col("product_id"))),
                ("Invalid movement type", ~kind.isin(*v.OUTBOUND, *v.INBOUND)),
                ("Zero/null quantity", F.coalesce(qty == 0, F.lit(True))),
                ("Invalid unit cost", F.coalesce(F.col("_cost") <= 0, F.lit(True))),
                ("Negative inventory", stock < 0),
            ]
        ),
    }

    def number(c: str) -> Column:
        return F.round(c, 2).cast("double")

    lost = typed.where(F.col("movement_date").isNull()).select(
        "movement_id",
        "store_id",
        "product_id",
        "movement_type",
        F.round(signed_qty, 2).cast("double").alias("quantity"),
        F.abs(number("_qty")).alias("quantity_absolute"),
        F.round("_cost", 2).alias("unit_cost_kes"),
        money.extended(F.abs(qty), F.col("_cost")).alias("movement_value_kes"),
        F.lit(clean.UNREADABLE).alias("quality_flag"),
        *v.MOVEMENT_TEXTS,
    )
    placed = ledger.withColumns(flags).select(
        compat.glue(F.col("movement_id"), F.lit("_"), compat.day_key(day)).alias("inventory_movement_key"),
        "movement_id",
        "movement_date",
        "store_id",
        "product_id",
        "movement_type",
        number("_signed").alias("quantity"),
        F.abs(number("_qty")).alias("quantity_absolute"),
        F.round("_cost", 2).alias("unit_cost_kes"),
        money.extended(F.abs(qty), F.col("_cost")).alias("movement_value_kes"),
        number("running_quantity").alias("running_quantity"),
        number("cumulative_sum_by_product").alias("cumulative_sum_by_product"),
        number("running_quantity").alias("cumulative_sum_by_product_store"),
        number("running_total_raw_quantity").alias("running_total_raw_quantity"),
        number("moving_sum_3_transactions").alias("moving_sum_3_transactions"),
        "inventory_status",
        "demand_velocity",
        *[c.alias(n) for n, c in compat.month_parts(day, "movement").items()],
        F.date_format(day, "MMMM").alias("movement_month_name"),
        "sign_validation_flag",
        "quality_flag",
    )
    return placed.unionByName(lost, allowMissingColumns=True)


def inventory_movements_slim(raw: DataFrame) -> DataFrame:
    """Typed pass-through variant of the ledger, types in lower case."""
    return raw.select(
        "movement_id",
        clean.fix_date(F.col("movement_date"), v.CHRISTMAS_2023).alias("movement_date"),
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        clean.strip_dup(F.col("product_id")).alias("product_id"),
        F.lower("movement_type").alias("movement_type"),
        clean.as_int(F.col("quantity")).alias("quantity"),
        clean.as_float(F.col("unit_cost_kes")).alias("unit_cost_kes"),
    )


def _snapshot_columns(raw: DataFrame, product: Column) -> DataFrame:
    return raw.select(
        clean.fix_date(F.col("snapshot_date"), v.CHRISTMAS_2023).alias("snapshot_date"),
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        product.alias("product_id"),
        clean.as_int(F.col("on_hand_quantity")).alias("on_hand_quantity"),
        clean.as_float(F.col("reorder_point")).alias("reorder_point"),
        clean.as_int(F.col("safety_stock")).alias("safety_stock"),
    )


def inventory_snapshots(raw: DataFrame) -> DataFrame:
    day, on_hand = F.col("snapshot_date"), F.col("on_hand_quantity")
    point, safety = F.col("reorder_point"), F.col("safety_stock")
    low = on_hand <= point
    return _snapshot_columns(raw, F.col("product_id")).withColumns(
        {
            "snapshot_key": clean.join_key(F.col("store_id"), F.col("product_id"), compat.day_key(day)),
            "stock_vs_reorder": on_hand - point,
            "stock_status": F.when(on_hand <= safety, "CRITICAL")
            .when(low, "WARNING")
            .when(on_hand <= point * v.CAUTION_FACTOR, "CAUTION")
            .otherwise("HEALTHY"),
            "suggested_reorder_quantity": F.when(low, point + safety - on_hand).otherwise(F.lit(0.0)),
            **compat.month_parts(day, "snapshot"),
            "snapshot_weekday": F.date_format(day, "EEEE"),
            "quality_flag": clean.first_failing(
                [
                    ("Negative stock", on_hand < 0),
                    ("Invalid reorder point", point < 0),
                    ("Invalid safety stock", safety < 0),
                    ("Below reorder point", low),
                ]
            ),
        }
    )


def inventory_snapshots_slim(raw: DataFrame) -> DataFrame:
    """Typed pass-through variant; its key is added when the table is written."""
    kept = raw.where(clean.not_dup(F.col("snapshot_date")))
    return _snapshot_columns(kept, clean.strip_dup(F.col("product_id")))


def purchase_orders(raw: DataFrame, as_of: date) -> DataFrame:
    po, status = F.col("po_number"), F.col("status")
    typed = raw.where(po.isNotNull()).select(
        "po_number",
        po.alias("purchase_order_key"),
        clean.strip_dup(F.col("supplier_id")).alias("supplier_id"),
        "status",
        clean.fix_date(F.col("order_date"), v.OCTOBER_2022).alias("order_date"),
        clean.fix_date(F.col("expected_delivery_date"), v.OCTOBER_2022).alias("expected_delivery_date"),
        F.round(clean.as_float(F.col("total_amount")), 2).alias("total_amount_kes"),
    )
    ordered, due = F.col("order_date"), F.col("expected_delivery_date")
    age = compat.days_between(ordered, compat.today(as_of))
    is_open = status == "Open"
    return typed.withColumns(
        {
            "status_category": clean.recode(status, v.PO_STATUS, v.UNKNOWN),
            **compat.month_parts(ordered, "order"),
            "expected_lead_time_days": compat.days_between(ordered, due),
            "days_since_order": age,
            "po_prefix": F.left(po, F.lit(2)),
            "po_sequence_number": clean.as_int(F.right(po, F.lit(8))),
            "action_priority": F.when(is_open & (age > 30), "OVERDUE - Review")
            .when(is_open & (age > 14), "Pending - Follow up")
            .when(status == "Cancelled", "Cancelled - Investigate")
            .when(status == "Closed", "Complete")
            .otherwise("Normal"),
            "quality_flag": clean.first_failing(
                [
                    ("Invalid total amount", F.col("total_amount_kes") <= 0),
                    ("Order date after expected delivery", ordered > due),
                    ("Missing order date", ordered.isNull()),
                    ("Missing expected delivery date", due.isNull()),
                    ("Missing supplier", ~clean.present(F.col("supplier_id"))),
                    ("Invalid status", ~status.isin("Closed", "Open", "Cancelled")),
                ]
            ),
        }
    )


def purchase_line_parts(po: Column, line: Column, qty: Column, total: Column) -> dict[str, Column]:
    """What follows from a purchase line's number, quantity and total, whatever the signs of these."""
    return {
        "po_line_key": clean.join_key(po, line),
        "calculated_unit_price": F.abs(money.unit_price(total, qty)),
        "landed_cost_kes": F.abs(money.landed_cost(total)),
        "estimated_vat_kes": F.abs(money.vat(total)),
        "po_prefix": F.left(po, F.lit(2)),
        "po_sequence_number": clean.as_int(F.right(po, F.lit(8))),
    }


def purchase_order_lines(raw: DataFrame) -> DataFrame:
    po, qty = F.col("po_number"), F.col("_qty")
    price, total = F.col("_price"), F.col("_total")
    typed = raw.where(po.isNotNull() & F.col("product_id").isNotNull()).select(
        "po_number",
        clean.as_int(F.col("line_number")).alias("line_number"),
        clean.strip_dup(F.col("product_id")).alias("product_id"),
        clean.as_int(F.col("quantity_ordered")).alias("_qty"),
        clean.as_float(F.col("unit_price")).alias("_price"),
        F.round(clean.as_float(F.col("line_total")), 2).alias("_total"),
        clean.unreadable(
            (F.col("quantity_ordered"), clean.as_int(F.col("quantity_ordered"))),
            (F.col("unit_price"), money.amount(clean.as_float(F.col("unit_price")))),
            (F.col("line_total"), money.amount(clean.as_float(F.col("line_total")))),
        ).alias("_unread"),
    )
    parts = purchase_line_parts(po, F.col("line_number"), qty, total)
    return typed.select(
        parts.pop("po_line_key").alias("po_line_key"),
        "po_number",
        "line_number",
        "product_id",
        F.abs(qty.cast("bigint")).alias("quantity_ordered"),
        F.abs(F.round(price, 2)).alias("unit_price_kes"),
        F.abs(total).alias("line_total_kes"),
        *[c.alias(name) for name, c in parts.items()],
        clean.first_failing(
            [
                (clean.UNREADABLE, F.col("_unread")),
                ("Invalid quantity", qty <= 0),
                ("Invalid unit price", F.round(price, 2) <= 0),
                ("Invalid line total", total <= 0),
                ("Line total mismatch", money.extended(qty, price) != total),
            ]
        ).alias("quality_flag"),
    )


def goods_receipts(raw: DataFrame, as_of: date) -> DataFrame:
    notes, day = F.col("receiving_notes"), F.col("receipt_date")
    real_note = F.nullif(notes, F.lit("NULL"))
    kind = None
    for word, label in v.NOTE_KINDS.items():
        kind = (F if kind is None else kind).when(notes.contains(word), F.lit(label))
    kind = kind.when(real_note.isNull(), F.lit("No Issues Recorded")).otherwise("Other Issue")
    typed = raw.where(F.col("receipt_id").isNotNull() & F.col("po_number").isNotNull()).select(
        F.col("receipt_id").alias("receipt_key"),
        "receipt_id",
        F.upper(F.trim("po_number")).alias("po_number"),
        "product_id",
        clean.fix_date(F.col("receipt_date"), v.CHRISTMAS_2023).alias("receipt_date"),
        clean.as_int(F.col("quantity_received")).alias("quantity_received"),
        F.coalesce(real_note, F.lit("No issues recorded")).alias("receiving_notes"),
        kind.alias("receipt_quality_category"),
        F.coalesce(notes.isin(*v.PROBLEM_NOTES), F.lit(False)).cast("int").alias("has_quality_issue"),
    )
    return typed.withColumns(
        {
            **compat.month_parts(day, "receipt"),
            "quality_flag": clean.first_failing(
                [
                    ("Invalid quantity", F.col("quantity_received") <= 0),
                    ("Future receipt date", day > compat.today(as_of)),
                    ("Suspicious old date", day < F.lit(v.OLDEST_PLAUSIBLE).cast("date")),
                    ("Missing product", F.col("product_id").isNull()),
                ]
            ),
        }
    )


def promotions(raw: DataFrame, as_of: date) -> DataFrame:
    now, kind = compat.today(as_of), F.col("_kind")
    start, end, value = F.col("start_date"), F.col("end_date"), F.col("discount_value")
    name = F.col("promotion_name")
    typed = raw.where(F.col("promotion_id").isNotNull()).select(
        F.col("promotion_id").alias("promotion_key"),
        "promotion_id",
        "promotion_name",
        F.when(name.rlike("^Promotion."), F.substr(name, F.lit(11)))
        .otherwise(name)
        .alias("promotion_short_name"),
        clean.as_date(F.col("start_date")).alias("start_date"),
        clean.as_date(F.col("end_date")).alias("end_date"),
        F.lower(F.trim("discount_type")).alias("_kind"),
        clean.as_float(F.col("discount_value")).alias("discount_value"),
    )
    days = compat.days_between(start, end)
    running = (start <= now) & (end >= now)
    fixed, percent = kind == "fixed", kind == "percentage"
    return typed.withColumns(
        {
            "campaign_duration_days": days,
            "promotion_status": F.when(start > now, "Scheduled (Future)")
            .when(end < now, "Completed (Past)")
            .when(running, "Active (Ongoing)")
            .otherwise(v.UNKNOWN),
            "campaign_length_tier": clean.band(days, v.CAMPAIGN_LENGTHS),
            "discount_type": clean.recode(kind, v.DISCOUNT_KINDS, "Unknown Type"),
            "discount_amount_or_percent": F.when(fixed | percent, value),
            "discount_description": F.when(
                fixed, compat.glue(F.lit("KES "), compat.no_decimals(value), F.lit(" off"))
            )
            .when(percent, compat.glue(value.cast("int").cast("string"), F.lit("% off")))
            .otherwise("Unknown discount"),
            "is_active": F.coalesce(running, F.lit(False)).cast("int"),
            "days_until_start": F.greatest(compat.days_between(now, start), F.lit(0)),
            "days_since_ended": F.greatest(compat.days_between(end, now), F.lit(0)),
            "quality_flag": clean.first_failing(
                [
                    ("Invalid - Start after end", start > end),
                    ("Invalid discount value", value <= 0),
                    ("Invalid discount type", ~kind.isin("fixed", "percentage")),
                    ("Missing dates", start.isNull() | end.isNull()),
                ]
            ),
        }
    ).drop("_kind")


def promotion_products(raw: DataFrame) -> DataFrame:
    product = F.col("product_id")
    return raw.where(F.col("promotion_id").isNotNull()).select(
        clean.join_key(F.col("promotion_id"), product).alias("promotion_product_key"),
        "promotion_id",
        "product_id",
        F.when(clean.present(product), "Valid product promotion link")
        .otherwise("Invalid record (no product)")
        .alias("record_type"),
        clean.first_failing(
            [
                ("Missing product - Invalid", ~clean.present(product)),
                ("NULL value - Invalid", product.contains("NULL")),
            ]
        ).alias("quality_flag"),
    )


def campaigns(raw: DataFrame) -> DataFrame:
    start, end = clean.as_date(F.col("start_date")), clean.as_date(F.col("end_date"))
    return raw.where(F.col("campaign_id").isNotNull()).select(
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "channel",
        start.alias("start_date"),
        end.alias("end_date"),
        compat.days_between(start, end).alias("campaign_duration_days"),
        clean.as_int(F.col("budget_kes")).alias("budget_kes"),
        clean.as_int(F.col("actual_spend_kes")).alias("actual_spend_kes"),
        clean.as_float(F.col("discount_rate")).alias("discount_rate"),
    )


def gl_transactions(raw: DataFrame) -> DataFrame:
    """Ledger lines with both signed views. Account codes read ``number-name``."""
    code, amount, side = F.col("account_code"), F.col("amount"), F.col("transaction_type")
    typed = raw.where(F.col("transaction_id").isNotNull()).select(
        F.col("transaction_id").alias("gl_transaction_key"),
        "transaction_id",
        "account_code",
        compat.text_before(code, "-").alias("account_number"),
        compat.text_after(code, "-").alias("account_name"),
        clean.recode(F.left(code, F.lit(1)), v.ACCOUNT_CLASSES, "Other").alias("account_category"),
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        clean.as_date(F.col("date")).alias("transaction_date"),
        F.lower("type").alias("transaction_type"),
        clean.as_float(F.col("amount")).alias("amount"),
    )
    debit, credit, nothing = side == "debit", side == "credit", F.lit(0.0)
    return typed.withColumns(
        {
            "signed_amount_debit_view": money.signed(amount, debit, credit, nothing),
            "signed_amount_credit_view": money.signed(amount, credit, debit, nothing),
            **compat.month_parts(F.col("transaction_date"), "transaction"),
            "quality_flag": clean.first_failing(
                [
                    ("Invalid amount", amount <= 0),
                    ("Invalid transaction type", ~side.isin("debit", "credit")),
                    ("Missing store", F.col("store_id").isNull()),
                    ("Missing account", code.isNull()),
                ]
            ),
        }
    )


def store_daily_financials(raw: DataFrame) -> DataFrame:
    measures = ("sales_kes", "cost_of_goods_sold", "gross_margin", "operating_expenses", "net_profit")
    return raw.select(
        "store_id",
        clean.as_date(F.col("date")).alias("date"),
        *[clean.as_float(F.col(m)).alias(m) for m in measures],
    )


def economic(raw: DataFrame) -> DataFrame:
    """Monthly county indicators, dated at the month's end."""
    measures = (
        "gdp_growth_pct",
        "inflation_pct",
        "unemployment_pct",
        "consumer_confidence",
        "retail_sales_index",
        "fuel_price_kes",
        "usd_kes_rate",
    )
    start = compat.month_start(F.col("year_month"))
    typed = raw.select(
        "county",
        F.last_day(start).alias("date"),
        start.alias("month_start_date"),
        *[clean.as_float(F.col(m)).alias(m) for m in measures],
    )
    gdp, inflation, jobless, mood, retail, fuel, rate = (F.col(m) for m in measures)
    day = F.col("date")
    score = (100 - jobless) * 0.4 + mood * 0.3 + (gdp * 5 + 50) * 0.3
    return typed.withColumns(
        {
            "economic_id": compat.glue(F.col("county"), F.lit("_"), F.date_format(day, "yyyyMM")),
            "calendar_year": F.year(day),
            "calendar_month": F.month(day),
            "calendar_quarter": F.quarter(day),
            "quarter_label": compat.quarter_label(day),
            "month_name": F.date_format(day, "MMMM"),
            "real_retail_sales_index": money.real_index(retail, inflation),
            "economic_health_score": F.round(score, 2),
            "quality_flag": clean.first_failing(
                [
                    ("Missing GDP", gdp.isNull()),
                    ("Invalid inflation", ~inflation.between(0, 50)),
                    ("Invalid unemployment", ~jobless.between(0, 100)),
                    ("Invalid confidence", ~mood.between(0, 100)),
                    ("Invalid retail index", retail < 0),
                    ("Invalid fuel price", fuel <= 0),
                    ("Invalid exchange rate", rate <= 0),
                ]
            ),
            "outlier_flag": clean.first_failing(
                [
                    ("High Growth Alert", gdp > 10),
                    ("Recession Alert", gdp < -5),
                    ("Hyperinflation Alert", inflation > 20),
                    ("Currency Crisis Alert", rate > 200),
                ],
                ok="Normal Range",
            ),
        }
    )
