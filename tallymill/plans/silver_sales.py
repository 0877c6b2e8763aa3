"""Silver tables of the two sales channels, returns and gift cards.

Every function takes raw frames and returns the typed, repaired and flagged
frame; the gate that decides which rows are kept is in ``tallymill.plans.tables``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions import clean, compat, money
from tallymill.operators.repair import shift_gift_card, unpack_order
from tallymill.operators.settle import settled
from tallymill.operators.windows import row_numbers
from tallymill.plans import vocab as v


def _line_rules(total: str, extra: list) -> list:
    q, p, d = F.col("quantity"), F.col("unit_price_kes"), F.col("discount_rate")
    return [
        (clean.UNREADABLE, F.col("_unread")),
        ("Invalid quantity", q <= 0),
        ("Invalid unit price", p <= 0),
        ("Invalid discount rate", ~d.between(0, 1)),
        ("Invalid line total", F.col(total) <= 0),
        *extra,
    ]


def pos_line_items(raw: DataFrame) -> DataFrame:
    """Till lines: blanks out of ids, campaign prefix off the total, signs dropped."""
    total = F.col("line_total")
    has_campaign = total.startswith(v.CAMPAIGN_PREFIX)
    amount = F.when(has_campaign, compat.text_after(total, ",")).otherwise(total)
    amount = F.trim(F.replace(amount, F.lit(","), F.lit("")))
    qty, price, rate = F.col("quantity"), F.col("unit_price"), F.col("discount_rate")
    base = settled(raw).where(clean.present(F.col("transaction_id")) & F.col("product_id").isNotNull()).select(
        clean.no_blanks(F.col("transaction_id")).alias("transaction_id"),
        clean.as_int(F.col("line_number")).alias("line_number"),
        clean.strip_dup(F.col("product_id")).alias("product_id"),
        F.abs(clean.as_int(qty).cast("bigint")).alias("quantity"),
        F.round(F.abs(clean.as_float(price)), 2).alias("unit_price_kes"),
        F.abs(clean.as_float(rate)).alias("discount_rate"),
        F.abs(clean.as_float(amount)).alias("line_total"),
        clean.unreadable(
            (qty, clean.as_int(qty)),
            (price, money.amount(clean.as_float(price))),
            (rate, clean.as_float(rate)),
            (amount, money.amount(clean.as_float(amount))),
        ).alias("_unread"),
        F.when(has_campaign, F.substring_index(total, ",", 1)).alias("campaign_id"),
    )
    q, p, d = F.col("quantity"), F.col("unit_price_kes"), F.col("discount_rate")
    txn = F.col("transaction_id")
    off_by = F.abs(
        F.col("calculated_line_total").try_cast("decimal(20,4)") - F.col("line_total").try_cast("decimal(20,4)")
    )
    return settled(
        base.withColumns(
            {
                "calculated_line_total": money.line_total(q, p, d),
                "discount_amount_kes": money.line_discount(q, p, d),
                "effective_unit_price_kes": money.net_price(p, d),
                "discount_tier": clean.band(d, v.DISCOUNT_TIERS),
                "line_value_tier": clean.band(F.col("line_total"), v.LINE_VALUE_TIERS),
                "transaction_source": F.when(txn.startswith("TXN-"), F.lit("POS")).otherwise(
                    F.coalesce(compat.text_before(txn, "-"), F.lit(v.UNKNOWN))
                ),
            }
        )
        .withColumn(
            "quality_flag",
            clean.first_failing(
                _line_rules(
                    "line_total",
                    [
                        ("Line total mismatch", off_by > money.LINE_TOLERANCE),
                        ("Malformed transaction ID", txn.contains(" ") | (txn == "")),
                    ],
                )
            ),
        )
        .drop("_unread")
    )


def pos_transaction_heads(raw: DataFrame, as_of: date) -> DataFrame:
    """Till receipts, typed and flagged."""
    customer, stamp = F.col("customer_id"), F.left(F.col("transaction_date"), F.lit(10))
    base = settled(raw).where(F.col("transaction_id").isNotNull()).select(
        clean.no_blanks(F.col("transaction_id")).alias("transaction_id"),
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        F.coalesce(clean.strip_dup(customer), F.lit(v.WALK_IN)).alias("customer_id"),
        clean.strip_dup(F.col("cashier_id")).alias("cashier_id"),
        clean.unreadable(
            (stamp, clean.as_date(stamp)),
            (F.col("total_amount"), money.amount(clean.as_float(F.col("total_amount")))),
        ).alias("_unread"),
        clean.as_date(stamp).alias("transaction_date"),
        compat.clock_text(F.col("transaction_date")).alias("transaction_time"),
        F.col("payment_method").alias("_method"),
        clean.as_float(F.col("total_amount")).alias("total_amount"),
        F.when(customer.isNull(), "Walk-in (Unknown)")
        .when(customer.contains(clean.DUP_MARK), "Registered (Needs merge)")
        .otherwise("Registered Customer")
        .alias("customer_type"),
    )
    day, hour = F.col("transaction_date"), compat.clock_hour(F.col("transaction_time"))
    amount = F.col("total_amount")
    typed = base.withColumns(
        {
            "payment_method": clean.recode(F.col("_method"), v.PAYMENT_METHODS, "Other"),
            "transaction_tier": clean.band(amount, v.TRANSACTION_TIERS),
            "time_of_day": clean.band(hour, v.DAY_TIMES),
            **compat.month_parts(day, "transaction"),
            "transaction_hour": hour,
            "transaction_weekday_num": F.dayofweek(day),
            "transaction_weekday": F.date_format(day, "EEEE"),
            "quality_flag": clean.first_failing(
                [
                    (clean.UNREADABLE, F.col("_unread")),
                    ("Future date - Invalid", day > compat.today(as_of)),
                    ("Suspicious old date", day < F.lit(v.OLDEST_PLAUSIBLE).cast("date")),
                    ("Invalid amount", amount <= 0),
                    ("Invalid payment method", ~F.col("_method").isin(*v.PAYMENT_WORDS)),
                ]
            ),
        }
    )
    return settled(typed.drop("_method", "_unread", "total_amount"))


def pos_transactions(raw: DataFrame, line_items: DataFrame, as_of: date) -> DataFrame:
    """Till receipts with the sum of their kept lines, added up before the join."""
    lines = line_items.groupBy("transaction_id").agg(
        money.exact_sum(F.col("line_total")).cast("double").alias("line_total")
    )
    return pos_transaction_heads(raw, as_of).join(lines, "transaction_id", "left")


def ecommerce_orders(raw: DataFrame) -> DataFrame:
    """Web orders with shifted fields put back; every distinct raw row is kept."""
    distinct = raw.drop("delivery_fee").distinct()
    stamp = F.replace(F.col("order_date"), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    return unpack_order(distinct).select(
        F.coalesce("order_id", F.lit(v.UNKNOWN)).alias("order_id"),
        F.coalesce(stamp.cast("date"), F.lit(v.EPOCH_PLACEHOLDER).cast("date")).alias("order_date"),
        F.coalesce(F.substring(stamp.cast("string"), 12, 8), F.lit("00:00:00")).alias("order_time"),
        F.coalesce(clean.strip_dup(F.col("customer_id")), F.lit(v.UNKNOWN)).alias("customer_id"),
        F.coalesce(
            F.trim(F.replace(F.col("delivery_address"), F.lit('"'), F.lit(""))), F.lit(v.UNKNOWN)
        ).alias("delivery_address"),
        "delivery_fee",
        "payment_method",
        "order_status",
        "amount",
    )


def ecommerce_order_lines(raw: DataFrame) -> DataFrame:
    order = F.col("order_id")
    qty, price = F.col("quantity"), F.col("unit_price")
    rate, total = F.col("discount_rate"), F.col("line_total")
    base = settled(raw).where(order.isNotNull() & F.col("product_id").isNotNull()).select(
        "order_id",
        clean.as_int(F.col("line_number")).alias("line_number"),
        clean.strip_dup(F.col("product_id")).alias("product_id"),
        clean.as_int(F.col("quantity")).alias("quantity"),
        F.abs(F.round(clean.as_float(F.col("unit_price")), 2)).alias("unit_price_kes"),
        F.abs(clean.as_float(F.col("discount_rate"))).alias("discount_rate"),
        F.abs(F.round(clean.as_float(F.col("line_total")), 2)).alias("line_total_kes"),
        clean.unreadable(
            (qty, clean.as_int(qty)),
            (price, money.amount(clean.as_float(price))),
            (rate, clean.as_float(rate)),
            (total, money.amount(clean.as_float(total))),
        ).alias("_unread"),
    )
    q, p, d = F.col("quantity"), F.col("unit_price_kes"), F.col("discount_rate")
    return settled(
        base.withColumns(
            {
                "calculated_line_total": money.line_total(q, p, d),
                "discount_amount_kes": money.line_discount(q, p, d),
                "unit_price_after_discount_kes": money.net_price(p, d),
                "discount_tier": clean.band(d, v.DISCOUNT_TIERS),
                "order_prefix": F.left(order, F.lit(4)),
                "order_sequence_number": clean.as_int(F.right(order, F.lit(8))),
                "quality_flag": clean.first_failing(_line_rules("line_total_kes", [])),
            }
        ).drop("_unread")
    )


def returns(raw: DataFrame) -> DataFrame:
    """Both channels' returns; ``channel`` is POS where the original id says so."""
    original = F.col("original_transaction_id")
    till = original.startswith("TXN")
    return raw.where(clean.not_dup(F.col("return_id")) & original.isNotNull()).select(
        "return_id",
        F.when(till, clean.no_blanks(original)).otherwise(original).alias("original_transaction_id"),
        clean.fix_date(F.col("return_date"), v.CHRISTMAS_2023).alias("return_date"),
        clean.strip_dup(F.col("product_id")).alias("product_id"),
        clean.as_int(F.col("quantity_returned")).alias("quantity_returned"),
        clean.as_float(F.col("refund_amount")).alias("refund_amount"),
        "return_reason",
        F.when(till, F.lit("POS")).otherwise(F.lit("ECOMMERCE")).alias("channel"),
    )


def pos_returns(raw: DataFrame) -> DataFrame:
    return returns(raw).where(F.col("channel") == "POS").drop("channel")


def ecomerce_returns(raw: DataFrame) -> DataFrame:
    return returns(raw).where(F.col("channel") == "ECOMMERCE").drop("channel")


def gift_cards(raw: DataFrame) -> DataFrame:
    return shift_gift_card(raw)


def gift_card_transactions(raw: DataFrame) -> DataFrame:
    """A card's first event, if an issue, stays one; later issues are top-ups and
    everything else redeems."""
    typed = raw.select(
        "transaction_id",
        "card_number",
        clean.as_date(F.col("date")).alias("date"),
        clean.as_int(F.col("amount")).alias("amount"),
        clean.packed(F.col("type"), 0, 2).alias("_kind"),
        clean.packed(F.col("type"), 1, 2).alias("linked_transaction_id"),
    )
    numbered = row_numbers(
        typed,
        ["card_number"],
        [F.col("date"), F.col("transaction_id")],
        [F.col("date"), F.left(F.col("transaction_id"), F.lit(v.CHUNK_PREFIX))],
        "_n",
    )
    issue = F.col("_kind") == "issue"
    kind = F.when(issue & (F.col("_n") == 1), "issue").when(issue, "top_up").otherwise("redeem")
    return numbered.withColumn("type", kind).select(
        "transaction_id",
        "card_number",
        "date",
        F.when(F.col("type") == "redeem", -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        "type",
        "linked_transaction_id",
    )
