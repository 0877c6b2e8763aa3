"""Rows whose last column swallowed its neighbours (unquoted commas)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.clean import comma_count, packed


def unpack_order(df: DataFrame) -> DataFrame:
    """Put fee, method, status and amount of an order back into their own columns.

    Rows shift left by one for each comma that ended up in ``total_amount``: with
    one comma it holds status and amount, with two it holds method, status and
    amount. What is displaced sits in ``payment_method`` and ``status``. Rows with
    more commas cannot be placed and get the defaults. The split is done per row,
    so copies of an order id keep their values.
    """
    raw = F.col("total_amount")
    commas = comma_count(raw)
    fee_in_method = F.col("payment_method").try_cast("int")
    fee_in_status = F.col("status").try_cast("int")
    unknown = F.lit("Unknown")

    def money(c: Column) -> Column:
        return F.abs(F.coalesce(c.try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")))

    def by_commas(none: Column, one: Column, two: Column, other: Column) -> Column:
        return F.when(commas == 0, none).when(commas == 1, one).when(commas == 2, two).otherwise(other)

    nothing = F.lit(None).cast("string")
    zero_fee = F.lit(0)
    return df.withColumns(
        {
            "delivery_fee": F.abs(
                F.coalesce(by_commas(fee_in_method, fee_in_method, fee_in_status, zero_fee), zero_fee)
            ).cast("decimal(18,2)"),
            "payment_method": F.coalesce(
                F.trim(by_commas(F.col("payment_method"), F.col("status"), packed(raw, 0), unknown)),
                unknown,
            ),
            "order_status": F.trim(by_commas(F.col("status"), packed(raw, 0), packed(raw, 1), nothing)),
            "amount": money(by_commas(raw, packed(raw, 1), packed(raw, 2), F.lit("0"))),
        }
    )


def shift_gift_card(df: DataFrame) -> DataFrame:
    """Move gift-card fields one column to the right and unpack the balances."""
    balances = F.col("current_balance")
    return df.select(
        "card_number",
        F.col("issue_date").alias("customer_id"),
        F.col("expiry_date").alias("issue_date"),
        F.col("initial_balance").alias("expiry_date"),
        packed(balances, 0, 3).alias("initial_balance"),
        packed(balances, 1, 3).alias("current_balance"),
        F.replace(packed(balances, 2, 3), F.lit('"'), F.lit("")).alias("transactions"),
    )


def split_rows(df: DataFrame, column: str, position: str = "position", value: str = "value") -> DataFrame:
    """One row per comma-separated piece, with its place counted from 1.

    A NULL field has no pieces; its row stays, once, with NULL place and piece.
    """
    return df.select("*", F.posexplode_outer(F.split(column, ",")).alias("_pos", value)).select(
        *df.columns, (F.col("_pos") + 1).cast("long").alias(position), value
    )
