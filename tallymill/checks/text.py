"""Pieces of DuckDB SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tallymill.functions.clean import BAD_DATE, VALID, Bands
from tallymill.plans.derive import raw_sql as raw
from tallymill.plans.lake import AS_OF

NOW = f"date '{AS_OF}'"


def lit(x) -> str:
    return "null" if x is None else "'" + x.replace("'", "''") + "'"


def words(items: Sequence[str]) -> str:
    return "(" + ", ".join(lit(i) for i in items) + ")"


def bands(expr: str, b: Bands) -> str:
    """One searched CASE for a set of bands."""
    whens = []
    for test, edge, label in b.items():
        cond = f"between {edge[0]} and {edge[1]}" if test == "between" else f"{test} {edge}"
        whens.append(f"when ({expr}) {cond} then {lit(label)}")
    return f"(case {' '.join(whens)} else {lit(b.otherwise)} end)"


def recode(expr: str, synonyms: Mapping[str, Sequence[str]], otherwise: str) -> str:
    whens = [f"when {expr} in {words(w)} then {lit(label)}" for label, w in synonyms.items()]
    return f"(case {' '.join(whens)} else {otherwise} end)"


def rules(pairs: Sequence[tuple[str, str]], ok: str = VALID) -> str:
    whens = [f"when {cond} then {lit(label)}" for label, cond in pairs]
    return f"(case {' '.join(whens)} else {lit(ok)} end)"


def undup(c: str) -> str:
    return f"split_part({c}, '-DUP', 1)"


def fixed(c: str, repl: str) -> str:
    return f"try_cast(if({c} = '{BAD_DATE}', '{repl}', {c}) as date)"


def num(c: str) -> str:
    return f"try_cast({c} as double)"


def whole(c: str) -> str:
    return f"try_cast({c} as bigint)"


def parts(d: str, p: str) -> str:
    return (
        f"year({d}) as {p}_year, month({d}) as {p}_month, quarter({d}) as {p}_quarter,"
        f" strftime({d}, '%Y-%m') as {p}_year_month"
    )


def dec(c: str, scale: int = 2) -> str:
    return f"try_cast({c} as decimal(14,{scale}))"


def rate(c: str) -> str:
    return f"try_cast({c} as decimal(6,4))"


def unread(*pairs: tuple[str, str]) -> str:
    """Text whose typed value is missing or NaN."""
    lost = (f"({raw} <> '' and ({typed} is null or cast({typed} as varchar) = 'nan'))" for raw, typed in pairs)
    return " or ".join(f"coalesce({x}, false)" for x in lost)


def readable(table: str, **types: str) -> str:
    """The raw rows of which every field parses, by column → type."""
    typed = {
        "int": "try_cast({0} as int)", "double": "try_cast({0} as double)", "date": f"if({{0}} = '{BAD_DATE}', date '2000-01-01', try_cast({{0}} as date))",
        "timestamp": "try_cast(replace({0}, 'T', ' ') as timestamp)",
    }
    given = {c: f"if({c} in ('n/a', 'NULL'), '', {c})" for c in types}
    return f"(select * from {raw(table)} where not ({unread(*((given[c], typed[k].format(c)) for c, k in types.items()))}))"


RETURNS = readable("returns_raw", return_date="date", quantity_returned="int", refund_amount="double")
LOYALTY = readable("loyalty_transactions_raw", date="date", points_earned="int", points_redeemed="int", points_balance="int")
LEDGER = readable("gl_transactions_raw", date="date", amount="double")
FEEDBACK = readable("feedback_raw", date="date", rating="int")
CRM = readable("crm_raw", feedback_score="double")
STAFF = readable("hr_raw", valid_from="date", valid_to="date", birth_date="date", hire_date="date", salary="int")
SERVICE = readable("service_interactions_raw", interaction_date="date", resolution_time_minutes="int", satisfaction_score="double")
FINANCE = readable(
    "store_daily_financials_raw", date="date", sales_kes="double", cost_of_goods_sold="double", gross_margin="double",
    operating_expenses="double", net_profit="double",
)
COUNTIES = readable("gis_counties_raw", population="int", avg_income_kes="int", latitude="double", longitude="double")
LOCATIONS = readable("gis_locations_raw", latitude="double", longitude="double", accessibility_score="double")
SHIFTS = readable("employee_shifts_raw", shift_date="date", hours_worked="double", overtime_hours="int")
CLOCK = readable("time_tracking_raw", timestamp="timestamp")
SNAPSHOTS = readable("inventory_snapshots_raw", snapshot_date="date", on_hand_quantity="int", reorder_point="double", safety_stock="int")
ECONOMY = readable(
    "economic_raw", gdp_growth_pct="double", inflation_pct="double", unemployment_pct="double", consumer_confidence="double",
    retail_sales_index="double", fuel_price_kes="double", usd_kes_rate="double",
)
PROMOTIONS = readable("promotions_raw", start_date="date", end_date="date", discount_value="double")
RECEIPTS = readable("goods_receipts_raw", receipt_date="date", quantity_received="int")
PURCHASES = readable("purchase_orders_raw", order_date="date", expected_delivery_date="date", total_amount="double")
STORES = readable("stores_raw", valid_from="date", valid_to="date", opening_date="date", closing_date="date", size_sqm="int")
SUPPLIERS = readable("suppliers_raw", valid_from="date", valid_to="date", lead_time_days="int")


def mean(total: str, n: str, places: int = 2) -> str:
    """Exact average of a decimal total, half up."""
    units = f"(2 * cast({total} * {10**places} as hugeint) + {n}) // nullif(2 * {n}, 0)"
    return f"cast({units} as double) / {10**places}"
