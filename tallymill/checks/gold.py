"""What the gold tables and marts hold, stated over the silver statements."""

from __future__ import annotations

from tallymill.checks import silver
from tallymill.checks.text import NOW, bands, dec, mean
from tallymill.plans import vocab as v
from tallymill.plans.lake import AS_OF

S = silver.SQL


def t(name: str) -> str:
    return f"({S[name]})"


def dim_date() -> str:
    columns = {
        "campaigns": "start_date", "crm": "registration_date", "ecommerce_orders": "order_date", "economic": "date",
        "feedback": "feedback_date", "gl_transactions": "transaction_date", "goods_receipts": "receipt_date",
        "inventory_movements_slim": "movement_date", "inventory_snapshots": "snapshot_date",
        "loyalty_transactions": "transaction_date", "pos_transactions": "transaction_date",
        "returns": "return_date", "service_interactions": "interaction_date",
    }
    every = " union ".join(f"select cast({c} as date) as d from {t(n)}" for n, c in columns.items())
    return calendar(every)


def calendar(days: str) -> str:
    """Calendar columns for a statement that yields days as ``d``."""
    return f"""
    select cast(strftime(d, '%Y%m%d') as bigint) as date_id, cast(d as varchar) as date, dayofweek(d) + 1 as day_of_week,
           dayname(d) as day_name, strftime(d, '%a') as day_name_short, day(d) as day_of_month,
           dayofyear(d) as day_of_the_year, cast(strftime(d, '%U') as bigint)
             + if(dayofweek(date_trunc('year', d)) = 0, 0, 1) as week_of_year,
           month(d) as month, monthname(d) as month_name, strftime(d, '%b') as month_name_short,
           cast(cast(date_trunc('month', d) as date) as varchar) as year_month, quarter(d) as quarter,
           'Q' || quarter(d) || ' ' || year(d) as quarter_name, year(d) as year,
           if(month(d) < 7, (year(d) - 1) || '/' || year(d), year(d) || '/' || (year(d) + 1)) as fiscal_year,
           (quarter(d) + 1) % 4 + 1 as fiscal_quarter, if(dayofweek(d) in (0, 6), 'yes', 'no') as is_weekend
    from ({days}) where d is not null"""


def dim_campaign() -> str:
    return f"""
    select row_number() over (order by campaign_id) as campaign_sk, *,
           if(budget_kes = 0, null, cast(actual_spend_kes as double) / budget_kes * 100) as budget_utilisation_pct
    from {t("campaigns")}"""


_born = "year(cast(birth_date as date))"


def dim_customers() -> str:
    born = _born
    return f"""
    select row_number() over (order by registration_date, customer_id) as customer_sk, * exclude (county),
           if({born} between {v.YOUNGEST_FROM} and {AS_OF.year}, '{v.YOUNGEST_GENERATION}', {bands(born, v.GENERATIONS)})
             as generation
    from {t("crm")}"""


def dim_employee() -> str:
    return f"""
    select row_number() over (order by employee_id, valid_from, valid_to) as employee_sk,
           * replace (coalesce(store_id, 'HQ') as store_id), last_name || ', ' || first_name as display_name,
           if({_born} between {v.YOUNGEST_FROM} and {AS_OF.year}, '{v.YOUNGEST_GENERATION}', {bands(_born, v.GENERATIONS)})
             as generation,
           tenure_days // 365 as tenure_years, {AS_OF.year} - hire_year as years_since_hire,
           hire_year || '-Q' || hire_quarter as hire_cohort
    from {t("hr")}"""


def _earliest(table: str, key: str, order: tuple[str, ...], rest: tuple[str, ...]) -> str:
    """The first row per key, nulls last, ties by the other columns."""
    by = ", ".join(f"{c} nulls last" for c in (*order, *rest))
    return f"""
    select {", ".join((key, *order, *rest))} from {t(table)}
    qualify row_number() over (partition by {key} order by {by}) = 1"""


def pos_heads() -> str:
    rest = ("store_id", "customer_id", "cashier_id", "payment_method")
    return _earliest("pos_transactions", "transaction_id", ("transaction_date", "transaction_time"), rest)


def web_heads() -> str:
    rest = ("customer_id", "delivery_address", "delivery_fee", "payment_method", "order_status")
    return _earliest("ecommerce_orders", "order_id", ("order_date", "order_time"), rest)


def po_heads() -> str:
    return _earliest("purchase_orders", "po_number", ("order_date", "expected_delivery_date"), ("supplier_id", "status"))


def receipts_per_line() -> str:
    return f"""
    select po_number, product_id, min(receipt_date) as first_receipt_date, max(receipt_date) as last_receipt_date,
           cast(sum(quantity_received) as bigint) as quantity_received
    from {t("goods_receipts")} group by all"""


def card_owners() -> str:
    return f"select card_number, min(customer_id) as customer_id from {t('gift_cards')} group by 1"


def sale_origins() -> str:
    return f"""
    select transaction_id, min(store_id) as store_id, min(customer_id) as customer_id
    from (select transaction_id, store_id, customer_id from {t("pos_transactions")}
          union all select order_id, null, customer_id from {t("ecommerce_orders")}) group by 1"""


def dim_supplier() -> str:
    return f"""
    select row_number() over (order by supplier_id, valid_from, valid_to) as supplier_key, * from {t("suppliers")}"""


def dim_product() -> str:
    return f"""
    select row_number() over (order by product_id, valid_from, valid_to, product_name, unit_cost_kes) as product_sk, *
    from {t("products")}"""


def dim_geography_economic() -> str:
    return f"""
    with e as (select *, rank() over (partition by county order by date desc) as n from {t("economic")})
    select row_number() over (order by c.county) as geo_sk, c.*, gdp_growth_pct, inflation_pct, unemployment_pct,
           consumer_confidence, retail_sales_index, fuel_price_kes, usd_kes_rate, date as economic_as_of_date
    from {t("gis_counties")} c left join e on e.county = c.county and n = 1"""


def cust_county() -> str:
    return f"""
    with n as (
        select customer_id, store_id, count(*) as n from {t("pos_transactions")}
        where customer_id <> '{v.WALK_IN}' group by all
    ), h as (
        select *, row_number() over (partition by customer_id order by n desc, store_id) as r from n
    )
    select customer_id, h.store_id as primary_store_id, c.home_county
    from h left join (select store_id, max_by(county, valid_from) as home_county from {t("stores")} group by 1) c
      on c.store_id = h.store_id where r = 1"""


def periods(dim: str, key: str, sk: str, payload: str) -> str:
    """Day by day the winning version, folded back into periods."""
    return f"""
    with v as (
        select {key}, cast(valid_from as date) as f, cast(valid_to as date) as u, {sk}{payload} from ({dim})
    ), b as (
        select distinct {key}, f as day from v union select distinct {key}, u + 1 from v
    ), w as (
        select b.{key}, b.day, v.{sk}{payload.replace(", ", ", v.")},
               row_number() over (partition by b.{key}, b.day order by f desc, v.{sk}) as r
        from b left join v on v.{key} = b.{key} and b.day between v.f and v.u
    ), c as (
        select *, lag({sk}) over x as prev, row_number() over x as i from w where r = 1
        window x as (partition by {key} order by day)
    ), e as (
        select *, lead(day) over (partition by {key} order by day) - 1 as until
        from c where i = 1 or prev is distinct from {sk}
    )
    select {key}, cast(day as varchar) as valid_from, cast(until as varchar) as valid_to, {sk}{payload}
    from e where {sk} is not null"""


def bridge_product() -> str:
    return periods(dim_product(), "product_id", "product_sk", ", supplier_id, unit_cost_kes")


def bridge_store() -> str:
    return periods(S["stores"], "store_id", "store_key", ", county")


def _match(facts: str, key: str, day: str, dim: str, sk: str, payload: str) -> str:
    """Facts with the version valid on their day, by ranking every match per fact."""
    return f"""
    select * exclude (_i, _r, _k, _f, _s) from (
        select f.*, {payload}, d.{key} as _k, d.valid_from as _f, d.{sk} as _s,
               row_number() over (partition by f._i order by d.valid_from desc, d.{sk}) as _r
        from (select *, row_number() over () as _i from ({facts})) f
        left join ({dim}) d on d.{key} = f.{key} and f.{day} between d.valid_from and d.valid_to
    ) where _r = 1"""


_POS_HEADS = f"""
    select transaction_id, store_id, customer_id, cashier_id, payment_method, transaction_date, transaction_time
    from {t("pos_transactions")}
    qualify row_number() over (partition by transaction_id order by transaction_date, transaction_time) = 1"""
_WEB_HEADS = f"""
    select order_id, customer_id, order_date, order_time, delivery_address, delivery_fee, payment_method, order_status
    from {t("ecommerce_orders")}
    qualify row_number() over (partition by order_id order by order_date, order_time) = 1"""


def fact_pos_sales() -> str:
    facts = f"select l.*, h.* exclude (transaction_id) from {t('pos_line_items')} l left join ({_POS_HEADS}) h using (transaction_id)"
    m = _match(facts, "product_id", "transaction_date", dim_product(), "product_sk", "d.supplier_id, d.unit_cost_kes")
    return f"""
    select transaction_id, store_id, customer_id, cashier_id, product_id, supplier_id, cast(null as varchar) as delivery_address,
           payment_method, 'delivered' as order_status, cast(0 as double) as delivery_fee, transaction_date,
           transaction_time, line_number, quantity, unit_price_kes, discount_rate, discount_amount_kes,
           effective_unit_price_kes as unit_price_after_discount_kes, line_total, unit_cost_kes, campaign_id
    from ({m})"""


def _web() -> str:
    facts = f"select l.*, h.* exclude (order_id) from {t('ecommerce_order_lines')} l left join ({_WEB_HEADS}) h using (order_id)"
    m = _match(facts, "product_id", "order_date", dim_product(), "product_sk", "d.supplier_id, d.unit_cost_kes")
    return f"select m.*, c.primary_store_id as store_id from ({m}) m left join ({cust_county()}) c using (customer_id)"


def fact_ecommerce_sales() -> str:
    return f"""
    select order_id as transaction_id, store_id, customer_id, cast(null as varchar) as cashier_id, product_id, supplier_id,
           delivery_address, payment_method, order_status, delivery_fee, order_date as transaction_date,
           order_time as transaction_time, line_number, quantity, unit_price_kes, discount_rate, discount_amount_kes,
           unit_price_after_discount_kes, line_total_kes as line_total, unit_cost_kes,
           cast(null as varchar) as campaign_id
    from ({_web()})"""


def fact_sales() -> str:
    return f"select * from ({fact_pos_sales()}) union all by name select * from ({fact_ecommerce_sales()})"


def ecommerce_fact_sales() -> str:
    return f"""
    select row_number() over (order by order_date, order_id, line_number, product_id, quantity, unit_price_kes,
                              discount_rate, line_total_kes) as order_line_key,
           order_id, line_number, product_id, supplier_id, customer_id, store_id, order_date, order_time, delivery_address,
           delivery_fee, payment_method, order_status, quantity, unit_cost_kes, unit_price_kes, discount_rate,
           unit_price_after_discount_kes, discount_amount_kes, line_total_kes, discount_tier
    from ({_web()})"""


def _dated(sql: str, day: str, name: str = "date_id") -> str:
    return f"select *, cast(replace({day}, '-', '') as bigint) as {name} from ({sql})"


def fact_returns() -> str:
    heads = f"""
        select transaction_id, min(store_id) as store_id, min(customer_id) as customer_id from (
            select transaction_id, store_id, customer_id from {t("pos_transactions")}
            union all select order_id, null, customer_id from {t("ecommerce_orders")}
        ) group by 1"""
    m = _match(_dated(S["returns"], "return_date"), "product_id", "return_date", dim_product(), "product_sk", "d.product_sk")
    return f"""
    select m.*, h.store_id, h.customer_id from ({m}) m left join ({heads}) h on h.transaction_id = m.original_transaction_id"""


def fact_inventory_movements() -> str:
    one = _match(_dated(S["inventory_movements"], "movement_date"), "product_id", "movement_date", dim_product(),
                 "product_sk", "d.product_sk")
    return _match(one, "store_id", "movement_date", S["stores"], "store_key", "d.store_key")


def fact_gift_card() -> str:
    return f"""
    select f.*, c.customer_id from ({_dated(S["gift_card_transactions"], "date")}) f
    left join (select card_number, min(customer_id) as customer_id from {t("gift_cards")} group by 1) c using (card_number)"""


def fact_time_attendance() -> str:
    return _match(_dated(S["time_tracking"], "event_date"), "employee_id", "event_date", dim_employee(), "employee_sk",
                  "d.employee_sk, d.department")


def fact_procurement() -> str:
    base = f"""
    select l.*, o.supplier_id, o.status, o.order_date, o.expected_delivery_date, r.first_receipt_date,
           r.last_receipt_date, r.quantity_received
    from {t("purchase_order_lines")} l
    left join (select * from {t("purchase_orders")}
               qualify row_number() over (partition by po_number order by order_date) = 1) o using (po_number)
    left join (select po_number, product_id, min(receipt_date) as first_receipt_date,
                      max(receipt_date) as last_receipt_date, cast(sum(quantity_received) as bigint) as quantity_received
               from {t("goods_receipts")} group by all) r using (po_number, product_id)"""
    day = "cast({} as date)".format
    for c, n in (("order_date", "order_date_id"), ("expected_delivery_date", "expected_date_id"),
                 ("last_receipt_date", "receipt_date_id")):
        base = _dated(base, c, n)
    return f"""
    select *, {day("last_receipt_date")} - {day("order_date")} as actual_lead_time_days,
           {day("last_receipt_date")} - {day("expected_delivery_date")} as lead_time_variance_days,
           cast(last_receipt_date <= expected_delivery_date as bigint) as is_on_time
    from ({base})"""


def agg_store_financials() -> str:
    m = ("sales_kes", "cost_of_goods_sold", "gross_margin", "operating_expenses", "net_profit")
    sums = ", ".join(f"cast(sum({dec(c)}) as double) as {c}" for c in m)
    return f"select store_id, date, {sums} from {t('store_daily_financials')} group by all"


def agg_inventory_snapshot() -> str:
    return f"""
    select product_id, store_id, snapshot_date, cast(sum(on_hand_quantity) as bigint) as on_hand_quantity,
           max(reorder_point) as reorder_point, max(safety_stock) as safety_stock,
           cast(bool_or(on_hand_quantity <= 0) as bigint) as is_stockout
    from {t("inventory_snapshots")} group by all"""


def agg_competitor_benchmark() -> str:
    return f"""
    with q as (
        select competitor_id, quarter, cast(sum(revenue_kes) as bigint) as revenue_kes, avg(market_share_pct) as market_share_pct
        from {t("competitor_quarterly")} group by all
    )
    select q.*, competitor_name,
           round(revenue_kes * 100.0 / sum(revenue_kes) over (partition by quarter), 4)::double as revenue_share_pct
    from q left join {t("competitors")} using (competitor_id)"""


def _ratio(a: str, b: str, places: int = 4) -> str:
    return f"round(cast({a} as double) / nullif(cast({b} as double), 0), {places})"


def mart_sales() -> str:
    cost = f"sum(cast(quantity as decimal(10,0)) * {dec('unit_cost_kes')})"
    return f"""
    with f as (
        select transaction_date[:7] as year_month, count(distinct coalesce(transaction_id, '')) as n_orders,
               count(*) as n_lines, sum(cast(line_total as decimal(18,2))) as rev, coalesce({cost}, 0) as cost
        from ({fact_sales()}) group by 1
    ), r as (
        select return_date[:7] as year_month, sum(cast(refund_amount as decimal(18,2))) as back from {t("returns")} group by 1
    )
    select f.year_month, n_orders, n_lines, cast(rev as double) as revenue, cast(coalesce(back, 0) as double) as refunds,
           {mean("rev", "n_orders")} as avg_order_value, {_ratio("rev - cost", "rev")} as gross_margin,
           {_ratio("coalesce(back, 0)", "rev")} as return_rate
    from f left join r on r.year_month is not distinct from f.year_month
    union all
    select year_month, 0, 0, 0.0, cast(coalesce(back, 0) as double), null, null, null
    from r where not exists (select 1 from f where f.year_month is not distinct from r.year_month)"""


def mart_campaign_roi() -> str:
    return f"""
    select campaign_id, actual_spend_kes, cast(coalesce(rev, 0) as double) as revenue,
           {_ratio("coalesce(rev, 0) - actual_spend_kes", "actual_spend_kes")} as roi
    from {t("campaigns")} left join (
        select campaign_id, sum(cast(line_total as decimal(18,2))) as rev from {t("pos_line_items")} group by 1
    ) using (campaign_id)"""


def mart_customer() -> str:
    return f"""
    with p as (
        select customer_id, sum(greatest(points_earned_raw, 0)) as e, sum(points_redeemed) as s
        from {t("loyalty_transactions")} group by 1
    ), r as (
        select customer_id, sum(case rating when 5 then 1 when 4 then 0 else -1 end) as net, count(rating) as n
        from {t("feedback")} group by 1
    )
    select customer_segment, count(*) as n_customers, cast(sum(1 - is_churned) as bigint) as n_active,
           {_ratio("sum(is_churned)", "count(*)")} as churn_rate,
           round(cast(coalesce(sum(net), 0) as double) * 100 / nullif(sum(n), 0), 2) as nps,
           {_ratio("coalesce(sum(s), 0)", "coalesce(sum(e), 0)")} as redemption_rate
    from {t("crm")} left join p using (customer_id) left join r using (customer_id) group by 1"""


def mart_supply() -> str:
    return f"""
    select supplier_id, count(*) as n_lines, count(lead_time_variance_days) as n_received,
           {_ratio("coalesce(sum(is_on_time), 0)", "count(lead_time_variance_days)")} as on_time_rate,
           round(avg(lead_time_variance_days), 4) as avg_lead_time_variance,
           round(stddev_samp(lead_time_variance_days), 4) as sd_lead_time_variance
    from ({fact_procurement()}) group by 1"""


def mart_stock() -> str:
    return f"""
    with m as (
        select product_id, sum(cast(quantity_absolute as decimal(18,2))) as sold from {t("inventory_movements")}
        where movement_type = 'SALE' group by 1
    ), a as (
        select product_id, count(*) as n_snapshots, cast(sum(is_stockout) as bigint) as n_stockouts,
               avg(on_hand_quantity) as mean
        from ({agg_inventory_snapshot()}) group by 1
    )
    select a.product_id, n_snapshots, n_stockouts, cast(coalesce(sold, 0) as double) as units_sold,
           {_ratio("coalesce(sold, 0)", "mean")} as turnover
    from a left join m using (product_id)"""


def mart_finance() -> str:
    return f"""
    with b as (
        select store_id, sum({dec("sales_kes")}) as rev, sum({dec("net_profit")}) as net
        from {t("store_daily_financials")} group by 1
    ), z as (select store_id, max_by(size_sqm, valid_from) as sqm from {t("stores")} group by 1)
    select store_id, cast(rev as double) as revenue, cast(net as double) as net_profit,
           {_ratio("net", "rev")} as operating_margin, {mean("rev", "sqm")} as revenue_per_sqm
    from b left join z using (store_id)"""


def mart_workforce() -> str:
    return f"""
    with c as (select employee_sk, count(*) as n from ({fact_time_attendance()}) group by 1)
    select department, count(*) as headcount, {_ratio("count(*) filter (gender = 'Female')", "count(*)")} as female_share,
           {_ratio(f"count(*) filter ({NOW} - cast(hire_date as date) < 365)", "count(*)")} as retention_risk,
           {_ratio("coalesce(sum(n), 0)", "count(*)")} as events_per_head
    from ({dim_employee()}) left join c using (employee_sk) where employment_status = 'Active' group by 1"""


SQL = {
    "dim_date": dim_date(),
    "dim_campaign": dim_campaign(),
    "dim_customers": dim_customers(),
    "dim_employee": dim_employee(),
    "dim_store": S["stores"],
    "dim_supplier": dim_supplier(),
    "dim_product": dim_product(),
    "dim_geography_economic": dim_geography_economic(),
    "bridge_product": bridge_product(),
    "bridge_store": bridge_store(),
    "bridge_employee": periods(dim_employee(), "employee_id", "employee_sk", ", department"),
    "cust_county": cust_county(),
    "fact_pos_sales": fact_pos_sales(),
    "fact_ecommerce_sales": fact_ecommerce_sales(),
    "fact_sales": fact_sales(),
    "ecommerce_fact_sales": ecommerce_fact_sales(),
    "fact_returns": fact_returns(),
    "fact_loyalty": _dated(S["loyalty_transactions"], "transaction_date"),
    "fact_inventory_movements": fact_inventory_movements(),
    "fact_customer_experience": _dated(S["feedback"], "feedback_date"),
    "fact_gift_card": fact_gift_card(),
    "fact_time_attendance": fact_time_attendance(),
    "fact_procurement": fact_procurement(),
    "agg_store_financials": agg_store_financials(),
    "agg_inventory_snapshot": agg_inventory_snapshot(),
    "agg_competitor_benchmark": agg_competitor_benchmark(),
    "pos_heads": pos_heads(),
    "web_heads": web_heads(),
    "po_heads": po_heads(),
    "receipts_per_line": receipts_per_line(),
    "card_owners": card_owners(),
    "sale_origins": sale_origins(),
    "mart_sales": mart_sales(),
    "mart_campaign_roi": mart_campaign_roi(),
    "mart_customer": mart_customer(),
    "mart_supply": mart_supply(),
    "mart_stock": mart_stock(),
    "mart_finance": mart_finance(),
    "mart_workforce": mart_workforce(),
}
