"""What each silver table holds, given the derived raw tables."""

from __future__ import annotations

from tallymill.checks.text import (
    CLOCK, COUNTIES, CRM, ECONOMY, FEEDBACK, FINANCE, LEDGER, LOCATIONS, LOYALTY, NOW, PROMOTIONS, PURCHASES, RECEIPTS,
    RETURNS, SERVICE, SHIFTS, SNAPSHOTS, STAFF, STORES, SUPPLIERS, bands, dec, fixed, lit, num, parts, rate, raw, recode, rules, undup, unread,
    whole, words,
)
from tallymill.functions.clean import UNREADABLE
from tallymill.plans import vocab as v
from tallymill.plans.lake import STORE_BRAND, STORE_CODE

_OLD = f"date '{v.OLDEST_PLAUSIBLE}'"
_LINE_AMOUNTS = (
    f"cast(round({dec('p')} * (1 - {rate('d')}) * cast(q as decimal(10,0)), 2) as double)",
    f"cast(round({dec('p')} * {rate('d')} * cast(q as decimal(10,0)), 2) as double)",
    f"cast(round({dec('p')} * (1 - {rate('d')}), 2) as double)",
)


_bare = "replace(regexp_replace(t, '^CMP[^,]*', ''), ',', '')"


def _line_flag(total: str, extra: list[tuple[str, str]]) -> str:
    return rules(
        [
            (UNREADABLE, "lost"),
            ("Invalid quantity", "q <= 0"),
            ("Invalid unit price", "p <= 0"),
            ("Invalid discount rate", "d not between 0 and 1"),
            ("Invalid line total", f"{total} <= 0"),
            *extra,
        ]
    )


def flagged_pos_lines() -> str:
    expect, off, net = _LINE_AMOUNTS
    return f"""
    with a as (
        select replace(transaction_id, ' ', '') as transaction_id, {whole("line_number")} as line_number,
               {undup("product_id")} as product_id, abs({whole("quantity")}) as q,
               round(abs({num("unit_price")}), 2) as p, abs({num("discount_rate")}) as d, line_total as t,
               {unread(("quantity", whole("quantity")), ("unit_price", dec(num("unit_price"))),
                       ("discount_rate", num("discount_rate")))} as gone
        from {raw("pos_line_items_raw")} where transaction_id <> '' and product_id is not null
    ), b as (
        select * exclude (t, gone), regexp_extract(t, '^(CMP[^,]*)', 1) as camp,
               abs({num(_bare)}) as line_total, gone or {unread((_bare, dec(num(_bare))))} as lost
        from a
    )
    select transaction_id, line_number, product_id, q as quantity, p as unit_price_kes, d as discount_rate,
           line_total, nullif(camp, '') as campaign_id, {expect} as calculated_line_total,
           {off} as discount_amount_kes, {net} as effective_unit_price_kes,
           {bands("d", v.DISCOUNT_TIERS)} as discount_tier, {bands("line_total", v.LINE_VALUE_TIERS)} as line_value_tier,
           case split_part(transaction_id, '-', 1) when 'TXN' then 'POS' else split_part(transaction_id, '-', 1) end
             as transaction_source,
           {_line_flag("line_total", [
               ("Line total mismatch",
                f"abs(try_cast({expect} as decimal(20,4)) - try_cast(line_total as decimal(20,4))) > 0.01"),
           ])} as quality_flag
    from b"""


def pos_line_items() -> str:
    return f"select * from ({flagged_pos_lines()}) where quality_flag = 'Valid'"


def pos_transactions() -> str:
    return f"""
    with a as (
        select replace(transaction_id, ' ', '') as transaction_id, {undup("store_id")} as store_id,
               coalesce({undup("customer_id")}, '{v.WALK_IN}') as customer_id, {undup("cashier_id")} as cashier_id,
               try_cast(substr(transaction_date, 1, 10) as date) as dt, substr(transaction_date, 12, 8) as tm,
               payment_method as pm, {num("total_amount")} as amt,
               {unread(("transaction_date", "try_cast(substr(transaction_date, 1, 10) as date)"),
                       ("total_amount", dec(num("total_amount"))))} as lost,
               case when customer_id is null then 'Walk-in (Unknown)'
                    when customer_id like '%-DUP%' then 'Registered (Needs merge)'
                    else 'Registered Customer' end as customer_type
        from {raw("pos_transactions_raw")} where transaction_id is not null
    ), l as (
        select transaction_id, cast(sum(cast(line_total as decimal(18,2))) as double) as line_total
        from ({pos_line_items()}) group by transaction_id
    ), f as (
        select a.*, cast(substr(tm, 1, 2) as bigint) as hr, l.line_total, {rules([
            (UNREADABLE, "lost"),
            ("Future date - Invalid", f"dt > {NOW}"),
            ("Suspicious old date", f"dt < {_OLD}"),
            ("Invalid amount", "amt <= 0"),
            ("Invalid payment method", f"pm not in {words(v.PAYMENT_WORDS)}"),
        ])} as quality_flag
        from a left join l using (transaction_id)
    )
    select transaction_id, store_id, customer_id, cashier_id, cast(dt as varchar) as transaction_date,
           tm as transaction_time, customer_type, {recode("pm", v.PAYMENT_METHODS, "'Other'")} as payment_method,
           {bands("amt", v.TRANSACTION_TIERS)} as transaction_tier, {bands("hr", v.DAY_TIMES)} as time_of_day,
           {parts("dt", "transaction")}, hr as transaction_hour, dayofweek(dt) + 1 as transaction_weekday_num,
           dayname(dt) as transaction_weekday, quality_flag, line_total
    from f where quality_flag not in ('Future date - Invalid', '{UNREADABLE}')"""


def ecommerce_orders() -> str:
    # regular expressions read the packed column from its end
    return f"""
    with d as (
        select distinct order_id, order_date, customer_id, delivery_address, payment_method as pm, status as st,
               total_amount as ta, string_split(total_amount, ',') as f
        from {raw("ecommerce_orders_raw")}
    ), s as (
        select *, len(f) as n, try_cast(replace(order_date, 'T', ' ') as timestamp) as ts,
               case len(f) when 1 then pm when 2 then pm when 3 then st end as fee,
               case len(f) when 1 then pm when 2 then st when 3 then f[1] end as method,
               case len(f) when 1 then st when 2 then f[1] when 3 then f[2] end as state,
               case when len(f) <= 3 then f[len(f)] end as money
        from d
    )
    select order_id, coalesce(cast(cast(ts as date) as varchar), '{v.EPOCH_PLACEHOLDER}') as order_date,
           coalesce(strftime(ts, '%H:%M:%S'), '00:00:00') as order_time,
           coalesce({undup("customer_id")}, 'Unknown') as customer_id,
           coalesce(trim(replace(delivery_address, '"', '')), 'Unknown') as delivery_address,
           cast(abs(coalesce(try_cast(fee as int), 0)) as double) as delivery_fee,
           coalesce(trim(method), 'Unknown') as payment_method, trim(state) as order_status,
           cast(abs(coalesce(try_cast(money as decimal(18,2)), 0)) as double) as amount
    from s"""


def flagged_web_lines() -> str:
    expect, off, net = _LINE_AMOUNTS
    return f"""
    with a as (
        select order_id, {whole("line_number")} as line_number, {undup("product_id")} as product_id,
               {whole("quantity")} as q, abs(round({num("unit_price")}, 2)) as p, abs({num("discount_rate")}) as d,
               abs(round({num("line_total")}, 2)) as line_total_kes,
               {unread(("quantity", whole("quantity")), ("unit_price", dec(num("unit_price"))),
                       ("discount_rate", num("discount_rate")), ("line_total", dec(num("line_total"))))} as lost
        from {raw("ecommerce_order_lines_raw")} where order_id is not null and product_id is not null
    )
    select order_id, line_number, product_id, q as quantity, p as unit_price_kes, d as discount_rate, line_total_kes,
           {expect} as calculated_line_total, {off} as discount_amount_kes, {net} as unit_price_after_discount_kes,
           {bands("d", v.DISCOUNT_TIERS)} as discount_tier, substr(order_id, 1, 4) as order_prefix,
           {whole("right(order_id, 8)")} as order_sequence_number, {_line_flag("line_total_kes", [])} as quality_flag
    from a"""


def ecommerce_order_lines() -> str:
    return f"select * from ({flagged_web_lines()}) where quality_flag = 'Valid'"


def returns(channel: str | None = None) -> str:
    sql = f"""
    select return_id, replace(original_transaction_id, ' ', '') as original_transaction_id,
           cast({fixed("return_date", v.CHRISTMAS_2023)} as varchar) as return_date, {undup("product_id")} as product_id,
           {whole("quantity_returned")} as quantity_returned, {num("refund_amount")} as refund_amount, return_reason,
           if(original_transaction_id like 'TXN%', 'POS', 'ECOMMERCE') as channel
    from {RETURNS} where return_id not like '%DUP' and original_transaction_id is not null"""
    return sql if channel is None else f"select * exclude (channel) from ({sql}) where channel = '{channel}'"


def gift_cards() -> str:
    bal = "regexp_extract(current_balance, '^([^,]*),([^,]*),(.*)$', {})"
    return f"""
    select card_number, issue_date as customer_id, expiry_date as issue_date, initial_balance as expiry_date,
           {bal.format(1)} as initial_balance, {bal.format(2)} as current_balance,
           replace({bal.format(3)}, '"', '') as transactions
    from {raw("gift_cards_raw")}"""


def gift_card_transactions() -> str:
    return f"""
    with t as (
        select *, split_part(type, ',', 1) = 'issue' as iss,
               row_number() over (partition by card_number order by date, transaction_id) as n
        from {raw("gift_card_transactions_raw")}
    )
    select transaction_id, card_number, cast(date as varchar) as date,
           {whole("amount")} * if(iss, 1, -1) as amount,
           case when not iss then 'redeem' when n = 1 then 'issue' else 'top_up' end as type,
           split_part(type, ',', 2) as linked_transaction_id
    from t"""


def crm() -> str:
    def cap(c: str) -> str:
        return f"trim(upper({c}[1]) || lower({c}[2:]))"

    return f"""
    with u as (
        select *, row_number() over (partition by customer_id
                  order by churn_date is not null, registration_date desc) as n
        from {CRM} where customer_id not like '%DUP%'
    ), c as (
        select *, cast(birth_date as date) as b, cast(registration_date as date) as r, cast(churn_date as date) as x,
               regexp_replace(phone, '[ +-]', '', 'g') as ph, trim(lower(replace(email, 'example', 'gmail'))) as em
        from u where n = 1
    ), k as (
        select *, year({NOW}) - year(b) as ag, coalesce(x, {NOW}) as till from c
    )
    select customer_id, {cap("first_name")} as first_name, {cap("last_name")} as last_name,
           {cap("first_name")} || ' ' || {cap("last_name")} as full_name,
           if((length(first_name) + length(last_name)) % 2 = 1, 'Male', 'Female') as gender,
           cast(b as varchar) as birth_date, ag as age, {bands("ag", v.AGE_BANDS)} as age_band,
           case when ph ~ '^2547.{{8}}$' then '0' || substr(ph, 4) when ph ~ '^7.{{8}}$' then '07' || ph
                when ph ~ '^1.{{8}}$' then '01' || ph else ph end as phone,
           em as email, {cap("county")} as county, {cap("town")} as town,
           if(customer_segment in {words(v.SEGMENTS)}, customer_segment, 'Standard') as customer_segment,
           if(acquisition_channel in {words(v.CHANNELS)}, acquisition_channel, 'Other') as acquisition_channel,
           cast(r as varchar) as registration_date, cast(x as varchar) as churn_date,
           if(loyalty_tier in {words(v.SEGMENTS)}, loyalty_tier, 'Bronze') as loyalty_tier,
           coalesce(communication_preferences, 'Email') as communication_preferences,
           cast(if(abs({num("feedback_score")}) < 1000, try_cast(feedback_score as decimal(5,2)), null) as double) as feedback_score,
           substr(ph, 1, 3) as phone_prefix, cast(regexp_full_match(ph, '[0-9]{{10,12}}') as bigint) as is_phone_valid,
           nullif(regexp_extract(em, '@(.*)$', 1), '') as email_domain,
           cast(coalesce(regexp_full_match(em, '.+@.{{2,}}[.].{{2,}}'), false) as bigint) as is_email_valid,
           cast(coalesce(x <= {NOW}, false) as bigint) as is_churned, till - r as tenure_days,
           datediff('month', r, till) as tenure_months, {bands("till - r", v.TENURE_BANDS)} as tenure_band,
           year(r) as registration_year, month(r) as registration_month, quarter(r) as registration_quarter
    from k"""


def suppliers() -> str:
    return f"""
    select supplier_id, cast({fixed("valid_from", v.NEW_YEAR_2016)} as varchar) as valid_from,
           cast(coalesce({fixed("valid_to", v.NEW_YEAR_2016)}, {NOW}) as varchar) as valid_to, supplier_name,
           coalesce(contact_person, supplier_name) as contact_person, replace(phone, '+254', '') as phone,
           replace(email, 'contact', lower(substr(supplier_name, 1, 2))) as email, payment_terms,
           {whole("lead_time_days")} as lead_time_days, category, tax_id
    from {SUPPLIERS} where supplier_id not like '%DUP'"""


def stores() -> str:
    def day(c: str) -> str:
        return fixed(c, v.CHRISTMAS_2023)

    return f"""
    with t as (
        select store_id, coalesce({day("valid_from")}, {NOW}) as vf, coalesce({day("valid_to")}, {NOW}) as vt,
               replace(store_name, '{STORE_BRAND}', '{STORE_CODE}') as store_name, county, format,
               {whole("size_sqm")} as size_sqm, cast({day("opening_date")} as varchar) as opening_date,
               cast(coalesce({day("closing_date")}, {NOW}) as varchar) as closing_date,
               if(is_active = 'TRUE', 'yes', 'no') as is_active
        from {STORES} where store_id not like '%DUP'
    )
    select row_number() over w as store_key, store_id, cast(vf as varchar) as valid_from,
           cast(vt as varchar) as valid_to, store_name, county,
           substr(store_name, {len(STORE_CODE) + 1}) as town, coalesce(format, lag(format) over w) as format,
           size_sqm, opening_date, closing_date, is_active
    from t window w as (order by store_id, vf, vt, store_name)"""


def products() -> str:
    def day(c: str) -> str:
        return f"coalesce({fixed(c, v.CHRISTMAS_2023)}, {NOW})"

    first = f"n = 1, date '{v.NEW_YEAR_2016}'"
    return f"""
    with t as (
        select * replace ({undup("product_id")} as product_id, {undup("supplier_id")} as supplier_id),
               row_number() over (partition by {undup("product_id")} order by valid_from) as n,
               {num("margin_percentage")} as m
        from {raw("products_raw")}
    )
    select product_id, product_name, brand, category, subcategory, supplier_id,
           {num("unit_cost_kes")} as unit_cost_kes, {num("retail_price_kes")} as retail_price_kes,
           m as margin_percentage, {bands("m", v.MARGIN_BANDS)} as margin_band,
           cast(if({first}, {day("introduction_date")}) as varchar) as introduction_date,
           cast(if({first}, {day("valid_from")}) as varchar) as valid_from, cast({day("valid_to")} as varchar) as valid_to,
           cast({day("discontinued_date")} as varchar) as discontinued_date, is_active,
           if(valid_to is null, 'yes', 'no') as is_current_version
    from t"""


def feedback() -> str:
    return f"""
    with t as (
        select feedback_id, {undup("customer_id")} as customer_id, cast(date as date) as d, {whole("rating")} as r,
               trim(category) as category
        from {FEEDBACK} where feedback_id is not null
    )
    select feedback_id as feedback_key, feedback_id, customer_id, cast(d as varchar) as feedback_date, r as rating,
           category, {parts("d", "feedback")}, {bands("r", v.RATING_LABELS)} as rating_label,
           {bands("r", v.SENTIMENTS)} as sentiment, cast(d > {NOW} as bigint) as is_future_dated,
           {rules([
               ("Missing category", "coalesce(category, '') = ''"),
               ("Future date", f"d > {NOW}"),
               ("Suspicious old date", f"d < {_OLD}"),
           ])} as quality_flag
    from t where r in (1, 2, 3, 4, 5)"""


def service_interactions() -> str:
    return f"""
    select interaction_id, {undup("customer_id")} as customer_id,
           cast({fixed("interaction_date", v.CHRISTMAS_2023)} as varchar) as interaction_date, channel, issue_type,
           {whole("resolution_time_minutes")} as resolution_time_minutes, {num("satisfaction_score")} as satisfaction_score
    from {SERVICE}"""


def loyalty_transactions() -> str:
    return f"""
    with t as (
        select transaction_id, {undup("customer_id")} as customer_id, order_id,
               {fixed("date", v.CHRISTMAS_2023)} as d, lower(trim(transaction_type)) as k,
               {whole("points_earned")} as e, abs({whole("points_redeemed")}) as s, {whole("points_balance")} as bal
        from {LOYALTY} where transaction_id is not null and customer_id is not null
    )
    select transaction_id as loyalty_transaction_key, transaction_id, customer_id, order_id,
           cast(d as varchar) as transaction_date, e as points_earned_raw, s as points_redeemed, bal as points_balance,
           {recode("k", v.EARN_WORDS, "if(e < 0, 'Adjustment (Negative)', 'Other')")} as transaction_type,
           case left(order_id, 4) when 'ORD-' then 'E-commerce order' when 'TXN-' then 'POS transaction'
                else if(coalesce(order_id, '') = '', 'No linked order', 'Unknown source') end as order_source_type,
           coalesce({bands("e", v.EARN_TIERS)}, if(s >= {v.BIG_REDEMPTION}, '{v.BIG_REDEMPTION_TIER}', '{v.NO_ACTIVITY}'))
             as points_activity_tier,
           coalesce({bands("bal", v.POINT_STATUS)}, case when bal < 0 then 'Negative balance - Data error'
                    when k = 'redeem' then 'Points exhausted' else 'No points' end) as customer_point_status,
           {parts("d", "transaction")},
           {rules([
               ("Negative earn - Possible adjustment", "e < 0 and k = 'earn' and s = 0"),
               ("Negative balance - Data error", "bal < 0"),
               ("Invalid transaction type", "k <> 'earn' and k <> 'redeem'"),
               ("Invalid redemption amount", "k = 'redeem' and s <= 0"),
               ("No points movement", "k = 'earn' and e <= 0 and s = 0"),
           ])} as quality_flag,
           if(k in {words(v.EARN_WORDS["Redeem"])}, -s, e) as points_change
    from t where d <= {NOW}"""


def competitor_quarterly() -> str:
    return f"""
    with t as (
        select competitor_id, quarter, {whole("split_part(market_share_pct, ',', 1)")} as revenue_kes,
               {num("split_part(market_share_pct, ',', 2)")} as market_share_pct
        from {raw("competitor_quarterly_raw")}
    )
    select row_number() over (order by quarter, competitor_id, revenue_kes, market_share_pct) as comp_qtr_key, * from t"""


def hr() -> str:
    def day(c: str) -> str:
        return fixed(c, v.CHRISTMAS_2023)

    def cap(c: str) -> str:
        return f"{c}[1] || lower({c}[2:])"

    return f"""
    with t as (
        select *, {day("birth_date")} as b, {day("hire_date")} as h from {STAFF} where employee_id not like '%DUP'
    ), k as (select *, year({NOW}) - year(b) as ag from t)
    select employee_id, cast(coalesce({day("valid_from")}, {NOW}) as varchar) as valid_from,
           cast(coalesce({day("valid_to")}, {NOW}) as varchar) as valid_to, {cap("first_name")} as first_name,
           {cap("last_name")} as last_name, gender, cast(b as varchar) as birth_date, cast(h as varchar) as hire_date,
           department, job_title, {whole("salary")} as salary, {undup("store_id")} as store_id, shift_pattern,
           if(valid_to is null, 'Active', 'Left') as employment_status,
           {cap("first_name")} || ' ' || {cap("last_name")} as full_name, ag as age, {bands("ag", v.AGE_BANDS)} as age_band,
           {NOW} - h as tenure_days, datediff('month', h, {NOW}) as tenure_months,
           {bands(f"{NOW} - h", v.TENURE_BANDS)} as tenure_band, year(h) as hire_year, month(h) as hire_month,
           quarter(h) as hire_quarter
    from k"""


def employee_shifts() -> str:
    return f"""
    select shift_id, employee_id, {undup("store_id")} as store_id,
           cast({fixed("shift_date", v.CHRISTMAS_2023)} as varchar) as shift_date, shift_type, start_time, end_time,
           {num("hours_worked")} as hours_worked, {whole("overtime_hours")} as overtime_hours
    from {SHIFTS}"""


def time_tracking() -> str:
    return f"""
    select event_id, employee_id, {undup("store_id")} as store_id,
           cast(cast(replace(timestamp, 'T', ' ') as timestamp) as varchar) as event_time,
           left(timestamp, 10) as event_date, event_type
    from {CLOCK}"""


def inventory_movements() -> str:
    return f"""
    with t as (
        select movement_id, {fixed("movement_date", v.OCTOBER_2022)} as d, {undup("store_id")} as store_id, product_id,
               upper(movement_type) as k, try_cast(quantity as decimal(18,4)) as q, {num("unit_cost_kes")} as cost
        from {raw("inventory_movements_raw")} where movement_date is not null and movement_id not like '%DUP'
    ), s as (
        select *, if(k in {words(v.OUTBOUND)}, -abs(q), abs(q)) as sq from t
    ), w as (
        select *, sum(sq) over (partition by product_id, store_id order by d, movement_id rows unbounded preceding) as rq,
               sum(sq) over (partition by product_id order by d, movement_id rows unbounded preceding) as cp,
               sum(q) over (partition by product_id order by d, movement_id rows unbounded preceding) as rw,
               sum(sq) over (partition by product_id order by d, movement_id
                             rows between 2 preceding and current row) as m3
        from s
    )
    select movement_id || '_' || strftime(d, '%Y%m%d') as inventory_movement_key, movement_id,
           cast(d as varchar) as movement_date, store_id, product_id, k as movement_type,
           cast(sq as double) as quantity, cast(abs(q) as double) as quantity_absolute, round(cost, 2) as unit_cost_kes,
           cast(round(cast(cost as decimal(12,4)) * abs(cast(q as decimal(12,4))), 2) as double) as movement_value_kes,
           cast(rq as double) as running_quantity, cast(cp as double) as cumulative_sum_by_product,
           cast(rq as double) as cumulative_sum_by_product_store, cast(rw as double) as running_total_raw_quantity,
           cast(m3 as double) as moving_sum_3_transactions, {bands("rq", v.STOCK_LEVELS)} as inventory_status,
           {bands("m3", v.DEMAND)} as demand_velocity, {parts("d", "movement")}, monthname(d) as movement_month_name,
           case when k in {words(v.OUTBOUND)} and q > 0 then 'Positive quantity for outbound'
                when k in {words(v.INBOUND)} and q < 0 then 'Negative quantity for inbound' else 'Valid sign' end
             as sign_validation_flag,
           {rules([
               ("Missing store", "coalesce(store_id, '') = ''"),
               ("Invalid movement type", f"k not in {words(v.OUTBOUND + v.INBOUND)}"),
               ("Zero/null quantity", "coalesce(q, 0) = 0"),
               ("Invalid unit cost", "coalesce(cost, 0) <= 0"),
               ("Negative inventory", "rq < 0"),
           ])} as quality_flag
    from w"""


def inventory_movements_slim() -> str:
    return f"""
    select movement_id, cast({fixed("movement_date", v.CHRISTMAS_2023)} as varchar) as movement_date,
           {undup("store_id")} as store_id, {undup("product_id")} as product_id, lower(movement_type) as movement_type,
           {whole("quantity")} as quantity, {num("unit_cost_kes")} as unit_cost_kes
    from {raw("inventory_movements_raw")}"""


def _snapshots() -> str:
    return f"""
    select {fixed("snapshot_date", v.CHRISTMAS_2023)} as d, {undup("store_id")} as store_id, product_id,
           {whole("on_hand_quantity")} as q, {num("reorder_point")} as p, {whole("safety_stock")} as s
    from {SNAPSHOTS}"""


def inventory_snapshots() -> str:
    return f"""
    select cast(d as varchar) as snapshot_date, store_id, product_id, q as on_hand_quantity, p as reorder_point,
           s as safety_stock, store_id || '_' || product_id || '_' || strftime(d, '%Y%m%d') as snapshot_key,
           q - p as stock_vs_reorder,
           case when q <= s then 'CRITICAL' when q <= p then 'WARNING' when q <= p * cast(1.2 as double) then 'CAUTION'
                else 'HEALTHY' end as stock_status,
           if(q <= p, p + s - q, 0) as suggested_reorder_quantity, {parts("d", "snapshot")},
           dayname(d) as snapshot_weekday,
           {rules([
               ("Negative stock", "q < 0"), ("Invalid reorder point", "p < 0"),
               ("Invalid safety stock", "s < 0"), ("Below reorder point", "q <= p"),
           ])} as quality_flag
    from ({_snapshots()})"""


def inventory_snapshots_slim() -> str:
    return f"""
    select cast(d as varchar) as snapshot_date, store_id, {undup("product_id")} as product_id,
           q as on_hand_quantity, p as reorder_point, s as safety_stock,
           row_number() over (order by d, store_id, product_id, q, p, s) as inventory_key
    from ({_snapshots()})"""


def purchase_orders() -> str:
    return f"""
    with t as (
        select po_number, {undup("supplier_id")} as supplier_id, status, {fixed("order_date", v.OCTOBER_2022)} as d,
               {fixed("expected_delivery_date", v.OCTOBER_2022)} as e, round({num("total_amount")}, 2) as amt
        from {PURCHASES} where po_number not like '%DUP'
    )
    select po_number, po_number as purchase_order_key, supplier_id, status, cast(d as varchar) as order_date,
           cast(e as varchar) as expected_delivery_date, amt as total_amount_kes,
           {recode("status", v.PO_STATUS, "'Unknown'")} as status_category, {parts("d", "order")},
           e - d as expected_lead_time_days, {NOW} - d as days_since_order, left(po_number, 2) as po_prefix,
           {whole("right(po_number, 8)")} as po_sequence_number,
           case status when 'Cancelled' then 'Cancelled - Investigate' when 'Closed' then 'Complete'
                when 'Open' then case when {NOW} - d > 30 then 'OVERDUE - Review'
                                      when {NOW} - d > 14 then 'Pending - Follow up' else 'Normal' end
                else 'Normal' end as action_priority,
           {rules([
               ("Invalid total amount", "amt <= 0"), ("Order date after expected delivery", "d > e"),
               ("Missing expected delivery date", "e is null"), ("Missing supplier", "coalesce(supplier_id, '') = ''"),
               ("Invalid status", "not (status = 'Closed' or status = 'Open' or status = 'Cancelled')"),
           ])} as quality_flag
    from t where d is not null"""


def purchase_order_lines() -> str:
    def scaled(f: str) -> str:
        return f"abs(cast(round({dec('t')} * cast({f} as decimal(4,2)), 2) as double))"

    return f"""
    with a as (
        select po_number, {whole("line_number")} as line_number, {undup("product_id")} as product_id,
               {whole("quantity_ordered")} as q, {num("unit_price")} as p, {num("line_total")} as t,
               {unread(("quantity_ordered", whole("quantity_ordered")), ("unit_price", dec(num("unit_price"))),
                       ("line_total", dec(num("line_total"))))} as lost
        from {raw("purchase_order_lines_raw")}
        where po_number not like '%DUP' and product_id is not null
    )
    select po_number || '_' || line_number as po_line_key, po_number, line_number, product_id,
           abs(q) as quantity_ordered, abs(p) as unit_price_kes, abs(t) as line_total_kes,
           cast((2 * abs(cast({dec("t")} * 100 as bigint)) + abs(q)) // nullif(2 * abs(q), 0) as double) / 100
             as calculated_unit_price,
           {scaled("1.10")} as landed_cost_kes, {scaled("0.16")} as estimated_vat_kes, left(po_number, 2) as po_prefix,
           {whole("right(po_number, 8)")} as po_sequence_number,
           {rules([
               (UNREADABLE, "lost"), ("Invalid quantity", "q <= 0"), ("Invalid unit price", "p <= 0"),
               ("Invalid line total", "t <= 0"), ("Line total mismatch", f"{dec('p')} * q <> {dec('t')}"),
           ])} as quality_flag
    from a"""


def goods_receipts() -> str:
    return f"""
    with t as (
        select receipt_id, upper(trim(po_number)) as po_number, product_id,
               {fixed("receipt_date", v.CHRISTMAS_2023)} as d, {whole("quantity_received")} as q,
               nullif(receiving_notes, 'NULL') as note
        from {RECEIPTS} where receipt_id is not null and po_number is not null
    )
    select receipt_id as receipt_key, receipt_id, po_number, product_id, cast(d as varchar) as receipt_date,
           q as quantity_received, coalesce(note, 'No issues recorded') as receiving_notes,
           case when note is null then 'No Issues Recorded'
                else coalesce((select min(label) from (values {', '.join(f'({lit(w)}, {lit(x)})' for w, x in v.NOTE_KINDS.items())})
                               k(word, label) where contains(note, word)), 'Other Issue') end as receipt_quality_category,
           cast(coalesce(note in {words(v.PROBLEM_NOTES)}, false) as bigint) as has_quality_issue, {parts("d", "receipt")},
           {rules([
               ("Future receipt date", f"d > {NOW}"), ("Suspicious old date", f"d < {_OLD}"),
               ("Missing product", "product_id is null"),
           ])} as quality_flag
    from t where q > 0"""


def promotions() -> str:
    return f"""
    with t as (
        select promotion_id, promotion_name, cast(start_date as date) as s, cast(end_date as date) as e,
               lower(trim(discount_type)) as k, {num("discount_value")} as val
        from {PROMOTIONS} where promotion_id is not null
    )
    select promotion_id as promotion_key, promotion_id, promotion_name,
           if(promotion_name like 'Promotion_%', promotion_name[11:], promotion_name) as promotion_short_name,
           cast(s as varchar) as start_date, cast(e as varchar) as end_date, val as discount_value,
           e - s as campaign_duration_days,
           case when s > {NOW} then 'Scheduled (Future)' when e < {NOW} then 'Completed (Past)'
                else 'Active (Ongoing)' end as promotion_status,
           {bands("e - s", v.CAMPAIGN_LENGTHS)} as campaign_length_tier,
           {recode("k", v.DISCOUNT_KINDS, "'Unknown Type'")} as discount_type, val as discount_amount_or_percent,
           if(k = 'fixed', 'KES ' || format('{{:,}}', cast(val as bigint)) || ' off', cast(val as bigint) || '% off')
             as discount_description,
           cast(s <= {NOW} and e >= {NOW} as bigint) as is_active, greatest(s - {NOW}, 0) as days_until_start,
           greatest({NOW} - e, 0) as days_since_ended, 'Valid' as quality_flag
    from t where s <= e and val > 0 and k in ('fixed', 'percentage')"""


def promotion_products() -> str:
    return f"""
    select promotion_id || '_' || product_id as promotion_product_key, promotion_id, product_id,
           if(product_id = '', 'Invalid record (no product)', 'Valid product promotion link') as record_type,
           {rules([
               ("Missing product - Invalid", "product_id = ''"), ("NULL value - Invalid", "contains(product_id, 'NULL')"),
           ])} as quality_flag
    from {raw("promotion_products_raw")} where promotion_id is not null and product_id <> 'NULL'"""


def campaigns() -> str:
    return f"""
    select campaign_id, campaign_name, campaign_type, channel, start_date, end_date,
           cast(end_date as date) - cast(start_date as date) as campaign_duration_days,
           {whole("budget_kes")} as budget_kes, {whole("actual_spend_kes")} as actual_spend_kes,
           {num("discount_rate")} as discount_rate
    from {raw("campaigns_raw")}"""


def gl_transactions() -> str:
    return f"""
    with t as (
        select *, lower(type) as k, cast(date as date) as d, {num("amount")} as a from {LEDGER}
    )
    select transaction_id as gl_transaction_key, transaction_id, account_code,
           split_part(account_code, '-', 1) as account_number, regexp_extract(account_code, '-(.*)$', 1) as account_name,
           {recode("account_code[1]", v.ACCOUNT_CLASSES, "'Other'")} as account_category, {undup("store_id")} as store_id,
           cast(d as varchar) as transaction_date, k as transaction_type, a as amount,
           if(k = 'debit', a, -a) as signed_amount_debit_view, if(k = 'credit', a, -a) as signed_amount_credit_view,
           {parts("d", "transaction")}, 'Valid' as quality_flag
    from t where a > 0 and k in ('debit', 'credit') and store_id is not null and account_code is not null"""


def store_daily_financials() -> str:
    m = ("sales_kes", "cost_of_goods_sold", "gross_margin", "operating_expenses", "net_profit")
    return f"select store_id, date, {', '.join(f'{num(c)} as {c}' for c in m)} from {FINANCE}"


def economic() -> str:
    m = ("gdp_growth_pct", "inflation_pct", "unemployment_pct", "consumer_confidence", "retail_sales_index",
         "fuel_price_kes", "usd_kes_rate")
    return f"""
    with t as (
        select county, cast(year_month || '-01' as date) as s, last_day(cast(year_month || '-01' as date)) as d,
               {', '.join(f'{num(c)} as {c}' for c in m)}
        from {ECONOMY}
    )
    select county, cast(d as varchar) as date, cast(s as varchar) as month_start_date, {', '.join(m)},
           county || '_' || strftime(d, '%Y%m') as economic_id, year(d) as calendar_year, month(d) as calendar_month,
           quarter(d) as calendar_quarter, 'Q' || quarter(d) || ' ' || year(d) as quarter_label, monthname(d) as month_name,
           round(retail_sales_index * (100.0 / (100 + inflation_pct)), 2) as real_retail_sales_index,
           round((100 - unemployment_pct) * 0.4 + consumer_confidence * 0.3 + (50 + gdp_growth_pct * 5) * 0.3, 2)
             as economic_health_score,
           {rules([
               ("Missing GDP", "gdp_growth_pct is null"), ("Invalid inflation", "inflation_pct not between 0 and 50"),
               ("Invalid unemployment", "unemployment_pct not between 0 and 100"),
               ("Invalid confidence", "consumer_confidence not between 0 and 100"),
               ("Invalid retail index", "retail_sales_index < 0"), ("Invalid fuel price", "fuel_price_kes <= 0"),
               ("Invalid exchange rate", "usd_kes_rate <= 0"),
           ])} as quality_flag,
           {rules([
               ("High Growth Alert", "gdp_growth_pct > 10"), ("Recession Alert", "gdp_growth_pct < -5"),
               ("Hyperinflation Alert", "inflation_pct > 20"), ("Currency Crisis Alert", "usd_kes_rate > 200"),
           ], "Normal Range")} as outlier_flag
    from t"""


def gis_counties() -> str:
    return (
        f"select county, {whole('population')} as population, {whole('avg_income_kes')} as avg_income_kes,"
        f" {num('latitude')} as latitude, {num('longitude')} as longitude from {COUNTIES}"
    )


def gis_locations() -> str:
    m = ", ".join(f"{num(c)} as {c}" for c in ("latitude", "longitude", "accessibility_score"))
    return f"select county, location_id, location_name, location_type, {m} from {LOCATIONS}"


SQL = {
    "competitors": f"select competitor_id, competitor_name from {raw('competitors_raw')}",
    "competitor_stores": f"select * from {raw('competitor_stores_raw')}",
    "competitor_quarterly": competitor_quarterly(),
    "crm": crm(),
    "feedback": feedback(),
    "service_interactions": service_interactions(),
    "gl_transactions": gl_transactions(),
    "store_daily_financials": store_daily_financials(),
    "gis_counties": gis_counties(),
    "gis_locations": gis_locations(),
    "employee_shifts": employee_shifts(),
    "hr": hr(),
    "time_tracking": time_tracking(),
    "inventory_movements": inventory_movements(),
    "inventory_movements_slim": inventory_movements_slim(),
    "inventory_snapshots": inventory_snapshots(),
    "inventory_snapshots_slim": inventory_snapshots_slim(),
    "loyalty_transactions": loyalty_transactions(),
    "economic": economic(),
    "campaigns": campaigns(),
    "promotions": promotions(),
    "promotion_products": promotion_products(),
    "goods_receipts": goods_receipts(),
    "purchase_orders": purchase_orders(),
    "purchase_order_lines": purchase_order_lines(),
    "products": products(),
    "ecommerce_orders": ecommerce_orders(),
    "ecommerce_order_lines": ecommerce_order_lines(),
    "gift_cards": gift_cards(),
    "gift_card_transactions": gift_card_transactions(),
    "pos_line_items": pos_line_items(),
    "pos_transactions": pos_transactions(),
    "pos_returns": returns("POS"),
    "ecomerce_returns": returns("ECOMMERCE"),
    "returns": returns(),
    "stores": stores(),
    "suppliers": suppliers(),
}
