"""What each operator query returns."""

from __future__ import annotations

from tallymill.checks import silver
from tallymill.checks.gold import calendar
from tallymill.checks.text import NOW, bands, dec, fixed, mean, num, raw, rules, undup
from tallymill.plans import vocab as v

S = silver.SQL
_RATE = "cast(l_discount as decimal(4,2))"
_NET = f"{dec('l_extendedprice')} * (1 - {_RATE})"
_CHANGES = """
    select l_partkey, cast(date_trunc('year', l_shipdate) as date) as f, min(l_extendedprice) as unit_cost,
           min(l_suppkey) as l_suppkey
    from lineitem group by 1, 2"""
_VERSIONS = f"""
    select l_partkey, f, coalesce(lead(f) over (partition by l_partkey order by f), {NOW}) as u,
           year(f) as version_no, unit_cost
    from ({_CHANGES})"""
_ASOF = f"""
    select l.*, cast(o_orderdate as date) as order_date, v.version_no, v.unit_cost
    from (select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount,
                 row_number() over () as i from lineitem) l
    left join orders on o_orderkey = l_orderkey
    left join ({_VERSIONS}) v on v.l_partkey = l.l_partkey and cast(o_orderdate as date) between v.f and v.u
    qualify row_number() over (partition by i order by v.f desc) = 1"""
_LEDGER = """
    select event_id, user_id, event_type,
           if(event_type in ('click', 'error'), -1, 1) * cast(value as decimal(14,2)) as change
    from events"""
_CHANGE = "cast(change as double) as change"

_email = "trim(lower(replace(email, 'example', 'gmail')))"
_phone = "regexp_replace(phone, '[ +-]', '', 'g')"


def _phone_case(seven: str, one: str) -> str:
    return (
        f"case when regexp_full_match(ph, '2547.{{8}}') then '0' || substr(ph, 4)"
        f" when regexp_full_match(ph, '7.{{8}}') then '{seven}' || ph"
        f" when regexp_full_match(ph, '1.{{8}}') then '{one}' || ph else ph end"
    )


SQL = {
    "calendar": calendar(
        "select cast(o_orderdate as date) as d from orders union select cast(l_shipdate as date) from lineitem"
        " union select cast(ts as date) from events"
    ),
    "scd2_versions": f"""
        select l_partkey, cast(f as varchar) as valid_from, unit_cost, l_suppkey,
               cast(coalesce(lead(f) over w - 1, {NOW}) as varchar) as valid_to,
               if(lead(f) over w is null, 'yes', 'no') as is_current_version, p_name, p_brand
        from ({_CHANGES}) join part on p_partkey = l_partkey
        window w as (partition by l_partkey order by f)""",
    "first_version_opened": f"""
        select l_partkey, unit_cost, l_suppkey, cast(lead(f) over w - 1 as varchar) as valid_to,
               if(row_number() over w = 1, '{v.NEW_YEAR_2016}', cast(f as varchar)) as valid_from
        from ({_CHANGES}) window w as (partition by l_partkey order by f)""",
    "bridge_part": f"""
        select l_partkey, cast(f as varchar) as valid_from, version_no, unit_cost,
               cast(if(lead(f) over w is null, u, lead(f) over w - 1) as varchar) as valid_to
        from ({_VERSIONS}) window w as (partition by l_partkey order by f)""",
    "asof_line_cost": f"select * exclude (i) replace (cast(order_date as varchar) as order_date, cast(l_linenumber as bigint) as l_linenumber) from ({_ASOF})",
    "revenue_by_month": f"""
        select strftime(order_date, '%Y-%m') as year_month, count(*) as n_lines, count(version_no) as n_priced,
               cast(round(sum({_NET}), 2) as double) as revenue, cast(sum({dec("unit_cost")}) as double) as version_cost
        from ({_ASOF}) group by 1""",
    "fact_sales_union": f"""
        select 'LINE' as channel, l_orderkey as sale_id, l_partkey as part_key, cast(null as bigint) as user_id,
               cast(cast(l_shipdate as date) as varchar) as sale_date, cast(round({_NET}, 2) as double) as amount
        from lineitem
        union all
        select 'EVENT', event_id, null, user_id, cast(cast(ts as date) as varchar), value
        from events where event_type = 'purchase'""",
    "order_totals_vs_lines": f"""
        with l as (
            select l_orderkey, sum({dec("l_extendedprice")}) as t, count(*) as n from lineitem group by 1
        )
        select o_orderkey, o_totalprice, cast(t as double) as line_total, n as n_lines,
               {rules([("No lines", "t is null"), ("Total mismatch", f"abs({dec('o_totalprice')} - t) > 0.01")])} as quality_flag
        from orders left join l on l_orderkey = o_orderkey""",
    "line_mismatch_flag": f"""
        select l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
               cast(round({_NET} * cast(l_quantity as decimal(6,0)), 2) as double) as calculated_line_total,
               cast(round({dec("l_extendedprice")} * {_RATE} * cast(l_quantity as decimal(6,0)), 2) as double) as discount_amount,
               cast(round({_NET}, 2) as double) as net_price,
               {rules([("Invalid quantity", "l_quantity <= 0"), ("Large order", "l_quantity >= 45"),
                       ("Deep discount", f"{_RATE} >= 0.09")])} as quality_flag
        from lineitem""",
    "discount_tier": f"""
        select {bands(_RATE, v.DISCOUNT_TIERS)} as discount_tier, count(*) as n,
               cast(sum({dec("l_extendedprice")}) as double) as amount
        from lineitem group by 1""",
    "value_tier": f"select o_orderkey, {bands('o_totalprice', v.TRANSACTION_TIERS)} as transaction_tier from orders",
    "time_of_day": f"""
        select event_id, strftime(ts, '%H:%M:%S') as event_time, {bands("hour(ts)", v.DAY_TIMES)} as time_of_day from events""",
    "running_balance": f"""
        select event_id, user_id, event_type, {_CHANGE},
               cast(sum(change) over (partition by user_id order by event_id) as double) as balance,
               cast(sum(change) over (partition by user_id, event_type order by event_id) as double) as type_balance
        from ({_LEDGER})""",
    "moving_sum_3": f"""
        select event_id, user_id, event_type, {_CHANGE},
               cast(sum(change) over (partition by user_id order by event_id rows 2 preceding) as double) as moving_sum_3
        from ({_LEDGER})""",
    "first_event_class": """
        select event_id, user_id, event_type, row_number() over w as n,
               case when event_type <> 'signup' then 'redeem' when row_number() over w = 1 then 'issue'
                    else 'top_up' end as kind
        from events window w as (partition by user_id order by event_id)""",
    "lag_fill": """
        select event_id, coalesce(nullif(event_type, 'error'),
                                  lag(nullif(event_type, 'error')) over (order by event_id)) as event_type
        from events""",
    "dedup_best_customer_order": """
        select o_custkey, o_orderkey, o_orderstatus, cast(o_orderdate as varchar) as o_orderdate
        from orders qualify row_number() over (partition by o_custkey
            order by (o_orderstatus <> 'F'), o_orderdate desc, o_orderkey desc) = 1""",
    "latest_per_group": """
        select o_orderkey, o_orderpriority, cast(cast(o_orderdate as date) as varchar) as day
        from orders qualify rank() over (partition by o_orderpriority order by cast(o_orderdate as date) desc) = 1""",
    "surrogate_key": """
        select row_number() over (order by o_orderdate, o_orderkey) as order_sk, o_orderkey, o_custkey,
               cast(cast(o_orderdate as date) as varchar) as day
        from orders""",
    "dup_id_strip": f"""
        select transaction_id, replace(transaction_id, ' ', '') as clean_id, {undup("store_id")} as store_id,
               store_id[:9] as fixed_length_id, cast(store_id not like '%DUP' as bigint) as is_original
        from {raw("pos_transactions_raw")}""",
    "dup_rows_dropped": f"select return_id, product_id from {raw('returns_raw')} where return_id not like '%DUP'",
    "sentinel_repair": f"""
        select po_number, cast({fixed("expected_delivery_date", v.OCTOBER_2022)} as varchar) as repaired,
               cast(try_cast(expected_delivery_date as date) as varchar) as unrepaired,
               cast(try_cast(expected_delivery_date as date) is not null as bigint) as is_date,
               cast(coalesce(try_cast(order_date as date), {NOW}) as varchar) as order_date
        from {raw("purchase_orders_raw")}""",
    "safe_cast": f"""
        select customer_id, registration_date, {num("feedback_score")} as score,
               cast(try_cast(phone as int) as bigint) as phone_number, cast(try_cast(email as date) as varchar) as not_a_date
        from {raw("crm_raw")}""",
    "strict_cast": f"select store_id, date, cast(sales_kes as double) as sales_kes from {raw('store_daily_financials_raw')}",
    "packed_split": f"""
        select transaction_id, split_part(type, ',', 1) as kind, split_part(type, ',', 2) as linked,
               cast(len(string_split(type, ',')) - 1 as bigint) as commas
        from {raw("gift_card_transactions_raw")}""",
    "shifted_repair": f"""
        with s as (
            select order_id, payment_method as pm, status as st, string_split(total_amount, ',') as f
            from {raw("ecommerce_orders_raw")}
        )
        select order_id,
               cast(abs(coalesce(try_cast(case len(f) when 3 then st when 2 then pm when 1 then pm end as int), 0)) as double)
                 as delivery_fee,
               coalesce(trim(case len(f) when 1 then pm when 2 then st when 3 then f[1] end), 'Unknown') as payment_method,
               trim(case len(f) when 1 then st when 2 then f[1] when 3 then f[2] end) as order_status,
               cast(abs(coalesce(try_cast(if(len(f) < 4, f[-1], null) as decimal(18,2)), 0)) as double) as amount
        from s""",
    "split_rows": f"""
        select order_id, order_date, total_amount, coalesce(len(f), 0) as n_pieces,
               trim(f[1]) as piece_1, trim(f[2]) as piece_2, trim(f[3]) as piece_3,
               coalesce(array_to_string([trim(x) for x in f[4:]], ','), '') as further
        from (select *, string_split(total_amount, ',') as f from (select distinct * from {raw("ecommerce_orders_raw")}))""",
    "hash_impute": f"""
        select c_custkey, cast(date '{v.IMPUTE_FROM}' + cast(('0x' || left(md5(cast(c_custkey as varchar)), 12))::bigint
               % (date '{v.IMPUTE_TO}' - date '{v.IMPUTE_FROM}' + 1) as int) as varchar) as birth_date
        from customer""",
    "campaign_prefix": f"""
        select campaign_id, count(*) as n, cast(sum(cast(line_total as decimal(18,2))) as double) as amount
        from ({S["pos_line_items"]}) group by 1""",
    "text_norm": """
        select c_custkey, c_mktsegment[1] || lower(c_mktsegment[2:]) as segment, upper(c_name) as upper_name,
               length(c_name) as name_length, c_name || c_mktsegment as glued,
               c_name || '__' || c_nationkey as composite_key, instr(c_name, '#') as hash_at,
               split_part(c_name, '#', 1) as before_hash, split_part(c_name, '#', 2) as after_hash,
               format('{:,}', c_custkey * 1234) as grouped,
               if((length(c_name) + length(c_mktsegment)) % 2 = 1, 'odd', 'even') as parity
        from customer""",
    "date_functions": f"""
        with o as (select o_orderkey, cast(o_orderdate as date) as d from orders)
        select o_orderkey, cast(strftime(d, '%U') as bigint) + if(dayofweek(date_trunc('year', d)) = 0, 0, 1) as week_of_year,
               {NOW} - d as days, datediff('month', d, {NOW}) as months, datediff('year', d, {NOW}) as years,
               cast(last_day(d) as varchar) as month_end, cast(cast(date_trunc('month', d) as date) as varchar) as month_start,
               cast(cast(d + interval 5 month as date) as varchar) as five_months_on,
               if(month(d) < 7, (year(d) - 1) || '/' || year(d), year(d) || '/' || (year(d) + 1)) as fiscal_year,
               (quarter(d) + 1) % 4 + 1 as fiscal_quarter, 'Q' || quarter(d) || ' ' || year(d) as quarter_label,
               strftime(d, '%Y%m%d') as day_key
        from o""",
    "email_phone_checks": f"""
        with c as (select customer_id, registration_date, {_phone} as ph, {_email} as em from {raw("crm_raw")})
        select customer_id, registration_date, {_phone_case("07", "01")} as phone, {_phone_case("0", "0")} as plain_phone,
               cast(regexp_full_match(ph, '[0-9]{{10,12}}') as bigint) as is_phone_valid, em as email,
               nullif(regexp_extract(em, '@(.*)$', 1), '') as email_domain,
               cast(coalesce(regexp_full_match(em, '.+@.{{2,}}[.].{{2,}}'), false) as bigint) as is_email_valid
        from c""",
    "landed_cost": f"""
        select l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
               cast(round({dec("l_extendedprice")} * 1.10, 2) as double) as landed_cost,
               cast(round({dec("l_extendedprice")} * 0.16, 2) as double) as vat,
               cast((2 * cast({dec("l_extendedprice")} * 100 as bigint) + cast(l_quantity as bigint))
                    // nullif(2 * cast(l_quantity as bigint), 0) as double) / 100 as unit_price
        from lineitem""",
    "signed_ledger": """
        with s as (
            select user_id, cast(value as decimal(14,2)) * case event_type when 'view' then 1 when 'signup' then 1
                   when 'error' then 0 else -1 end as x
            from events
        )
        select user_id, cast(sum(x) as double) as debit_view, cast(-sum(x) as double) as credit_view from s group by 1""",
    "returns_split": f"""
        select channel, return_reason, count(*) as n, cast(sum(cast(refund_amount as decimal(18,2))) as double) as refunds
        from ({S["returns"]}) group by all""",
    "geo_latest": """
        select cast(n_nationkey as bigint) as n_nationkey, n_name, r_name, max(c_acctbal) as c_acctbal
        from nation left join region on r_regionkey = n_regionkey left join customer on c_nationkey = n_nationkey
        group by all""",
    "procurement_snapshot": """
        select o_orderkey, cast(cast(o_orderdate as date) as varchar) as ordered, cast(min(l_shipdate)::date as varchar) as first_ship,
               cast(max(l_shipdate)::date as varchar) as last_ship, max(l_shipdate)::date - o_orderdate::date as lead_days
        from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderdate""",
    "dq_metrics": f"""
        with o as ({S["ecommerce_orders"]})
        select 'Total Rows' as metric, count(*) as value from o
        union all select 'Unique Order IDs', count(distinct order_id) from o
        union all select 'Unknown Customer IDs', count(*) filter (customer_id = 'Unknown') from o
        union all select 'Zero Amounts', count(*) filter (amount = 0) from o
        union all select 'Negative Amounts', count(*) filter (amount < 0) from o
        union all select 'Zero Delivery Fee', count(*) filter (delivery_fee = 0) from o""",
    "summary": f"""
        select count(*) as total_orders, count(distinct customer_id) as unique_customers, min(order_date) as first_order_date,
               max(order_date) as last_order_date, cast(sum({dec("amount")}) as double) as total_revenue,
               {mean(f"sum({dec('amount')})", "count(*)", 4)} as average_order_value,
               cast(sum({dec("delivery_fee")}) as double) as total_delivery_fees,
               {mean(f"sum({dec('delivery_fee')})", "count(*)", 4)} as average_delivery_fee,
               min(amount) as min_order_amount, max(amount) as max_order_amount
        from ({S["ecommerce_orders"]})""",
    "topn_preview": f"""
        select * exclude (delivery_address), delivery_address[:30] as delivery_address_preview
        from ({S["ecommerce_orders"]}) order by order_id, order_date, order_time, amount limit 20""",
    "reconcile": f"""
        with n as (
            select (select count(*) from {raw("pos_line_items_raw")}) as s, (select count(*) from ({S["pos_line_items"]})) as t
        ), p as (
            select 'Source Bronze' as source, s as row_count, s from n
            union all select 'Target Silver', t, s from n union all select 'Missing Rows', s - t, s from n
        )
        select source, row_count, printf('%.2f%%', ((row_count * 20000 + s) // (2 * s)) / 100) as percentage from p""",
    "unique_check": """
        select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as n_rows
        from lineitem group by all having count(*) > 1""",
    "check_violations": f"""
        with o as ({S["ecommerce_orders"]})
        select 'amount_not_negative' as check_name, count(*) filter (amount < 0) as n_violations from o
        union all select 'delivery_fee_not_negative', count(*) filter (delivery_fee < 0) from o
        union all select 'order_date_not_in_future', count(*) filter (order_date > cast({NOW} as varchar)) from o
        union all select c || '_not_null', 0 from (values ('order_id'), ('order_date'), ('order_time'), ('customer_id'),
                                                   ('delivery_address'), ('payment_method'), ('amount')) x(c)""",
    "fk_coverage": f"""
        select supplier_id, count(*) as n_rows from ({S["purchase_orders"]})
        where supplier_id not in (select supplier_id from ({S["suppliers"]})) group by 1""",
    "quarantine": f"""
        select quality_flag, count(*) as n from ({silver.flagged_pos_lines()}) where quality_flag <> 'Valid' group by 1""",
    "bronze_roundtrip": f"""
        select * replace (nullif(line_total, '') as line_total) from {raw("pos_line_items_raw")}""",
    "gated_write": f"""
        select cast(quality_flag = 'Valid' as bigint) as accepted, quality_flag, count(*) as n
        from ({silver.flagged_pos_lines()}) group by all""",
    "load_log": f"""
        with o as (select if(right(order_id, 1) in ('0', '2', '4', '6', '8'), 1, 2) as b, count(*) as n
                   from ({S["ecommerce_orders"]}) group by 1)
        select 'silver.ecommerce_orders' as table_name, n as rows_inserted, n as rows_held,
               if(b = 1, '2024-06-30 12:00:00', '2024-07-01 12:00:00') as load_date, 'batch-' || b as batch_id, 'SUCCESS' as status
        from o join (values (1), (2), (2)) loads(l) on l = b""",
    "latest_batch": f"""
        select * exclude (delivery_address), delivery_address[:30] as delivery_address_preview, 'batch-2' as etl_batch_id,
               '2024-07-01 12:00:00' as created_date, 'silver.ecommerce_orders' as source_system
        from ({S["ecommerce_orders"]}) where right(order_id, 1) not in ('0', '2', '4', '6', '8')
        order by order_id, order_date, order_time, amount limit 20""",
    "unreadable_texts": " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, {c} as text, count(*) as n_rows from {raw(r)} where {c} like '%abc' group by {c}"
        for t, r, c in (
            ("crm", "crm_raw", "feedback_score"), ("feedback", "feedback_raw", "rating"), ("gl_transactions", "gl_transactions_raw", "amount"),
            ("hr", "hr_raw", "salary"), ("loyalty_transactions", "loyalty_transactions_raw", "points_earned"),
            ("pos_returns", "returns_raw", "quantity_returned"), ("service_interactions", "service_interactions_raw", "resolution_time_minutes"),
            ("store_daily_financials", "store_daily_financials_raw", "net_profit"), ("gis_counties", "gis_counties_raw", "population"),
            ("gis_locations", "gis_locations_raw", "accessibility_score"), ("employee_shifts", "employee_shifts_raw", "hours_worked"),
            ("time_tracking", "time_tracking_raw", "timestamp"), ("inventory_snapshots", "inventory_snapshots_raw", "on_hand_quantity"),
            ("economic", "economic_raw", "fuel_price_kes"), ("campaigns", "campaigns_raw", "budget_kes"),
            ("promotions", "promotions_raw", "discount_value"), ("goods_receipts", "goods_receipts_raw", "quantity_received"),
            ("purchase_orders", "purchase_orders_raw", "total_amount"), ("products", "products_raw", "unit_cost_kes"),
            ("stores", "stores_raw", "size_sqm"), ("suppliers", "suppliers_raw", "lead_time_days"),
        )
    ),
    "full_refresh": """
        select step, o_orderstatus, count(*) as n_rows
        from orders join (values ('refreshed', 'F'), ('died', 'F'), ('again', '%')) s(step, shown) on o_orderstatus like shown
        group by all""",
    "sorted_write": "select count(*) as n_rows, 0::bigint as wrong_within, 0::bigint as wrong_between from orders",
    "loader_modes": f"""
        with n as (
            select 'competitors_raw' as table_name, count(*) as n from {raw("competitors_raw")}
            union all select 'promotion_products_raw', count(*) from {raw("promotion_products_raw")}
            union all select 'crm_raw', null
        ), s as (select * from n, (values ('stop'), ('continue'), ('append'), ('truncate')) x(step))
        select step, table_name,
               case when table_name = 'crm_raw' then 'FAILED' when step = 'stop' and table_name like 'prom%' then 'SKIPPED'
                    else 'LOADED' end as status,
               if(step = 'stop' and table_name like 'prom%', null, n) as rows_loaded,
               if(step = 'stop' and table_name like 'prom%', null, n * if(step = 'append', 2, 1)) as rows_held
        from s""",
    "audit_columns": f"""
        select cast({NOW} as varchar) as etl_load_date, 'silver.feedback' as etl_source, count(*) as n from ({S["feedback"]})""",
}
SQL["asof_line_cost_ranked"] = SQL["asof_line_cost"]
SQL["running_balance_batches"] = SQL["running_balance"]
