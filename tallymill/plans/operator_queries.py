"""Each operator over whole benchmark tables."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions import clean, compat, contact, money
from tallymill.operators import accumulate, quality, repair, rescue, versions, windows
from tallymill.operators.keys import dense_key
from tallymill.plans import audit, gold
from tallymill.plans import vocab as v
from tallymill.plans.lake import AS_OF, Lake
from tallymill.plans.tables import SILVER
from tallymill.session import fresh_path, materialise
from tallymill.sources import bronze, sinks

EVENT_CHUNK = 100_000
BATCH, LOADED_AT = "batch-1", datetime(2024, 6, 30, 12, 0)
SECOND_SHIPMENTS = date(1998, 1, 1)
NEXT_BATCH, NEXT_AT = "batch-2", datetime(2024, 7, 1, 12, 0)


def _event_chunk():
    """Ranges of consecutive event ids: no chunk holds more than a fixed number of rows."""
    return [F.floor(F.col("event_id") / EVENT_CHUNK)]


def _cash(c: str):
    return F.col(c).cast("decimal(14,2)")


# --- calendar, versions and sales -----------------------------------------
def calendar(lake: Lake) -> DataFrame:
    return gold.dim_date(
        lake.base("orders").select("o_orderdate"),
        lake.base("lineitem").select("l_shipdate"),
        lake.base("events").select("ts"),
    )


def _part_changes(lake: Lake) -> DataFrame:
    """Lowest line price per part and year, dated at the start of the year."""
    year_start = F.trunc("l_shipdate", "year").alias("valid_from")
    return (
        lake.base("lineitem")
        .groupBy("l_partkey", year_start)
        .agg(F.min("l_extendedprice").alias("unit_cost"), F.min("l_suppkey").alias("l_suppkey"))
    )


def scd2_versions(lake: Lake) -> DataFrame:
    """Part price versions: each ends the day before the next, the last is open."""
    closed = versions.versions_from_changes(_part_changes(lake), "l_partkey", "valid_from")
    dated = closed.withColumns(
        {
            "is_current_version": clean.yes_no(F.col("valid_to").isNull()),
            "valid_to": clean.open_end(F.col("valid_to"), AS_OF),
        }
    )
    part = lake.base("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return dated.join(part, "l_partkey")


def first_version_opened(lake: Lake) -> DataFrame:
    closed = versions.versions_from_changes(_part_changes(lake), "l_partkey", "valid_from")
    return versions.open_first_version(
        closed, "l_partkey", [F.col("valid_from")], [F.year("valid_from")], ["valid_from"]
    )


def _overlapping(lake: Lake) -> DataFrame:
    """Part versions that share their boundary day, numbered by year."""
    w = Window.partitionBy("l_partkey").orderBy("valid_from")
    return _part_changes(lake).select(
        "l_partkey",
        "valid_from",
        F.coalesce(F.lead("valid_from").over(w), F.lit(AS_OF)).alias("valid_to"),
        F.year("valid_from").alias("version_no"),
        "unit_cost",
    )


def bridge_part(lake: Lake) -> DataFrame:
    return versions.disjoint_periods(
        _overlapping(lake), "l_partkey", "version_no", ["version_no", "unit_cost"]
    )


def _dated_lines(lake: Lake) -> DataFrame:
    lines = lake.base("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    orders = lake.base("orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    return lines.join(orders, "l_orderkey", "left")


def asof_line_cost(lake: Lake) -> DataFrame:
    """Every line with the part version valid on its order date."""
    periods = versions.by_month(bridge_part(lake), "l_partkey")
    return versions.point_in_time_join(_dated_lines(lake), periods, "order_date", ["version_no", "unit_cost"])


def asof_line_cost_ranked(lake: Lake) -> DataFrame:
    """The same by ranking overlapping matches per line."""
    # written, so that a retried stage sees the same numbers
    numbered = materialise(_dated_lines(lake).withColumn("_line", F.monotonically_increasing_id()), "lines")
    return versions.point_in_time_guarded(
        numbered, _overlapping(lake), "l_partkey", "order_date", ["_line"], "version_no"
    ).drop("_line")


def revenue_by_month(lake: Lake) -> DataFrame:
    """Lines with their version cost, added up per order month."""
    net = _cash("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return (
        asof_line_cost(lake)
        .groupBy(compat.month_text(F.col("order_date")).alias("year_month"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count("version_no").alias("n_priced"),
            F.sum(net).alias("_revenue"),
            F.sum(_cash("unit_cost")).alias("_cost"),
        )
        .select(
            "year_month",
            "n_lines",
            "n_priced",
            money.cents(F.col("_revenue")).alias("revenue"),
            F.col("_cost").cast("double").alias("version_cost"),
        )
    )


def fact_sales_union(lake: Lake) -> DataFrame:
    """Lines and purchase events under one set of columns."""
    lines = lake.base("lineitem").select(
        F.lit("LINE").alias("channel"),
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_partkey").alias("part_key"),
        F.lit(None).cast("bigint").alias("user_id"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        money.cents(_cash("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("amount"),
    )
    clicks = (
        lake.base("events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.lit("EVENT").alias("channel"),
            F.col("event_id").alias("sale_id"),
            F.lit(None).cast("bigint").alias("part_key"),
            "user_id",
            F.col("ts").cast("date").alias("sale_date"),
            F.col("value").alias("amount"),
        )
    )
    return lines.unionByName(clicks)


def order_totals_vs_lines(lake: Lake) -> DataFrame:
    """Order headers with the sum of their lines, added up before the join."""
    lines = lake.base("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        money.exact_sum(F.col("l_extendedprice")).cast("double").alias("line_total"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return (
        lake.base("orders")
        .select("o_orderkey", "o_totalprice")
        .join(lines, "o_orderkey", "left")
        .withColumn(
            "quality_flag",
            clean.first_failing(
                [
                    ("No lines", F.col("line_total").isNull()),
                    (
                        "Total mismatch",
                        F.abs(_cash("o_totalprice") - _cash("line_total")) > money.LINE_TOLERANCE,
                    ),
                ]
            ),
        )
    )


def line_mismatch_flag(lake: Lake) -> DataFrame:
    q, p, d = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    return lake.base("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        money.line_total(q, p, d).alias("calculated_line_total"),
        money.line_discount(q, p, d).alias("discount_amount"),
        money.net_price(p, d).alias("net_price"),
        clean.first_failing(
            [
                ("Invalid quantity", q <= 0),
                ("Large order", q >= 45),
                ("Deep discount", d >= 0.09),
            ]
        ).alias("quality_flag"),
    )


def discount_tier(lake: Lake) -> DataFrame:
    return (
        lake.base("lineitem")
        .groupBy(clean.band(F.col("l_discount"), v.DISCOUNT_TIERS).alias("discount_tier"))
        .agg(F.count(F.lit(1)).alias("n"), money.exact_sum(F.col("l_extendedprice")).cast("double").alias("amount"))
    )


def value_tier(lake: Lake) -> DataFrame:
    return lake.base("orders").select(
        "o_orderkey", clean.band(F.col("o_totalprice"), v.TRANSACTION_TIERS).alias("transaction_tier")
    )


def time_of_day(lake: Lake) -> DataFrame:
    stamp = F.col("ts").cast("string")
    return lake.base("events").select(
        "event_id",
        compat.clock_text(stamp).alias("event_time"),
        clean.band(compat.clock_hour(compat.clock_text(stamp)), v.DAY_TIMES).alias("time_of_day"),
    )


# --- windows ---------------------------------------------------------------
def _ledger(lake: Lake) -> DataFrame:
    out = F.col("event_type").isin("click", "error")
    return lake.base("events").select(
        "event_id", "user_id", "event_type", F.when(out, -_cash("value")).otherwise(_cash("value")).alias("change")
    )


def running_balance(lake: Lake) -> DataFrame:
    """Running sums per user, and per user and event type, on one shuffle."""
    return windows.running_windows(
        _ledger(lake),
        [
            windows.Level(("user_id",), sums={"balance": "change"}),
            windows.Level(("user_id", "event_type"), sums={"type_balance": "change"}),
        ],
        [F.col("event_id")],
        _event_chunk(),
    )


def running_balance_batches(lake: Lake) -> DataFrame:
    """The same sums over two batches of the log, the second from the state that the first left."""
    levels = {
        "balance": windows.Level(("user_id",), sums={"balance": "change"}),
        "type_balance": windows.Level(("user_id", "event_type"), sums={"type_balance": "change"}),
    }
    ledger = _ledger(lake)
    first = F.col("event_id") < lake.base("events").agg(F.floor(F.percentile_approx("event_id", 0.6))).first()[0]
    done, states = [], dict.fromkeys(levels)
    for part in (first, ~first):
        batch = ledger.where(part)
        rows = batch
        for out, level in levels.items():
            rows = accumulate.running_sums_from(rows, level, [F.col("event_id")], _event_chunk(), states[out])
            states[out] = materialise(accumulate.next_state(batch, level, states[out]), "state")
        done.append(rows)
    return done[0].unionByName(done[1])


def moving_sum_3(lake: Lake) -> DataFrame:
    return windows.running_windows(
        _ledger(lake),
        [windows.Level(("user_id",), moving={"moving_sum_3": ("change", 3)})],
        [F.col("event_id")],
        _event_chunk(),
    )


def first_event_class(lake: Lake) -> DataFrame:
    numbered = windows.row_numbers(
        lake.base("events").select("event_id", "user_id", "event_type"),
        ["user_id"],
        [F.col("event_id")],
        _event_chunk(),
        "n",
    )
    start = F.col("event_type") == "signup"
    return numbered.withColumn(
        "kind", F.when(start & (F.col("n") == 1), "issue").when(start, "top_up").otherwise("redeem")
    )


def lag_fill(lake: Lake) -> DataFrame:
    """Event types hidden on every error, filled from the row before in the whole log."""
    hidden = lake.base("events").select("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    return windows.lag_fill(hidden, "event_type", [F.col("event_id")], _event_chunk())


def dedup_best_customer_order(lake: Lake) -> DataFrame:
    """One order per customer: finished ones first, then the latest."""
    return windows.best_per_key(
        lake.base("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"),
        ["o_custkey"],
        [F.col("o_orderstatus") != "F", F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
    )


def latest_per_group(lake: Lake) -> DataFrame:
    orders = lake.base("orders").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    return windows.latest_per_key(orders, ["o_orderpriority"], "day")


def surrogate_key(lake: Lake) -> DataFrame:
    orders = lake.base("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return dense_key(orders, [F.col("day"), F.col("o_orderkey")], "order_sk", steady=True)


# --- repairs ---------------------------------------------------------------
def dup_id_strip(lake: Lake) -> DataFrame:
    raw = lake.raw("pos_transactions_raw")
    return raw.select(
        "transaction_id",
        clean.no_blanks(F.col("transaction_id")).alias("clean_id"),
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        F.left("store_id", F.lit(9)).alias("fixed_length_id"),
        clean.not_dup(F.col("store_id")).cast("int").alias("is_original"),
    )


def dup_rows_dropped(lake: Lake) -> DataFrame:
    return lake.raw("returns_raw").where(clean.not_dup(F.col("return_id"))).select("return_id", "product_id")


def sentinel_repair(lake: Lake) -> DataFrame:
    due = F.col("expected_delivery_date")
    return lake.raw("purchase_orders_raw").select(
        "po_number",
        clean.fix_date(due, v.OCTOBER_2022).alias("repaired"),
        clean.as_date(due).alias("unrepaired"),
        compat.is_date(due).cast("int").alias("is_date"),
        clean.open_end(clean.as_date(F.col("order_date")), AS_OF).alias("order_date"),
    )


def safe_cast(lake: Lake) -> DataFrame:
    raw = lake.raw("crm_raw")
    return raw.select(
        "customer_id",
        "registration_date",
        clean.as_float(F.col("feedback_score")).alias("score"),
        clean.as_int(F.col("phone")).alias("phone_number"),
        clean.as_date(F.col("email")).alias("not_a_date"),
    )


def strict_cast(lake: Lake) -> DataFrame:
    raw = lake.raw("store_daily_financials_raw")
    return raw.select(
        "store_id",
        clean.strict(F.col("date"), "date").alias("date"),
        clean.strict(F.col("sales_kes"), "double").alias("sales_kes"),
    )


def packed_split(lake: Lake) -> DataFrame:
    kind = F.col("type")
    return lake.raw("gift_card_transactions_raw").select(
        "transaction_id",
        clean.packed(kind, 0, 2).alias("kind"),
        clean.packed(kind, 1, 2).alias("linked"),
        clean.comma_count(kind).cast("bigint").alias("commas"),
    )


def shifted_repair(lake: Lake) -> DataFrame:
    fixed = repair.unpack_order(lake.raw("ecommerce_orders_raw"))
    return fixed.select("order_id", "delivery_fee", "payment_method", "order_status", "amount")


def split_rows(lake: Lake) -> DataFrame:
    """Packed totals as rows, and their pieces gathered back by position."""
    packed = lake.raw("ecommerce_orders_raw").dropDuplicates()
    rows = repair.split_rows(packed, "total_amount").withColumn("value", F.trim("value"))
    pieces = F.sort_array(F.collect_list(F.struct("position", "value"))).alias("pieces")
    gathered = rows.groupBy(*packed.columns).agg(pieces)
    values = F.filter(F.transform("pieces", lambda p: p["value"]), lambda x: x.isNotNull())
    return gathered.withColumn("values", values).select(
        "order_id",
        "order_date",
        "total_amount",
        F.size("values").cast("bigint").alias("n_pieces"),
        *[F.get("values", F.lit(i - 1)).alias(f"piece_{i}") for i in (1, 2, 3)],
        F.array_join(F.filter("values", lambda _, i: i > 2), ",").alias("further"),
    )


def campaign_prefix(lake: Lake) -> DataFrame:
    lines = lake.silver("pos_line_items")
    return lines.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("n"), money.exact_sum(F.col("line_total")).cast("double").alias("amount")
    )


def text_norm(lake: Lake) -> DataFrame:
    name = F.col("c_name")
    return lake.base("customer").select(
        "c_custkey",
        compat.capitalise(F.col("c_mktsegment")).alias("segment"),
        F.upper(name).alias("upper_name"),
        compat.text_len(F.concat(name, F.lit("  "))).alias("name_length"),
        compat.glue(name, F.lit(None).cast("string"), F.col("c_mktsegment")).alias("glued"),
        clean.join_key(name, F.lit(None).cast("string"), F.col("c_nationkey")).alias("composite_key"),
        compat.position_of("#", name, 3).alias("hash_at"),
        compat.text_before(name, "#").alias("before_hash"),
        compat.text_after(name, "#").alias("after_hash"),
        compat.no_decimals(F.col("c_custkey") * 1234).alias("grouped"),
        clean.parity_choice("odd", "even", name, F.col("c_mktsegment")).alias("parity"),
    )


def date_functions(lake: Lake) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    now = compat.today(AS_OF)
    return lake.base("orders").select(
        "o_orderkey",
        compat.week_of_year(d).alias("week_of_year"),
        compat.days_between(d, now).alias("days"),
        compat.months_between_starts(d, now).alias("months"),
        compat.years_between_starts(d, now).alias("years"),
        F.last_day(d).alias("month_end"),
        compat.month_start(compat.month_text(d)).alias("month_start"),
        F.add_months(d, 5).alias("five_months_on"),
        compat.fiscal_year(d).alias("fiscal_year"),
        compat.fiscal_quarter(d).alias("fiscal_quarter"),
        compat.quarter_label(d).alias("quarter_label"),
        compat.day_key(d).alias("day_key"),
    )


def email_phone_checks(lake: Lake) -> DataFrame:
    phone, email = contact.digits(F.col("phone")), contact.mail_host(F.col("email"), "example", "gmail")
    return lake.raw("crm_raw").select(
        "customer_id",
        "registration_date",
        contact.local_phone(phone).alias("phone"),
        contact.local_phone(phone, compat=False).alias("plain_phone"),
        contact.phone_valid(phone).cast("int").alias("is_phone_valid"),
        email.alias("email"),
        contact.email_domain(email).alias("email_domain"),
        contact.email_valid(email).cast("int").alias("is_email_valid"),
    )


def hash_impute(lake: Lake) -> DataFrame:
    return lake.base("customer").select(
        "c_custkey", clean.imputed_date(F.col("c_custkey"), v.IMPUTE_FROM, v.IMPUTE_TO).alias("birth_date")
    )


def landed_cost(lake: Lake) -> DataFrame:
    p = F.col("l_extendedprice")
    return lake.base("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        money.landed_cost(p).alias("landed_cost"),
        money.vat(p).alias("vat"),
        money.unit_price(p, F.col("l_quantity")).alias("unit_price"),
    )


def signed_ledger(lake: Lake) -> DataFrame:
    debit, credit = F.col("event_type").isin("view", "signup"), F.col("event_type").isin("click", "purchase")
    zero = F.lit(0).cast("decimal(14,2)")
    return lake.base("events").groupBy("user_id").agg(
        F.sum(money.signed(_cash("value"), debit, credit, zero)).cast("double").alias("debit_view"),
        F.sum(money.signed(_cash("value"), credit, debit, zero)).cast("double").alias("credit_view"),
    )


def returns_split(lake: Lake) -> DataFrame:
    """Both routes of the return split, counted side by side."""
    till, web = lake.silver("pos_returns"), lake.silver("ecomerce_returns")
    return till.withColumn("channel", F.lit("POS")).unionByName(web.withColumn("channel", F.lit("ECOMMERCE"))).groupBy(
        "channel", "return_reason"
    ).agg(F.count(F.lit(1)).alias("n"), money.exact_sum(F.col("refund_amount")).cast("double").alias("refunds"))


def geo_latest(lake: Lake) -> DataFrame:
    """Nations with their region and the largest account balance of their customers."""
    top = windows.latest_per_key(
        lake.base("customer").select("c_nationkey", "c_acctbal"), ["c_nationkey"], "c_acctbal"
    ).distinct()
    nation, region = lake.base("nation"), lake.base("region")
    return (
        nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
        .join(top, nation["n_nationkey"] == top["c_nationkey"], "left")
        .select("n_nationkey", "n_name", "r_name", "c_acctbal")
    )


def procurement_snapshot(lake: Lake) -> DataFrame:
    """Orders with first and last shipment and the days in between, from two batches of shipments:
    the second rewrites the months it touches only."""
    day = F.col("o_orderdate").cast("date")
    orders = accumulate.by_month(lake.base("orders").select("o_orderkey", day.alias("ordered")), "ordered")
    shipped = lake.base("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("date").alias("day"))
    late = F.coalesce(F.col("day") >= F.lit(SECOND_SHIPMENTS), F.lit(False))
    path, measures = fresh_path(lake.spark, "snapshot"), {"first_ship": F.min("day"), "last_ship": F.max("day")}
    accumulate.accumulate(orders, shipped.where(~late), path, ["o_orderkey"], measures)
    accumulate.accumulate(orders, shipped, path, ["o_orderkey"], measures, batch=shipped.where(late))
    lead = compat.days_between(F.col("ordered"), F.col("last_ship"))
    return lake.spark.read.parquet(path).drop("month").withColumn("lead_days", lead)


# --- quality ---------------------------------------------------------------
def dq_metrics(lake: Lake) -> DataFrame:
    return audit.order_metrics(lake.silver("ecommerce_orders"))


def summary(lake: Lake) -> DataFrame:
    return audit.order_summary(lake.silver("ecommerce_orders"))


def topn_preview(lake: Lake) -> DataFrame:
    return audit.preview(lake.silver("ecommerce_orders"), ["order_id", "order_date", "order_time", "amount"])


def reconcile(lake: Lake) -> DataFrame:
    return quality.reconcile(lake.raw("pos_line_items_raw"), lake.silver("pos_line_items"))


def unique_check(lake: Lake) -> DataFrame:
    return quality.duplicate_keys(lake.base("lineitem"), ["l_orderkey", "l_linenumber"])


def check_violations(lake: Lake) -> DataFrame:
    return audit.order_violations(lake.silver("ecommerce_orders"), AS_OF)


def fk_coverage(lake: Lake) -> DataFrame:
    return quality.unmatched_keys(
        lake.silver("purchase_orders"), lake.silver("suppliers"), "supplier_id", "supplier_id"
    )


def quarantine(lake: Lake) -> DataFrame:
    """Rejected till lines per reason."""
    _, rejected = quality.gate(lake.flagged("pos_line_items"), SILVER["pos_line_items"].keep())
    return rejected.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("n"))


# --- sources and sinks -----------------------------------------------------
def _as_text_file(lake: Lake, table: str, root: str) -> None:
    """Write a raw table the way its extract looks: header, commas, no quotes."""
    raw = lake.raw(table)
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in raw.columns])
    # one column, named like the header line, and a separator that never occurs
    raw.select(line.alias(",".join(raw.columns))).write.options(
        header=True, sep="\u0001", quote="\u0002", escape="\u0002"
    ).csv(f"{root}/{bronze.PATHS[table]}")


def bronze_roundtrip(lake: Lake) -> DataFrame:
    """Till lines written as text extracts, whose totals hold commas, and loaded back."""
    root = fresh_path(lake.spark, "extract")
    _as_text_file(lake, "pos_line_items_raw", root)
    target = f"{root}/bronze"
    bronze.load_bronze(lake.spark, root, target, tables=["pos_line_items_raw"])
    return bronze.read_bronze(lake.spark, target, "pos_line_items_raw")


def gated_write(lake: Lake) -> DataFrame:
    """Kept and rejected till lines written in one pass and counted from the files."""
    flagged = lake.flagged("pos_line_items")
    path = fresh_path(lake.spark, "gated")
    sinks.write_gated(flagged, SILVER["pos_line_items"].keep(), path)
    both = [
        sinks.read_gated(flagged.schema, lake.spark, path, side).select(F.lit(int(side)).alias("accepted"), "quality_flag")
        for side in (True, False)
    ]
    return both[0].unionAll(both[1]).groupBy("accepted", "quality_flag").agg(F.count(F.lit(1)).alias("n"))


def _two_batches(lake: Lake) -> tuple[str, str]:
    """Web orders loaded as two batches, the second one twice; paths of the table and of its load log."""
    path, log = fresh_path(lake.spark, "orders"), fresh_path(lake.spark, "log")
    orders = materialise(lake.silver("ecommerce_orders"), "orders")
    even = F.right("order_id", F.lit(1)).isin(*"02468")
    for batch, at, part in ((BATCH, LOADED_AT, even), (NEXT_BATCH, NEXT_AT, ~even), (NEXT_BATCH, NEXT_AT, ~even)):
        rows = sinks.append_batch(orders.where(part), path, "silver.ecommerce_orders", at, batch)
        sinks.log_load(lake.spark, log, "silver.ecommerce_orders", rows, batch, at)
    return path, log


def load_log(lake: Lake) -> DataFrame:
    """What the log of two batches says, and what their table holds."""
    path, log = _two_batches(lake)
    held = lake.spark.read.parquet(path).groupBy(F.col("etl_batch_id").alias("batch_id")).agg(F.count(F.lit(1)).alias("rows_held"))
    lines = lake.spark.read.schema(sinks.LOG_SCHEMA).parquet(log)
    return lines.join(held, "batch_id").select("table_name", "rows_inserted", "rows_held", "load_date", "batch_id", "status")


def latest_batch(lake: Lake) -> DataFrame:
    """The first orders of the batch that came last."""
    orders = audit.of_latest_batch(lake.spark.read.parquet(_two_batches(lake)[0]), "created_date")
    columns = [*lake.silver("ecommerce_orders").columns, "etl_batch_id", "created_date", "source_system"]
    return audit.preview(orders.select(*columns), ["order_id", "order_date", "order_time", "amount"])


def unreadable_texts(lake: Lake) -> DataFrame:
    """Texts that their columns cannot hold, in the tables that set such rows apart."""
    first = {spec.sources[0]: t for t, spec in reversed(SILVER.items()) if spec.typed is not None}  # of tables with one source the first
    found = [rescue.unread_texts(lake.raw(source), SILVER[t].typed, t) for source, t in first.items()]
    return reduce(DataFrame.unionByName, found)


def full_refresh(lake: Lake) -> DataFrame:
    """Rows that readers find after a refresh, after one that dies half way, and after the next."""
    path = fresh_path(lake.spark, "refresh")
    orders = lake.base("orders").select("o_orderkey", "o_orderstatus")
    dies = F.when(F.col("o_orderkey") % 5 == 3, F.raise_error(F.lit("dies")).cast("bigint")).otherwise(F.col("o_orderkey"))
    seen = []

    def look(step: str) -> None:
        held = materialise(sinks.read_table(lake.spark, path), "held")
        seen.append(held.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("step", F.lit(step)))

    sinks.replace_table(orders.where("o_orderstatus = 'F'"), path)
    look("refreshed")
    try:
        sinks.replace_table(orders.withColumn("o_orderkey", dies), path)
    except Exception:  # noqa: BLE001 - this is the point
        look("died")
    sinks.replace_table(orders, path)
    look("again")
    return reduce(DataFrame.unionByName, seen)


def sorted_write(lake: Lake) -> DataFrame:
    """Rows of a table written in order, and pairs of neighbours that are not, within files and between them."""
    path = fresh_path(lake.spark, "sorted")
    orders = lake.base("orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    sinks.replace_table(orders, path, ["day", "o_orderkey"])
    place = F.struct(F.col("day"), F.col("o_orderkey"))
    rows = sinks.read_table(lake.spark, path).select(
        place.alias("at"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("i")
    )
    # runs of rows keep large files from being one window
    run = Window.partitionBy("file", F.floor(F.col("i") / 100_000)).orderBy("i")
    within = rows.withColumn("wrong", (F.lag("at").over(run) > F.col("at")).cast("int"))
    files = within.groupBy("file", F.floor(F.col("i") / 100_000).alias("run")).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.sum("wrong").alias("wrong"), F.count(F.lit(1)).alias("n")
    )
    along = Window.orderBy("file", "run")  # one row for 100,000
    checked = files.withColumn("apart", (F.lag("high").over(along) > F.col("low")).cast("int"))
    zero = F.lit(0).cast("bigint")
    return checked.agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum("wrong"), zero).alias("wrong_within"),
        F.coalesce(F.sum("apart"), zero).alias("wrong_between"),
    )


def loader_modes(lake: Lake) -> DataFrame:
    """Status and rows held after loads that stop, go on, append and truncate; one extract is missing."""
    root, target = fresh_path(lake.spark, "extract"), fresh_path(lake.spark, "bronze")
    for table in ("competitors_raw", "promotion_products_raw"):
        _as_text_file(lake, table, root)
    names = ["competitors_raw", "crm_raw", "promotion_products_raw"]
    steps = {
        "stop": {},
        "continue": {"continue_on_error": True},
        "append": {"continue_on_error": True, "truncate_first": False},
        "truncate": {"continue_on_error": True},
    }
    seen = []
    for step, options in steps.items():
        status = bronze.load_bronze(lake.spark, root, target, tables=names, **options).where("table_name <> '*'")
        counts = [(t, bronze.read_bronze(lake.spark, target, t).count()) for t, s in status.select("table_name", "status").collect() if s == "LOADED"]
        held = lake.spark.createDataFrame(counts, "table_name string, rows_held bigint")
        seen.append(status.join(held, "table_name", "left").select(F.lit(step).alias("step"), "table_name", "status", "rows_loaded", "rows_held"))
    return reduce(DataFrame.unionByName, seen)


def audit_columns(lake: Lake) -> DataFrame:
    stamped = sinks.with_audit(lake.silver("feedback"), "silver.feedback", AS_OF)
    return stamped.groupBy("etl_load_date", "etl_source").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        calendar, scd2_versions, first_version_opened, bridge_part, asof_line_cost, asof_line_cost_ranked,
        revenue_by_month, fact_sales_union, order_totals_vs_lines, line_mismatch_flag, discount_tier, value_tier,
        time_of_day, running_balance, running_balance_batches, moving_sum_3, first_event_class, lag_fill, dedup_best_customer_order,
        latest_per_group, surrogate_key, dup_id_strip, dup_rows_dropped, sentinel_repair, safe_cast, strict_cast,
        packed_split, shifted_repair, split_rows, campaign_prefix, text_norm, date_functions, email_phone_checks,
        hash_impute, landed_cost, signed_ledger, returns_split, geo_latest, procurement_snapshot, dq_metrics, summary,
        topn_preview, reconcile, unique_check, check_violations, fk_coverage, quarantine, bronze_roundtrip,
        gated_write, load_log, audit_columns, latest_batch, unreadable_texts, full_refresh, sorted_write, loader_modes,
    )
}
