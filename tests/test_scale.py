"""What plans read, write and shuffle."""

from __future__ import annotations

import re

from conftest import SF, rows
from pyspark.sql import functions as F

from tallymill.operators import keys, rescue, settle, windows
from tallymill.plans import derive, gold
from tallymill.plans import silver_sales as sales
from tallymill.plans.lake import AS_OF, Lake
from tallymill.plans.tables import SILVER
from tallymill.operators.versions import by_month, disjoint_periods
from tallymill.sources import sinks


def plan(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_raw_tables_made_row_by_row_are_not_written(spark):
    lake = Lake(spark, SF)
    assert set(lake.raw("pos_line_items_raw").inputFiles()) == set(lake.dealt("lineitem").inputFiles())
    assert "economic_raw" in lake.raw("economic_raw").inputFiles()[0]


def test_fields_are_tested_without_building_the_map_of_texts(spark):
    types = {"n": "int", "x": "double", "d": "date"}
    texts = [("1", "2.5", "2020-01-01"), ("abc", "NaN", "2023-13-45"), ("", "n/a", None), ("7", "inf", "31/12/2023"), (None, "1e400", "NULL"), ("1e13", " nan ", "")]
    raw = spark.createDataFrame(texts, "n string, x string, d string")
    kept = rescue.readable(raw, types)
    assert "map_from_entries" not in plan(kept)
    assert rows(kept) == rows(spark.createDataFrame([texts[0], texts[2], texts[4]], raw.schema))
    lost = {tuple(sorted(r["unread"].items())) for r in rescue.rescued(raw, types).collect()}
    assert lost == {(("n", "abc"), ("x", "NaN")), (("d", "31/12/2023"),), (("n", "1e13"), ("x", " nan "))}


def longest_method(df):
    """Bytes of the longest method generated for a plan; beyond 8,000 the JVM interprets it."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length()))


def test_a_settled_column_is_made_below_the_filter(spark, tmp_path):
    spark.range(6).write.parquet(str(tmp_path / "ids"))
    made = spark.read.parquet(str(tmp_path / "ids")).withColumn("text", F.concat(F.lit("x"), F.col("id").cast("string")))
    kept = settle.settled(made).where(F.col("text").isin("x1", "x4"))
    assert plan(kept).count("concat") == 1 < plan(made.where(F.col("text").isin("x1", "x4"))).count("concat")
    assert rows(kept) == rows(made.where("id in (1, 4)")) and kept.columns == made.columns


def sold(spark, tmp_path):
    """Lines and orders of their own, as the raw tables are derived from them."""
    spark.sql(
        "select id div 4 as l_orderkey, id * 7 % 300 as l_partkey, id % 40 as l_suppkey, cast(id % 4 + 1 as int) as l_linenumber,"
        " cast(id % 50 + 1 as double) as l_quantity, id * 13.25D + 1 as l_extendedprice, id % 11 / 100D as l_discount, 0.02D as l_tax,"
        " 'R' as l_returnflag, 'F' as l_linestatus, timestamp'1995-03-04' as l_shipdate from range(2000)"
    ).write.parquet(str(tmp_path / "lineitem"))
    spark.sql(
        "select id as o_orderkey, id % 90 as o_custkey, 'F' as o_orderstatus, id * 3.5D as o_totalprice,"
        " timestamp'1995-02-03' as o_orderdate, '1-URGENT' as o_orderpriority from range(500)"
    ).write.parquet(str(tmp_path / "orders"))
    return lambda name: derive.raw(spark, lambda t: spark.read.parquet(str(tmp_path / t)), name)


def test_the_gate_of_till_lines_and_receipts_leaves_code_that_the_jvm_compiles(spark, tmp_path):
    raw = sold(spark, tmp_path)
    lines = SILVER["pos_line_items"].make(AS_OF, raw("pos_line_items_raw"))
    kept = lines.where(SILVER["pos_line_items"].keep())
    narrow = kept.select("transaction_id", "line_number", "product_id", "quantity", "unit_price_kes", "discount_rate", "line_total", "campaign_id")
    assert longest_method(narrow) < 8_000
    flags = {r["quality_flag"] for r in lines.collect()}
    assert {"Valid", "Unreadable value", "Invalid quantity", "Line total mismatch"} <= flags
    assert rows(kept) == [r for r in rows(lines) if "Valid" in r] and 0 < kept.count() < lines.count()

    heads = SILVER["pos_transactions"].keep
    receipts = sales.pos_transaction_heads(raw("pos_transactions_raw"), AS_OF).where(heads())
    columns = ("transaction_id", "store_id", "customer_id", "cashier_id", "payment_method", "transaction_date", "transaction_time")
    assert longest_method(receipts.select(*columns)) < 8_000
    assert 0 < receipts.count() < 500


def test_the_gate_of_web_lines_leaves_code_that_the_jvm_compiles(spark, tmp_path):
    lines = SILVER["ecommerce_order_lines"].make(AS_OF, sold(spark, tmp_path)("ecommerce_order_lines_raw"))
    kept = lines.where(SILVER["ecommerce_order_lines"].keep())
    narrow = kept.select("order_id", "line_number", "product_id", "quantity", "unit_price_kes", "discount_rate", "line_total_kes")
    assert longest_method(narrow) < 8_000
    flags = {r["quality_flag"] for r in lines.collect()}
    assert {"Valid", "Unreadable value", "Invalid quantity", "Invalid line total"} <= flags
    assert rows(kept) == [r for r in rows(lines) if "Valid" in r] and 0 < kept.count() < lines.count()


def test_web_facts_are_not_sorted_before_they_are_dealt_out_by_their_key(spark, monkeypatch):
    lines = spark.createDataFrame(
        [(7, "o2", 1, "p"), (3, "o1", 2, "q"), (4, "o1", 2, "q"), (9, "o1", 1, "p"), (8, "none", 1, "p")],
        "order_line_key bigint, order_id string, line_number int, product_id string",
    ).withColumns({c: F.lit(1.0) for c in ("unit_price_kes", "discount_rate", "line_total_kes")} | {"quantity": F.lit(1)})
    heads = spark.sql(
        "select *, 'c' as customer_id, '10:00:00' as order_time, 'x' as delivery_address, '1' as delivery_fee, 'Card' as payment_method,"
        " 'Delivered' as order_status from values ('o1', date'2020-01-05'), ('o2', date'2020-01-04') as t(order_id, order_date)"
    )
    homes = spark.sql("select 'c' as customer_id, 's9' as primary_store_id, 'x' as home_county")
    dim = spark.sql("select 'p' as product_id, 1 as product_sk, 'sup' as supplier_id, 2.0D as unit_cost_kes, date'2019-01-01' as valid_from, date'2021-01-01' as valid_to")
    periods = by_month(disjoint_periods(dim, "product_id", "product_sk", ["product_sk", "supplier_id", "unit_cost_kes"]), "product_id")
    plans, write = [], keys.materialise
    monkeypatch.setattr(keys, "materialise", lambda df, label: plans.append(plan(df)) or write(df, label))
    facts = gold.ecommerce_fact_sales(lines, heads, periods, homes)
    assert [len(re.findall(r"\bSort ", p)) for p in plans] == [1]
    got = [tuple(r) for r in facts.orderBy("order_line_key").select("order_line_key", "order_id", "line_number", "supplier_id").collect()]
    assert got == [(1, "none", 1, None), (2, "o2", 1, "sup"), (3, "o1", 1, "sup"), (4, "o1", 2, None), (5, "o1", 2, None)]


def test_row_numbers_shuffle_each_column_once(spark):
    df = spark.range(20).select((F.col("id") % 3).alias("k"), "id", F.lit("text").alias("t"))
    numbered = windows.row_numbers(df, ["k"], [F.col("id"), F.col("t")], [F.floor(F.col("id") / 5)], "n")
    assert windows._ORDER not in plan(numbered)
    assert sorted(r["n"] for r in numbered.where("k = 0").collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_web_lines_meet_the_home_store_with_their_head_and_are_measured_after_the_joins(spark):
    lines = spark.createDataFrame(
        [("o1", 1, "p", 2, 10.0, 0.1, 18.0), ("o1", 2, "p", 1, 5.0, 0.0, 5.0), ("o2", 1, "q", 1, 3.0, 0.5, 1.5), ("none", 1, "p", 1, 1.0, 0.0, 1.0)],
        "order_id string, line_number int, product_id string, quantity int, unit_price_kes double, discount_rate double, line_total_kes double",
    )
    heads = spark.sql(
        "select * from values ('o1', 'c1', date'2020-01-05', '10:00:00', 'x', '1', 'Card', 'Delivered'),"
        " ('o2', null, date'2020-02-05', '10:00:00', 'x', '1', 'Card', 'Delivered')"
        " as t(order_id, customer_id, order_date, order_time, delivery_address, delivery_fee, payment_method, order_status)"
    )
    homes = spark.sql("select 'c1' as customer_id, 's9' as primary_store_id, 'x' as home_county")
    dim = spark.sql("select 'p' as product_id, 1 as product_sk, 'sup' as supplier_id, 2.0D as unit_cost_kes, date'2019-01-01' as valid_from, date'2021-01-01' as valid_to")
    periods = by_month(disjoint_periods(dim, "product_id", "product_sk", ["product_sk", "supplier_id", "unit_cost_kes"]), "product_id")
    sold = gold.fact_ecommerce_sales(lines, heads, periods, homes)
    joins = re.findall(r"Join LeftOuter, .*", plan(sold))
    assert len(joins) == 3 and "_pk" in joins[0] and "order_id" in joins[1] and "customer_id" in joins[2]
    got = {(r["transaction_id"], r["line_number"]): (r["store_id"], r["supplier_id"], r["discount_amount_kes"], r["unit_price_after_discount_kes"]) for r in sold.collect()}
    assert got == {("o1", 1): ("s9", "sup", 2.0, 9.0), ("o1", 2): ("s9", "sup", 0.0, 5.0), ("o2", 1): (None, None, 1.5, 1.5), ("none", 1): (None, None, 0.0, 1.0)}


def test_purchase_lines_shuffle_no_column_that_follows_from_others(spark):
    lake = Lake(spark, SF)
    shuffles = re.findall(r"Join LeftOuter.*?Join LeftOuter", plan(lake.gold("fact_procurement")), re.S)
    assert shuffles and not any("landed_cost_kes" in s for s in shuffles)


def test_gated_rows_are_not_sorted_before_they_are_written(spark, tmp_path, monkeypatch):
    seen, publish = [], sinks._publish
    name = "spark.sql.maxConcurrentOutputFileWriters"

    def look(writer, session, path):
        seen.append(session.conf.get(name))
        publish(writer, session, path)

    monkeypatch.setattr(sinks, "_publish", look)
    before = spark.conf.get(name)
    df = spark.range(10)
    counts = sinks.write_gated(df, F.col("id") > 3, str(tmp_path / "t"))
    assert counts == {"kept": 6, "rejected": 4} and int(seen[0]) >= 2 and spark.conf.get(name) == before
    assert sinks.read_gated(df.schema, spark, str(tmp_path / "t"), False).count() == 4
