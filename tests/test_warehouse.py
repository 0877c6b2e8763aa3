"""Bronze loading, and a full run from text extracts to marts."""

from __future__ import annotations

import tempfile
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tallymill.plans.lake import AS_OF, STORE_BRAND, STORE_CODE, Lake, plain
from tallymill.plans.operator_queries import _as_text_file
from tallymill.plans.tables import SILVER
from tallymill.plans.warehouse import GOLD, MARTS, Warehouse, run
from tallymill.sources import bronze, sinks
from tallymill.sources.schemas import PATHS, SCHEMAS


def write(root: str, table: str, text: str) -> None:
    path = Path(root) / PATHS[table]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_schemas():
    assert len(SCHEMAS) == 33
    assert sum(len(s) for s in SCHEMAS.values()) == 243


def test_surplus_fields_stay_in_the_last_column(spark):
    root = tempfile.mkdtemp()
    header = "competitor_id,quarter,revenue_kes,market_share_pct"
    write(root, "competitor_quarterly_raw", f'{header}\nC1,Q1,x,"5,2.5"\r\nC2,,y\n{header}\n\n')
    df = bronze.read_overflow_csv(spark, f"{root}/{PATHS['competitor_quarterly_raw']}", SCHEMAS["competitor_quarterly_raw"])
    assert [tuple(r) for r in df.collect()] == [
        ("C1", "Q1", "x", '"5,2.5"'),
        ("C2", None, "y", None),
        ("competitor_id", "quarter", "revenue_kes", "market_share_pct"),
    ]
    assert df.schema["revenue_kes"].metadata == {"intended_type": "bigint"}


def test_load_stops_or_goes_on_after_an_error(spark):
    root, target = tempfile.mkdtemp(), tempfile.mkdtemp()
    write(root, "competitors_raw", "a,b,c,d\n1,2,3,4\n")
    write(root, "promotion_products_raw", "a,b\n1,2\n3,4\n")
    names = ["competitors_raw", "crm_raw", "promotion_products_raw"]

    def status(**options):
        loaded = bronze.load_bronze(spark, root, target, tables=names, **options)
        return [(r["status"], r["rows_loaded"]) for r in loaded.collect()]

    assert status() == [("LOADED", 1), ("FAILED", None), ("SKIPPED", None), ("completed with errors", 1)]
    assert status(continue_on_error=True)[2] == ("LOADED", 2)
    assert status(continue_on_error=True, truncate_first=False)[2] == ("LOADED", 2)
    assert bronze.read_bronze(spark, target, "promotion_products_raw").count() == 4


def test_gated_write_and_append(spark):
    path = tempfile.mkdtemp() + "/t"
    df = spark.range(10).withColumn("x", F.nullif(F.col("id"), F.lit(3)))
    assert sinks.write_gated(df, F.col("x") < 6, path) == {"kept": 5, "rejected": 5}
    assert sinks.read_gated(df.schema, spark, path).count() == 5
    assert sinks.read_gated(df.schema, spark, path, accepted=False).count() == 5
    other = tempfile.mkdtemp() + "/u"
    assert sinks.append_table(df, other, ["id"]) + sinks.append_table(df, other, ["id"]) == 20
    assert spark.read.parquet(other).columns == ["id"]


@pytest.fixture(scope="module")
def house(spark):
    lake, extracts, root = Lake(spark, SF), tempfile.mkdtemp(), tempfile.mkdtemp()
    for table in SCHEMAS:
        _as_text_file(lake, table, extracts)
    log = run(
        spark, extracts, root, AS_OF, batch_id="b1", at=datetime(2024, 6, 30), brand=STORE_BRAND, brand_code=STORE_CODE
    )
    return lake, Warehouse(spark, root, AS_OF), {r["table_name"]: r for r in log.collect()}


def test_full_run_logs_every_table(house):
    _, _, log = house
    assert [n for n, r in log.items() if r["status"] != "SUCCESS"] == []
    assert len(log) == len(SCHEMAS) + len(SILVER) + len(GOLD) + len(MARTS) + 3
    assert log["silver.pos_line_items"]["rows_inserted"] > 0


@pytest.mark.parametrize("name", ["fact_sales", "fact_gift_card", "dim_date", "bridge_product"])
def test_written_gold_equals_the_lazy_tables(house, name):
    lake, warehouse, _ = house
    table = lake.gold(name)
    written = warehouse.read("gold", name).select(*table.columns)
    a, b = plain(table), plain(written)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_quarantine_and_keys(house):
    _, warehouse, log = house
    rejected = warehouse.rejected("pos_line_items")
    assert rejected.count() > 0 and rejected.where("quality_flag = 'Valid'").isEmpty()
    lines = warehouse.read("silver", "pos_line_items")
    n = log["silver.pos_line_items"]["rows_inserted"]
    assert lines.agg(F.min("pos_line_key"), F.max("pos_line_key"), F.count_distinct("pos_line_key")).first() == (1, n, n)
    assert warehouse.duplicates("crm").isEmpty()
    assert warehouse.duplicates("pos_transactions").isEmpty()


def test_checks_of_the_run(house):
    _, warehouse, log = house
    found = {(r["table_name"], r["check_name"]): r["n_rows"] for r in warehouse.read("log", "quality").collect()}
    assert log["log.quality"]["rows_inserted"] == len(found)
    assert found["ecommerce_orders", "Total Rows"] == log["silver.ecommerce_orders"]["rows_inserted"]
    assert found["crm", "repeated keys"] == found["pos_transactions", "repeated keys"] == 0
    assert found["pos_line_items", "rejected: Unreadable value"] > 0
    rejected = warehouse.rejected("pos_line_items").count()
    assert sum(n for (table, check), n in found.items() if table == "pos_line_items" and check[:8] == "rejected") == rejected


def test_staff_keys_agree_with_the_written_dimension(house):
    _, warehouse, _ = house
    dim = warehouse.read("gold", "dim_employee")
    facts = warehouse.read("gold", "fact_time_attendance")
    staff = facts.where("employee_sk is not null").select("employee_sk").distinct()
    assert staff.count() > 0 and staff.join(dim, "employee_sk", "left_anti").isEmpty()
    bridge = warehouse.read("gold", "bridge_employee")
    assert bridge.join(dim, ["employee_sk", "employee_id"], "left_anti").isEmpty()


def test_as_of_is_a_parameter(spark):
    early = Lake(spark, SF, date(2020, 1, 1)).silver("crm")
    assert early.agg(F.max("age")).first()[0] < Lake(spark, SF).silver("crm").agg(F.max("age")).first()[0]


def test_a_refresh_that_fails_leaves_the_old_rows(spark):
    path = tempfile.mkdtemp() + "/t"
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path)
    assert sinks.replace_table(spark.range(5), path) == 5
    dies = spark.range(100, numPartitions=4).withColumn("id", F.when(F.col("id") > 90, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(dies, path)
    assert sinks.read_table(spark, path).count() == 5
    reader = sinks.read_table(spark, path)
    assert sinks.replace_table(spark.range(7), path) == 7
    assert reader.count() == 5 and sinks.read_table(spark, path).count() == 7
    sinks.replace_table(spark.range(8), path)
    kept = [p.name for p in Path(path).iterdir()]
    assert len(kept) == 2 and sinks.read_table(spark, path).count() == 8


def test_batches_are_appended_once(spark):
    path, at = tempfile.mkdtemp() + "/b", datetime(2024, 1, 1)
    assert sinks.append_batch(spark.range(3), path, "s", at, "b1") == 3
    for _ in range(2):
        assert sinks.append_batch(spark.range(4), path, "s", at, "b2") == 4
    counts = spark.read.parquet(path).groupBy("etl_batch_id").count().collect()
    assert {(r[0], r[1]) for r in counts} == {("b1", 3), ("b2", 4)}


def test_text_that_does_not_parse_is_set_apart(house, spark):
    from tallymill.operators import rescue

    lake, warehouse, _ = house
    for name in [n for n, spec in SILVER.items() if spec.typed is not None]:
        texts = warehouse.read("unread", name).select(F.explode(F.map_values("unread")).alias("text")).distinct()
        found = [r[0] for r in texts.collect()]
        assert found and all(x.endswith("abc") for x in found), name
    with pytest.raises(Exception, match="abc"):
        rescue.strict(lake.raw("hr_raw"), SILVER["hr"].typed).write.format("noop").mode("overwrite").save()
    raw = spark.createDataFrame([("1", "2024-01-01"), ("NaN", "2023-13-45"), ("x", "x"), ("", None), ("n/a", "NULL")], "n string, d string")
    types = {"n": "double", "d": "date"}
    assert [r.unread for r in rescue.rescued(raw, types).collect()] == [{"n": "NaN"}, {"n": "x", "d": "x"}]
    assert rescue.readable(raw, types).count() == 3


def test_a_second_batch_and_its_repeat(house, spark):
    _, warehouse, log = house
    n = log["history.ecommerce_orders"]["rows_inserted"]
    assert n == log["silver.ecommerce_orders"]["rows_inserted"] and log["log.latest_orders"]["rows_inserted"] == 20
    for _ in range(2):
        warehouse.append_orders("b2", datetime(2024, 7, 1))
    history = spark.read.parquet(warehouse.path("history", "ecommerce_orders"))
    assert {(r[0], r[1]) for r in history.groupBy("etl_batch_id").count().collect()} == {("b1", n), ("b2", n)}
    warehouse.build_preview()
    assert {r.etl_batch_id for r in warehouse.read("log", "latest_orders").collect()} == {"b2"}


def test_products_and_campaigns_keep_rows_with_text_that_does_not_parse(spark):
    lake = Lake(spark, SF)
    columns = "product_id valid_from valid_to product_name category subcategory brand supplier_id unit_cost_kes retail_price_kes margin_percentage introduction_date discontinued_date is_active"
    day = "2017-01-01"
    goods = [(f"P{i}", day, None, "n", "c", "s", "b", "S1", cost, "20", "5", day, None, "TRUE") for i, cost in enumerate(("10", "abc", "NaN", "n/a"))]
    campaigns = [(f"C{i}", "n", "t", "Radio", day, day, budget, "7", "0.1") for i, budget in enumerate(("10", "abc", None))]
    raw = {
        "products_raw": spark.createDataFrame(goods, ", ".join(f"{c} string" for c in columns.split())),
        "campaigns_raw": spark.createDataFrame(
            campaigns, ", ".join(f"{c} string" for c in "campaign_id campaign_name campaign_type channel start_date end_date budget_kes actual_spend_kes discount_rate".split())
        ),
    }
    lake.raw = raw.__getitem__
    costs = {r.product_id: r.unit_cost_kes for r in lake.silver("products").collect()}
    assert costs == {"P0": 10.0, "P1": None, "P2": None, "P3": None}
    assert lake.gold("dim_product").count() == 4
    spent = {r.campaign_id: (r.budget_kes, r.actual_spend_kes, r.budget_utilisation_pct) for r in lake.gold("dim_campaign").collect()}
    assert spent == {"C0": (10, 7, 70.0), "C1": (None, 7, None), "C2": (None, 7, None)}
