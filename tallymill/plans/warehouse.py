"""A full run: text extracts → bronze → silver → gold → marts, every layer written."""

from __future__ import annotations

from datetime import date, datetime
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators import rescue
from tallymill.operators.keys import dense_key
from tallymill.operators.quality import duplicate_keys, reconcile
from tallymill.plans.audit import of_latest_batch, order_metrics, order_violations, preview
from tallymill.plans.lake import Lake
from tallymill.plans.tables import SILVER
from tallymill.sources import bronze, sinks

# in the order they depend on each other
GOLD = (
    "dim_date", "dim_campaign", "dim_customers", "dim_employee", "dim_store", "dim_supplier", "dim_product",
    "dim_geography_economic", "bridge_product", "bridge_store", "bridge_employee", "card_owners", "cust_county", "pos_heads", "web_heads", "po_heads",
    "receipts_per_line", "sale_origins", "fact_pos_sales", "fact_ecommerce_sales", "fact_sales",
    "ecommerce_fact_sales", "fact_returns", "fact_loyalty", "fact_inventory_movements",
    "fact_customer_experience", "fact_gift_card", "fact_time_attendance", "fact_procurement",
    "agg_store_financials", "agg_inventory_snapshot", "agg_competitor_benchmark",
)
MARTS = (
    "mart_sales", "mart_campaign_roi", "mart_customer", "mart_supply", "mart_stock", "mart_finance", "mart_workforce",
)
# facts kept in monthly folders, with the date that decides
MONTHLY = {
    "fact_pos_sales": "transaction_date",
    "fact_ecommerce_sales": "transaction_date",
    "fact_sales": "transaction_date",
    "ecommerce_fact_sales": "order_date",
    "fact_inventory_movements": "movement_date",
}


class Warehouse(Lake):
    """Tables under ``root``; whatever a table needs is read from what is written."""

    def __init__(
        self, spark: SparkSession, root: str, as_of: date, brand: str = "", brand_code: str = "", strict: bool = False
    ):
        super().__init__(spark, root, as_of)
        self.strict = strict
        self.root, self.brand, self.brand_code = root.rstrip("/"), brand, brand_code
        # what a gold table is made from is read as written: built once, and with the keys that were given then
        self.gold = cache(self._fixed)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return sinks.read_table(self.spark, self.path(layer, name))

    def _raw(self, name: str) -> DataFrame:
        return bronze.read_bronze(self.spark, f"{self.root}/bronze", name)

    def _silver(self, name: str) -> DataFrame:
        return self.read("silver", name).drop("etl_load_date", "etl_source")

    def keyed(self, name: str, *columns: str) -> DataFrame:
        return self.silver(name)

    def receipts(self) -> DataFrame:
        return self.silver("pos_transactions")

    def _fixed(self, name: str) -> DataFrame:
        return self.read("gold", name)

    # --- building ----------------------------------------------------------
    def build_silver(self, name: str) -> dict[str, int]:
        """Write one silver table; rejected rows stay readable beside it."""
        spec = SILVER[name]
        frames = [self._raw(s) if s.endswith("_raw") else self.silver(s) for s in spec.sources]
        if spec.typed is not None and self.strict:
            frames[0] = rescue.strict(frames[0], spec.typed)
        elif spec.typed is not None:
            lost = rescue.rescued(frames[0], spec.typed)
            sinks.replace_table(lost, self.path("unread", name))
            frames[0] = rescue.blanked(frames[0], spec.typed) if spec.whole else rescue.readable(frames[0], spec.typed)
        options = {"brand": self.brand, "brand_code": self.brand_code} if name == "stores" else {}
        flagged = spec.make(self.as_of, *frames, **options)
        counts: dict[str, int] = {}
        ready = flagged
        if spec.keep is not None:
            gated = self.path("gated", name)
            counts = sinks.write_gated(flagged, spec.keep(), gated)
            ready = sinks.read_gated(flagged.schema, self.spark, gated).drop(*spec.evidence)
        if spec.surrogate is not None:
            key, order = spec.surrogate
            ready = dense_key(ready, [F.col(c) for c in order], key, steady=spec.steady or spec.keep is not None)
        stamped = sinks.with_audit(ready, f"silver.{name}", self.as_of)
        counts["rows"] = sinks.replace_table(stamped, self.path("silver", name), spec.sort)
        return counts

    def rejected(self, name: str) -> DataFrame:
        """The quarantine of a gated table."""
        both = self.read("gated", name)
        return both.where(~F.col("accepted")).drop("accepted")

    def build_gold(self, name: str) -> int:
        table = self._gold(name)
        path = self.path("marts" if name in MARTS else "gold", name)
        if name not in MONTHLY:
            return sinks.replace_table(table, path)
        return sinks.replace_monthly(table, MONTHLY[name], path)

    def quality(self) -> DataFrame:
        """What is looked at after a load, one row per table and check, from what the run wrote."""

        def named(table: str, df: DataFrame, check: str, n: str) -> DataFrame:
            return df.select(F.lit(table).alias("table_name"), F.col(check).alias("check_name"), F.col(n).cast("long").alias("n_rows"))

        orders = self.read("silver", "ecommerce_orders")
        parts = [
            named("ecommerce_orders", order_metrics(orders), "metric", "value"),
            named("ecommerce_orders", order_violations(orders, self.as_of), "check_name", "n_violations"),
            named("ecommerce_orders", reconcile(self._raw("ecommerce_orders_raw"), orders), "source", "row_count"),
        ]
        for name, spec in SILVER.items():
            if spec.unique is not None:
                repeated = self.duplicates(name).agg(F.count(F.lit(1)).alias("n")).withColumn("check", F.lit("repeated keys"))
                parts.append(named(name, repeated, "check", "n"))
            if spec.keep is not None and "quality_flag" in self.rejected(name).columns:
                flags = self.rejected(name).groupBy("quality_flag").agg(F.count(F.lit(1)).alias("n"))
                parts.append(named(name, flags.withColumn("check", F.concat(F.lit("rejected: "), "quality_flag")), "check", "n"))
        return reduce(DataFrame.unionByName, parts)

    def build_quality(self) -> int:
        return sinks.replace_table(self.quality(), self.path("log", "quality"))

    def append_orders(self, batch_id: str, at: datetime) -> int:
        """Keep the web orders of this load as a batch; loading a batch again changes nothing."""
        orders = self.silver("ecommerce_orders")
        return sinks.append_batch(orders, self.path("history", "ecommerce_orders"), "silver.ecommerce_orders", at, batch_id)

    def build_preview(self) -> int:
        """The first orders of the latest batch."""
        orders = of_latest_batch(self.spark.read.parquet(self.path("history", "ecommerce_orders")), "created_date")
        first = preview(orders, ["order_id", "order_date", "order_time", "amount"])
        return sinks.replace_table(first, self.path("log", "latest_orders"))

    def duplicates(self, name: str) -> DataFrame:
        """Rows that break the key the table is meant to have."""
        return duplicate_keys(self.read("silver", name), list(SILVER[name].unique))


def run(
    spark: SparkSession,
    extracts: str,
    root: str,
    as_of: date,
    *,
    batch_id: str,
    at: datetime,
    brand: str = "",
    brand_code: str = "",
    continue_on_error: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Load ``extracts`` and build every table under ``root``.

    Each step appends a line to the load log, which is returned. A failed step
    stops the run unless ``continue_on_error``; the log then shows it. A ``strict`` run
    fails on text that does not parse instead of setting it apart.
    """
    house = Warehouse(spark, root, as_of, brand, brand_code, strict)
    log = house.path("log", "etl_load_log")
    loaded = bronze.load_bronze(
        spark, extracts, f"{house.root}/bronze", continue_on_error=continue_on_error
    ).where("table_name <> '*'")
    bad = 0
    for row in loaded.collect():  # one row per manifest entry
        failed = row["status"] != "LOADED"
        bad += failed
        sinks.log_load(
            spark, log, f"bronze.{row['table_name']}", row["rows_loaded"],
            batch_id, at, (row["error"] or row["status"]) if failed else None,
        )
    steps = [(f"silver.{n}", lambda n=n: house.build_silver(n)["rows"]) for n in SILVER]
    steps += [(f"gold.{n}", lambda n=n: house.build_gold(n)) for n in (*GOLD, *MARTS)]
    steps.append(("history.ecommerce_orders", lambda: house.append_orders(batch_id, at)))
    steps.append(("log.latest_orders", house.build_preview))
    steps.append(("log.quality", house.build_quality))
    for name, step in steps:
        if bad and not continue_on_error:
            break
        try:
            sinks.log_load(spark, log, name, step(), batch_id, at)
        except Exception as err:  # noqa: BLE001 - reported in the log
            bad += 1
            sinks.log_load(spark, log, name, None, batch_id, at, str(err).splitlines()[0])
    return spark.read.schema(sinks.LOG_SCHEMA).parquet(log)
