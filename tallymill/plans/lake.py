"""A lazily built medallion over one folder of benchmark tables."""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.operators.keys import dense_key
from tallymill.operators.rescue import blanked, readable
from tallymill.operators.versions import MonthlyPeriods, by_month
from tallymill.plans import derive, gold, marts
from tallymill.plans.silver_sales import pos_transaction_heads
from tallymill.plans.tables import SILVER
from tallymill.session import materialise

AS_OF = date(2024, 6, 30)
STORE_BRAND, STORE_CODE = "Chain Store", "cs_"
#: Bridges and the key by which facts meet them.
BRIDGED = {"bridge_product": "product_id", "bridge_store": "store_id", "bridge_employee": "employee_id"}
#: Raw tables that silver reads several times, for windows in chunks.
REREAD = ("inventory_movements_raw", "gift_card_transactions_raw")

#: Bytes up to which an input counts as small.
SMALL_INPUT = 256 << 20


def dealt(df: DataFrame) -> DataFrame:
    """A small table, written again in as many files as there are cores.

    Its file may hold a single row group, which one task has to read, whatever is then
    done with the rows. Larger tables have splits enough and stay as they lie.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SMALL_INPUT:
        return df
    return materialise(df.repartition(df.sparkSession.sparkContext.defaultParallelism), "dealt")


class Lake:
    """Bronze from ``derive``, silver and gold from the table functions.

    Raw tables made row by row are read as they are derived; those that are grouped, joined or
    read several times are written first, as are the gold tables that facts join. Silver stays lazy, and each query builds only the
    tables it needs. A production run (``tallymill.plans.warehouse``) writes all.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: date = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.dealt = cache(lambda name: dealt(self.base(name)))
        self.raw = cache(self._raw)
        self.silver = cache(self._silver)
        self.gold = cache(self._gold)
        self.fixed = cache(self._fixed)
        self.monthly = cache(self._monthly)

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _raw(self, name: str) -> DataFrame:
        raw = derive.raw(self.spark, self.dealt, name)
        return raw if derive.row_by_row(name) and name not in REREAD else materialise(raw, name)

    def flagged(self, name: str) -> DataFrame:
        """All rows of a silver table, those its gate rejects included."""
        spec = SILVER[name]
        frames = [self.raw(s) if s.endswith("_raw") else self.silver(s) for s in spec.sources]
        if spec.typed is not None:
            frames[0] = blanked(frames[0], spec.typed) if spec.whole else readable(frames[0], spec.typed)
        options = {"brand": STORE_BRAND, "brand_code": STORE_CODE} if name == "stores" else {}
        return spec.make(self.as_of, *frames, **options)

    def _silver(self, name: str) -> DataFrame:
        keep = SILVER[name].keep
        flagged = self.flagged(name)
        return flagged if keep is None else flagged.where(keep()).drop(*SILVER[name].evidence)

    def keyed(self, name: str, *columns: str) -> DataFrame:
        """The kept rows with the table's surrogate key; of ``columns`` and those of the key's order, if any are given."""
        key, order = SILVER[name].surrogate
        rows = self.silver(name)
        if columns:
            rows = rows.select(*[c for c in rows.columns if c in (*order, *columns)])
        return dense_key(rows, [F.col(c) for c in order], key, steady=SILVER[name].steady)

    def receipts(self) -> DataFrame:
        """Kept till receipts without their line sums, for those who need no sum."""
        heads = pos_transaction_heads(self.raw("pos_transactions_raw"), self.as_of)
        return heads.where(SILVER["pos_transactions"].keep())

    def _fixed(self, name: str) -> DataFrame:
        """A gold table that others join, written and read back: the join then knows
        its size, and Spark may broadcast it or split hot keys of the other side."""
        return materialise(self.gold(name), name)

    def _monthly(self, bridge: str) -> MonthlyPeriods:
        """A bridge as facts meet it, split once for all of them."""
        return by_month(self.fixed(bridge), BRIDGED[bridge])

    def _gold(self, name: str) -> DataFrame:
        s, g = self.silver, self.gold
        match name:
            case "dim_date":
                sources = {
                    "campaigns": "start_date",
                    "crm": "registration_date",
                    "ecommerce_orders": "order_date",
                    "economic": "date",
                    "feedback": "feedback_date",
                    "gl_transactions": "transaction_date",
                    "goods_receipts": "receipt_date",
                    "inventory_movements_slim": "movement_date",
                    "inventory_snapshots": "snapshot_date",
                    "loyalty_transactions": "transaction_date",
                    "returns": "return_date",
                    "service_interactions": "interaction_date",
                }
                days = [s(t).select(c) for t, c in sources.items()]
                return gold.dim_date(*days, self.receipts().select("transaction_date"))
            case "dim_campaign":
                return gold.dim_campaign(s("campaigns"))
            case "dim_customers":
                return gold.dim_customers(s("crm"), self.as_of)
            case "dim_employee":
                return gold.dim_employee(s("hr"), self.as_of)
            case "dim_store":
                return gold.dim_store(s("stores"))
            case "dim_supplier":
                return gold.dim_supplier(s("suppliers"))
            case "dim_product":
                return gold.dim_product(self.keyed("products"))
            case "dim_geography_economic":
                return gold.dim_geography_economic(s("gis_counties"), s("economic"))
            case "bridge_product":
                return gold.bridge_product(g("dim_product"))
            case "bridge_store":
                return gold.bridge_store(g("dim_store"))
            case "bridge_employee":
                return gold.bridge_employee(g("dim_employee"))
            case "card_owners":
                return gold.card_owners(s("gift_cards"))
            case "cust_county":
                return gold.cust_county(self.receipts(), s("stores"))
            case "pos_heads":
                return gold.pos_heads(self.receipts())
            case "web_heads":
                return gold.web_heads(s("ecommerce_orders"))
            case "po_heads":
                return gold.po_heads(s("purchase_orders"))
            case "receipts_per_line":
                return gold.receipts_per_line(s("goods_receipts"))
            case "sale_origins":
                return gold.sale_origins(self.receipts(), s("ecommerce_orders"))
            case "fact_pos_sales":
                return gold.fact_pos_sales(s("pos_line_items"), self.fixed("pos_heads"), self.monthly("bridge_product"))
            case "fact_ecommerce_sales":
                return gold.fact_ecommerce_sales(
                    s("ecommerce_order_lines"),
                    self.fixed("web_heads"),
                    self.monthly("bridge_product"),
                    self.fixed("cust_county"),
                )
            case "ecommerce_fact_sales":
                return gold.ecommerce_fact_sales(
                    self.keyed("ecommerce_order_lines", "order_id"),
                    self.fixed("web_heads"),
                    self.monthly("bridge_product"),
                    self.fixed("cust_county"),
                )
            case "fact_sales":
                return gold.fact_sales(g("fact_pos_sales"), g("fact_ecommerce_sales"))
            case "fact_returns":
                return gold.fact_returns(s("returns"), self.monthly("bridge_product"), self.fixed("sale_origins"))
            case "fact_loyalty":
                return gold.fact_loyalty(s("loyalty_transactions"))
            case "fact_inventory_movements":
                return gold.fact_inventory_movements(
                    s("inventory_movements"), self.monthly("bridge_product"), self.monthly("bridge_store")
                )
            case "fact_customer_experience":
                return gold.fact_customer_experience(s("feedback"))
            case "fact_gift_card":
                return gold.fact_gift_card(s("gift_card_transactions"), self.fixed("card_owners"))
            case "fact_time_attendance":
                return gold.fact_time_attendance(s("time_tracking"), self.monthly("bridge_employee"))
            case "fact_procurement":
                return gold.fact_procurement(
                    s("purchase_order_lines"), self.fixed("po_heads"), self.fixed("receipts_per_line")
                )
            case "agg_store_financials":
                return gold.agg_store_financials(s("store_daily_financials"))
            case "agg_inventory_snapshot":
                return gold.agg_inventory_snapshot(s("inventory_snapshots"))
            case "agg_competitor_benchmark":
                return gold.agg_competitor_benchmark(s("competitor_quarterly"), s("competitors"))
            case "mart_sales":
                return marts.sales(g("fact_sales"), s("returns"))
            case "mart_campaign_roi":
                return marts.campaign_roi(g("fact_pos_sales"), s("campaigns"))
            case "mart_customer":
                return marts.customer(g("dim_customers"), g("fact_loyalty"), g("fact_customer_experience"))
            case "mart_supply":
                return marts.supply(g("fact_procurement"))
            case "mart_stock":
                return marts.stock_health(g("agg_inventory_snapshot"), s("inventory_movements"))
            case "mart_finance":
                return marts.finance(g("agg_store_financials"), s("stores"))
            case "mart_workforce":
                return marts.workforce(g("dim_employee"), g("fact_time_attendance"), self.as_of)
        raise KeyError(name)


def plain(df: DataFrame) -> DataFrame:
    """Reduce the columns to text, bigint and double for comparison across engines."""

    def cast(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.BooleanType)):
            c = c.cast("int").cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        return c.alias(f.name)

    return df.select(*[cast(f) for f in df.schema.fields])
