"""Scans, writes, projections, filters, aggregates, sorts and set operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.audit import add_audit, batch_label
from strataflow.functions.columns import money_sum, with_tax
from strataflow.operators import aggregates, dedup, joins, quality, shaping
from strataflow.plans import loads
from strataflow.queries.landing import Landing
from strataflow.queries.registry import query
from strataflow.session import scratch_path
from strataflow.sources import files

SALES = ("sales",)
BATCHES = ("orders_full", "orders_later")
MONEY = "CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"


@query("csv_explicit_schema", "SELECT * FROM sales", SALES)
def csv_explicit_schema(land: Landing) -> DataFrame:
    return land.sales()


@query(
    "csv_infer_schema",
    "SELECT customer_id, CAST(address_id AS BIGINT) AS address_id, address_type FROM addresses",
    ("addresses",),
)
def csv_infer_schema(land: Landing) -> DataFrame:
    found = files.read_csv_inferred(land.spark, land.csv("addresses"))
    # A detected integer is as wide as the values met so far: fix the width.
    return quality.enforce_schema(
        found, schemas.contract("customer_id BIGINT, address_id BIGINT, address_type STRING")
    )


@query("table_scan", "SELECT * FROM sales", SALES)
def table_scan(land: Landing) -> DataFrame:
    return land.spark.table(sales_table(land))


def sales_table(land: Landing) -> str:
    return land.once("table:sales", lambda: load_sales(land))


def load_sales(land: Landing) -> str:
    name = land.new_table("sales")
    loads.full_load(land.sales(), name)
    return name


@query(
    "full_load",
    "SELECT *, 'shop' AS source_system, 'full_1' AS batch_id, true AS has_time, true AS has_file FROM sales",
    SALES,
)
def full_load(land: Landing) -> DataFrame:
    name = land.new_table("full_load")
    loads.full_load(add_audit(land.sales(), "shop", "full_1", source_file=True), name)
    return audit_as_flags(land.spark.table(name))


def audit_as_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"has_time": F.col("ingestion_timestamp").isNotNull(), "has_file": F.col("source_file").isNotNull()}
    ).drop("ingestion_timestamp", "source_file")


@query("write_path", "SELECT * FROM sales", SALES)
def write_path(land: Landing) -> DataFrame:
    path = scratch_path(land.spark, "sales_parquet")
    loads.write_path(land.sales(), path)
    return land.spark.read.parquet(path)


@query(
    "sales_by_region_category",
    f"SELECT region, category, {MONEY} AS total_amount, COUNT(*) AS n_rows FROM sales "
    "GROUP BY region, category ORDER BY total_amount DESC, region, category",
    SALES,
)
def sales_by_region_category(land: Landing) -> DataFrame:
    """Land with audit columns, overwrite the table, report from it."""
    name = land.new_table("sales_report")
    loads.full_load(add_audit(land.sales(), "shop", "full_1", source_file=True), name)
    return aggregates.totals_by(land.spark.table(name), ["region", "category"], "amount")


@query("sort_multi", "SELECT category, amount, sale_id FROM sales ORDER BY category DESC, amount, sale_id", SALES)
def sort_multi(land: Landing) -> DataFrame:
    return land.sales().select("category", "amount", "sale_id").orderBy(
        F.col("category").desc(), F.col("amount").asc(), F.col("sale_id")
    )


@query("topk", "SELECT sale_id, region, amount FROM sales ORDER BY amount DESC, sale_id LIMIT 15", SALES)
def topk(land: Landing) -> DataFrame:
    rows = land.sales().select("sale_id", "region", "amount")
    return shaping.top_k(rows, 15, F.col("amount").desc(), F.col("sale_id"))


@query(
    "basic_aggregates",
    f"SELECT status, COUNT(*) AS n_rows, {MONEY} AS sum_amount, {MONEY} / COUNT(*) AS avg_amount, "
    "MIN(amount) AS min_amount, MAX(amount) AS max_amount FROM sales GROUP BY status",
    SALES,
)
def basic_aggregates(land: Landing) -> DataFrame:
    return land.sales().groupBy("status").agg(
        F.count(F.lit(1)).alias("n_rows"),
        money_sum("amount").alias("sum_amount"),
        (money_sum("amount") / F.count(F.lit(1))).alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


@query(
    "computed_column",
    "SELECT sale_id, amount, amount * CAST(1.18 AS DOUBLE) AS amount_with_tax, amount * 2 AS doubled FROM sales",
    SALES,
)
def computed_column(land: Landing) -> DataFrame:
    return (
        land.sales().select("sale_id", "amount")
        .withColumn("amount_with_tax", with_tax("amount", 0.18))
        .withColumn("doubled", F.col("amount") * 2)
    )


@query(
    "case_when",
    "SELECT sale_id, CASE WHEN amount < 100000 THEN 'low' WHEN amount < 300000 THEN 'middle' ELSE 'high' END AS band "
    "FROM sales",
    SALES,
)
def case_when(land: Landing) -> DataFrame:
    amount = F.col("amount")
    band = F.when(amount < 100000, "low").when(amount < 300000, "middle").otherwise("high")
    return land.sales().select("sale_id", band.alias("band"))


@query(
    "filter_predicates",
    "SELECT sale_id, region, amount FROM sales WHERE region = 'AMERICA' AND amount > 200000 "
    "AND category IS NOT NULL AND NOT (status IS NULL)",
    SALES,
)
def filter_predicates(land: Landing) -> DataFrame:
    return (
        land.spark.table(sales_table(land))
        .filter((F.col("region") == "AMERICA") & (F.col("amount") > 200000))
        .where("category IS NOT NULL")
        .filter(~F.col("status").isNull())
        .select("sale_id", "region", "amount")
    )


@query("project_columns", "SELECT sale_id, region FROM sales", SALES)
def project_columns(land: Landing) -> DataFrame:
    return land.spark.table(sales_table(land)).select("sale_id", F.col("region"))


@query("rename_drop", "SELECT sale_id, sale_date, customer_id, region AS area, nation, category, status FROM sales", SALES)
def rename_drop(land: Landing) -> DataFrame:
    return land.sales().withColumnRenamed("region", "area").drop("amount")


@query("distinct_values", "SELECT DISTINCT region, status FROM sales", SALES)
def distinct_values(land: Landing) -> DataFrame:
    return land.sales().select("region", "status").distinct()


@query(
    "date_functions",
    "SELECT sale_id, strftime(sale_date, '%d/%m/%Y') AS day_text, sale_date AS day_again, "
    "strftime(sale_date, '%Y-%m') AS month FROM sales",
    SALES,
)
def date_functions(land: Landing) -> DataFrame:
    text = land.sales().select(
        "sale_id", F.date_format("sale_date", "dd/MM/yyyy").alias("day_text"),
        F.date_format("sale_date", "yyyy-MM").alias("month"),
    )
    return text.withColumn("day_again", F.to_date("day_text", "dd/MM/yyyy"))


@query(
    "audit_columns",
    "SELECT *, 'erp' AS source_system, 'full_1' AS batch_id, true AS has_time, true AS has_file FROM orders_full "
    "UNION ALL "
    "SELECT *, 'erp' AS source_system, 'later_1' AS batch_id, true AS has_time, true AS has_file FROM orders_later",
    BATCHES,
)
def audit_columns(land: Landing) -> DataFrame:
    return audit_as_flags(shaping.union_by_name(*batches(land)))


def batches(land: Landing) -> list[DataFrame]:
    return [
        add_audit(land.orders(name), "erp", batch, source_file=True)
        for name, batch in (("orders_full", "full_1"), ("orders_later", "later_1"))
    ]


def appended_table(land: Landing) -> str:
    return land.once("table:orders", lambda: load_batches(land))


def load_batches(land: Landing) -> str:
    name = land.new_table("orders")
    first, second = batches(land)
    loads.full_load(first, name, partition_by=["batch_id"])
    loads.append_load(second, name, partition_by=["batch_id"])
    return name


@query(
    "incremental_append",
    "SELECT *, 'full_1' AS batch_id FROM orders_full UNION ALL SELECT *, 'later_1' AS batch_id FROM orders_later",
    BATCHES,
)
def incremental_append(land: Landing) -> DataFrame:
    return land.spark.table(load_batches(land)).drop("ingestion_timestamp", "source_file", "source_system")


@query(
    "batch_compare",
    "SELECT 'full_1' AS batch_id, 'erp' AS source_system, COUNT(*) AS n_rows, MIN(order_date) AS min_order_date, "
    "MAX(order_date) AS max_order_date FROM orders_full UNION ALL "
    "SELECT 'later_1', 'erp', COUNT(*), MIN(order_date), MAX(order_date) FROM orders_later",
    BATCHES,
)
def batch_compare(land: Landing) -> DataFrame:
    return aggregates.compare_batches(
        land.spark.table(appended_table(land)), ["batch_id", "source_system"], "order_date"
    ).orderBy("min_order_date")


@query(
    "describe_table",
    """, columns(col_name, data_type) AS (VALUES ('sale_id','bigint'), ('sale_date','date'),
    ('customer_id','bigint'), ('region','string'), ('nation','string'), ('category','string'),
    ('status','string'), ('amount','double'))
    SELECT col_name, data_type, (SELECT COUNT(*) FROM sales) AS n_rows FROM columns""",
    SALES,
)
def describe_table(land: Landing) -> DataFrame:
    name = sales_table(land)
    n_rows = land.spark.table(name).count()
    return loads.describe(land.spark, name).select("col_name", "data_type", F.lit(n_rows).cast("bigint").alias("n_rows"))


@query(
    "landing_inventory",
    "SELECT 'orders_full' AS lot, true AS lists_every_file, true AS has_bytes FROM orders_full "
    "UNION SELECT 'orders_later', true, true FROM orders_later",
    BATCHES,
)
def landing_inventory(land: Landing) -> DataFrame:
    lots = ("orders_full", "orders_later")
    listed = [files.inventory(land.spark, land.csv(name), "*.csv").withColumn("lot", F.lit(name)) for name in lots]
    read = [land.spark.read.text(land.csv(name)).select(F.lit(name).alias("lot"), "_metadata.file_path") for name in lots]
    present = shaping.union_by_name(*read).groupBy("lot").agg(F.countDistinct("file_path").alias("n_read"))
    found = shaping.union_by_name(*listed).filter("length > 0").groupBy("lot").agg(
        F.count("path").alias("n_listed"), (F.sum("length") > 0).alias("has_bytes")
    )
    return found.join(present, "lot").select("lot", (F.col("n_listed") == F.col("n_read")).alias("lists_every_file"), "has_bytes")


@query("batch_id_from_clock", "SELECT sale_id, 'sales_20260630_0905' AS batch_id FROM sales", SALES)
def batch_id_from_clock(land: Landing) -> DataFrame:
    label = batch_label("sales", datetime(2026, 6, 30, 9, 5))
    return add_audit(land.sales(), batch_id=label).select("sale_id", "batch_id")


@query(
    "drop_qualified",
    "SELECT customer_id, address_id, city FROM addresses JOIN address_reference USING (address_id)",
    ("addresses", "address_reference"),
)
def drop_qualified(land: Landing) -> DataFrame:
    """After a join on a condition, the second of two columns of one name goes."""
    bridge, reference = land.addresses(), land.address_reference()
    joined = bridge.join(reference, bridge["address_id"] == reference["address_id"])
    return joined.drop(reference["address_id"]).select("customer_id", "address_id", "city")


# Set operations on the address bridge

ADDRESSES = ("addresses",)


@query("union_by_name", "SELECT * FROM addresses", ADDRESSES)
def union_by_name(land: Landing) -> DataFrame:
    main = land.addresses().filter(F.col("address_type") == "Principal")
    other = land.addresses().filter(F.col("address_type") != "Principal")
    return shaping.union_by_name(main, other.select("address_type", "address_id", "customer_id"))


@query(
    "union_positional",
    "SELECT customer_id AS id, address_id AS target FROM addresses UNION ALL "
    "SELECT customer_id, CAST(LENGTH(address_type) AS INT) FROM addresses",
    ADDRESSES,
)
def union_positional(land: Landing) -> DataFrame:
    bridge = land.addresses()
    first = bridge.select(F.col("customer_id").alias("id"), F.col("address_id").alias("target"))
    return shaping.union_by_position(first, bridge.select("customer_id", F.length("address_type")))


@query("drop_duplicates_subset", "SELECT DISTINCT customer_id, address_id FROM addresses", ADDRESSES)
def drop_duplicates_subset(land: Landing) -> DataFrame:
    both = shaping.union_by_name(land.addresses(), land.addresses())
    return dedup.distinct_by(both, ["customer_id", "address_id"]).select("customer_id", "address_id")


@query("join_cross", ", a AS (SELECT DISTINCT category FROM sales), b AS (SELECT DISTINCT region FROM sales) "
       "SELECT category, region FROM a CROSS JOIN b", SALES)
def join_cross(land: Landing) -> DataFrame:
    """All combinations of two value sets."""
    sales = land.spark.table(sales_table(land))
    return joins.cross_join(sales.select("category").distinct(), sales.select("region").distinct())
