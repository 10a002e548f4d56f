"""Nested files, API pages, databases, ledgered loads and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.audit import add_audit
from strataflow.functions.columns import money_sum
from strataflow.operators import aggregates, shaping
from strataflow.plans import flows, loads
from strataflow.plans.ledger import LedgerTable
from strataflow.queries.landing import LOTS, SURPLUS, Landing, write_csv, write_surplus
from strataflow.queries.registry import query
from strataflow.session import scratch_path
from strataflow.sources import files, jdbc, paged, records
from strataflow.streaming.autoload import AutoLoad, UnknownFieldError

# Nested orders

ORDER_HEAD = """SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date,
    o.o_orderstatus AS channel, c.c_custkey AS customer_id, c.c_name AS customer_name,
    n.n_name AS customer_nation, r.r_name AS customer_region{extra}
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""
HEAD_PATHS = {
    "order_id": "order_id", "order_date": "order_date", "channel": "channel",
    "customer_id": "customer.customer_id", "customer_name": "customer.name",
    "customer_nation": "customer.address.nation", "customer_region": "customer.address.region",
}


SUPPLIED = (
    "WITH lines AS (SELECT l_orderkey, l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_suppkey), head AS ("
    + ORDER_HEAD.format(extra="")
    + ") "
)


@query(
    "json_nested_scan",
    SUPPLIED + "SELECT order_id, l_suppkey AS supplier_id, customer_name, customer_nation, COALESCE(n, 0) AS n_items "
    "FROM head LEFT JOIN lines ON order_id = l_orderkey",
)
def json_nested_scan(land: Landing) -> DataFrame:
    items = F.coalesce(F.size("items"), F.lit(0))
    return land.json_orders().select(
        "order_id", "supplier_id", F.col("customer.name").alias("customer_name"),
        F.col("customer.address.nation").alias("customer_nation"),
        F.when(items < 0, 0).otherwise(items).cast("bigint").alias("n_items"),
    )


@query(
    "flatten_struct",
    SUPPLIED + "SELECT head.*, l_suppkey AS supplier_id FROM head LEFT JOIN lines ON order_id = l_orderkey",
)
def flatten_struct(land: Landing) -> DataFrame:
    return shaping.flatten(land.json_orders(), HEAD_PATHS | {"supplier_id": "supplier_id"})


@query(
    "explode_items",
    "SELECT order_id, product, category, quantity, unit_price FROM order_lines",
    ("order_lines",),
)
def explode_items(land: Landing) -> DataFrame:
    fields = {c: c for c in ("product", "category", "quantity", "unit_price")}
    return shaping.explode_items(land.json_orders().select("order_id", "items"), "items", fields)


@query(
    "flatten_orders",
    "SELECT *, quantity * unit_price AS item_amount, 'web' AS source_system, 'json_1' AS batch_id, "
    "true AS has_time, true AS has_file FROM order_lines",
    ("order_lines",),
)
def flatten_orders(land: Landing) -> DataFrame:
    flat = land.spark.table(load_flat(land))
    return flat.withColumns(
        {"has_time": F.col("ingestion_timestamp").isNotNull(), "has_file": F.col("source_file").isNotNull()}
    ).drop("ingestion_timestamp", "source_file")


def load_flat(land: Landing) -> str:
    """Nested files to an audited line table; the file name is captured at the scan."""
    name = land.new_table("order_items")
    landed = land.json_orders().withColumn("source_file", F.col("_metadata.file_name")).drop("supplier_id")
    loads.full_load(add_audit(flows.flatten_orders(landed), "web", "json_1"), name)
    return name


@query(
    "nested_topk",
    "SELECT customer_nation, category, COUNT(*) AS n_items, "
    "ROUND(CAST(SUM(CAST(quantity * unit_price AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_amount "
    "FROM order_lines GROUP BY customer_nation, category "
    "ORDER BY total_amount DESC, customer_nation, category LIMIT 10",
    ("order_lines",),
)
def nested_topk(land: Landing) -> DataFrame:
    totals = land.spark.table(land.once("table:order_items", lambda: load_flat(land))).groupBy("customer_nation", "category").agg(
        F.count(F.lit(1)).alias("n_items"), F.round(money_sum("item_amount"), 2).alias("total_amount")
    )
    return shaping.top_k(totals, 10, F.col("total_amount").desc(), F.col("customer_nation"), F.col("category"))


@query(
    "averages",
    "SELECT category, AVG(quantity) AS avg_quantity, MIN(quantity) AS min_quantity, MAX(quantity) AS max_quantity "
    "FROM order_lines GROUP BY category",
    ("order_lines",),
)
def averages(land: Landing) -> DataFrame:
    items = land.spark.table(land.once("table:order_items", lambda: load_flat(land)))
    return items.groupBy("category").agg(
        F.avg("quantity").alias("avg_quantity"), F.min("quantity").alias("min_quantity"),
        F.max("quantity").alias("max_quantity"),
    )


# API payloads

API = ("api_products",)


@query("paged_source", "SELECT * FROM api_products", API)
def paged_source(land: Landing) -> DataFrame:
    return paged.read_pages(land.spark, paged.FileTransport(land.api_pages()), schemas.contract(schemas.PRODUCTS_API))


@query("raw_payload_landing", "SELECT * FROM api_products", API)
def raw_payload_landing(land: Landing) -> DataFrame:
    landed = land.spark.read.text(land.api_pages()).select(F.col("value").alias("payload"))
    return records.parse_payload(landed, schemas.contract(schemas.PRODUCTS_API))


@query(
    "api_timestamps",
    "SELECT id, CAST(replace(replace(updated_at, 'T', ' '), 'Z', '') AS TIMESTAMP) AS updated_at FROM api_products",
    API,
)
def api_timestamps(land: Landing) -> DataFrame:
    landed = files.read_json(land.spark, land.api_pages(), schemas.PRODUCTS_API)
    return landed.withColumn("updated_at", F.to_timestamp("updated_at")).select("id", _in_utc("updated_at").alias("updated_at"))


@query(
    "api_increment",
    """, snapshot AS (SELECT id, CAST(replace(replace(updated_at, 'T', ' '), 'Z', '') AS TIMESTAMP) AS updated_at
    FROM api_products), poll AS (SELECT id, CAST(replace(replace(updated_at, 'T', ' '), 'Z', '') AS TIMESTAMP)
    AS updated_at FROM api_products_later)
    SELECT 'poll_1' AS batch_id, COUNT(*) AS n_rows, MIN(updated_at) AS min_updated_at, MAX(updated_at) AS max_updated_at
    FROM snapshot UNION ALL SELECT 'poll_2', COUNT(*), MIN(updated_at), MAX(updated_at) FROM poll
    WHERE updated_at > (SELECT MAX(updated_at) FROM snapshot)""",
    ("api_products", "api_products_later"),
)
def api_increment(land: Landing) -> DataFrame:
    """Snapshot of the API, then what a later poll brought above the watermark."""
    name = land.new_table("products")
    loads.full_load(add_audit(_polled(land, "api_products"), "api", "poll_1"), name, partition_by=["batch_id"])
    newer = loads.newer_than(_polled(land, "api_products_later"), land.spark.table(name), "updated_at")
    loads.append_load(add_audit(newer, "api", "poll_2"), name, partition_by=["batch_id"])
    found = aggregates.compare_batches(land.spark.table(name), ["batch_id"], "updated_at")
    return found.withColumns({c: _in_utc(c) for c in ("min_updated_at", "max_updated_at")})


def _polled(land: Landing, name: str) -> DataFrame:
    pages = paged.FileTransport(land.api_pages(name))
    found = paged.read_pages(land.spark, pages, schemas.contract(schemas.PRODUCTS_API), name=name)
    return found.withColumn("updated_at", F.to_timestamp("updated_at"))


def _in_utc(column: str):
    """The moment as UTC wall-clock time, whatever the session's zone."""
    return F.convert_timezone(None, F.lit("UTC"), F.col(column).cast("timestamp_ntz"))


@query("records_to_df", "SELECT brand, COUNT(*) AS products FROM api_products GROUP BY brand", API)
def records_to_df(land: Landing) -> DataFrame:
    """Records of all landed replies, projected to a schema where they lie."""
    landed = land.spark.read.text(land.api_pages()).withColumnRenamed("value", "payload")
    found = records.parse_payload(landed, schemas.contract("id BIGINT, brand STRING"))
    return aggregates.counts_by(found, ["brand"], "products")


# Transactional database
#
# An embedded in-memory database lives in one process, so these queries run on a
# local session as they are; on a cluster name a reachable database in
# spark.strataflow.jdbc.url and spark.strataflow.jdbc.driver.

BUSINESS = ("customer_id", "name", "segment", "balance", "modified_on")
SECRET = ("password_hash", "password_salt")
COLUMN_TYPES = "name VARCHAR(64), segment VARCHAR(32), password_hash VARCHAR(80), password_salt VARCHAR(80)"


def jdbc_options(land: Landing) -> dict[str, str]:
    conf = land.spark.conf
    url = conf.get("spark.strataflow.jdbc.url", None)
    driver = conf.get("spark.strataflow.jdbc.driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    if url is None:
        # The embedded database is seen by one process only; local-cluster has several.
        if land.spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.strataflow.jdbc.url to a database the executors can reach")
        url = "jdbc:derby:memory:strataflow;create=true"
    return {"url": url, "driver": driver}


def source_table(land: Landing, name: str) -> str:
    def fill() -> str:
        table = f"{name}_{uuid.uuid4().hex[:8]}".upper()
        (
            land.rows(name).write.format("jdbc").options(**jdbc_options(land))
            .option("dbtable", table).option("createTableColumnTypes", COLUMN_TYPES)
            .option("batchsize", "5000").mode("overwrite").save()
        )
        return table

    return land.once(f"jdbc:{name}", fill)


def federated(land: Landing, name: str) -> str:
    jdbc.register_catalog(land.spark, "crm_source", jdbc_options(land))
    schema = land.spark.conf.get("spark.strataflow.jdbc.schema", "APP")
    return f"crm_source.`{schema}`.{source_table(land, name)}"


@query("jdbc_subquery_scan", f"SELECT {', '.join(BUSINESS)} FROM source_day1", ("source_day1",))
def jdbc_subquery_scan(land: Landing) -> DataFrame:
    return jdbc.read_query(
        land.spark, jdbc_options(land), source_table(land, "source_day1"), BUSINESS,
        split_on="customer_id", quote='"',
    )


@query(
    "federated_catalog_scan",
    "SELECT customer_id, name, balance FROM source_day1 WHERE balance > 5000 AND segment = 'BUILDING'",
    ("source_day1",),
)
def federated_catalog_scan(land: Landing) -> DataFrame:
    rows = jdbc.read_federated(land.spark, federated(land, "source_day1"), BUSINESS, split_on="customer_id")
    return rows.filter((F.col("balance") > 5000) & (F.col("segment") == "BUILDING")).select(
        "customer_id", "name", "balance"
    )


@query("column_allowlist", f"SELECT {', '.join(BUSINESS)} FROM source_day1", ("source_day1",))
def column_allowlist(land: Landing) -> DataFrame:
    source = jdbc.read_federated(
        land.spark, federated(land, "source_day1"), [*BUSINESS, *SECRET], split_on="customer_id"
    )
    return shaping.allow_columns(source, BUSINESS, denied=SECRET)


def extracted_table(land: Landing) -> str:
    """Snapshot of day one, then what day two brought above the watermark."""

    return land.once("table:crm_extract", lambda: load_extract(land))


def load_extract(land: Landing) -> str:
    name = land.new_table("crm_extract")
    first = jdbc.read_federated(land.spark, federated(land, "source_day1"), BUSINESS, split_on="customer_id")
    loads.full_load(add_audit(first, "crm", "snapshot"), name)
    second = jdbc.read_federated(land.spark, federated(land, "source_day2"), BUSINESS, split_on="customer_id")
    newer = loads.newer_than(second, land.spark.table(name), "modified_on")
    loads.append_load(add_audit(newer, "crm", "increment"), name)
    return name


DAYS = ("source_day1", "source_day2")
EXTRACT = (
    f", increment AS (SELECT {', '.join(BUSINESS)} FROM source_day2 "
    "WHERE modified_on > (SELECT MAX(modified_on) FROM source_day1)), "
    f"extract AS (SELECT {', '.join(BUSINESS)}, 'snapshot' AS batch_id FROM source_day1 "
    "UNION ALL SELECT *, 'increment' FROM increment)"
)


@query("watermark_extract", f"{EXTRACT} SELECT * FROM extract", DAYS)
def watermark_extract(land: Landing) -> DataFrame:
    return land.spark.table(load_extract(land)).drop("ingestion_timestamp", "source_system")


@query("watermark_kept", f"{EXTRACT} SELECT * FROM extract", DAYS)
def watermark_kept(land: Landing) -> DataFrame:
    """The same extract into a ledgered table, which keeps the watermark with its commits."""
    name = land.new_table("crm_kept")
    first = jdbc.read_federated(land.spark, federated(land, "source_day1"), BUSINESS, split_on="customer_id")
    snapshot = add_audit(first, "crm", "snapshot")
    table = LedgerTable(land.spark, name).create(snapshot.schema, watermark="modified_on")
    table.write(snapshot)
    second = jdbc.read_federated(land.spark, federated(land, "source_day2"), BUSINESS, split_on="customer_id")
    table.write(add_audit(table.newer(second), "crm", "increment"))
    return table.read().drop("ingestion_timestamp", "source_system")


@query(
    "version_check",
    f"{EXTRACT} SELECT customer_id, COUNT(*) AS versions FROM extract GROUP BY customer_id HAVING COUNT(*) > 1",
    DAYS,
)
def version_check(land: Landing) -> DataFrame:
    return aggregates.several_versions(land.spark.table(extracted_table(land)), ["customer_id"])


@query(
    "group_count_ranked",
    f"{EXTRACT} SELECT segment, batch_id, COUNT(*) AS customers FROM extract GROUP BY segment, batch_id",
    DAYS,
)
def group_count_ranked(land: Landing) -> DataFrame:
    return aggregates.ranked_counts(
        land.spark.table(extracted_table(land)), ["segment", "batch_id"], "customers"
    )


# Ledgered file loads

ORDER_SELECT = (
    "CAST(order_id AS BIGINT) AS order_id", "CAST(order_date AS DATE) AS order_date",
    "CAST(customer_id AS BIGINT) AS customer_id", "status", "priority",
    "CAST(amount AS DOUBLE) AS amount", "current_timestamp() AS ingestion_timestamp",
    "_source_file AS source_file",
)
ORDER_TABLE = (
    "order_id BIGINT, order_date DATE, customer_id BIGINT, status STRING, priority STRING, "
    "amount DOUBLE, ingestion_timestamp TIMESTAMP, source_file STRING"
)
LOADED = ("orders_full", "orders_later")
ROWS = "order_id, order_date, customer_id, status, priority, amount"


class OrderLoad:
    """A fresh target and the landing folders that have received files so far."""

    def __init__(self, land: Landing):
        self.land = land
        self.folders: list[str] = []
        self.table = LedgerTable(land.spark, land.new_table("orders")).create(ORDER_TABLE)
        self.affected: list[int] = []

    def arrive(self, name: str) -> OrderLoad:
        self.folders.append(self.land.csv(name))
        return self

    def copy(self, **options) -> OrderLoad:
        self.affected.append(self.table.copy_into(self.folders, ORDER_SELECT, **options).num_affected_rows)
        return self

    def rows(self) -> DataFrame:
        return self.table.read().select(*ROWS.split(", "))

    def summary(self) -> DataFrame:
        """Rows per status, next to the rows the last load said it added."""
        return aggregates.counts_by(self.table.read(), ["status"]).withColumn(
            "last_affected", F.lit(self.affected[-1]).cast("bigint")
        )


BOTH = f"SELECT {ROWS} FROM orders_full UNION ALL SELECT {ROWS} FROM orders_later"


@query("copy_into_first", BOTH, LOADED)
def copy_into_first(land: Landing) -> DataFrame:
    return OrderLoad(land).arrive("orders_full").arrive("orders_later").copy().rows()


@query("copy_into_rerun", f"SELECT status, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS last_affected "
       f"FROM ({BOTH}) GROUP BY status", LOADED)
def copy_into_rerun(land: Landing) -> DataFrame:
    return OrderLoad(land).arrive("orders_full").arrive("orders_later").copy().copy().summary()


@query("copy_into_incremental", f"SELECT {ROWS} FROM orders_full UNION ALL SELECT {ROWS} FROM orders_later", LOADED)
def copy_into_incremental(land: Landing) -> DataFrame:
    return OrderLoad(land).arrive("orders_full").copy().arrive("orders_later").copy().rows()


@query(
    "copy_into_force",
    ", both_lots AS (SELECT * FROM orders_full UNION ALL SELECT * FROM orders_later) "
    "SELECT status, 2 * COUNT(*) AS n_rows, (SELECT COUNT(*) FROM both_lots) AS last_affected "
    "FROM both_lots GROUP BY status",
    LOADED,
)
def copy_into_force(land: Landing) -> DataFrame:
    return OrderLoad(land).arrive("orders_full").arrive("orders_later").copy().copy(force=True).summary()


@query("copy_into_recreate", f"SELECT {ROWS} FROM orders_full UNION ALL SELECT {ROWS} FROM orders_later", LOADED)
def copy_into_recreate(land: Landing) -> DataFrame:
    load = OrderLoad(land).arrive("orders_full").arrive("orders_later").copy().copy(force=True)
    load.table.drop()
    load.table.create(ORDER_TABLE)
    return load.copy().rows()


@query(
    "load_history",
    "SELECT CAST(1 AS BIGINT) AS version, COUNT(*) AS rows_inserted, true AS counts_its_files FROM orders_full "
    "UNION ALL SELECT CAST(2 AS BIGINT), COUNT(*), true FROM orders_later",
    LOADED,
)
def load_history(land: Landing) -> DataFrame:
    load = OrderLoad(land).arrive("orders_full").copy().arrive("orders_later").copy()
    stored = land.spark.table(load.table.data).groupBy("load_id").agg(
        F.countDistinct("_metadata.file_path").alias("files_stored")
    )
    return load.table.load_history().join(stored, "load_id").select(
        "version", "rows_inserted", (F.col("files_written") == F.col("files_stored")).alias("counts_its_files")
    )


# Streams over event files

class EventStream:
    """A fresh stream over a folder to which lots of events are added."""

    def __init__(self, land: Landing):
        self.land = land
        root = scratch_path(land.spark, "events")
        self.folder = f"{root}/landing"
        self.load = AutoLoad(
            land.spark, self.folder, land.new_table("events"), f"{root}/checkpoint", f"{root}/schema",
            hints=schemas.EVENT_HINTS, source_system="app", merge_schema=True, glob="part-*",
        )

    def arrive(self, *lots: str) -> EventStream:
        for lot in lots:
            rows = self.land.rows(lot)
            if lot == LOTS[-1]:
                write_surplus(rows.filter(SURPLUS), f"{self.folder}/{lot}_surplus")
                rows = rows.filter(f"NOT ({SURPLUS})")
            write_csv(rows, f"{self.folder}/{lot}")
        return self

    def drain(self) -> EventStream:
        """Run to the end, restarting when a new column stops the stream."""
        try:
            self.load.drain()
        except UnknownFieldError:
            self.load.drain()
        return self

    def rows(self) -> DataFrame:
        return self.load.read().drop("ingestion_timestamp", "source_system")


def all_lots(land: Landing) -> EventStream:
    return land.once(
        "stream:all",
        lambda: EventStream(land).arrive("events_1", "events_2").drain().arrive("events_3").drain()
        .arrive("events_4").drain(),
    )


CLICKS = (
    ", clicks AS ("
    + " UNION ALL ".join(
        f"SELECT event_id, TRY_CAST(user_id AS BIGINT) AS user_id, event_type, product_id, "
        f"{'device' if lot in LOTS[2:] else 'CAST(NULL AS VARCHAR) AS device'}, "
        f"CASE WHEN user_id = 'guest' THEN user_id END AS rescued_user FROM {lot}"
        for lot in LOTS
    )
    + ")"
)


CLICK_ROWS = f"{CLICKS} SELECT event_id, user_id, event_type, product_id, device FROM clicks"


@query("autoload_stream", CLICK_ROWS, LOTS)
def autoload_stream(land: Landing) -> DataFrame:
    return EventStream(land).arrive(*LOTS).drain().rows().drop("_rescued_data")


@query("autoload_rerun", CLICK_ROWS, LOTS)
def autoload_rerun(land: Landing) -> DataFrame:
    return EventStream(land).arrive(*LOTS).drain().drain().rows().drop("_rescued_data")


@query("autoload_evolve", CLICK_ROWS, LOTS)
def autoload_evolve(land: Landing) -> DataFrame:
    return all_lots(land).rows().drop("_rescued_data")


@query(
    "autoload_rescue",
    f"{CLICKS}, surplus AS (SELECT event_id, concat_ws(',', event_id, device, user_id, event_type, product_id, 'extra') AS line "
    f"FROM {LOTS[-1]} WHERE {SURPLUS}) "
    "SELECT event_id, user_id, rescued_user, line, true AS names_file FROM clicks LEFT JOIN surplus USING (event_id) "
    "WHERE rescued_user IS NOT NULL OR line IS NOT NULL",
    LOTS,
)
def autoload_rescue(land: Landing) -> DataFrame:
    rescued = F.from_json("_rescued_data", "user_id STRING, _line STRING, _file_path STRING")
    return (
        all_lots(land).rows().filter("_rescued_data IS NOT NULL")
        .select("event_id", "user_id", rescued.alias("r"))
        .select("event_id", "user_id", F.col("r.user_id").alias("rescued_user"),
                F.col("r._line").alias("line"), F.col("r._file_path").contains("/part-").alias("names_file"))
    )


@query("autoload_periodic", CLICK_ROWS, LOTS)
def autoload_periodic(land: Landing) -> DataFrame:
    """Two lots, of one header each, are there; the others arrive while the stream runs."""
    stream = EventStream(land).arrive(LOTS[0], LOTS[2])
    running = stream.load.start(processingTime="1 second")
    try:
        running.processAllAvailable()
        stream.arrive(LOTS[1], LOTS[3])
        running.processAllAvailable()
    finally:
        running.stop()
    return stream.rows().drop("_rescued_data")


@query("autoload_reset", CLICK_ROWS, LOTS)
def autoload_reset(land: Landing) -> DataFrame:
    stream = EventStream(land).arrive(*LOTS).drain()
    stream.load.reset()
    return stream.drain().rows().drop("_rescued_data")


@query("stream_progress", f"{CLICKS} SELECT COUNT(*) AS rows_loaded, true AS all_files_taken FROM clicks", LOTS)
def stream_progress(land: Landing) -> DataFrame:
    stream = all_lots(land)
    present = files.inventory(land.spark, stream.folder, "part-*").count()
    return stream.load.batches().agg(
        F.sum("rows").alias("rows_loaded"), (F.sum("files") == present).alias("all_files_taken")
    )


@query(
    "event_counts",
    f"{CLICKS} SELECT event_type, device, COUNT(*) AS events FROM clicks GROUP BY event_type, device",
    LOTS,
)
def event_counts(land: Landing) -> DataFrame:
    return aggregates.counts_by(all_lots(land).rows(), ["event_type", "device"], "events").orderBy(
        F.col("event_type").asc_nulls_last(), F.col("device").asc_nulls_last()
    )
