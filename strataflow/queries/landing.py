"""Raw inputs derived from the test tables, and landed as files or tables.

Each input is SQL text that Spark and the checking engine both understand; the
queries read what was landed, the oracle SQL starts from the same text.
"""

from __future__ import annotations

import uuid
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.session import scratch_path
from strataflow.sources import files, records

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

INPUTS: dict[str, str] = {}

INPUTS["sales"] = """
SELECT o.o_orderkey AS sale_id, CAST(o.o_orderdate AS DATE) AS sale_date, o.o_custkey AS customer_id,
       r.r_name AS region, n.n_name AS nation, o.o_orderpriority AS category,
       o.o_orderstatus AS status, o.o_totalprice AS amount
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# Two extracts of the order system: everything up to a day, then what came later.
INPUTS["orders_full"] = """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
       o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS amount
FROM {orders} WHERE o_orderdate < DATE '2000-01-01'
"""
INPUTS["orders_later"] = """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
       o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS amount
FROM {orders} WHERE o_orderdate >= DATE '2000-01-01'
"""

# Flat form of the nested orders; ``nested_orders`` below folds it into documents.
INPUTS["order_lines"] = """
SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS channel,
       c.c_custkey AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS customer_segment,
       n.n_name AS customer_nation, r.r_name AS customer_region,
       p.p_name AS product, p.p_type AS category, CAST(l.l_quantity AS INT) AS quantity,
       p.p_retailprice AS unit_price
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey
"""

_CRM_ROW = """
SELECT CASE WHEN c_acctbal < -900 THEN NULL ELSE CAST(c_custkey AS STRING) END AS customer_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN concat('  ', upper(c_name), ' ') ELSE lower(c_name) END AS first_name,
       concat(upper(c_mktsegment), ' of nation ', CAST(c_nationkey AS STRING)) AS last_name,
       CASE WHEN c_acctbal BETWEEN -900 AND -800 THEN NULL
            WHEN c_mktsegment = 'BUILDING' THEN concat(' ', upper(c_name), '@MAIL.EXAMPLE ')
            ELSE concat(c_name, '@mail.example') END AS email,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE concat('+', CAST(c_nationkey AS STRING), '-{line}') END AS phone,
       CASE WHEN c_nationkey = 7 THEN NULL ELSE concat(' Company ', CAST(c_nationkey AS STRING), ' ') END AS company,
       c_mktsegment AS segment,
       concat('Advisor ', CAST(c_nationkey AS STRING)) AS advisor,
       CAST(DATE '2024-01-01' + c_nationkey{later} AS STRING) AS updated_on
FROM {{customer}}"""

# Text rows of a customer system; rich customers arrive again with a later date,
# some others again with the same one.
INPUTS["crm_dirty"] = (
    _CRM_ROW.format(line="100", later="")
    + " UNION ALL "
    + _CRM_ROW.format(line="200", later=" + 60") + " WHERE c_acctbal >= 9000"
    + " UNION ALL "
    + _CRM_ROW.format(line="300", later="") + " WHERE c_acctbal >= 8000 AND c_acctbal < 9000"
)

# Bridge between customers and addresses: most have a main one, households have a
# delivery address as well, and poor non-households have none.
INPUTS["addresses"] = """
SELECT c_custkey AS customer_id, c_nationkey AS address_id, 'Principal' AS address_type
FROM {customer} WHERE c_acctbal >= -500
UNION ALL
SELECT c_custkey AS customer_id, 24 - c_nationkey AS address_id, 'Envio' AS address_type
FROM {customer} WHERE c_mktsegment = 'HOUSEHOLD'
UNION ALL
SELECT -1 - s_suppkey AS customer_id, s_nationkey AS address_id, 'Principal' AS address_type
FROM {supplier}
"""

INPUTS["address_reference"] = """
SELECT n.n_nationkey AS address_id, n.n_name AS city, r.r_name AS region
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
WHERE n.n_name <> 'NATION_9'
"""

_EVENT = """
SELECT event_id, {device}{user} AS user_id, event_type,
       CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS product_id
FROM {{events}} WHERE {when}
"""
_DEVICE = "CASE WHEN value < 5 THEN 'mobile' ELSE 'desktop' END AS device, "
_GUEST = "CASE WHEN event_type = 'error' AND value > 20 THEN 'guest' ELSE CAST(user_id AS STRING) END"

# Four lots of click events. The third adds a column in the middle of the header,
# the fourth has user ids that are not numbers.
INPUTS["events_1"] = _EVENT.format(device="", user="CAST(user_id AS STRING)", when="ts < TIMESTAMP '2024-01-08 00:00:00'")
INPUTS["events_2"] = _EVENT.format(
    device="", user="CAST(user_id AS STRING)",
    when="ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'",
)
INPUTS["events_3"] = _EVENT.format(
    device=_DEVICE, user="CAST(user_id AS STRING)",
    when="ts >= TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-24 00:00:00'",
)
INPUTS["events_4"] = _EVENT.format(device=_DEVICE, user=_GUEST, when="ts >= TIMESTAMP '2024-01-24 00:00:00'")
LOTS = ("events_1", "events_2", "events_3", "events_4")

# Rows of the fourth lot that arrive with a field more than the header names.
SURPLUS = "event_id % 97 = 0"

# A transactional customer table on two days, with columns that must not land.
_SOURCE = """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment,
       CAST(c_acctbal AS DOUBLE) AS balance,
       CAST({modified} AS DATE) AS modified_on,
       concat('hash-', c_name) AS password_hash, concat('salt-', c_name) AS password_salt
FROM {{customer}}
"""
INPUTS["source_day1"] = _SOURCE.format(modified="DATE '2024-01-01' + c_nationkey")
INPUTS["source_day2"] = _SOURCE.format(
    modified="CASE WHEN c_acctbal >= 9000 THEN DATE '2024-03-01' ELSE DATE '2024-01-01' + c_nationkey END"
)

_PRODUCT = """
SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size,
       p_retailprice AS price,
       CASE WHEN p_size < 10 THEN NULL ELSE concat('size ', CAST(p_size AS STRING)) END AS note,
       {updated} AS updated_at
FROM {{part}}
"""
_DAY = """concat('2024-01-', CASE WHEN p_size < 10 THEN '0' ELSE '' END,
              CAST(CASE WHEN p_size > 28 THEN 28 ELSE p_size END AS STRING), 'T06:30:00Z')"""

# Replies of a product API, and those of a later poll, when large products had changed.
INPUTS["api_products"] = _PRODUCT.format(updated=_DAY)
INPUTS["api_products_later"] = _PRODUCT.format(
    updated=f"CASE WHEN p_size >= 40 THEN '2024-02-10T18:00:00Z' ELSE {_DAY} END"
)
PAGE_SIZE = 500
# A compressed file is read by one task, so its documents are bounded.
DOCUMENTS_PER_FILE = 1_000_000
SURPLUS_PER_FILE = 20_000

def oracle_ctes(*names: str) -> str:
    """``WITH`` clause that defines inputs over the plain table names."""
    plain = {t: t for t in TABLES}
    return "WITH " + ", ".join(f"{n} AS ({INPUTS[n].format(**plain)})" for n in names)


_MEMO: dict[tuple[str, str, str], object] = {}
_LOCK = RLock()


class Landing:
    """Inputs of one data folder, written once per session to the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, name: str) -> DataFrame:
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in INPUTS[name]}
        return self.spark.sql(INPUTS[name], **used)

    def once(self, key: str, make):
        memo = (self.spark.sparkContext.applicationId, self.sf_dir, key)
        with _LOCK:
            if memo not in _MEMO:
                _MEMO[memo] = make()
            return _MEMO[memo]

    def csv(self, name: str) -> str:
        """Folder with the input as CSV files with headers."""

        def land() -> str:
            path = scratch_path(self.spark, name)
            write_csv(self.rows(name), path)
            return path

        return self.once(f"csv:{name}", land)

    def nested_orders(self) -> str:
        """Folder with nested JSON documents, one per order and supplier, compressed: each
        repeats its order's head and the names of the fields."""

        def land() -> str:
            path = scratch_path(self.spark, "nested_orders")
            documents = fold_orders(self).write.option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
            documents.option("ignoreNullFields", True).json(path, compression="gzip")
            return path

        return self.once("nested_orders", land)

    def api_pages(self, name: str = "api_products") -> str:
        """Folder with API replies, ``page=<n>`` holding one JSON record a line."""

        def land() -> str:
            path = scratch_path(self.spark, name)
            page = F.floor(F.col("id") / PAGE_SIZE).cast("bigint")
            payload = self.rows(name).select(
                F.to_json(F.struct("*")).alias("payload"), page.alias("page")
            )
            records.land_payload(payload.repartition("page"), path, by="page")
            return path

        return self.once(f"pages:{name}", land)

    def database(self) -> str:
        """A database of this session's own, stored in the shared folder."""

        def create() -> str:
            name = f"strataflow_{uuid.uuid4().hex[:12]}"
            self.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(self.spark, name)}'")
            return name

        return self.once("database", create)

    def new_table(self, prefix: str) -> str:
        return f"{self.database()}.{prefix}_{uuid.uuid4().hex[:12]}"

    # Frames read back from what was landed

    def sales(self) -> DataFrame:
        return files.read_csv(self.spark, self.csv("sales"), schemas.SALES)

    def orders(self, name: str) -> DataFrame:
        return files.read_csv(self.spark, self.csv(name), schemas.ORDERS)

    def bronze_customers(self) -> DataFrame:
        return files.read_csv(self.spark, self.csv("crm_dirty"), schemas.CRM_BRONZE)

    def addresses(self) -> DataFrame:
        return files.read_csv(
            self.spark, self.csv("addresses"), "customer_id BIGINT, address_id INT, address_type STRING"
        )

    def address_reference(self) -> DataFrame:
        return files.read_csv_inferred(self.spark, self.csv("address_reference"))

    def json_orders(self) -> DataFrame:
        return files.read_json(self.spark, self.nested_orders(), schemas.NESTED_ORDERS)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header that keeps padding in text."""
    df.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_surplus(df: DataFrame, path: str) -> None:
    """CSV files whose rows have one field more than their header; a file holds about
    ``SURPLUS_PER_FILE`` rows, so there are few files however the event ids lie."""
    line = F.concat_ws(",", *(F.col(c).cast("string") for c in df.columns), F.lit("extra"))
    shares = -(-df.count() // SURPLUS_PER_FILE)
    share = F.pmod(F.xxhash64("line"), F.lit(max(shares, 1)))
    spans = df.select(line.alias("line")).groupBy(share.alias("span")).agg(
        F.array_join(F.collect_list("line"), "\n").alias("lines")
    )
    header = F.lit(",".join(df.columns) + "\n")
    spans.select(F.concat(header, "lines").alias("value"), "span").write.partitionBy("span").text(path)


def fold_orders(landing: Landing) -> DataFrame:
    """One document per order and supplier, with the items it ships nested; an
    order without lines has one document without items.

    An order of any size is thereby many documents, each with the few items that
    one supplier has in one order.
    """
    lines = landing.table("lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", F.col("l_quantity").cast("int").alias("quantity")
    )
    parts = landing.table("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    items = (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .drop("l_partkey", "p_partkey")
        # Lists collected before the shuffle would hardly shrink the rows, but sort all that a scan task reads.
        .repartition("l_orderkey", "l_suppkey")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(
            F.collect_list(
                F.struct(
                    F.col("p_name").alias("product"), F.col("p_type").alias("category"),
                    "quantity", F.col("p_retailprice").alias("unit_price"),
                )
            ).alias("items")
        )
    )
    orders = landing.table("orders")
    nations = landing.table("nation").join(
        landing.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    buyers = landing.table("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.struct(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.struct(F.col("n_name").alias("nation"), F.col("r_name").alias("region")).alias("address"),
        ).alias("customer"),
    )
    return (
        orders.join(buyers, orders.o_custkey == buyers.c_custkey)
        .join(items, orders.o_orderkey == items.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("channel"), F.col("l_suppkey").alias("supplier_id"), "customer", "items",
        )
    )
