from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.audit import add_audit, batch_label
from strataflow.operators import shaping
from strataflow.queries import landing
from strataflow.queries.ingestion import jdbc_options
from strataflow.queries.registry import QUERIES
from strataflow.session import shuffle_partitions
from strataflow.sources import files, jdbc, paged, records
from tests.conftest import rows


def test_bad_csv_value_becomes_null(spark, put):
    path = put("s.csv", "id,day,amount\n1,2026-06-30,2.5\nx,2026-06-31,3\n")
    found = files.read_csv(spark, path, "id INT NOT NULL, day DATE, amount DOUBLE")
    assert rows(found) == [(None, None, 3.0), (1, __import__("datetime").date(2026, 6, 30), 2.5)]


def test_inferred_types(spark, put):
    path = put("s.csv", "id,city,share\n1,Lima,2.5\n")
    assert files.read_csv_inferred(spark, path).dtypes == [("id", "int"), ("city", "string"), ("share", "double")]


def test_columns_bind_by_name_over_different_headers(spark, put, tmp_path):
    first = put("a.csv", 'id,kind\n1,click\n')
    second = put("b.csv", '"kind","device, os",id\nview,"ios, 9",2\n')
    empty = put("c.csv", "")
    groups = files.header_groups(spark, {f"file:{p}": 9 for p in (first, second, empty)})
    assert set(groups) == {("id", "kind"), ("kind", "device, os", "id")}
    found = files.read_csv_groups(spark, groups)
    assert rows(found, "id", "kind", "`device, os`", files.SOURCE_FILE) == [
        ("1", "click", None, "a.csv"), ("2", "view", "ios, 9", "b.csv"),
    ]


def test_a_header_other_than_expected_fails(spark, put):
    path = "file:" + put("a.csv", "id,kind\n1,click\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_csv_groups(spark, {("kind", "id"): [path]}).collect()


def test_inventory_reads_no_content(spark, put, tmp_path):
    put("land/a.csv", "x\n1\n")
    put("land/deep/b.csv", "x\n12\n")
    put("land/c.txt", "no")
    found = files.inventory(spark, str(tmp_path / "land"), "*.csv")
    assert [os.path.basename(r.path) for r in found.orderBy("path").collect()] == ["a.csv", "b.csv"]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_listing_session_keeps_settings_and_packs_files(spark, put, tmp_path):
    spark.conf.set("fs.example.key", "secret")
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        session = files.listing_session(spark)
        assert session.conf.get("fs.example.key") == "secret"
        assert session.conf.get("spark.sql.session.timeZone") == "America/Lima"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.unset("fs.example.key")


def test_nested_json_flattens_and_explodes(spark, put):
    # E7: the grain moves from order to item; no items, no rows
    orders = [
        {"order_id": 1, "customer": {"name": "Ana", "address": {"nation": "Peru"}},
         "items": [{"product": "a", "quantity": 2, "unit_price": 1.5}, {"product": "b", "quantity": 1}]},
        {"order_id": 2, "customer": None, "items": []},
        {"order_id": 3},
    ]
    path = put("o.json", "\n".join(json.dumps(o) for o in orders))
    found = files.read_json(spark, path, schemas.NESTED_ORDERS)
    flat = shaping.flatten(found, {"id": "order_id", "nation": "customer.address.nation"})
    assert rows(flat) == [(1, "Peru"), (2, None), (3, None)]
    fields = {"product": "product", "quantity": "quantity"}
    narrow = found.select("order_id", "items")
    assert rows(shaping.explode_items(narrow, "items", fields)) == [(1, "a", 2), (1, "b", 1)]
    kept = shaping.explode_items(narrow, "items", fields, keep_empty=True)
    assert rows(kept) == [(1, "a", 2), (1, "b", 1), (2, None, None), (3, None, None)]


def test_audit_columns(spark, put):
    path = put("s.csv", "id\n1\n")
    found = add_audit(files.read_csv(spark, path, "id INT"), "erp", "full_1", source_file=True)
    assert found.columns == ["id", "ingestion_timestamp", "source_file", "source_system", "batch_id"]
    assert rows(found.drop("ingestion_timestamp")) == [(1, "s.csv", "erp", "full_1")]
    assert add_audit(found.select("id")).columns == ["id", "ingestion_timestamp"]


def test_batch_label():
    from datetime import datetime

    assert batch_label("load", datetime(2026, 6, 30, 9, 5)) == "load_20260630_0905"


def test_records_enforce_not_null_and_fill_absent_keys(spark):
    schema = schemas.contract("id BIGINT NOT NULL, name STRING")
    assert rows(records.from_records(spark, [{"id": 1, "extra": 2}], schema)) == [(1, None)]
    with pytest.raises(PySparkException):
        records.from_records(spark, [{"name": "x"}], schema).collect()


def test_payload_round_trip(spark, tmp_path):
    raw = spark.createDataFrame([('{"id": 1, "x": 9}',), ('{"id": 2, "name": "b"}',)], "payload STRING")
    path = str(tmp_path / "raw")
    records.land_payload(raw, path)
    landed = spark.read.text(path).withColumnRenamed("value", "payload")
    assert rows(records.parse_payload(landed, schemas.contract("id BIGINT, name STRING"))) == [(1, None), (2, "b")]


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(0, 64) == 64
    assert shuffle_partitions(1 << 40, 64) == 4096
    assert shuffle_partitions(100 << 40, 8000) == 409_600


# Paged API

class Script:
    """Answers of an API, in turn."""

    def __init__(self, *statuses):
        self.statuses = list(statuses)
        self.calls = 0

    def __call__(self, page):
        self.calls += 1
        return self.statuses.pop(0), "[]"


@pytest.mark.parametrize("status", [401, 403, 404])
def test_refusal_is_not_retried(status):
    script, waits = Script(status, 200), []
    with pytest.raises(paged.ApiError):
        paged.fetch_page(script, 0, sleep=waits.append)
    assert script.calls == 1 and waits == []


@pytest.mark.parametrize("status", [429, 500, 503])
def test_transient_failure_is_retried_with_backoff(status):
    script, waits = Script(status, status, 200), []
    assert paged.fetch_page(script, 0, sleep=waits.append) == "[]"
    assert waits == [1, 2]


def test_third_failure_gives_up_without_a_further_wait():
    script, waits = Script(500, 500, 500, 200), []
    with pytest.raises(paged.ApiError):
        paged.fetch_page(script, 0, sleep=waits.append)
    assert script.calls == 3 and waits == [1, 2]


def test_http_request_carries_page_size_and_token():
    plain = paged.HttpTransport("http://api.example/items", page_size=20, params={"sort": "updated"})
    assert plain.build(0).full_url == "http://api.example/items?sort=updated&per_page=20&page=1"
    assert not plain.build(0).has_header("Authorization")
    signed = paged.HttpTransport("http://api.example/items", token="t")
    assert signed.build(3).get_header("Authorization") == "Bearer t"


def test_landed_pages_are_found_by_any_form_of_path(put, tmp_path):
    put("api/page=0/part.txt", '{"id": 1}\n{"id": 2}\n')
    put("api/page=0/_SUCCESS", "")
    for root in (f"{tmp_path}/api", f"file:{tmp_path}/api", f"file://{tmp_path}/api"):
        assert json.loads(paged.FileTransport(root)(0)[1]) == [{"id": 1}, {"id": 2}]
        assert paged.FileTransport(root)(1) == (200, "[]")
        assert paged.FileTransport(root).pages() == [0]


@pytest.mark.parametrize("share", [1, 3, 100])
def test_all_pages_are_read_once(spark, put, tmp_path, share):
    wanted = []
    for page in (0, 1, 2, 3, 7, 12):  # page 2 is empty, others are missing
        ids = [page * 10 + i for i in range(0 if page == 2 else 3 if page == 12 else 10)]
        put(f"api/page={page}/part.txt", "\n".join(json.dumps({"id": i, "name": f"n{i}"}) for i in ids))
        wanted += ids
    transport = paged.FileTransport(str(tmp_path / "api"))
    schema = schemas.contract("id BIGINT, name STRING, absent INT")
    found = paged.read_pages(spark, transport, schema, share)
    assert found.rdd.getNumPartitions() == -(-6 // share)
    assert sorted(r.id for r in found.collect()) == wanted
    assert found.filter("absent IS NOT NULL").isEmpty()


def test_last_page_comes_from_the_link_header():
    api = paged.HttpTransport("http://api.example/items")
    link = '<http://api.example/items?page=2>; rel="next", <http://api.example/items?per_page=9&page=34>; rel="last"'
    assert api.last_page(link) == 33
    assert api.last_page('<http://api.example/items?page=1>; rel="prev"') == api.last_page(None) == 0


def test_a_lost_connection_is_transient(monkeypatch):
    from urllib import error

    def broken(*args, **kwargs):
        raise failure

    monkeypatch.setattr(paged.request, "urlopen", broken)
    for failure in (TimeoutError(), error.URLError("reset"), ConnectionResetError()):
        status, _ = paged.HttpTransport("http://api.example/items")(0)
        assert paged.is_transient(status)


NOW = 1792567620  # 2026-10-21 07:27 UTC


@pytest.mark.parametrize("status, headers, wait", [
    (429, {"Retry-After": "30"}, 30), (503, {"Retry-After": "0"}, 1), (429, {}, None),
    (429, {"Retry-After": "Wed, 21 Oct 2026 07:28:00 GMT"}, 60),
    (403, {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": str(NOW + 120)}, 120),
    (403, {"X-RateLimit-Remaining": "7", "X-RateLimit-Reset": str(NOW + 120)}, None),
    (403, {}, None), (404, {"Retry-After": "30"}, None), (429, {"Retry-After": "soon"}, None),
])
def test_the_wait_a_reply_asks_for(status, headers, wait):
    assert paged.asked_wait(status, headers, NOW) == wait


def test_an_asked_wait_is_no_failure():
    replies, waits = [(429, "", 60.0)] * 5 + [(500, ""), (403, "", 9.0), (200, "[1]")], []
    assert paged.fetch_page(lambda page: replies.pop(0), 0, attempts=2, sleep=waits.append) == "[1]"
    assert waits == [60.0] * 5 + [1, 9.0]
    with pytest.raises(paged.ApiError, match="more than 100"):
        paged.fetch_page(lambda page: (429, "", 60.0), 0, sleep=waits.append, patience=100)


def test_paced_calls_keep_their_distance():
    now, calls = [100.0], []

    def pause(seconds):
        now[0] += seconds

    paced = paged.Paced(lambda page: calls.append((page, now[0])), 2.0, lambda: now[0], pause)
    for page in range(3):
        paced(page)
        now[0] += 0.5 if page else 5.0  # a slow reply needs no further wait
    assert calls == [(0, 102.0), (1, 107.0), (2, 109.0)]


def limited_api(folder, allowed):
    """An API of 24 pages that refuses what is above an allowance each second."""
    class Limited:
        def pages(self):
            return range(24)

        def __call__(self, page):
            import os
            import time
            import uuid

            second = int(time.time())
            log = f"{folder}/{second}"
            os.makedirs(log, exist_ok=True)
            name = f"{time.time_ns()}-{uuid.uuid4().hex}"
            open(f"{log}/{name}", "w").close()
            if len(os.listdir(log)) > allowed:
                open(f"{folder}/refused-{name}", "w").close()
                return 429, "", second + 1.05 - time.time()
            return 200, f'[{{"id": {page}}}]'

    return Limited()


@pytest.mark.parametrize("budget", [None, 4 * 3600])
def test_a_limited_api_is_read_whole(spark, tmp_path, budget):
    api = limited_api(str(tmp_path), 5)
    found = paged.read_pages(spark, api, schemas.contract("id BIGINT"), 3, calls_per_hour=budget)
    assert rows(found) == [(i,) for i in range(24)]
    refused = [f for f in os.listdir(tmp_path) if f.startswith("refused")]
    assert bool(refused) == (budget is None)  # eight tasks at once, or four that share the rate
    assert found.rdd.getNumPartitions() == (4 if budget else 8)


def test_a_small_allowance_leaves_one_partition(tmp_path):
    reader = paged._PagedReader(limited_api(str(tmp_path), 5), schemas.contract("id BIGINT"), 3, 3, 60, 1.0)
    only, = reader.partitions()
    assert len(only.pages) == 24 and only.interval == 60.0


# Database

@pytest.fixture(scope="module")
def crm(spark):
    options = {
        "url": "jdbc:derby:memory:sourcetest;create=true",
        "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    }
    rows_ = [(i, f"name{i}", "hash") for i in range(100)]
    (
        spark.createDataFrame(rows_, "ID INT, NAME STRING, PASSWORD_HASH STRING").write.format("jdbc")
        .options(**options).option("dbtable", "CRM")
        .option("createTableColumnTypes", "NAME VARCHAR(20), PASSWORD_HASH VARCHAR(20)").mode("overwrite").save()
    )
    return options


def sizes(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_jdbc_subquery_is_split_into_ranges(spark, crm):
    found = jdbc.read_query(spark, crm, "CRM", ["ID", "NAME"], split_on="ID", rows_per_range=25)
    assert found.rdd.getNumPartitions() == 4 and max(sizes(found)) <= 26
    assert found.columns == ["ID", "NAME"] and rows(found.select("ID")) == [(i,) for i in range(100)]
    small = jdbc.read_query(spark, crm, "CRM", ["ID"], where="ID < 1 OR ID = 50", split_on="ID", rows_per_range=1)
    assert rows(small) == [(0,), (50,)]
    assert jdbc.read_query(spark, crm, "CRM", ["ID"], where="ID < 0", split_on="ID").isEmpty()
    assert jdbc.read_query(spark, crm, "CRM", ["NAME"], split_on="ID").count() == 100


def test_jdbc_ranges_follow_the_rows_not_the_key_span(spark, crm):
    data = [(i,) for i in range(1000)] + [(10_000_000,), (-5,), (None,), (None,)]
    spark.createDataFrame(data, "K BIGINT").write.format("jdbc").options(**crm).option(
        "dbtable", "UNEVEN").mode("overwrite").save()
    found = jdbc.read_query(spark, crm, "UNEVEN", ["K"], split_on="K", rows_per_range=251)
    assert rows(found) == sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    assert found.rdd.getNumPartitions() >= 4 and max(sizes(found)) < 400


def test_federated_ranges_follow_the_rows(spark, crm):
    data = [(i % 40 + 500,) for i in range(1000)] + [(10_000_000,), (-5,), (None,)]
    spark.createDataFrame(data, "K BIGINT").write.format("jdbc").options(**crm).option(
        "dbtable", "BUNCHED").mode("overwrite").save()
    jdbc.register_catalog(spark, "crmtest", crm)
    found = jdbc.read_federated(spark, "crmtest.APP.BUNCHED", ["K"], split_on="K", rows_per_range=200)
    assert rows(found) == sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    assert max(sizes(found)) <= 200
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    few = found.filter("K > 600").select("k")
    assert "PushedFilters: [*IsNotNull(K), *GreaterThan(K,600)]" in few._jdf.queryExecution().executedPlan().toString()
    assert rows(few) == [(10_000_000,)]


def test_queries_for_ranges_follow_the_key_not_the_rows(spark, crm, monkeypatch):
    # Crowds of neighbouring keys far apart from each other are all cut by the same few queries.
    from pyspark.sql import DataFrameReader

    asked = []
    option = DataFrameReader.option

    def counted(self, key, value):
        asked.append(value)
        return option(self, key, value)

    queries = {}
    for crowds in (2, 20):
        data = [(c * 10**15 + i,) for c in range(crowds) for i in range(500)]
        spark.createDataFrame(data, "K BIGINT").write.format("jdbc").options(**crm).option(
            "dbtable", f"CROWDS{crowds}").mode("overwrite").save()
        with monkeypatch.context() as patched:
            patched.setattr(DataFrameReader, "option", counted)
            ranges = jdbc.even_ranges(spark, crm, f"CROWDS{crowds}", "K", [], 100)
        queries[crowds] = len(asked)
        asked.clear()
        found = jdbc.read_query(spark, crm, f"CROWDS{crowds}", ["K"], split_on="K", rows_per_range=100)
        assert found.rdd.getNumPartitions() == len(ranges) >= crowds * 5
        assert max(sizes(found)) <= 150 and rows(found) == data
    assert queries[20] <= queries[2] <= 10


def test_federated_scan_pushes_filter_columns_and_max(spark, crm):
    jdbc.register_catalog(spark, "crmtest", crm)
    whole = jdbc.read_federated(spark, "crmtest.APP.CRM", ["ID", "NAME"], split_on="ID", rows_per_range=25)
    assert whole.rdd.getNumPartitions() == 4 and whole.count() == 100
    assert jdbc.read_federated(spark, "crmtest.APP.CRM", ["NAME"], split_on="ID").rdd.getNumPartitions() == 1
    single = jdbc.read_federated(spark, "crmtest.APP.CRM", ["ID", "NAME"])
    for source, pushed in ((single, "ID > 97"), (whole, "GreaterThan(ID,97)")):  # as each relation prints it
        found = source.filter("ID > 97")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PASSWORD_HASH" not in plan and pushed in plan.split("PushedFilters")[1]
        assert rows(found.select("ID")) == [(98,), (99,)]
    top = spark.table("crmtest.APP.CRM").agg(F.max("ID"))
    assert "PushedAggregates: [MAX(ID)]" in top._jdf.queryExecution().executedPlan().toString()


def test_sensitive_columns_do_not_land(spark, crm, name):
    # E26
    jdbc.register_catalog(spark, "crmtest", crm)
    source = spark.table("crmtest.APP.CRM")
    kept = shaping.allow_columns(source, ["ID", "NAME"], denied=["PASSWORD_HASH"])
    kept.write.saveAsTable(name)
    assert spark.table(name).columns == ["ID", "NAME"]
    with pytest.raises(ValueError):
        shaping.allow_columns(source, ["ID", "password_hash"], denied=["PASSWORD_HASH"])


DATABASE_QUERIES = (
    "column_allowlist", "federated_catalog_scan", "group_count_ranked", "jdbc_subquery_scan",
    "version_check", "watermark_extract", "watermark_kept",
)


@pytest.mark.parametrize("key", DATABASE_QUERIES)
@pytest.mark.parametrize("master", ["local-cluster[3,4,1024]", "yarn"])
def test_database_queries_ask_for_a_reachable_database(spark, tmp_path, monkeypatch, key, master):
    spark.sql(
        "SELECT 1L AS c_custkey, 'ann' AS c_name, 'BUILDING' AS c_mktsegment, 9000.5D AS c_acctbal, 3 AS c_nationkey"
    ).write.parquet(str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(spark.sparkContext, "master", master)
    with pytest.raises(RuntimeError, match="spark.strataflow.jdbc.url"):
        QUERIES[key](spark, str(tmp_path))


def test_a_named_database_is_used_whatever_the_master(spark, tmp_path, monkeypatch):
    land = landing.Landing(spark, str(tmp_path))
    for master in ("local", "local[8]", "local[*]"):
        monkeypatch.setattr(spark.sparkContext, "master", master)
        assert jdbc_options(land)["url"].startswith("jdbc:derby:memory:")
    named = {"url": "jdbc:some://host/crm", "driver": "some.Driver"}
    for key, value in named.items():
        spark.conf.set(f"spark.strataflow.jdbc.{key}", value)
    try:
        for master in ("local[8]", "local-cluster[3,4,1024]", "yarn"):
            monkeypatch.setattr(spark.sparkContext, "master", master)
            assert jdbc_options(land) == named
    finally:
        for key in named:
            spark.conf.unset(f"spark.strataflow.jdbc.{key}")


@pytest.mark.parametrize("key", sorted(set(DATABASE_QUERIES) - {"jdbc_subquery_scan"}))
def test_federated_queries_read_the_schema_the_connection_writes_to(spark, tmp_path, key):
    spark.sql(
        "SELECT id AS c_custkey, concat('n', id) AS c_name, 'BUILDING' AS c_mktsegment, 8999.0D + id AS c_acctbal, "
        "3 AS c_nationkey FROM range(2)"
    ).write.parquet(str(tmp_path / "customer.parquet"))
    own = spark.newSession()  # a session keeps the connection of a catalog it has used
    own.conf.set("spark.strataflow.jdbc.url", "jdbc:derby:memory:schematest;create=true;user=crm;password=x")
    own.conf.set("spark.strataflow.jdbc.schema", "CRM")
    # Customer 1 was changed on day two.
    both, extracted = [(0, "n0"), (1, "n1")], [(0, "snapshot"), (1, "increment"), (1, "snapshot")]
    columns, want = {
        "column_allowlist": (("customer_id", "name"), both),
        "federated_catalog_scan": (("customer_id", "name"), both),
        "group_count_ranked": (("batch_id", "customers"), [("increment", 1), ("snapshot", 2)]),
        "version_check": (("customer_id", "versions"), [(1, 2)]),
        "watermark_extract": (("customer_id", "batch_id"), extracted),
        "watermark_kept": (("customer_id", "batch_id"), extracted),
    }[key]
    assert rows(QUERIES[key](own, str(tmp_path)), *columns) == want


def test_nested_orders_land_compressed_and_whole(spark, tmp_path, monkeypatch):
    def put_table(name, sql):
        spark.sql(sql).write.parquet(str(tmp_path / "in" / f"{name}.parquet"))

    put_table("region", "SELECT 1 AS r_regionkey, 'EUROPE' AS r_name")
    put_table("nation", "SELECT 1 AS n_nationkey, 'SPAIN' AS n_name, 1 AS n_regionkey")
    put_table("customer", "SELECT 1L AS c_custkey, 'c' AS c_name, 1 AS c_nationkey, 'AUTO' AS c_mktsegment")
    put_table("part", "SELECT id AS p_partkey, concat('part ', id) AS p_name, 'LARGE' AS p_type, id + 0.5D AS p_retailprice FROM range(5)")
    put_table("orders", "SELECT id AS o_orderkey, 1L AS o_custkey, 'O' AS o_orderstatus, TIMESTAMP '2024-01-02 00:00:00' AS o_orderdate FROM range(401)")
    # Each order has two suppliers, one of them with two lines; the last order has none.
    put_table("lineitem", "SELECT id % 400 AS l_orderkey, id % 5 AS l_partkey, CAST(id / 800 AS BIGINT) AS l_suppkey, 3D AS l_quantity FROM range(1200)")
    monkeypatch.setattr(landing, "DOCUMENTS_PER_FILE", 300)
    land = landing.Landing(spark, str(tmp_path / "in"))
    documents = landing.fold_orders(land)
    folder = Path(land.nested_orders().removeprefix("file:"))
    names = [f for f in folder.iterdir() if f.name.startswith("part-")]
    assert all(f.name.endswith(".json.gz") for f in names) and len(names) >= 3
    plain = documents.selectExpr("sum(length(to_json(struct(*)))) AS n").first().n
    assert sum(f.stat().st_size for f in names) < plain / 4
    found = land.json_orders().selectExpr("order_id", "supplier_id", "size(items) AS n", "customer.address.region")
    assert rows(found) == sorted(
        [(i, s, 2 - s, "EUROPE") for i in range(400) for s in (0, 1)] + [(400, None, None, "EUROPE")],
        key=lambda r: (r[0], r[1] is not None, r[1]),
    )
    # No list is collected before the rows are dealt by order and supplier.
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    lists, dealt = plan.index("collect_list"), plan.index("RepartitionByExpression [l_orderkey")
    assert lists < dealt
