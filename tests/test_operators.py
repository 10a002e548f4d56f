from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.operators import aggregates, dedup, joins, quality, shaping
from strataflow.plans import flows, loads
from tests.conftest import rows

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Cleaning

def test_null_profile_counts_every_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a INT, b STRING")
    assert rows(quality.null_profile(df)) == [(1, 2)]


def test_required_defaults_and_rejects(spark):
    # E16
    df = spark.createDataFrame(
        [("1", "a", None), (None, "b", "9"), ("3", None, None), (None, None, "7")], "id STRING, email STRING, phone STRING"
    )
    kept = quality.fill_defaults(quality.keep_required(df, ["id", "email"]), {"phone": "No phone"})
    assert rows(kept) == [("1", "a", "No phone")]
    assert rows(quality.rejected(df, ["id", "email"]), "phone", quality.REJECT_REASON) == [
        (None, "missing: email"), ("7", "missing: id, email"), ("9", "missing: id"),
    ]
    assert rows(quality.count_missing(df, ["id", "email"])) == [(4, 1, 3)]


def test_standard_text(spark):
    df = spark.createDataFrame([(" ANA@MAIL.COM ", "  maría DEL mar ", "O'NEIL ana-maria", " Co ")], "e STRING, n STRING, l STRING, c STRING")
    clean = quality.standardize(df, lower=["e"], title=["n", "l"], trim=["c"])
    assert rows(clean) == [("ana@mail.com", "María Del Mar", "O'neil Ana-maria", "Co")]


def test_contract_orders_casts_and_checks(spark):
    df = spark.createDataFrame([("7", "2026-01-02", "x")], "id STRING, day STRING, extra STRING")
    contract = schemas.contract("day DATE, id BIGINT NOT NULL")
    assert rows(quality.enforce_schema(df, contract)) == [(date(2026, 1, 2), 7)]
    bad = spark.createDataFrame([("x", "2026-01-02", "")], df.schema)
    with pytest.raises(PySparkException):
        quality.enforce_schema(bad, contract).collect()
    with pytest.raises(PySparkException, match="NULL in required column id"):
        quality.enforce_schema(bad, contract, strict=False).collect()
    lenient = schemas.contract("day DATE, id BIGINT")
    assert rows(quality.enforce_schema(bad, lenient, strict=False)) == [(date(2026, 1, 2), None)]


# Deduplication

CRM = [
    # id, first, last, email, phone, company, segment, advisor, updated
    ("4012", "ANA", "lópez", "ANA@MAIL.COM", None, "Acme ", "A", "x", "2026-01-01"),
    ("4012", "ana", "lópez", "ana@mail.com", "1", "Acme", "A", "x", "2026-02-01"),
    ("4020", "luis", "paz", "luis@mail.com", "1", None, "B", "x", "2026-03-01"),
    ("4020", "luis", "paz", "luis@mail.com", "2", None, "B", "x", "2026-01-01"),
    ("4033", "eva", "ruiz", "eva@mail.com", "1", "E", "B", "y", "2026-01-05"),
    ("4033", "eva", "ruiz", "eva@mail.com", "9", "E", "B", "y", "2026-01-05"),
    ("4007", "leo", "sanz", "leo@mail.com", "1", "L", "B", "y", "2026-01-05"),
    ("4013", "mia", "rey", "mia@mail.com", "1", "M", "C", "z", "2026-01-05"),
    ("4015", "noa", "gil", "noa@mail.com", "1", "N", "C", "z", "2026-01-05"),
    (None, "sin", "id", "s@mail.com", "1", "S", "C", "z", "2026-01-05"),
    ("4099", "sin", "mail", None, "1", "S", "C", "z", "2026-01-05"),
]


def bronze(spark):
    return spark.createDataFrame(CRM, schemas.CRM_BRONZE)


def silver(spark):
    return flows.silver_customers(bronze(spark))


def test_silver_keeps_the_latest_of_each_customer(spark):
    # E17, E18
    found = silver(spark)
    assert rows(found, "customer_id", "phone", "updated_on", "company") == [
        (4007, "1", date(2026, 1, 5), "L"), (4012, "1", date(2026, 2, 1), "Acme"),
        (4013, "1", date(2026, 1, 5), "M"), (4015, "1", date(2026, 1, 5), "N"),
        (4020, "1", date(2026, 3, 1), "No company"), (4033, "9", date(2026, 1, 5), "E"),
    ]
    assert rows(quality.validate_keys(found, "customer_id", "email")) == [(6, 6, 0)]
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.contract(schemas.CRM_SILVER)]


def test_dedup_drops_candidates_before_the_shuffle(spark):
    text = plan(dedup.latest_per_key(bronze(spark), ["customer_id"], "updated_on", ["phone"]))
    before = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before


@FEW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 5)), max_size=30))
def test_dedup_is_idempotent_and_right(spark, data):
    df = spark.createDataFrame(data, "k STRING, at INT, v INT")
    once = dedup.latest_per_key(df, ["k"], "at", ["v"])
    best = {}
    for k, at, v in data:
        best[k] = max(best.get(k, (-1, -1)), (at, v))
    assert rows(once) == sorted((k, *b) for k, b in best.items())
    assert rows(dedup.latest_per_key(once, ["k"], "at", ["v"])) == rows(once)


# Joins

def bridge(spark):
    return spark.createDataFrame(
        [
            (4007, 1, "Principal"), (4007, 2, "Envio"), (4012, 3, "Principal"), (4015, 4, "Envio"),
            (4015, 5, "Principal"), (4020, 6, "Principal"), (4033, 7, "Principal"), (9999, 8, "Principal"),
        ],
        "customer_id BIGINT, address_id INT, address_type STRING",
    )


def test_inner_join_fans_out(spark):
    # E19
    found = joins.inner_join(silver(spark), bridge(spark), ["customer_id"])
    assert found.columns.count("customer_id") == 1
    repeated = aggregates.several_versions(found, ["customer_id"])
    assert rows(repeated) == [(4007, 2), (4015, 2)]
    assert rows(joins.fanout_keys(silver(spark), bridge(spark), ["customer_id"])) == rows(repeated)


def test_left_join_keeps_the_unmatched(spark):
    # E20, and both forms of the unmatched-row extract agree
    found = joins.outer_join(silver(spark), bridge(spark), ["customer_id"], "left")
    lacking = rows(found.filter("address_id IS NULL"), "customer_id")
    assert lacking == [(4013,)]
    assert rows(joins.unmatched(silver(spark), bridge(spark), ["customer_id"]), "customer_id") == lacking


def test_compound_condition_keeps_one_row_per_customer(spark):
    # E21: same rows as the condition written into ON, unlike one put after the join
    left, right = silver(spark), bridge(spark)
    found = joins.left_join_where(left, right, ["customer_id"], F.col("address_type") == "Principal")
    assert found.count() == left.count()
    on = (left["customer_id"] == right["customer_id"]) & (right["address_type"] == "Principal")
    written = left.join(right, on, "left").drop(right["customer_id"])
    assert rows(found) == rows(written)
    after = joins.outer_join(left, right, ["customer_id"], "left").filter("address_type = 'Principal'")
    assert after.count() < left.count()


KEYED = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3)), max_size=20)


@FEW
@given(KEYED, KEYED)
def test_outer_joins_equal_the_plain_ones(spark, a, b):
    left, right = spark.createDataFrame(a, "k INT, x INT"), spark.createDataFrame(b, "k INT, y INT")
    for how in ("left", "right", "full"):
        found = joins.outer_join(left, right, ["k"], how)
        assert rows(found, "k", "x", "y") == rows(left.join(right, "k", how), "k", "x", "y")
    matched = left.join(right, "k", "left_semi").count()
    assert matched + joins.unmatched(left, right, ["k"]).count() == left.count()


def test_outer_join_with_a_hot_key_on_both_sides(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    right = spark.range(60).select(F.when(F.col("id") < 20, 7).otherwise(F.col("id") + 5000).alias("k"), F.col("id").alias("y"))
    found = joins.outer_join(left, right, ["k"], "full").agg(F.count("*"), F.count("x"), F.count("y"))
    assert rows(found) == [(1000 * 20 + 2000 + 40, 1000 * 20 + 2000, 1000 * 20 + 40)]


def test_a_hot_key_is_split_on_the_side_a_plain_outer_join_cannot_split(spark, tmp_path):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") < 30_000, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("y")
        ).write.parquet(str(tmp_path / "right"))
        right = spark.read.parquet(str(tmp_path / "right"))
        left = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("x"))
        plain = left.join(right, "k", "left")
        split = joins.outer_join(left, right, ["k"], "left")
        counted = []
        for df in (plain, split):
            df.write.format("noop").mode("overwrite").save()
            counted.append(len(df.collect()))
        assert "skew=true" not in plan(plain) and "skew=true" in plan(split)
        assert counted[0] == counted[1] == 30_000 + 19_999
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_outer_join_shuffles_its_kept_side_once(spark, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loads.full_load(bridge(spark), name)
        df = joins.outer_join(spark.table(name).select("customer_id", "address_id"),
                              spark.range(5000).withColumnRenamed("id", "customer_id"), ["customer_id"], "left")
        df.collect()
        assert "ReusedExchange" in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_lookup_is_broadcast_where_its_size_allows(spark, tmp_path):
    # E22: Spark decides, from the size on disk and from what was shuffled; nothing is measured before
    path = str(tmp_path / "reference")
    spark.range(1, 3000).selectExpr("int(id) AS address_id", "concat('city', id) AS city").write.parquet(path)
    reference = spark.read.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = {}
    try:
        for limit in ("10MB", "1KB"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            df = joins.lookup_join(bridge(spark), reference, ["address_id"])
            found[limit] = (final_plan(df), rows(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in found["10MB"][0] and "LeftOuter" in found["10MB"][0]
    assert "Broadcast" not in found["1KB"][0]
    assert found["10MB"][1] == found["1KB"][1]
    assert all("Limit" not in text for text, _ in found.values())


@pytest.mark.parametrize("hot", [None, 7])
def test_lookup_splits_a_hot_key(spark, hot):
    held = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.shuffle.partitions") if spark.conf.get(k, None) is not None}
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "16",
    }.items():
        spark.conf.set(key, value)
    try:
        key = "CAST(NULL AS INT)" if hot is None else str(hot)
        left = spark.range(0, 60_000, 1, 8).selectExpr(f"CASE WHEN id % 3 = 0 THEN int(id % 500) ELSE {key} END AS address_id", "uuid() AS v")
        df = joins.lookup_join(left, spark.range(500).selectExpr("int(id) AS address_id", "id AS city"), ["address_id"])
        assert "skew=true" in final_plan(df)
        assert df.count() == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for k, v in held.items():
            spark.conf.set(k, v)


def test_cross_join_is_the_product(spark):
    # E23
    three = spark.range(3)
    assert joins.cross_join(three, three.toDF("other")).count() == 9


def test_unions_add_and_dedup_removes_overlap(spark):
    # E24
    one, two = bridge(spark), bridge(spark).select("address_type", "customer_id", "address_id")
    both = shaping.union_by_name(one, two)
    assert both.count() == 16
    assert dedup.distinct_by(both, ["customer_id", "address_id"]).count() == 8
    assert shaping.union_by_position(one, one).count() == 16


def test_priority_resolves_fanout(spark):
    # E25: alphabetical order puts Envio before Principal, a list can turn it round
    found = flows.one_address_per_customer(silver(spark), bridge(spark))
    assert rows(found, "customer_id", "address_id") == [(4007, 2), (4012, 3), (4015, 4), (4020, 6), (4033, 7)]
    ranked = flows.one_address_per_customer(silver(spark), bridge(spark), ["Principal", "Envio"])
    assert rows(ranked, "customer_id", "address_id") == [(4007, 1), (4012, 3), (4015, 5), (4020, 6), (4033, 7)]
    late = dedup.first_per_key(
        joins.inner_join(silver(spark), bridge(spark), ["customer_id"]), ["customer_id"],
        [dedup.by_priority("address_type"), F.col("address_id")],
    )
    assert rows(late) == rows(found)


def test_enriched_customers(spark):
    reference = spark.createDataFrame([(1, "Lima"), (3, "Ica")], "address_id INT, city STRING")
    found = flows.enriched_customers(silver(spark), bridge(spark), reference)
    assert rows(found, "customer_id", "city") == [
        (4007, "Lima"), (4012, "Ica"), (4013, None), (4015, None), (4020, None), (4033, None),
    ]


# Aggregates

def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "k STRING")
    assert rows(aggregates.counts_by(df, ["k"])) == [(None, 2), ("x", 1)]


def test_money_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([("a", 0.1)] * 10 + [("b", 3.0)], "k STRING, amount DOUBLE")
    found = aggregates.totals_by(df, ["k"], "amount").collect()
    assert [tuple(r) for r in found] == [("b", 3.0, 1), ("a", 1.0, 10)]
