"""Cleaning, deduplication, joins and enrichment of customer data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.operators import aggregates, dedup, joins, quality
from strataflow.plans import flows, loads
from strataflow.queries.landing import Landing
from strataflow.queries.registry import query

CRM = ("crm_dirty",)
CRM_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone", "company", "segment", "advisor", "updated_on",
)
JOINED = ("crm_dirty", "addresses", "address_reference")

KEPT = "kept AS (SELECT * FROM crm_dirty WHERE customer_id IS NOT NULL AND email IS NOT NULL)"
FILLED = (
    "filled AS (SELECT * REPLACE (COALESCE(phone, 'No phone') AS phone, "
    "COALESCE(company, 'No company') AS company) FROM kept)"
)


def _title(column: str) -> str:
    return (
        f"trim(array_to_string(list_transform(string_split(lower({column}), ' '), "
        "lambda x: upper(x[1]) || x[2:]), ' '))"
    )


STANDARD = (
    f"standard AS (SELECT * REPLACE (trim(lower(email)) AS email, {_title('first_name')} AS first_name, "
    f"{_title('last_name')} AS last_name, trim(company) AS company) FROM filled)"
)
LATEST = (
    "latest AS (SELECT * FROM standard QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY "
    "updated_on DESC NULLS LAST, phone DESC NULLS LAST, company DESC NULLS LAST, first_name DESC NULLS LAST, "
    "last_name DESC NULLS LAST, email DESC NULLS LAST, segment DESC NULLS LAST, advisor DESC NULLS LAST) = 1)"
)
SILVER = (
    "silver AS (SELECT * REPLACE (CAST(customer_id AS BIGINT) AS customer_id, "
    "CAST(updated_on AS DATE) AS updated_on) FROM latest)"
)
TO_SILVER = f", {KEPT}, {FILLED}, {STANDARD}, {LATEST}, {SILVER}"


@query(
    "null_profile",
    f"SELECT {', '.join(f'COUNT(*) FILTER ({c} IS NULL) AS {c}' for c in CRM_COLUMNS)} FROM crm_dirty",
    CRM,
)
def null_profile(land: Landing) -> DataFrame:
    return quality.null_profile(land.bronze_customers())


@query("required_not_null", f", {KEPT} SELECT * FROM kept", CRM)
def required_not_null(land: Landing) -> DataFrame:
    return quality.keep_required(land.bronze_customers(), flows.REQUIRED)


@query(
    "required_rejects",
    "SELECT *, 'missing: ' || concat_ws(', ', CASE WHEN customer_id IS NULL THEN 'customer_id' END, "
    "CASE WHEN email IS NULL THEN 'email' END) AS reject_reason "
    "FROM crm_dirty WHERE customer_id IS NULL OR email IS NULL",
    CRM,
)
def required_rejects(land: Landing) -> DataFrame:
    return quality.rejected(land.bronze_customers(), flows.REQUIRED)


@query(
    "required_report",
    "SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (customer_id IS NOT NULL AND email IS NOT NULL) AS rows_kept, "
    "COUNT(*) FILTER (customer_id IS NULL OR email IS NULL) AS rows_dropped FROM crm_dirty",
    CRM,
)
def required_report(land: Landing) -> DataFrame:
    return quality.count_missing(land.bronze_customers(), flows.REQUIRED)


@query("fill_defaults", f", {KEPT}, {FILLED} SELECT * FROM filled", CRM)
def fill_defaults(land: Landing) -> DataFrame:
    kept = quality.keep_required(land.bronze_customers(), flows.REQUIRED)
    return quality.fill_defaults(kept, flows.DEFAULTS)


@query("standardize_text", f", {KEPT}, {FILLED}, {STANDARD} SELECT * FROM standard", CRM)
def standardize_text(land: Landing) -> DataFrame:
    return flows.clean_customers(land.bronze_customers())


@query(
    "cast_schema",
    f", {KEPT} SELECT * REPLACE (CAST(customer_id AS BIGINT) AS customer_id, CAST(updated_on AS DATE) AS updated_on) "
    "FROM kept",
    CRM,
)
def cast_schema(land: Landing) -> DataFrame:
    kept = quality.keep_required(land.bronze_customers(), flows.REQUIRED)
    return quality.enforce_schema(kept, schemas.contract(schemas.CRM_SILVER))


@query("dedup_latest", f", {KEPT}, {FILLED}, {STANDARD}, {LATEST} SELECT * FROM latest", CRM)
def dedup_latest(land: Landing) -> DataFrame:
    ties = ["phone", "company", "first_name", "last_name", "email", "segment", "advisor"]
    return dedup.latest_per_key(
        flows.clean_customers(land.bronze_customers()), ["customer_id"], "updated_on", ties
    )


@query("silver_customers", f"{TO_SILVER} SELECT * FROM silver", CRM)
def silver_customers(land: Landing) -> DataFrame:
    name = land.new_table("silver")
    loads.full_load(flows.silver_customers(land.bronze_customers()), name)
    return land.spark.table(name)


def silver(land: Landing) -> DataFrame:
    def load() -> str:
        name = land.new_table("silver")
        loads.full_load(flows.silver_customers(land.bronze_customers()), name)
        return name

    return land.spark.table(land.once("table:silver", load))


@query(
    "silver_validation",
    f"{TO_SILVER} SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, COUNT(DISTINCT customer_id) AS distinct_keys, "
    "CAST(COALESCE(SUM(CASE WHEN email IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS null_email FROM silver",
    CRM,
)
def silver_validation(land: Landing) -> DataFrame:
    return quality.validate_keys(silver(land), "customer_id", "email")


# Joins with the address bridge

SHORT = "customer_id, first_name, address_id, address_type"


@query("join_inner", f"{TO_SILVER} SELECT {SHORT} FROM silver JOIN addresses USING (customer_id)", JOINED)
def join_inner(land: Landing) -> DataFrame:
    return joins.inner_join(_named(land), land.addresses(), ["customer_id"])


def _named(land: Landing) -> DataFrame:
    return silver(land).select("customer_id", "first_name")


@query("join_left", f"{TO_SILVER} SELECT {SHORT} FROM silver LEFT JOIN addresses USING (customer_id)", JOINED)
def join_left(land: Landing) -> DataFrame:
    return joins.outer_join(_named(land), land.addresses(), ["customer_id"], "left")


@query("join_right", f"{TO_SILVER} SELECT {SHORT} FROM silver RIGHT JOIN addresses USING (customer_id)", JOINED)
def join_right(land: Landing) -> DataFrame:
    return joins.outer_join(_named(land), land.addresses(), ["customer_id"], "right")


@query("join_full", f"{TO_SILVER} SELECT {SHORT} FROM silver FULL JOIN addresses USING (customer_id)", JOINED)
def join_full(land: Landing) -> DataFrame:
    return joins.outer_join(_named(land), land.addresses(), ["customer_id"], "full")


@query(
    "join_anti",
    f"{TO_SILVER} SELECT customer_id, first_name FROM silver LEFT JOIN addresses USING (customer_id) "
    "WHERE address_id IS NULL",
    JOINED,
)
def join_anti(land: Landing) -> DataFrame:
    return joins.unmatched(_named(land), land.addresses(), ["customer_id"])


@query(
    "join_left_compound",
    f"{TO_SILVER} SELECT s.customer_id, s.first_name, a.address_id, a.address_type FROM silver s "
    "LEFT JOIN addresses a ON s.customer_id = a.customer_id AND a.address_type = 'Principal'",
    JOINED,
)
def join_left_compound(land: Landing) -> DataFrame:
    return joins.left_join_where(
        _named(land), land.addresses(), ["customer_id"], F.col("address_type") == "Principal"
    )


@query(
    "join_broadcast",
    "SELECT customer_id, address_id, address_type, city, region FROM addresses "
    "LEFT JOIN address_reference USING (address_id)",
    ("addresses", "address_reference"),
)
def join_broadcast(land: Landing) -> DataFrame:
    return joins.lookup_join(land.addresses(), land.address_reference(), ["address_id"])


@query(
    "fanout_check",
    f"{TO_SILVER} SELECT customer_id, COUNT(*) AS rows_after_join FROM silver JOIN addresses USING (customer_id) "
    "GROUP BY customer_id HAVING COUNT(*) > 1",
    JOINED,
)
def fanout_check(land: Landing) -> DataFrame:
    return joins.fanout_keys(silver(land), land.addresses(), ["customer_id"])


FANOUT = (
    "{silver} SELECT customer_id, first_name, address_id, address_type FROM silver JOIN addresses USING (customer_id) "
    "QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {order}, address_id) = 1"
)


@query("fanout_resolve", FANOUT.format(silver=TO_SILVER, order="address_type"), JOINED)
def fanout_resolve(land: Landing) -> DataFrame:
    return flows.one_address_per_customer(_named(land), land.addresses())


@query(
    "fanout_resolve_ranked",
    FANOUT.format(silver=TO_SILVER, order="CASE address_type WHEN 'Principal' THEN 1 WHEN 'Envio' THEN 2 ELSE 3 END"),
    JOINED,
)
def fanout_resolve_ranked(land: Landing) -> DataFrame:
    return flows.one_address_per_customer(_named(land), land.addresses(), ["Principal", "Envio"])


ENRICHED = (
    f"{TO_SILVER}, main AS (SELECT s.*, a.address_id, a.address_type FROM silver s LEFT JOIN addresses a "
    "ON s.customer_id = a.customer_id AND a.address_type = 'Principal'), "
    "enriched AS (SELECT * FROM main LEFT JOIN address_reference USING (address_id))"
)


@query("enriched_customers", f"{ENRICHED} SELECT * FROM enriched", JOINED)
def enriched_customers(land: Landing) -> DataFrame:
    name = land.new_table("enriched")
    loads.full_load(
        flows.enriched_customers(silver(land), land.addresses(), land.address_reference()), name
    )
    return land.spark.table(name)


@query(
    "enriched_report",
    f"{ENRICHED} SELECT region, city, COUNT(*) AS customers FROM enriched GROUP BY region, city",
    JOINED,
)
def enriched_report(land: Landing) -> DataFrame:
    enriched = flows.enriched_customers(silver(land), land.addresses(), land.address_reference())
    return aggregates.ranked_counts(enriched, ["region", "city"], "customers")
