"""End-to-end flows, each a function from DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.operators import dedup, joins, quality, shaping

REQUIRED = ("customer_id", "email")
DEFAULTS = {"phone": "No phone", "company": "No company"}


def flatten_orders(orders: DataFrame) -> DataFrame:
    """Nested orders to one row per ordered item. Columns that are not part of
    the nested contract, such as audit columns, are kept."""
    nested = {"customer", "items"}
    rest = {c: c for c in orders.columns if c not in nested}
    header = shaping.flatten(
        orders,
        rest
        | {
            "customer_id": "customer.customer_id",
            "customer_name": "customer.name",
            "customer_segment": "customer.segment",
            "customer_nation": "customer.address.nation",
            "customer_region": "customer.address.region",
            "items": "items",
        },
    )
    lines = shaping.explode_items(
        header, "items", {c: c for c in ("product", "category", "quantity", "unit_price")}
    )
    return lines.withColumn("item_amount", F.col("quantity") * F.col("unit_price"))


def clean_customers(bronze: DataFrame) -> DataFrame:
    """Required keys, defaults and standard text; still one row per landed row."""
    kept = quality.keep_required(bronze, REQUIRED)
    filled = quality.fill_defaults(kept, DEFAULTS)
    return quality.standardize(
        filled, lower=["email"], title=["first_name", "last_name"], trim=["company"]
    )


def silver_customers(bronze: DataFrame) -> DataFrame:
    """All-text customer rows to one typed row per customer, the latest.

    The update date is still text when it is compared, which is right for ISO
    dates only.
    """
    ties = ["phone", "company", "first_name", "last_name", "email", "segment", "advisor"]
    latest = dedup.latest_per_key(clean_customers(bronze), ["customer_id"], "updated_on", ties)
    return quality.enforce_schema(latest, schemas.contract(schemas.CRM_SILVER))


def enriched_customers(customers: DataFrame, bridge: DataFrame, reference: DataFrame) -> DataFrame:
    """Customers with their main address, and its details where it is known."""
    main = joins.left_join_where(
        customers, bridge, ["customer_id"], F.col("address_type") == "Principal"
    )
    return joins.lookup_join(main, reference, ["address_id"])


def one_address_per_customer(customers: DataFrame, bridge: DataFrame, ranking: list[str] | None = None) -> DataFrame:
    """Inner join without fan-out: the first address by type, alphabetical or ranked.

    Customers are unique here, so choosing one bridge row per key before the join
    gives the row a ranking after the join would choose, and the join stays 1:1.
    """
    first = dedup.first_per_key(
        bridge, ["customer_id"],
        [dedup.by_priority("address_type", ranking), F.col("address_id").asc_nulls_last()],
    )
    return joins.inner_join(customers, first, ["customer_id"])
