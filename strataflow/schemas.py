"""Explicit contracts of the landed files, as DDL text."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

SALES = (
    "sale_id BIGINT NOT NULL, sale_date DATE NOT NULL, customer_id BIGINT, region STRING, "
    "nation STRING, category STRING, status STRING, amount DOUBLE"
)
ORDERS = (
    "order_id BIGINT NOT NULL, order_date DATE NOT NULL, customer_id BIGINT, "
    "status STRING, priority STRING, amount DOUBLE"
)
NESTED_ORDERS = (
    "order_id BIGINT NOT NULL, order_date DATE NOT NULL, channel STRING, supplier_id BIGINT, "
    "customer STRUCT<customer_id: BIGINT, name: STRING, segment: STRING, "
    "address: STRUCT<nation: STRING, region: STRING>>, "
    "items ARRAY<STRUCT<product: STRING, category: STRING, quantity: INT, unit_price: DOUBLE>>"
)
CRM_BRONZE = (
    "customer_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "company STRING, segment STRING, advisor STRING, updated_on STRING"
)
CRM_SILVER = (
    "customer_id BIGINT NOT NULL, first_name STRING, last_name STRING, email STRING NOT NULL, "
    "phone STRING, company STRING, segment STRING, advisor STRING, updated_on DATE"
)
PRODUCTS_API = (
    "id BIGINT NOT NULL, name STRING, brand STRING, kind STRING, size INT, "
    "price DOUBLE, note STRING, updated_at STRING"
)
EVENT_HINTS = "event_id BIGINT, user_id BIGINT, product_id INT"


def contract(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def as_text(names: list[str] | tuple[str, ...]) -> StructType:
    """The all-text landing schema for the given columns."""
    return StructType([StructField(name, StringType()) for name in names])


def to_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
