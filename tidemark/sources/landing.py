"""Landed raw documents, one directory per resource, one JSON document per line.

Layout under a landing root::

    orders/            connection pages  {data:{orders:{edges:[{node}]}}}
    order_snapshots/   bulk id snapshot lines {id, updatedAt, createdAt}
    order_payloads/    by-id payloads {data:{nodes:[..]}}
    customers/ products/ collections/   connection pages
    collection_products/   membership pages {collection:{id, products:{nodes:[{id}]}}}
    shop/              {data:{shop:{..}}}

Files are read as text and parsed with explicit schemas (``sources.raw_schema``); nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import raw_schema as RS
from . import scans

PAGED = {
    "orders": ("orders", RS.ORDER_NODE),
    "customers": ("customers", RS.CUSTOMER_NODE),
    "products": ("products", RS.PRODUCT_NODE),
    "collections": ("collections", RS.COLLECTION_NODE),
}


def _lines(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.text(f"{root.rstrip('/')}/{name}")


def read_resource(spark: SparkSession, root: str, resource: str, on_missing: str = "raise") -> DataFrame:
    """Raw nodes of one resource (``collection_products`` -> bridge rows, ``shop`` -> shop nodes)."""
    if resource in PAGED:
        conn, ddl = PAGED[resource]
        return scans.page_scan(_lines(spark, root, resource), conn, ddl, on_missing=on_missing)
    if resource == "collection_products":
        return scans.bridge_scan(_lines(spark, root, resource))
    if resource == "shop":
        return scans.shop_scan(_lines(spark, root, resource))
    if resource == "order_snapshots":
        return _lines(spark, root, resource)
    if resource == "order_payloads":
        return scans.payload_scan(scans.landed_at(_lines(spark, root, resource)), RS.ORDER_NODE)
    raise ValueError(f"unknown resource {resource}")


def read_landed(spark: SparkSession, root: str, resources: list[str]) -> dict[str, DataFrame]:
    return {r: read_resource(spark, root, r) for r in resources}
