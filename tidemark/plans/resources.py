"""Resources: raw nodes of one kind -> their normalised tables (the per-resource transform chains).

Each ``*_tables`` function is a pure DataFrame function returning ``{table_name: DataFrame}``; nothing is
executed until a job writes them. Children explode from the already exploded parent (grandchildren from
line items, not from the order root), and every table carries ``shop_id``.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.timefmt import money_amount, parse_instant
from ..naming import snake_case
from ..functions.ids import gid_to_long
from ..operators.nested import explode_child, flatten, normalize_ids, unwrap_connection_expr, unwrap_connections
from ..operators.normalize import (classify_collections, discount_value_fields, flatten_customer_contact,
                                   flatten_order_customer_spend, normalize_discount_applications, shop_profile)
from ..sources import raw_schema as RS
from ..sources.store import FAILED_COL
from .specs import TABLES
from ..operators.privacy import (CUSTOMER_PII_PATHS, ORDER_PII_PATHS, REFUND_PII_PATHS, hash_pii_paths,
                                 nested_paths)

# Wrapped connections of an order node, outermost first.
ORDER_CONNECTIONS = [
    "lineItems", "refunds", "discountApplications", "shippingLines",
    "refunds[*].refundLineItems", "refunds[*].orderAdjustments",
    "lineItems[*].taxLines", "lineItems[*].discountAllocations",
]
PRODUCT_CONNECTIONS = ["images", "variants"]

# Decimal-as-text fields that the target model types as double.
DECIMAL_TEXT_FIELDS = {"subtotal_price", "total_discounts", "total_price", "total_shipping_price", "total_tax",
                       "total_weight", "price", "compare_at_price", "subtotal", "total_spent", "amount"}


def _stamp(df: DataFrame, shop_id: int | Column, loaded_at: Column | None) -> DataFrame:
    sid = shop_id if isinstance(shop_id, Column) else F.lit(int(shop_id))
    return df.withColumn("shopId", sid.cast("bigint")).withColumn(
        "_loaded_at", loaded_at if loaded_at is not None else F.current_timestamp())


#: Set while a load builds its tables: ``finish`` then lists the columns of a row whose text can't be cast.
TRACK_CASTS: ContextVar[bool] = ContextVar("track_casts", default=False)


def finish(df: DataFrame) -> DataFrame:
    """Type rules on flattened text columns: ``*_at`` -> timestamp, decimal text -> double."""
    cols, failed = [], {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        last = f.name.split("__")[-1]
        if isinstance(f.dataType, StringType) and last.endswith("_at") and f.name != "_loaded_at":
            c = parse_instant(c)
        elif isinstance(f.dataType, StringType) and last in DECIMAL_TEXT_FIELDS:
            c = money_amount(c)
        else:
            cols.append(c.alias(f.name))
            continue
        failed[f.name] = c.isNull() & (F.trim(F.col(f"`{f.name}`")) != "")
        cols.append(c.alias(f.name))
    if failed and TRACK_CASTS.get():
        # The list is made for rows with a failure alone: it is evaluated without generated code, casts and all.
        names = F.array_compact(F.array(*[F.when(x, F.lit(name)) for name, x in failed.items()]))
        cols.append(F.when(reduce(or_, failed.values()), names).otherwise(F.array().cast("array<string>")).alias(FAILED_COL))
    return df.select(*cols)


def _table(df: DataFrame) -> DataFrame:
    return finish(flatten(df, snake=True, keep_arrays=False))


def _child(parent: DataFrame, array: str, fk: str, index: bool = False) -> DataFrame:
    return explode_child(parent, array, {"shopId": "shopId", "id": fk}, index="index" if index else None)


# ---------------------------------------------------------------------------------------------
# orders (12 tables)
# ---------------------------------------------------------------------------------------------

def normalize_orders(nodes: DataFrame, shop_id: int | Column, loaded_at: Column | None = None,
                     secret: str | bytes | None = None, pii_paths: list[str] | None = None) -> DataFrame:
    """unwrap -> discount values -> customer spend -> GID parse -> PII hash -> tenant + audit stamp."""
    df = unwrap_connections(nodes, ORDER_CONNECTIONS)
    df = normalize_discount_applications(df)
    df = flatten_order_customer_spend(df)
    df = normalize_ids(df)
    paths = list(ORDER_PII_PATHS if pii_paths is None else pii_paths) + nested_paths("refunds", REFUND_PII_PATHS)
    df = hash_pii_paths(df, paths, secret)
    return _stamp(df, shop_id, loaded_at)


def _is_connection(dtype) -> bool:
    return isinstance(dtype, StructType) and any(
        f.name in ("edges", "nodes") and isinstance(f.dataType, ArrayType) for f in dtype.fields)


def _unwrap_top(df: DataFrame) -> DataFrame:
    """Top-level connection structs -> plain lists (field extraction, no lambdas)."""
    cols = [unwrap_connection_expr(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if _is_connection(f.dataType)
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*cols)


def _scalar_part(df: DataFrame) -> DataFrame:
    """Drop lists of structs (they become child tables) and helper columns."""
    keep = [f.name for f in df.schema.fields
            if not (isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType))
            and not _is_connection(f.dataType) and f.name != "__pk"]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def _explode(parent: DataFrame, array: str, fk: str, index: bool = False) -> DataFrame:
    """Child rows of ``parent.<array>`` carrying ``shopId`` and the parent's parsed id as ``fk``.

    The child's own parsed id is kept as ``__pk`` for grandchildren.
    """
    p = _unwrap_top(parent.select("shopId", "__pk", array))
    child = explode_child(p, array, {"shopId": "shopId", "__pk": fk}, index="index" if index else None)
    if "id" in child.columns:
        child = child.withColumn("__pk", gid_to_long(F.col("id")))
    return child


def _child_table(child: DataFrame, pii: list[str] | None = None, secret: str | bytes | None = None) -> DataFrame:
    flat = normalize_ids(_scalar_part(child))
    if pii:
        flat = hash_pii_paths(flat, pii, secret)
    return _table(flat)


def order_tables(nodes: DataFrame, shop_id: int | Column, loaded_at: Column | None = None,
                 secret: str | bytes | None = None, pii_paths: list[str] | None = None,
                 stage: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Raw order nodes -> the 12 order tables.

    Same result as ``normalize_orders`` followed by exploding, but each list is exploded *first* and the
    id parsing / hashing / discount normalisation run on flat child rows in generated code, instead of
    lambdas rewriting every element of every nested list inside each order.
    """
    base = _stamp(nodes, shop_id, loaded_at).withColumn("__pk", gid_to_long(F.col("id")))
    paths = list(ORDER_PII_PATHS if pii_paths is None else pii_paths)
    root = hash_pii_paths(normalize_ids(flatten_order_customer_spend(_scalar_part(base))), paths, secret)

    if "clientIp" not in root.columns:  # declared but never landed (T24): the column is there, NULL
        root = root.withColumn("clientIp", F.lit(None).cast("string"))

    def child_paths(lst: str, own: list[str] | None = None) -> list[str]:
        """Paths into ``lst[*]`` apply to that child table (the list is exploded before hashing)."""
        prefix = f"{lst}[*]."
        return list(own or []) + [p[len(prefix):] for p in paths if p.startswith(prefix)]

    cut = stage or (lambda df: df)
    # Line items and refunds feed 4 and 3 tables: with a `stage` hook they are exploded once and cut, so
    # their tables read narrow line rows instead of whole orders.
    li = cut(_explode(base, "lineItems", "orderId"))
    rf = cut(_explode(base, "refunds", "orderId"))
    sl = _explode(base, "shippingLines", "orderId")
    da = _explode(base, "discountApplications", "orderId", index=True)
    value = discount_value_fields(F.col("value"))
    da = da.select(*[c for c in da.columns if c != "value"], *[v.alias(k) for k, v in value.items()])
    return {
        "order": _table(root),
        "order__line_items": _child_table(li, child_paths("lineItems"), secret),
        "order__line_items__tax_lines": _child_table(_explode(li, "taxLines", "lineItemId", index=True)),
        "order__line_items__discount_allocations": _child_table(
            _explode(li, "discountAllocations", "lineItemId", index=True)),
        "order__line_items__custom_attributes": _child_table(
            _explode(li, "customAttributes", "lineItemId", index=True)),
        "order__refunds": _child_table(rf, child_paths("refunds", REFUND_PII_PATHS), secret),
        "order__refunds__refund_line_items": _child_table(_explode(rf, "refundLineItems", "refundId")),
        "order__refunds__order_adjustments": _child_table(_explode(rf, "orderAdjustments", "refundId")),
        "order__discount_applications": _child_table(da, child_paths("discountApplications"), secret),
        "order__tax_lines": _child_table(_explode(base, "taxLines", "orderId", index=True),
                                         child_paths("taxLines"), secret),
        "order__shipping_lines": _child_table(sl, child_paths("shippingLines"), secret),
        "order__shipping_lines__tax_lines": _child_table(_explode(sl, "taxLines", "shippingLineId", index=True)),
    }


# ---------------------------------------------------------------------------------------------
# customers (2), products (7), collections (2), bridge (1), shop (1)
# ---------------------------------------------------------------------------------------------

def normalize_customers(nodes: DataFrame, shop_id: int | Column, loaded_at: Column | None = None,
                        secret: str | bytes | None = None) -> DataFrame:
    df = flatten_customer_contact(nodes)
    df = normalize_ids(df)
    df = hash_pii_paths(df, CUSTOMER_PII_PATHS, secret)
    return _stamp(df, shop_id, loaded_at)


def customer_tables(norm: DataFrame) -> dict[str, DataFrame]:
    return {
        "customer": _table(norm.drop("tags")),
        "customer__tags": _table(_child(norm, "tags", "customerId", index=True)),
    }


def normalize_products(nodes: DataFrame, shop_id: int | Column, loaded_at: Column | None = None) -> DataFrame:
    df = unwrap_connections(nodes, PRODUCT_CONNECTIONS)
    df = normalize_ids(df)
    return _stamp(df, shop_id, loaded_at)


def product_tables(norm: DataFrame) -> dict[str, DataFrame]:
    opts = _child(norm, "options", "productId")
    var = _child(norm, "variants", "productId")
    return {
        "product": _table(norm.drop("tags")),
        "product__tags": _table(_child(norm, "tags", "productId", index=True)),
        "product__images": _table(_child(norm, "images", "productId")),
        "product__options": _table(opts),
        "product__options__option_values": _table(
            explode_child(opts, "optionValues", {"shopId": "shopId", "id": "productOptionId"}, index="index")),
        "product__variants": _table(var),
        "product__variants__selected_options": _table(
            explode_child(var, "selectedOptions", {"shopId": "shopId", "id": "variantId"}, index="index")),
    }


def normalize_collections(nodes: DataFrame, shop_id: int | Column, loaded_at: Column | None = None) -> DataFrame:
    df = classify_collections(nodes)
    df = normalize_ids(df)
    return _stamp(df, shop_id, loaded_at)


def collection_tables(norm: DataFrame) -> dict[str, DataFrame]:
    return {
        "collection": _table(norm),
        "collection__rules": _table(_child(norm, "rules", "collectionId")),
    }


def bridge_table(bridge_rows: DataFrame, shop_id: int | Column) -> dict[str, DataFrame]:
    """``collection_product`` from ``sources.scans.bridge_scan`` rows."""
    df = bridge_rows.withColumn("shopId", (shop_id if isinstance(shop_id, Column) else F.lit(int(shop_id))).cast("bigint"))
    return {"collection_product": df.select(*[F.col(c).alias(snake_case(c)) for c in
                                              ["shopId", "collectionId", "productId", "_loaded_at"]])}


def shop_table(shop_nodes: DataFrame, loaded_at: Column | None = None) -> dict[str, DataFrame]:
    return {"shop": finish(shop_profile(shop_nodes, loaded_at))}


def declared(spark: SparkSession) -> dict[str, StructType]:
    """The columns and types of the 25 tables: what the rules above make of the raw read schemas.

    Keys, links to the parent and the tenant are not nullable. Nothing is run: the frames are empty.
    """
    def empty(ddl: str) -> DataFrame:
        return spark.createDataFrame([], ddl)

    stamp = F.lit(None).cast("timestamp")
    norms = (customer_tables(normalize_customers(empty(RS.CUSTOMER_NODE), 0, stamp)),
             product_tables(normalize_products(empty(RS.PRODUCT_NODE), 0, stamp)),
             collection_tables(normalize_collections(empty(RS.COLLECTION_NODE), 0, stamp)),
             bridge_table(empty("collectionId bigint, productId bigint, _loaded_at timestamp"), 0),
             shop_table(empty(RS.shop_envelope_schema()).select("data.shop.*"), stamp))
    tables = dict(order_tables(empty(RS.ORDER_NODE), 0, stamp))
    for t in norms:
        tables.update(t)
    out = {}
    for name, df in tables.items():
        required = {*TABLES[name].pk, *TABLES[name].fk}
        out[name] = StructType([StructField(f.name, f.dataType, f.name not in required) for f in df.schema.fields])
    return out
