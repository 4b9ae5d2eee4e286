"""The registered queries: every operator of the inventory applied to the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the *whole* input tables. Column
names and integer widths match ``oracle.SQL``. Timestamps are returned as UTC wall clock
(``timestamp_ntz``) so they compare with engines that have no zoned timestamps.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hmac_sha256_hex, sha256_hex
from ..functions.ids import gid_to_long
from ..functions.timefmt import as_utc_ntz, money_amount, parse_instant
from ..operators import changes as CH
from ..operators import quality as Q
from ..operators import windows as W
from ..operators.merge import merge_counts
from ..operators.nested import explode_list, flatten, normalize_ids, truncation_report, unwrap_connections
from ..operators.normalize import typed_projection
from ..session import prepare, scratch_path
from ..sources import raw_schema as RS
from ..sources import scans
from ..sources.store import TableStore
from ..streaming import stream as ST
from . import feeds, jobs
from . import resources as R
from .specs import TABLES

SHOP_ID = 1
HMAC_TEST_KEY = "tidemark-test-key"
MANIFEST_CUT = "2024-01-20 00:00:00"      # manifest = state of a load that ran at this instant
PRUNE_START = MANIFEST_CUT
MERGE_CUT = datetime(1998, 1, 1)
CHUNK_START = datetime(1995, 1, 1)
CHUNK_END = datetime(1999, 1, 1)
BACKFILL_FIRST = datetime(1996, 3, 1)
BACKFILL_LAST = datetime(1996, 3, 31)
FRESHNESS_NOW = datetime(2024, 1, 31, 8)
# Test mapping of event types onto resources for the freshness report.
EVENT_RESOURCE = {"view": "orders", "click": "customers", "purchase": "products", "signup": "collections",
                  "error": "shop"}


def _ctx(spark: SparkSession) -> None:
    prepare(spark)


def _store(spark: SparkSession, buckets: int = 8) -> TableStore:
    return TableStore(spark, scratch_path(spark, "store"), buckets=buckets)


def _ntz(c: Column | str) -> Column:
    return as_utc_ntz(F.col(c) if isinstance(c, str) else c)


def _order_tables(spark: SparkSession, sf: str, shared: bool = False) -> dict[str, DataFrame]:
    """The 12 order tables. ``shared``: the caller reads several of them, so the orders with their lines are joined
    once and written as Parquet, still flat; each table builds only its own lists of the nodes from there."""
    orders = None
    if shared:
        path = scratch_path(spark, "orders")
        flat = feeds.orders_with_lines(spark, sf)
        flat.write.parquet(path)
        orders = spark.read.schema(flat.schema).parquet(path)
    return R.order_tables(feeds.order_nodes(spark, sf, orders=orders), SHOP_ID)


# ---------------------------------------------------------------------------------------------
# flagship: landed orders -> typed tables -> daily summary
# ---------------------------------------------------------------------------------------------

def order_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    _ctx(spark)
    t = _order_tables(spark, sf, shared=True)
    per_order = t["order__line_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("units"))
    o = t["order"].select(F.col("id").alias("order_id"), F.to_date("updated_at").alias("day"))
    j = o.join(per_order, "order_id", "left")
    return j.groupBy("day").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"),
        F.coalesce(F.sum("n_lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.sum("units"), F.lit(0)).cast("bigint").alias("units"),
    )


# ---------------------------------------------------------------------------------------------
# scans (A1, A2, A4, A5) and projections
# ---------------------------------------------------------------------------------------------

def unwrap_connection(spark, sf):
    _ctx(spark)
    nodes = feeds.order_nodes(spark, sf, mixed_connections=True).select("id", "lineItems")
    flat = unwrap_connections(nodes, ["lineItems"])
    rows = explode_list(flat, "lineItems", gid_to_long("id").alias("order_id"), pos="position", elem="li")
    return rows.select("order_id", F.col("position").cast("bigint").alias("position"),
                       gid_to_long("li.id").alias("line_item_id"), F.col("li.quantity").alias("quantity"))


def page_scan(spark, sf):
    _ctx(spark)
    n = scans.page_scan(feeds.order_pages(spark, sf), "orders", RS.ORDER_NODE)
    return n.select(
        gid_to_long("id").alias("id"),
        _ntz(parse_instant("updatedAt")).alias("updated_at"),
        money_amount("totalPrice").alias("total_price"),
        F.col("displayFinancialStatus").alias("status"),
        F.size(F.col("lineItems.edges")).cast("bigint").alias("n_lines"),
    )


def snapshot_scan(spark, sf):
    _ctx(spark)
    s = scans.snapshot_scan(feeds.snapshot_lines(spark, sf))
    return s.select("gid", _ntz("updated_at").alias("updated_at"), _ntz("created_at").alias("created_at"))


def props_json_scan(spark, sf):
    """Landed JSON text inside a table column (events.props) parsed with an explicit schema."""
    _ctx(spark)
    e = feeds.load(spark, sf, "events").select("event_id", "props")
    return scans.parse_column(e, "props", "k bigint").select("event_id", F.col("doc.k").alias("k"))


def flatten_struct(spark, sf):
    _ctx(spark)
    c, n, r = (feeds.load(spark, sf, t) for t in ("customer", "nation", "region"))
    nested = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        F.struct(
            F.col("c_custkey").alias("customerId"), F.col("c_name").alias("fullName"),
            F.struct(F.col("n_nationkey").alias("nationKey"), F.col("n_name").alias("nationName"),
                     F.struct(F.col("r_regionkey").alias("regionKey"), F.col("r_name").alias("regionName"))
                     .alias("parentRegion")).alias("homeNation"),
        ).alias("customer"))
    return flatten(nested)


def money_bag_flatten(spark, sf):
    _ctx(spark)
    n = feeds.order_nodes(spark, sf).select("id", "totalPriceSet")
    return R.finish(flatten(normalize_ids(n)))


def typed_projection_q(spark, sf):
    _ctx(spark)
    o = feeds.load(spark, sf, "orders")
    as_text = o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("string").alias("total_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_date"),
        F.col("o_orderpriority").alias("priority"))
    spec = [("id", "bigint"), ("customer_id", "bigint"), ("status", "string"), ("total_price", "double"),
            ("order_date", "timestamp"), ("priority", "string")]
    typed = typed_projection(as_text, spec, not_null=["id"])
    return typed.withColumn("order_date", _ntz("order_date"))


def customer_flatten(spark, sf):
    _ctx(spark)
    t = R.customer_tables(R.normalize_customers(feeds.customer_nodes(spark, sf), SHOP_ID))["customer"]
    return t.select("id", "first_name", "last_name", "note", "email", "email_marketing_consent_state",
                    "phone", "total_spent", "total_spent_currency", _ntz("updated_at").alias("updated_at"))


def normalize_document(spark, sf):
    """Document-level normalisation (nested unwrap, discount values, GID parse, PII hash inside arrays)
    checked through per-order facts of the normalised document."""
    _ctx(spark)
    d = R.normalize_orders(feeds.order_nodes(spark, sf), SHOP_ID)
    pct = F.filter("discountApplications", lambda x: x["valueType"] == "percentage")
    return d.select(
        F.col("id"), F.col("email"),
        F.size("lineItems").cast("bigint").alias("n_lines"),
        F.size(pct).cast("bigint").alias("n_percentage_discounts"),
        F.try_element_at(F.col("lineItems.id"), F.lit(1)).alias("first_line_id"),
        F.try_element_at(F.col("refunds.note"), F.lit(1)).alias("first_refund_note"),
    )


def discount_value_normalize(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf)["order__discount_applications"]
    return t.select("order_id", "index", "value_type", "value_percentage", "value_amount", "value_currency_code")


def explode_discounts(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf)["order__discount_applications"]
    return t.select("shop_id", "order_id", "index", "code", "title", "allocation_method", "target_type")


def collection_classify(spark, sf):
    _ctx(spark)
    t = R.collection_tables(R.normalize_collections(feeds.collection_nodes(spark, sf), SHOP_ID))["collection"]
    return t.select("id", "title", "collection_type", "rule_set_applied_disjunctively")


def explode_rules(spark, sf):
    _ctx(spark)
    t = R.collection_tables(R.normalize_collections(feeds.collection_nodes(spark, sf), SHOP_ID))["collection__rules"]
    return t.select("collection_id", "index", "column", "relation", "condition")


def _shops(spark, sf) -> DataFrame:
    return R.shop_table(scans.shop_scan(feeds.shop_envelopes(spark, sf)))["shop"]


def shop_profile(spark, sf):
    _ctx(spark)
    return _shops(spark, sf).select(
        "id", "name", "currency", "domain", "plan_name", "plan_shopify_plus", "plan_partner_development",
        "money_format", "has_gift_cards_feature", "bundles_eligible", "bundles_ineligibility_reason",
        "cart_transform_expand", "cart_transform_merge", "source")


def json_text_columns(spark, sf):
    _ctx(spark)
    s = _shops(spark, sf)
    return s.select(
        "id",
        F.json_array_length("enabled_presentment_currencies").cast("bigint").alias("n_presentment"),
        F.get_json_object("enabled_presentment_currencies", "$[1]").alias("second_currency"),
        F.json_array_length("currency_settings").cast("bigint").alias("n_settings"),
        F.get_json_object("currency_settings", "$[1].enabled").cast("boolean").alias("second_setting_enabled"),
        F.get_json_object("features_json", "$.giftCards").cast("boolean").alias("features_gift_cards"),
    )


def gid_normalize(spark, sf):
    _ctx(spark)
    n = feeds.order_nodes(spark, sf, bad_gids=True).select("id", "customer", "lineItems")
    n = normalize_ids(unwrap_connections(n, ["lineItems"]))
    rows = explode_list(n, "lineItems", F.col("id").alias("order_id"), F.col("customer.id").alias("customer_id"), elem="li")
    return rows.select("order_id", F.col("li.id").alias("line_item_id"), F.col("li.product.id").alias("product_id"),
                       "customer_id")


def pii_hash_sha256(spark, sf):
    _ctx(spark)
    c = feeds.load(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"), sha256_hex("c_name").alias("name_hash"))


def pii_hash_hmac(spark, sf):
    _ctx(spark)
    c = feeds.load(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"), hmac_sha256_hex("c_name", HMAC_TEST_KEY).alias("name_hash"))


def pii_hash_wildcard(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf)["order__refunds"]
    return t.select("order_id", F.col("id").alias("refund_id"), F.col("note").alias("note_hash"))


def inject_shop_id(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf, shared=True)
    parts = []
    for name in ("order", "order__line_items", "order__line_items__tax_lines", "order__refunds",
                 "order__shipping_lines"):
        parts.append(t[name].groupBy("shop_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
                     .select(F.lit(name).alias("table_name"), "shop_id", "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def updated_range_filter(spark, sf):
    _ctx(spark)
    o = feeds.load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"),
                                               F.col("o_orderstatus").alias("status"))
    return W.in_window(o, "updated_at", W.Window(W.utc("1996-01-01T00:00:00Z"), W.utc("1996-12-31T00:00:00Z")))


# ---------------------------------------------------------------------------------------------
# child tables
# ---------------------------------------------------------------------------------------------

def explode_child_q(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf)["order__line_items"]
    return t.select("order_id", "id", "quantity", "sku", "vendor", "original_total_set__shop_money__amount")


def explode_grandchild(spark, sf):
    _ctx(spark)
    return _order_tables(spark, sf)["order__line_items__tax_lines"].select("line_item_id", "index", "title", "rate")


def explode_custom_attributes(spark, sf):
    _ctx(spark)
    return _order_tables(spark, sf)["order__line_items__custom_attributes"].select("line_item_id", "index", "key", "value")


def explode_discount_allocations(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf)["order__line_items__discount_allocations"]
    return t.select("line_item_id", "index", F.col("allocated_amount_set__shop_money__amount").alias("amount"),
                    F.col("discount_application__allocation_method").alias("allocation_method"))


def explode_refunds(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf)["order__refunds__refund_line_items"]
    return t.select("refund_id", "id", "line_item__id", "quantity", "subtotal")


def explode_order_adjustments(spark, sf):
    _ctx(spark)
    return _order_tables(spark, sf)["order__refunds__order_adjustments"].select("refund_id", "id", "reason")


def explode_order_tax_lines(spark, sf):
    _ctx(spark)
    return _order_tables(spark, sf)["order__tax_lines"].select("order_id", "index", "title", "rate")


def explode_shipping_lines(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf, shared=True)
    sl = t["order__shipping_lines"].select(F.col("id").alias("shipping_line_id"), "order_id", "title", "code")
    tl = t["order__shipping_lines__tax_lines"].select("shipping_line_id", "index", F.col("title").alias("tax_title"), "rate")
    return sl.join(tl, "shipping_line_id")


def explode_tags(spark, sf):
    _ctx(spark)
    t = R.product_tables(R.normalize_products(feeds.product_nodes(spark, sf), SHOP_ID))["product__tags"]
    return t.select("product_id", "index", "value")


def explode_customer_tags(spark, sf):
    _ctx(spark)
    t = R.customer_tables(R.normalize_customers(feeds.customer_nodes(spark, sf), SHOP_ID))["customer__tags"]
    return t.select("customer_id", "index", "value")


def explode_options(spark, sf):
    _ctx(spark)
    t = R.product_tables(R.normalize_products(feeds.product_nodes(spark, sf), SHOP_ID))["product__options__option_values"]
    return t.select("product_option_id", "index", "name")


def explode_variants(spark, sf):
    _ctx(spark)
    t = R.product_tables(R.normalize_products(feeds.product_nodes(spark, sf), SHOP_ID))
    v = t["product__variants"].select(F.col("id").alias("variant_id"), "product_id", "sku", "price")
    so = t["product__variants__selected_options"].select("variant_id", "index", "name", "value")
    return v.join(so, "variant_id")


def explode_images(spark, sf):
    _ctx(spark)
    t = R.product_tables(R.normalize_products(feeds.product_nodes(spark, sf), SHOP_ID))["product__images"]
    return t.select("product_id", "id", "url", "width")


def collection_product_bridge(spark, sf):
    _ctx(spark)
    b = R.bridge_table(scans.bridge_scan(feeds.membership_pages(spark, sf)), SHOP_ID)["collection_product"]
    return b.select("shop_id", "collection_id", "product_id")


def truncation_report_q(spark, sf):
    _ctx(spark)
    n = feeds.order_nodes(spark, sf).select(gid_to_long("id").alias("order_id"), "lineItems")
    return truncation_report(n, "order_id", ["lineItems"])


# ---------------------------------------------------------------------------------------------
# sinks (A7, A8, A12) and merge
# ---------------------------------------------------------------------------------------------

def replace_snapshot(spark, sf):
    _ctx(spark)
    store = _store(spark)
    coll = R.collection_tables(R.normalize_collections(feeds.collection_nodes(spark, sf), SHOP_ID))["collection"]
    coll = coll.select("shop_id", "id", "collection_type")
    store.replace("collection", coll.where(F.col("collection_type") == "smart"))
    store.replace("collection", coll)
    return store.read("collection").select("id", "collection_type")


def _merge_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = feeds.load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total_price"),
        F.col("o_orderdate").alias("updated_at"), F.col("o_orderstatus").alias("status"))
    cut = F.lit(MERGE_CUT.isoformat(sep=" ")).cast("timestamp_ntz")
    target = o.where(F.col("updated_at") < cut)
    recent = o.where(F.col("updated_at") >= F.lit((MERGE_CUT - timedelta(days=30)).isoformat(sep=" ")).cast("timestamp_ntz"))
    newer = recent.select("id", (F.col("total_price") + 1).alias("total_price"),
                          (F.col("updated_at") + F.expr("INTERVAL 1 DAY")).alias("updated_at"), "status")
    older = recent.select("id", (F.col("total_price") + 0.5).alias("total_price"), "updated_at", "status")
    return target, newer.unionByName(older)


def merge_upsert(spark, sf):
    _ctx(spark)
    store = _store(spark)
    target, delta = _merge_inputs(spark, sf)
    store.merge("order", target, ["id"])
    store.merge("order", delta, ["id"], prefer=[F.col("updated_at")])
    return store.read("order").select("id", "total_price", "updated_at", "status")


def load_audit(spark, sf):
    _ctx(spark)
    store = _store(spark)
    target, delta = _merge_inputs(spark, sf)
    store.merge("order", target, ["id"])
    res = store.merge("order", delta, ["id"], prefer=[F.col("updated_at")])
    # The merge's own counters (observed while writing) go to the store's _loads table, read back here.
    jobs.record_load(store, jobs.LoadReport({"order": res}), load_id="delta-1")
    return store.read("_loads").select("table_name", "rows_in", "inserted", "updated")


def merge_counts_q(spark, sf):
    """E4 counters computed relationally (no store): the same numbers as the load audit."""
    _ctx(spark)
    target, delta = _merge_inputs(spark, sf)
    return merge_counts(target, delta, ["id"])


# ---------------------------------------------------------------------------------------------
# change detection
# ---------------------------------------------------------------------------------------------

def _latest(df: DataFrame) -> DataFrame:
    return CH.latest_by_key(df, "gid", [F.col("updated_at"), -F.col("event_id")])


def _snapshots(spark, sf) -> DataFrame:
    return feeds.event_snapshots(spark, sf)


def _manifest(spark, sf) -> DataFrame:
    """What earlier runs left: users whose latest event is a purchase are up to date, those whose latest is a signup
    were never loaded, all others stand as of MANIFEST_CUT."""
    e = feeds.load(spark, sf, "events").select(F.col("user_id").alias("gid"), F.col("ts").alias("updated_at"), "event_id", "event_type")
    now, old = _latest(e), _latest(e.where(F.col("updated_at") < F.lit(MANIFEST_CUT).cast("timestamp_ntz")))
    other = now.where(F.col("event_type").isin("purchase", "signup")).select("gid")
    current = now.where(F.col("event_type") == "purchase")
    return current.unionByName(old.join(other, "gid", "left_anti")).select("gid", "updated_at")


def _changed(spark, sf) -> DataFrame:
    return CH.change_detect(_latest(_snapshots(spark, sf)).select("gid", "updated_at"), _manifest(spark, sf))


def latest_by_key(spark, sf):
    _ctx(spark)
    return _latest(_snapshots(spark, sf)).select("gid", "updated_at", "event_id")


def change_detect(spark, sf):
    _ctx(spark)
    return _changed(spark, sf)


def hydrate_join(spark, sf):
    _ctx(spark)
    payloads = feeds.load(spark, sf, "customer").select(F.col("c_custkey").alias("gid"), "c_name", "c_acctbal")
    return CH.hydrate(_changed(spark, sf), payloads, "gid", on_missing="raise")


def hydrate_missing(spark, sf):
    _ctx(spark)
    payloads = feeds.load(spark, sf, "customer").where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("gid"))
    return CH.hydrate_missing(_changed(spark, sf), payloads, "gid")


def topk_snapshots(spark, sf):
    _ctx(spark)
    return CH.oldest_changes(_changed(spark, sf), max_rows=100)


def manifest_prune(spark, sf):
    _ctx(spark)
    return CH.prune_manifest(_manifest(spark, sf), PRUNE_START)


def manifest_update(spark, sf):
    _ctx(spark)
    return CH.update_manifest(_manifest(spark, sf), _changed(spark, sf))


# ---------------------------------------------------------------------------------------------
# windows / incremental
# ---------------------------------------------------------------------------------------------

def date_chunks(spark, sf):
    _ctx(spark)
    o = feeds.load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"))
    tagged = W.assign_chunks(o, "ts", CHUNK_START, CHUNK_END, days=7)
    return tagged.groupBy("chunk_index", "chunk_start", "chunk_end").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_read"))


def date_chunks_dedup(spark, sf):
    """G1 + E2: the union of all chunk reads, deduplicated on the PK, equals one range scan."""
    _ctx(spark)
    o = feeds.load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"))
    tagged = W.assign_chunks(o, "ts", CHUNK_START, CHUNK_END, days=7)
    from ..operators.merge import dedupe_by_pk
    return dedupe_by_pk(tagged.select("id", "ts", "chunk_index"), ["id"], prefer=[F.col("chunk_index")]) \
        .select("id", "ts", F.col("chunk_index").alias("last_chunk"))


def incremental_window(spark, sf):
    _ctx(spark)
    e = feeds.load(spark, sf, "events")
    prior = Q.high_watermark(e.where(F.col("ts") < F.lit(MANIFEST_CUT).cast("timestamp_ntz")), "ts").first()[0]
    w = W.incremental_window(cursor=W.utc(prior), lookback_days=1, end=datetime(2024, 1, 25),
                             overlap_days=7)
    return W.in_window(e, "ts", w).select("event_id", "ts", "user_id")


def high_watermark(spark, sf):
    _ctx(spark)
    return Q.high_watermark(feeds.load(spark, sf, "events"), "ts", ["event_type"])


def daily_partition_backfill(spark, sf):
    _ctx(spark)
    store = _store(spark)
    o = feeds.load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"))
    jobs.backfill_days(store, "order", o, "updated_at", ["id"], BACKFILL_FIRST, BACKFILL_LAST)
    return store.read("order").groupBy("day").agg(F.count(F.lit(1)).cast("bigint").alias("n_orders"))


def _now_from_events(e: DataFrame) -> datetime:
    last = e.agg(F.max("ts")).first()[0]
    return W.start_of_day(W.utc(last)) + timedelta(days=1)


def two_phase_replay(spark, sf):
    _ctx(spark)
    store = _store(spark)
    e = feeds.load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    jobs.replay(store, "events", e, "ts", ["event_id"], now=_now_from_events(e))
    return store.read("events")


def fk_orphans(spark, sf):
    _ctx(spark)
    t = _order_tables(spark, sf, shared=True)
    # Some parents have been archived: their children are orphans.
    orders, lines = t["order"].where("total_price >= 10000"), t["order__line_items"].where("quantity >= 5")
    cust = R.customer_tables(R.normalize_customers(feeds.customer_nodes(spark, sf), SHOP_ID))["customer"]
    prod = R.product_tables(R.normalize_products(feeds.product_nodes(spark, sf), SHOP_ID))["product"]
    return Q.orphan_summary([
        ("order__line_items.order_id->order", t["order__line_items"], orders, ["order_id"], ["id"]),
        ("order__refunds.order_id->order", t["order__refunds"], orders, ["order_id"], ["id"]),
        ("order__refunds__refund_line_items.line_item__id->order__line_items",
         t["order__refunds__refund_line_items"], lines, ["line_item__id"], ["id"]),
        ("order.customer__id->customer", t["order"], cust, ["customer__id"], ["id"]),
        ("order__line_items.product__id->product", t["order__line_items"], prod, ["product__id"], ["id"]),
    ])


def freshness_report(spark, sf):
    _ctx(spark)
    e = feeds.load(spark, sf, "events")
    return Q.freshness_report(e, "event_type", "ts", FRESHNESS_NOW, Q.FRESHNESS_LIMIT_MINUTES, EVENT_RESOURCE)


BULK_WINDOW = (datetime(1997, 6, 1), datetime(2001, 12, 31))


def bulk_orders_load(spark, sf):
    """The bulk orders lifecycle: snapshot lines + by-id payloads -> change detection against a manifest
    left by an earlier run (orders before MERGE_CUT) -> hydrate -> 12 tables -> manifest advanced."""
    _ctx(spark)
    store = _store(spark)
    prior = scans.snapshot_scan(feeds.order_snapshot_lines(spark, sf)).where(
        F.col("updated_at") < F.lit(MERGE_CUT.isoformat(sep=" ")).cast("timestamp")).select("gid", "updated_at")
    store.merge(jobs.manifest_table(SHOP_ID), prior, ["gid"])
    payloads = scans.payload_scan(feeds.order_payloads(spark, sf), RS.ORDER_NODE)
    window = W.Window(W.utc(BULK_WINDOW[0]), W.utc(BULK_WINDOW[1]))
    jobs.load_orders_bulk(store, feeds.order_snapshot_lines(spark, sf), payloads, window, shop_id=SHOP_ID)
    return store.read("order").select("id", _ntz("updated_at").alias("updated_at"), "total_price")


def payload_scan(spark, sf):
    _ctx(spark)
    n = scans.payload_scan(feeds.order_payloads(spark, sf), RS.ORDER_NODE)
    return n.select(gid_to_long("id").alias("id"), money_amount("totalPrice").alias("total_price"),
                    F.size("refunds").cast("bigint").alias("n_refunds"))


# ---------------------------------------------------------------------------------------------
# full load (all 25 tables through the store)
# ---------------------------------------------------------------------------------------------

def landed(spark, sf) -> dict[str, DataFrame]:
    return {
        "orders": feeds.order_nodes(spark, sf),
        "customers": feeds.customer_nodes(spark, sf),
        "products": feeds.product_nodes(spark, sf),
        "collections": feeds.collection_nodes(spark, sf),
        "collection_products": scans.bridge_scan(feeds.membership_pages(spark, sf)),
        "shop": scans.shop_scan(feeds.shop_envelopes(spark, sf)),
    }


def full_load_counts(spark, sf):
    _ctx(spark)
    store = _store(spark, buckets=8)
    report = jobs.run(store, landed(spark, sf), "all", shop_id=SHOP_ID)
    parts = [store.read(name).select(F.lit(name).alias("table_name")) for name in sorted(report.results)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("table_name").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# ---------------------------------------------------------------------------------------------
# streaming
# ---------------------------------------------------------------------------------------------

def _event_stream(spark, sf) -> DataFrame:
    schema = feeds.load(spark, sf, "events").schema
    return ST.file_stream(spark, sf, schema, glob="events.parquet")


def stream_merge(spark, sf):
    _ctx(spark)
    store = _store(spark)
    ST.stream_merge(_event_stream(spark, sf), store, "events", ["event_id"], scratch_path(spark, "ckpt"))
    return store.read("events").select("event_id", "user_id", "ts", "event_type", "value")


def stream_dedup(spark, sf):
    _ctx(spark)
    store = _store(spark)
    redelivered = _event_stream(spark, sf).unionByName(_event_stream(spark, sf))
    ST.stream_dedup(redelivered.select("event_id", "user_id", "ts", "event_type"), store, "events", ["event_id"],
                    scratch_path(spark, "ckpt"))
    return store.read("events")


def stream_dedup_late(spark, sf):
    """Files that arrive out of order and twice, one micro-batch each: every event once, none lost for being late."""
    _ctx(spark)
    store, landing, ckpt = _store(spark), scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    e = feeds.load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    day = F.dayofmonth("ts")
    for part in (day.between(11, 20), day > 20, day <= 10, day.between(15, 20)):
        e.where(part).coalesce(1).write.mode("append").parquet(landing)
        ST.stream_dedup(ST.file_stream(spark, landing, e.schema, max_files=1), store, "events", ["event_id"], ckpt)
    return store.read("events")


def reject_report(spark, sf):
    """Rows without a primary key are kept apart and counted, not merged into one."""
    _ctx(spark)
    store = _store(spark)
    e = feeds.load(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"), "user_id", "event_type")
    store.merge("event", e, ["id"])
    rejects = store.read("_rejects").groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    merged = store.read("event").agg(F.lit("event").alias("table_name"), F.lit("merged").alias("reason"), F.count(F.lit(1)).alias("n_rows"))
    return rejects.unionByName(merged)


INCREMENTAL_RUNS = (datetime(2024, 1, 10), datetime(2024, 2, 1))


def incremental_load(spark, sf):
    """Two loads through stored state: a first run over the last 7 days, a second from the cursor it left."""
    _ctx(spark)
    store = _store(spark)
    for now in INCREMENTAL_RUNS:
        windows = jobs.load_windows(store, ["customers"], SHOP_ID, W.utc(now))
        jobs.run(store, {"customers": feeds.customer_nodes(spark, sf)}, ["customers"], shop_id=SHOP_ID, windows=windows)
    return store.read("customer").select("id", _ntz("updated_at").alias("updated_at"))


def bulk_relanded(spark, sf):
    """Payloads of one id landed three times: the newest by ``updatedAt``, then by the file, is loaded, once, into all 12 tables."""
    _ctx(spark)
    store = _store(spark)
    nodes = feeds.order_nodes(spark, sf)
    landed = lambda df, day: df.withColumn(scans.LANDED, F.struct(F.lit(f"2024-01-0{day}").cast("timestamp").alias("file_modification_time"), F.lit(f"f{day}").alias("file_path")))
    stale = landed(nodes.withColumns({"updatedAt": F.lit("1990-01-01T00:00:00Z"), "totalPrice": F.lit("0.5"), "refunds": F.lit(None).cast(nodes.schema["refunds"].dataType)}), 3)
    earlier = landed(nodes.withColumn("totalPrice", F.lit("0.25")), 1)
    prior = scans.snapshot_scan(feeds.order_snapshot_lines(spark, sf)).where(
        F.col("updated_at") < F.lit(MERGE_CUT.isoformat(sep=" ")).cast("timestamp")).select("gid", "updated_at")
    store.merge(jobs.manifest_table(SHOP_ID), prior, ["gid"])
    window = W.Window(W.utc(BULK_WINDOW[0]), W.utc(BULK_WINDOW[1]))
    report = jobs.load_orders_bulk(store, feeds.order_snapshot_lines(spark, sf), earlier.unionByName(landed(nodes, 2)).unionByName(stale), window, shop_id=SHOP_ID)
    values = {"order": F.round(F.col("total_price") * 100).cast("bigint"), "order__line_items": F.col("quantity"), "order__refunds__refund_line_items": F.col("quantity")}
    return _checksums(store, sorted(report.tables), values)


KEYS_A_TASK = 1_000_000


def _checksums(store: TableStore, tables: list[str], values: dict[str, Column]) -> DataFrame:
    """(table_name, n_rows, n_keys, key_sum, value_sum) of each table; keys by the first column after the tenant's.

    Keys are shuffled into parts of about ``KEYS_A_TASK`` rows before they are grouped, so that no task's table of distinct
    keys grows with the input."""
    parts = []
    for name in tables:
        pk, rows = TABLES[name].pk, store.read(name)
        n_parts = 2 + rows.count() // KEYS_A_TASK  # one part alone would leave the groups of all tables to a single task
        narrow = rows.select(*pk, values.get(name, F.lit(0)).alias("__value")).repartition(n_parts, *pk)
        keys = narrow.groupBy(*pk).agg(F.count(F.lit(1)).alias("__n"), F.sum("__value").alias("__value"))
        parts.append(keys.agg(
            F.lit(name).alias("table_name"), F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
            F.sum(F.col(pk[1]) * F.col("__n")).cast("bigint").alias("key_sum"), F.coalesce(F.sum("__value"), F.lit(0)).cast("bigint").alias("value_sum")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_checksums(spark, sf):
    """Customers, products and collections through the load, each table by value."""
    _ctx(spark)
    store = _store(spark)
    landed_nodes = {"customers": feeds.customer_nodes(spark, sf), "products": feeds.product_nodes(spark, sf), "collections": feeds.collection_nodes(spark, sf)}
    report = jobs.run(store, landed_nodes, list(landed_nodes), shop_id=SHOP_ID)
    length = lambda c: F.length(c).cast("bigint")
    values = {"customer": length("note"), "customer__tags": length("value"), "product": length("title"), "product__tags": length("value"),
              "product__options": length("name"), "product__options__option_values": length("name"), "product__images": F.col("width"),
              "product__variants": F.round(F.col("price") * 100).cast("bigint"), "product__variants__selected_options": length("value"),
              "collection": length("title"), "collection__rules": length("condition")}
    return _checksums(store, sorted(report.results), values)


def cast_failures(spark, sf):
    """Text that can't be cast is counted by column, rows without a required column are kept apart; both by the load itself."""
    _ctx(spark)
    store = _store(spark)
    nation = F.col("tags")[1]
    nodes = feeds.customer_nodes(spark, sf).withColumns({
        "createdAt": F.when(nation == "nation_3", F.lit("soon")).otherwise(F.col("createdAt")),
        "amountSpent": F.when(nation == "nation_4", F.col("amountSpent").withField("amount", F.lit("n/a"))).otherwise(F.col("amountSpent")),
        "id": F.when(nation == "nation_7", F.lit("gid://shop/Customer/none")).otherwise(F.col("id")),
    })
    jobs.run(store, {"customers": nodes}, ["customers"], shop_id=SHOP_ID)
    casts = store.read("_cast_failures").select("table_name", F.concat(F.lit("cast "), "column_name").alias("reason"), "n_rows")
    rejects = store.read("_rejects").groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return casts.unionByName(rejects)


REPLAY_NOW = datetime(2024, 1, 20)
BACKFILL_RUNS = ((datetime(2024, 1, 5), datetime(2024, 1, 7)), (datetime(2024, 1, 6), datetime(2024, 1, 30)))


def replay_load(spark, sf):
    """Two-phase replay of a resource through its stored cursor."""
    _ctx(spark)
    store = _store(spark)
    jobs.replay_resources(store, {"customers": feeds.customer_nodes(spark, sf)}, ["customers"], W.utc(REPLAY_NOW), shop_id=SHOP_ID)
    return store.read("customer").select("id", _ntz("updated_at").alias("updated_at"), "note")


def backfill_load(spark, sf):
    """Two daily backfills whose days overlap: each day once, empty days counted as such."""
    _ctx(spark)
    store = _store(spark)
    for first, last in BACKFILL_RUNS:
        jobs.backfill(store, {"customers": feeds.customer_nodes(spark, sf)}, ["customers"], first, last, shop_id=SHOP_ID)
    loaded = store.read("customer").groupBy(F.to_date("updated_at").alias("day")).agg(F.count(F.lit(1)).alias("n_loaded"))
    return store.read(jobs.BACKFILLS).join(loaded, "day", "left").select("resource", "day", "n_roots", F.coalesce("n_loaded", F.lit(0)).alias("n_loaded"))


def stream_change_detect(spark, sf):
    _ctx(spark)
    store = _store(spark)
    store.merge("manifest", _manifest(spark, sf), ["gid"])
    snaps = _event_stream(spark, sf).select(F.col("user_id").alias("gid"), F.col("ts").alias("updated_at"), "event_id")
    ST.stream_change_detect(snaps, store, "manifest", "changes", "gid", "updated_at",
                            [F.col("updated_at"), -F.col("event_id")], scratch_path(spark, "ckpt"))
    return store.read("changes")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "order_daily_summary": order_daily_summary,
    "unwrap_connection": unwrap_connection,
    "page_scan": page_scan,
    "snapshot_scan": snapshot_scan,
    "props_json_scan": props_json_scan,
    "flatten_struct": flatten_struct,
    "money_bag_flatten": money_bag_flatten,
    "typed_projection": typed_projection_q,
    "customer_flatten": customer_flatten,
    "normalize_document": normalize_document,
    "discount_value_normalize": discount_value_normalize,
    "collection_classify": collection_classify,
    "shop_profile": shop_profile,
    "json_text_columns": json_text_columns,
    "gid_normalize": gid_normalize,
    "pii_hash_sha256": pii_hash_sha256,
    "pii_hash_hmac": pii_hash_hmac,
    "pii_hash_wildcard": pii_hash_wildcard,
    "inject_shop_id": inject_shop_id,
    "updated_range_filter": updated_range_filter,
    "explode_child": explode_child_q,
    "explode_grandchild": explode_grandchild,
    "explode_custom_attributes": explode_custom_attributes,
    "explode_discount_allocations": explode_discount_allocations,
    "explode_refunds": explode_refunds,
    "explode_order_adjustments": explode_order_adjustments,
    "explode_discounts": explode_discounts,
    "explode_order_tax_lines": explode_order_tax_lines,
    "explode_shipping_lines": explode_shipping_lines,
    "explode_tags": explode_tags,
    "explode_customer_tags": explode_customer_tags,
    "explode_options": explode_options,
    "explode_variants": explode_variants,
    "explode_images": explode_images,
    "explode_rules": explode_rules,
    "collection_product_bridge": collection_product_bridge,
    "replace_snapshot": replace_snapshot,
    "latest_by_key": latest_by_key,
    "change_detect": change_detect,
    "hydrate_join": hydrate_join,
    "hydrate_missing": hydrate_missing,
    "topk_snapshots": topk_snapshots,
    "merge_upsert": merge_upsert,
    "load_audit": load_audit,
    "merge_counts": merge_counts_q,
    "manifest_prune": manifest_prune,
    "manifest_update": manifest_update,
    "date_chunks": date_chunks,
    "date_chunks_dedup": date_chunks_dedup,
    "incremental_window": incremental_window,
    "high_watermark": high_watermark,
    "daily_partition_backfill": daily_partition_backfill,
    "two_phase_replay": two_phase_replay,
    "truncation_report": truncation_report_q,
    "fk_orphans": fk_orphans,
    "freshness_report": freshness_report,
    "full_load_counts": full_load_counts,
    "bulk_orders_load": bulk_orders_load,
    "payload_scan": payload_scan,
    "stream_merge": stream_merge,
    "stream_dedup": stream_dedup,
    "stream_change_detect": stream_change_detect,
    "stream_dedup_late": stream_dedup_late,
    "reject_report": reject_report,
    "incremental_load": incremental_load,
    "bulk_relanded": bulk_relanded,
    "load_checksums": load_checksums,
    "cast_failures": cast_failures,
    "replay_load": replay_load,
    "backfill_load": backfill_load,
}
