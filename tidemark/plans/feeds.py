"""Commerce-shaped nested inputs derived, with Spark, from the driver's flat tables.

The engine consumes landed nested JSON (orders with line-item connections, customers, products, ...).
The test warehouse is flat, so these builders nest it first -- orders <- orders + lineitem,
customers <- customer, products / collections <- part, shops <- supplier, snapshot lines <- events --
and the real operators then run on the result. All work is distributed and grows with the tables:

* line items are grouped per order (one shuffle on the order key); a group is one order's lines, which the
  upstream API bounds (at most 250 per order), so no group can grow with the table;
* membership pages hold at most ``PAGE_SIZE`` product ids, keyed by ``(collection, id range)``;
* a line's position inside its order is its rank by ``(l_linenumber, l_partkey, l_suppkey)``, unique per
  order in the data, so positions and derived ids are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import to_gid
from ..functions.timefmt import format_instant
from ..session import table_path

PAGE_SIZE = 100          # nodes per landed connection page
LINE_PAGE_CAP = 5        # line-item page size of the test feed: more lines flag hasNextPage
LINE_ID_STRIDE = 1000    # line id = order key * stride + position


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _money(amount: Column, currency: Column | str = "USD") -> Column:
    cur = F.lit(currency) if isinstance(currency, str) else currency
    return F.struct(amount.cast("string").alias("amount"), cur.alias("currencyCode"))


def _bag(amount: Column, presentment_currency: Column | str = "USD") -> Column:
    return F.struct(_money(amount).alias("shopMoney"), _money(amount, presentment_currency).alias("presentmentMoney"))


def _only_if(cond: Column, element: Column) -> Column:
    """``[element]`` when ``cond`` else a correctly typed empty list."""
    return F.filter(F.array(element), lambda _: cond)


# ---------------------------------------------------------------------------------------------
# orders
# ---------------------------------------------------------------------------------------------

LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
               "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def order_lines(lineitem: DataFrame, per: int | None = None) -> DataFrame:
    """``(l_orderkey, lines)``: each order's lines as a position-sorted array (one shuffle on the order key).

    The explicit hash partitioning on the key replaces the aggregate's own exchange (still one shuffle) and
    skips map-side partial aggregation, which cannot shrink a ``collect_list`` and only costs memory. ``per``: the
    shuffle is on the key range ``l_orderkey div per`` (``__lines_of``), so that orders of one page meet there too.
    """
    lines = F.array_sort(F.collect_list(F.struct(*LINE_FIELDS))).alias("lines")
    if per is None:
        return lineitem.repartition("l_orderkey").groupBy("l_orderkey").agg(lines)
    ranged = lineitem.withColumn("__lines_of", F.floor(F.col("l_orderkey") / per))
    return ranged.repartition("__lines_of").groupBy("__lines_of", "l_orderkey").agg(lines)


def orders_with_lines(spark: SparkSession, sf_dir: str, per: int | None = None) -> DataFrame:
    """Every order with its ``lines``: still flat and narrow. ``per``: with ``__range`` (``o_orderkey div per``), by which
    both sides are shuffled, so that the orders of a page are grouped without a further shuffle."""
    orders = load(spark, sf_dir, "orders")
    lines = order_lines(load(spark, sf_dir, "lineitem"), per)
    elem_t = lines.schema["lines"].dataType.elementType
    same = orders.o_orderkey == lines.l_orderkey
    if per is not None:
        orders = orders.withColumn("__range", F.floor(F.col("o_orderkey") / per)).repartition("__range")
        same = (orders["__range"] == lines["__lines_of"]) & (orders.o_orderkey == lines.l_orderkey)
    # orders without lines: an empty list, never NULL (computed once, reused by every nested field below)
    o = orders.join(lines, same, "left").drop("l_orderkey", "__lines_of")
    return o.withColumn("lines", F.coalesce(F.col("lines"), F.array_compact(F.array(F.lit(None).cast(elem_t)))))


def line_id(order_key: Column, pos: Column) -> Column:
    return order_key * F.lit(LINE_ID_STRIDE) + pos


def _line_node(order_key: Column, x: Column, i: Column) -> Column:
    lid = line_id(order_key, i)
    disc = x["l_discount"]
    allocation = F.struct(
        _bag(disc).alias("allocatedAmountSet"),
        F.struct(
            F.lit("ACROSS").alias("allocationMethod"),
            F.lit("ALL").alias("targetSelection"),
            F.lit("LINE_ITEM").alias("targetType"),
            F.struct(F.lit(None).cast("string").alias("amount"), F.lit(None).cast("string").alias("currencyCode"),
                     disc.alias("percentage")).alias("value"),
        ).alias("discountApplication"),
    )
    return F.struct(
        to_gid("LineItem", lid).alias("id"),
        F.struct(to_gid("Product", x["l_partkey"]).alias("id"),
                 F.concat(F.lit("Part "), x["l_partkey"].cast("string")).alias("title")).alias("product"),
        F.struct(to_gid("ProductVariant", x["l_partkey"]).alias("id"),
                 F.concat(F.lit("SKU-"), x["l_partkey"].cast("string")).alias("sku"),
                 x["l_extendedprice"].cast("string").alias("price")).alias("variant"),
        x["l_quantity"].cast("bigint").alias("quantity"),
        F.concat(F.lit("SKU-"), x["l_partkey"].cast("string")).alias("sku"),
        F.concat(F.lit("Supplier#"), x["l_suppkey"].cast("string")).alias("vendor"),
        x["l_linenumber"].cast("bigint").alias("currentQuantity"),
        _bag(x["l_extendedprice"]).alias("originalTotalSet"),
        F.array(
            F.struct(F.lit("VAT").alias("title"), x["l_tax"].alias("rate")),
            F.struct(F.lit("CITY").alias("title"), x["l_discount"].alias("rate")),
        ).alias("taxLines"),
        F.array(
            F.struct(F.lit("returnflag").alias("key"), x["l_returnflag"].alias("value")),
            F.struct(F.lit("linestatus").alias("key"), x["l_linestatus"].alias("value")),
        ).alias("customAttributes"),
        _only_if(disc > 0, allocation).alias("discountAllocations"),
        x["l_linestatus"].alias("fulfillmentStatus"),
    )


def _discount_value(x: Column) -> Column:
    """Even line numbers carry a percentage value, odd ones an amount string ('' when the discount is 0)."""
    disc = x["l_discount"]
    even = (x["l_linenumber"] % 2) == 0
    amount = F.when(disc == 0, F.lit("")).otherwise(disc.cast("string"))
    return F.struct(
        F.when(~even, amount).alias("amount"),
        F.when(~even, F.lit("USD")).alias("currencyCode"),
        F.when(even, disc).alias("percentage"),
    )


def _refund(order_key: Column, x: Column, i: Column) -> Column:
    lid = line_id(order_key, i)
    adjustment = F.struct(to_gid("OrderAdjustment", lid).alias("id"), F.lit("RESTOCK").alias("reason"))
    return F.struct(
        to_gid("Refund", lid).alias("id"),
        format_instant(x["l_shipdate"], micros=False).alias("createdAt"),
        F.concat(F.lit("return of line "), lid.cast("string")).alias("note"),
        F.struct(F.array(F.struct(F.struct(
            to_gid("RefundLineItem", lid).alias("id"),
            F.struct(to_gid("LineItem", lid).alias("id")).alias("lineItem"),
            x["l_quantity"].cast("bigint").alias("quantity"),
            x["l_extendedprice"].cast("string").alias("subtotal"),
        ).alias("node"))).alias("edges")).alias("refundLineItems"),
        F.struct(_only_if(x["l_discount"] > 0.05, adjustment).alias("nodes")).alias("orderAdjustments"),
    )


def order_nodes(spark: SparkSession, sf_dir: str, bad_gids: bool = False, mixed_connections: bool = False,
                orders: DataFrame | None = None) -> DataFrame:
    """One raw order node per order (schema: a subset of ``raw_schema.ORDER_NODE``).

    ``bad_gids``: ids of pending ('P') orders get a query string with a ``/`` so they do not parse.
    ``mixed_connections``: odd orders land ``lineItems`` as ``{nodes}``, even ones as ``{edges}``.
    ``orders``: ``orders_with_lines`` that the caller has already.
    """
    o = orders_with_lines(spark, sf_dir) if orders is None else orders
    return o.select(*_order_node(F.col, bad_gids, mixed_connections))


def _order_node(of: Callable[[str], Column], bad_gids: bool = False, mixed_connections: bool = False) -> list[Column]:
    """The fields of an order node; ``of`` gives a column of ``orders_with_lines`` by its name."""
    k = of("o_orderkey")
    ls = of("lines")
    presentment = F.when(of("o_orderpriority") == "1-URGENT", F.lit("EUR")).otherwise(F.lit("USD"))
    query = F.when(of("o_orderstatus") == "P", F.lit("src=a/b")).otherwise(F.lit("channel=web")) \
        if bad_gids else F.lit("channel=web")
    email = F.concat(F.lit("customer"), of("o_custkey").cast("string"), F.lit("@example.com"))
    # one lambda pass builds each edge (node + cursor); the {nodes} form is a field extraction of it
    edges = F.transform(ls, lambda x, i: F.struct(
        _line_node(k, x, i).alias("node"),
        F.concat(F.lit("c"), to_gid("LineItem", line_id(k, i))).alias("cursor")))
    nodes = edges.getField("node")
    page = F.struct(F.size(ls) > LINE_PAGE_CAP, F.lit(None).cast("string")).cast(
        "struct<hasNextPage:boolean,endCursor:string>")
    if mixed_connections:
        odd = (k % 2) == 1
        line_conn = F.struct(F.when(~odd, edges).alias("edges"), F.when(odd, nodes).alias("nodes"),
                             page.alias("pageInfo"))
    else:
        line_conn = F.struct(edges.alias("edges"), page.alias("pageInfo"))
    discounts = F.transform(ls, lambda x, i: F.struct(F.struct(
        F.lit("ACROSS").alias("allocationMethod"), F.lit("ALL").alias("targetSelection"),
        F.lit("LINE_ITEM").alias("targetType"), _discount_value(x).alias("value"),
        F.concat(F.lit("CODE"), x["l_linenumber"].cast("string")).alias("code"),
        F.concat(F.lit("line "), x["l_linenumber"].cast("string")).alias("title"),
    ).alias("node")))
    tax_lines = F.transform(ls, lambda x, i: F.struct(
        F.concat(F.lit("LINE_"), x["l_linenumber"].cast("string")).alias("title"), x["l_tax"].alias("rate")))
    shipping = _only_if(F.size(ls) > 0, F.struct(F.struct(
        to_gid("ShippingLine", k).alias("id"),
        of("o_orderpriority").alias("title"),
        F.lit("STD").alias("code"),
        F.concat(F.lit("+1555"), F.lpad(of("o_custkey").cast("string"), 7, "0")).alias("phone"),
        _bag(of("o_totalprice")).alias("originalPriceSet"),
        F.array(F.struct(F.lit("SHIP_VAT").alias("title"), F.lit(0.1).alias("rate"))).alias("taxLines"),
    ).alias("node")))
    refunds = F.filter(
        F.transform(ls, lambda x, i: F.when(x["l_returnflag"] == "R", _refund(k, x, i))),
        lambda r: r.isNotNull())
    stamp = format_instant(of("o_orderdate"), micros=False)
    return [
        F.concat(to_gid("Order", k), F.lit("?"), query).alias("id"),
        F.concat(F.lit("#"), k.cast("string")).alias("name"),
        stamp.alias("createdAt"), stamp.alias("processedAt"), stamp.alias("updatedAt"),
        F.lit("USD").alias("currencyCode"), presentment.alias("presentmentCurrencyCode"),
        email.alias("email"),
        F.concat(F.lit("+1555"), F.lpad(of("o_custkey").cast("string"), 7, "0")).alias("phone"),
        of("o_orderpriority").alias("note"),
        F.array(of("o_orderpriority"), of("o_orderstatus")).alias("tags"),
        of("o_orderstatus").alias("displayFinancialStatus"),
        of("o_totalprice").cast("string").alias("totalPrice"),
        F.struct(to_gid("Customer", of("o_custkey")).alias("id"), email.alias("email")).alias("customer"),
        _bag(of("o_totalprice"), presentment).alias("totalPriceSet"),
        F.struct(discounts.alias("edges")).alias("discountApplications"),
        tax_lines.alias("taxLines"),
        F.struct(shipping.alias("edges")).alias("shippingLines"),
        line_conn.alias("lineItems"),
        refunds.alias("refunds"),
    ]


HYDRATE_BATCH = 25      # order ids per by-id payload document


def order_snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 landing for orders: one ``{id, updatedAt, createdAt}`` JSON line per order (same gids as the nodes)."""
    o = load(spark, sf_dir, "orders")
    gid = F.concat(to_gid("Order", F.col("o_orderkey")), F.lit("?channel=web"))
    stamp = format_instant(F.col("o_orderdate"), micros=False)
    return o.select(F.to_json(F.struct(gid.alias("id"), stamp.alias("updatedAt"), stamp.alias("createdAt"))).alias("value"))


def _pages(spark: SparkSession, sf_dir: str, per: int) -> DataFrame:
    """``__orders``: the flat orders, with their lines, of each key range ``o_orderkey div per``.

    The flat rows are what is shuffled and grouped; the far wider nodes are built, and written as text, page by page.
    """
    o = orders_with_lines(spark, sf_dir, per)
    return o.groupBy("__range").agg(F.collect_list(F.struct(*[c for c in o.columns if c != "__range"])).alias("__orders"))


def _text(pages: DataFrame, document: Column) -> DataFrame:
    # One element's explode: what reads ``value`` can't be pushed below it, which would write the text once a use.
    return pages.select(F.explode(F.array(F.to_json(document))).alias("value"))


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 landing: by-id payload documents ``{data:{nodes:[..]}}`` of at most ``HYDRATE_BATCH`` orders."""
    nodes = F.transform("__orders", lambda o: F.struct(*_order_node(o.getField)))
    return _text(_pages(spark, sf_dir, HYDRATE_BATCH), F.struct(F.struct(nodes.alias("nodes")).alias("data")))


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 landing: connection pages of at most ``PAGE_SIZE`` orders as JSON text (``value``).

    Orders are paged by key range (``o_orderkey div PAGE_SIZE``), so a page never grows with the table.
    """
    def edge(o: Column) -> Column:
        node = _order_node(o.getField)
        return F.struct(node[0].alias("cursor"), F.struct(*node).alias("node"))

    env = F.struct(F.struct(F.struct(
        F.struct(F.lit(False).alias("hasNextPage"), F.lit(None).cast("string").alias("endCursor")).alias("pageInfo"),
        F.transform("__orders", edge).alias("edges"),
    ).alias("orders")).alias("data"))
    return _text(_pages(spark, sf_dir, PAGE_SIZE), env)


# ---------------------------------------------------------------------------------------------
# customers, products, collections, shops
# ---------------------------------------------------------------------------------------------

def customer_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer nodes; accounts with a negative balance have no default email (NULL object)."""
    c = load(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    updated = F.timestamp_seconds(F.lit(1704067200) + F.col("c_nationkey").cast("bigint") * 86400)
    email = F.struct(
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("emailAddress"),
        F.when(F.col("c_acctbal") > 5000, F.lit("SUBSCRIBED")).otherwise(F.lit("NOT_SUBSCRIBED")).alias("marketingState"),
        F.lit("SINGLE_OPT_IN").alias("marketingOptInLevel"),
        format_instant(updated, micros=False).alias("marketingUpdatedAt"),
    )
    return c.select(
        to_gid("Customer", key).alias("id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("firstName"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("lastName"),
        F.col("c_mktsegment").alias("note"),
        F.lit("ENABLED").alias("state"),
        format_instant(updated, micros=False).alias("createdAt"),
        format_instant(updated, micros=False).alias("updatedAt"),
        F.array(F.col("c_mktsegment"), F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))).alias("tags"),
        F.when(F.col("c_acctbal") >= 0, email).alias("defaultEmailAddress"),
        F.struct(F.concat(F.lit("+1"), F.lpad(key.cast("string"), 10, "0")).alias("phoneNumber")).alias("defaultPhoneNumber"),
        _money(F.col("c_acctbal")).alias("amountSpent"),
    )


def product_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product nodes: tags = words of the name; options Brand / Type / Words; one variant; one image."""
    p = load(spark, sf_dir, "part")
    key = F.col("p_partkey")
    image = F.struct(
        to_gid("ProductImage", key).alias("id"), F.col("p_name").alias("altText"),
        F.concat(F.lit("https://img.example/"), key.cast("string"), F.lit(".png")).alias("url"),
        (F.col("p_size") * 10).cast("bigint").alias("width"), (F.col("p_size") * 10).cast("bigint").alias("height"),
    )

    def option(slot: int, name: str, values: Column) -> Column:
        oid = key * 10 + slot
        return F.struct(
            to_gid("ProductOption", oid).alias("id"), F.lit(name).alias("name"), F.lit(slot).cast("bigint").alias("position"),
            F.transform(values, lambda v, i: F.struct(
                to_gid("ProductOptionValue", oid * 100 + i).alias("id"), v.alias("name"),
                F.lit(True).alias("hasVariants"))).alias("optionValues"),
        )

    variant = F.struct(
        to_gid("ProductVariant", key).alias("id"), F.col("p_name").alias("title"),
        F.concat(F.lit("SKU-"), key.cast("string")).alias("sku"), F.lit(1).cast("bigint").alias("position"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.array(F.struct(F.lit("Brand").alias("name"), F.col("p_brand").alias("value")),
                F.struct(F.lit("Size").alias("name"), F.col("p_size").cast("string").alias("value"))).alias("selectedOptions"),
    )
    return p.select(
        to_gid("Product", key).alias("id"),
        F.col("p_name").alias("title"),
        F.regexp_replace("p_name", " ", "-").alias("handle"),
        F.col("p_type").alias("productType"),
        F.lit("ACTIVE").alias("status"),
        F.split(F.col("p_name"), " ").alias("tags"),
        F.col("p_brand").alias("vendor"),
        F.col("p_size").cast("bigint").alias("totalInventory"),
        F.struct(F.struct(F.lit(False).alias("hasNextPage")).alias("pageInfo"), F.array(image).alias("nodes")).alias("images"),
        F.array(option(1, "Brand", F.array(F.col("p_brand"))), option(2, "Type", F.array(F.col("p_type"))),
                option(3, "Words", F.split(F.col("p_name"), " "))).alias("options"),
        F.struct(F.struct((F.col("p_size") > 45).alias("hasNextPage")).alias("pageInfo"),
                 F.array(variant).alias("nodes")).alias("variants"),
    )


def collection_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection per part: even sizes are smart collections (2 rules), odd sizes are custom (NULL ruleSet)."""
    p = load(spark, sf_dir, "part")
    rules = F.array(
        F.struct(F.lit("TYPE").alias("column"), F.lit("EQUALS").alias("relation"), F.col("p_type").alias("condition")),
        F.struct(F.lit("VENDOR").alias("column"), F.lit("EQUALS").alias("relation"), F.col("p_brand").alias("condition")),
    )
    rule_set = F.struct((F.col("p_size") > 25).alias("appliedDisjunctively"), rules.alias("rules"))
    return p.select(
        to_gid("Collection", F.col("p_partkey")).alias("id"),
        F.concat_ws(" ", F.col("p_type"), F.col("p_size").cast("string")).alias("title"),
        F.lower(F.concat_ws("-", F.col("p_type"), F.col("p_size").cast("string"))).alias("handle"),
        F.struct(F.lit(1).cast("bigint").alias("count"), F.lit("EXACT").alias("precision")).alias("productsCount"),
        F.when((F.col("p_size") % 2) == 0, rule_set).alias("ruleSet"),
    )


def brand_number(c: Column) -> Column:
    return F.regexp_extract(c, r"#(\d+)", 1).try_cast("bigint")


def membership_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 landing: one collection per brand; pages of <= ``PAGE_SIZE`` product ids as JSON text."""
    p = load(spark, sf_dir, "part").select(brand_number(F.col("p_brand")).alias("brand"), "p_partkey")
    pages = p.groupBy("brand", F.floor(F.col("p_partkey") / PAGE_SIZE).alias("__page")).agg(
        F.collect_list(F.struct(to_gid("Product", F.col("p_partkey")).alias("id"))).alias("nodes"))
    doc = F.struct(F.struct(
        to_gid("Collection", F.col("brand")).alias("id"),
        F.struct(F.struct(F.lit(False).alias("hasNextPage")).alias("pageInfo"), F.col("nodes").alias("nodes")).alias("products"),
    ).alias("collection"))
    return pages.select(F.to_json(doc).alias("value"))


def shop_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 landing: one ``{data:{shop:..}}`` document per supplier; negative balances land no shop."""
    s = load(spark, sf_dir, "supplier")
    bal = F.col("s_acctbal")
    key = F.col("s_suppkey")
    currency = F.when(F.col("s_nationkey") <= 8, F.lit("USD")).when(F.col("s_nationkey") <= 16, F.lit("EUR")) \
        .otherwise(F.lit("GBP"))
    features = F.struct(
        (bal > 1000).alias("avalaraAvatax"), F.lit("STOREFRONT").alias("branding"),
        F.struct((bal > 3000).alias("eligibleForBundles"),
                 F.when(bal <= 3000, F.lit("LOW_BALANCE")).alias("ineligibilityReason"),
                 (bal > 6000).alias("sellsBundles")).alias("bundles"),
        F.lit(True).alias("captcha"),
        F.struct(F.when(bal > 2500, F.struct((bal > 4000).alias("expandOperation"), (bal > 5000).alias("mergeOperation"),
                                             (bal > 7000).alias("updateOperation"))).alias("eligibleOperations")).alias("cartTransform"),
        (bal > 2000).alias("giftCards"),
        (bal > 9000).alias("unifiedMarkets"),
    )
    settings = F.array(
        F.struct(F.struct(F.lit("USD").alias("currencyCode"), F.lit("US Dollar").alias("currencyName"),
                          F.lit(True).alias("enabled")).alias("node")),
        F.struct(F.struct(currency.alias("currencyCode"), F.concat(currency, F.lit(" money")).alias("currencyName"),
                          (bal > 500).alias("enabled")).alias("node")),
    )
    shop = F.struct(
        to_gid("Shop", key).alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("shop"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("shop-"), key.cast("string"), F.lit(".shops.example")).alias("myshopifyDomain"),
        currency.alias("currencyCode"),
        F.struct(F.concat(F.lit("shop"), key.cast("string"), F.lit(".example.com")).alias("host")).alias("primaryDomain"),
        F.struct((bal < 500).alias("partnerDevelopment"), (bal > 5000).alias("shopifyPlus")).alias("plan"),
        F.when(bal > 1000, F.array(F.lit("USD"), currency)).otherwise(F.array().cast("array<string>")).alias("enabledPresentmentCurrencies"),
        F.when(bal > 100, F.struct(F.concat(F.lit("${amount} "), currency).alias("moneyFormat"),
                                   F.lit("${amount}").alias("moneyInEmailsFormat"))).alias("currencyFormats"),
        features.alias("features"),
        F.struct(F.when(bal > 0, settings).otherwise(F.slice(settings, 1, 0)).alias("edges")).alias("currencySettings"),
    )
    return s.select(F.to_json(F.struct(F.struct(F.when(bal >= 0, shop).alias("shop")).alias("data"))).alias("value"))


# ---------------------------------------------------------------------------------------------
# snapshots (events)
# ---------------------------------------------------------------------------------------------

def snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 landing: one JSON line per event ``{id, updatedAt, createdAt}`` (the user as the order gid).

    'error' events land with an empty id (dropped by the required-field filter) and every 'click' line is
    followed by a blank line (skipped by the reader).
    """
    e = load(spark, sf_dir, "events")
    gid = F.when(F.col("event_type") == "error", F.lit("")).otherwise(to_gid("Order", F.col("user_id")))
    doc = F.to_json(F.struct(gid.alias("id"), format_instant(F.col("ts")).alias("updatedAt"),
                             format_instant(F.date_trunc("day", F.col("ts"))).alias("createdAt")))
    lines = F.when(F.col("event_type") == "click", F.array(doc, F.lit(""))).otherwise(F.array(doc))
    return e.select(F.explode(lines).alias("value"))


def event_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows straight from events: ``(gid, updated_at, event_id)`` with gid = user id."""
    e = load(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("gid"), F.col("ts").alias("updated_at"), "event_id")
