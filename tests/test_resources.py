"""Hand-written nested documents through the resource pipelines (expected rows derived by reading the
source transforms)."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators.nested import truncation_report
from tidemark.plans import resources as R
from tidemark.sources import raw_schema as RS
from tidemark.sources.scans import parse_documents, shop_identity, shop_scan
from tidemark.functions.ids import gid_to_long


def sha(v):
    return hashlib.sha256(v.encode()).hexdigest()


ORDER_B1 = {
    "id": "gid://x/Order/100?k=1", "updatedAt": "2024-01-02T00:00:00Z", "email": "a@b.c", "note": None,
    "totalPriceSet": {"shopMoney": {"amount": "12.50", "currencyCode": "USD"}, "presentmentMoney": None},
    "lineItems": {"edges": [
        {"node": {"id": "gid://x/LineItem/1", "taxLines": [{"title": "VAT", "rate": 0.2}, {"title": "City", "rate": 0.01}],
                  "customAttributes": [{"key": "gift", "value": "yes"}], "discountAllocations": []}},
        {"node": {"id": "gid://x/LineItem/2", "taxLines": [], "customAttributes": [], "discountAllocations": []}}],
        "pageInfo": {"hasNextPage": True}},
    "discountApplications": {"edges": [
        {"node": {"value": {"percentage": 10.0}}},
        {"node": {"value": {"amount": "5.50", "currencyCode": "USD"}}},
        {"node": {"value": {"amount": ""}}},
        {"node": {"value": None}}]},
    "refunds": [{"id": "gid://x/Refund/9", "note": "n",
                 "refundLineItems": {"edges": [{"node": {"id": "gid://x/RLI/4", "lineItem": {"id": "gid://x/LineItem/1"}}}]},
                 "orderAdjustments": {"nodes": [{"id": "gid://x/OA/5", "reason": "X"}]}}],
    "taxLines": [{"title": "VAT", "rate": 0.2}],
    "shippingLines": {"edges": [{"node": {"id": "gid://x/SL/3", "taxLines": [{"title": "VAT", "rate": 0.2}]}}]},
}


@pytest.fixture()
def order_tables(docs):
    nodes = parse_documents(docs(ORDER_B1), RS.ORDER_NODE)
    return R.order_tables(nodes, 7), nodes


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_order_root(order_tables):
    t, _ = order_tables
    o = t["order"].first()
    assert (o.shop_id, o.id) == (7, 100)
    assert o.email == sha("a@b.c")
    assert o.note is None
    assert o.total_price_set__shop_money__amount == 12.5
    assert o.total_price_set__presentment_money__amount is None
    assert str(o.updated_at) == "2024-01-02 00:00:00"


def test_order_children(order_tables):
    t, _ = order_tables
    assert rows(t["order__line_items"], "shop_id", "id", "order_id") == [(7, 1, 100), (7, 2, 100)]
    assert rows(t["order__line_items__tax_lines"], "shop_id", "line_item_id", "index", "title") == \
        [(7, 1, 0, "VAT"), (7, 1, 1, "City")]
    assert rows(t["order__line_items__custom_attributes"], "shop_id", "line_item_id", "index", "key", "value") == \
        [(7, 1, 0, "gift", "yes")]
    assert t["order__line_items__discount_allocations"].count() == 0
    assert rows(t["order__refunds"], "shop_id", "id", "order_id", "note") == [(7, 9, 100, sha("n"))]
    assert rows(t["order__refunds__refund_line_items"], "shop_id", "id", "refund_id", "line_item__id") == [(7, 4, 9, 1)]
    assert rows(t["order__refunds__order_adjustments"], "shop_id", "id", "refund_id") == [(7, 5, 9)]
    assert rows(t["order__tax_lines"], "shop_id", "order_id", "index") == [(7, 100, 0)]
    assert rows(t["order__shipping_lines"], "shop_id", "id", "order_id") == [(7, 3, 100)]
    assert rows(t["order__shipping_lines__tax_lines"], "shop_id", "shipping_line_id", "index") == [(7, 3, 0)]


def test_discount_values(order_tables):
    t, _ = order_tables
    got = rows(t["order__discount_applications"], "shop_id", "order_id", "index", "value_type",
               "value_percentage", "value_amount", "value_currency_code")
    assert got == [
        (7, 100, 0, "percentage", 10.0, None, None),
        (7, 100, 1, "fixed_amount", None, 5.5, "USD"),
        (7, 100, 2, "fixed_amount", None, None, None),
        (7, 100, 3, None, None, None, None),
    ]


def test_truncation_report(order_tables):
    _, nodes = order_tables
    rep = truncation_report(nodes.select(gid_to_long("id").alias("oid"), "lineItems"), "oid", ["lineItems"])
    assert [tuple(r) for r in rep.collect()] == [(100, "lineItems", 2)]


def test_customer_b2(docs):
    c = {"id": "gid://x/Customer/5", "firstName": "Ann", "tags": ["vip", "eu"], "defaultEmailAddress": None,
         "amountSpent": {"amount": "3.00", "currencyCode": "EUR"}}
    t = R.customer_tables(R.normalize_customers(parse_documents(docs(c), RS.CUSTOMER_NODE), 7))
    row = t["customer"].first()
    assert (row.id, row.email, row.email_marketing_consent_state, row.total_spent, row.total_spent_currency) == \
        (5, None, None, 3.0, "EUR")
    assert row.first_name == sha("Ann")
    assert rows(t["customer__tags"], "customer_id", "index", "value") == [(5, 0, "vip"), (5, 1, "eu")]


def test_product_b3(docs):
    p = {"id": "gid://x/Product/1", "tags": ["a"],
         "images": {"pageInfo": {"hasNextPage": True}, "nodes": [{"id": "gid://x/ProductImage/11"}]},
         "options": [{"id": "gid://x/ProductOption/21", "name": "Color",
                      "optionValues": [{"name": "Red"}, {"name": "Blue"}]}],
         "variants": {"nodes": [
             {"id": "gid://x/ProductVariant/31", "selectedOptions": [{"name": "Color", "value": "Red"}, {"name": "Size", "value": "S"}]},
             {"id": "gid://x/ProductVariant/32", "selectedOptions": [{"name": "Color", "value": "Blue"}, {"name": "Size", "value": "M"}]}]}}
    nodes = parse_documents(docs(p), RS.PRODUCT_NODE)
    t = R.product_tables(R.normalize_products(nodes, 7))
    assert rows(t["product__images"], "product_id", "id") == [(1, 11)]
    assert rows(t["product__options__option_values"], "product_option_id", "index", "name") == \
        [(21, 0, "Red"), (21, 1, "Blue")]
    assert rows(t["product__variants__selected_options"], "variant_id", "index", "value") == \
        [(31, 0, "Red"), (31, 1, "S"), (32, 0, "Blue"), (32, 1, "M")]
    rep = truncation_report(nodes.select(gid_to_long("id").alias("pid"), "images", "variants"), "pid",
                            ["images", "variants"])
    assert [tuple(r) for r in rep.collect()] == [(1, "images", 1)]


def test_collections_b4(docs):
    c1 = {"id": "gid://x/Collection/1", "ruleSet": None}
    c2 = {"id": "gid://x/Collection/2", "ruleSet": {"appliedDisjunctively": True, "rules": [
        {"column": "TAG", "relation": "EQUALS", "condition": "x"}, {"column": "TYPE", "relation": "EQUALS", "condition": "y"}]}}
    c3 = {"id": "gid://x/Collection/3", "ruleSet": {}}
    t = R.collection_tables(R.normalize_collections(parse_documents(docs(c1, c2, c3), RS.COLLECTION_NODE), 7))
    assert rows(t["collection"], "id", "collection_type", "rule_set_applied_disjunctively") == \
        [(1, "custom", None), (2, "smart", True), (3, "custom", None)]
    assert rows(t["collection__rules"], "collection_id", "index", "column") == [(2, 0, "TAG"), (2, 1, "TYPE")]


def test_shop_profile(docs):
    shop = {"data": {"shop": {"id": "gid://x/Shop/42", "name": "S", "plan": {"partnerDevelopment": True, "shopifyPlus": False},
                              "enabledPresentmentCurrencies": ["USD", "EUR"],
                              "currencySettings": {"edges": [{"node": {"currencyCode": "USD", "enabled": True}}]},
                              "features": {"giftCards": True, "bundles": {"eligibleForBundles": False}}}}}
    empty = {"data": {"shop": None}}
    nodes = shop_scan(docs(shop, empty))
    assert shop_identity(nodes) == 42
    row = R.shop_table(nodes)["shop"].first()
    assert (row.id, row.plan_name, row.has_gift_cards_feature, row.bundles_eligible) == (42, "partner_development", True, False)
    assert row.enabled_presentment_currencies == '["USD","EUR"]'
    assert '"currency_code":"USD"' in row.currency_settings
    assert row.source == "shopify_graphql"


def test_document_normalisation_matches_tables(docs):
    """The document-level normaliser gives the same child values as the explode-first tables."""
    nodes = parse_documents(docs(ORDER_B1), RS.ORDER_NODE)
    norm = R.normalize_orders(nodes, 7)
    d = norm.select(F.explode("discountApplications").alias("d")).select("d.index", "d.valueType", "d.valueAmount")
    assert sorted(tuple(r) for r in d.collect()) == [(0, "percentage", None), (1, "fixed_amount", 5.5),
                                                       (2, "fixed_amount", None), (3, None, None)]
    r = norm.select(F.explode("refunds").alias("r")).select("r.id", "r.note", F.col("r.refundLineItems")[0]["id"])
    assert [tuple(x) for x in r.collect()] == [(9, sha("n"), 4)]
    assert norm.select("lineItems").first()[0][0]["id"] == 1


def test_null_connections_and_lists(docs):
    """NULL connections / NULL lists behave as empty lists (no child rows, no error)."""
    o = {"id": "gid://x/Order/5", "lineItems": None, "refunds": None,
         "discountApplications": {"edges": None}, "shippingLines": {"edges": []}, "taxLines": None,
         "customer": None, "email": "Zoë@exämple.com"}
    t = R.order_tables(parse_documents(docs(o), RS.ORDER_NODE), 1)
    assert t["order"].count() == 1
    assert t["order"].first().email == sha("Zoë@exämple.com")
    assert t["order"].first().customer__id is None
    for name, df in t.items():
        if name != "order":
            assert df.count() == 0, name


def test_strict_pii_paths_reach_child_tables(docs):
    from tidemark.operators.privacy import ORDER_PII_PATHS, STRICT_EXTRA_ORDER_PATHS

    o = dict(ORDER_B1, shippingLines={"edges": [{"node": {"id": "gid://x/SL/3", "phone": "+1 555"}}]})
    nodes = parse_documents(docs(o), RS.ORDER_NODE)
    strict = R.order_tables(nodes, 7, pii_paths=ORDER_PII_PATHS + STRICT_EXTRA_ORDER_PATHS)
    default = R.order_tables(nodes, 7)
    assert strict["order__shipping_lines"].first().phone == sha("+1 555")
    assert default["order__shipping_lines"].first().phone == "+1 555"
