"""Scan and projection semantics on small hand-written documents."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.normalize import typed_projection
from tidemark.sources import raw_schema as RS
from tidemark.sources.scans import bridge_scan, page_scan, payload_scan

PAGE = {"data": {"customers": {"pageInfo": {"hasNextPage": False},
                               "edges": [{"node": {"id": "gid://x/Customer/1"}}, {"node": {"id": "gid://x/Customer/2"}}]}}}
NO_DATA = {"errors": [{"message": "throttled"}]}


def test_page_scan_rows_and_missing_data(docs):
    ok = page_scan(docs(PAGE), "customers", RS.CUSTOMER_NODE)
    assert sorted(r.id for r in ok.collect()) == ["gid://x/Customer/1", "gid://x/Customer/2"]
    skipped = page_scan(docs(PAGE, NO_DATA), "customers", RS.CUSTOMER_NODE, on_missing="skip")
    assert skipped.count() == 2
    with pytest.raises(Exception, match="page without data"):
        page_scan(docs(PAGE, NO_DATA), "customers", RS.CUSTOMER_NODE).collect()


def test_payload_scan_null_node_fails(docs):
    good = payload_scan(docs({"data": {"nodes": [{"id": "gid://x/Order/1"}]}}), RS.ORDER_NODE)
    assert good.first().id == "gid://x/Order/1"
    with pytest.raises(Exception, match="null node"):
        payload_scan(docs({"data": {"nodes": [{"id": "gid://x/Order/1"}, None]}}), RS.ORDER_NODE).collect()


def test_bridge_scan_skips_collections_without_id(docs):
    pages = docs({"collection": {"id": "gid://x/Collection/3", "products": {"nodes": [{"id": "gid://x/Product/1"},
                                                                                     {"id": "gid://x/Product/2"}]}}},
                 {"collection": {"id": None, "products": {"nodes": [{"id": "gid://x/Product/9"}]}}},
                 {"collection": None})
    rows = sorted((r.collectionId, r.productId) for r in bridge_scan(pages).collect())
    assert rows == [(3, 1), (3, 2)]


def test_typed_projection_casts_and_not_null(spark):
    df = spark.createDataFrame([("1", "2.50", "2024-01-02T03:04:05Z", "x"), ("2", "", "bad", None)],
                               "id string, price string, at string, extra string")
    spec = [("id", "bigint"), ("price", "double"), ("at", "timestamp"), ("missing", "string")]
    out = typed_projection(df, spec, not_null=["id"])
    assert out.columns == ["id", "price", "at", "missing"]
    rows = sorted(out.collect(), key=lambda r: r.id)
    assert (rows[0].price, str(rows[0].at)) == (2.5, "2024-01-02 03:04:05")
    assert rows[1].price is None and rows[1].at is None and rows[1].missing is None
    bad = spark.createDataFrame([(None,)], "id string")
    with pytest.raises(Exception, match="NOT NULL"):
        typed_projection(bad, [("id", "bigint")], not_null=["id"]).collect()
