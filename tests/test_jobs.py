"""End-to-end: landed JSON files -> CLI job -> tables in the store; re-runs are idempotent."""

import json

from pyspark.sql import functions as F

from tidemark.plans import cli, jobs
from tidemark.sources.landing import read_landed
from tidemark.sources.store import TableStore

SF = "/root/testdata/sf0.001"
from test_resources import ORDER_B1


def _land(root, name, docs):
    d = root / name
    d.mkdir(parents=True)
    (d / "part-0.json").write_text("\n".join(json.dumps(x) for x in docs) + "\n")


def _landing(tmp_path):
    root = tmp_path / "landing"
    order2 = dict(ORDER_B1, id="gid://x/Order/101", refunds=[], lineItems={"edges": []})
    _land(root, "orders", [{"data": {"orders": {"pageInfo": {"hasNextPage": False},
                                                 "edges": [{"node": ORDER_B1}, {"node": order2}]}}}])
    _land(root, "customers", [{"data": {"customers": {"edges": [{"node": {"id": "gid://x/Customer/5", "tags": ["a"]}}]}}}])
    _land(root, "products", [{"data": {"products": {"edges": [{"node": {"id": "gid://x/Product/1", "tags": ["t"],
                                                                          "variants": {"nodes": [{"id": "gid://x/ProductVariant/2"}]}}}]}}}])
    _land(root, "collections", [{"data": {"collections": {"edges": [{"node": {"id": "gid://x/Collection/3", "ruleSet": None}}]}}}])
    _land(root, "collection_products", [{"collection": {"id": "gid://x/Collection/3",
                                                        "products": {"nodes": [{"id": "gid://x/Product/1"}]}}}])
    _land(root, "shop", [{"data": {"shop": {"id": "gid://x/Shop/77", "name": "S"}}}])
    _land(root, "order_snapshots", [{"id": "gid://x/Order/100?k=1", "updatedAt": "2024-01-02T00:00:00Z"}])
    _land(root, "order_payloads", [{"data": {"nodes": [ORDER_B1]}}])
    return root


def test_cli_full_load(spark, tmp_path):
    landing = _landing(tmp_path)
    cli.main(["--landing", str(landing), "--store", str(tmp_path / "tables"), "--dataset", "d", "--mode", "all",
              "--allow-unkeyed-hash", "--buckets", "4"])
    store = TableStore(spark, str(tmp_path / "tables" / "d"))
    assert store.read("order").count() == 2
    assert store.read("order__line_items").count() == 2
    assert {r.shop_id for r in store.read("order").collect()} == {77}
    assert store.read("collection_product").first().product_id == 1
    assert store.read("shop").first().id == 77
    loads = store.read("_loads")
    assert loads.where(F.col("table_name") == "order").first().inserted == 2


def test_run_is_idempotent(spark, tmp_path):
    landing = _landing(tmp_path)
    store = TableStore(spark, str(tmp_path / "t2"), buckets=4)
    landed = read_landed(spark, str(landing), ["orders", "customers"])
    r1 = jobs.run(store, landed, ["orders", "customers"], shop_id=7, batch_id="b1")
    snap1 = sorted(tuple(r) for r in store.read("order__line_items__tax_lines").collect())
    again = jobs.run(store, landed, ["orders", "customers"], shop_id=7, batch_id="b1")
    assert all(getattr(v, "skipped", True) for v in again.results.values())
    r3 = jobs.run(store, landed, ["orders", "customers"], shop_id=7, batch_id="b2")
    assert r3.results["order"].inserted == 0 and r3.results["order"].updated == 2
    snap3 = sorted(tuple(r) for r in store.read("order__line_items__tax_lines").collect())
    assert snap1 == snap3
    assert r1.results["order"].inserted == 2


def test_bulk_orders_path(spark, tmp_path):
    from datetime import datetime, timezone

    from tidemark.operators.windows import Window
    from tidemark.sources.landing import read_resource

    landing = _landing(tmp_path)
    store = TableStore(spark, str(tmp_path / "t3"), buckets=4)
    w = Window(datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 3, tzinfo=timezone.utc))
    snaps = read_resource(spark, str(landing), "order_snapshots")
    payloads = read_resource(spark, str(landing), "order_payloads")
    rep = jobs.load_orders_bulk(store, snaps, payloads, w, shop_id=7)
    assert (rep.discovered, rep.to_hydrate) == (1, 1)
    assert store.read("order__refunds").first().id == 9
    # second run: the manifest already holds the snapshot -> nothing to hydrate
    rep2 = jobs.load_orders_bulk(store, snaps, payloads, w, shop_id=7)
    assert rep2.to_hydrate == 0


def test_orphan_modes(spark, tmp_path):
    """A re-loaded order that lost a line keeps the stale child by default, drops it with 'delete'."""
    from tidemark.sources.scans import parse_documents
    from tidemark.sources import raw_schema as RS

    first = dict(ORDER_B1)
    second = dict(ORDER_B1, lineItems={"edges": [ORDER_B1["lineItems"]["edges"][0]]})
    for mode, expected in (("keep", [1, 2]), ("delete", [1])):
        store = TableStore(spark, str(tmp_path / mode), buckets=4)
        for i, doc in enumerate((first, second)):
            nodes = parse_documents(spark.createDataFrame([(json.dumps(doc),)], "value string"), RS.ORDER_NODE)
            jobs.run(store, {"orders": nodes}, ["orders"], shop_id=7, batch_id=f"{mode}{i}", orphans=mode)
        assert sorted(r.id for r in store.read("order__line_items").collect()) == expected
        # grandchildren of the surviving line are untouched
        assert store.read("order__line_items__tax_lines").count() == 2


def test_cli_bulk_orders_window(spark, tmp_path):
    """--bulk-orders with an explicit window: orders come from snapshots + by-id payloads only."""
    landing = _landing(tmp_path)
    cli.main(["--landing", str(landing), "--store", str(tmp_path / "tables"), "--dataset", "b", "--mode", "orders",
              "--bulk-orders", "--start", "2024-01-01T00:00:00Z", "--end", "2024-01-05T00:00:00Z",
              "--shop-id", "7", "--allow-unkeyed-hash", "--buckets", "4"])
    store = TableStore(spark, str(tmp_path / "tables" / "b"))
    assert [r.id for r in store.read("order").collect()] == [100]
    assert store.read(jobs.manifest_table(7)).count() == 1


def test_windows_and_cursors(spark, tmp_path):
    """Loads through stored cursors: the window filters each paged resource, the cursor never moves back."""
    from datetime import datetime, timezone

    from tidemark.plans import feeds, jobs

    store = TableStore(spark, str(tmp_path / "w"), buckets=4)
    landed = {"customers": feeds.customer_nodes(spark, SF)}
    every = spark.read.parquet(f"{SF}/customer.parquet").count()
    now = datetime(2024, 1, 10, tzinfo=timezone.utc)
    first = jobs.load_windows(store, ["customers", "shop"], 1, now)
    assert list(first) == ["customers"] and first["customers"].start == datetime(2024, 1, 3, tzinfo=timezone.utc)
    jobs.run(store, landed, ["customers"], windows=first)
    some = store.read("customer").count()
    assert 0 < some < every
    at = jobs.cursor(store, "customers", 1)
    assert at is not None and at <= now and jobs.cursor(store, "customers", 2) is None
    second = jobs.load_windows(store, ["customers"], 1, datetime(2024, 2, 1, tzinfo=timezone.utc))
    assert (at - second["customers"].start).days == 1
    jobs.run(store, landed, ["customers"], windows=second)
    later = jobs.cursor(store, "customers", 1)
    assert later > at and store.read("customer").count() > some
    jobs.run(store, landed, ["customers"], windows=jobs.load_windows(store, ["customers"], 1, now, start="2024-01-01", end="2024-01-05"))
    assert jobs.cursor(store, "customers", 1) == later
