"""Declared schemas, re-landed payloads, layout of real tables, expiry, replay, formats and truncations through the jobs."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_jobs import _land, _landing
from test_resources import ORDER_B1

from tidemark.operators.nested import truncations
from tidemark.operators.normalize import conform
from tidemark.operators.windows import Window
from tidemark.plans import cli, feeds, jobs
from tidemark.plans import resources as R
from tidemark.plans.specs import TABLES
from tidemark.sources import raw_schema as RS
from tidemark.sources.landing import read_resource
from tidemark.sources.scans import parse_documents
from tidemark.sources.store import TableStore
from tidemark.streaming import stream as ST

SF = "/root/testdata/sf0.001"
UTC = timezone.utc


def rows(store, table):
    return sorted(str(r.asDict()) for r in store.read(table).drop("_loaded_at").collect())


@pytest.fixture(scope="module")
def declared(spark):
    return R.declared(spark)


def test_declared_tables(declared):
    assert set(declared) == set(TABLES)
    for name, schema in declared.items():
        required = {f.name for f in schema.fields if not f.nullable}
        assert required == {*TABLES[name].pk, *TABLES[name].fk}, name
    assert declared["order"]["total_price"].dataType.simpleString() == "double"


def test_conform(spark, declared):
    df = spark.createDataFrame([("5", "x", "2024-01-02T00:00:00Z")], "id string, extra string, created_at string")
    out = conform(df, declared["customer"])
    assert out.columns == [*declared["customer"].names, "extra"] and out.first()["id"] == 5 and out.first()["created_at"] is not None
    assert conform(df, declared["customer"], extras=False).columns == declared["customer"].names


def test_full_load_has_the_declared_columns_in_any_format(spark, tmp_path, declared):
    """All 25 tables in Parquet, ORC and the session's catalog: the same rows, the declared columns and no others."""
    landing = _landing(tmp_path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tidemark_test LOCATION '{tmp_path}/catalog'")
    stores = []
    for fmt in ("parquet", "orc"):
        more = ["--catalog", "tidemark_test"] if fmt == "orc" else []
        cli.main(["--landing", str(landing), "--store", str(tmp_path / fmt), "--dataset", "d", "--mode", "all", "--allow-unkeyed-hash",
                  "--buckets", "4", "--format", fmt, "--schema-contract", "freeze", *more])
        stores.append(TableStore(spark, str(tmp_path / fmt / "d")))
    for name, schema in declared.items():
        assert stores[0].read(name).dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields], name
        assert rows(stores[0], name) == rows(stores[1], name), name
    assert stores[1].commit_info("order")["format"] == "orc"
    try:
        assert spark.table("tidemark_test.order__line_items").count() == 2
    finally:
        spark.sql("DROP DATABASE tidemark_test CASCADE")


def test_relanded_payloads_give_one_row_a_key(spark, tmp_path):
    landing, store = _landing(tmp_path), TableStore(spark, str(tmp_path / "t"), buckets=4)
    older = dict(ORDER_B1, updatedAt="2020-01-01T00:00:00Z", totalPrice="1.0")
    (landing / "order_payloads" / "part-1.json").write_text(json.dumps({"data": {"nodes": [older, ORDER_B1]}}) + "\n")
    (landing / "order_payloads" / "part-2.json").write_text(json.dumps({"data": {"nodes": [ORDER_B1]}}) + "\n")
    w = Window(datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 3, tzinfo=UTC))
    read = lambda name: read_resource(spark, str(landing), name)
    once = TableStore(spark, str(tmp_path / "once"), buckets=4)
    _land(tmp_path, "one/order_payloads", [{"data": {"nodes": [ORDER_B1]}}])
    jobs.load_orders_bulk(once, read("order_snapshots"), read_resource(spark, str(tmp_path / "one"), "order_payloads"), w, shop_id=7)
    report = jobs.load_orders_bulk(store, read("order_snapshots"), read("order_payloads"), w, shop_id=7)
    assert len(report.tables) == 12 and (report.discovered, report.to_hydrate, report.deferred) == (1, 1, 0)
    for name in report.tables:
        assert rows(store, name) == rows(once, name), name


def test_the_file_landed_last_decides_between_equal_payloads(spark):
    from tidemark.operators.changes import latest_rows

    df = spark.createDataFrame([("a", 1, 1, 0), ("a", 1, 2, 1), ("a", 0, 9, 2), ("b", 1, 1, 3), (None, 5, 5, 4), (None, 5, 5, 5)], "k string, u int, l int, r long")
    assert sorted(x["r"] for x in latest_rows(df, F.col("k"), [F.col("u"), F.col("l")], "r").collect()) == [1, 3, 4, 5]


def test_recent_ids_replace_few_buckets_of_real_tables(spark, tmp_path):
    """customer and customer__tags lead with the tenant's id; a delta of the newest ids replaces two buckets at most."""
    store = TableStore(spark, str(tmp_path / "s"), buckets=16)
    nodes = feeds.customer_nodes(spark, SF)
    jobs.run(store, {"customers": nodes}, ["customers"])
    before = {t: set(store.commit_info(t)["paths"]) for t in ("customer", "customer__tags")}
    assert all(len(p) >= 15 for p in before.values())
    number = F.regexp_extract("id", r"/(\d+)$", 1).cast("long")
    recent = nodes.where(number >= nodes.select(F.max(number)).first()[0] - 4).withColumn("note", F.lit("changed"))
    jobs.run(store, {"customers": recent}, ["customers"])
    for table, old in before.items():
        now = set(store.commit_info(table)["paths"])
        assert 1 <= len(old - now) <= 2 and len(old & now) >= 13, table
    jobs.run(store, {"customers": recent}, ["customers"], shop_id=2)  # another tenant opens buckets of its own
    assert store.read("customer").where("shop_id = 2").count() == recent.count()


def test_read_for_keys_reads_their_buckets_only(spark, store):
    store.merge("t", spark.createDataFrame([(i, "a") for i in range(400)], "id long, v string"), ["id"])
    some = store.read_for_keys("t", spark.createDataFrame([(3,), (5,), (9_999,)], "id long"))
    assert {3, 5} <= {r["id"] for r in some.collect()} and some.count() == 100 and len(some.inputFiles()) == 1
    assert store.read_for_keys("t", spark.createDataFrame([(9_999,)], "id long")).count() == 0


def test_counts_are_observed(spark, store):
    """One written delta, no counting job of its own: rows, rejected rows and failed casts."""
    df = spark.createDataFrame([(1, 5, ["a", "b"]), (None, 5, []), (2, None, ["a"])], "id long, fk long, __failed array<string>")
    r = store.merge("t", df, ["id"], not_null=["fk"])
    assert (r.rows_in, r.inserted, r.rejected) == (3, 1, 2) and store.read("t").columns == ["id", "fk"]
    assert {(x["reason"]) for x in store.read("_rejects").collect()} == {"NULL primary key", "NULL in fk"}
    assert {(x["column_name"], x["n_rows"]) for x in store.read("_cast_failures").collect()} == {("a", 2), ("b", 1)}


def test_manifest_holds_the_window_only(spark, tmp_path):
    landing, store = _landing(tmp_path), TableStore(spark, str(tmp_path / "t"), buckets=4)
    old = spark.createDataFrame([(f"gid://x/Order/{i}", datetime(2023, 1, 1)) for i in range(50)], "gid string, updated_at timestamp")
    store.merge(jobs.manifest_table(7), old, ["gid"])
    w = Window(datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 3, tzinfo=UTC))
    args = [read_resource(spark, str(landing), n) for n in ("order_snapshots", "order_payloads")]
    assert jobs.load_orders_bulk(store, *args, w, shop_id=7).to_hydrate == 1
    assert store.read(jobs.manifest_table(7)).count() == 1
    assert jobs.load_orders_bulk(store, *args, w, shop_id=7).to_hydrate == 0


def test_stream_manifest_expires(spark, tmp_path):
    store, landing = TableStore(spark, str(tmp_path / "t"), buckets=4), str(tmp_path / "landing")
    day = datetime(2024, 1, 1)
    store.merge("m", spark.createDataFrame([(i, day) for i in range(20)], "gid long, updated_at timestamp_ntz"), ["gid"])
    new = spark.createDataFrame([(i, day + timedelta(days=40), i) for i in range(15, 25)], "gid long, updated_at timestamp_ntz, n long")
    new.write.parquet(landing)
    ST.stream_change_detect(ST.file_stream(spark, landing, new.schema), store, "m", "c", "gid", "updated_at", [F.col("updated_at")], str(tmp_path / "ck"), keep_days=30)
    assert store.read("c").count() == 10 and sorted(r["gid"] for r in store.read("m").collect()) == list(range(15, 25))


def test_replay_equals_one_load(spark, tmp_path):
    """Customers and orders, by value, against one load of the whole window."""
    landed = {"customers": feeds.customer_nodes(spark, SF)}
    now = datetime(2024, 1, 20, tzinfo=UTC)
    two, one = (TableStore(spark, str(tmp_path / n), buckets=4) for n in ("two", "one"))
    jobs.replay_resources(two, landed, list(landed), now)
    start = now - timedelta(days=10)
    jobs.run(one, landed, list(landed), windows={r: Window(start, now) for r in landed})
    for table in ("customer", "customer__tags"):
        assert rows(two, table) == rows(one, table) and rows(one, table)


def test_truncations_at_any_depth(spark, tmp_path):
    page = {"hasNextPage": True}
    refund = {"id": "gid://x/Refund/9", "refundLineItems": {"edges": [{"node": {"id": "gid://x/RefundLineItem/1"}}], "pageInfo": page}}
    doc = {"id": "gid://x/Order/1", "lineItems": {"edges": [{"node": {"id": "gid://x/LineItem/1"}}] * 3, "pageInfo": page}, "refunds": [refund, dict(refund, id="gid://x/Refund/10", refundLineItems=None)]}
    other = {"id": "gid://x/Order/2", "lineItems": {"edges": [], "pageInfo": {"hasNextPage": False}}, "refunds": None}
    nodes = parse_documents(spark.createDataFrame([(json.dumps(d),) for d in (doc, other)], "value string"), RS.ORDER_NODE)
    want = [("lineItems", "gid://x/Order/1", 3), ("refunds.refundLineItems", "gid://x/Refund/9", 1)]
    assert sorted(map(tuple, truncations(nodes).collect())) == want
    store = TableStore(spark, str(tmp_path / "t"), buckets=2)
    jobs.run(store, {"orders": nodes}, ["orders"])
    assert sorted(tuple(r)[1:] for r in store.read("_truncations").collect()) == want
    assert truncations(spark.range(1)) is None


def test_cast_failures_are_listed_without_a_list_for_good_rows(spark):
    from tidemark.plans import resources as R
    from tidemark.sources.store import FAILED_COL

    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "1.5"), ("bad", "x"), (None, " "), ("bad", "2")], "created_at string, price string")
    token = R.TRACK_CASTS.set(True)
    try:
        rows = R.finish(df)
    finally:
        R.TRACK_CASTS.reset(token)
    assert [r[FAILED_COL] for r in rows.collect()] == [[], ["created_at", "price"], [], ["created_at"]]
    column = [c for c in str(rows._jdf.queryExecution().optimizedPlan()).split("\n") if FAILED_COL in c][0]
    assert column.index("CASE WHEN") < column.index("filter(")  # the list is only made behind a condition
