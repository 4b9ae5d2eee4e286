"""Plans and stored bytes that may not grow faster than the input: one parse a document, no wide shuffles, no deltas."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as CH
from tidemark.operators.nested import explode_list
from tidemark.plans import feeds, jobs, queries
from tidemark.sources import raw_schema as RS
from tidemark.sources import scans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def sf(spark, tmp_path):
    """Three orders, one without lines and one key twice, as the driver lays its tables out."""
    day = "timestamp_ntz '1997-07-01 00:00:00'"
    orders = spark.createDataFrame([(1, 5, "O", 10.5, "1-URGENT"), (2, 6, "P", 2.0, "2-HIGH"), (2, 6, "P", 3.0, "2-HIGH")],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    orders.withColumn("o_orderdate", F.expr(day)).write.parquet(str(tmp_path / "orders.parquet"))
    lines = spark.createDataFrame([(1, 7, 8, n, 2.0, 3.5, 0.06, 0.1, "R", "F") for n in (1, 2)],
                                  "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                  "l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    lines.withColumn("l_shipdate", F.expr(day)).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_a_page_is_parsed_and_shuffled_once(spark, sf):
    df = queries.page_scan(spark, sf)
    assert sum(line.count("from_json(") for line in plan(df).split("\n") if "Filter" in line) == 0
    assert plan(df).count("Exchange hashpartitioning") == 2  # orders and lines, flat
    assert sorted((r["id"], r["n_lines"]) for r in df.collect()) == [(1, 2), (2, 0), (2, 0)]


def test_a_payload_is_parsed_and_shuffled_once(spark, sf):
    df = queries.payload_scan(spark, sf)
    assert not [line for line in plan(df).split("\n") if "Filter" in line and ("from_json(" in line or "StructsToJson" in line)]
    assert plan(df).count("Exchange hashpartitioning") == 2
    assert sorted((r["id"], r["n_refunds"]) for r in df.collect()) == [(1, 2), (2, 0), (2, 0)]


def test_derived_lists_are_built_once_for_an_explode(spark, sf):
    nodes = feeds.order_nodes(spark, sf).select("id", F.col("lineItems.edges").alias("edges"))
    rows = explode_list(nodes, "edges", "id")
    assert not [line for line in plan(rows).split("\n") if line.strip(" :+-").startswith("Filter") and "transform(" in line]
    assert not [line for line in plan(queries.gid_normalize(spark, sf)).split("\n") if line.strip(" :+-").startswith("Filter") and "transform(" in line]
    assert sorted(r["__pos"] for r in rows.collect()) == [0, 1]


@pytest.mark.parametrize("query", ["order_daily_summary", "inject_shop_id", "explode_shipping_lines"])
def test_shared_orders_are_stored_flat(spark, sf, query, monkeypatch):
    stored = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, *parts: stored.append(f"{sf}/shared_{query}") or stored[-1])
    getattr(queries, query)(spark, sf).collect()
    assert set(spark.read.parquet(stored[0]).columns) == {*spark.read.parquet(f"{sf}/orders.parquet").columns, "lines"}


def test_bits_keep_the_rows_numbered(spark):
    df = spark.range(100_000).withColumn("n", F.col("id") + F.lit(1 << 33))
    kept = CH.rows_in_bits(df, "n", CH.row_bits(df.where("id % 3 = 0 or id = 32767").select("n"), "n"))
    assert sorted(r["id"] for r in kept.collect()) == [i for i in range(100_000) if i % 3 == 0 or i == 32767]


def test_only_nodes_that_share_their_id_are_compared(spark):
    df = spark.createDataFrame([("gid://x/Order/1", "2024-01-01T00:00:00Z"), ("gid://x/Order/1", "2024-01-02T00:00:00Z"), ("gid://x/Order/2", None), ("none", None), ("none", None)],
                               "id string, updatedAt string")
    once = df.where("id != 'gid://x/Order/1'")
    assert jobs.latest_stored(once) is once
    assert sorted(map(str, jobs.latest_stored(df).collect())) == sorted(map(str, jobs.latest_nodes(df).collect()))


def test_first_merge_of_stored_rows_writes_no_delta(spark, store, monkeypatch):
    rows = spark.createDataFrame([(i, i % 7, []) for i in range(100)] + [(None, 1, ["a"])], "id long, v long, __failed array<string>")
    monkeypatch.setattr(type(store), "_merge", lambda *a, **k: pytest.fail("a delta was written"))
    r = store.merge("t", rows, ["id"], unique=True, stored=True)
    assert (r.rows_in, r.inserted, r.updated, r.rejected) == (101, 100, 0, 1) and store.read("t").columns == ["id", "v"]
    assert len(store.commit_info("t")["buckets"]) == 4 and store.read("_rejects").count() == 1 and store.read("_cast_failures").first()["n_rows"] == 1


def test_distinct_keys_are_counted_in_bounded_parts(spark, store, monkeypatch):
    monkeypatch.setattr(queries, "KEYS_A_TASK", 10)
    store.merge("collection", spark.createDataFrame([(1, i, "ab") for i in range(45)], "shop_id long, id long, title string"), ["shop_id", "id"])
    sums = queries._checksums(store, ["collection"], {"collection": F.length("title")})
    assert tuple(sums.first()) == ("collection", 45, 45, 990, 90) and "hashpartitioning(shop_id" in plan(sums) and ", 6), REPARTITION_BY_NUM" in plan(sums)


def test_scans_keep_what_fails_and_what_is_skipped(docs):
    node = {"id": "gid://x/Customer/1"}
    pages = docs({"data": {"customers": {"edges": [{"node": node}]}}}, {"data": {"customers": {"edges": []}}}, {"data": {"customers": None}}, " ")
    assert scans.page_scan(pages, "customers", RS.CUSTOMER_NODE).count() == 1
    assert scans.payload_scan(docs({"data": {"nodes": []}}, {"data": None}, {}), RS.ORDER_NODE).count() == 0


def test_likely_keys_keep_all_wanted_rows(spark, monkeypatch):
    rows = spark.range(20_000).select(F.concat(F.lit("gid://x/Order/"), F.col("id") % 10_000).alias("id"), F.col("id").alias("n"))
    keys = rows.where("n % 10 = 3 and n < 10000").select(F.col("id").alias("gid"))
    got = CH.likely_in(rows.unionByName(rows.limit(1).select(F.lit(None).cast("string").alias("id"), "n")), "id", keys, 1000)
    assert got.columns == ["id", "n"] and got.join(keys, got.id == keys.gid).count() == 2000
    assert 2000 <= got.count() < 4500  # an eighth of the bits at most are set
    monkeypatch.setattr(CH, "MOST_KEYS", 999)
    assert CH.likely_in(rows, "id", keys, 1000) is rows


def test_payloads_of_unchanged_orders_are_not_staged(spark, store, sf):
    from tidemark.operators import windows as W

    lines = feeds.order_snapshot_lines(spark, sf).where("value like '%Order/1?%'")
    window = W.Window(W.utc("1997-01-01"), W.utc("1997-12-31"))
    nodes = feeds.order_nodes(spark, sf)
    report = jobs.load_orders_bulk(store, lines, nodes.unionByName(nodes), window)
    assert store.read("_staging__orders_payloads").count() == 2 and report.to_hydrate == 1
    assert (store.read("order").count(), store.read("order__line_items").count()) == (1, 2)
    with pytest.raises(Exception, match="payload missing for id gid://shop/Order/2"):
        jobs.load_orders_bulk(store, feeds.order_snapshot_lines(spark, sf), nodes.where("id like '%Order/1?%'"), window)


def test_staged_rows_are_written_without_dictionaries(spark, store):
    import glob

    import pyarrow.parquet as pq

    jobs._stage(store, "texts", spark.range(1000).selectExpr("'same' as t").coalesce(1), None)
    part = pq.ParquetFile(glob.glob(f"{store.root}/_staging__texts/v=*/*.parquet")[0]).metadata.row_group(0).column(0)
    assert not part.has_dictionary_page and store.read("_staging__texts").where("t = 'same'").count() == 1000


def test_first_merges_read_key_columns_and_then_the_rows_once(spark, store, monkeypatch):
    asked, rows = [], spark.createDataFrame([(1, i) for i in range(64)], "shop_id long, id long")
    ends = type(store).key_ends
    monkeypatch.setattr(type(store), "key_ends", lambda self, keyed: asked.append(sorted(keyed)) or ends(self, keyed))
    monkeypatch.setattr(type(store), "_accepted", lambda *a: pytest.fail("the rows were read again"))
    tables = {"product": rows, "product__images": rows.withColumn("product_id", F.col("id")),
              "product__tags": rows.select("shop_id", F.col("id").alias("product_id"), F.lit(0).cast("long").alias("index")).where("product_id < 32")}
    got = jobs.merge_tables(store, tables)
    assert asked == [["product", "product__images"]]
    assert {k: r.inserted for k, r in got.items()} == {"product": 64, "product__images": 64, "product__tags": 32}
    assert [len(store.commit_info(t)["buckets"]) for t in tables] == [4, 4, 2]
