"""Snapshots, change detection, windows, merge and the table store."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as CH
from tidemark.operators import windows as W
from tidemark.operators.merge import upsert
from tidemark.sources.scans import snapshot_scan


def test_snapshot_b5(spark, docs):
    lines = docs('{"id":"a","updatedAt":"2024-01-01T09:00:00Z"}', "", '{"id":"a","updatedAt":"2024-01-01T11:00:00Z"}',
                 '{"id":"b","updatedAt":"2024-01-01T10:00:00Z"}', '{"id":"","updatedAt":"2024-01-01T10:00:00Z"}',
                 '{"updatedAt":"2024-01-01T10:00:00Z"}')
    snaps = snapshot_scan(lines).withColumn("tb", F.lit(0))
    latest = CH.latest_by_key(snaps, "gid", [F.col("updated_at"), -F.col("tb")]).select("gid", "updated_at")
    ordered = [r.gid for r in CH.oldest_changes(latest).collect()]
    assert ordered == ["b", "a"]
    manifest = spark.createDataFrame([("a", datetime(2024, 1, 1, 11, tzinfo=timezone.utc))], "gid string, updated_at timestamp")
    assert [r.gid for r in CH.change_detect(latest, manifest).collect()] == ["b"]


def test_malformed_line_fails(docs):
    with pytest.raises(Exception):
        snapshot_scan(docs('{"id":"a","updatedAt":"x"}', "{not json")).collect()


def test_hydrate_guard(spark):
    changed = spark.createDataFrame([(1,), (2,)], "gid long")
    payloads = spark.createDataFrame([(1, "p")], "gid long, body string")
    with pytest.raises(Exception, match="payload missing"):
        CH.hydrate(changed, payloads).collect()
    assert CH.hydrate_missing(changed, payloads).collect()[0].gid == 2
    assert CH.hydrate(changed, payloads, on_missing="drop").count() == 1


def test_windows_b7():
    now = datetime(2024, 1, 10, 15, tzinfo=timezone.utc)
    assert W.resolve_start("2024-01-05T00:00:00Z", 3, None, now) == datetime(2024, 1, 7, tzinfo=timezone.utc)
    assert W.resolve_start("2024-01-05T00:00:00Z", 0, "2024-01-02T00:00:00Z", now) == datetime(2024, 1, 2, tzinfo=timezone.utc)
    assert W.resolve_start("2024-01-05T00:00:00Z", 0, None, now) == datetime(2024, 1, 5, tzinfo=timezone.utc)
    with pytest.raises(ValueError):
        W.resolve_start(None, 0, None, now)
    assert W.clamp_backfill(-1) == 0 and W.clamp_backfill(120) == 90
    chunks = W.chunk_bounds(datetime(2024, 1, 1), datetime(2024, 1, 10), 7)
    assert [(a.day, b.day) for a, b in chunks] == [(1, 8), (8, 10)]
    assert W.chunk_bounds(datetime(2024, 1, 10), datetime(2024, 1, 1)) == []
    s = W.snapshot_start(datetime(2024, 1, 9, tzinfo=timezone.utc), datetime(2024, 1, 10, tzinfo=timezone.utc), 7)
    assert s == datetime(2024, 1, 3, tzinfo=timezone.utc)


def test_assign_chunks_boundary(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 8)), (2, datetime(2024, 1, 9)), (3, datetime(2024, 1, 10))],
                               "id long, ts timestamp_ntz")
    tagged = W.assign_chunks(df, "ts", datetime(2024, 1, 1), datetime(2024, 1, 10), 7)
    got = sorted((r.id, r.chunk_index) for r in tagged.collect())
    assert got == [(1, 0), (1, 1), (2, 1), (3, 1)]


def test_upsert_b8(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, v string, t long")
    source = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k long, v string, t long")
    once = upsert(target, source, ["k"], prefer=[F.col("t")])
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "d"), (3, "e")]
    twice = upsert(once, source, ["k"], prefer=[F.col("t")])
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_store_merge_touches_only_delta_buckets(spark, store):
    base = spark.range(0, 200).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    r1 = store.merge("t", base, ["k"])
    assert (r1.inserted, r1.updated) == (200, 0)
    before = store.commit_info("t")["buckets"]
    delta = spark.createDataFrame([(5, "new"), (1000, "ins")], "k long, v string")
    r2 = store.merge("t", delta, ["k"])
    assert (r2.rows_in, r2.inserted, r2.updated) == (2, 1, 1)
    after = store.commit_info("t")["buckets"]
    changed = [b for b in after if after[b] != before.get(b)]
    assert 1 <= len(changed) <= 2 < len(after)
    got = {r.k: r.v for r in store.read("t").collect()}
    assert len(got) == 201 and got[5] == "new" and got[1000] == "ins" and got[6] == "old"


def test_store_batch_replay_is_noop(spark, store):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    store.merge("t", df, ["k"], batch_id="b1")
    v = store.version("t")
    again = store.merge("t", spark.createDataFrame([(1, "zzz")], "k long, v string"), ["k"], batch_id="b1")
    assert again.skipped and store.version("t") == v
    assert store.read("t").first().v == "a"


def test_store_replace_and_append(spark, store):
    store.replace("r", spark.createDataFrame([(1,)], "k long"))
    store.replace("r", spark.createDataFrame([(2,), (3,)], "k long"))
    assert sorted(r.k for r in store.read("r").collect()) == [2, 3]
    assert sorted(r.k for r in store.read("r", version=1).collect()) == [1]
    store.append("a", spark.createDataFrame([(1,)], "k long"))
    store.append("a", spark.createDataFrame([(2,)], "k long"))
    assert sorted(r.k for r in store.read("a").collect()) == [1, 2]


def test_dataset_namespaces_and_history(spark, tmp_path):
    from tidemark.sources.store import TableStore

    prod = TableStore.for_dataset(spark, str(tmp_path), "shop_data", buckets=4)
    dev = TableStore.for_dataset(spark, str(tmp_path), "shop_data", dev_mode=True, buckets=4)
    assert prod.root.endswith("/shop_data") and dev.root != prod.root and "shop_data_dev_" in dev.root
    prod.merge("t", spark.createDataFrame([(1, "a")], "k long, v string"), ["k"])
    prod.merge("t", spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"), ["k"])
    assert [h["counts"]["inserted"] for h in prod.history("t")] == [1, 1]
    assert [h["counts"]["updated"] for h in prod.history("t")] == [0, 1]
    assert {r.k: r.v for r in prod.read("t", version=1).collect()} == {1: "a"}
    assert {r.k: r.v for r in prod.read("t").collect()} == {1: "b", 2: "c"}
    assert not dev.exists("t")


# -- the store under failures, races and changing layouts ------------------------------------------


def _keys(store, table):
    return sorted(tuple(r) for r in store.read(table).collect())


def _pairs(spark, rows, names="id long, v string"):
    return spark.createDataFrame(rows, names)


def test_failed_write_can_be_retried(spark, store):
    bad = _pairs(spark, [(1, "a")]).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    for write in (lambda d: store.replace("t", d), lambda d: store.merge("t", d, ["id"])):
        with pytest.raises(Exception, match="broken"):
            write(bad)
        write(_pairs(spark, [(1, "a")]))
    assert _keys(store, "t") == [(1, "a")]


def test_driver_lost_before_commit(spark, store, monkeypatch):
    store.merge("t", _pairs(spark, [(1, "a")]), ["id"], batch_id="b1")
    monkeypatch.setattr(type(store), "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.merge("t", _pairs(spark, [(1, "b"), (2, "b")]), ["id"], batch_id="b2")
    monkeypatch.undo()
    assert _keys(store, "t") == [(1, "a")]
    store.merge("t", _pairs(spark, [(1, "b"), (2, "b")]), ["id"], batch_id="b2")
    assert _keys(store, "t") == [(1, "b"), (2, "b")]
    assert len(store.vacuum("t", retain=1)) == 2 and _keys(store, "t") == [(1, "b"), (2, "b")]


def test_layout_is_the_tables_own(spark, store):
    from tidemark.sources.store import TableStore

    rows = [(i, "a") for i in range(100)]
    store.merge("t", _pairs(spark, rows), ["id"])
    other = TableStore(spark, store.root, buckets=16)
    other.merge("t", _pairs(spark, [(i, "b") for i in range(3)] + [(500, "b")]), ["id"])
    assert _keys(other, "t") == [(i, "b" if i < 3 else "a") for i in range(100)] + [(500, "b")]


def test_recent_ids_touch_few_buckets(spark, tmp_path):
    from tidemark.sources.store import TableStore

    store = TableStore(spark, str(tmp_path / "s"), buckets=32)
    store.merge("t", _pairs(spark, [(i, "a") for i in range(3200)]), ["id"])
    before = set(store.commit_info("t")["paths"])
    store.merge("t", _pairs(spark, [(i, "b") for i in range(3150, 3250)]), ["id"])
    after = set(store.commit_info("t")["paths"])
    assert len(before - after) <= 2 and len(before & after) >= 30
    plan = store.read("t")._jdf.queryExecution().toString()
    assert "Aggregate" not in plan


def test_merge_after_replace_and_append(spark, store):
    store.replace("t", _pairs(spark, [(1, "a"), (2, "a")]))
    store.merge("t", _pairs(spark, [(2, "b"), (3, "b")]), ["id"])
    store.append("t", _pairs(spark, [(4, "c")]))
    r = store.merge("t", _pairs(spark, [(4, "d")]), ["id"])
    assert _keys(store, "t") == [(1, "a"), (2, "b"), (3, "b"), (4, "d")] and (r.inserted, r.updated) == (0, 1)


def test_lost_marker(spark, store):
    for batch in ("a", "b", "a"):
        store.append("t", _pairs(spark, [(1, batch)]), batch_id=batch)
        store.fs.delete(f"{store.root}/t/_batches")
    assert _keys(store, "t") == [(1, "a"), (1, "b")]


def test_two_writers(spark, store):
    from tidemark.sources.store import TableStore

    other, real = TableStore(spark, store.root, buckets=4), store._write
    store.merge("t", _pairs(spark, [(1, "a")]), ["id"])
    raced = []

    def write(df, path, by_bucket):
        real(df, path, by_bucket)
        if not raced:
            raced.append(other.merge("t", _pairs(spark, [(2, "other")]), ["id"]))

    store._write = write
    store.merge("t", _pairs(spark, [(3, "mine")]), ["id"])
    assert _keys(store, "t") == [(1, "a"), (2, "other"), (3, "mine")]


def test_null_keys_are_rejected_and_counted(spark, store):
    r = store.merge("t", _pairs(spark, [(None, "x"), (None, "y"), (1, "a")]), ["id"])
    assert (r.rows_in, r.inserted, r.rejected) == (3, 1, 2) and _keys(store, "t") == [(1, "a")]
    assert sorted(x["row"] for x in store.read("_rejects").collect()) == ['{"v":"x"}', '{"v":"y"}']


def test_older_redelivery_keeps_newer_row(spark, store):
    names = "id long, at int"
    store.merge("t", _pairs(spark, [(1, 5), (2, 5)], names), ["id"], prefer=[F.col("at")], keep_newer=True)
    r = store.merge("t", _pairs(spark, [(1, 4), (2, 6)], names), ["id"], prefer=[F.col("at")], keep_newer=True)
    assert _keys(store, "t") == [(1, 5), (2, 6)] and (r.inserted, r.updated) == (0, 1)


def test_new_columns_stay(spark, store):
    store.merge("t", _pairs(spark, [(i, "a") for i in range(8)]), ["id"])
    store.merge("t", _pairs(spark, [(1, "b", 7)], "id long, v string, extra int"), ["id"])
    store.merge("t", _pairs(spark, [(2, "c")]), ["id"])
    assert {r["id"]: (r["v"], r["extra"]) for r in store.read("t").collect()}[1] == ("b", 7) and store.read("t").count() == 8


def test_nodes_without_id_are_not_merged_together(spark):
    from tidemark.plans.jobs import latest_nodes

    nodes = spark.createDataFrame([("gid://s/Order/1", "2024-01-01T00:00:00Z"), ("bad", "2024-01-01T00:00:00Z"), ("worse", None)], "id string, updatedAt string")
    assert sorted(r["id"] for r in latest_nodes(nodes).collect()) == ["bad", "gid://s/Order/1", "worse"]
