"""Job entry point for ``spark-submit``::

    spark-submit -m tidemark.plans.cli --landing s3a://bucket/landing --store s3a://bucket/tables \\
        --dataset shop_data --mode all [--backfill-days N | --start ISO --end ISO] [--bulk-orders]

``--mode`` picks a preset (orders, customers, products, collections, catalog, shop, all). The PII secret
is read from the environment variable named by ``--secret-env`` (unset -> unkeyed SHA-256 only with
``--allow-unkeyed-hash``). Window arguments drive the bulk-orders snapshot window and the incremental
range filter of paged resources; without any, and without ``--incremental``, these are loaded whole.
"""

from __future__ import annotations

import argparse
import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ..operators.windows import Window, clamp_backfill, incremental_window
from ..session import prepare
from ..sources.landing import read_landed, read_resource
from ..sources.store import TableStore
from . import jobs
from .specs import PRESETS


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--dataset", default="shop_data")
    ap.add_argument("--dev-mode", action="store_true")
    ap.add_argument("--mode", default="all", choices=sorted(PRESETS))
    ap.add_argument("--shop-id", type=int, default=None, help="tenant id; default: read from the shop landing")
    ap.add_argument("--backfill-days", type=int, default=0)
    ap.add_argument("--start", default=None)
    ap.add_argument("--end", default=None)
    ap.add_argument("--cursor", default=None, help="stored high-water mark for incremental runs")
    ap.add_argument("--lookback-days", type=int, default=1)
    ap.add_argument("--incremental", action="store_true",
                    help="paged resources from their stored cursors (a first run: the last 7 days); implied by a window option")
    ap.add_argument("--run-id", default=None, help="name of this run: a retry under the same name writes nothing twice")
    ap.add_argument("--bulk-orders", action="store_true", help="orders via snapshot + by-id payloads")
    ap.add_argument("--max-rows", type=int, default=0)
    ap.add_argument("--buckets", type=int, default=256)
    ap.add_argument("--orphans", default="keep", choices=["keep", "delete"],
                    help="children of re-loaded parents missing from the new load: keep (default) or delete")
    ap.add_argument("--daily-backfill", nargs=2, metavar=("FIRST", "LAST"), default=None, help="load these whole days of the paged resources")
    ap.add_argument("--replay", action="store_true", help="two-phase replay: the days 10 to 2 days ago, then from the cursors left by that")
    ap.add_argument("--format", default="parquet", choices=["parquet", "orc"], help="file format of new tables")
    ap.add_argument("--catalog", default=None, help="also save the loaded tables under this database of the session's catalog")
    ap.add_argument("--schema-contract", default="evolve", choices=["evolve", "freeze"])
    ap.add_argument("--secret-env", default="PII_HASH_SECRET")
    ap.add_argument("--allow-unkeyed-hash", action="store_true")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = parse_args(argv)
    spark = prepare(SparkSession.builder.appName("tidemark-load").getOrCreate())
    secret = os.environ.get(a.secret_env) or None
    if secret is None and not a.allow_unkeyed_hash:
        raise SystemExit(f"{a.secret_env} is not set; pass --allow-unkeyed-hash to hash without a key")
    store = TableStore.for_dataset(spark, a.store, a.dataset, a.dev_mode, buckets=a.buckets, fmt=a.format)
    resources = PRESETS[a.mode]
    shop_id = a.shop_id
    if shop_id is None:
        from ..sources.scans import shop_identity
        shop_id = shop_identity(read_resource(spark, a.landing, "shop"))
    load_id = a.run_id or uuid.uuid4().hex
    now, bulk = datetime.now(timezone.utc), None
    if a.bulk_orders and "orders" in resources:
        w = incremental_window(a.cursor, a.lookback_days, a.end, clamp_backfill(a.backfill_days), a.start,
                               overlap_days=7, now=now) if (a.cursor or a.start or a.backfill_days) else \
            Window(datetime(1970, 1, 1, tzinfo=timezone.utc), now)
        bulk = jobs.load_orders_bulk(store, read_resource(spark, a.landing, "order_snapshots"),
                              read_resource(spark, a.landing, "order_payloads"), w, shop_id=shop_id,
                              secret=secret, max_rows=a.max_rows, batch_id=load_id, orphans=a.orphans)
        if bulk.deferred:
            print(f"{bulk.deferred} changed orders left for the next run (--max-rows)")
        resources = [r for r in resources if r != "orders"]
    windows = None
    if a.incremental or a.start or a.end or a.cursor or a.backfill_days:
        days = clamp_backfill(a.backfill_days)
        if a.cursor:
            w = incremental_window(a.cursor, a.lookback_days, a.end, days, a.start, now=now)
            windows = {r: w for r in resources}
        else:
            windows = jobs.load_windows(store, resources, shop_id, now, a.lookback_days, a.start, a.end, days)
        for r, w in windows.items():
            print(f"{r}: {w.start.isoformat()} to {w.end.isoformat()}")
    landed = read_landed(spark, a.landing, resources)
    options = {"shop_id": shop_id, "secret": secret, "orphans": a.orphans, "contract": a.schema_contract}
    if a.daily_backfill:
        report = jobs.backfill(store, landed, resources, *a.daily_backfill, batch_id=load_id, **options)
    elif a.replay:
        first, report = jobs.replay_resources(store, landed, resources, now, **options)
        jobs.record_load(store, first, f"{load_id}-first", now)
    else:
        report = jobs.run(store, landed, resources, batch_id=load_id, windows=windows, **options)
    if bulk is not None:
        report.results.update(bulk.tables)
    jobs.record_load(store, report, load_id, now)
    if a.catalog:
        for table in report.results:
            store.export(table, f"{a.catalog}.`{table}`")


if __name__ == "__main__":
    main()
