"""Oracle SQL (DuckDB dialect) for each registered query: the flat answer computed directly from the
driver's tables, with the same column names and integer widths as the Spark result."""

from __future__ import annotations

from datetime import timedelta

from ..functions.hashing import hmac_pads
from ..operators.quality import FRESHNESS_LIMIT_MINUTES
from ..operators.windows import chunk_bounds
from . import queries as QY

# A line's position = its rank by all line fields in the nesting order (ties are identical rows).
LINES = ("li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, "
         "l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"
         " - 1 AS pos FROM lineitem)")
LINE_ID = "(l_orderkey * 1000 + pos)"


def _ts(dt) -> str:
    return f"TIMESTAMP '{dt.isoformat(sep=' ')}'"


def _latest(where: str = "") -> str:
    return (f"SELECT user_id AS gid, ts AS updated_at, event_id, event_type FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY user_id ORDER BY ts DESC, event_id ASC) AS rn FROM events {where}) WHERE rn = 1")


SNAP = _latest()
MANIFEST = (f"SELECT gid, updated_at FROM ({SNAP}) WHERE event_type = 'purchase' UNION ALL SELECT gid, updated_at FROM ("
            + _latest(f"WHERE ts < TIMESTAMP '{QY.MANIFEST_CUT}'")
            + f") WHERE gid NOT IN (SELECT gid FROM ({SNAP}) WHERE event_type IN ('purchase', 'signup'))")
CHANGED = (f"SELECT s.gid, s.updated_at FROM ({SNAP}) s WHERE NOT EXISTS (SELECT 1 FROM ({MANIFEST}) m "
           "WHERE m.gid = s.gid AND m.updated_at = s.updated_at)")

_IPAD, _OPAD = hmac_pads(QY.HMAC_TEST_KEY)

_MERGE_CUT = _ts(QY.MERGE_CUT)
_MERGE_FROM = _ts(QY.MERGE_CUT - timedelta(days=30))
MERGED = f"""
SELECT o_orderkey AS id, o_totalprice AS total_price, o_orderdate AS updated_at, o_orderstatus AS status
FROM orders WHERE o_orderdate < {_MERGE_CUT} AND o_orderdate < {_MERGE_FROM}
UNION ALL
SELECT o_orderkey, o_totalprice + 1, o_orderdate + INTERVAL 1 DAY, o_orderstatus
FROM orders WHERE o_orderdate >= {_MERGE_FROM}
"""

_N_CHUNKS = len(chunk_bounds(QY.CHUNK_START, QY.CHUNK_END, 7))
_CS, _CE = _ts(QY.CHUNK_START), _ts(QY.CHUNK_END)

_SHOP_CUR = "CASE WHEN s_nationkey <= 8 THEN 'USD' WHEN s_nationkey <= 16 THEN 'EUR' ELSE 'GBP' END"

_FRESH_MAP = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in QY.EVENT_RESOURCE.items())
_FRESH_LIM = " ".join(f"WHEN '{k}' THEN {FRESHNESS_LIMIT_MINUTES[v]}" for k, v in QY.EVENT_RESOURCE.items())

_TAGS = "t AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)"

SQL: dict[str, str] = {
    "order_daily_summary": """
        SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders,
               CAST(coalesce(sum(nl), 0) AS BIGINT) AS n_lines, CAST(coalesce(sum(units), 0) AS BIGINT) AS units
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS nl, sum(CAST(l_quantity AS BIGINT)) AS units
                               FROM lineitem GROUP BY 1) l ON l.l_orderkey = o_orderkey
        GROUP BY 1""",
    "unwrap_connection": f"""WITH {LINES}
        SELECT l_orderkey AS order_id, pos AS position, {LINE_ID} AS line_item_id,
               CAST(l_quantity AS BIGINT) AS quantity FROM li""",
    "page_scan": """
        SELECT o_orderkey AS id, o_orderdate AS updated_at, o_totalprice AS total_price, o_orderstatus AS status,
               coalesce(n, 0) AS n_lines
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey""",
    "snapshot_scan": """
        SELECT 'gid://shop/Order/' || CAST(user_id AS VARCHAR) AS gid, ts AS updated_at,
               CAST(date_trunc('day', ts) AS TIMESTAMP) AS created_at
        FROM events WHERE event_type <> 'error'""",
    "props_json_scan": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "flatten_struct": """
        SELECT c_custkey AS customer__customer_id, c_name AS customer__full_name,
               n_nationkey AS customer__home_nation__nation_key, n_name AS customer__home_nation__nation_name,
               r_regionkey AS customer__home_nation__parent_region__region_key,
               r_name AS customer__home_nation__parent_region__region_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "money_bag_flatten": """
        SELECT o_orderkey AS id, o_totalprice AS total_price_set__shop_money__amount,
               'USD' AS total_price_set__shop_money__currency_code,
               o_totalprice AS total_price_set__presentment_money__amount,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'EUR' ELSE 'USD' END
                   AS total_price_set__presentment_money__currency_code
        FROM orders""",
    "typed_projection": """
        SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS total_price,
               o_orderdate AS order_date, o_orderpriority AS priority FROM orders""",
    "customer_flatten": """
        SELECT c_custkey AS id, sha256(split_part(c_name, '#', 1)) AS first_name,
               sha256(split_part(c_name, '#', 2)) AS last_name, sha256(c_mktsegment) AS note,
               CASE WHEN c_acctbal >= 0 THEN sha256(lower(replace(c_name, '#', '.')) || '@example.com') END AS email,
               CASE WHEN c_acctbal >= 0 THEN CASE WHEN c_acctbal > 5000 THEN 'SUBSCRIBED' ELSE 'NOT_SUBSCRIBED' END
               END AS email_marketing_consent_state,
               sha256('+1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0')) AS phone,
               c_acctbal AS total_spent, 'USD' AS total_spent_currency,
               TIMESTAMP '2024-01-01 00:00:00' + to_days(c_nationkey) AS updated_at
        FROM customer""",
    "normalize_document": f"""WITH {LINES},
        per AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linenumber % 2 = 0) AS pct,
                       min(CASE WHEN pos = 0 THEN {LINE_ID} END) AS first_line,
                       arg_min(CASE WHEN l_returnflag = 'R' THEN {LINE_ID} END, CASE WHEN l_returnflag = 'R' THEN pos END)
                           AS first_refund
                FROM li GROUP BY 1)
        SELECT o_orderkey AS id, sha256('customer' || CAST(o_custkey AS VARCHAR) || '@example.com') AS email,
               coalesce(n, 0) AS n_lines, coalesce(pct, 0) AS n_percentage_discounts,
               first_line AS first_line_id,
               CASE WHEN first_refund IS NOT NULL THEN sha256('return of line ' || CAST(first_refund AS VARCHAR)) END
                   AS first_refund_note
        FROM orders LEFT JOIN per ON l_orderkey = o_orderkey""",
    "discount_value_normalize": f"""WITH {LINES}
        SELECT l_orderkey AS order_id, pos AS index,
               CASE WHEN l_linenumber % 2 = 0 THEN 'percentage' ELSE 'fixed_amount' END AS value_type,
               CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS value_percentage,
               CASE WHEN l_linenumber % 2 = 1 AND l_discount <> 0 THEN l_discount END AS value_amount,
               CASE WHEN l_linenumber % 2 = 1 THEN 'USD' END AS value_currency_code
        FROM li""",
    "explode_discounts": f"""WITH {LINES}
        SELECT CAST(1 AS BIGINT) AS shop_id, l_orderkey AS order_id, pos AS index,
               'CODE' || CAST(l_linenumber AS VARCHAR) AS code, 'line ' || CAST(l_linenumber AS VARCHAR) AS title,
               'ACROSS' AS allocation_method, 'LINE_ITEM' AS target_type
        FROM li""",
    "collection_classify": """
        SELECT p_partkey AS id, p_type || ' ' || CAST(p_size AS VARCHAR) AS title,
               CASE WHEN p_size % 2 = 0 THEN 'smart' ELSE 'custom' END AS collection_type,
               CASE WHEN p_size % 2 = 0 THEN p_size > 25 END AS rule_set_applied_disjunctively
        FROM part""",
    "explode_rules": """
        SELECT p_partkey AS collection_id, CAST(0 AS BIGINT) AS index, 'TYPE' AS "column", 'EQUALS' AS relation,
               p_type AS condition FROM part WHERE p_size % 2 = 0
        UNION ALL
        SELECT p_partkey, CAST(1 AS BIGINT), 'VENDOR', 'EQUALS', p_brand FROM part WHERE p_size % 2 = 0""",
    "shop_profile": f"""
        SELECT s_suppkey AS id, s_name AS name, {_SHOP_CUR} AS currency,
               'shop' || CAST(s_suppkey AS VARCHAR) || '.example.com' AS domain,
               CASE WHEN s_acctbal > 5000 THEN 'shopify_plus' WHEN s_acctbal < 500 THEN 'partner_development'
                    ELSE 'unknown' END AS plan_name,
               s_acctbal > 5000 AS plan_shopify_plus, s_acctbal < 500 AS plan_partner_development,
               CASE WHEN s_acctbal > 100 THEN '${{amount}} ' || {_SHOP_CUR} END AS money_format,
               s_acctbal > 2000 AS has_gift_cards_feature, s_acctbal > 3000 AS bundles_eligible,
               CASE WHEN s_acctbal <= 3000 THEN 'LOW_BALANCE' END AS bundles_ineligibility_reason,
               CASE WHEN s_acctbal > 2500 THEN s_acctbal > 4000 END AS cart_transform_expand,
               CASE WHEN s_acctbal > 2500 THEN s_acctbal > 5000 END AS cart_transform_merge,
               'shopify_graphql' AS source
        FROM supplier WHERE s_acctbal >= 0""",
    "json_text_columns": f"""
        SELECT s_suppkey AS id,
               CASE WHEN s_acctbal > 1000 THEN CAST(2 AS BIGINT) END AS n_presentment,
               CASE WHEN s_acctbal > 1000 THEN {_SHOP_CUR} END AS second_currency,
               CASE WHEN s_acctbal > 0 THEN CAST(2 AS BIGINT) END AS n_settings,
               CASE WHEN s_acctbal > 0 THEN s_acctbal > 500 END AS second_setting_enabled,
               s_acctbal > 2000 AS features_gift_cards
        FROM supplier WHERE s_acctbal >= 0""",
    "gid_normalize": f"""WITH {LINES}
        SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS order_id,
               {LINE_ID} AS line_item_id, l_partkey AS product_id, o_custkey AS customer_id
        FROM li JOIN orders ON o_orderkey = l_orderkey""",
    "pii_hash_sha256": "SELECT c_custkey AS id, sha256(c_name) AS name_hash FROM customer",
    "pii_hash_hmac": f"""
        SELECT c_custkey AS id,
               sha256(unhex('{_OPAD}') || unhex(sha256(unhex('{_IPAD}') || encode(c_name)))) AS name_hash
        FROM customer""",
    "pii_hash_wildcard": f"""WITH {LINES}
        SELECT l_orderkey AS order_id, {LINE_ID} AS refund_id,
               sha256('return of line ' || CAST({LINE_ID} AS VARCHAR)) AS note_hash
        FROM li WHERE l_returnflag = 'R'""",
    "inject_shop_id": """
        SELECT 'order' AS table_name, CAST(1 AS BIGINT) AS shop_id, count(*) AS n_rows FROM orders
        UNION ALL SELECT 'order__line_items', 1, count(*) FROM lineitem
        UNION ALL SELECT 'order__line_items__tax_lines', 1, 2 * count(*) FROM lineitem
        UNION ALL SELECT 'order__refunds', 1, count(*) FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT 'order__shipping_lines', 1, count(DISTINCT l_orderkey) FROM lineitem""",
    "updated_range_filter": """
        SELECT o_orderkey AS id, o_orderdate AS updated_at, o_orderstatus AS status FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'""",
    "explode_child": f"""WITH {LINES}
        SELECT l_orderkey AS order_id, {LINE_ID} AS id, CAST(l_quantity AS BIGINT) AS quantity,
               'SKU-' || CAST(l_partkey AS VARCHAR) AS sku, 'Supplier#' || CAST(l_suppkey AS VARCHAR) AS vendor,
               l_extendedprice AS original_total_set__shop_money__amount
        FROM li""",
    "explode_grandchild": f"""WITH {LINES}
        SELECT {LINE_ID} AS line_item_id, CAST(0 AS BIGINT) AS index, 'VAT' AS title, l_tax AS rate FROM li
        UNION ALL SELECT {LINE_ID}, 1, 'CITY', l_discount FROM li""",
    "explode_custom_attributes": f"""WITH {LINES}
        SELECT {LINE_ID} AS line_item_id, CAST(0 AS BIGINT) AS index, 'returnflag' AS key, l_returnflag AS value
        FROM li UNION ALL SELECT {LINE_ID}, 1, 'linestatus', l_linestatus FROM li""",
    "explode_discount_allocations": f"""WITH {LINES}
        SELECT {LINE_ID} AS line_item_id, CAST(0 AS BIGINT) AS index, l_discount AS amount,
               'ACROSS' AS allocation_method FROM li WHERE l_discount > 0""",
    "explode_refunds": f"""WITH {LINES}
        SELECT {LINE_ID} AS refund_id, {LINE_ID} AS id, {LINE_ID} AS line_item__id,
               CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS subtotal
        FROM li WHERE l_returnflag = 'R'""",
    "explode_order_adjustments": f"""WITH {LINES}
        SELECT {LINE_ID} AS refund_id, {LINE_ID} AS id, 'RESTOCK' AS reason
        FROM li WHERE l_returnflag = 'R' AND l_discount > 0.05""",
    "explode_order_tax_lines": f"""WITH {LINES}
        SELECT l_orderkey AS order_id, pos AS index, 'LINE_' || CAST(l_linenumber AS VARCHAR) AS title,
               l_tax AS rate FROM li""",
    "explode_shipping_lines": """
        SELECT o_orderkey AS shipping_line_id, o_orderkey AS order_id, o_orderpriority AS title, 'STD' AS code,
               CAST(0 AS BIGINT) AS index, 'SHIP_VAT' AS tax_title, CAST(0.1 AS DOUBLE) AS rate
        FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "explode_tags": f"""WITH {_TAGS}
        SELECT p_partkey AS product_id, unnest(range(len(w))) AS index, unnest(w) AS value FROM t""",
    "explode_customer_tags": """
        SELECT c_custkey AS customer_id, CAST(0 AS BIGINT) AS index, c_mktsegment AS value FROM customer
        UNION ALL SELECT c_custkey, 1, 'nation_' || CAST(c_nationkey AS VARCHAR) FROM customer""",
    "explode_options": f"""WITH {_TAGS}
        SELECT p_partkey * 10 + 1 AS product_option_id, CAST(0 AS BIGINT) AS index, p_brand AS name FROM part
        UNION ALL SELECT p_partkey * 10 + 2, 0, p_type FROM part
        UNION ALL SELECT p_partkey * 10 + 3, unnest(range(len(w))), unnest(w) FROM t""",
    "explode_variants": """
        SELECT p_partkey AS variant_id, p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
               p_retailprice AS price, CAST(0 AS BIGINT) AS index, 'Brand' AS name, p_brand AS value FROM part
        UNION ALL SELECT p_partkey, p_partkey, 'SKU-' || CAST(p_partkey AS VARCHAR), p_retailprice, 1, 'Size',
               CAST(p_size AS VARCHAR) FROM part""",
    "explode_images": """
        SELECT p_partkey AS product_id, p_partkey AS id,
               'https://img.example/' || CAST(p_partkey AS VARCHAR) || '.png' AS url,
               CAST(p_size * 10 AS BIGINT) AS width FROM part""",
    "collection_product_bridge": """
        SELECT CAST(1 AS BIGINT) AS shop_id, CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS BIGINT) AS collection_id,
               p_partkey AS product_id FROM part""",
    "replace_snapshot": """
        SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'smart' ELSE 'custom' END AS collection_type
        FROM part""",
    "latest_by_key": f"SELECT gid, updated_at, event_id FROM ({SNAP})",
    "change_detect": CHANGED,
    "hydrate_join": f"""
        SELECT c.gid, c.updated_at, c_name, c_acctbal FROM ({CHANGED}) c JOIN customer ON c_custkey = c.gid""",
    "hydrate_missing": f"""
        SELECT c.gid, c.updated_at FROM ({CHANGED}) c
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal >= 0 AND c_custkey = c.gid)""",
    "topk_snapshots": f"SELECT * FROM ({CHANGED}) ORDER BY updated_at, gid LIMIT 100",
    "merge_upsert": MERGED,
    "load_audit": f"""
        SELECT 'order' AS table_name, 2 * count(*) AS rows_in,
               count(*) FILTER (WHERE o_orderdate >= {_MERGE_CUT}) AS inserted,
               count(*) FILTER (WHERE o_orderdate < {_MERGE_CUT}) AS updated
        FROM orders WHERE o_orderdate >= {_MERGE_FROM}""",
    "merge_counts": f"""
        SELECT 2 * count(*) AS rows_in, count(*) AS distinct_keys,
               count(*) FILTER (WHERE o_orderdate >= {_MERGE_CUT}) AS inserted,
               count(*) FILTER (WHERE o_orderdate < {_MERGE_CUT}) AS updated
        FROM orders WHERE o_orderdate >= {_MERGE_FROM}""",
    "manifest_prune": f"""
        SELECT gid, updated_at FROM ({MANIFEST}) WHERE updated_at >= TIMESTAMP '{QY.PRUNE_START}'""",
    "manifest_update": f"""
        SELECT gid, updated_at FROM ({MANIFEST}) m WHERE NOT EXISTS (SELECT 1 FROM ({CHANGED}) c WHERE c.gid = m.gid)
        UNION ALL SELECT gid, updated_at FROM ({CHANGED})""",
    "date_chunks": f"""
        WITH c AS (SELECT i AS chunk_index, {_CS} + i * INTERVAL 7 DAY AS chunk_start,
                          least({_CS} + (i + 1) * INTERVAL 7 DAY, {_CE}) AS chunk_end
                   FROM range(0, {_N_CHUNKS}) r(i))
        SELECT chunk_index, chunk_start, chunk_end, count(*) AS rows_read
        FROM c JOIN orders ON o_orderdate BETWEEN chunk_start AND chunk_end
        GROUP BY ALL""",
    "date_chunks_dedup": f"""
        SELECT o_orderkey AS id, o_orderdate AS ts,
               CAST(least(floor(date_diff('day', {_CS}, o_orderdate) / 7), {_N_CHUNKS - 1}) AS BIGINT) AS last_chunk
        FROM orders WHERE o_orderdate BETWEEN {_CS} AND {_CE}""",
    "incremental_window": f"""
        WITH c AS (SELECT max(ts) AS cur FROM events WHERE ts < TIMESTAMP '{QY.MANIFEST_CUT}')
        SELECT event_id, ts, user_id FROM events, c
        WHERE ts BETWEEN least(cur - INTERVAL 1 DAY, TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 7 DAY)
                     AND TIMESTAMP '2024-01-25 00:00:00'""",
    "high_watermark": "SELECT event_type, max(ts) AS high_watermark FROM events GROUP BY 1",
    "daily_partition_backfill": f"""
        SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders
        WHERE o_orderdate BETWEEN {_ts(QY.BACKFILL_FIRST)} AND {_ts(QY.BACKFILL_LAST)} + INTERVAL 1 DAY
                                  - INTERVAL 1 MICROSECOND
        GROUP BY 1""",
    "two_phase_replay": """
        WITH n AS (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY AS now FROM events)
        SELECT event_id, user_id, ts, value FROM events, n
        WHERE ts BETWEEN now - INTERVAL 10 DAY AND now""",
    "truncation_report": """
        SELECT l_orderkey AS parent_id, 'lineItems' AS field, count(*) AS n_nodes FROM lineitem
        GROUP BY 1 HAVING count(*) > 5""",
    "fk_orphans": """
        SELECT 'order__line_items.order_id->order' AS relation, count(*) AS n_children,
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_totalprice >= 10000)) AS n_orphans
        FROM lineitem
        UNION ALL
        SELECT 'order__refunds.order_id->order', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_totalprice >= 10000))
        FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL
        SELECT 'order__refunds__refund_line_items.line_item__id->order__line_items', count(*), count(*) FILTER (WHERE l_quantity < 5)
        FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL
        SELECT 'order.customer__id->customer', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey))
        FROM orders
        UNION ALL
        SELECT 'order__line_items.product__id->product', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey))
        FROM lineitem""",
    "freshness_report": f"""
        SELECT event_type, CASE event_type {_FRESH_MAP} END AS resource, max(ts) AS last_updated,
               CAST((epoch_us({_ts(QY.FRESHNESS_NOW)}) - epoch_us(max(ts))) // 60000000 AS BIGINT) AS lag_minutes,
               CAST(CASE event_type {_FRESH_LIM} END AS BIGINT) AS limit_minutes,
               (epoch_us({_ts(QY.FRESHNESS_NOW)}) - epoch_us(max(ts))) // 60000000 > CASE event_type {_FRESH_LIM} END
                   AS is_stale
        FROM events GROUP BY 1""",
    "full_load_counts": """
        WITH w AS (SELECT sum(len(string_split(p_name, ' '))) AS words FROM part)
        SELECT 'order' AS table_name, count(*) AS n_rows FROM orders
        UNION ALL SELECT 'order__line_items', count(*) FROM lineitem
        UNION ALL SELECT 'order__line_items__tax_lines', 2 * count(*) FROM lineitem
        UNION ALL SELECT 'order__line_items__discount_allocations', count(*) FROM lineitem WHERE l_discount > 0
        UNION ALL SELECT 'order__line_items__custom_attributes', 2 * count(*) FROM lineitem
        UNION ALL SELECT 'order__refunds', count(*) FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT 'order__refunds__refund_line_items', count(*) FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT 'order__refunds__order_adjustments', count(*) FROM lineitem
                  WHERE l_returnflag = 'R' AND l_discount > 0.05
        UNION ALL SELECT 'order__discount_applications', count(*) FROM lineitem
        UNION ALL SELECT 'order__tax_lines', count(*) FROM lineitem
        UNION ALL SELECT 'order__shipping_lines', count(DISTINCT l_orderkey) FROM lineitem
        UNION ALL SELECT 'order__shipping_lines__tax_lines', count(DISTINCT l_orderkey) FROM lineitem
        UNION ALL SELECT 'customer', count(*) FROM customer
        UNION ALL SELECT 'customer__tags', 2 * count(*) FROM customer
        UNION ALL SELECT 'product', count(*) FROM part
        UNION ALL SELECT 'product__tags', CAST((SELECT words FROM w) AS BIGINT)
        UNION ALL SELECT 'product__images', count(*) FROM part
        UNION ALL SELECT 'product__options', 3 * count(*) FROM part
        UNION ALL SELECT 'product__options__option_values', 2 * count(*) + CAST((SELECT words FROM w) AS BIGINT) FROM part
        UNION ALL SELECT 'product__variants', count(*) FROM part
        UNION ALL SELECT 'product__variants__selected_options', 2 * count(*) FROM part
        UNION ALL SELECT 'collection', count(*) FROM part
        UNION ALL SELECT 'collection__rules', 2 * count(*) FROM part WHERE p_size % 2 = 0
        UNION ALL SELECT 'collection_product', count(*) FROM part
        UNION ALL SELECT 'shop', count(*) FROM supplier WHERE s_acctbal >= 0""",
    "bulk_orders_load": f"""
        SELECT o_orderkey AS id, o_orderdate AS updated_at, o_totalprice AS total_price FROM orders
        WHERE o_orderdate >= {_MERGE_CUT} AND o_orderdate <= {_ts(QY.BULK_WINDOW[1])}""",
    "payload_scan": """
        SELECT o_orderkey AS id, o_totalprice AS total_price,
               (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS n_refunds
        FROM orders""",
    "stream_merge": "SELECT event_id, user_id, ts, event_type, value FROM events",
    "stream_dedup": "SELECT event_id, user_id, ts, event_type FROM events",
    "stream_change_detect": CHANGED,
    "stream_dedup_late": "SELECT event_id, user_id, ts, event_type FROM events",
    "reject_report": """
        SELECT 'event' AS table_name, 'NULL primary key' AS reason, count(*) AS n_rows FROM events WHERE event_type = 'error'
        UNION ALL SELECT 'event', 'merged', count(*) FROM events WHERE event_type <> 'error'""",
    "incremental_load": """
        SELECT c_custkey AS id, TIMESTAMP '2024-01-01' + c_nationkey * INTERVAL 1 DAY AS updated_at FROM customer WHERE c_nationkey >= 2""",
    "bulk_relanded": f"""WITH {LINES},
        o AS (SELECT * FROM orders WHERE o_orderdate >= {_MERGE_CUT} AND o_orderdate <= {_ts(QY.BULK_WINDOW[1])}),
        l AS (SELECT *, {LINE_ID} AS id, l_returnflag = 'R' AS returned FROM li WHERE l_orderkey IN (SELECT o_orderkey FROM o)),
        c AS (SELECT 'order' AS table_name, o_orderkey AS k, round(o_totalprice * 100) AS v, 1 AS n FROM o
              UNION ALL SELECT 'order__line_items', id, l_quantity, 1 FROM l
              UNION ALL SELECT unnest(['order__line_items__tax_lines', 'order__line_items__custom_attributes']), id, 0, 2 FROM l
              UNION ALL SELECT 'order__line_items__discount_allocations', id, 0, 1 FROM l WHERE l_discount > 0
              UNION ALL SELECT 'order__refunds', id, 0, 1 FROM l WHERE returned
              UNION ALL SELECT 'order__refunds__refund_line_items', id, l_quantity, 1 FROM l WHERE returned
              UNION ALL SELECT 'order__refunds__order_adjustments', id, 0, 1 FROM l WHERE returned AND l_discount > 0.05
              UNION ALL SELECT unnest(['order__discount_applications', 'order__tax_lines']), l_orderkey, 0, 1 FROM l
              UNION ALL SELECT DISTINCT unnest(['order__shipping_lines', 'order__shipping_lines__tax_lines']), l_orderkey, 0, 1 FROM l)
        SELECT table_name, sum(n)::BIGINT AS n_rows, sum(n)::BIGINT AS n_keys, sum(n * k)::BIGINT AS key_sum, sum(v)::BIGINT AS value_sum
        FROM c GROUP BY table_name""",
    "load_checksums": f"""WITH {_TAGS}, w AS (SELECT p_partkey, unnest(w) AS x FROM t),
        c AS (SELECT 'customer' AS table_name, c_custkey AS k, length(sha256(c_mktsegment)) AS v FROM customer
              UNION ALL SELECT 'customer__tags', c_custkey, unnest([length(c_mktsegment), length('nation_' || c_nationkey)]) FROM customer
              UNION ALL SELECT 'product', p_partkey, length(p_name) FROM part
              UNION ALL SELECT 'product__tags', p_partkey, length(x) FROM w
              UNION ALL SELECT 'product__images', p_partkey, p_size * 10 FROM part
              UNION ALL SELECT 'product__options', p_partkey * 10 + unnest([1, 2, 3]), unnest([5, 4, 5]) FROM part
              UNION ALL SELECT 'product__options__option_values', p_partkey * 10 + unnest([1, 2]), unnest([length(p_brand), length(p_type)]) FROM part
              UNION ALL SELECT 'product__options__option_values', p_partkey * 10 + 3, length(x) FROM w
              UNION ALL SELECT 'product__variants', p_partkey, round(p_retailprice * 100) FROM part
              UNION ALL SELECT 'product__variants__selected_options', p_partkey, unnest([length(p_brand), length(p_size::VARCHAR)]) FROM part
              UNION ALL SELECT 'collection', p_partkey, length(p_type || ' ' || p_size) FROM part
              UNION ALL SELECT 'collection__rules', p_partkey, unnest([length(p_type), length(p_brand)]) FROM part WHERE p_size % 2 = 0)
        SELECT table_name, count(*) AS n_rows, count(*) AS n_keys, sum(k)::BIGINT AS key_sum, sum(v)::BIGINT AS value_sum FROM c GROUP BY table_name""",
    "cast_failures": """
        SELECT 'customer' AS table_name, 'cast created_at' AS reason, count(*) AS n_rows FROM customer WHERE c_nationkey = 3
        UNION ALL SELECT 'customer', 'cast total_spent', count(*) FROM customer WHERE c_nationkey = 4
        UNION ALL SELECT 'customer', 'NULL primary key', count(*) FROM customer WHERE c_nationkey = 7
        UNION ALL SELECT 'customer__tags', 'NULL primary key', 2 * count(*) FROM customer WHERE c_nationkey = 7""",
    "replay_load": """
        SELECT c_custkey AS id, TIMESTAMP '2024-01-01' + c_nationkey * INTERVAL 1 DAY AS updated_at, sha256(c_mktsegment) AS note
        FROM customer WHERE c_nationkey BETWEEN 9 AND 19""",
    "backfill_load": """
        SELECT 'customers' AS resource, d::DATE AS day, count(c_custkey) AS n_roots, count(c_custkey) AS n_loaded
        FROM range(DATE '2024-01-05', DATE '2024-01-31', INTERVAL 1 DAY) AS r(d)
        LEFT JOIN customer ON DATE '2024-01-01' + c_nationkey::INT = d::DATE GROUP BY ALL""",
}
