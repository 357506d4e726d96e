"""The same results in SQL, straight from the star-schema tables, for checking.

Money is summed as decimal and compared as double; averages are exact sums over counts.
"""

from __future__ import annotations

# r restaurants, u users, m menu items, o orders, i order items.
_TABLES = """
WITH r AS (
  SELECT s_suppkey AS restaurant_id, CAST(s_nationkey AS BIGINT) AS fk_address,
         s_name AS restaurant_name
  FROM supplier
), u AS (
  SELECT c_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS fk_address, c_name AS user_fullname
  FROM customer
), m AS (
  SELECT p_partkey AS item_id, p_partkey % (SELECT count(*) FROM supplier) AS fk_restaurant,
         p_name AS item_name,
         CASE p_partkey % 3 WHEN 0 THEN 'food' WHEN 1 THEN 'beverage' ELSE 'dessert' END
           AS item_category,
         p_retailprice AS price
  FROM part
), o AS (
  SELECT o_orderkey AS order_id, o_orderkey % (SELECT count(*) FROM supplier) AS fk_restaurant,
         o_custkey AS fk_user, o_orderdate AS order_datetime, o_totalprice AS total_cost,
         1 + (o_orderkey % 9) * CAST(0.5 AS DOUBLE) AS cust_restaurant_rating
  FROM orders
), i AS (
  SELECT l_partkey AS fk_menu_item, l_orderkey AS fk_order,
         CAST(l_quantity AS BIGINT) AS item_quantity
  FROM lineitem
), stats AS (
  SELECT restaurant_name,
         CAST(sum(CAST(total_cost AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         sum(cust_restaurant_rating) / count(cust_restaurant_rating) AS avg_rate
  FROM o JOIN r ON fk_restaurant = restaurant_id
  GROUP BY restaurant_name
), counts AS (
  SELECT fk_menu_item, CAST(sum(item_quantity) AS BIGINT) AS item_quantity
  FROM i GROUP BY fk_menu_item
), listing AS (
  SELECT user_fullname, order_datetime, restaurant_name, total_cost, cust_restaurant_rating,
         order_id
  FROM o JOIN r ON fk_restaurant = restaurant_id JOIN u ON fk_user = user_id
), totals AS (
  SELECT fk_order,
         CAST(sum(CAST(price AS DECIMAL(18,2)) * item_quantity) AS DOUBLE) AS total_cost
  FROM i JOIN m ON fk_menu_item = item_id
  GROUP BY fk_order
)
"""

# Texts of the document queries; the price of the first food depends on the part.
_DOCUMENTS = """
WITH foods AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price
  FROM part
), written AS (
  SELECT *, CASE p_partkey % 5 WHEN 0 THEN '$' || price WHEN 1 THEN 'FREE'
                 WHEN 2 THEN price || '$-' || price || '$' WHEN 3 THEN 'on request'
                 ELSE price END AS price_text,
         CASE p_partkey % 5 WHEN 1 THEN 0.0::DOUBLE WHEN 3 THEN NULL
              ELSE CAST(price AS DOUBLE) END AS price_value
  FROM foods
), menu AS (
  SELECT p_partkey, 0 AS menu_place, p_name AS item_name, 'food' AS item_category,
         price_value AS price, price_text, p_name, p_size
  FROM written WHERE p_size > 3
  UNION ALL
  SELECT p_partkey, 1, p_brand, 'food', 12.5, '12.5', p_name, p_size FROM written WHERE p_size > 3
  UNION ALL
  SELECT p_partkey, 2, p_type, 'beverage', 3.0, '$3', p_name, p_size FROM written WHERE p_size > 3
  UNION ALL
  SELECT p_partkey, 3, p_name || ' pie', 'dessert', 1.5, '1-2', p_name, p_size
  FROM written WHERE p_size > 3
)
"""

_REVENUE = _TABLES + "SELECT * FROM stats"
_COUNTS = _TABLES + "SELECT * FROM counts"

_TOP_RESTAURANTS = (
    _TABLES + "SELECT * FROM stats ORDER BY total_revenue DESC, restaurant_name LIMIT 10"
)
_TOP_ITEMS = (
    _TABLES
    + """
SELECT item_name || chr(10) || '$' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) AS item_name,
       item_quantity, price
FROM counts JOIN m ON fk_menu_item = item_id
ORDER BY item_quantity DESC, fk_menu_item LIMIT 10
"""
)

_REJECTS = """
SELECT 'orders' AS topic,
       CASE o_orderkey % 7 WHEN 0 THEN 'incomplete' WHEN 1 THEN 'malformed' ELSE 'amount_not_finite' END AS reason,
       count(*) AS n
FROM orders WHERE o_orderkey % 7 < 3 GROUP BY 2
UNION ALL
SELECT 'order_items', CASE l_orderkey % 11 WHEN 0 THEN 'incomplete' ELSE 'malformed' END, count(*)
FROM lineitem WHERE l_orderkey % 11 < 2 GROUP BY 2
"""

ORACLE: dict[str, str] = {
    "restaurant_revenue": _REVENUE,
    "restaurant_revenue_stream": _REVENUE,
    "item_counts": _COUNTS,
    "item_counts_stream": _COUNTS,
    "snapshot_current": _COUNTS,
    "top10_restaurants": _TOP_RESTAURANTS,
    "top10_restaurants_live": _TOP_RESTAURANTS,
    "top10_items": _TOP_ITEMS,
    "top10_items_live": _TOP_ITEMS,
    "top10_job": f"""
SELECT 'restaurant' AS kind, restaurant_name AS name, total_revenue AS value FROM ({_TOP_RESTAURANTS})
UNION ALL SELECT 'item', item_name, CAST(item_quantity AS DOUBLE) FROM ({_TOP_ITEMS})
""",
    "latest_stats": """
SELECT user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events
) WHERE rn = 1
""",
    "orders_list": _TABLES + "SELECT * EXCLUDE (order_id) FROM listing",
    "orders_list_sql": _TABLES
    + """
SELECT user_fullname, restaurant_name, count(*) AS n_orders FROM listing
GROUP BY user_fullname, restaurant_name
""",
    "orders_page": _TABLES
    + """
SELECT * EXCLUDE (order_id) FROM listing
ORDER BY total_cost DESC, order_id LIMIT 25 OFFSET 50
""",
    "orders_next_page": _TABLES
    + """
SELECT * EXCLUDE (order_id) FROM listing
ORDER BY total_cost DESC, order_id LIMIT 25 OFFSET 75
""",
    "orders_previous_page": _TABLES
    + """
SELECT * EXCLUDE (order_id, place, n) FROM (
  SELECT *, row_number() OVER (ORDER BY total_cost DESC, order_id) - 1 AS place,
         count(*) OVER () AS n
  FROM listing
) WHERE place // 100 = (n - 1) // 100 - 1
""",
    "orders_last_page": _TABLES
    + """
SELECT * EXCLUDE (order_id, place, n) FROM (
  SELECT *, row_number() OVER (ORDER BY total_cost DESC, order_id) - 1 AS place,
         count(*) OVER () AS n
  FROM listing
) WHERE place // 100 = (n - 1) // 100
""",
    "orders_page_by_user": _TABLES
    + "SELECT * FROM listing ORDER BY user_fullname, order_id LIMIT 50 OFFSET 50",
    "page_index": """
SELECT CAST(size AS INTEGER) AS page_size, CAST(ceil(n / size) AS BIGINT) AS total_pages
FROM (SELECT count(*) AS n FROM orders), (SELECT unnest([10, 25, 50, 100]) AS size)
""",
    "order_enrich": _TABLES
    + "SELECT o.*, restaurant_name FROM o JOIN r ON fk_restaurant = restaurant_id",
    "restaurant_menu": _TABLES
    + """
SELECT order_id, n_items, min_price FROM o JOIN (
  SELECT fk_restaurant, count(*) AS n_items, min(price) AS min_price FROM m GROUP BY fk_restaurant
) USING (fk_restaurant)
""",
    "order_totals": _TABLES + "SELECT * FROM totals",
    "order_item_quantities": _TABLES
    + "SELECT fk_order, fk_menu_item, count(*) AS n FROM i GROUP BY fk_order, fk_menu_item",
    "order_total_reconcile": _TABLES
    + """
SELECT order_id, o.total_cost AS stated, totals.total_cost AS computed,
       coalesce(CAST(o.total_cost AS DECIMAL(18,2)) = CAST(totals.total_cost AS DECIMAL(18,2)), false)
         AS matches
FROM o LEFT JOIN totals ON order_id = fk_order
""",
    "table_scan_filtered": _TABLES + "SELECT * FROM m WHERE fk_restaurant = 3",
    "table_scan_predicate": _TABLES
    + "SELECT * FROM u WHERE fk_address = 3 OR user_fullname LIKE '%7'",
    "table_scan_json": _TABLES
    + """
SELECT '{"user_id":' || user_id || ',"fk_address":' || fk_address || ',"user_fullname":"'
       || user_fullname || '"}' AS value
FROM u
""",
    "table_counts": """
SELECT 'address' AS table_name, count(*) AS n FROM nation
UNION ALL SELECT 'users', count(*) FROM customer
UNION ALL SELECT 'restaurants', count(*) FROM supplier
UNION ALL SELECT 'menu_items', count(*) FROM part
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'order_item', count(*) FROM lineitem
""",
    "json_decode": "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events",
    "typecast_orders": _TABLES + "SELECT * FROM o",
    "publish_orders": _TABLES
    + "SELECT CAST(order_id AS VARCHAR) AS key, order_id, order_datetime, total_cost FROM o",
    "distinct_names": "SELECT DISTINCT p_name AS item_name FROM part",
    "distinct_name_count": "SELECT count(DISTINCT p_name) AS n FROM part",
    "numbered_list_parse": """
SELECT p_partkey AS list_id, p_name AS name FROM part
UNION ALL SELECT p_partkey, p_brand FROM part
UNION ALL SELECT p_partkey, p_type FROM part
""",
    "price_normalize": _DOCUMENTS + "SELECT p_partkey AS item_id, price_value AS price FROM written",
    "extract_json": "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events",
    "user_flatten": """
SELECT c_custkey AS user_id, replace(c_name, '#', ' ') AS user_fullname,
       CAST(c_nationkey AS BIGINT) AS fk_address,
       c_custkey || ' ' || c_mktsegment || ', Springfield, ' || c_nationkey AS address_info
FROM customer
""",
    "user_load": """
SELECT 100 + place AS user_id, (SELECT max(n_nationkey) + 1 FROM nation) + place AS fk_address,
       c_name AS registration_number,
       c_custkey || ' ' || c_mktsegment || ', Springfield, ' || c_nationkey AS address_info
FROM (SELECT *, row_number() OVER (ORDER BY c_name) - 1 AS place FROM customer)
""",
    "menu_flatten": _DOCUMENTS
    + "SELECT p_partkey AS fk_restaurant, item_name, item_category, price FROM menu",
    "menu_load": _DOCUMENTS
    + """
SELECT row_number() OVER (ORDER BY p_partkey, menu_place) - 1 AS item_id, place AS fk_restaurant,
       place + (SELECT max(n_nationkey) + 1 FROM nation) AS fk_address,
       'House of ' || p_name AS restaurant_name, CAST(p_size AS DOUBLE) AS latitude,
       item_name, price
FROM menu JOIN (
  SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part WHERE p_size > 3
) USING (p_partkey)
""",
    "document_quarantine": """
SELECT CASE WHEN p_size < 3 THEN 'malformed' ELSE 'incomplete' END AS reason, count(*) AS n
FROM part WHERE p_size <= 3 GROUP BY 1
""",
    "price_quarantine": _DOCUMENTS
    + "SELECT p_partkey AS document_id, menu_place, price_text FROM menu WHERE price IS NULL",
    "quarantine": """
SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'incomplete'
            WHEN 'view' THEN 'empty' ELSE 'valid' END AS status, count(*) AS n
FROM events GROUP BY 1
""",
    "assign_ids": _TABLES
    + """
SELECT item_id,
       (SELECT max(user_id) + 1 FROM u)
         + row_number() OVER (ORDER BY fk_restaurant, item_id) - 1 AS new_id
FROM m
""",
    "append_new": """
SELECT o_orderkey AS order_id, o_totalprice AS total_cost,
       CASE WHEN o_orderdate < '1998-01-01' THEN 'already_present' ELSE 'accepted' END AS status,
       CAST(1 AS BIGINT) AS n
FROM orders
UNION ALL
SELECT o_orderkey, o_totalprice + 1, 'duplicate_key', 1 FROM orders WHERE o_orderdate >= '2000-01-01'
""",
    "orders_deep_page": _TABLES
    + """
SELECT * EXCLUDE (order_id) FROM listing ORDER BY total_cost DESC, order_id LIMIT 100 OFFSET 11900
""",
    "revenue_after_restart": _REVENUE,
    "revenue_after_rescale": _REVENUE,
    "order_stats_job": _TABLES
    + """
SELECT 'restaurant' AS kind, restaurant_name AS key, CAST(sum(CAST(total_cost AS DECIMAL(18, 2))) AS DOUBLE) AS value
FROM o JOIN r ON fk_restaurant = restaurant_id GROUP BY restaurant_name
UNION ALL
SELECT 'item', CAST(fk_menu_item AS VARCHAR), CAST(sum(item_quantity) AS DOUBLE) FROM i GROUP BY fk_menu_item
""",
    "user_fields_unknown": """
SELECT c_custkey AS user_id, 'results.loyalty' AS field, 'unknown' AS problem, '{"level":"gold"}' AS value
FROM customer WHERE c_custkey % 5 = 0
UNION ALL
SELECT c_custkey, 'results.location.street', 'mistyped', '"Main"' FROM customer WHERE c_custkey % 7 = 0
UNION ALL
SELECT c_custkey, 'results.login.username', 'mistyped', '["x"]' FROM customer WHERE c_custkey % 11 = 0
""",
    "stream_quarantine": _REJECTS,
    "stream_rejects": _REJECTS,
    "publish_period": """
SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(o_orderdate AS TIMESTAMP) AS order_datetime
FROM orders WHERE o_orderdate >= '1996-03-08' AND o_orderdate < '1996-04-11'
""",
    "orders_load": """
WITH placed AS (
  SELECT o_orderkey, o_custkey AS fk_user,
         (SELECT max(o_orderkey) + 1 FROM orders) + row_number() OVER (ORDER BY o_orderkey) - 1 AS fk_order
  FROM orders
), counted AS (
  SELECT l_orderkey, l_partkey AS fk_menu_item, count(*) AS item_quantity FROM lineitem GROUP BY ALL
), total AS (
  SELECT l_orderkey, CAST(sum(CAST(p_retailprice AS DECIMAL(18, 2)) * item_quantity) AS DOUBLE) AS total_cost
  FROM counted JOIN part ON fk_menu_item = p_partkey GROUP BY l_orderkey
)
SELECT 500 + row_number() OVER (ORDER BY fk_order, fk_menu_item) - 1 AS order_item_id,
       fk_menu_item, fk_order, item_quantity, fk_user, total_cost
FROM counted JOIN placed ON l_orderkey = o_orderkey JOIN total USING (l_orderkey)
""",
    "create_and_load": """
SELECT unnest(['address', 'users', 'restaurants', 'menu_items', 'orders', 'order_item']) AS table_name,
       unnest([0, 0, (SELECT count(*) FROM supplier), 0, 0, 0]) AS n
""",
    "name_list_roundtrip": "SELECT DISTINCT p_name AS restaurant_name FROM part",
    "user_documents_file": """
SELECT c_name AS registration_number, replace(c_name, '#', ' ') AS user_fullname,
       c_custkey || ' ' || c_mktsegment || ', Springfield, ' || c_nationkey AS address_info
FROM customer WHERE c_custkey % 10 NOT IN (3, 4)
""",
    "user_quarantine": """
SELECT CASE c_custkey % 10 WHEN 3 THEN 'malformed' ELSE 'incomplete' END AS reason, count(*) AS n
FROM customer WHERE c_custkey % 10 IN (3, 4) GROUP BY 1
""",
    "restaurant_documents_file": """
SELECT 'House of ' || p_name AS restaurant_name, 2 AS n_foods FROM part WHERE p_size > 3
""",
    "day_series": """
SELECT CAST(day AS DATE) AS day, CAST(day + INTERVAL 86400 SECOND AS TIMESTAMP) AS latest_order
FROM (
  SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day
  FROM orders
)
""",
}
