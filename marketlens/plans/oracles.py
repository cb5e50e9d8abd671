"""SQL counterparts of the registered queries, for checking results in another engine.

The ALS queries have none: their result is not expressible in SQL.
"""

from __future__ import annotations

from marketlens.plans.catalogue import STOP_PHRASES, STOP_WORDS, TABLES
from marketlens.plans.star import CATEGORY_TITLES, JOINED_TEXTS, WARRANTY_TEXTS


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _warranty(text: str, zero: str = "0") -> str:
    low = f"lower({text})"
    return f"""CASE WHEN {text} IS NULL OR trim({text}) = '' THEN 0
        WHEN contains({low}, 'trọn đời') THEN 36500
        WHEN regexp_matches({low}, 'không|no warranty|{zero}') THEN 0
        WHEN regexp_matches({low}, '[0-9]+\\s*(năm|year)') THEN CAST(regexp_extract({low}, '([0-9]+)\\s*(năm|year)', 1) AS INTEGER) * 365
        WHEN regexp_matches({low}, '[0-9]+\\s*(tháng|month)') THEN CAST(regexp_extract({low}, '([0-9]+)\\s*(tháng|month)', 1) AS INTEGER) * 30
        WHEN regexp_matches({low}, '[0-9]+\\s*(ngày|day)') THEN CAST(regexp_extract({low}, '([0-9]+)\\s*(ngày|day)', 1) AS INTEGER)
        ELSE 0 END"""


def _joined(text: str) -> str:
    def value(unit: str) -> str:
        return f"CAST(regexp_extract({text}, '([0-9]+)\\s+(năm|tháng|ngày)', 1) AS INTEGER) * {unit}"

    unit = f"regexp_extract({text}, '([0-9]+)\\s+(năm|tháng|ngày)', 2)"
    return f"""CASE WHEN {text} IS NULL THEN 0 WHEN {unit} = 'năm' THEN {value("365")}
        WHEN {unit} = 'tháng' THEN {value("30")} WHEN {unit} = 'ngày' THEN {value("1")} ELSE 0 END"""


_SELLERS = """
SELECT s_suppkey AS seller_id, s_name AS seller_name,
  'https://img.example/' || s_suppkey || '.png' AS icon_url,
  'https://shop.example/' || s_suppkey AS store_url,
  CAST(s_nationkey AS DOUBLE) / 5 AS avg_rating_point,
  CAST(floor(s_acctbal) AS INTEGER) AS review_count,
  s_nationkey * 100 AS total_follower, s_nationkey * 10 AS days_since_joined,
  s_acctbal > 5000 AS is_official,
  CASE WHEN s_acctbal > 5000 THEN 'OFFICIAL_STORE' ELSE 'NONE' END AS store_level
FROM supplier WHERE s_suppkey <> 0
"""

_LINE = "l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"

_PRODUCTS = f"""
newest AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, {_LINE}) AS rn
  FROM lineitem WHERE l_suppkey <> 0
),
sp AS (
  SELECT l_partkey AS product_id, 'SKU' || l_partkey AS product_sku, p_name AS product_name,
    'https://shop.example/p' || l_partkey || '?spid=' || l_suppkey AS product_url,
    list_transform(string_split(p_name, ' '), lambda w: 'https://img.example/ts/product/' || w || '.jpg') AS images,
    p_name || ' <img src="' || p_brand || '">' AS description,
    'Size: ' || p_size || chr(10) || 'Brand: ' || p_brand AS specifications,
    CAST(list_position({_list(CATEGORY_TITLES)}, p_type) AS BIGINT) AS category_id,
    p_type || ' / ' || p_brand AS breadcrumbs,
    l_extendedprice AS original_price,
    floor(l_extendedprice * l_discount) AS discount,
    l_extendedprice - floor(l_extendedprice * l_discount) AS price,
    CAST(round(l_discount * 100) AS INTEGER) AS discount_rate,
    l_linestatus = 'F' AS is_authentic, l_tax > 0.04::DOUBLE AS is_freeship_xtra,
    l_discount > 0.07::DOUBLE AS is_top_deal, p_brand LIKE '%1' AS is_top_brand,
    CASE WHEN l_returnflag = 'A' THEN 'Bất cứ lý do gì' WHEN l_returnflag = 'R' THEN 'Sản phẩm hư hỏng'
      WHEN p_size < 30 THEN 'Không đổi trả' ELSE 'wrong_item' END AS return_reason,
    'available' AS inventory_status, l_linestatus AS inventory_type,
    CASE WHEN l_quantity = 1 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity_sold,
    CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '2005-01-01') AS INTEGER) AS day_ago_created,
    CASE WHEN p_brand = 'Brand#25' THEN 0 ELSE CAST(substr(p_brand, 7) AS BIGINT) END AS brand_id,
    CASE WHEN p_brand = 'Brand#25' THEN 'No Brand' ELSE p_brand END AS brand_name,
    CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN string_split(p_name, ' ') ELSE CAST([] AS VARCHAR[]) END AS author_names,
    l_quantity / 10 AS rating_average, l_linenumber * 7 AS review_count,
    l_suppkey + 1000 AS store_id, l_suppkey AS seller_id,
    'S' || l_suppkey || '-' || l_partkey AS seller_sku,
    'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS seller_name,
    'https://shop.example/' || l_suppkey AS seller_url,
    'https://img.example/' || l_suppkey || '.png' AS seller_logo,
    {_warranty(f"({_list(WARRANTY_TEXTS)})[1 + l_partkey % {len(WARRANTY_TEXTS)}]")} AS warranty_period,
    CASE WHEN p_size < 40 THEN 'Điện tử' ELSE 'Không bảo hành' END AS warranty_type,
    CASE WHEN p_size > 10 THEN 'Trung tâm bảo hành' ELSE 'Không bảo hành' END AS warranty_location
  FROM newest JOIN part ON l_partkey = p_partkey WHERE rn = 1
)
"""

_AUTHOR_ID = "CAST('0x' || substr(md5({w}), 1, 8) AS BIGINT)"

_REVIEWS = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey * 8 + l_linenumber ORDER BY {_LINE}) AS rn
  FROM lineitem WHERE l_suppkey <> 0
),
sr AS (
  SELECT l_orderkey * 8 + l_linenumber AS review_id, l_partkey AS product_id, l_suppkey AS seller_id,
    'Order ' || l_orderkey AS title, l_returnflag || ' ' || l_linestatus || ' ' || o_orderpriority AS content,
    'approved' AS status, l_linenumber AS thank_count, 1 + CAST(l_quantity AS INTEGER) % 5 AS rating,
    o_orderdate AS created_at, o_custkey AS customer_id, c_name AS customer_name,
    CASE WHEN l_linenumber < 7 THEN l_shipdate END AS purchased_at,
    'https://img.example/u' || o_custkey AS avatar_url,
    coalesce(({_list(JOINED_TEXTS)})[1 + o_custkey % {len(JOINED_TEXTS)}], '') AS joined_time,
    coalesce(c_nationkey, 0) AS total_review,
    CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS INTEGER) ELSE 0 END AS total_thank,
    {_joined(f"({_list(JOINED_TEXTS)})[1 + o_custkey % {len(JOINED_TEXTS)}]")} AS joined_day
  FROM ranked JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey WHERE rn = 1
)
"""


def _normal(text: str) -> str:
    link = r"((http|https)\:\/\/)?[a-zA-Z0-9\.\/\?\:@\-_=#]+\.([a-zA-Z]){2,6}([a-zA-Z0-9\.\&\/\?\:@\-_=#])*"
    out = f"lower(regexp_replace({text}, '\\p{{Z}}', ' ', 'g'))"
    out = f"regexp_replace({out}, '{link}', '', 'g')"
    out = f"regexp_replace({out}, '[\\r\\n]+', ' ', 'g')"
    out = f"replace(replace({out}, '/', ' '), ',', ' ')"
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')"
    return f"regexp_replace({out}, '\\s{{2,}}', ' ', 'g')"


def _counts(name: str, table: str, key: str, text: str) -> str:
    return f"""
{name} AS (
  SELECT {key}, token, count(*) AS tf
  FROM (SELECT {key}, unnest(string_split_regex({_normal(text)}, '\\s+')) AS token FROM {table})
  WHERE token <> '' GROUP BY {key}, token
)"""


_STOPS = f"SELECT unnest({_list(STOP_WORDS)})"

_INDEX = f"""
{_counts("counts", "documents", "doc_id", "text")},
vocab AS (
  SELECT token, count(*) AS df FROM counts
  WHERE token NOT IN ({_STOPS}) GROUP BY token HAVING count(*) >= 2
),
n AS (SELECT count(*) AS n_docs FROM documents),
raw AS (
  SELECT doc_id, token, df, tf * log2(n_docs / df) AS w FROM counts JOIN vocab USING (token), n WHERE n_docs <> df
),
weights AS (
  SELECT doc_id, token, df, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw
)
"""

ORACLES: dict[str, str] = {}

ORACLES["top_categories_by_quantity"] = """
SELECT p_type AS title, format('{:,}', CAST(sum(l_quantity) AS BIGINT)) AS total_quantity_sold
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY sum(l_quantity) DESC, p_type
"""
ORACLES["silver_sellers"] = _SELLERS
ORACLES["silver_products"] = f"""
WITH {_PRODUCTS}
SELECT * EXCLUDE (images, author_names), array_to_string(images, ' ') AS images_url,
  array_to_string(list_transform(author_names, lambda w: {_AUTHOR_ID.format(w="w")} || ':' || w), ' ') AS authors
FROM sp
"""
ORACLES["silver_reviews"] = f"WITH {_REVIEWS} SELECT * FROM sr"
ORACLES["gold_products"] = f"""
WITH {_PRODUCTS}
SELECT category_id, product_id, seller_id, brand_id, product_name, description, specifications, breadcrumbs,
  original_price, discount, price, discount_rate, quantity_sold, rating_average, review_count, day_ago_created,
  product_url, is_authentic, is_freeship_xtra, is_top_deal, return_reason, inventory_type, warranty_period,
  warranty_type, warranty_location
FROM sp
"""
ORACLES["gold_brands"] = f"WITH {_PRODUCTS} SELECT brand_id, min(brand_name) AS brand_name FROM sp GROUP BY brand_id"
ORACLES["gold_users"] = f"""
WITH {_REVIEWS}
SELECT DISTINCT customer_id AS user_id, customer_name AS user_name, avatar_url, joined_day, joined_time, total_review, total_thank
FROM sr
"""
ORACLES["gold_reviews"] = f"""
WITH {_REVIEWS}
SELECT review_id, product_id, seller_id, title, content, status, thank_count, rating, created_at, customer_id, purchased_at FROM sr
"""
ORACLES["gold_images_url"] = f"WITH {_PRODUCTS} SELECT product_id, seller_id, unnest(images) AS image_url FROM sp"
ORACLES["gold_authors"] = f"""
WITH {_PRODUCTS}, names AS (SELECT DISTINCT unnest(author_names) AS w FROM sp)
SELECT {_AUTHOR_ID.format(w="w")} AS author_id, w AS author_name FROM names
"""
ORACLES["gold_products_authors"] = f"""
WITH {_PRODUCTS}, names AS (SELECT DISTINCT product_id, seller_id, unnest(author_names) AS w FROM sp)
SELECT product_id, seller_id, {_AUTHOR_ID.format(w="w")} AS author_id FROM names
"""

_SIZED = "p_size || ([' năm', ' tháng', ' ngày', 'year', ' Months', ''])[1 + p_partkey % 6]"
ORACLES["warranty_days"] = f"""
WITH t AS (
  SELECT p_partkey, ({_list(WARRANTY_TEXTS)})[1 + p_partkey % {len(WARRANTY_TEXTS)}] AS case_text, {_SIZED} AS sized_text FROM part
)
SELECT p_partkey, {_warranty("case_text")} AS case_days, sized_text, {_warranty("sized_text")} AS sized_days,
  {_warranty("sized_text", "(^|[^0-9])0([^0-9]|$)")} AS lenient_days
FROM t
"""
ORACLES["joined_days"] = f"""
WITH t AS (
  SELECT c_custkey, ({_list(JOINED_TEXTS)})[1 + c_custkey % {len(JOINED_TEXTS)}] AS case_text,
    'Đã tham gia ' || c_nationkey || ([' năm', ' tháng', ' ngày', 'năm'])[1 + c_custkey % 4] AS dated_text
  FROM customer
)
SELECT c_custkey, {_joined("case_text")} AS case_days, dated_text, {_joined("dated_text")} AS dated_days FROM t
"""
ORACLES["json_extract_events"] = """
SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k,
  CASE WHEN event_id % 5 = 0 THEN 'L' || (event_id % 3) ELSE 'none' END AS label FROM events
"""
_REJECT = """CASE WHEN p_size = 17 THEN 'unreadable' WHEN p_size % 9 = 0 THEN 'no category'
  WHEN p_size % 39 = 0 THEN 'author without id' END"""
ORACLES["json_product_flatten"] = f"""
SELECT p_partkey AS product_id, 'SKU' || p_partkey AS product_sku, p_name AS product_name,
  'https://shop.example/p' || p_partkey AS product_url, 'About ' || p_name AS description,
  CASE WHEN p_size = 7 THEN '' ELSE 'Size: ' || p_size || chr(10) || 'Brand: ' || p_brand
    || CASE WHEN p_size % 2 = 1 THEN chr(10) || 'Type: ' || p_type ELSE '' END END AS specifications,
  CASE WHEN p_size % 11 <> 5 THEN CAST(p_size AS BIGINT) ELSE -1 END AS category_id, p_type || ' / ' || p_brand AS breadcrumbs,
  CAST(CAST(p_retailprice AS DECIMAL(15, 2)) AS DOUBLE) AS original_price,
  p_size > 20 AS is_authentic, p_size % 2 = 1 AS is_top_deal, 'any_reason' AS return_reason,
  p_partkey % 10 AS seller_id, 'Seller ' || (p_partkey % 10) AS seller_name,
  CASE WHEN p_size % 4 <> 0 THEN p_name ELSE '' END AS images_url,
  CASE WHEN p_size > 5 THEN CAST(p_size AS BIGINT) ELSE -1 END AS quantity_sold,
  CASE WHEN p_size > 3 THEN CAST(substr(p_brand, 7) AS BIGINT) ELSE -1 END AS brand_id,
  CASE WHEN p_size > 3 THEN p_brand ELSE '' END AS brand_name,
  CASE WHEN p_size % 3 = 0 THEN array_to_string(list_transform(string_split(p_name, ' '), lambda w, i: (p_partkey * 10 + i - 1) || ':' || w), ' ') ELSE '' END AS authors,
  p_size || ' tháng' AS warranty_period, '' AS warranty_type, p_brand AS warranty_location
FROM part WHERE ({_REJECT}) IS NULL
"""
ORACLES["json_product_rejects"] = f"SELECT p_partkey, {_REJECT} AS reason FROM part WHERE ({_REJECT}) IS NOT NULL"
ORACLES["json_mixed_types"] = """
WITH t AS (
  SELECT *, p_partkey % 5 = 3 AS broken, p_partkey % 7 AS r, p_partkey % 5 AS a, p_size % 5 AS u FROM part
)
SELECT p_partkey,
  CASE WHEN broken THEN 'unreadable' WHEN u = 2 THEN 'author without name' WHEN u = 3 THEN 'author without id' ELSE '' END AS reason,
  CASE WHEN broken THEN '' ELSE concat_ws(' ',
    CASE WHEN p_partkey % 4 = 0 THEN 'breadcrumbs[]' ELSE 'breadcrumbs[].category_id' END,
    CASE WHEN p_partkey % 3 = 0 THEN 'brand' END,
    CASE WHEN a = 2 THEN 'rating_average' END,
    CASE WHEN r IN (2, 3, 5) THEN 'review_count' END) END AS unread,
  CASE WHEN broken THEN -1 ELSE p_partkey END AS product_id,
  CAST(CASE WHEN broken OR r IN (2, 3, 4, 5) THEN -1 WHEN r = 6 THEN 7 ELSE 12 END AS BIGINT) AS review_count,
  CAST(CASE WHEN broken OR a = 2 THEN -1 WHEN a = 0 THEN 4.5 WHEN a = 1 THEN 4 ELSE 3.25 END AS DOUBLE) AS rating_average,
  CAST(CASE WHEN broken OR p_partkey % 3 = 0 THEN -1 ELSE p_size END AS BIGINT) AS brand_id,
  CAST(CASE WHEN broken THEN -1 ELSE p_size END AS BIGINT) AS category_id,
  CASE WHEN broken THEN '' WHEN p_partkey % 11 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_name END AS product_name,
  CAST(CASE WHEN broken THEN 0 WHEN u IN (1, 2) THEN 1 WHEN u = 3 THEN 2 ELSE 0 END AS INTEGER) AS n_authors
FROM t
"""
ORACLES["json_seller_flatten"] = """
SELECT s_suppkey AS seller_id, s_name AS seller_name, 'i' || s_suppkey AS icon_url, 'u' || s_suppkey AS store_url,
  s_acctbal AS avg_rating_point, CAST(s_nationkey AS BIGINT) AS review_count, CAST(s_nationkey * 3 AS BIGINT) AS total_follower,
  CAST(s_nationkey * 7 AS BIGINT) AS days_since_joined, s_nationkey > 12 AS is_official, 'TRUSTED' AS store_level
FROM supplier
"""
ORACLES["json_review_explode"] = """
SELECT conv_id * 100 + turn AS review_id, conv_id AS product_id, turn + 1 AS seller_id, role AS title, text AS content,
  'approved' AS status, CAST(turn AS BIGINT) AS thank_count, CAST(1 + turn % 5 AS DOUBLE) AS rating,
  1700000000 + turn AS created_at, conv_id AS customer_id,
  CASE WHEN role = 'system' THEN '' ELSE 'U ' || role END AS customer_name,
  CASE WHEN role = 'system' THEN -1 ELSE 1600000000 + conv_id END AS purchased_at,
  CASE WHEN role = 'system' THEN '' ELSE 'a' END AS avatar_url,
  CASE WHEN role = 'system' THEN '' ELSE '2 tháng' END AS joined_time,
  CASE WHEN role = 'system' THEN 0 ELSE CAST(turn AS BIGINT) END AS total_review,
  CASE WHEN role = 'system' THEN 0 ELSE CAST(3 AS BIGINT) END AS total_thank
FROM conversations
"""
ORACLES["json_review_rejects"] = "SELECT 'no seller' AS reason, count(*) AS n_rows FROM conversations WHERE turn % 3 = 0"
ORACLES["json_listing_pages"] = """
SELECT l_partkey AS pid, l_orderkey + i AS spid, l_suppkey AS seller_id, CAST(l_linenumber AS BIGINT) AS category_id, l_returnflag AS slug
FROM lineitem, (SELECT unnest([0, 1]) AS i)
"""
ORACLES["categories_from_html"] = """
WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) || '/c' || page_id AS href FROM pages)
SELECT DISTINCT regexp_extract(href, '/([^/]+)/c([0-9]+)', 1) AS slug,
  CAST(regexp_extract(href, '/([^/]+)/c([0-9]+)', 2) AS BIGINT) AS category_id FROM links
"""
ORACLES["files_per_category"] = """
WITH parts AS (SELECT string_split(split_part(url, '//', 2), '/') AS p FROM pages),
folders AS (SELECT DISTINCT p[1] AS slug, p[2] AS folder FROM parts WHERE len(p) > 2 AND p[2] <> '')
SELECT slug, count(*) AS n_items FROM folders GROUP BY slug
UNION ALL SELECT '(total)', count(*) FROM folders
"""
ORACLES["incremental_skip"] = """
WITH known AS (SELECT DISTINCT l_partkey AS pid, l_suppkey AS seller_id FROM lineitem WHERE l_linestatus = 'F')
SELECT pid, seller_id, 'known' AS state FROM known
UNION ALL
SELECT pid, seller_id, 'new' FROM (
  SELECT DISTINCT l_partkey AS pid, l_suppkey AS seller_id FROM lineitem EXCEPT SELECT pid, seller_id FROM known)
"""
ORACLES["upsert_customers"] = """
WITH source AS (
  SELECT o_custkey * 2 AS c_custkey, 'Buyer ' || max(o_orderkey) AS c_name, max(o_totalprice) AS c_acctbal FROM orders GROUP BY o_custkey
)
SELECT c_custkey, c_name, c_acctbal FROM source
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM source)
"""
ORACLES["insert_ignore_bridge"] = "SELECT DISTINCT l_partkey AS pid, l_suppkey AS seller_id FROM lineitem"
ORACLES["load_projection"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_custkey AS VARCHAR) AS product_id, CAST(o_custkey % 7 AS VARCHAR) AS seller_id,
  CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS title, o_orderstatus AS content,
  CAST(trunc(o_totalprice) AS INTEGER) AS thank_count, CAST(CAST(o_totalprice / 100000 AS DECIMAL(2, 1)) AS DOUBLE) AS rating,
  o_orderdate AS created_at, o_orderdate AS purchased_at
FROM orders
"""
ORACLES["defaults_applied"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_name, 'https://img.example/' || s_suppkey || '.png' AS icon_url,
  'https://shop.example/' || s_suppkey AS store_url,
  CASE WHEN s_nationkey = 3 THEN 0.0::DOUBLE ELSE CAST(CAST(CAST(s_nationkey AS DOUBLE) / 5 AS DECIMAL(4, 3)) AS DOUBLE) END AS avg_rating_point,
  CASE WHEN floor(s_acctbal) > 0 THEN CAST(floor(s_acctbal) AS INTEGER) ELSE 0 END AS review_count,
  CASE WHEN s_nationkey = 5 THEN 0 ELSE s_nationkey * 100 END AS total_follower, s_nationkey * 10 AS days_since_joined,
  s_acctbal > 5000 AS is_official, CASE WHEN s_acctbal > 5000 THEN 'OFFICIAL_STORE' ELSE 'NONE' END AS store_level
FROM supplier
"""
ORACLES["warehouse_load"] = f"""
WITH {_PRODUCTS}, {_REVIEWS},
names AS (SELECT DISTINCT product_id, seller_id, unnest(author_names) AS w FROM sp),
images AS (SELECT DISTINCT product_id, seller_id, unnest(images) AS u FROM sp),
sizes AS (
  SELECT 'categories' AS table_name, count(DISTINCT p_type) AS n_rows FROM part
  UNION ALL SELECT 'sellers', count(*) FROM supplier WHERE s_suppkey <> 0
  UNION ALL SELECT 'brands', count(DISTINCT brand_id) FROM sp
  UNION ALL SELECT 'authors', count(DISTINCT w) FROM names
  UNION ALL SELECT 'users', count(DISTINCT customer_id) FROM sr
  UNION ALL SELECT 'products', count(*) FROM sp
  UNION ALL SELECT 'products_authors', count(*) FROM names
  UNION ALL SELECT 'images_url', count(*) FROM images
  UNION ALL SELECT 'reviews', count(*) FROM sr
)
SELECT table_name, n_rows, CAST(0 AS BIGINT) AS n_violations FROM sizes
"""
ORACLES["item_key_round_trip"] = """
SELECT l_partkey || '_' || l_suppkey AS item_id, l_partkey AS product_id, l_suppkey AS seller_id, count(*) AS n_rows
FROM lineitem GROUP BY l_partkey, l_suppkey
"""
ORACLES["table_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)
ORACLES["pk_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
"""
ORACLES["fk_violations"] = """
SELECT 'supplier' AS parent, l_suppkey AS value, count(*) AS n_rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY l_suppkey
UNION ALL
SELECT 'part', l_partkey, count(*) FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45) GROUP BY l_partkey
"""
ORACLES["length_violations"] = """
SELECT * FROM (
  SELECT 'p_name' AS "column", 'length 9' AS rule, count(*) FILTER (length(p_name) > 9) AS n_rows FROM part
  UNION ALL SELECT 'p_brand', 'length 7', count(*) FILTER (length(p_brand) > 7) FROM part
  UNION ALL SELECT 'p_type', 'length 5', count(*) FILTER (length(p_type) > 5) FROM part
  UNION ALL SELECT 'p_retailprice', 'decimal(6,2)', count(*) FILTER (TRY_CAST(p_retailprice AS DECIMAL(6, 2)) IS NULL) FROM part
) WHERE n_rows > 0
"""
ORACLES["decimal_conformance"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t.lower()} fits' AS rule, count(TRY_CAST({c} AS {t})) AS n_rows FROM lineitem
    UNION ALL SELECT '{c}', '{t.lower()} overflows', count({c}) - count(TRY_CAST({c} AS {t})) FROM lineitem"""
    for c, t in (("l_extendedprice", "DECIMAL(6,2)"), ("l_quantity", "DECIMAL(2,1)"), ("l_discount", "DECIMAL(4,3)"))
)
ORACLES["value_counts"] = "SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY c_mktsegment"
ORACLES["distinct_values"] = "SELECT DISTINCT event_type FROM events"
ORACLES["table_profile"] = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_values FROM orders"
    for i, (c, t) in enumerate(
        [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
         ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")], 1)
)
ORACLES["multi_author_products"] = """
SELECT p_partkey, CAST(len(list_distinct(string_split(p_name, ' '))) AS INTEGER) AS n_authors FROM part
WHERE p_size % 3 <> 0 AND len(list_distinct(string_split(p_name, ' '))) > 1
"""
ORACLES["sql_point_lookup"] = """
SELECT l_partkey AS product_id, l_suppkey AS seller_id, l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_partkey = 42 AND l_suppkey = 3
"""
ORACLES["brand_or_author_label"] = f"""
WITH {_PRODUCTS}
SELECT product_id, seller_id,
  CASE WHEN len(author_names) > 0 THEN 'Tác giả:' ELSE 'Thương hiệu:' END AS label,
  CASE WHEN len(author_names) > 0 THEN array_to_string(list_sort(list_distinct(author_names)), ',') ELSE brand_name END AS names
FROM sp
"""
ORACLES["product_card"] = f"""
WITH {_PRODUCTS}, named AS (SELECT *, repeat(product_name || ' ', CAST(product_id % 6 + 1 AS BIGINT)) AS long_name FROM sp)
SELECT product_id, seller_id, replace(breadcrumbs, ' / ', ' > ') AS trail,
  CASE WHEN length(long_name) > 54 THEN substr(long_name, 1, 45) || '...' ELSE long_name END AS short_name,
  repeat('★', CAST(floor(rating_average) AS BIGINT)) || repeat('☆', 5 - CAST(floor(rating_average) AS BIGINT)) AS stars,
  format('{{:,}}', CAST(round_even(price, 0) AS BIGINT)) AS price_text,
  CASE WHEN discount_rate > 0 THEN '-' || discount_rate || '%' ELSE '' END AS discount_badge,
  CASE WHEN discount_rate > 0 THEN format('{{:,}}', CAST(round_even(original_price, 0) AS BIGINT)) ELSE '' END AS old_price_text,
  regexp_replace(description, '<img[^>]*>', '', 'g') AS description,
  replace(list_min(images), 'ts/product', 'cache/200x280/ts/product') AS thumbnail
FROM named
"""
ORACLES["recent_purchases_top5"] = f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey * 8 + l_linenumber ORDER BY {_LINE}) AS rn FROM lineitem
), bought AS (
  SELECT o_custkey AS customer_id, l_orderkey * 8 + l_linenumber AS review_id, l_partkey AS product_id, l_suppkey AS seller_id,
    l_shipdate AS purchased_at,
    row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate DESC, l_orderkey * 8 + l_linenumber) AS r
  FROM ranked JOIN orders ON l_orderkey = o_orderkey WHERE rn = 1
)
SELECT customer_id, CAST(r AS INTEGER) AS rank, review_id, product_id, seller_id, purchased_at FROM bought WHERE r <= 5
"""
ORACLES["normalized_text"] = f"""
SELECT 'document' AS kind, doc_id AS id, {_normal("text")} AS text FROM documents
UNION ALL SELECT 'page', page_id, {_normal("html")} FROM pages
"""
ORACLES["token_frequency_top200"] = f"""
WITH tokens AS (
  SELECT unnest(regexp_extract_all(lower(role || ' ' || text), '[\\p{{L}}\\p{{N}}_]+')) AS token FROM conversations
)
SELECT token, count(*) AS n FROM tokens WHERE length(token) > 2 AND token NOT IN ({_STOPS})
GROUP BY token ORDER BY n DESC, token LIMIT 200
"""
ORACLES["vocab"] = f"WITH {_INDEX} SELECT token, df FROM vocab"
ORACLES["tfidf_weights"] = f"WITH {_INDEX} SELECT doc_id, token, round(weight, 6) AS weight FROM weights"
ORACLES["tfidf_documented"] = f"""
WITH {_INDEX}, lengths AS (SELECT doc_id, sum(tf) AS length FROM counts GROUP BY doc_id)
SELECT doc_id, token, round(tf / length * ln(n_docs / (1 + df)), 6) AS weight
FROM counts JOIN vocab USING (token) JOIN lengths USING (doc_id), n
"""
ORACLES["search_top10"] = f"""
WITH {_INDEX}, {_counts("asked", "benchmark", "item_id", "text")},
qraw AS (SELECT item_id, token, tf * log2(n_docs / df) AS w FROM asked JOIN vocab USING (token), n),
q AS (SELECT item_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM qraw),
scores AS (SELECT item_id, doc_id, round(sum(w * weight), 6) AS score FROM q JOIN weights USING (token) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score >= 0.1)
SELECT item_id, doc_id, score, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10
"""
ORACLES["similar_documents_top10"] = f"""
WITH {_INDEX},
scores AS (
  SELECT a.doc_id AS for_doc_id, b.doc_id, round(sum(a.weight * b.weight), 6) AS score
  FROM weights a JOIN weights b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY for_doc_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score >= 0.1)
SELECT for_doc_id, doc_id, score, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10
"""


def _product_index(text: str) -> str:
    return f"""
WITH {_PRODUCTS},
counts AS (
  SELECT product_id, seller_id, token, count(*) AS tf
  FROM (SELECT product_id, seller_id, unnest(string_split_regex({_normal(text)}, '\\s+')) AS token FROM sp)
  WHERE token <> '' GROUP BY ALL
),
vocab AS (SELECT token, count(*) AS df FROM counts GROUP BY token HAVING count(*) >= 2),
n AS (SELECT count(*) AS n_docs FROM sp),
raw AS (SELECT product_id, seller_id, token, tf * log2(n_docs / df) AS w FROM counts JOIN vocab USING (token), n WHERE n_docs <> df),
weights AS (SELECT product_id, seller_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY product_id, seller_id)) AS weight FROM raw)"""


ORACLES["product_search_top10"] = f"""
{_product_index("product_name || ' ' || breadcrumbs")},
asked AS (SELECT DISTINCT p_type || ' ' || p_brand AS query FROM part),
qcounts AS (
  SELECT query, token, count(*) AS tf FROM (SELECT query, unnest(string_split_regex({_normal("query")}, '\\s+')) AS token FROM asked)
  WHERE token <> '' GROUP BY ALL
),
qraw AS (SELECT query, token, tf * log2(n_docs / df) AS w FROM qcounts JOIN vocab USING (token), n),
q AS (SELECT query, token, w / sqrt(sum(w * w) OVER (PARTITION BY query)) AS w FROM qraw),
scores AS (SELECT query, product_id, seller_id, round(sum(w * weight), 6) AS score FROM q JOIN weights USING (token) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, product_id, seller_id) AS r FROM scores WHERE score >= 0.1)
SELECT query, product_id, seller_id, score, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10
"""
ORACLES["similar_to_product"] = f"""
{_product_index("product_name || ' ' || description || ' ' || specifications")},
wanted AS (SELECT l_partkey AS p, min(l_suppkey) AS s FROM lineitem WHERE l_suppkey <> 0 AND l_partkey % 100 = 0 GROUP BY l_partkey),
scores AS (
  SELECT a.product_id AS for_product_id, a.seller_id AS for_seller_id, b.product_id, b.seller_id, round(sum(a.weight * b.weight), 6) AS score
  FROM weights a JOIN wanted ON a.product_id = p AND a.seller_id = s JOIN weights b USING (token)
  WHERE a.product_id <> b.product_id OR a.seller_id <> b.seller_id GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY for_product_id, for_seller_id ORDER BY score DESC, product_id, seller_id) AS r
  FROM scores WHERE score >= 0.1
)
SELECT for_product_id, for_seller_id, product_id, seller_id, score, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10
"""
# Offers of one part share a text here too.
ORACLES["similar_to_offers"] = f"""
{_product_index("product_name || ' ' || description || ' ' || specifications")},
w AS MATERIALIZED (SELECT product_id, token, any_value(weight) AS w FROM weights GROUP BY ALL),
offers AS MATERIALIZED (SELECT DISTINCT product_id, seller_id FROM weights),
scores AS MATERIALIZED (
  SELECT a.product_id AS p, b.product_id AS q, round(sum(a.w * b.w), 6) AS score FROM w a JOIN w b USING (token) WHERE a.product_id % 100 = 0 GROUP BY ALL
),
ranked AS (
  SELECT a.product_id AS for_product_id, a.seller_id AS for_seller_id, b.product_id, b.seller_id, score,
    row_number() OVER (PARTITION BY a.product_id, a.seller_id ORDER BY score DESC, b.product_id, b.seller_id) AS r
  FROM offers a JOIN scores ON a.product_id = p JOIN offers b ON b.product_id = q
  WHERE score >= 0.1 AND (a.product_id <> b.product_id OR a.seller_id <> b.seller_id)
)
SELECT for_product_id, for_seller_id, product_id, seller_id, score, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10
"""
ORACLES["picks_with_names"] = """
WITH bought AS (
  SELECT o_custkey AS customer_id, l_partkey AS product_id, l_suppkey AS seller_id, sum(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY rating DESC, product_id, seller_id) AS r FROM bought)
SELECT customer_id, CAST(r AS INTEGER) AS rank, product_id, seller_id, rating, CASE WHEN product_id % 4 <> 0 THEN p_name ELSE '' END AS product_name
FROM ranked JOIN part ON p_partkey = product_id WHERE r <= 5
"""
ORACLES["found_lines"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_partkey = 7)
SELECT *, 'product' AS by FROM r UNION ALL SELECT *, 'offer' FROM r WHERE l_suppkey = 3
"""
ORACLES["als_exact_top10"] = """
WITH n AS (SELECT count(*) AS items FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))
SELECT DISTINCT o_custkey AS customer_id, least(10, items) AS n_picks, true AS agrees
FROM lineitem JOIN orders ON l_orderkey = o_orderkey, n WHERE o_custkey % 100 = 0
"""
ORACLES["als_properties"] = """
WITH n AS (SELECT count(*) AS items FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))
SELECT DISTINCT o_custkey AS customer_id, least(20, items) AS n_picks, true AS ranks_whole, true AS ratings_fall, true AS items_known
FROM lineitem JOIN orders ON l_orderkey = o_orderkey, n
"""
ORACLES["factors_top10"] = """
WITH scores AS (
  SELECT u.vec_id AS user_id, i.vec_id AS item_id,
    round(list_sum(list_transform(list_zip(u.embedding, i.embedding), lambda p: CAST(p[1] AS DOUBLE) * p[2])), 4) AS score
  FROM embeddings u, embeddings i WHERE u.vec_id % 100 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM scores)
SELECT user_id, item_id, score, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10
"""
ORACLES["file_sources"] = """
WITH pages AS (SELECT p_type, p_brand, count(*) AS sold, max(p_size) AS size FROM part GROUP BY ALL)
SELECT 'folders' AS what, p_type AS name, count(*) AS n FROM pages GROUP BY p_type
UNION ALL SELECT 'folders', '(total)', count(*) FROM pages
UNION ALL SELECT 'products', 'sold', CAST(sum(sold) AS BIGINT) FROM pages WHERE size % 2 = 0
UNION ALL SELECT 'rejects', 'no category', count(*) FROM pages WHERE size % 2 <> 0 HAVING count(*) > 0
UNION ALL SELECT 'words', lower(p_type), length(p_type) FROM (SELECT DISTINCT p_type FROM part)
UNION ALL SELECT 'tracking', 'rows', 0
"""
ORACLES["file_documents"] = f"""
SELECT 'kept' AS what, substr(p_brand, 7) AS name, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS ids FROM part WHERE ({_REJECT}) IS NULL GROUP BY p_brand
UNION ALL SELECT 'refused', {_REJECT}, count(*), 0 FROM part WHERE ({_REJECT}) IS NOT NULL GROUP BY ALL
"""
# Offers of one part share a text, so the SQL scores parts and expands them.
ORACLES["similar_products_top10"] = """
WITH offers AS (SELECT DISTINCT l_partkey AS product_id, l_suppkey AS seller_id FROM lineitem),
sold AS (SELECT product_id, count(*) AS n_offers FROM offers GROUP BY product_id),
counts AS (
  SELECT product_id, n_offers, token, count(*) AS tf FROM (
    SELECT p_partkey AS product_id, n_offers,
      unnest(string_split(lower(p_name || ' ' || replace(p_brand, '#', '') || ' ' || p_type || ' size' || p_size), ' ')) AS token
    FROM part JOIN sold ON p_partkey = product_id) GROUP BY ALL
),
vocab AS (SELECT token, sum(n_offers) AS df FROM counts GROUP BY token HAVING sum(n_offers) >= 2),
n AS (SELECT count(*) AS n FROM offers),
raw AS (SELECT product_id, token, tf * log2(n / df) AS w FROM counts JOIN vocab USING (token), n),
weights AS (SELECT product_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY product_id)) AS w FROM raw),
scores AS (
  SELECT a.product_id AS p, b.product_id AS q, round(sum(a.w * b.w), 6) AS score
  FROM weights a JOIN weights b USING (token) GROUP BY a.product_id, b.product_id
),
near AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY score DESC, q) AS r FROM scores WHERE score >= 0.1) WHERE r <= 40
),
first_offers AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seller_id) AS r FROM offers) WHERE r <= 11
),
shortlist AS (
  SELECT * FROM (
    SELECT near.p, f.product_id, f.seller_id, score, row_number() OVER (PARTITION BY near.p ORDER BY score DESC, f.product_id, f.seller_id) AS r
    FROM near JOIN first_offers f ON near.q = f.product_id) WHERE r <= 11
),
ranked AS (
  SELECT o.product_id AS for_product_id, o.seller_id AS for_seller_id, s.product_id, s.seller_id, s.score,
    row_number() OVER (PARTITION BY o.product_id, o.seller_id ORDER BY s.score DESC, s.product_id, s.seller_id) AS r
  FROM offers o JOIN shortlist s ON o.product_id = s.p AND (o.product_id <> s.product_id OR o.seller_id <> s.seller_id)
)
SELECT for_product_id, for_seller_id, product_id, seller_id, score, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10
"""
ORACLES["item_index"] = """
SELECT l_partkey || '_' || l_suppkey AS item_id, count(*) AS n_ratings,
  row_number() OVER (ORDER BY count(*) DESC, l_partkey || '_' || l_suppkey) - 1 AS item_index
FROM lineitem GROUP BY l_partkey, l_suppkey
"""
ORACLES["file_format_round_trip"] = """
SELECT 'csv' AS format, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum, CAST(sum(length(c_name)) AS BIGINT) AS name_chars FROM customer
UNION ALL SELECT 'json', count(*), CAST(sum(p_partkey) AS BIGINT), CAST(sum(length(p_name)) AS BIGINT) FROM part
UNION ALL SELECT 'parquet', count(*), CAST(sum(s_suppkey) AS BIGINT), CAST(sum(length(s_name)) AS BIGINT) FROM supplier
"""
ORACLES["stream_documents"] = f"""
WITH g AS (SELECT *, len(string_split(p_name, ' ')) AS n_words FROM part WHERE ({_REJECT}) IS NULL)
SELECT 'stored' AS what, 'categories' AS name, count(DISTINCT CASE WHEN p_size % 11 <> 5 THEN p_size END) AS n_rows FROM g
UNION ALL SELECT 'stored', 'sellers', count(DISTINCT p_partkey % 10) FROM g WHERE p_partkey % 10 <> 0
UNION ALL SELECT 'stored', 'brands', count(DISTINCT CASE WHEN p_size > 3 THEN substr(p_brand, 7) ELSE 'none' END) FROM g
UNION ALL SELECT 'stored', 'authors', CAST(coalesce(sum(n_words), 0) AS BIGINT) FROM g WHERE p_size % 3 = 0
UNION ALL SELECT 'stored', 'products', count(*) FROM g WHERE p_partkey % 10 <> 0
UNION ALL SELECT 'renewed', 'products', count(*) FROM g WHERE p_partkey % 10 = 4
UNION ALL SELECT 'document', {_REJECT}, CAST(sum(CASE WHEN p_partkey % 10 = 4 THEN 2 ELSE 1 END) AS BIGINT) FROM part WHERE ({_REJECT}) IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'product', 'no sellers', count(*) FROM g WHERE p_partkey % 10 = 0 HAVING count(*) > 0
"""
ORACLES["stream_incremental_upsert"] = """
WITH ranked AS (
  SELECT event_id, user_id, event_type, value,
    row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'purchase' DESC, event_id DESC) AS r
  FROM events
)
SELECT event_id, user_id, event_type, value FROM ranked WHERE r = 1
"""
ORACLES["stream_two_sources"] = """
WITH ranked AS (
  SELECT event_id, user_id, event_type, value,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, event_id DESC) AS r
  FROM events
)
SELECT event_id, user_id, event_type, value FROM ranked WHERE r = 1
"""
ORACLES["stream_new_keys"] = """
SELECT user_id, CAST(min(CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END) AS INTEGER) AS drop_no
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
"""
ORACLES["stream_skip_known"] = """
WITH ranked AS (
  SELECT event_id, user_id, event_type, value,
    row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'signup' DESC, event_id) AS r
  FROM events
)
SELECT event_id, user_id, event_type, value FROM ranked WHERE r = 1
"""
ORACLES["load_rejects"] = f"""
WITH {_PRODUCTS},
s AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey <> 0),
stored AS (SELECT k FROM s WHERE k % 3 = 0 OR (k % 3 = 1 AND k % 4 = 0))
SELECT 'categories' AS table_name, 'stored' AS tag, '' AS reason, count(DISTINCT p_type) AS n_rows FROM part
UNION ALL SELECT 'sellers', 'stored', '', count(*) FROM stored
UNION ALL SELECT 'brands', 'stored', '', count(DISTINCT brand_id) FROM sp
UNION ALL SELECT 'products', 'stored', '', count(*) FROM sp WHERE seller_id IN (SELECT k FROM stored)
UNION ALL SELECT 'products', 'day1', 'no sellers', count(*) FROM sp WHERE seller_id % 3 <> 0 HAVING count(*) > 0
UNION ALL SELECT 'products', 'day2', 'no sellers', count(*) FROM sp WHERE seller_id NOT IN (SELECT k FROM stored) HAVING count(*) > 0
UNION ALL SELECT 'sellers', 'day2',
  CASE k % 4 WHEN 1 THEN 'store_level length 32' WHEN 2 THEN 'avg_rating_point decimal(4,3)' ELSE 'seller_id not null' END, count(*)
FROM s WHERE k % 3 = 1 AND k % 4 <> 0 GROUP BY ALL
"""
ORACLES["load_guards"] = f"""
WITH {_PRODUCTS},
b AS (SELECT DISTINCT brand_id FROM sp WHERE brand_id IS NOT NULL)
SELECT 'brands' AS table_name, '' AS reason, count(*) AS n_rows FROM b WHERE brand_id % 2 <> 0 OR brand_id % 3 <> 0
UNION ALL SELECT 'brands', 'brand_id not null', CAST(count_if(brand_id % 2 = 0) + count_if(brand_id % 3 = 0) AS BIGINT) FROM b
UNION ALL SELECT 'products_authors', '', 0
UNION ALL SELECT 'products_authors', 'no products; no authors', count(*) FROM ({ORACLES["gold_products_authors"]})
UNION ALL SELECT 'users', '', count(DISTINCT user_id) FROM events WHERE event_id % 7 <> 0
UNION ALL SELECT 'users', 'no key', count(*) FROM events WHERE event_id % 7 = 0 OR user_id IS NULL
"""
ORACLES["stream_partition_upsert"] = ORACLES["stream_incremental_upsert"]
ORACLES["index_by_drops"] = f"WITH {_INDEX} SELECT doc_id, token, df, round(weight, 6) AS weight FROM weights"

_PHRASES = f"""
lists AS (SELECT doc_id, list_filter(string_split_regex({_normal("text")}, '\\s+'), lambda x: x <> '') AS t FROM documents),
places AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM lists),
neighbours AS (SELECT doc_id, pos, token AS a, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM places),
single AS (SELECT token, count(*) AS m FROM places GROUP BY token),
chance AS (
  SELECT p.a, p.b, p.n, round(log2(p.n * CAST((SELECT sum(m) FROM single) AS DOUBLE) / (CAST(x.m AS DOUBLE) * y.m)), 6) AS pmi
  FROM (SELECT a, b, count(*) AS n FROM neighbours WHERE b IS NOT NULL GROUP BY a, b HAVING count(*) >= 20) p
  JOIN single x ON x.token = p.a JOIN single y ON y.token = p.b
),
pairs AS (SELECT a, b, n, pmi FROM chance WHERE pmi >= 5)
"""
ORACLES["phrase_table"] = f"WITH {_PHRASES} SELECT a, b, n, pmi FROM pairs"
ORACLES["phrase_vocab"] = f"""
WITH {_PHRASES},
found AS (
  SELECT doc_id, pos, a, b, pos - row_number() OVER w AS run, coalesce(lead(pos) OVER w > pos + 1, true) AS last
  FROM neighbours SEMI JOIN pairs USING (a, b) WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
placed AS (SELECT *, pos - min(pos) OVER (PARTITION BY doc_id, run) AS o FROM found),
parts AS (
  SELECT doc_id, run, o, a AS token FROM placed
  UNION ALL SELECT doc_id, run, o + 1, b FROM placed WHERE last
),
cut AS (
  SELECT doc_id, run, o // 3 AS w, string_agg(token, '_' ORDER BY o) AS word FROM parts GROUP BY ALL HAVING count(*) > 1
),
changes AS (
  SELECT doc_id, token, count(*) AS tf FROM places GROUP BY ALL
  UNION ALL SELECT doc_id, word, 1 FROM cut
  UNION ALL SELECT p.doc_id, p.token, -1 FROM parts p SEMI JOIN cut c ON c.doc_id = p.doc_id AND c.run = p.run AND c.w = p.o // 3
),
counted AS (SELECT doc_id, token FROM changes GROUP BY ALL HAVING sum(tf) > 0)
SELECT token, count(*) AS df FROM counted WHERE token NOT IN (SELECT unnest({_list([*STOP_WORDS, *STOP_PHRASES])}))
GROUP BY token HAVING count(*) >= 2
"""
ORACLES["bucketed_existence"] = """
SELECT coalesce(o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'), false) AS inside,
  o_orderpriority, count(*) AS n_orders
FROM orders GROUP BY ALL
"""
