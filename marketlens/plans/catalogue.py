"""The registered queries. Each takes a session and a folder of star-schema Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.functions import cleaning as C
from marketlens.functions import display as X
from marketlens.functions import text as TX
from marketlens.operators import checks, collab, documents, keys, load, phrases, profile, serving, similarity, terms, text_index
from marketlens.operators.keys import spread
from marketlens.plans import gold, recommend, silver, star
from marketlens.plans.warehouse import load_table, load_warehouse, open_warehouse, read_rejects
from marketlens.schemas import LISTING_DOC, TRACKING_CSV, UNREAD, WAREHOUSE, Column, TableSpec
from marketlens.session import fresh_path, staged
from marketlens.sources import files
from marketlens.sources.bucketed import write_bucketed
from marketlens.sources.partitioned import read_partitioned
from marketlens.sources.versions import read_current
from marketlens.streaming import documents as doc_stream
from marketlens.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Function words of the four languages of the test texts.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "as", "was", "for", "with", "this", "are", "by", "from", "at",
    "der", "die", "das", "und", "ist", "nicht", "mit", "für", "auf", "den", "des", "ein", "eine", "zu", "im",
    "la", "le", "les", "et", "un", "une", "du", "en", "que", "qui", "dans", "pour", "avec", "au", "pas", "sur",
    "el", "los", "las", "por", "con", "para", "se", "del", "como", "su", "al", "lo",
]
# Joined words that are left out of the vocabulary with joined words.
STOP_PHRASES = ["of_the", "in_the", "de_la"]
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _pairs_text(pairs, left: str, right: str):
    """An array of structs as "left:right" words, for results without nested columns."""
    return F.array_join(F.transform(pairs, lambda p: F.concat(p[left].cast("string"), F.lit(":"), p[right])), " ")


# --- cleaned tables -------------------------------------------------------------------------


@query
def top_categories_by_quantity(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity sold per category title. Lines are summed per part before they meet the parts."""
    sold = star.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity_sold"))
    part = star.table(spark, sf, "part").select("p_partkey", F.lower("p_type").alias("category_id"))
    products = sold.join(part, sold.l_partkey == part.p_partkey)
    titles = star.categories(spark, sf).select(F.col("slug").alias("category_id"), "title")
    return serving.quantity_by_category(products, titles)


@query
def silver_sellers(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_sellers(star.sellers(spark, sf))


def _silver_products(spark: SparkSession, sf: str) -> DataFrame:
    sellers = silver.silver_sellers(star.sellers(spark, sf), [F.col("seller_name")])
    return silver.silver_products(star.listings(spark, sf), sellers, unique=True)


def _silver_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_reviews(star.review_rows(spark, sf), star.offer_keys(spark, sf), unique=True)


@query
def silver_products(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_products(spark, sf).withColumns(
        {
            "images_url": F.array_join("images_url", " "),
            "authors": F.coalesce(_pairs_text(F.col("authors"), "author_id", "author_name"), F.lit("")),
        }
    )


@query
def silver_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_reviews(spark, sf).withColumns(
        {
            "created_at": F.col("created_at").cast("timestamp_ntz"),
            "purchased_at": F.col("purchased_at").cast("timestamp_ntz"),
            "joined_time": F.coalesce("joined_time", F.lit("")),
        }
    )


# --- normalised tables ----------------------------------------------------------------------


@query
def gold_products(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_products(_silver_products(spark, sf))


@query
def gold_brands(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_brands(_silver_products(spark, sf))


@query
def gold_users(spark: SparkSession, sf: str) -> DataFrame:
    users = gold.gold_users(_silver_reviews(spark, sf))
    return users.withColumn("joined_time", F.coalesce("joined_time", F.lit("")))


@query
def gold_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_reviews(_silver_reviews(spark, sf)).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "purchased_at")}
    )


@query
def gold_images_url(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_images(_silver_products(spark, sf))


@query
def gold_authors(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_authors(_silver_products(spark, sf))


@query
def gold_products_authors(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_products_authors(_silver_products(spark, sf))


# --- scalar rules ---------------------------------------------------------------------------


@query
def warranty_days(spark: SparkSession, sf: str) -> DataFrame:
    part = star.table(spark, sf, "part")
    cases = F.expr(f"get({star.sql_list(star.WARRANTY_TEXTS)}, cast(p_partkey % {len(star.WARRANTY_TEXTS)} as int))")
    sized = F.concat("p_size", F.expr("get(array(' năm', ' tháng', ' ngày', 'year', ' Months', ''), cast(p_partkey % 6 as int))"))
    return part.select(
        "p_partkey",
        C.warranty_days(cases).alias("case_days"),
        sized.alias("sized_text"),
        C.warranty_days(sized).alias("sized_days"),
        C.warranty_days(sized, strict_zero=False).alias("lenient_days"),
    )


@query
def joined_days(spark: SparkSession, sf: str) -> DataFrame:
    customer = star.table(spark, sf, "customer")
    cases = F.expr(f"get({star.sql_list(star.JOINED_TEXTS)}, cast(c_custkey % {len(star.JOINED_TEXTS)} as int))")
    dated = F.concat(F.lit("Đã tham gia "), "c_nationkey", F.expr("get(array(' năm', ' tháng', ' ngày', 'năm'), cast(c_custkey % 4 as int))"))
    return customer.select("c_custkey", C.joined_days(cases).alias("case_days"), dated.alias("dated_text"), C.joined_days(dated).alias("dated_days"))


# --- nested documents -----------------------------------------------------------------------


@query
def json_extract_events(spark: SparkSession, sf: str) -> DataFrame:
    """A known key, and one that only every fifth event has, with its default."""
    labelled = F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', "label": "L'), F.expr("event_id % 3"), F.lit('"}'))
    props = F.from_json(F.when(F.expr("event_id % 5 = 0"), labelled).otherwise(F.col("props")), "k int, label string")
    parsed = star.table(spark, sf, "events").select("event_id", props.alias("p"))
    return parsed.select("event_id", "p.k", F.coalesce("p.label", F.lit("none")).alias("label"))


def _product_documents(spark: SparkSession, sf: str, brands: bool = False) -> DataFrame:
    """One product document per part as JSON text; some unreadable, some without category.

    Parts are dealt to tasks while they are narrow, as their table may be one small block of a file. With ``brands``
    each document has the brands of its key beside it, joined before the documents are made.
    """
    pair = "struct<name:string,value:string>"
    part = star.table(spark, sf, "part")
    if brands:
        part = part.join(part.select("p_partkey", F.col("p_brand").alias("brand")), "p_partkey")
    doc = spread(part).selectExpr(
        "p_partkey",
        "p_size",
        *(["brand"] if brands else []),
        f"""to_json(named_struct(
            'id', p_partkey, 'sku', concat('SKU', p_partkey), 'name', p_name,
            'short_url', concat('https://shop.example/p', p_partkey), 'description', concat('About ', p_name),
            'images', case when p_size % 4 <> 0 then transform(split(p_name, ' '), w -> named_struct('base_url', w)) end,
            'specifications', case when p_size <> 7 then array(
                named_struct('attributes', array(
                    named_struct('name', 'Size', 'value', cast(p_size as string)),
                    named_struct('name', 'Brand', 'value', p_brand))),
                named_struct('attributes', case when p_size % 2 = 1 then array(
                    named_struct('name', 'Type', 'value', p_type)) end)) end,
            'breadcrumbs', case when p_size % 9 = 0
                then cast(array() as array<struct<category_id:bigint,name:string>>)
                else array(
                    named_struct('category_id', case when p_size % 11 <> 5 then cast(p_size as bigint) end, 'name', p_type),
                    named_struct('category_id', cast(100 as bigint), 'name', p_brand),
                    named_struct('category_id', cast(null as bigint), 'name', p_name)) end,
            'list_price', cast(p_retailprice as decimal(15,2)),
            'tracking_info', named_struct('amplitude', named_struct(
                'is_authentic', p_size > 20, 'is_hero', p_size % 2, 'return_reason', 'any_reason')),
            'all_time_quantity_sold', case when p_size > 5 then p_size end,
            'brand', case when p_size > 3 then named_struct('id', cast(substring(p_brand, 7) as bigint), 'name', p_brand) end,
            'authors', case when p_size % 3 = 0 then transform(split(p_name, ' '),
                (w, i) -> named_struct('id', case when p_size % 13 <> 0 then p_partkey * 10 + i end, 'name', w)) end,
            'current_seller', named_struct('id', p_partkey % 10, 'name', concat('Seller ', p_partkey % 10)),
            'warranty_info', cast(array(
                named_struct('name', 'Thời gian bảo hành', 'value', '1 năm'),
                named_struct('name', 'thời gian BẢO HÀNH', 'value', concat(p_size, ' tháng')),
                named_struct('name', 'Nơi bảo hành', 'value', p_brand),
                named_struct('name', 'Khác', 'value', 'x')) as array<{pair}>)
        )) as doc""",
    )
    broken = F.when(F.col("p_size") == 17, F.substring("doc", 1, 30)).otherwise(F.col("doc"))
    return doc.select("p_partkey", *(["brand"] if brands else []), broken.alias("doc"))


@query
def json_product_flatten(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = documents.split_products(files.parse_documents(_product_documents(spark, sf), "doc", "products"))
    return documents.product_rows(good).select(
        "product_id", "product_sku", "product_name", "product_url", "description", "specifications",
        F.coalesce("category_id", F.lit(-1)).alias("category_id"),
        "breadcrumbs", F.col("original_price").cast("double").alias("original_price"), "is_authentic", "is_top_deal", "return_reason", "seller_id", "seller_name",
        F.array_join("images_url", " ").alias("images_url"),
        F.coalesce("quantity_sold", F.lit(-1)).alias("quantity_sold"),
        F.coalesce("brand_id", F.lit(-1)).alias("brand_id"),
        F.coalesce("brand_name", F.lit("")).alias("brand_name"),
        _pairs_text(F.col("authors"), "author_id", "author_name").alias("authors"),
        "warranty_period",
        F.coalesce("warranty_type", F.lit("")).alias("warranty_type"),
        "warranty_location",
    )


@query
def json_product_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = documents.split_products(files.parse_documents(_product_documents(spark, sf), "doc", "products"))
    return bad.select("p_partkey", "reason")


@query
def json_mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """One document per part whose values vary in type; what does not convert is null and reported."""
    doc = """concat('{"id": ', if(p_partkey % 2 = 0, concat('"', p_partkey, '"'), concat(p_partkey, '.0')),
        ', "name": ', if(p_partkey % 11 = 0, string(p_size), concat('"', p_name, '"')),
        ', "review_count": ', get(array('"12"', '12.0', '12.5', '"many"', 'null', '[1]', '7'), cast(p_partkey % 7 as int)),
        ', "rating_average": ', get(array('"4.5"', '4', '{"x": 1}', 'true and', '3.25'), cast(p_partkey % 5 as int)),
        ', "brand": ', if(p_partkey % 3 = 0, '"none"', concat('{"id": "', p_size, '", "name": "', p_brand, '"}')),
        ', "breadcrumbs": [{"category_id": "', p_size, '", "name": "a"}, ', if(p_partkey % 4 = 0, '5', '{"category_id": 1.5}'), ']',
        get(array('', ', "authors": [{"id": 1, "name": null}]', ', "authors": [{"id": 1}]', ', "authors": [{"name": "x"}, {"id": 2, "name": "y"}]', ', "authors": null'), cast(p_size % 5 as int)),
        '}')"""
    parsed = files.parse_documents(star.table(spark, sf, "part").selectExpr("p_partkey", f"{doc} as doc"), "doc", "products")
    judged = parsed.withColumn("reason", documents.reject_reason())
    rows = documents.product_rows(judged, ["p_partkey", "reason", UNREAD])
    return rows.select(
        "p_partkey", F.coalesce("reason", F.lit("")).alias("reason"), F.array_join(UNREAD, " ").alias("unread"),
        *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("product_id", "review_count", "rating_average", "brand_id", "category_id")),
        F.coalesce("product_name", F.lit("")).alias("product_name"), F.size("authors").alias("n_authors"),
    )


@query
def json_seller_flatten(spark: SparkSession, sf: str) -> DataFrame:
    text = star.table(spark, sf, "supplier").selectExpr(
        """to_json(named_struct('data', named_struct('seller', named_struct(
            'id', s_suppkey, 'name', s_name, 'icon', concat('i', s_suppkey), 'url', concat('u', s_suppkey),
            'avg_rating_point', s_acctbal, 'review_count', s_nationkey, 'total_follower', s_nationkey * 3,
            'days_since_joined', s_nationkey * 7, 'is_official', s_nationkey > 12, 'store_level', 'TRUSTED')))) as doc"""
    )
    good, _ = documents.split_readable(files.parse_documents(text, "doc", "sellers"))
    return documents.seller_rows(good)


def _review_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One review page per conversation turn; every third page also has a comment without seller."""
    text = star.table(spark, sf, "conversations").selectExpr(
        """to_json(named_struct('data', filter(array(
            named_struct('id', conv_id * 100 + turn, 'product_id', conv_id, 'seller', named_struct('id', turn + 1),
                'title', role, 'content', text, 'status', 'approved', 'thank_count', turn, 'rating', 1 + turn % 5,
                'created_at', 1700000000 + turn, 'customer_id', conv_id,
                'created_by', case when role <> 'system' then named_struct('full_name', concat('U ', role),
                    'purchased_at', 1600000000 + conv_id, 'avatar_url', 'a',
                    'contribute_info', named_struct('summary', named_struct('joined_time', '2 tháng',
                        'total_review', turn, 'total_thank', 3))) end),
            named_struct('id', -turn - 1, 'product_id', conv_id, 'seller', cast(null as struct<id:bigint>),
                'title', 'lost', 'content', '', 'status', '', 'thank_count', turn, 'rating', turn,
                'created_at', turn, 'customer_id', conv_id, 'created_by', null)),
            (c, i) -> i = 0 or turn % 3 = 0))) as doc"""
    )
    return files.parse_documents(text, "doc", "reviews")


@query
def json_review_explode(spark: SparkSession, sf: str) -> DataFrame:
    comments, _ = documents.split_comments(_review_pages(spark, sf))
    return documents.review_rows(comments).withColumns(
        {
            "customer_name": F.coalesce("customer_name", F.lit("")),
            "avatar_url": F.coalesce("avatar_url", F.lit("")),
            "joined_time": F.coalesce("joined_time", F.lit("")),
            "purchased_at": F.coalesce("purchased_at", F.lit(-1)),
        }
    )


@query
def json_review_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = documents.split_comments(_review_pages(spark, sf))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def json_listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Category listing pages: the offers of a page, with the category and slug of the page."""
    pages = star.table(spark, sf, "lineitem").selectExpr(
        """to_json(named_struct('data', array(
            named_struct('id', l_partkey, 'seller_product_id', l_orderkey, 'seller_id', l_suppkey),
            named_struct('id', l_partkey, 'seller_product_id', l_orderkey + 1, 'seller_id', l_suppkey)))) as doc""",
        "cast(l_linenumber as bigint) as category", "l_returnflag as page_slug",
    )
    parsed = pages.select("category", "page_slug", F.from_json("doc", LISTING_DOC).alias("d")).select("category", "page_slug", "d.data")
    return documents.listing_rows(parsed, F.col("category"), F.col("page_slug"))


@query
def categories_from_html(spark: SparkSession, sf: str) -> DataFrame:
    """Slugs and ids out of page links; the page number stands in for the category id."""
    links = star.table(spark, sf, "pages").select("page_id", F.explode(TX.page_links(F.col("html"))).alias("link"))
    href = F.concat("link", F.lit("/c"), "page_id")
    return links.select(X.link_slug(href).alias("slug"), X.link_category(href).alias("category_id")).distinct()


@query
def files_per_category(spark: SparkSession, sf: str) -> DataFrame:
    paths = star.table(spark, sf, "pages").select(F.col("url").alias("path"))
    return profile.files_per_category(paths, "//").withColumn("slug", F.coalesce("slug", F.lit("(total)")))


# --- incremental load and warehouse ---------------------------------------------------------


def _offers(spark: SparkSession, sf: str) -> DataFrame:
    return star.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("pid"), F.col("l_suppkey").alias("seller_id"), "l_linestatus")


@query
def incremental_skip(spark: SparkSession, sf: str) -> DataFrame:
    """Offers of open lines that no finished line has, appended to the finished ones."""
    offers = _offers(spark, sf)
    tracked = offers.filter("l_linestatus = 'F'").select("pid", "seller_id", F.lit("known").alias("state")).distinct()
    candidates = offers.select("pid", "seller_id", F.lit("new").alias("state")).distinct()
    _, tracking = incremental.track(tracked, candidates, ["pid", "seller_id"])
    return tracking


@query
def bucketed_existence(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per priority of customers of one market segment and of customers outside it, from tables bucketed by customer."""
    base = fresh_path(spark, "bucketed")
    label = base.rsplit("-", 1)[1]
    orders = star.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    customers = star.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    orders = write_bucketed(orders, f"orders_{label}", f"{base}/orders", ["o_custkey"], 16)
    customers = write_bucketed(customers, f"customers_{label}", f"{base}/customers", ["o_custkey"], 16)
    inside = keys.existing(orders, customers, ["o_custkey"], unique=True).withColumn("inside", F.lit(True))
    outside = keys.unknown(orders, customers, ["o_custkey"], unique=True).withColumn("inside", F.lit(False))
    return inside.unionByName(outside).groupBy("inside", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))


@query
def upsert_customers(spark: SparkSession, sf: str) -> DataFrame:
    target = star.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    source = (
        star.table(spark, sf, "orders")
        .groupBy((F.col("o_custkey") * 2).alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("c_acctbal"), F.concat(F.lit("Buyer "), F.max("o_orderkey")).alias("c_name"))
    )
    return load.upsert(target, source, ["c_custkey"])


@query
def insert_ignore_bridge(spark: SparkSession, sf: str) -> DataFrame:
    offers = _offers(spark, sf)
    target = offers.filter("l_linestatus = 'F'").select("pid", "seller_id").distinct()
    return load.insert_ignore(target, offers)


@query
def load_projection(spark: SparkSession, sf: str) -> DataFrame:
    raw = star.table(spark, sf, "orders").selectExpr(
        "o_orderkey as review_id", "o_custkey as product_id", "o_custkey % 7 as seller_id", "o_custkey as customer_id",
        "o_orderpriority as title", "o_orderstatus as content", "o_totalprice as thank_count",
        "o_totalprice / 100000 as rating", "cast(o_orderdate as string) as created_at", "o_orderdate as purchased_at",
        "'unused' as status",
    )
    loaded = load.load_projection(raw, WAREHOUSE["reviews"])
    return loaded.withColumns(
        {
            "rating": F.col("rating").cast("double"),
            "created_at": F.col("created_at").cast("timestamp_ntz"),
            "purchased_at": F.col("purchased_at").cast("timestamp_ntz"),
        }
    )


@query
def defaults_applied(spark: SparkSession, sf: str) -> DataFrame:
    raw = star.sellers(spark, sf).withColumns(
        {
            "avg_rating_point": F.expr("case when total_follower <> 300 then avg_rating_point end"),
            "review_count": F.expr("case when review_count > 0 then review_count end"),
            "is_official": F.expr("nullif(is_official, false)"),
            "store_level": F.expr("nullif(store_level, 'NONE')"),
            "total_follower": F.expr("nullif(total_follower, 500)"),
        }
    )
    typed = load.load_projection(raw, WAREHOUSE["sellers"])
    return load.apply_defaults(typed, WAREHOUSE["sellers"]).withColumn("avg_rating_point", F.col("avg_rating_point").cast("double"))


@query
def warehouse_load(spark: SparkSession, sf: str) -> DataFrame:
    """All tables normalised, judged, loaded and read back: row count and refused rows per table."""
    products = staged(_silver_products(spark, sf).select(*gold.PRODUCT_COLUMNS, "images_url", "authors", "brand_name"), "silver-products")
    reviews = staged(_silver_reviews(spark, sf), "silver-reviews")
    tables = gold.normalise(products, reviews) | {
        "sellers": silver.silver_sellers(star.sellers(spark, sf)),
        "categories": star.categories(spark, sf),
    }
    base = fresh_path(spark, "warehouse")
    load_warehouse(tables, base)
    counts = profile.table_counts(open_warehouse(spark, base))
    refused = read_rejects(spark, base).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(refused, "table_name", "left").select("table_name", "n_rows", F.coalesce("n", F.lit(0)).alias("n_violations"))


@query
def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads, the second into filled tables: rows stored, and rows refused by table, load and reason.

    On the first day a third of the sellers arrive with all products; on the second another third,
    three in four of them with a value that their table does not take, and all products again.
    """
    base = fresh_path(spark, "warehouse")
    products = staged(_silver_products(spark, sf).select(*gold.PRODUCT_COLUMNS, "brand_name"), "silver-products")
    sellers = silver.silver_sellers(star.sellers(spark, sf), [F.col("seller_name")])
    first = {
        "categories": star.categories(spark, sf),
        "sellers": sellers.filter("seller_id % 3 = 0"),
        "brands": gold.gold_brands(products),
        "products": gold.gold_products(products),
    }
    load_warehouse(first, base, "day1")
    later = sellers.filter("seller_id % 3 = 1").withColumns(
        {
            "store_level": F.expr("case when seller_id % 4 = 1 then repeat('X', 40) else store_level end"),
            "avg_rating_point": F.expr("case when seller_id % 4 = 2 then 12.5 else avg_rating_point end"),
            "seller_id": F.expr("case when seller_id % 4 <> 3 then seller_id end"),
        }
    )
    load_warehouse({"sellers": later, "products": first["products"]}, base, "day2")
    stored = profile.table_counts(open_warehouse(spark, base)).withColumns({"tag": F.lit("stored"), "reason": F.lit("")})
    refused = read_rejects(spark, base).groupBy("table_name", "tag", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return stored.unionByName(refused).select("table_name", "tag", "reason", "n_rows")


@query
def load_guards(spark: SparkSession, sf: str) -> DataFrame:
    """What loads refuse and keep: null keys in two loads without a tag, a bridge without its parents, and
    null keys in two drops of a stream."""
    base = fresh_path(spark, "guards")
    products = staged(_silver_products(spark, sf).select("product_id", "seller_id", "brand_id", "brand_name", "authors"), "silver-products")
    brands = gold.gold_brands(products)
    for k in (2, 3):
        load_table(brands.withColumn("brand_id", F.expr(f"case when brand_id % {k} <> 0 then brand_id end")), WAREHOUSE["brands"], base)
    load_warehouse({"products_authors": gold.gold_products_authors(products)}, base)
    stored = profile.table_counts(open_warehouse(spark, base)).withColumn("reason", F.lit(""))
    refused = read_rejects(spark, base).groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    upsert = incremental.upsert_batches(f"{base}/users", ["user_id"], [F.desc("event_id")], "events")
    for i, drop in enumerate(_drops(spark, sf, "event_type <> 'purchase'")):
        keyed = drop.withColumn("user_id", F.expr("case when event_id % 7 <> 0 then user_id end"))
        files.write_json(keyed, f"{base}/in/drop{i}")
        incremental.run_available(spark, f"{base}/in", drop.schema, upsert, f"{base}/state", recursiveFileLookup="true")
    users = read_current(spark, f"{base}/users").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("reason", F.lit(""))
    lost = incremental.read_refused(spark, f"{base}/users", drop.schema).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("reason", F.lit("no key"))
    streamed = users.unionByName(lost).withColumn("table_name", F.lit("users"))
    return stored.unionByName(refused).unionByName(streamed).select("table_name", "reason", "n_rows")


@query
def item_key_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    items = star.table(spark, sf, "lineitem").select(X.item_key(F.col("l_partkey"), F.col("l_suppkey")).alias("item_id"))
    counted = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("item_id", X.item_key_part(F.col("item_id"), 0).alias("product_id"), X.item_key_part(F.col("item_id"), 1).alias("seller_id"), "n_rows")


# --- quality --------------------------------------------------------------------------------


@query
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_counts({name: star.table(spark, sf, name) for name in TABLES})


@query
def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    return checks.key_violations(star.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of suppliers in the red and of oversized parts, taken as lines without parent."""
    lines = star.table(spark, sf, "lineitem")
    solvent = star.table(spark, sf, "supplier").filter("s_acctbal >= 0")
    usual = star.table(spark, sf, "part").filter("p_size <= 45")
    by_supplier = checks.orphans(lines, ["l_suppkey"], solvent, ["s_suppkey"])
    by_part = checks.orphans(lines, ["l_partkey"], usual, ["p_partkey"])
    return by_supplier.select(F.lit("supplier").alias("parent"), F.col("l_suppkey").alias("value"), "n_rows").unionByName(
        by_part.select(F.lit("part").alias("parent"), F.col("l_partkey").alias("value"), "n_rows")
    )


PART_SPEC = TableSpec(
    "part",
    (
        Column("p_partkey", "bigint", required=True),
        Column("p_name", "string", 9, required=True),
        Column("p_brand", "string", 7),
        Column("p_type", "string", 5),
        Column("p_retailprice", "decimal(6,2)"),
        Column("p_size", "tinyint"),
    ),
    ("p_partkey",),
)


@query
def length_violations(spark: SparkSession, sf: str) -> DataFrame:
    return checks.column_violations(star.table(spark, sf, "part"), PART_SPEC)


@query
def decimal_conformance(spark: SparkSession, sf: str) -> DataFrame:
    types = {"l_extendedprice": "decimal(6,2)", "l_quantity": "decimal(2,1)", "l_discount": "decimal(4,3)"}
    return checks.decimal_conformance(star.table(spark, sf, "lineitem").select(*types), types)


@query
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(star.table(spark, sf, "customer"), "c_mktsegment")


@query
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(star.table(spark, sf, "events"), "event_type")


@query
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_profile(star.table(spark, sf, "orders"))


# --- serving --------------------------------------------------------------------------------


@query
def multi_author_products(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("p_name", " ")
    authors = F.when(F.expr("p_size % 3 = 0"), F.slice(words, 1, 1)).otherwise(words)
    named = star.table(spark, sf, "part").select("p_partkey", F.array_distinct(authors).alias("authors"))
    return named.filter(F.size("authors") > 1).select("p_partkey", F.size("authors").alias("n_authors"))


@query
def sql_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lines = star.table(spark, sf, "lineitem").withColumnsRenamed({"l_partkey": "product_id", "l_suppkey": "seller_id"})
    text = "select product_id, seller_id, l_orderkey, l_linenumber, l_quantity from offer_lines where product_id = :product and seller_id = :seller"
    return serving.sql_view(lines, "offer_lines", text, product=42, seller=3)


@query
def brand_or_author_label(spark: SparkSession, sf: str) -> DataFrame:
    """Maker line of every product, from normalised tables built out of one stored table."""
    products = staged(_silver_products(spark, sf).select("product_id", "seller_id", "brand_id", "brand_name", "authors"), "makers")
    return serving.makers(products, gold.gold_products_authors(products), gold.gold_authors(products), gold.gold_brands(products))


@query
def product_card(spark: SparkSession, sf: str) -> DataFrame:
    shown = ["product_id", "seller_id", "breadcrumbs", "product_name", "rating_average", "price", "discount_rate", "original_price", "description", "images_url"]
    products = staged(_silver_products(spark, sf).select(*shown), "cards")
    long_name = F.repeat(F.concat("product_name", F.lit(" ")), F.expr("cast(product_id % 6 + 1 as int)"))
    return serving.product_cards(products.withColumn("product_name", long_name), gold.gold_images(products))


@query
def recent_purchases_top5(spark: SparkSession, sf: str) -> DataFrame:
    recent = serving.recent_purchases(star.reviews(spark, sf), 5, "rank")
    return recent.select("customer_id", "rank", "review_id", "product_id", "seller_id", "purchased_at")


# --- text and recommendations ---------------------------------------------------------------


@query
def normalized_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = star.table(spark, sf, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = star.table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("kind", "id", TX.normalize_text(F.col("text")).alias("text"))


@query
def token_frequency_top200(spark: SparkSession, sf: str) -> DataFrame:
    talk = star.table(spark, sf, "conversations")
    return terms.word_frequencies(talk, TX.joined_text(F.col("role"), F.col("text")), STOP_WORDS)


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return terms.term_counts(star.table(spark, sf, "documents"), ["doc_id"], F.col("text"))


def _n_docs(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_docs"))


def _document_index(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Weights, vocabulary and document count; the term counts are stored once."""
    counts = staged(_counts(spark, sf), "term-counts")
    vocab = terms.vocabulary(counts, STOP_WORDS)
    n_docs = _n_docs(star.table(spark, sf, "documents"))
    return terms.tfidf(counts, vocab, n_docs, ["doc_id"]), vocab, n_docs


@query
def vocab(spark: SparkSession, sf: str) -> DataFrame:
    return terms.vocabulary(_counts(spark, sf), STOP_WORDS)


@query
def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights, _, _ = _document_index(spark, sf)
    return weights.select("doc_id", "token", F.round("weight", 6).alias("weight"))


@query
def tfidf_documented(spark: SparkSession, sf: str) -> DataFrame:
    counts = staged(_counts(spark, sf), "term-counts")
    n_docs = _n_docs(star.table(spark, sf, "documents"))
    weights = terms.tfidf(counts, terms.vocabulary(counts, STOP_WORDS), n_docs, ["doc_id"], "documented")
    return weights.select("doc_id", "token", F.round("weight", 6).alias("weight"))


@query
def phrase_table(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of tokens of all documents that stand side by side far more often than by chance."""
    return phrases.pair_table(star.table(spark, sf, "documents"), F.col("text"), 20, 5.0)


@query
def phrase_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary of all documents with joined words, of which ``STOP_PHRASES`` are stop words too."""
    docs = phrases.stored_tokens(star.table(spark, sf, "documents"), ["doc_id"], F.col("text"))
    pairs = staged(phrases.pair_table(docs, F.col("tokens"), 20, 5.0), "pairs")
    return terms.vocabulary(phrases.phrase_counts(docs, ["doc_id"], F.col("tokens"), pairs), [*STOP_WORDS, *STOP_PHRASES])


@query
def index_by_drops(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of an index to which the documents came in three loads, the last of which replaces texts of both others."""
    base, docs = fresh_path(spark, "text-index"), star.table(spark, sf, "documents").select("doc_id", "text")
    late = F.col("doc_id") % 7 == 0
    early = docs.withColumn("text", F.when(late, F.reverse("text")).otherwise(F.col("text")))
    drops = [early.filter(F.col("doc_id") % 2 == 0), early.filter(F.col("doc_id") % 2 == 1), docs.filter(late)]
    for i, drop in enumerate(drops):
        text_index.add_drop(drop, base, ["doc_id"], F.col("text"), i)
    weights = text_index.current_weights(spark, base, [("doc_id", docs.schema["doc_id"].dataType)], STOP_WORDS)
    return weights.select("doc_id", "token", "df", F.round("weight", 6).alias("weight"))


@query
def search_top10(spark: SparkSession, sf: str) -> DataFrame:
    """All benchmark texts searched in all documents."""
    weights, words, n_docs = _document_index(spark, sf)
    asked = terms.term_counts(star.table(spark, sf, "benchmark"), ["item_id"], F.col("text"))
    queries = terms.query_weights(asked, words, n_docs, ["item_id"])
    return similarity.search(weights, queries, ["doc_id"], ["item_id"])


@query
def similar_documents_top10(spark: SparkSession, sf: str) -> DataFrame:
    """The ten most similar documents of every document."""
    weights, _, _ = _document_index(spark, sf)
    return similarity.similar_items(weights, ["doc_id"])


@query
def similar_products_top10(spark: SparkSession, sf: str) -> DataFrame:
    """The ten most similar offers of every offer; offers of one part have equal texts."""
    offers = star.table(spark, sf, "lineitem").selectExpr("l_partkey as product_id", "l_suppkey as seller_id").distinct()
    part = star.table(spark, sf, "part").selectExpr("p_partkey as product_id", "p_name", "p_brand", "p_type", "p_size")
    texts = offers.join(part, "product_id").select(
        "product_id", "seller_id",
        TX.joined_text(F.col("p_name"), F.col("p_brand"), F.lower("p_type"), F.concat(F.lit("size"), "p_size")).alias("text"),
    )
    counts = staged(terms.term_counts(texts, ["product_id", "seller_id"], F.col("text")), "offer-terms")
    weights = terms.tfidf(counts, staged(terms.vocabulary(counts), "offer-vocabulary"), _n_docs(offers), ["product_id", "seller_id"])
    return similarity.similar_items(weights, ["product_id", "seller_id"])


@query
def product_search_top10(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of category and brand searched in the names and breadcrumbs of all products."""
    index = recommend.search_index(gold.gold_products(_silver_products(spark, sf)))
    asked = star.table(spark, sf, "part").select(F.concat_ws(" ", "p_type", "p_brand").alias("query")).distinct()
    return index.search(asked, "query", F.col("query"))


@query
def similar_to_product(spark: SparkSession, sf: str) -> DataFrame:
    """The products most like the first offer of every hundredth product, by content."""
    index = recommend.content_index(gold.gold_products(_silver_products(spark, sf)))
    wanted = star.offer_keys(spark, sf).filter("product_id % 100 = 0").groupBy("product_id").agg(F.min("seller_id").alias("seller_id"))
    return index.similar_to(wanted)


@query
def similar_to_offers(spark: SparkSession, sf: str) -> DataFrame:
    """The products most like every offer whose product id is divisible by 100, by content."""
    index = recommend.content_index(gold.gold_products(_silver_products(spark, sf)))
    return index.similar_to(star.offer_keys(spark, sf).filter("product_id % 100 = 0"))


@query
def item_index(spark: SparkSession, sf: str) -> DataFrame:
    return collab.item_index(star.table(spark, sf, "lineitem").selectExpr("l_partkey as product_id", "l_suppkey as seller_id"))


@query
def als_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    return collab.recommendations(staged(star.reviews(spark, sf), "ratings"))


@query
def als_user_top5(spark: SparkSession, sf: str) -> DataFrame:
    recs = collab.recommendations(staged(star.reviews(spark, sf), "ratings"))
    names = star.offer_names(spark, sf)
    return collab.user_picks(recs, names)


@query
def als_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Per user what must hold of any recommendations: how many, ranks without gaps, falling ratings, known items."""
    reviews = staged(star.reviews(spark, sf), "ratings")
    picks = staged(collab.user_picks(collab.recommendations(reviews), n=20), "picks")
    before = Window.partitionBy("customer_id").orderBy("rank")
    known = reviews.select("product_id", "seller_id").distinct().withColumn("known", F.lit(True))
    judged = picks.join(known, ["product_id", "seller_id"], "left").withColumn("before", F.lag("rating").over(before))
    return judged.groupBy(F.col("customer_id").cast("long").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_picks"),
        ((F.min("rank") == 1) & (F.max("rank") == F.count_distinct("rank")) & (F.max("rank") == F.count(F.lit(1)))).alias("ranks_whole"),
        F.every(F.coalesce(F.col("before") >= F.col("rating"), F.lit(True))).alias("ratings_fall"),
        F.every(F.coalesce("known", F.lit(False))).alias("items_known"),
    )


@query
def picks_with_names(spark: SparkSession, sf: str) -> DataFrame:
    """The five items that every customer has bought most of, with the names of those in the catalogue."""
    bought = star.table(spark, sf, "lineitem").join(star.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    recs = bought.groupBy(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id")).agg(F.sum("l_quantity").alias("rating"))
    names = star.offer_names(spark, sf).filter("product_id % 4 <> 0")
    return collab.user_picks(recs, names).select("customer_id", "rank", "product_id", "seller_id", "rating", F.coalesce("product_name", F.lit("")).alias("product_name"))


@query
def found_lines(spark: SparkSession, sf: str) -> DataFrame:
    """All lines of one product, and those of one of its sellers, by equal values."""
    lines = star.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    both = [serving.find(lines, l_partkey=7).withColumn("by", F.lit("product")), serving.find(lines, l_partkey=7, l_suppkey=3).withColumn("by", F.lit("offer"))]
    return both[0].unionByName(both[1])


@query
def als_exact_top10(spark: SparkSession, sf: str) -> DataFrame:
    """Per hundredth customer: the exact best items from fitted factors, held against the model's own list."""
    reviews = staged(star.reviews(spark, sf), "ratings")
    model = collab.fit(collab.ratings(reviews, collab.item_index(reviews)))
    users = staged(model.userFactors.filter("id % 100 = 0"), "user-factors")
    best = collab.best_items(users, staged(model.itemFactors, "item-factors"), 10)
    own = model.recommendForUserSubset(users.select(F.col("id").alias("customer_id")), 10)
    own = own.select("customer_id", F.posexplode("recommendations").alias("at", "r")).select("customer_id", (F.col("at") + 1).alias("rank"), "r.rating")
    met = best.join(own, (best.user_id == own.customer_id) & (best["rank"] == own["rank"]), "left")
    return met.groupBy(F.col("user_id").cast("long").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_picks"), F.every(F.coalesce(F.abs(F.col("score") - F.col("rating")) < 0.001, F.lit(False))).alias("agrees")
    )


@query
def factors_top10(spark: SparkSession, sf: str) -> DataFrame:
    """The exact best vectors for every hundredth one, as users and items with given factors."""
    vectors = star.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    return collab.best_items(vectors.filter("id % 100 = 0"), vectors, 10)


# --- files and streams ----------------------------------------------------------------------


@query
def file_format_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Tables written as CSV, JSON and Parquet, read back with their schemas and summed up."""
    base = fresh_path(spark, "formats")
    customer, part, supplier = (star.table(spark, sf, t) for t in ("customer", "part", "supplier"))
    files.write_csv(customer, f"{base}/customer.csv")
    files.write_json(part, f"{base}/part.json")
    files.write_table(supplier, files.table_path(base, "silver", "shop", "silver_supplier"))
    back = [
        ("csv", files.read_csv(spark, f"{base}/customer.csv", customer.schema), "c_custkey", "c_name"),
        ("json", spark.read.schema(part.schema).json(f"{base}/part.json"), "p_partkey", "p_name"),
        ("parquet", files.read_table(spark, f"{base}/silver/shop/supplier.parquet"), "s_suppkey", "s_name"),
    ]
    out = None
    for fmt, df, key, name in back:
        one = df.agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(key).alias("key_sum"), F.sum(F.length(name)).cast("bigint").alias("name_chars")
        ).select(F.lit(fmt).alias("format"), "n_rows", "key_sum", "name_chars")
        out = one if out is None else out.unionByName(one)
    return out


@query
def file_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Products written as documents into category folders, then listed, scanned and counted.

    Also a word list with repeats and a tracking table that does not exist yet.
    """
    base = fresh_path(spark, "documents")
    part = star.table(spark, sf, "part")
    pages = part.groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("id"), F.count(F.lit(1)).alias("sold"), F.max("p_size").alias("size"))
    document = """to_json(named_struct('id', id, 'name', p_brand, 'all_time_quantity_sold', sold, 'breadcrumbs',
        if(size % 2 = 0, array(named_struct('category_id', size, 'name', p_type)), cast(array() as array<struct<category_id:int,name:string>>))))"""
    text = pages.selectExpr("lower(p_type) as slug", "substring(p_brand, 7) as folder", f"{document} as value")
    text.repartition("slug", "folder").write.option("maxRecordsPerFile", 1).partitionBy("slug", "folder").text(f"{base}/files")

    listed = files.list_files(spark, f"{base}/files", "part-*").select(F.regexp_replace("path", "(slug|folder)=", "").alias("path"))
    titles = star.categories(spark, sf).select("slug", "title")
    folders = profile.files_per_category(listed, f"{base}/files/", titles).select(
        F.lit("folders").alias("what"), F.coalesce("title", F.lit("(total)")).alias("name"), F.col("n_items").alias("n")
    )
    good, bad = documents.split_products(files.scan_documents(spark, f"{base}/files", "products", "part-*"))
    sold = documents.product_rows(good).agg(F.sum("quantity_sold")).select(F.lit("products").alias("what"), F.lit("sold").alias("name"), F.col("sum(quantity_sold)").alias("n"))
    refused = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejects").alias("what"), F.col("reason").alias("name"), "n")
    part.select("p_type").write.text(f"{base}/words")
    words = files.read_words(spark, f"{base}/words").select(F.lit("words").alias("what"), F.lower("token").alias("name"), F.length("token").cast("long").alias("n"))
    tracked = files.read_or_create(spark, f"{base}/tracking", TRACKING_CSV).agg(F.count(F.lit(1)).alias("n"))
    return folders.unionByName(sold).unionByName(refused).unionByName(words).unionByName(tracked.select(F.lit("tracking").alias("what"), F.lit("rows").alias("name"), "n"))


@query
def file_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A document for every part, written in files of many by brand, then scanned, sorted out and counted."""
    base = fresh_path(spark, "documents")
    written = _product_documents(spark, sf, brands=True)
    written.select(F.substring("brand", 7, 10).alias("folder"), F.col("doc").alias("value")).write.partitionBy("folder").text(f"{base}/files")
    good, bad = documents.split_products(files.scan_documents(spark, f"{base}/files", "products", "part-*", lines=True))
    folder = F.regexp_extract("path", "/folder=([^/]*)/", 1).alias("folder")
    rows = documents.product_rows(good, ["path"]).groupBy(folder).agg(F.count(F.lit(1)).alias("n"), F.sum("product_id").alias("ids"))
    refused = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("ids"))
    return rows.select(F.lit("kept").alias("what"), F.col("folder").alias("name"), "n", "ids").unionByName(refused.select(F.lit("refused").alias("what"), F.col("reason").alias("name"), "n", "ids"))


def _drops(spark: SparkSession, sf: str, first: str) -> list[DataFrame]:
    events = star.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return [events.filter(first), events.filter(f"not coalesce({first}, false)")]


@query
def stream_incremental_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive in two drops; each drop upserts the newest event of its users."""
    base = fresh_path(spark, "stream")
    upsert = incremental.upsert_batches(f"{base}/users", ["user_id"], [F.desc("event_id")], "events")
    for i, drop in enumerate(_drops(spark, sf, "event_type <> 'purchase'")):
        files.write_json(drop, f"{base}/in/drop{i}")
        incremental.run_available(spark, f"{base}/in", drop.schema, upsert, f"{base}/state", recursiveFileLookup="true")
    return read_current(spark, f"{base}/users")


@query
def stream_partition_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Events in two drops; the last event of every user so far is kept in a table partitioned by buckets of the key."""
    base = fresh_path(spark, "stream")
    upsert = incremental.upsert_partition_batches(f"{base}/users", ["user_id"], [F.desc("event_id")], 8)
    for i, drop in enumerate(_drops(spark, sf, "event_type <> 'purchase'")):
        files.write_json(drop, f"{base}/in/drop{i}")
        incremental.run_available(spark, f"{base}/in", drop.schema, upsert, f"{base}/state", recursiveFileLookup="true")
    return read_partitioned(spark, f"{base}/users")


@query
def stream_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Product documents in two drops, good and bad, some of the first again in the second with another text:
    rows of the loaded tables, documents refused by reason, products refused by reason."""
    base = fresh_path(spark, "stream")
    docs = staged(_product_documents(spark, sf), "docs")
    again = docs.filter("p_partkey % 10 = 4").withColumn("doc", F.replace("doc", F.lit('"description":"About '), F.lit('"description":"Again ')))
    for drop in (docs.filter("p_partkey % 2 = 0"), docs.filter("p_partkey % 2 = 1").unionByName(again)):
        drop.select(F.col("doc").alias("value")).write.mode("append").text(f"{base}/in")
        doc_stream.load_products(spark, f"{base}/in", f"{base}/shop", f"{base}/state")
    stored = open_warehouse(spark, f"{base}/shop")
    rows = profile.table_counts({t: stored[t] for t in ("categories", "sellers", "brands", "authors", "products")})
    renewed = stored["products"].filter(F.startswith("description", F.lit("Again"))).agg(F.count(F.lit(1)).alias("n_rows"))
    lost = doc_stream.refused_documents(spark, f"{base}/shop").groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    refused = read_rejects(spark, f"{base}/shop").filter("table_name = 'products'").groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    parts = [
        rows.select(F.lit("stored").alias("what"), F.col("table_name").alias("name"), "n_rows"),
        renewed.select(F.lit("renewed").alias("what"), F.lit("products").alias("name"), "n_rows"),
        lost.select(F.lit("document").alias("what"), F.col("reason").alias("name"), "n_rows"),
        refused.select(F.lit("product").alias("what"), F.col("reason").alias("name"), "n_rows"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def stream_two_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources with checkpoints of their own upsert into one table, the odd events after the even ones."""
    base = fresh_path(spark, "stream")
    events = star.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    for name, rest in (("even", 0), ("odd", 1)):
        files.write_json(events.filter(F.col("event_id") % 2 == rest), f"{base}/{name}/in")
        upsert = incremental.upsert_batches(f"{base}/users", ["user_id"], [F.desc("event_id")], name)
        incremental.run_available(spark, f"{base}/{name}/in", events.schema, upsert, f"{base}/{name}/state")
    return read_current(spark, f"{base}/users")


@query
def stream_skip_known(spark: SparkSession, sf: str) -> DataFrame:
    """Events in two drops; of every user unseen so far the first event is taken in."""
    base = fresh_path(spark, "stream")

    def store(fresh: DataFrame, batch_id: int) -> None:
        fresh.write.mode("overwrite").parquet(f"{base}/taken/{batch_id}")

    take = incremental.new_keys_only(f"{base}/tracking", ["user_id"], store, [F.col("event_id")], "events")
    for i, drop in enumerate(_drops(spark, sf, "event_type = 'signup'")):
        files.write_json(drop, f"{base}/in/drop{i}")
        incremental.run_available(spark, f"{base}/in", drop.schema, take, f"{base}/state", recursiveFileLookup="true")
    return spark.read.option("recursiveFileLookup", True).parquet(f"{base}/taken")


@query
def stream_new_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Events in two drops, with a restart between them: every user once, with the drop that first names the user."""
    base = fresh_path(spark, "stream")
    for i, drop in enumerate(_drops(spark, sf, "event_type = 'signup'")):
        named = drop.select("user_id", F.lit(i).alias("drop_no"))
        files.write_json(named, f"{base}/in/drop{i}")
        incremental.new_keys_stored(spark, f"{base}/in", named.schema, ["user_id"], f"{base}/users", f"{base}/state", recursiveFileLookup="true")
    return spark.read.parquet(f"{base}/users")
