"""Maps a star schema (part, supplier, customer, orders, lineitem) to catalogue tables.

A line item is read as one sighting of the offer (part, supplier) and as one review of it. Some
values are blanked out so that the cleaning rules have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.keys import keep_one

# The part types, by category id.
CATEGORY_TITLES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
WARRANTY_TEXTS = [None, "", "Không bảo hành", "Trọn đời", "2 năm", "6 tháng", "15 ngày", "1 năm 6 tháng", "10 tháng", "abc"]
JOINED_TEXTS = [None, "Đã tham gia 3 năm", "2 tháng", "9 ngày", "3năm", "3 NĂM"]

def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql_list(values: list[str | None]) -> str:
    quoted = ["null" if v is None else "'" + v + "'" for v in values]
    return "array(" + ", ".join(quoted) + ")"


def categories(spark: SparkSession, sf: str) -> DataFrame:
    titles = table(spark, sf, "part").select(F.col("p_type").alias("title")).distinct()
    return titles.selectExpr(
        f"cast(array_position({sql_list(CATEGORY_TITLES)}, title) as bigint) as category_id",
        "title",
        "lower(title) as slug",
    )


def sellers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey as seller_id",
        "s_name as seller_name",
        "concat('https://img.example/', s_suppkey, '.png') as icon_url",
        "concat('https://shop.example/', s_suppkey) as store_url",
        "cast(s_nationkey as double) / 5 as avg_rating_point",
        "cast(floor(s_acctbal) as int) as review_count",
        "s_nationkey * 100 as total_follower",
        "s_nationkey * 10 as days_since_joined",
        "s_acctbal > 5000 as is_official",
        "case when s_acctbal > 5000 then 'OFFICIAL_STORE' else 'NONE' end as store_level",
    )


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with ``line``, a struct that orders equal dates."""
    line = F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return table(spark, sf, "lineitem").withColumn("line", line)


def first_review() -> list[Column]:
    return [F.col("line")]


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """The newest sighting of every offer.

    It is chosen on the columns of the line; what the part adds is joined and derived afterwards, for
    one row per offer.
    """
    lines = keep_one(_lines(spark, sf), ["l_partkey", "l_suppkey"], [F.desc("l_shipdate"), F.col("line")])
    part = table(spark, sf, "part")
    category = f"cast(array_position({sql_list(CATEGORY_TITLES)}, p_type) as bigint)"
    author = "named_struct('author_id', cast(conv(substring(md5(w), 1, 8), 16, 10) as bigint), 'author_name', w)"
    return lines.join(part, lines.l_partkey == part.p_partkey).selectExpr(
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "concat('SKU', l_partkey) as product_sku",
        "p_name as product_name",
        "concat('https://shop.example/p', l_partkey, '?spid=', l_suppkey) as product_url",
        "transform(split(p_name, ' '), w -> concat('https://img.example/ts/product/', w, '.jpg')) as images_url",
        "concat(p_name, ' <img src=\"', p_brand, '\">') as description",
        "concat('Size: ', p_size, '\\nBrand: ', p_brand) as specifications",
        f"{category} as category_id",
        "concat(p_type, ' / ', p_brand) as breadcrumbs",
        "l_extendedprice as original_price",
        "cast(floor(l_extendedprice * l_discount) as double) as discount",
        "l_extendedprice - floor(l_extendedprice * l_discount) as price",
        "cast(round(l_discount * 100) as int) as discount_rate",
        "l_linestatus = 'F' as is_authentic",
        "l_tax > 0.04 as is_freeship_xtra",
        "l_discount > 0.07 as is_top_deal",
        "p_brand like '%1' as is_top_brand",
        """case when l_returnflag = 'A' then 'any_reason' when l_returnflag = 'R' then 'defective_product'
           when p_size < 15 then 'no_return' when p_size < 30 then null else 'wrong_item' end as return_reason""",
        "'available' as inventory_status",
        "l_linestatus as inventory_type",
        "nullif(cast(l_quantity as int), 1) as quantity_sold",
        "datediff(date'2005-01-01', l_shipdate) as day_ago_created",
        "nullif(cast(substring(p_brand, 7) as bigint), 25) as brand_id",
        "nullif(p_brand, 'Brand#25') as brand_name",
        f"case when p_type in ('ECONOMY', 'PROMO') then transform(split(p_name, ' '), w -> {author}) end as authors",
        "l_quantity / 10 as rating_average",
        "l_linenumber * 7 as review_count",
        "l_suppkey + 1000 as store_id",
        "concat('S', l_suppkey, '-', l_partkey) as seller_sku",
        "concat('Supplier#', lpad(cast(l_suppkey as string), 9, '0')) as seller_name",
        "concat('https://shop.example/', l_suppkey) as seller_url",
        "concat('https://img.example/', l_suppkey, '.png') as seller_logo",
        f"get({sql_list(WARRANTY_TEXTS)}, cast(l_partkey % {len(WARRANTY_TEXTS)} as int)) as warranty_period",
        "case when p_size < 40 then 'Điện tử' end as warranty_type",
        "case when p_size > 10 then 'Trung tâm bảo hành' end as warranty_location",
    )


def offer_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the cleaned products, without building the rest of them."""
    lines = table(spark, sf, "lineitem").selectExpr("l_partkey as product_id", "l_suppkey as seller_id")
    return lines.filter("seller_id <> 0").distinct()


def review_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first review of every id among those of known offers, in the shape of a parsed review.

    It is chosen on the columns of the line, before orders and customers are joined.
    """
    lines = _lines(spark, sf).filter("l_suppkey <> 0").withColumn("review_id", F.expr("l_orderkey * 8 + l_linenumber"))
    lines = keep_one(lines, ["review_id"], first_review())
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    bought = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    return lines.join(bought, lines.l_orderkey == bought.o_orderkey).selectExpr(
        "review_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "concat('Order ', l_orderkey) as title",
        "concat(l_returnflag, ' ', l_linestatus, ' ', o_orderpriority) as content",
        "'approved' as status",
        "l_linenumber as thank_count",
        "1 + cast(l_quantity as int) % 5 as rating",
        "unix_seconds(cast(o_orderdate as timestamp)) as created_at",
        "o_custkey as customer_id",
        "c_name as customer_name",
        "case when l_linenumber < 7 then unix_seconds(cast(l_shipdate as timestamp)) end as purchased_at",
        "concat('https://img.example/u', o_custkey) as avatar_url",
        f"get({sql_list(JOINED_TEXTS)}, cast(o_custkey % {len(JOINED_TEXTS)} as int)) as joined_time",
        "nullif(c_nationkey, 0) as total_review",
        "case when c_acctbal > 0 then cast(floor(c_acctbal) as int) end as total_thank",
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Lean (review_id, product, seller, customer, rating, purchase time), unique per review."""
    lines, orders = _lines(spark, sf), table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    unique = keep_one(
        lines.selectExpr("l_orderkey", "l_orderkey * 8 + l_linenumber as review_id", "l_partkey as product_id", "l_suppkey as seller_id", "l_quantity", "l_shipdate as purchased_at", "line"),
        ["review_id"],
        first_review(),
    )
    return unique.join(orders, unique.l_orderkey == orders.o_orderkey).selectExpr(
        "review_id", "o_custkey as customer_id", "product_id", "seller_id", "1 + cast(l_quantity as int) % 5 as rating", "purchased_at"
    )


def offer_names(spark: SparkSession, sf: str) -> DataFrame:
    """(product_id, seller_id, product_name) of every offer."""
    offers = table(spark, sf, "lineitem").selectExpr("l_partkey as product_id", "l_suppkey as seller_id").distinct()
    names = table(spark, sf, "part").selectExpr("p_partkey as product_id", "p_name as product_name")
    return offers.join(names, "product_id")
