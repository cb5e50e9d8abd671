from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlens import session
from marketlens.operators import checks, keys, load, profile, serving
from marketlens.plans import catalogue, silver, warehouse
from marketlens.schemas import WAREHOUSE, Column, ForeignKey, TableSpec
from marketlens.sources import jdbc


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_keep_one_takes_the_first_in_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (1, 7, "c")], "k int, t int, v string")
    assert rows(keys.keep_one(df, ["k"], [F.desc("t"), F.col("v")])) == [(1, 7, "b"), (2, 1, "c")]


def test_keep_one_complete_does_not_lose_a_key_to_a_null_row(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "x"), (2, None)], "k int, v string")
    assert rows(keys.keep_one_complete(df, ["k"])) == [(1, "a")]


def test_rank_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = keys.keep_one(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_existing_and_unknown(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1)], "a int, b int")
    ref = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert rows(keys.existing(df, ref, ["a", "b"])) == [(1, 1), (2, 1)]
    assert rows(keys.unknown(df, ref, ["a", "b"])) == [(None, 1), (1, 2)]


def test_dense_index_numbers_in_order(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as s", "id % 7 as n").repartition(13)
    got = keys.dense_index(df, [F.desc("n"), F.col("s")], "i").orderBy("i").collect()
    want = sorted(((str(i), i % 7) for i in range(1000)), key=lambda r: (-r[1], r[0]))
    assert [(r["s"], r["n"]) for r in got] == want and [r["i"] for r in got] == list(range(1000))


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c"), (4, "d")], "k int, v string")
    once = load.upsert(target, source, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert rows(load.upsert(once, source, ["k"])) == rows(once)


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    source = spark.createDataFrame([(1, 2), (2, 2), (2, 2)], "a int, b int")
    assert rows(load.insert_ignore(target, source)) == [(1, 1), (1, 2), (2, 2)]


def test_load_projection_casts_and_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("7", "4.75", "x"), ("8", "99.9", "y")], "review_id string, rating string, title string")
    raw = df.selectExpr("review_id", "1 as product_id", "2 as seller_id", "3 as customer_id", "title", "'c' as content",
                        "'5' as thank_count", "rating", "'2024-01-02 03:04:05' as created_at", "null as purchased_at")
    out = load.load_projection(raw, WAREHOUSE["reviews"])
    assert out.columns == WAREHOUSE["reviews"].names
    assert [str(r["rating"]) for r in out.orderBy("review_id").collect()] == ["4.8", "None"]
    assert dict(out.dtypes)["created_at"] == "timestamp" and dict(out.dtypes)["product_id"] == "string"


def test_defaults(spark):
    spec = WAREHOUSE["sellers"]
    raw = spark.createDataFrame([("1", None)], "seller_id string, store_level string")
    full = raw.select("*", *[F.lit(None).alias(c) for c in spec.names if c not in raw.columns])
    row = load.apply_defaults(load.load_projection(full, spec), spec).collect()[0]
    assert (row["store_level"], row["review_count"], row["is_official"], row["seller_name"]) == ("NONE", 0, False, None)


SPEC = TableSpec(
    "t",
    (Column("k", "bigint", required=True), Column("name", "string", 3), Column("price", "decimal(4,2)"), Column("p", "bigint")),
    ("k",),
    (ForeignKey(("p",), "parent", ("id",)),),
)


def test_check_table_reports_every_rule(spark):
    df = spark.createDataFrame(
        [(1, "abc", 1.5, 10), (1, "abcd", 1.5, 11), (2, "a", 123.0, None), (None, "a", 1.0, 10)],
        "k bigint, name string, price double, p bigint",
    )
    parent = spark.createDataFrame([(10,)], "id bigint")
    found = {(r["rule"], r["detail"]): r["n_rows"] for r in checks.check_table(df, SPEC, {"parent": parent}).collect()}
    assert found == {
        ("primary key", "1"): 2, ("primary key", "null"): 1, ("foreign key parent", "11"): 1,
        ("column", "k not null"): 1, ("column", "name length 3"): 1, ("column", "price decimal(4,2)"): 1,
    }


def test_require_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        checks.require_unique(df, ["k"])
    checks.require_unique(df.distinct(), ["k"])


def test_grouped_total_counts_a_member_once_per_group(spark):
    paths = ["r/a/1_1/p.json", "r/a/1_1/reviews/x.json", "r/b/1_1/p.json", "r/b/2_1/p.json", "r/readme.txt", "r/a/file.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert rows(profile.files_per_category(df, "r/")) == [(None, 3), ("a", 1), ("b", 2)]


def test_counted_write(spark, tmp_path):
    n = profile.counted_write(spark.range(7).toDF("i"), lambda out: out.write.parquet(str(tmp_path / "x")))
    assert n == 7


def test_makers_prefers_authors_and_sorts_them(spark):
    products = spark.createDataFrame([(1, 1, 5), (2, 1, 5), (3, 1, 9)], "product_id int, seller_id int, brand_id int")
    bridge = spark.createDataFrame([(1, 1, 2), (1, 1, 1)], "product_id int, seller_id int, author_id int")
    authors = spark.createDataFrame([(1, "An"), (2, "Bo")], "author_id int, author_name string")
    brands = spark.createDataFrame([(5, "Brand")], "brand_id int, brand_name string")
    assert rows(serving.makers(products, bridge, authors, brands)) == [
        (1, 1, "Tác giả:", "An,Bo"), (2, 1, "Thương hiệu:", "Brand"), (3, 1, "", ""),
    ]


def test_lookups(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "product_id int, seller_id int")
    assert rows(serving.find(df, product_id=1, seller_id=2)) == [(1, 2)]
    assert rows(serving.sql_view(df, "v", "select * from v where product_id = :p", p=2)) == [(2, 1)]


def test_recent_purchases_put_missing_dates_last(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, None), (1, 12, 9), (1, 13, 9)], "customer_id int, review_id int, purchased_at int")
    assert [r["review_id"] for r in serving.recent_purchases(df, 3, "rank").orderBy("rank").collect()] == [12, 13, 10]


def test_jdbc_options():
    assert jdbc.staging_name("dwh", "users", "2024-05-06") == "dwh.users_tmp_2024_05_06"
    write = jdbc.write_options("jdbc:x", "dwh.t", 8, user="u")
    assert write == {"url": "jdbc:x", "dbtable": "dwh.t", "batchsize": "10000", "numPartitions": "8", "user": "u"}
    read = jdbc.read_options("jdbc:x", "t", "id", (0, 100), 4)
    assert read["partitionColumn"] == "id" and read["numPartitions"] == "4"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "t")


def test_merge_statements_run():
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE SCHEMA dwh")
    staging = jdbc.staging_name("dwh", "brands", "2024-05-06")
    for name, key in (("dwh.brands", "PRIMARY KEY"), (staging, "")):
        con.execute(f"CREATE TABLE {name} (brand_id VARCHAR {key}, brand_name VARCHAR)")
    con.execute("INSERT INTO dwh.brands VALUES ('1', 'a'), ('2', 'b')")
    con.execute(f"INSERT INTO {staging} VALUES ('2', 'B'), ('3', 'c')")
    for statement in jdbc.merge_statements(WAREHOUSE["brands"], "dwh", staging):
        con.execute(statement)
    assert con.execute("SELECT * FROM dwh.brands ORDER BY 1").fetchall() == [("1", "a"), ("2", "B"), ("3", "c")]
    assert con.execute("SELECT count(*) FROM duckdb_tables() WHERE table_name LIKE '%tmp%'").fetchone() == (0,)
    bridge = jdbc.merge_statements(WAREHOUSE["products_authors"], "dwh", "dwh.t")
    assert bridge[1].endswith("ON CONFLICT (product_id, seller_id, author_id) DO NOTHING")


def test_texts_of_reasons_are_made_for_broken_rows_only(spark):
    """a compiled test comes first; Spark makes the array of texts by interpreting it."""
    spec = TableSpec("t", (Column("k", "string", 3), Column("n", "int", required=True), Column("x", "decimal(3,1)")), ("k",))
    rows = [("a", "1", "2.5"), (None, None, None), ("abcd", "z", "1000"), ("b", None, None), ("c", "3", None)]
    reasons = checks.row_reasons(spec)
    got = spark.createDataFrame(rows, "k string, n string, x string").select(reasons.alias("r")).collect()
    assert [r["r"] for r in got] == [[], ["k not null", "n not null"], ["k length 3", "n int", "x decimal(3,1)"], ["n not null"], []]
    assert "CASE WHEN coalesce(" in str(reasons)


def test_loads_store_only_columns_that_they_use(spark, monkeypatch):
    kept = {}

    def stop(df, label, by=None):
        kept[label] = df.columns
        raise InterruptedError

    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in silver.PRODUCT_COLUMNS))
    monkeypatch.setattr(catalogue, "staged", stop)
    monkeypatch.setattr(catalogue, "_silver_products", lambda spark, sf: empty)
    for name, unused in (("load_rejects", "images_url"), ("load_guards", "description")):
        with pytest.raises(InterruptedError):
            catalogue.QUERIES[name](spark, "none")
        assert unused not in kept["silver-products"] and "brand_name" in kept["silver-products"]


def test_warehouse_load_stores_only_columns_that_it_uses(spark, monkeypatch):
    kept = {}

    def stop(df, label, by=None):
        kept[label] = df.columns
        raise InterruptedError

    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in silver.PRODUCT_COLUMNS))
    monkeypatch.setattr(catalogue, "staged", stop)
    monkeypatch.setattr(catalogue, "_silver_products", lambda spark, sf: empty)
    with pytest.raises(InterruptedError):
        catalogue.QUERIES["warehouse_load"](spark, "none")
    assert "seller_url" not in kept["silver-products"] and {"images_url", "authors", "brand_name"} <= set(kept["silver-products"])


def test_a_load_leaves_no_batch_behind(spark):
    base, before = session.fresh_path(spark, "dwh"), set(session._STAGED)
    rows = spark.createDataFrame([("1", "a"), (None, "b")], "brand_id string, brand_name string")
    warehouse.load_table(rows, WAREHOUSE["brands"], base)
    assert not [p for p in session._STAGED if p not in before]
    stored = [f.name for f in Path(base).rglob("*.parquet")]
    assert stored and all(".zstd." in name for name in stored)
    assert warehouse.read_rejects(spark, base).count() == warehouse.open_warehouse(spark, base)["brands"].count() == 1
