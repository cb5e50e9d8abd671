import json

import pytest
from pyspark.sql import functions as F

from marketlens.operators import documents as D
from marketlens.plans import pipeline, warehouse
from marketlens.schemas import TRACKING_CSV, WAREHOUSE
from marketlens.session import fresh_path, shared_dir
from marketlens.sources import files
from marketlens.sources import versions
from marketlens.sources.versions import current_version, publish, publish_upsert, read_current
from marketlens.streaming import incremental


def product(pid, seller, **changes):
    doc = {
        "id": pid, "sku": f"S{pid}", "name": f"Sách {pid}", "short_url": "u", "description": "d",
        "images": [{"base_url": "i1"}, {"base_url": "i1"}],
        "specifications": [{"attributes": [{"name": "A", "value": "1"}, {"name": "B"}]}, {}],
        "breadcrumbs": [{"category_id": 8, "name": "X"}, {"category_id": 9, "name": "Y"}, {"name": "self"}],
        "list_price": 100, "discount": 0, "price": 100, "discount_rate": 0,
        "tracking_info": {"amplitude": {"is_authentic": 1, "is_hero": True, "return_reason": "no_return"}},
        "inventory_status": "ok", "inventory_type": "stock", "day_ago_created": 5,
        "brand": {"id": 7, "name": "Bút"}, "authors": [{"id": 3, "name": "An"}],
        "rating_average": 4.5, "review_count": 2, "current_seller": {"id": seller, "name": "Shop"},
        "warranty_info": [
            {"name": "Thời gian bảo hành", "value": "1 năm"}, {"name": "thời gian bảo hành", "value": "6 tháng"},
            {"name": "Khác", "value": "z"},
        ],
    }
    doc.update(changes)
    return {k: v for k, v in doc.items() if v != "drop"}


def seller(sid):
    return {"data": {"seller": {"id": sid, "name": f"Shop {sid}", "avg_rating_point": 4.5, "is_official": True, "store_level": "T"}}}


def comment(rid, pid, sid, **changes):
    out = {
        "id": rid, "product_id": pid, "seller": {"id": sid}, "title": "t", "content": "c", "status": "ok", "thank_count": 1,
        "rating": 5, "created_at": 1700000000, "customer_id": rid % 3,
        "created_by": {"full_name": "U", "purchased_at": 1600000000, "avatar_url": "a",
                       "contribute_info": {"summary": {"joined_time": "Đã tham gia 3 năm", "total_review": 4}}},
    }
    out.update(changes)
    return out


@pytest.fixture(scope="module")
def bronze(tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")

    def put(path, content):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False, indent=4), encoding="utf-8")

    put("books/1_5/product_1_5.json", product(1, 5))
    put("toys/1_5/product_1_5.json", product(1, 5))
    put("books/2_5/product_2_5.json", product(2, 5, brand="drop", warranty_info="drop", specifications="drop", images="drop", authors=[]))
    put("books/3_9/product_3_9.json", product(3, 9))
    put("books/4_5/product_4_5.json", product(4, 5, breadcrumbs=[]))
    put("books/8_5/product_8_5.json", product(8, 5, breadcrumbs=[{"name": "X"}, {"name": "self"}], list_price=99.5, price=99.5, images="drop", authors=[], brand="drop"))
    put("books/5_5/product_5_5.json", product(5, 5, authors=[{"name": "no id"}]))
    put("books/6_5/product_6_5.json", '{"id": 6, "name"')
    put("books/1_5/seller_1_5.json", seller(5))
    put("toys/1_5/seller_1_5.json", seller(5))
    put("books/7_0/seller_7_0.json", seller(0))
    put("books/1_5/reviews/reviews_1_5_1.json", {"data": [comment(1, 1, 5), comment(2, 1, 5, created_by=None), comment(3, 1, 5, seller=None)]})
    put("books/1_5/reviews/reviews_1_5_2.json", {"data": [comment(1, 1, 5), comment(4, 99, 5)]})
    put("categories.csv", "title,slug,category_id\nNhà Sách,books,8\nĐồ chơi,toys,9\n")
    return str(root)


def test_product_fields(spark, bronze):
    good, bad = D.split_products(files.scan_documents(spark, bronze, "products"))
    rows = {r["product_id"]: r for r in D.product_rows(good).collect()}
    one, two = rows[1], rows[2]
    assert one["specifications"] == "A: 1\nB: " and one["breadcrumbs"] == "X / Y" and one["category_id"] == 8
    assert one["images_url"] == ["i1", "i1"] and one["warranty_period"] == "6 tháng" and one["warranty_type"] is None
    assert one["is_authentic"] is True and one["is_top_deal"] is True and one["is_top_brand"] is None
    assert [tuple(a) for a in one["authors"]] == [(3, "An")]
    assert (two["specifications"], two["images_url"], two["authors"], two["brand_id"]) == ("", [], [], None)
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in bad.select("path", "reason").collect()}
    assert reasons == {"product_4_5.json": "no category", "product_5_5.json": "author without id", "product_6_5.json": "unreadable"}


def test_review_fields(spark, bronze):
    pages, _ = D.split_readable(files.scan_documents(spark, bronze, "reviews"))
    comments, lost = D.split_comments(pages)
    rows = {r["review_id"]: r for r in D.review_rows(comments).collect()}
    assert set(rows) == {1, 2, 4} and lost.count() == 1
    assert (rows[2]["total_review"], rows[2]["total_thank"], rows[2]["customer_name"]) == (0, 0, None)
    assert (rows[1]["total_review"], rows[1]["total_thank"], rows[1]["joined_time"]) == (4, None, "Đã tham gia 3 năm")


def test_unknown_kind(spark, bronze):
    with pytest.raises(ValueError):
        files.scan_documents(spark, bronze, "other")


def test_file_listing(spark, bronze):
    listed = files.list_files(spark, bronze, "*.json")
    assert listed.columns == ["path"] and listed.count() == 13


def test_whole_pipeline(spark, bronze):
    lake = fresh_path(spark, "lake")
    counts = pipeline.run(spark, bronze, lake)
    assert counts["silver.products"] == 3 and counts["silver.sellers"] == 1 and counts["silver.reviews"] == 2
    assert counts["bronze.rejects"] == 4 and counts["gold.images_url"] == 2 and counts["gold.brands"] == 2
    stored = warehouse.open_warehouse(spark, f"{lake}/warehouse")
    assert {name: df.count() for name, df in stored.items()} == {
        "categories": 2, "sellers": 1, "brands": 2, "authors": 1, "users": 2, "products": 3, "products_authors": 1,
        "images_url": 1, "reviews": 2,
    }
    brand = spark.sql("select brand_name, warranty_period, warranty_type, quantity_sold, return_reason from products join brands using (brand_id) order by product_id")
    assert [tuple(r) for r in brand.collect()] == [
        ("Bút", 180, "Không bảo hành", 0, "Không đổi trả"), ("No Brand", 0, "Không bảo hành", 0, "Không đổi trả"),
        ("No Brand", 180, "Không bảo hành", 0, "Không đổi trả"),
    ]
    priced = stored["products"].filter("product_id = '8'").collect()[0]
    assert (str(priced["price"]), priced["category_id"]) == ("99.50", None)
    review = stored["reviews"].filter("review_id = '1'").collect()[0]
    assert str(review["created_at"]) == "2023-11-14 22:13:20"
    again = pipeline.run(spark, bronze, lake)
    assert again == counts
    assert warehouse.open_warehouse(spark, f"{lake}/warehouse")["reviews"].count() == 2


def test_repeated_key_in_a_batch_is_refused(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b")], "brand_id string, brand_name string")
    with pytest.raises(ValueError):
        warehouse.load_table(df, WAREHOUSE["brands"], fresh_path(spark, "dwh"))


def test_null_key_is_refused_and_kept_apart(spark):
    base = fresh_path(spark, "dwh")
    df = spark.createDataFrame([(None, "a"), ("1", "b")], "brand_id string, brand_name string")
    for _ in range(3):
        warehouse.load_table(df, WAREHOUSE["brands"], base)
    assert [tuple(r) for r in read_current(spark, f"{base}/brands").collect()] == [("1", "b")]
    assert [(r["table_name"], r["reason"]) for r in warehouse.read_rejects(spark, base).collect()] == [("brands", "brand_id not null")] * 3


def test_values_that_do_not_fit_are_refused_not_emptied(spark):
    base = fresh_path(spark, "dwh")
    rows = [("1", "1", "1", "4.5", "2024-01-02 03:04:05"), ("2", "1", "1", "12.5", None), ("3", "1", "1", None, "no date"), ("4", None, "1", None, None)]
    raw = spark.createDataFrame(rows, "review_id string, product_id string, customer_id string, rating string, created_at string")
    raw = raw.selectExpr("*", "'1' as seller_id", "repeat('t', 300) as title", "'c' as content", "1 as thank_count", "cast(null as timestamp) as purchased_at")
    warehouse.load_table(raw, WAREHOUSE["reviews"], base)
    assert [r["review_id"] for r in read_current(spark, f"{base}/reviews").collect()] == ["1"]
    reasons = {json.loads(r["row"])["review_id"]: r["reason"] for r in warehouse.read_rejects(spark, base).collect()}
    assert reasons == {"2": "rating decimal(2,1)", "3": "created_at timestamp", "4": "product_id not null"}


def test_rows_without_parent_are_refused(spark):
    base = fresh_path(spark, "dwh")
    warehouse.load_warehouse({"authors": spark.createDataFrame([("7", "An")], "author_id string, author_name string")}, base)
    bridge = spark.createDataFrame([("1", "1", "7"), ("1", "1", "8")], "product_id string, seller_id string, author_id string")
    warehouse.load_warehouse({"products_authors": bridge}, base)
    # No product is stored, so both rows are refused.
    assert read_current(spark, f"{base}/products_authors").count() == 0
    assert sorted(r["reason"] for r in warehouse.read_rejects(spark, base).collect()) == ["no products", "no products; no authors"]
    warehouse.load_warehouse({"products_authors": bridge}, base, references=False)
    assert read_current(spark, f"{base}/products_authors").count() == 2
    assert warehouse.read_rejects(spark, base).count() == 2


def test_rejects_of_all_loads_are_kept(spark, monkeypatch):
    base, spec = fresh_path(spark, "dwh"), WAREHOUSE["brands"]
    for rows in ([("1", "a"), (None, "b")], [("2", "c")], [(None, "d"), ("3", "x" * 300)]):
        warehouse.load_table(spark.createDataFrame(rows, "brand_id string, brand_name string"), spec, base)
    names = [json.loads(r["row"])["brand_name"][:1] for r in warehouse.read_rejects(spark, base).collect()]
    assert sorted(names) == ["b", "d", "x"]
    # A load that fails leaves no rejects that are read, and the next one replaces them.
    monkeypatch.setattr(warehouse, "publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.load_table(spark.createDataFrame([(None, "e")], "brand_id string, brand_name string"), spec, base)
    monkeypatch.undo()
    assert warehouse.read_rejects(spark, base).count() == 3
    warehouse.load_table(spark.createDataFrame([("4", "f")], "brand_id string, brand_name string"), spec, base)
    assert warehouse.read_rejects(spark, base).count() == 3


def test_null_keys_of_streams_are_refused_once(spark):
    base = fresh_path(spark, "stream")
    upsert, taken = incremental.upsert_batches(f"{base}/t", ["k"], [F.col("v")], "s"), []
    skip = incremental.new_keys_only(f"{base}/seen", ["k"], lambda fresh, i: taken.append(sorted(r["v"] for r in fresh.collect())), [F.col("v")], "s")
    for i in (0, 1, 1):
        batch = spark.createDataFrame([(None, f"n{i}"), (1, f"a{i}"), (i + 2, "b")], "k int, v string")
        upsert(batch, i)
        skip(batch, i)
    assert sorted(tuple(r) for r in read_current(spark, f"{base}/t").collect()) == [(1, "a1"), (2, "b"), (3, "b")]
    assert taken == [["a0", "b"], ["b"], ["b"]]
    for name in ("t", "seen"):
        refused = incremental.read_refused(spark, f"{base}/{name}", batch.schema)
        assert sorted((r["load"], r["v"]) for r in refused.collect()) == [("s-0", "n0"), ("s-1", "n1")]


def test_two_loads_of_one_version_do_not_undo_each_other(spark, monkeypatch):
    base = fresh_path(spark, "table")
    publish(spark.range(3).toDF("i"), base)
    stale = versions._newest(spark, base)
    publish(spark.range(4).toDF("i"), base)
    monkeypatch.setattr(versions, "_newest", lambda s, b: stale)
    with pytest.raises(versions.ConcurrentLoad):
        publish(spark.range(5).toDF("i"), base)
    monkeypatch.undo()
    assert read_current(spark, base).count() == 4


def test_upsert_writes_only_the_buckets_it_touches(spark):
    base = fresh_path(spark, "table")
    publish_upsert(spark.range(200).selectExpr("id as k", "'a' as v"), base, ["k"], "t0", 16)
    first = versions._newest(spark, base)["folders"]
    for i in range(1, 6):
        publish_upsert(spark.createDataFrame([(5, f"v{i}")], "k bigint, v string"), base, ["k"], f"t{i}", 16)
    last = versions._newest(spark, base)["folders"]
    assert sum(first[b] != last[b] for b in last) == 1
    got = {r["k"]: r["v"] for r in read_current(spark, base).collect()}
    assert len(got) == 200 and got[5] == "v5" and got[6] == "a"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/data")
    kept = {s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)}
    assert len(kept) <= 1 + 5


def test_sources_with_equal_batch_numbers_both_arrive(spark):
    base = fresh_path(spark, "stream")
    for name, k in (("a", 1), ("b", 2)):
        incremental.upsert_batches(base, ["k"], [F.col("k")], name)(spark.createDataFrame([(k,)], "k int"), 0)
    assert sorted(r["k"] for r in read_current(spark, base).collect()) == [1, 2]


def test_tagged_load_is_applied_once(spark):
    base = fresh_path(spark, "dwh")
    df = spark.createDataFrame([("1", "a")], "brand_id string, brand_name string")
    assert warehouse.load_table(df, WAREHOUSE["brands"], base, "day1") == 1
    assert warehouse.load_table(df, WAREHOUSE["brands"], base, "day1") is None
    assert current_version(spark, f"{base}/brands") == 1


def test_versions_can_be_read_while_replaced(spark):
    base = fresh_path(spark, "table")
    assert read_current(spark, base) is None
    publish(spark.range(3).toDF("i"), base)
    old = read_current(spark, base)
    publish(old.filter("i > 0"), base)
    assert (old.count(), read_current(spark, base).count()) == (3, 2)


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "Đồ", 2.5), (2, "b,c", None)], "i int, s string, d double")
    files.write_csv(df, str(tmp_path / "c"))
    files.write_json(df, str(tmp_path / "j"))
    files.write_table(df, str(tmp_path / "p"))
    files.write_table(None, str(tmp_path / "none"))
    want = df.orderBy("i").collect()
    assert files.read_csv(spark, str(tmp_path / "c"), df.schema).orderBy("i").collect() == want
    assert spark.read.schema(df.schema).json(str(tmp_path / "j")).orderBy("i").collect() == want
    assert files.read_table(spark, str(tmp_path / "p")).orderBy("i").collect() == want
    assert not files.path_exists(spark, str(tmp_path / "none"))


def test_table_path_words_and_created_table(spark, tmp_path):
    assert files.table_path("s3a://w/", "gold", "shop", "gold_users") == "s3a://w/gold/shop/users.parquet"
    (tmp_path / "w.txt").write_text("a\nb\na\n\n", encoding="utf-8")
    assert sorted(r[0] for r in files.read_words(spark, str(tmp_path / "w.txt")).collect()) == ["a", "b"]
    path = str(tmp_path / "tracking")
    assert files.read_or_create(spark, path, TRACKING_CSV).columns == ["pid", "spid", "seller_id", "category_id", "slug"]
    assert files.path_exists(spark, path) and files.read_or_create(spark, path, TRACKING_CSV).count() == 0


def test_shared_dir_is_the_one_of_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stream_takes_each_file_once(spark):
    base = fresh_path(spark, "stream")
    seen = []

    def handle(batch, batch_id):
        seen.append(sorted(r["k"] for r in batch.collect()))

    for keys in ([1, 2], [3]):
        spark.createDataFrame([(k,) for k in keys], "k bigint").coalesce(1).write.mode("append").json(f"{base}/in")
        incremental.run_available(spark, f"{base}/in", "k bigint", handle, f"{base}/state")
    assert seen == [[1, 2], [3]]


def test_upsert_batch_is_idempotent(spark):
    base = fresh_path(spark, "stream")
    run = incremental.upsert_batches(base, ["k"], [F.desc("t")], "s")
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, v string")
    run(first, 0)
    run(spark.createDataFrame([(1, 3, "x")], first.schema), 1)
    run(first, 0)
    assert sorted(tuple(r) for r in read_current(spark, base).collect()) == [(1, 3, "x"), (2, 1, "c")]


def test_known_keys_are_skipped_and_a_repeated_batch_is_not(spark):
    base = fresh_path(spark, "stream")
    got = {}
    take = lambda fresh, i: got.update({i: sorted(r["v"] for r in fresh.collect())})
    run = incremental.new_keys_only(base, ["k"], take, [F.col("v")], "s")
    run(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), 0)
    run(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), 1)
    run(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), 1)
    assert got == {0: ["a", "b"], 1: ["d"]}
    run(spark.createDataFrame([(4, "f"), (4, "e"), (1, "x")], "k int, v string"), 2)
    assert got[2] == ["e"]
    other = incremental.new_keys_only(base, ["k"], take, [F.col("v")], "t")
    other(spark.createDataFrame([(4, "g"), (5, "h")], "k int, v string"), 0)
    assert got[0] == ["h"]


def test_values_of_other_types_are_read_or_reported(spark):
    docs = {
        "a": '{"id": "7", "review_count": 12.0, "rating_average": "4.5", "sku": 5, "brand": "x", "breadcrumbs": [{"category_id": "3", "name": null}]}',
        "b": '{"id": 7.5, "review_count": "many", "breadcrumbs": {"category_id": 3}, "authors": [1, {"id": null, "name": null}]}',
        "c": "[1]", "d": "", "e": None, "f": '{"id": 1, "breadcrumbs": [{}], "authors": [{"id": null, "name": null}], "extra": {}}', "g": '{"id": null}',
    }
    parsed = files.parse_documents(spark.createDataFrame(list(docs.items()), "k string, doc string"), "doc", "products")
    rows = {r["k"]: r for r in parsed.withColumn("reason", D.reject_reason()).collect()}
    assert (rows["a"]["id"], rows["a"]["review_count"], rows["a"]["rating_average"], rows["a"]["sku"]) == (7, 12, 4.5, "5")
    assert rows["a"]["_unread"] == ["brand"] and rows["a"]["breadcrumbs"][0]["category_id"] == 3 and rows["a"]["reason"] is None
    assert rows["b"]["_unread"] == ["id", "breadcrumbs", "authors[]", "review_count"] and rows["b"]["_missing"] == ["id", "name"]
    assert [rows[k]["reason"] for k in "cdfg"] == ["unreadable", "unreadable", None, "no category"]
    assert rows["e"]["reason"] == "no category" and rows["f"]["authors"][0]["id"] is None


def test_new_keys_are_kept_by_the_state_store_over_restarts(spark, tmp_path):
    schema = "k bigint, v string"

    def drop(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / name))
        incremental.new_keys_stored(spark, str(tmp_path / "in"), schema, ["k"], str(tmp_path / "out"), str(tmp_path / "state"), recursiveFileLookup="true")
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert drop("a", [(1, "a"), (1, "a"), (2, "a"), (None, "a")]) == [(1, "a"), (2, "a")]
    assert drop("b", [(2, "b"), (3, "b"), (None, "b")]) == [(1, "a"), (2, "a"), (3, "b")]
    assert drop("c", [(1, "c"), (3, "c")]) == [(1, "a"), (2, "a"), (3, "b")]
