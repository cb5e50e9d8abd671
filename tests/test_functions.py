import re

import pytest
from pyspark.sql import functions as F

from marketlens.functions import cleaning as C
from marketlens.functions import display as X
from marketlens.functions import text as TX


def column(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


WARRANTY = {
    None: 0, "": 0, "Không bảo hành": 0, "Trọn đời": 36500, "2 năm": 730, "6 tháng": 180, "15 ngày": 15,
    "1 năm 6 tháng": 365, "10 tháng": 0, "abc": 0, "No Warranty": 0, "3year": 1095, " 12 Months ": 360,
}


def test_warranty_days(spark):
    assert column(spark, list(WARRANTY), C.warranty_days) == list(WARRANTY.values())


def test_warranty_days_lenient_about_digit_zero(spark):
    got = column(spark, ["10 tháng", "0 tháng", "20 năm"], lambda x: C.warranty_days(x, strict_zero=False))
    assert got == [300, 0, 7300]


def test_joined_days(spark):
    cases = {None: 0, "Đã tham gia 3 năm": 1095, "2 tháng": 60, "9 ngày": 9, "3năm": 0, "3 NĂM": 0}
    assert column(spark, list(cases), C.joined_days) == list(cases.values())


def test_durations_beyond_an_int_are_no_days(spark):
    assert column(spark, ["9999999 year", "99999999999 năm"], C.warranty_days) == [0, 0]
    assert column(spark, ["9999999 năm", "99999999999 tháng"], C.joined_days) == [0, 0]


def test_return_label(spark):
    got = column(spark, ["any_reason", "defective_product", "no_return", None, "x"], C.return_label)
    assert got == ["Bất cứ lý do gì", "Sản phẩm hư hỏng", "Không đổi trả", "Không đổi trả", "x"]


def test_null_defaults(spark):
    assert column(spark, [1.0, None], lambda x: C.number_or(x, 0), "double") == [1.0, 0.0]
    assert column(spark, ["a", None], lambda x: C.text_or(x, "d")) == ["a", "d"]
    assert column(spark, [0, None], lambda x: C.epoch_timestamp(x).isNull(), "bigint") == [False, True]


def test_flag(spark):
    assert column(spark, ["true", "1", "0", "False", None], C.flag) == [True, True, False, False, None]


LINK = r"((http|https)\:\/\/)?[a-zA-Z0-9\.\/\?\:@\-_=#]+\.([a-zA-Z]){2,6}([a-zA-Z0-9\.\&\/\?\:@\-_=#])*"


def stated_rule(text):
    """The normalisation rule in plain Python."""
    text = re.sub(LINK, "", text.lower())
    text = re.sub(r"[\r\n]+", " ", text).replace("/", " ").replace(",", " ")
    return re.sub(r"[\s]{2,}", " ", re.sub(r"[^\w\s]", "", text))


TEXTS = [
    "Sách Hay, giá/rẻ!", "xem https://a.example.com/x?y=1&z=2 ngay", "tốt.mua ngay", "dòng\r\nmới", "a..b .com x.y z.ab",
    "x&d.ef a.bc&d.ef,", "một\u00a0hai",
]


def test_normalize_text_follows_the_stated_rule(spark):
    assert column(spark, TEXTS, TX.normalize_text) == [stated_rule(t.replace("\u00a0", " ")) for t in TEXTS]


def test_normalize_text_is_linear_on_an_unbroken_run(spark):
    assert column(spark, ["a" * 200_000], lambda x: F.length(TX.normalize_text(x))) == [200_000]


def test_words_and_pairs(spark):
    assert column(spark, [" a  b ", ""], TX.words) == [["a", "b"], []]
    assert column(spark, ["Ấm-trà x_1 22"], TX.find_words) == [["ấm", "trà", "x_1", "22"]]
    assert column(spark, ["a b c", "a"], lambda x: TX.word_pairs(TX.words(x))) == [["a b", "b c"], []]


def test_display(spark):
    url = "https://i.example/ts/product/a.jpg"
    assert column(spark, [url], lambda x: X.image_url(x, "thumbnail")) == ["https://i.example/cache/200x280/ts/product/a.jpg"]
    with pytest.raises(ValueError):
        X.image_url(F.lit(url), "huge")
    assert column(spark, ["n" * 54, "n" * 55], X.short_name) == ["n" * 54, "n" * 45 + "..."]
    assert column(spark, [0.9, 4.7, 5.0], X.stars, "double") == ["☆☆☆☆☆", "★★★★☆", "★★★★★"]
    assert column(spark, [2528841], X.thousands, "bigint") == ["2,528,841"]
    assert column(spark, [0, 12], X.discount_badge, "int") == ["", "-12%"]
    assert column(spark, ["A / B"], X.trail) == ["A > B"]
    assert column(spark, ["x<img src='a'>y"], X.without_images) == ["xy"]


def test_item_key_parts(spark):
    assert column(spark, ["12_3", "9999999999_7", "x", None], lambda x: X.item_key_part(x, 0)) == [12, 9999999999, None, None]
    assert column(spark, ["12_3", "12"], lambda x: X.item_key_part(x, 1)) == [3, None]


def test_category_link(spark):
    assert column(spark, ["/sach/c8322"], X.link_slug) == ["sach"]
    assert column(spark, ["/sach/c8322", "/x"], X.link_category) == [8322, None]
