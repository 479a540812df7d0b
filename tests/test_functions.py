"""Scalar expressions against the edge rows of FIXTURES.md section 3."""

import pytest
from pyspark.sql import functions as F

from comptoir.functions import review as RV
from comptoir.functions import text as TX
from comptoir.functions import url as U
from comptoir.functions.price import parse_price, parse_price_number, price_bands
from comptoir.functions.storage import storage_gb, storage_gb_1024
from comptoir.operators.joins import price_class_join


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_price_number_and_band(spark):
    vals = ["£500.40", "£500.50", "£1,500.01", "£1,500.50", "£1,000,001.00", "Prix non disponible"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, prix string")
    out = {r.i: (r.n, r.classe) for r in price_class_join(df, price_bands(spark))
           .withColumn("n", parse_price_number("prix").cast("long")).collect()}
    assert out == {0: (500, "Bas"), 1: (501, "Moyen"), 2: (1500, "Moyen"), 3: (1501, "Élevé"),
                   4: (1000001, None), 5: (None, None)}


def test_price_strict_raises(spark):
    df = spark.createDataFrame([("Prix non disponible",)], "p string")
    with pytest.raises(Exception):
        df.select(parse_price("p", strict=True)).collect()
    assert df.select(parse_price("p")).first()[0] is None
    assert one_col(spark, ["£1,299.00"], parse_price) == [1299.0]


def test_storage_gb(spark):
    got = one_col(spark, ["1.5TB", "20000TB", "512 gb", "512 GB SSD", "500 MB", None], storage_gb)
    assert got == ["1500 GB", "20000000 GB", "512 GB", None, None, None]


def test_storage_gb_1024(spark):
    assert one_col(spark, ["2TB", "512 GB SSD", "512 gb"], storage_gb_1024) == [2048, 512, None]


def test_asin_patterns(spark):
    got = one_col(spark, ["https://x/dp/B08N5KWB9H", "https://x/gp/product/B08N5KWB9H/x",
                          "https://x/ASIN/B08N5KWB9H", "https://x/dp/short"], U.asin_from_url)
    assert got == ["B08N5KWB9H"] * 3 + [None]


def test_facet_filter(spark):
    df = spark.createDataFrame([("https://a/s?rh=n%3A429886031%2Cp_n_feature%3A12345&x=1",),
                                ("https://a/s?k=z",)], "u string")
    got = [tuple(r) for r in df.select(U.facet_filter("u").alias("f")).select("f.*").collect()]
    assert got == [("p_n_feature", "12345"), (None, None)]


def test_rating(spark):
    df = spark.createDataFrame([("4.5 out of 5 stars", None), ("5", None), (None, "a-icon a-star-3"), (None, None)],
                               "t string, c string")
    assert [r[0] for r in df.select(RV.parse_rating("t", "c")).collect()] == [4.5, 5.0, 3.0, 0.0]


def test_review_date_location(spark):
    df = spark.createDataFrame([("Reviewed in the United Kingdom on 3 May 2024",), ("3 May",), (None,)], "d string")
    got = [tuple(r) for r in df.select(RV.review_location("d"), RV.review_date("d")).collect()]
    assert got == [("the United Kingdom", "3 May 2024"), ("Unknown", "3 May"), ("Unknown", "Date inconnue")]


def test_helpful(spark):
    got = one_col(spark, ["12 people found this helpful", "1,234 people", "One person found this", None],
                  RV.helpful_votes)
    assert got == [12, 1, 0, 0]


def test_spec_text(spark):
    got = one_col(spark, ["‎16 GB\n DDR4", "a   b"], TX.clean_spec_text)
    assert got == ["16 GB DDR4", "a  b"]


def test_object_key(spark):
    assert one_col(spark, ["a\\b//c.csv", "//x"], U.object_key) == ["a/b/c.csv", "x"]


def test_slug_title_and_split(spark):
    assert one_col(spark, ["https://x/dp/B1/my-nice-laptop"], U.slug_title) == ["My Nice Laptop"]
    assert one_col(spark, ["https://x/dp/B08N5KWB9H/ref", "https://x/gp/product/B1/", "https://x/y"],
                   U.asin_by_split) == ["B08N5KWB9H", "B1", None]


def test_build_url(spark):
    df = spark.createDataFrame([("s",)], "p string")
    got = df.select(U.build_url("p", F.create_map(F.lit("k"), F.lit("a b")))).first()[0]
    assert got == "https://shop.example/s?k=a+b"
    assert df.select(U.build_url(F.lit("dp/X"))).first()[0] == "https://shop.example/dp/X"


def test_html_link_and_blank(spark):
    df = spark.createDataFrame([("u", "t"), ("  ", "t"), (None, "t")], "u string, t string")
    assert [r[0] for r in df.select(TX.html_link("u", "t")).collect()] == [
        '<a href="u" target="_blank">t</a>', "t", "t"]
    assert one_col(spark, ["  a \n", "   ", None], TX.blank_to_null) == ["a", None, None]


def test_run_id(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05' AS ts")
    assert df.select(TX.run_id("ts")).first()[0] == "20240102_030405"


def test_lenient_storage_never_raises(spark):
    assert one_col(spark, ["1e40TB", "99999999999999999999TB"], storage_gb) == [None, "99999999999999990000000 GB"]
    assert one_col(spark, ["9999999999999999TB"], storage_gb_1024) == [None]
