"""Property tests: Spark expressions against plain-Python models of the rules."""

import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from comptoir.functions import review as RV
from comptoir.functions.price import parse_price
from comptoir.functions.storage import storage_gb, storage_gb_1024

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def spark_values(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[1] for r in df.select("i", fn("x")).orderBy("i").collect()]


def py_float(s):
    try:
        return float(s)
    except (TypeError, ValueError):
        return None


def py_number_text(v):
    if v is None or v != v or abs(v) >= 1e32:
        return None
    t = format(Decimal(repr(v)), "f")
    return re.sub(r"\.?0+$", "", t) if "." in t else t


def py_storage_gb(s):
    if s is None:
        return None
    up = s.upper()
    if "TB" in up:
        v = py_float(s[:-2])
        return None if v is None else (None if py_number_text(v * 1000) is None else py_number_text(v * 1000) + " GB")
    if "GB" in up:
        v = py_float(s[:-2])
        return None if v is None or py_number_text(v) is None else py_number_text(v) + " GB"
    return None


def py_storage_1024(s):
    if s is None:
        return None
    m = re.search(r"[0-9]+", s)
    n = int(m.group(0)) if m and int(m.group(0)) < 2 ** 63 else None
    if "TB" in s:
        return None if n is None or n * 1024 >= 2 ** 63 else n * 1024
    if "GB" in s:
        return n
    return None


number = st.one_of(st.integers(0, 5000).map(str),
                   st.tuples(st.integers(0, 5000), st.integers(0, 999)).map(lambda t: f"{t[0]}.{t[1]:03d}"))
storage_text = st.tuples(st.sampled_from(["", " "]), number, st.sampled_from(["TB", "GB", " gb", " Tb", "GB SSD", "MB", ""])) \
    .map(lambda t: t[0] + t[1] + t[2])
price_text = st.tuples(st.sampled_from(["£", ""]), st.integers(0, 3_000_000), st.integers(0, 99)).map(
    lambda t: f"{t[0]}{t[1]:,}.{t[2]:02d}") | st.sampled_from(["Prix non disponible", "", "£", "1..2"])


@SETTINGS
@given(st.lists(storage_text, min_size=40, max_size=40))
def test_storage_gb_model(spark, values):
    assert spark_values(spark, values, storage_gb) == [py_storage_gb(v) for v in values]


@SETTINGS
@given(st.lists(storage_text | st.just("99999999999999999999TB"), min_size=40, max_size=40))
def test_storage_1024_model(spark, values):
    assert spark_values(spark, values, storage_gb_1024) == [py_storage_1024(v) for v in values]


@SETTINGS
@given(st.lists(price_text, min_size=40, max_size=40))
def test_price_model(spark, values):
    model = [py_float(v.replace("£", "").replace(",", "")) for v in values]
    assert spark_values(spark, values, parse_price) == model


helpful_text = st.text(alphabet="0123456789 ,people found this helpful One", max_size=30)
date_text = st.tuples(st.sampled_from(["Reviewed in ", "", "reviewed in "]), st.text(alphabet="abc XY", max_size=8),
                      st.sampled_from([" on ", " ", " on on "]), st.text(alphabet="0123 May", max_size=10)) \
    .map(lambda t: "".join(t))


@SETTINGS
@given(st.lists(helpful_text, min_size=40, max_size=40))
def test_helpful_model(spark, values):
    model = [int(m.group(1)) if (m := re.search(r"(\d+)", v)) else 0 for v in values]
    model = [m if m < 2 ** 31 else None for m in model]
    got = spark_values(spark, values, RV.helpful_votes)
    assert [g if m is not None else None for g, m in zip(got, model)] == model


@SETTINGS
@given(st.lists(date_text, min_size=40, max_size=40))
def test_date_location_model(spark, values):
    def model(s):
        t = s.strip()
        m = re.search(r"Reviewed in (.*?) on (.*)", t)
        return (m.group(1), m.group(2)) if m else ("Unknown", t)
    loc = spark_values(spark, values, RV.review_location)
    date = spark_values(spark, values, RV.review_date)
    assert list(zip(loc, date)) == [model(v) for v in values]
