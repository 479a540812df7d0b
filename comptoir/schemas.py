"""Explicit schemas of the reference's tables (read with these instead of inferring)."""

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


# Listing rows written by the search-page extractor.
LISTING = T.StructType([T.StructField(n, S) for n in
                        ("titre", "url", "prix", "note", "nombre_avis", "image_url", "asin")]
                       + [T.StructField("page", T.IntegerType())])

# Technical details in long form (one row per spec header).
DETAILS_LONG = _strings("asin", "titre", "url", "spec_key", "spec_value", "error")

FACET_VALUE = T.StructType([T.StructField(n, S) for n in ("name", "url", "filter_key", "filter_value")])
FACETS = T.StructType([
    T.StructField("category", S),
    T.StructField("product_urls", T.ArrayType(S)),
    T.StructField("filters", T.MapType(S, T.ArrayType(FACET_VALUE))),
])

REVIEWS = T.StructType([
    T.StructField("asin", S), T.StructField("reviewer", S), T.StructField("rating", T.DoubleType()),
    T.StructField("title", S), T.StructField("date", S), T.StructField("location", S),
    T.StructField("verified_purchase", T.BooleanType()), T.StructField("comment", S),
    T.StructField("helpful_count", T.IntegerType()),
])

# Warehouse tables (all text, loaded positionally from CSV).
PRODUCT_INFO1 = _strings("asin", "manufacturer", "processor_type", "hard_drive_size",
                         "hard_disk_description", "ram_size", "url")
PRODUCT_INFO2 = _strings("asin", "nombre_avis", "prix", "page", "note", "url", "titre")
REVIEW_SENTIMENT = _strings("asin", "sentiment")
PRICE_CLASS = T.StructType([T.StructField("classe", S), T.StructField("prix_min", T.DoubleType()),
                            T.StructField("prix_max", T.DoubleType())])

COMMENTS = _strings("asin", "comment")

METRIC_SAMPLES = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("kind", S), T.StructField("name", S), T.StructField("category", S),
    T.StructField("value", T.DoubleType()),
])

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", S), T.StructField("html", S)])
