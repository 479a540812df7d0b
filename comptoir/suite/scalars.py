"""Registered queries: scalar functions (STR-*, NUM-01, JSN-01) over fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fx, table, with_fx
from ..functions import review as RV
from ..functions import text as TX
from ..functions import url as U

Q: dict = {}
O: dict = {}


def _union_urls(spark, sf):
    p1 = fx(spark, sf, "fx_product_info1").select("asin", "url")
    p2 = fx(spark, sf, "fx_product_info2").select("asin", "url")
    return p1.unionByName(p2)


URLS_SQL = "(SELECT asin, url FROM fx_product_info1 UNION ALL SELECT asin, url FROM fx_product_info2)"


def q_asin_from_url(spark, sf):
    return _union_urls(spark, sf).select("asin", "url", U.asin_from_url("url").alias("asin_regex"),
                                         U.asin_by_split("url").alias("asin_split"))


def _asin_sql(x):
    pats = [r"/dp/([A-Z0-9]{10})/?", r"/gp/product/([A-Z0-9]{10})/?", r"/ASIN/([A-Z0-9]{10})/?",
            r"(?:product|dp|gp/product)/([A-Z0-9]{10})/?"]
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({x}, '{p}', 1), '')" for p in pats) + ")"


O["asin_from_url"] = with_fx(
    f"SELECT asin, url, {_asin_sql('url')} AS asin_regex, "
    "nullif(CASE WHEN url LIKE '%/dp/%' THEN split_part(split_part(url, '/dp/', 2), '/', 1) "
    "WHEN url LIKE '%/gp/product/%' THEN split_part(split_part(url, '/gp/product/', 2), '/', 1) END, '') "
    f"AS asin_split FROM {URLS_SQL} u", "fx_product_info1", "fx_product_info2")


def _initcap_sql(x):
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"


def q_slug_title(spark, sf):
    p2 = fx(spark, sf, "fx_product_info2")
    u = F.concat(F.lit("https://shop.example/dp/"), F.col("asin"), F.lit("/"),
                 F.replace(F.col("titre"), F.lit(" "), F.lit("-")))
    return p2.select("asin", U.slug_title(u).alias("slug_title"))


O["slug_title"] = with_fx(
    "SELECT asin, " + _initcap_sql("replace(regexp_extract(u, '[^/]*$', 0), '-', ' ')") + " AS slug_title "
    "FROM (SELECT asin, 'https://shop.example/dp/' || asin || '/' || replace(titre, ' ', '-') AS u "
    "FROM fx_product_info2) t", "fx_product_info2")


def q_build_url(spark, sf):
    part = table(spark, sf, "part")
    params = F.create_map(F.lit("k"), F.col("p_name"), F.lit("page"), F.col("p_size").cast("string"))
    return part.select("p_partkey", U.build_url(F.lit("s"), params).alias("url"),
                       U.build_url(F.concat(F.lit("/dp/B"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")))
                       .alias("product_url"))


O["build_url"] = (
    "SELECT p_partkey, 'https://shop.example/s?k=' || replace(p_name, ' ', '+') || '&page=' || "
    "CAST(p_size AS VARCHAR) AS url, 'https://shop.example/dp/B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') "
    "AS product_url FROM part")


def _raw_key():
    return F.concat(F.lit("\\data\\"), F.col("p_brand"), F.lit("//"), F.lit("/"),
                    F.replace(F.col("p_type"), F.lit(" "), F.lit("_")), F.lit(".csv"))


def q_object_key(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", U.object_key(_raw_key()).alias("object_key"))


O["object_key"] = (
    "SELECT p_partkey, regexp_replace(regexp_replace(replace('\\data\\' || p_brand || '//' || '/' || "
    "replace(p_type, ' ', '_') || '.csv', '\\', '/'), '/+', '/', 'g'), '^/', '') AS object_key FROM part")


def q_sentinel_null(spark, sf):
    p2 = fx(spark, sf, "fx_product_info2")
    return p2.select("asin", TX.sentinel_to_null("prix", TX.LISTING_SENTINELS["prix"]).alias("prix"),
                     TX.sentinel_to_null("note", TX.LISTING_SENTINELS["note"]).alias("note"),
                     TX.null_to_sentinel(TX.sentinel_to_null("prix", TX.LISTING_SENTINELS["prix"]),
                                         TX.LISTING_SENTINELS["prix"]).alias("prix_back"))


O["sentinel_null"] = with_fx(
    "SELECT asin, nullif(prix, 'Prix non disponible') AS prix, nullif(note, 'Note non disponible') AS note, "
    "coalesce(nullif(prix, 'Prix non disponible'), 'Prix non disponible') AS prix_back FROM fx_product_info2",
    "fx_product_info2")


def q_parse_rating(spark, sf):
    r = fx(spark, sf, "fx_reviews")
    star = F.concat(F.lit("a-icon a-star-"), (F.col("l_linenumber") % 5 + 1).cast("string"))
    text = F.when(F.col("l_linenumber") != 6, F.col("rating_text"))
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    RV.parse_rating("rating_text").alias("rating"),
                    RV.parse_rating(text, star).alias("rating_or_class"))


O["parse_rating"] = with_fx(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    r"coalesce(CAST(nullif(regexp_extract(rating_text, '(\d+\.\d+|\d+)', 1), '') AS DOUBLE), 0.0) AS rating, "
    r"CASE WHEN l_linenumber <> 6 THEN coalesce(CAST(nullif(regexp_extract(rating_text, '(\d+\.\d+|\d+)', 1), '') AS DOUBLE), 0.0) "
    r"ELSE coalesce(CAST(nullif(regexp_extract('a-icon a-star-' || CAST(l_linenumber % 5 + 1 AS VARCHAR), 'a-star-(\d+)', 1), '') AS DOUBLE), 0.0) END "
    "AS rating_or_class FROM fx_reviews", "fx_reviews")


def q_review_date_location(spark, sf):
    r = fx(spark, sf, "fx_reviews")
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    RV.review_location("date_text").alias("location"),
                    RV.review_date("date_text").alias("date"))


O["review_date_location"] = with_fx(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CASE WHEN regexp_matches(date_text, 'Reviewed in (.*?) on (.*)') THEN regexp_extract(date_text, 'Reviewed in (.*?) on (.*)', 1) ELSE 'Unknown' END AS location, "
    "CASE WHEN regexp_matches(date_text, 'Reviewed in (.*?) on (.*)') THEN regexp_extract(date_text, 'Reviewed in (.*?) on (.*)', 2) ELSE date_text END AS date "
    "FROM fx_reviews", "fx_reviews")


def q_helpful_votes(spark, sf):
    r = fx(spark, sf, "fx_reviews")
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    RV.helpful_votes("helpful_text").alias("helpful_count"))


O["helpful_votes"] = with_fx(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    r"coalesce(TRY_CAST(nullif(regexp_extract(helpful_text, '(\d+)', 1), '') AS INTEGER), 0) AS helpful_count "
    "FROM fx_reviews", "fx_reviews")


def _raw_spec():
    lrm = F.lit(TX.LRM)
    return F.concat(F.when(F.col("p_partkey") % 2 == 0, lrm).otherwise(F.lit("")), F.col("p_brand"),
                    F.lit("\n "), F.col("p_type"), F.lit("   x"), F.lit("  "))


def q_clean_spec_text(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", TX.clean_spec_text(_raw_spec()).alias("spec_value"))


O["clean_spec_text"] = (
    "SELECT p_partkey, CASE WHEN starts_with(x, chr(8206)) THEN substr(x, 2) ELSE x END AS spec_value FROM ("
    "SELECT p_partkey, replace(replace(regexp_replace(CASE WHEN p_partkey % 2 = 0 THEN chr(8206) ELSE '' END || p_brand || "
    "chr(10) || ' ' || p_type || '   x' || '  ', '^\\s+|\\s+$', '', 'g'), chr(10), ' '), '  ', ' ') AS x FROM part) t")


def q_run_id(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", TX.run_id(F.col("ts").cast("timestamp")).alias("run_id"))


O["run_id"] = "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id FROM events"


def q_fill_defaults(spark, sf):
    """Null -> default label, null -> the text 'nan' as ``astype(str)`` gives."""
    p1 = fx(spark, sf, "fx_product_info1")
    return p1.select("asin", F.coalesce("manufacturer", F.lit("nan")).alias("manufacturer"),
                     F.coalesce("hard_drive_size", F.lit("Unknown")).alias("hard_drive_size"))


O["fill_defaults"] = with_fx(
    "SELECT asin, coalesce(manufacturer, 'nan') AS manufacturer, coalesce(hard_drive_size, 'Unknown') "
    "AS hard_drive_size FROM fx_product_info1", "fx_product_info1")


def q_json_roundtrip(spark, sf):
    """to_json -> text -> from_json with the declared schema gives the rows back (JSN-01)."""
    p2 = fx(spark, sf, "fx_product_info2")
    schema = p2.schema
    enc = p2.select(F.to_json(F.struct(*p2.columns)).alias("j"))
    return enc.select(F.from_json("j", schema).alias("r")).select("r.*")


O["json_roundtrip"] = with_fx("SELECT * FROM fx_product_info2", "fx_product_info2")


def q_metric_summary(spark, sf):
    """Totals per metric name with unit conversions: s -> h, bytes -> MB (NUM-01)."""
    m = fx(spark, sf, "fx_metric_samples")
    g = m.groupBy("name").agg(F.sum("value").alias("total"))
    return g.select("name", TX.seconds_to_hours("total").alias("hours"),
                    TX.bytes_to_mb(F.col("total") * 1e6).alias("mb"))


O["metric_summary"] = with_fx(
    "SELECT name, round(sum(value) / 3600.0, 2) AS hours, round(sum(value) * 1e6 / (1024.0 * 1024.0), 2) AS mb "
    "FROM fx_metric_samples GROUP BY name", "fx_metric_samples")


def q_facet_filter_parse(spark, sf):
    """Facet link URLs built from part -> (filter_key, filter_value), first new pair."""
    part = table(spark, sf, "part")
    u = F.concat(F.lit("https://shop.example/s?i=computers&rh=n%3A429886031%2Cp_89%3A"),
                 F.replace(F.col("p_brand"), F.lit("#"), F.lit("")), F.lit("%2Cp_n_size%3A"),
                 F.col("p_size").cast("string"),
                 F.when(F.col("p_partkey") % 3 == 0, F.lit("&rh=p_1%3Ax")).otherwise(F.lit("")),
                 F.lit("&s=popularity-rank"))
    url = F.when(F.col("p_partkey") % 11 == 0, F.lit("https://shop.example/s?k=laptop")).otherwise(u)
    f = U.facet_filter(url)
    return part.select("p_partkey", f["filter_key"].alias("filter_key"), f["filter_value"].alias("filter_value"))


O["facet_filter_parse"] = (
    "WITH u AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'https://shop.example/s?k=laptop' ELSE "
    "'https://shop.example/s?i=computers&rh=n%3A429886031%2Cp_89%3A' || replace(p_brand, '#', '') || "
    "'%2Cp_n_size%3A' || CAST(p_size AS VARCHAR) || CASE WHEN p_partkey % 3 = 0 THEN '&rh=p_1%3Ax' ELSE '' END "
    "|| '&s=popularity-rank' END AS url FROM part), "
    "r AS (SELECT p_partkey, CASE WHEN url LIKE '%rh=%' THEN replace(replace(split_part(split_part(url, 'rh=', 2), '&', 1), '%3A', ':'), '%2C', ',') END AS rh FROM u) "
    "SELECT p_partkey, regexp_extract_all(rh, '([p|n]_[^:,]+):([^,]+)', 1)[1] AS filter_key, "
    "regexp_extract_all(rh, '([p|n]_[^:,]+):([^,]+)', 2)[1] AS filter_value FROM r")

for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
