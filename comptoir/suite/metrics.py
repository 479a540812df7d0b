"""Registered queries: run metrics, alerts, run statistics and report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fx, table, with_fx
from ..functions.price import parse_price
from ..functions.review import parse_rating
from ..operators import aggregates as A
from ..operators import metrics as M
from ..plans import report as R
from ..sources import writers as W
from . import sqlbits as S

Q: dict = {}
O: dict = {}
FXM = "fx_metric_samples"


def _log(spark, sf):
    return fx(spark, sf, FXM)


def _ts(c="ts"):
    return F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def _ts_sql(c="ts"):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def q_metric_counters(spark, sf):
    return M.counters(_log(spark, sf))


O["metric_counters"] = with_fx(
    f"SELECT name, count(*) AS increments, round(sum(value), 6) AS total FROM {FXM} WHERE kind = 'error' GROUP BY name", FXM)


def q_metric_gauges(spark, sf):
    g = M.gauges(_log(spark, sf))
    return g.select("name", "value", _ts().alias("ts"))


O["metric_gauges"] = with_fx(
    f"SELECT name, value, {_ts_sql()} AS ts FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC, "
    f"event_id DESC) rn FROM {FXM} WHERE kind = 'gauge') t WHERE rn = 1", FXM)


def q_metric_errors(spark, sf):
    return M.error_counts(_log(spark, sf))


O["metric_errors"] = with_fx(
    f"SELECT CASE WHEN grouping(category) = 1 THEN 'total' ELSE category END AS error_type, count(*) AS n FROM {FXM} WHERE kind = 'error' GROUP BY ROLLUP (category)", FXM)


def q_request_stats(spark, sf):
    return M.request_stats(_log(spark, sf))


O["request_stats"] = with_fx(
    f"SELECT round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max, count(*) AS count FROM "
    f"(SELECT value FROM {FXM} WHERE kind = 'duration' ORDER BY ts DESC, event_id DESC LIMIT 100) t", FXM)


def q_category_stats(spark, sf):
    return M.category_stats(_log(spark, sf))


O["category_stats"] = with_fx(
    f"SELECT category, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max, count(*) AS count FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY category ORDER BY ts DESC, event_id DESC) rn FROM {FXM} "
    "WHERE kind = 'duration') t WHERE rn <= 100 GROUP BY category", FXM)


def q_rolling_last_100(spark, sf):
    r = M.rolling_last_n(_log(spark, sf), 100)
    # rolling_avg = rolling_sum / rolling_n; the exact sum is compared (a 6-digit
    # rounded mean can tie-break differently between engines).
    return r.withColumn("ts", _ts()).withColumn("rolling_sum", F.round("rolling_sum", 2)).drop("rolling_avg")


O["rolling_last_100"] = with_fx(
    f"SELECT event_id, {_ts_sql()} AS ts, category, value, round(sum(value) OVER w, 2) AS rolling_sum, min(value) OVER w AS rolling_min, "
    f"max(value) OVER w AS rolling_max, count(*) OVER w AS rolling_n FROM {FXM} WHERE kind = 'duration' "
    "WINDOW w AS (PARTITION BY category ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)", FXM)


def q_success_rate(spark, sf):
    return M.success_rate(_log(spark, sf), by="category", total_label="all")


_REQUESTS = "CAST(count_if(kind <> 'gauge') AS BIGINT)"
_RATE = "CASE WHEN count_if(kind <> 'gauge') > 0 THEN round((1 - count_if(kind = 'error') / count_if(kind <> 'gauge')) * 100, 2) ELSE 0.0 END"
O["success_rate"] = with_fx(
    f"SELECT category, {_REQUESTS} AS requests, CAST(count_if(kind = 'error') AS BIGINT) AS errors, {_RATE} AS success_rate FROM {FXM} GROUP BY category "
    f"UNION ALL SELECT 'all', {_REQUESTS}, CAST(count_if(kind = 'error') AS BIGINT), {_RATE} FROM {FXM}", FXM)


def q_alert_windows(spark, sf):
    a = M.alerts(M.windowed_rates(_log(spark, sf), "1 hour"))
    return a.withColumn("window_start", _ts("window_start"))


O["alert_windows"] = with_fx(
    "SELECT window_start, requests, errors, error_rate_pct, concat_ws(',', CASE WHEN error_rate_pct > 5.0 THEN 'error_rate' END, "
    "CASE WHEN requests < 100 THEN 'throughput' END) AS alerts FROM (SELECT window_start, requests, errors, "
    "CASE WHEN requests > 0 THEN round(errors * 100.0 / requests, 4) ELSE 0.0 END AS error_rate_pct FROM ("
    f"SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, {_REQUESTS} AS requests, "
    f"CAST(count_if(kind = 'error') AS BIGINT) AS errors FROM {FXM} GROUP BY 1) c) x "
    "WHERE error_rate_pct > 5.0 OR requests < 100", FXM)


def _products(spark, sf):
    p1 = fx(spark, sf, "fx_product_info1")
    p2 = fx(spark, sf, "fx_product_info2")
    from ..plans.segmentation import fix_processor
    return p1.join(p2, "asin").select("asin", fix_processor("processor_type").alias("category"),
                                      parse_price("prix").alias("price"))


def q_price_stats(spark, sf):
    s = A.numeric_stats(_products(spark, sf), "price")
    return s.withColumn("mean", F.round("mean", 6))


O["price_stats"] = with_fx(
    f"SELECT count(p) AS count, min(p) AS min, max(p) AS max, round(avg(p), 6) AS mean, CAST(median(p) AS DOUBLE) AS median FROM "
    f"(SELECT {S.price_double('prix')} AS p FROM fx_product_info2) t", "fx_product_info2")


def _stats(spark, sf):
    reviews = fx(spark, sf, "fx_reviews").select(parse_rating("rating_text").alias("rating"))
    run_ts = table(spark, sf, "events").agg(F.max("ts")).scalar().cast("timestamp")
    return R.run_statistics(_products(spark, sf), reviews, run_ts, digits=6)


def q_run_statistics(spark, sf):
    return _stats(spark, sf)


_RATING = r"coalesce(CAST(nullif(regexp_extract(rating_text, '(\d+\.\d+|\d+)', 1), '') AS DOUBLE), 0.0)"
STATS_SQL = with_fx(
    f"WITH prod AS (SELECT {S.fix_processor('p1.processor_type')} AS category, {S.price_double('p2.prix')} AS price "
    "FROM fx_product_info1 p1 JOIN fx_product_info2 p2 ON p1.asin = p2.asin), "
    f"rv AS (SELECT {_RATING} AS rating FROM fx_reviews) "
    "SELECT 'products' AS section, 'total_products' AS metric, CAST(count(*) AS VARCHAR) AS value FROM prod "
    "UNION ALL SELECT 'products.categories', category, CAST(count(*) AS VARCHAR) FROM prod WHERE category IS NOT NULL GROUP BY category "
    f"UNION ALL SELECT 'products.price_stats', 'min', {S.number_text('min(price)')} FROM prod "
    f"UNION ALL SELECT 'products.price_stats', 'max', {S.number_text('max(price)')} FROM prod "
    f"UNION ALL SELECT 'products.price_stats', 'mean', {S.number_text('avg(price)')} FROM prod "
    f"UNION ALL SELECT 'products.price_stats', 'median', {S.number_text('median(price)')} FROM prod "
    "UNION ALL SELECT 'reviews', 'total_reviews', CAST(count(*) AS VARCHAR) FROM rv "
    f"UNION ALL SELECT 'reviews', 'average_rating', {S.number_text('coalesce(avg(rating), 0.0)')} FROM rv "
    f"UNION ALL SELECT 'reviews.rating_distribution', {S.number_text('rating')}, CAST(count(*) AS VARCHAR) FROM rv GROUP BY rating "
    "UNION ALL SELECT 'run', 'run_id', strftime(max(ts), '%Y%m%d_%H%M%S') FROM events "
    "UNION ALL SELECT 'run', 'timestamp', strftime(max(ts), '%Y-%m-%dT%H:%M:%S') FROM events",
    "fx_product_info1", "fx_product_info2", "fx_reviews")
O["run_statistics"] = STATS_SQL


def q_run_statistics_doc(spark, sf):
    """Nested statistics document (one row), checked on its scalar leaves."""
    doc = R.run_statistics_doc(_stats(spark, sf))
    return doc.select(F.col("products.total_products").alias("total_products"),
                      F.size("products.categories").alias("n_categories"),
                      F.col("reviews.total_reviews").alias("total_reviews"),
                      F.size("reviews.rating_distribution").alias("n_ratings"), "run_id")


O["run_statistics_doc"] = with_fx(
    f"SELECT (SELECT count(*) FROM fx_product_info1 p1 JOIN fx_product_info2 p2 ON p1.asin = p2.asin) AS total_products, "
    f"(SELECT CAST(count(DISTINCT {S.fix_processor('processor_type')}) AS INTEGER) FROM fx_product_info1 p1 JOIN fx_product_info2 p2 ON p1.asin = p2.asin) AS n_categories, "
    f"(SELECT count(*) FROM fx_reviews) AS total_reviews, (SELECT CAST(count(DISTINCT {_RATING}) AS INTEGER) FROM fx_reviews) AS n_ratings, "
    "(SELECT strftime(max(ts), '%Y%m%d_%H%M%S') FROM events) AS run_id", "fx_product_info1", "fx_product_info2", "fx_reviews")


def q_run_report(spark, sf):
    """Report written as text to the shared folder and read back line by line."""
    path = W.scratch_path(spark, "reports/run_report")
    W.write_report(_stats(spark, sf), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


O["run_report"] = f"SELECT section || '.' || metric || ': ' || coalesce(value, 'N/A') AS line FROM ({STATS_SQL}) s"

def q_run_report_text(spark, sf):
    """Text report of the run: scraped categories and output files as '- item' lists."""
    prods = _products(spark, sf)
    cats = prods.select("category").filter(F.col("category").isNotNull()).distinct()
    files = cats.select(F.concat(F.lit("data/products_"), F.col("category"), F.lit(".csv")).alias("path"))
    return R.report_text(_stats(spark, sf), cats, files)


def _report_sql():
    def v(section, metric, default="'N/A'"):
        return f"coalesce(max(CASE WHEN section = '{section}' AND metric = '{metric}' THEN value END), {default})"
    nl = "chr(10)"
    cat_rows = ("(SELECT DISTINCT {fix} AS category FROM fx_product_info1 p1 JOIN fx_product_info2 p2 ON p1.asin = p2.asin "
                "WHERE {fix} IS NOT NULL)").format(fix=S.fix_processor("p1.processor_type"))
    return with_fx(
        f"WITH c AS {cat_rows}, "
        f"scr AS (SELECT string_agg('- ' || category, {nl} ORDER BY category) AS scraped, "
        f"string_agg('- data/products_' || category || '.csv', {nl} ORDER BY 'data/products_' || category || '.csv') AS files FROM c) "
        f"SELECT 'Scraping Report' || {nl} || '{'=' * 20}' || {nl} || 'Run ID: ' || {v('run', 'run_id')} || {nl} || 'Timestamp: ' || {v('run', 'timestamp')} "
        f"|| {nl} || {nl} || 'Categories Scraped:' || {nl} || (SELECT scraped FROM scr) "
        f"|| {nl} || {nl} || 'Product Statistics:' || {nl} || '{'-' * 17}' || {nl} || 'Total Products: ' || {v('products', 'total_products', chr(39) + '0' + chr(39))} "
        f"|| {nl} || 'Categories: ' || coalesce(string_agg(CASE WHEN section = 'products.categories' THEN '  - ' || metric || ': ' || value END, {nl} ORDER BY metric, value), '') "
        f"|| {nl} || {nl} || 'Price Statistics:' || {nl} || '{'-' * 15}' || {nl} || 'Min Price: ' || {v('products.price_stats', 'min')} "
        f"|| {nl} || 'Max Price: ' || {v('products.price_stats', 'max')} || {nl} || 'Average Price: ' || {v('products.price_stats', 'mean')} "
        f"|| {nl} || 'Median Price: ' || {v('products.price_stats', 'median')} "
        f"|| {nl} || {nl} || 'Review Statistics:' || {nl} || '{'-' * 16}' || {nl} || 'Total Reviews: ' || {v('reviews', 'total_reviews', chr(39) + '0' + chr(39))} "
        f"|| {nl} || 'Average Rating: ' || {v('reviews', 'average_rating')} "
        f"|| {nl} || {nl} || 'Output Files:' || {nl} || '{'-' * 12}' || {nl} || (SELECT files FROM scr) || {nl} AS text "
        f"FROM ({STATS_SQL}) st", "fx_product_info1", "fx_product_info2")


O["run_report_text"] = _report_sql()

for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
