"""Run statistics and report (AGG-06/07/08, SNK-09, STR-21/23).

Statistics are computed as a handful of small aggregates and laid out as a
long table ``(section, metric, value)``; the nested document of the reference
(products{...}, reviews{...}, timestamp, run_id) is built from the same
aggregates with ``map_from_entries`` over already-aggregated rows only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import number_text
from ..functions.text import bullet_list
from ..functions.text import run_id as run_id_of
from ..operators.ranks import exact_median


def _num(c, digits: int | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return number_text(col.cast("double"), digits)


def _row(df: DataFrame, section: str, metric, value) -> DataFrame:
    m = F.lit(metric) if isinstance(metric, str) else metric
    return df.select(F.lit(section).alias("section"), m.cast("string").alias("metric"), value.cast("string").alias("value"))


def run_statistics(products: DataFrame, reviews: DataFrame, run_ts: Column | None = None,
                   price: str = "price", category: str = "category", rating: str = "rating",
                   digits: int | None = None) -> DataFrame:
    """Long-form statistics of one run. Numbers are written in full, or with ``digits`` decimals.

    The review fact is aggregated once, by rating (map-side combined); the total,
    the average and the distribution all come from that small table. Product
    count and price statistics share one aggregate.
    """
    ps = products.agg(F.count(F.lit(1)).alias("n"), F.min(price).alias("min"), F.max(price).alias("max"),
                      F.avg(price).alias("mean"))
    ps = ps.withColumn("median", exact_median(products, price).scalar())
    cats = products.filter(F.col(category).isNotNull()).groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    by_rating = reviews.groupBy(rating).agg(F.count(F.lit(1)).alias("n"))
    rv = by_rating.agg(F.sum("n").alias("n"),
                       F.coalesce(F.sum(F.col(rating) * F.col("n")) / F.sum(F.when(F.col(rating).isNotNull(), F.col("n"))),
                                  F.lit(0.0)).alias("avg"))
    dist = by_rating.filter(F.col(rating).isNotNull())
    parts = [
        _row(ps, "products", "total_products", F.col("n")),
        _row(cats, "products.categories", F.col(category), F.col("n")),
        _row(ps, "products.price_stats", "min", _num("min", digits)),
        _row(ps, "products.price_stats", "max", _num("max", digits)),
        _row(ps, "products.price_stats", "mean", _num("mean", digits)),
        _row(ps, "products.price_stats", "median", _num("median", digits)),
        _row(rv, "reviews", "total_reviews", F.col("n")),
        _row(rv, "reviews", "average_rating", _num("avg", digits)),
        _row(dist, "reviews.rating_distribution", _num(rating, digits), F.col("n")),
    ]
    if run_ts is not None:
        one = ps.select(run_ts.alias("ts"))
        parts.append(_row(one, "run", "run_id", run_id_of(F.col("ts"))))
        parts.append(_row(one, "run", "timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")))
    return reduce(DataFrame.unionByName, parts)


def run_statistics_doc(stats: DataFrame) -> DataFrame:
    """One-row nested document from the long table (a few dozen rows)."""
    def section_map(name):
        return F.map_from_entries(F.collect_list(F.when(F.col("section") == name, F.struct("metric", "value"))))

    def scalar(section, metric):
        return F.max(F.when((F.col("section") == section) & (F.col("metric") == metric), F.col("value")))

    return stats.agg(
        F.struct(scalar("products", "total_products").cast("long").alias("total_products"),
                 section_map("products.categories").alias("categories"),
                 F.struct(*[scalar("products.price_stats", m).cast("double").alias(m)
                            for m in ("min", "max", "mean", "median")]).alias("price_stats")).alias("products"),
        F.struct(scalar("reviews", "total_reviews").cast("long").alias("total_reviews"),
                 scalar("reviews", "average_rating").cast("double").alias("average_rating"),
                 section_map("reviews.rating_distribution").alias("rating_distribution")).alias("reviews"),
        scalar("run", "timestamp").alias("timestamp"), scalar("run", "run_id").alias("run_id"))


def report_lines(stats: DataFrame) -> DataFrame:
    """Rendered report lines 'section.metric: value' ('N/A' for a missing value)."""
    return stats.select(F.concat(F.col("section"), F.lit("."), F.col("metric"), F.lit(": "),
                                 F.coalesce(F.col("value"), F.lit("N/A"))).alias("line"))


def report_text(stats: DataFrame, categories: DataFrame, output_files: DataFrame,
                title: str = "Scraping Report") -> DataFrame:
    """The run's text report as one row ``text``: header, '- item' lists for the
    categories scraped and the output files, product/price/review statistics with
    'N/A' for missing values. ``categories`` (category) and ``output_files``
    (path) are small run-level tables; all inputs are aggregated rows."""
    def val(section, metric, default="N/A"):
        return F.coalesce(F.max(F.when((F.col("section") == section) & (F.col("metric") == metric),
                                       F.col("value"))), F.lit(default))
    cat_counts = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(F.col("section") == "products.categories",
                                           F.struct("metric", "value")))),
        lambda e: F.concat(F.lit("  - "), e["metric"], F.lit(": "), e["value"])), "\n")
    s = stats.agg(val("run", "run_id").alias("run_id"), val("run", "timestamp").alias("ts"),
                  val("products", "total_products", "0").alias("tp"), cat_counts.alias("cats"),
                  val("products.price_stats", "min").alias("pmin"), val("products.price_stats", "max").alias("pmax"),
                  val("products.price_stats", "mean").alias("pmean"),
                  val("products.price_stats", "median").alias("pmed"),
                  val("reviews", "total_reviews", "0").alias("tr"), val("reviews", "average_rating").alias("ar"))
    c = categories.agg(bullet_list(F.array_sort(F.collect_list("category"))).alias("scraped"))
    o = output_files.agg(bullet_list(F.array_sort(F.collect_list("path"))).alias("files"))
    row = s.select("*", c.scalar().alias("scraped"), o.scalar().alias("files"))
    text = F.concat(
        F.lit(title + "\n" + "=" * 20 + "\nRun ID: "), F.col("run_id"), F.lit("\nTimestamp: "), F.col("ts"),
        F.lit("\n\nCategories Scraped:\n"), F.col("scraped"),
        F.lit("\n\nProduct Statistics:\n" + "-" * 17 + "\nTotal Products: "), F.col("tp"),
        F.lit("\nCategories: "), F.col("cats"),
        F.lit("\n\nPrice Statistics:\n" + "-" * 15 + "\nMin Price: "), F.col("pmin"),
        F.lit("\nMax Price: "), F.col("pmax"), F.lit("\nAverage Price: "), F.col("pmean"),
        F.lit("\nMedian Price: "), F.col("pmed"),
        F.lit("\n\nReview Statistics:\n" + "-" * 16 + "\nTotal Reviews: "), F.col("tr"),
        F.lit("\nAverage Rating: "), F.col("ar"),
        F.lit("\n\nOutput Files:\n" + "-" * 12 + "\n"), F.col("files"), F.lit("\n"))
    return row.select(text.alias("text"))
