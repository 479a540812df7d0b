"""Dashboard and recommender flows: load, filters, panels, recommendation.

The dashboard frame of the reference is the segmented product x review table
merged once more with the per-review sentiment file, so a product with n
reviews appears n x n times. Here the frame is kept at (product, sentiment)
grain with an exact multiplicity column ``n_rows``:

    n_rows = reviews(product) x reviews(product, sentiment)     (mode='fanout')

Both factors are pre-aggregated per key (map-side combine, so a product with
a third of all reviews costs one row per map task) before the product join;
the n^2 rows are never produced. Every panel aggregates with that weight,
giving the same numbers as the materialised frame. ``mode='per_review'``
skips the second fan-out (each review counted once, with its own sentiment).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import nullif_empty
from ..functions.price import parse_price
from ..functions.text import html_link
from ..operators import aggregates as A
from ..operators.filters import ram_filter, range_filter
from ..operators.joins import isin_filter, price_class_join
from .segmentation import normalise_products

# Rating pattern of the configuration ("4.5 out of 5 stars").
NOTE_PATTERN = r"(\d\.\d) out"
WEIGHT = "n_rows"


def parse_note(c) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return nullif_empty(F.regexp_extract(col, NOTE_PATTERN, 1)).try_cast("double")


def product_table(p1: DataFrame, p2: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """One row per product: both product tables, normalised, with price class."""
    prod = (p1.select("asin", "manufacturer", "processor_type", "hard_drive_size",
                      "hard_disk_description", "ram_size", F.col("url").alias("url_info1"))
            .join(p2.select("asin", "nombre_avis", "prix", "page", "note",
                            F.col("url").alias("url_info2"), "titre"), "asin"))
    return price_class_join(normalise_products(prod), bands)


def dashboard_load(p1: DataFrame, p2: DataFrame, reviews: DataFrame, sentiments: DataFrame | None = None,
                   mode: str = "fanout", class_null_label: str = "nan") -> DataFrame:
    """The dashboard frame: ASIN, MANUFACTURER, TITRE, URL_INFO1, RAM, PRIX, NOTE, CLASSE,
    sentiment, n_rows (multiplicity). Rows without price or note are dropped."""
    same_source = sentiments is None
    sentiments = reviews if sentiments is None else sentiments
    prod = product_table(p1, p2)
    base = (prod.select(F.col("asin").alias("ASIN"), F.col("manufacturer").alias("MANUFACTURER"),
                        F.col("titre").alias("TITRE"), F.col("url_info1").alias("URL_INFO1"),
                        F.col("ram_size").alias("RAM"), parse_price("prix").alias("PRIX"),
                        parse_note("note").alias("NOTE"),
                        F.coalesce(F.col("classe"), F.lit(class_null_label)).alias("CLASSE"))
            .na.drop(subset=["PRIX", "NOTE"]))
    per_sent = (sentiments.groupBy(F.col("asin").alias("ASIN"), "sentiment")
                .agg(F.count(F.lit(1)).alias("__c")))
    if mode == "fanout":
        # reviews per product: from the per-sentiment counts when both come from the same
        # table (one scan and one shuffle of the review fact instead of two)
        per_prod = (per_sent.groupBy("ASIN").agg(F.sum("__c").alias("__k")) if same_source
                    else reviews.groupBy(F.col("asin").alias("ASIN")).agg(F.count(F.lit(1)).alias("__k")))
        d = base.join(per_prod, "ASIN").join(per_sent, "ASIN", "left")
        return (d.withColumn("sentiment", F.coalesce("sentiment", F.lit("Neutral")))
                .withColumn(WEIGHT, (F.col("__k") * F.coalesce("__c", F.lit(1))).cast("bigint"))
                .drop("__k", "__c"))
    if mode == "per_review":
        d = base.join(per_sent, "ASIN")
        return (d.withColumn("sentiment", F.coalesce("sentiment", F.lit("Neutral")))
                .withColumnRenamed("__c", WEIGHT).withColumn(WEIGHT, F.col(WEIGHT).cast("bigint")))
    raise ValueError("mode must be 'fanout' or 'per_review'")


def dashboard_filter(dash: DataFrame, lo=None, hi=None, note_min: float = 3.0,
                     manufacturers=None, classes=None) -> DataFrame:
    """Slider and multi-select filters of the data page (FLT-01, FLT-02)."""
    d = range_filter(dash, "PRIX", "NOTE", lo, hi, note_min)
    d = isin_filter(d, "MANUFACTURER", manufacturers)
    return isin_filter(d, "CLASSE", classes)


def top_manufacturers(dash: DataFrame, k: int = 10) -> DataFrame:
    m = A.mean_by(dash, "MANUFACTURER", "NOTE", WEIGHT, "NOTE")
    m = m.withColumn("NOTE", F.round("NOTE", 6))
    return A.top_k(m, [F.desc("NOTE"), F.asc("MANUFACTURER")], k)


def avg_price_by_class(dash: DataFrame) -> DataFrame:
    return A.mean_by(dash, "CLASSE", "PRIX", WEIGHT, "PRIX").withColumn("PRIX", F.round("PRIX", 6))


def sentiment_counts(dash: DataFrame) -> DataFrame:
    return A.value_counts(dash, "sentiment", WEIGHT, name="Count").withColumnRenamed("sentiment", "Sentiment")


def class_counts(dash: DataFrame) -> DataFrame:
    return (A.value_counts(dash, "CLASSE", WEIGHT, name="Nombre de produits")
            .withColumnRenamed("CLASSE", "Classe"))


def sentiment_share(dash: DataFrame) -> DataFrame:
    return A.share_of_total(sentiment_counts(dash), "Count", "pct", 1)


def recommend(dash: DataFrame, budget_min=None, budget_max=None, note_min: float = 4.0,
              manufacturers=None, ram_mode: str = "Intervalle", ram_min: float = 4,
              ram_max: float = 64, ram_exact: float = 8) -> DataFrame:
    """Recommendation page: budget, note, brands, RAM; ordered by NOTE desc, PRIX asc."""
    d = range_filter(dash, "PRIX", "NOTE", budget_min, budget_max, note_min)
    d = isin_filter(d, "MANUFACTURER", manufacturers)
    d = ram_filter(d, ram_mode, ram_min, ram_max, ram_exact)
    return d.orderBy(F.desc("NOTE"), F.asc_nulls_last("PRIX"), F.asc("ASIN"), F.asc("sentiment"))


def recommend_display(reco: DataFrame) -> DataFrame:
    """Display table: TITRE as an HTML link when URL_INFO1 is set, URL column dropped."""
    return reco.select(html_link("URL_INFO1", "TITRE").alias("TITRE"), "PRIX", "NOTE",
                       "MANUFACTURER", WEIGHT).drop("URL_INFO1")


def class_sentiment_report(p1: DataFrame, p2: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews per (product, price class, sentiment), most reviewed first (JN-08, AGG-09).

    Reviews are counted per (asin, sentiment) before meeting the product
    dimension; products without review keep one row with count 0, products
    without a price class have none.
    """
    prod = product_table(p1, p2).select("asin", "titre", "prix", F.col("classe").alias("gamme_prix"))
    prod = prod.filter(F.col("gamme_prix").isNotNull())  # the band join is inner
    per = reviews.groupBy("asin", "sentiment").agg(F.count("asin").alias("nombre_avis"))
    return (prod.join(per, "asin", "left")
            .withColumn("nombre_avis", F.coalesce("nombre_avis", F.lit(0)).cast("bigint"))
            .orderBy(F.desc("nombre_avis"), "asin", "sentiment"))
