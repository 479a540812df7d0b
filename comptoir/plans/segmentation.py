"""Warehouse flow: join product tables with reviews, normalise, attach price band.

The reference runs CTAS -> ALTER/UPDATE x5 -> CTAS. Here the UPDATEs are
projections fused into one plan, so the result is computed (and written, if
asked) once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import storage_gb
from ..operators.joins import price_class_join, product_info


def fix_processor(c="processor_type"):
    """'Aures' (any case, exact) -> 'Autres' (STR-05)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.ilike("Aures"), F.lit("Autres")).otherwise(col)


def normalise_products(full: DataFrame, strict: bool = False) -> DataFrame:
    """hard_drive_size -> GB text (moved to the end, as ADD/DROP/RENAME does),
    processor_type misspelling fixed."""
    return (full.withColumn("__gb", storage_gb("hard_drive_size", strict))
            .drop("hard_drive_size").withColumnRenamed("__gb", "hard_drive_size")
            .withColumn("processor_type", fix_processor("processor_type")))


def price_segmentation(p1: DataFrame, p2: DataFrame, review: DataFrame,
                       bands: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """full_product_info_classe: product x review rows with normalised columns and classe.
    Products are normalised and classed before they meet their reviews: once a product, not once a review."""
    classed = price_class_join(normalise_products(product_info(p1, p2), strict), bands, "prix", strict)
    columns = [c for c in classed.columns if c not in ("hard_drive_size", "classe")]
    return classed.join(review.select("asin", "sentiment"), "asin").select(*columns, "sentiment", "hard_drive_size", "classe")


def class_counts(seg: DataFrame) -> DataFrame:
    """Rows per price class (NULL class = missing or out-of-band price)."""
    return seg.groupBy("classe").agg(F.count(F.lit(1)).alias("n_rows"))


def segment_class_counts(p1: DataFrame, p2: DataFrame, review: DataFrame,
                         bands: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Same numbers as ``class_counts(price_segmentation(...))`` without joining every
    review: reviews are counted per asin first (map-side combine, so a product
    holding a third of all reviews costs one row per map task), then the
    per-product classes are joined to those counts and summed."""
    prod = (p1.select("asin").join(p2.select("asin", "prix"), "asin"))
    classed = price_class_join(prod, bands, "prix", strict)
    per_asin = review.groupBy("asin").agg(F.count(F.lit(1)).alias("__n"))
    return (classed.join(per_asin, "asin").groupBy("classe")
            .agg(F.sum("__n").cast("bigint").alias("n_rows")))


def load_inputs(spark: SparkSession, sf_dir: str):
    from ..fixtures import fx
    return (fx(spark, sf_dir, "fx_product_info1"), fx(spark, sf_dir, "fx_product_info2"),
            fx(spark, sf_dir, "fx_reviews"))
