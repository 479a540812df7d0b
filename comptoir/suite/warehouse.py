"""Registered queries: warehouse flow (SQL script of the reference)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fx, with_fx
from ..functions.price import parse_price, parse_price_number, price_bands
from ..functions.storage import storage_gb, storage_gb_1024
from ..operators.joins import full_product_info, price_class_join
from ..plans.segmentation import (class_counts, fix_processor, load_inputs, normalise_products,
                                  price_segmentation, segment_class_counts)
from ..sources import writers
from . import sqlbits as S

Q: dict = {}
O: dict = {}


def q_price_segmentation(spark, sf):
    return segment_class_counts(*load_inputs(spark, sf))


def q_price_segmentation_rows(spark, sf):
    """The same counts taken from the materialised product x review rows."""
    return class_counts(price_segmentation(*load_inputs(spark, sf)))


O["price_segmentation"] = with_fx(
    f"WITH {S.SEG_CTES} SELECT classe, count(*) AS n_rows FROM seg GROUP BY classe", *S.SEG_FX)
O["price_segmentation_rows"] = O["price_segmentation"]


def q_full_product_info(spark, sf):
    return full_product_info(*load_inputs(spark, sf))


O["full_product_info"] = with_fx(f"WITH {S.FULL_CTE} SELECT * FROM full_info", *S.SEG_FX)


def q_price_class_join(spark, sf):
    return price_segmentation(*load_inputs(spark, sf))


O["price_class_join"] = with_fx(f"WITH {S.SEG_CTES} SELECT * FROM seg", *S.SEG_FX)


def q_ctas_full_product(spark, sf):
    """CREATE OR REPLACE TABLE, twice (first without reviews); another session finds the newest by its name."""
    p1, p2, reviews = load_inputs(spark, sf)
    name = "full_product_info_classe"
    writers.replace_table(price_segmentation(p1, p2, reviews.limit(0)), name)
    writers.replace_table(price_segmentation(p1, p2, reviews), name)
    return spark.newSession().table(name)


O["ctas_full_product"] = O["price_class_join"]


def _p1(spark, sf):
    return fx(spark, sf, "fx_product_info1")


def q_storage_gb(spark, sf):
    p1 = _p1(spark, sf)
    return p1.select("asin", "hard_drive_size",
                     storage_gb("hard_drive_size").alias("hard_drive_size_gb"))


O["storage_gb"] = with_fx(
    f"SELECT asin, hard_drive_size, {S.storage_gb('hard_drive_size')} AS hard_drive_size_gb "
    "FROM fx_product_info1", "fx_product_info1")


def q_storage_gb_1024(spark, sf):
    p1 = _p1(spark, sf)
    return p1.select("asin", "hard_drive_size",
                     storage_gb_1024("hard_drive_size").alias("hard_drive_gb"))


O["storage_gb_1024"] = with_fx(
    f"SELECT asin, hard_drive_size, {S.storage_gb_1024('hard_drive_size')} AS hard_drive_gb "
    "FROM fx_product_info1", "fx_product_info1")


def q_fix_processor(spark, sf):
    p1 = _p1(spark, sf)
    return (p1.select(fix_processor("processor_type").alias("processor_type"))
            .groupBy("processor_type").agg(F.count(F.lit(1)).alias("n")))


O["fix_processor"] = with_fx(
    f"SELECT {S.fix_processor('processor_type')} AS processor_type, count(*) AS n "
    "FROM fx_product_info1 GROUP BY 1", "fx_product_info1")


def q_reshape_columns(spark, sf):
    """ADD COLUMN + UPDATE + DROP + RENAME as one projection, on product_info1."""
    p1 = _p1(spark, sf)
    return normalise_products(p1.withColumnRenamed("url", "url_info1"))


O["reshape_columns"] = with_fx(
    f"SELECT asin, manufacturer, {S.fix_processor('processor_type')} AS processor_type, "
    "hard_disk_description, ram_size, url AS url_info1, "
    f"{S.storage_gb('hard_drive_size')} AS hard_drive_size FROM fx_product_info1",
    "fx_product_info1")


def q_update_where(spark, sf):
    """Predicated UPDATE = when(pred, new).otherwise(old), applied to the whole table."""
    p1 = _p1(spark, sf)
    return p1.select("asin", F.when(F.col("processor_type").ilike("Aures"), F.lit("Autres"))
                     .otherwise(F.col("processor_type")).alias("processor_type"),
                     F.when(F.col("manufacturer").isNull(), F.lit("Unknown"))
                     .otherwise(F.col("manufacturer")).alias("manufacturer"))


O["update_where"] = with_fx(
    "SELECT asin, CASE WHEN processor_type ILIKE 'Aures' THEN 'Autres' ELSE processor_type END "
    "AS processor_type, CASE WHEN manufacturer IS NULL THEN 'Unknown' ELSE manufacturer END "
    "AS manufacturer FROM fx_product_info1", "fx_product_info1")


def q_like_preds(spark, sf):
    p1 = _p1(spark, sf)
    h, p = F.col("hard_drive_size"), F.col("processor_type")
    return (p1.select(F.upper(h).like("%TB%").alias("upper_like_tb"),
                      h.like("%TB%").alias("like_tb"),
                      p.ilike("Aures").alias("ilike_aures"))
            .groupBy("upper_like_tb", "like_tb", "ilike_aures")
            .agg(F.count(F.lit(1)).alias("n")))


O["like_preds"] = with_fx(
    "SELECT upper(hard_drive_size) LIKE '%TB%' AS upper_like_tb, hard_drive_size LIKE '%TB%' AS like_tb, "
    "processor_type ILIKE 'Aures' AS ilike_aures, count(*) AS n FROM fx_product_info1 GROUP BY 1, 2, 3",
    "fx_product_info1")


def q_parse_price(spark, sf):
    p2 = fx(spark, sf, "fx_product_info2")
    return p2.select("asin", "prix", parse_price("prix").alias("prix_num"))


O["parse_price"] = with_fx(
    f"SELECT asin, prix, {S.price_double('prix')} AS prix_num FROM fx_product_info2",
    "fx_product_info2")


def q_parse_price_number(spark, sf):
    p2 = fx(spark, sf, "fx_product_info2")
    return p2.select("asin", "prix", parse_price_number("prix").cast("bigint").alias("prix_int"))


O["parse_price_number"] = with_fx(
    f"SELECT asin, prix, CAST({S.price_number('prix')} AS BIGINT) AS prix_int FROM fx_product_info2",
    "fx_product_info2")


def q_price_band_dim(spark, sf):
    """Band dimension joined to the product prices: products per band (SRC-08)."""
    p2 = fx(spark, sf, "fx_product_info2").select("asin", "prix")
    banded = price_class_join(p2)
    return (price_bands(spark).join(banded.groupBy("classe").agg(F.count(F.lit(1)).alias("n_products")),
                                    "classe", "left")
            .select("classe", "prix_min", "prix_max",
                    F.coalesce("n_products", F.lit(0)).alias("n_products")))


O["price_band_dim"] = with_fx(
    f"WITH {S.BANDS_CTE}, banded AS (SELECT p.asin, c.classe FROM fx_product_info2 p LEFT JOIN bands c "
    f"ON CAST({S.price_number('p.prix')} AS DOUBLE) BETWEEN c.prix_min AND c.prix_max) "
    "SELECT b.classe, b.prix_min, b.prix_max, coalesce(n.n_products, 0) AS n_products FROM bands b "
    "LEFT JOIN (SELECT classe, count(*) AS n_products FROM banded GROUP BY classe) n ON b.classe = n.classe",
    "fx_product_info2")

for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
