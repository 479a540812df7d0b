"""Registered queries: sources and sinks as round trips.

Each query writes a driver-derived table to a fresh folder under the shared
folder (``spark.checkpoint.dir``), reads it back with the source under test
and returns the rows; the oracle is the original table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import fx, table, with_fx
from ..operators import extract as X
from ..plans import report as R
from ..schemas import PRODUCT_INFO2
from ..sources import readers as RD
from ..sources import writers as W
from . import sqlbits as S
from .extraction import FACETS_SQL, facet_pages
from .metrics import _stats
from .text import O as _TEXT_ORACLE

Q: dict = {}
O: dict = {}

P2_DDL = PRODUCT_INFO2
P2_COLS = P2_DDL.fieldNames()


def q_sink_csv(spark, sf):
    p2 = fx(spark, sf, "fx_product_info2")
    path = W.sink_csv(p2, W.scratch_path(spark, "csv/product_info2"))
    return RD.scan_csv_schema(spark, path, P2_DDL)


O["sink_csv"] = with_fx("SELECT * FROM fx_product_info2", "fx_product_info2")


def q_scan_csv_schema(spark, sf):
    """Positional load: the file header says c0..c6, the DDL names the columns."""
    p2 = fx(spark, sf, "fx_product_info2").toDF(*[f"c{i}" for i in range(len(P2_COLS))])
    path = W.sink_csv(p2, W.scratch_path(spark, "csv/positional"))
    return RD.scan_csv_schema(spark, path, P2_DDL)


O["scan_csv_schema"] = O["sink_csv"]


def q_scan_csv_infer(spark, sf):
    cust = table(spark, sf, "customer")
    path = W.sink_csv(cust, W.scratch_path(spark, "csv/customer"))
    df = RD.scan_csv_infer(spark, path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in cust.schema.fields])


O["scan_csv_infer"] = "SELECT * FROM customer"


def q_scan_json(spark, sf):
    pages = fx(spark, sf, "fx_product_pages")
    path = W.export_json(pages, W.scratch_path(spark, "json/pages"))
    return RD.scan_json(spark, path, schema=pages.schema, corrupt=None)


O["scan_json"] = with_fx("SELECT * FROM fx_product_pages", "fx_product_pages")


def q_scan_json_corrupt(spark, sf):
    """JSON lines of which every seventh is cut short: its text is kept beside the good records."""
    p = table(spark, sf, "part")
    line = F.to_json(F.struct("p_partkey", "p_name"))
    broken = F.when(F.col("p_partkey") % 7 == 0, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    path = W.scratch_path(spark, "json/broken")
    p.select(broken.alias("value")).write.text(path)
    schema = T.StructType([p.schema["p_partkey"], p.schema["p_name"]])
    return RD.scan_json(spark, path, schema=schema).select(
        F.when(F.col(RD.CORRUPT).isNull(), F.col("p_partkey")).alias("p_partkey"),
        F.when(F.col(RD.CORRUPT).isNull(), F.col("p_name")).alias("p_name"), F.col(RD.CORRUPT).alias("corrupt"))


O["scan_json_corrupt"] = (
    "SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_partkey END AS p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS p_name, "
    "CASE WHEN p_partkey % 7 = 0 THEN '{\"p_partkey\":' || p_partkey || ',\"p_name\":\"' || p_name || '\"' END AS corrupt FROM part")


def q_scan_csv_kept_schema(spark, sf):
    """Types inferred once from a tenth of the rows, then the files read once with that schema."""
    cust = table(spark, sf, "customer")
    path = W.sink_csv(cust, W.scratch_path(spark, "csv/customer-kept"))
    schema = RD.infer_csv_schema(spark, path, share=0.1)
    df = RD.scan_csv_schema(spark, path, schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in cust.schema.fields])


O["scan_csv_kept_schema"] = "SELECT * FROM customer"


def q_export_json(spark, sf):
    part = table(spark, sf, "part")
    path = W.export_json(part, W.scratch_path(spark, "json/part"))
    df = RD.scan_json(spark, path)  # inferred schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in part.schema.fields])


O["export_json"] = "SELECT * FROM part"

APPEND_COLS = ["asin", "reviewer", "rating_text", "helpful_text", "seller_note"]


def q_sink_append(spark, sf):
    """Two batches appended by name to one CSV table; missing fields written as ''."""
    r = fx(spark, sf, "fx_reviews")
    path = W.scratch_path(spark, "csv/reviews_append")
    W.sink_append(r.filter(F.col("sentiment") == "Negative").select("asin", "reviewer", "rating_text"), path, APPEND_COLS)
    W.sink_append(r.filter(F.col("sentiment") != "Negative"), path, APPEND_COLS)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in APPEND_COLS])
    return (spark.read.schema(schema).options(**RD.CSV_OPTIONS).csv(path)
            .select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in APPEND_COLS]))


O["sink_append"] = with_fx(
    "SELECT asin, reviewer, rating_text, '' AS helpful_text, '' AS seller_note FROM fx_reviews WHERE sentiment = 'Negative' "
    "UNION ALL SELECT asin, reviewer, rating_text, helpful_text, '' FROM fx_reviews WHERE sentiment <> 'Negative'", "fx_reviews")


def _export_reviews(spark, sf):
    r = fx(spark, sf, "fx_reviews").select("asin", "reviewer", "sentiment", "l_orderkey", "l_linenumber")
    return W.export_partitioned(r, W.scratch_path(spark, "export/reviews"), "sentiment")


def q_export_partitioned(spark, sf):
    path = _export_reviews(spark, sf)
    return spark.read.parquet(path).select("asin", "reviewer", "sentiment", "l_orderkey", "l_linenumber")


O["export_partitioned"] = with_fx("SELECT asin, reviewer, sentiment, l_orderkey, l_linenumber FROM fx_reviews", "fx_reviews")


def q_list_objects(spark, sf):
    """Objects of the exported prefix; rows per partition folder found via the listing."""
    path = _export_reviews(spark, sf)
    objs = RD.list_objects(spark, path).select(
        F.regexp_extract("path", r"(sentiment=[^/]*/[^/]*)$", 1).alias("key"), "name")
    rows = spark.read.parquet(path).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"(sentiment=[^/]*/[^/]*)$", 1).alias("key"))
    per_file = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    j = objs.join(per_file, "key")
    return (j.select(F.regexp_extract("key", r"^sentiment=([^/]*)/", 1).alias("sentiment"), "n")
            .groupBy("sentiment").agg(F.sum("n").cast("bigint").alias("rows")))


O["list_objects"] = with_fx("SELECT sentiment, count(*) AS rows FROM fx_reviews GROUP BY sentiment", "fx_reviews")


def q_discover_files(spark, sf):
    """A folder tree holding CSV, JSON and Parquet exports; data files (csv/json,
    any case) are discovered recursively and read; rows counted per extension."""
    root = W.scratch_path(spark, "discover")
    W.sink_csv(table(spark, sf, "part"), f"{root}/a/part_csv")
    W.export_json(table(spark, sf, "customer"), f"{root}/b/nested/customer_json")
    table(spark, sf, "orders").write.parquet(f"{root}/c/orders_parquet")
    files = RD.discover_files(spark, root)
    counted = files.filter("is_data").groupBy("ext").agg(F.count(F.lit(1)).alias("n_files"))
    csv_rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]") \
        .option("header", True).csv(root).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("csv").alias("ext"), "rows")
    json_rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[jJ][sS][oO][nN]") \
        .json(root).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("json").alias("ext"), "rows")
    return counted.join(csv_rows.unionByName(json_rows), "ext").select("ext", "rows", (F.col("n_files") > 0).alias("found"))


O["discover_files"] = ("SELECT 'csv' AS ext, count(*) AS rows, true AS found FROM part "
                       "UNION ALL SELECT 'json', count(*), true FROM customer")


def q_export_facets_json(spark, sf):
    """Nested facets documents (one per page) written as JSON, read back with their
    schema and flattened: the rows must survive the trip."""
    nested = X.facets_document(facet_pages(spark, sf), category="p_brand")
    path = W.export_json_document(nested, W.scratch_path(spark, "json/facets"))
    back = RD.scan_json(spark, path, schema=nested.schema)
    return X.facets_flatten(back)


def q_export_statistics_json(spark, sf):
    """Run statistics document written as JSON and read back (scalar leaves checked)."""
    doc = R.run_statistics_doc(_stats(spark, sf))
    path = W.export_json_document(doc, W.scratch_path(spark, "json/statistics"))
    back = RD.scan_json(spark, path, schema=doc.schema)
    return back.select(F.col("products.total_products").alias("total_products"),
                       F.col("reviews.total_reviews").alias("total_reviews"),
                       F.col("products.price_stats.median").alias("median_price"),
                       F.size("reviews.rating_distribution").alias("n_ratings"), "run_id")


def q_export_top_tokens_json(spark, sf):
    """Word-cloud data (top 200 terms) exported as JSON, read back."""
    from ..operators import text as TX
    top = TX.top_tokens(TX.tokens_clean(fx(spark, sf, "fx_comments")), 200)
    path = W.export_json(top, W.scratch_path(spark, "json/top_tokens"))
    return RD.scan_json(spark, path, schema=top.schema, corrupt=None)


def q_scan_reviews(spark, sf):
    r = fx(spark, sf, "fx_comments")
    path = W.scratch_path(spark, "reviews/comments")
    r.write.parquet(path)
    return RD.scan_reviews(spark, path).select("asin", "comment")


O["scan_reviews"] = with_fx("SELECT asin, comment FROM fx_comments", "fx_comments")

O["export_top_tokens_json"] = _TEXT_ORACLE["top_tokens"]
O["export_facets_json"] = f"SELECT page, category_name, item_pos, name, url, filter_key, filter_value FROM ({FACETS_SQL}) f"
O["export_statistics_json"] = with_fx(
    "SELECT (SELECT count(*) FROM fx_product_info1 p1 JOIN fx_product_info2 p2 ON p1.asin = p2.asin) AS total_products, "
    "(SELECT count(*) FROM fx_reviews) AS total_reviews, "
    f"(SELECT CAST({S.number_text('median(' + S.price_double('prix') + ')')} AS DOUBLE) FROM fx_product_info2) AS median_price, "
    r"(SELECT CAST(count(DISTINCT coalesce(CAST(nullif(regexp_extract(rating_text, '(\d+\.\d+|\d+)', 1), '') AS DOUBLE), 0.0)) AS INTEGER) FROM fx_reviews) AS n_ratings, "
    "(SELECT strftime(max(ts), '%Y%m%d_%H%M%S') FROM events) AS run_id",
    "fx_product_info1", "fx_product_info2", "fx_reviews")


for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
