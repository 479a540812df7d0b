"""Registered queries: table maintenance — clean, de-dup, merge, upsert, incremental
update, anti/semi joins, top-n per product, resume, review statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import fx, table, with_fx
from ..functions.price import parse_price
from ..functions.review import parse_rating
from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import dedupe as DD
from ..operators import filters as FL
from ..operators import joins as J
from . import sqlbits as S

Q: dict = {}
O: dict = {}

# Total order of the review rows (see SURVEY data facts: unique on these five).
ORD = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ORD_SQL = ", ".join(ORD)
ORD_DESC_SQL = ", ".join(f"{c} DESC" for c in ORD)
KEYS_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEYS_OUT_SQL = ", ".join(KEYS_OUT)


def _reviews(spark, sf):
    return fx(spark, sf, "fx_reviews")


def _ship():
    return F.col("l_shipdate").cast("date").cast("string").alias("ship")


SHIP_SQL = "CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship"


def q_dedupe_keep_last(spark, sf):
    r = _reviews(spark, sf)
    d = DD.dedupe_keep_last(r, ["asin", "reviewer"], ORD)
    return d.select("asin", "reviewer", "rating_text", *KEYS_OUT, _ship())


def q_dedupe_csv_file(spark, sf):
    """deduplicate a CSV table in place of the reference's file de-dup: keep the last
    row per (asin, reviewer) in *file order* (rows written sorted, then read back)."""
    from ..sources import writers as W
    r = _reviews(spark, sf).select("asin", "reviewer", "rating_text", *KEYS_OUT, _ship(), *ORD[:1])
    path = W.sink_csv(r.orderBy(*ORD).drop("l_shipdate"), W.scratch_path(spark, "csv/reviews_sorted"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("asin", "reviewer", "rating_text")]
                          + [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                             T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
                             T.StructField("ship", T.StringType())])
    out = W.deduplicate_file(spark, path, ["asin", "reviewer"], schema)
    return spark.read.schema(schema).option("header", True).csv(out)


O["dedupe_keep_last"] = with_fx(
    f"SELECT asin, reviewer, rating_text, {KEYS_OUT_SQL}, {SHIP_SQL} FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY asin, reviewer ORDER BY {ORD_DESC_SQL}) AS rn FROM fx_reviews) t WHERE rn = 1", "fx_reviews")


O["dedupe_csv_file"] = O["dedupe_keep_last"]


def _batches(spark, sf):
    r = _reviews(spark, sf)
    b0 = r.filter(F.col("sentiment") == "Negative").select("asin", "reviewer", "rating_text", "sentiment", *ORD)
    b1 = r.filter(F.col("sentiment") == "Positive").select("asin", "reviewer", "helpful_text", "sentiment", *ORD)
    b2 = r.filter(F.col("sentiment") == "Neutral").select("asin", "reviewer", "rating_text", "helpful_text",
                                                         "sentiment", *ORD)
    return [b0, b1, b2]


BATCHES_SQL = (
    "(SELECT 0 AS f, asin, reviewer, rating_text, NULL AS helpful_text, sentiment, " + ORD_SQL + " FROM fx_reviews WHERE sentiment = 'Negative' "
    "UNION ALL SELECT 1, asin, reviewer, NULL, helpful_text, sentiment, " + ORD_SQL + " FROM fx_reviews WHERE sentiment = 'Positive' "
    "UNION ALL SELECT 2, asin, reviewer, rating_text, helpful_text, sentiment, " + ORD_SQL + " FROM fx_reviews WHERE sentiment = 'Neutral')")
MERGED_COLS = ["asin", "reviewer", "rating_text", "helpful_text", "sentiment"] + KEYS_OUT
MERGED_SQL = ", ".join(MERGED_COLS)


def q_merge_tables(spark, sf):
    m = DD.merge_tables(_batches(spark, sf))
    return m.select(*MERGED_COLS, _ship())


O["merge_tables"] = with_fx(f"SELECT {MERGED_SQL}, {SHIP_SQL} FROM {BATCHES_SQL} b", "fx_reviews")


def q_merge_tables_dedupe(spark, sf):
    m = DD.merge_tables(_batches(spark, sf), key="asin", order_cols=ORD)
    return m.select(*MERGED_COLS, _ship())


O["merge_tables_dedupe"] = with_fx(
    f"SELECT {MERGED_SQL}, {SHIP_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY asin ORDER BY f DESC, "
    f"{ORD_DESC_SQL}) AS rn FROM {BATCHES_SQL} b) t WHERE rn = 1", "fx_reviews")


def q_schema_union(spark, sf):
    return DD.schema_union([fx(spark, sf, "fx_product_info1"), fx(spark, sf, "fx_product_info2")])


O["schema_union"] = with_fx(
    "SELECT asin, manufacturer, processor_type, hard_drive_size, hard_disk_description, ram_size, url, "
    "NULL AS nombre_avis, NULL AS prix, NULL AS page, NULL AS note, NULL AS titre FROM fx_product_info1 UNION ALL "
    "SELECT asin, NULL, NULL, NULL, NULL, NULL, url, nombre_avis, prix, page, note, titre FROM fx_product_info2",
    "fx_product_info1", "fx_product_info2")


def q_union_all(spark, sf):
    """Concatenation of the URL lists of three sources (SET-04)."""
    parts = [fx(spark, sf, n).select("url") for n in ("fx_product_info1", "fx_product_info2", "fx_product_pages")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


O["union_all"] = with_fx(
    "SELECT url FROM fx_product_info1 UNION ALL SELECT url FROM fx_product_info2 UNION ALL SELECT url FROM fx_product_pages",
    "fx_product_info1", "fx_product_info2", "fx_product_pages")


def q_upsert_by_key(spark, sf):
    """Catalogue prices upserted with unit prices observed in line items (new rows win)."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), "p_name",
                                            F.col("p_retailprice").alias("price"))
    li = table(spark, sf, "lineitem")
    obs = (li.groupBy(F.col("l_partkey").alias("product_id"))
           .agg(F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")), 6).alias("price")))
    return DD.upsert_by_key(part, obs)


O["upsert_by_key"] = (
    "WITH u AS (SELECT 0 AS f, p_partkey AS product_id, p_name, p_retailprice AS price FROM part UNION ALL "
    "SELECT 1, l_partkey, NULL, round(avg(l_extendedprice / l_quantity), 6) FROM lineitem GROUP BY l_partkey) "
    "SELECT product_id, p_name, price FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY f DESC) rn FROM u) t WHERE rn = 1")


def _orders_upd(spark, sf):
    o = table(spark, sf, "orders")
    ts = F.when(F.col("o_orderkey") % 13 == 0, F.lit("not a date")).otherwise(F.col("o_orderdate").cast("string"))
    d = o.select(F.col("o_custkey").alias("product_id"), ts.alias("last_updated"), "o_orderkey",
                 "o_totalprice", "o_orderstatus")
    return d.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus"), \
        d.filter(F.col("o_orderstatus") != "F").drop("o_orderstatus")


def q_incremental_update(spark, sf):
    target, source = _orders_upd(spark, sf)
    u = DD.incremental_update(target, source, "product_id", "last_updated", tie_break=["o_orderkey"])
    return u.withColumn("last_updated", F.col("last_updated").cast("string"))


O["incremental_update"] = (
    "WITH d AS (SELECT o_custkey AS product_id, TRY_CAST(CASE WHEN o_orderkey % 13 = 0 THEN 'not a date' ELSE CAST(o_orderdate AS VARCHAR) END AS TIMESTAMP) AS ts, "
    "o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS src FROM orders) "
    "SELECT product_id, CAST(ts AS VARCHAR) AS last_updated, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER "
    "(PARTITION BY product_id ORDER BY ts IS NOT NULL DESC, ts DESC, src DESC, o_orderkey DESC) rn FROM d) t WHERE rn = 1")


def q_new_reviews(spark, sf):
    """Reviews of the new batch by (asin, reviewer) pairs not seen in earlier batches (JN-05)."""
    r = _reviews(spark, sf)
    old = r.filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    new = r.filter(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    return J.anti_join(new, old, ["asin", "reviewer"]).select("asin", "reviewer", *KEYS_OUT)


O["new_reviews"] = with_fx(
    f"SELECT n.asin, n.reviewer, {', '.join('n.' + c for c in KEYS_OUT)} FROM fx_reviews n WHERE n.l_shipdate >= TIMESTAMP '1996-01-01' "
    "AND NOT EXISTS (SELECT 1 FROM fx_reviews o WHERE o.l_shipdate < TIMESTAMP '1996-01-01' AND o.asin = n.asin AND o.reviewer = n.reviewer)",
    "fx_reviews")


def q_known_pairs_ingest(spark, sf):
    """Reviews in two yearly batches and a third that repeats the second, each against a store of known
    (asin, reviewer) pairs kept in buckets: rows new to the store, with the number of their batch."""
    from ..sources.known_keys import KnownKeys, ingest
    import uuid
    r = _reviews(spark, sf).select("asin", "reviewer", "l_shipdate", *KEYS_OUT)
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    store = KnownKeys(spark, f"known_pairs_{uuid.uuid4().hex[:8]}", ["asin", "reviewer"], buckets=8)
    early, late = r.filter(F.col("l_shipdate") < cut), r.filter(F.col("l_shipdate") >= cut)
    found = [ingest(b, store).withColumn("batch", F.lit(i)) for i, b in enumerate((early, late, late))]
    out = found[0].unionByName(found[1]).unionByName(found[2])
    return out.select("batch", "asin", "reviewer", *KEYS_OUT)


O["known_pairs_ingest"] = with_fx(
    f"SELECT 0 AS batch, asin, reviewer, {KEYS_OUT_SQL} FROM fx_reviews WHERE l_shipdate < TIMESTAMP '1996-01-01' "
    f"UNION ALL SELECT 1, asin, reviewer, {KEYS_OUT_SQL} FROM fx_reviews n WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND NOT EXISTS "
    "(SELECT 1 FROM fx_reviews o WHERE o.l_shipdate < TIMESTAMP '1996-01-01' AND o.asin = n.asin AND o.reviewer = n.reviewer)", "fx_reviews")


def q_range_join_overlaps(spark, sf):
    """Suppliers' order values against overlapping bands of any width, some without an end in reach."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    bands = table(spark, sf, "nation").select(
        F.col("n_name").alias("band"), (F.col("n_nationkey") * 10000.0).alias("lo"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit(1e10)).otherwise(F.col("n_nationkey") * 10000.0 + 35000.0).alias("hi"))
    return J.range_join(o, F.col("o_totalprice").cast("double"), bands, "lo", "hi").select("o_orderkey", "band")


O["range_join_overlaps"] = (
    "SELECT o_orderkey, n_name AS band FROM orders LEFT JOIN nation ON CAST(o_totalprice AS DOUBLE) BETWEEN n_nationkey * 10000.0 AND "
    "CASE WHEN n_nationkey % 5 = 0 THEN 1e10 ELSE n_nationkey * 10000.0 + 35000.0 END")


def q_unprocessed_products(spark, sf):
    """Products whose details are not in the processed set (JN-04)."""
    p2 = fx(spark, sf, "fx_product_info2")
    done = _reviews(spark, sf).filter(F.col("l_shipdate") >= F.lit("2001-09-01").cast("timestamp_ntz")).select("asin")
    return J.anti_join(p2, done, "asin").select("asin", "titre", "url")


O["unprocessed_products"] = with_fx(
    "SELECT asin, titre, url FROM fx_product_info2 p WHERE NOT EXISTS (SELECT 1 FROM fx_reviews r "
    "WHERE r.l_shipdate >= TIMESTAMP '2001-09-01' AND r.asin = p.asin)", "fx_product_info2", "fx_reviews")


LISTING_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def _listing_batch(spark, sf):
    r = _reviews(spark, sf)
    return r.select(F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("asin")).alias("asin"),
                    F.when(F.col("l_linenumber") == 3, F.lit("Titre non disponible"))
                    .otherwise(F.concat(F.lit("Product "), F.col("asin"))).alias("titre"), *LISTING_ORDER)


LISTING_SQL = ("(SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE asin END AS asin, CASE WHEN l_linenumber = 3 "
               "THEN 'Titre non disponible' ELSE 'Product ' || asin END AS titre, " + ", ".join(LISTING_ORDER) +
               " FROM fx_reviews)")


def q_listing_valid(spark, sf):
    return FL.listing_valid(_listing_batch(spark, sf)).select("asin", "titre", *KEYS_OUT)


O["listing_valid"] = with_fx(
    f"SELECT asin, titre, {KEYS_OUT_SQL} FROM {LISTING_SQL} b WHERE nullif(titre, 'Titre non disponible') IS NOT NULL",
    "fx_reviews")


def q_new_listings(spark, sf):
    """Listing rows to append: valid title, ASIN unknown, first per ASIN; no-ASIN rows kept (JN-06/07)."""
    batch = _listing_batch(spark, sf).withColumn("titre", F.nullif("titre", F.lit("Titre non disponible")))
    known = fx(spark, sf, "fx_product_info2").filter(F.col("prix") != "Prix non disponible").select("asin")
    return J.new_listings(batch, known, LISTING_ORDER).select("asin", "titre", *KEYS_OUT)


O["new_listings"] = with_fx(
    f"WITH b AS (SELECT * FROM {LISTING_SQL} x WHERE nullif(titre, 'Titre non disponible') IS NOT NULL), "
    "f AS (SELECT * FROM b WHERE asin IS NULL OR asin NOT IN (SELECT asin FROM fx_product_info2 WHERE prix <> 'Prix non disponible')) "
    f"SELECT asin, titre, {KEYS_OUT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY asin ORDER BY {', '.join(LISTING_ORDER)}) rn FROM f) t "
    f"WHERE asin IS NULL OR rn = 1", "fx_reviews", "fx_product_info2")


def q_reviews_top_n(spark, sf):
    r = _reviews(spark, sf)
    return J.top_n_per_group(r, "asin", [F.col(c) for c in ORD], 50).select("asin", "reviewer", *KEYS_OUT)


O["reviews_top_n"] = with_fx(
    f"SELECT asin, reviewer, {KEYS_OUT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY asin ORDER BY {ORD_SQL}) rn "
    "FROM fx_reviews) t WHERE rn <= 50", "fx_reviews")


def q_resume_after(spark, sf):
    """Events after the stored progress mark (the latest 'signup' event id)."""
    ev = table(spark, sf, "events")
    last = ev.filter(F.col("event_type") == "signup").agg(F.max("event_id")).scalar()
    return DD.resume_after(ev, "event_id", last).select("event_id", "event_type", "user_id")


O["resume_after"] = ("SELECT event_id, event_type, user_id FROM events WHERE event_id > "
                     "(SELECT max(event_id) FROM events WHERE event_type = 'signup')")


def q_reviewers_by_asin(spark, sf):
    return A.count_distinct_by(_reviews(spark, sf), "asin", "reviewer", "n_reviewers")


O["reviewers_by_asin"] = with_fx(
    "SELECT asin, count(DISTINCT reviewer) AS n_reviewers FROM fx_reviews GROUP BY asin", "fx_reviews")


RATING_SQL = r"coalesce(CAST(nullif(regexp_extract(rating_text, '(\d+\.\d+|\d+)', 1), '') AS DOUBLE), 0.0)"


def q_rating_distribution(spark, sf):
    r = _reviews(spark, sf).select(parse_rating("rating_text").alias("rating"))
    return A.value_counts(r, "rating")


O["rating_distribution"] = with_fx(
    f"SELECT {RATING_SQL} AS rating, count(*) AS count FROM fx_reviews GROUP BY 1", "fx_reviews")


def q_review_stats(spark, sf):
    r = _reviews(spark, sf).select(parse_rating("rating_text").alias("rating"))
    return r.agg(F.count(F.lit(1)).alias("total_reviews"),
                 F.round(F.coalesce(F.avg("rating"), F.lit(0.0)), 6).alias("average_rating"))


O["review_stats"] = with_fx(
    f"SELECT count(*) AS total_reviews, round(coalesce(avg({RATING_SQL}), 0.0), 6) AS average_rating FROM fx_reviews",
    "fx_reviews")


def q_validate_rows(spark, sf):
    p2 = fx(spark, sf, "fx_product_info2")
    d = p2.select("asin", F.col("titre").alias("title"), parse_price("prix").alias("price"))
    v = FL.validate_rows(d, lo=0.01, hi=3000.0)
    return v.select("asin", F.array_join("violations", ",").alias("violations"), "valid")


O["validate_rows"] = with_fx(
    f"SELECT asin, concat_ws(',', CASE WHEN titre IS NULL THEN 'missing_title' END, CASE WHEN {S.price_double('prix')} IS NULL "
    f"THEN 'missing_price' END, CASE WHEN {S.price_double('prix')} < 0.01 OR {S.price_double('prix')} > 3000.0 THEN 'price_out_of_range' END) "
    f"AS violations, (titre IS NOT NULL AND {S.price_double('prix')} IS NOT NULL AND {S.price_double('prix')} BETWEEN 0.01 AND 3000.0) AS valid "
    "FROM fx_product_info2", "fx_product_info2")


def q_rename_cols(spark, sf):
    p1 = fx(spark, sf, "fx_product_info1")
    return C.rename_cols(p1, {"asin": "ASIN", "manufacturer": "MANUFACTURER", "url": "URL_INFO1"})


O["rename_cols"] = with_fx(
    'SELECT asin AS "ASIN", manufacturer AS "MANUFACTURER", processor_type, hard_drive_size, hard_disk_description, '
    'ram_size, url AS "URL_INFO1" FROM fx_product_info1', "fx_product_info1")


CLEAN_EXTRA = [
    (None, " Customer#X ", None, -5.0, ""),
    (None, " Customer#X ", None, -5.0, ""),
    (None, "Customer#X", 3, 1.5, "  "),
    (None, None, None, None, None),
    (None, "", None, None, "   "),
]


def q_clean_table(spark, sf):
    """clean_table on customer plus edge rows (duplicates, blanks, negatives, all-null)."""
    cust = table(spark, sf, "customer")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_mktsegment", T.StringType())])
    extra = spark.createDataFrame(CLEAN_EXTRA, schema)
    raw = cust.unionByName(extra).toDF(" C Custkey ", "c_name", "C Nationkey", "c_acctbal", " c_mktsegment")
    return C.clean_table(raw)


def _clean_sql():
    vals = ", ".join("(" + ", ".join("NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v)) for v in row) + ")"
                     for row in CLEAN_EXTRA)
    s = lambda c: f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"
    return (f"WITH raw AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL "
            f"SELECT CAST(a AS BIGINT), CAST(b AS VARCHAR), CAST(c AS INTEGER), CAST(d AS DOUBLE), CAST(e AS VARCHAR) "
            f"FROM (VALUES {vals}) t(a, b, c, d, e)), dd AS (SELECT DISTINCT * FROM raw), "
            f"cl AS (SELECT CASE WHEN c_custkey >= 0 THEN c_custkey END AS c_custkey, {s('c_name')} AS c_name, "
            f"CASE WHEN c_nationkey >= 0 THEN c_nationkey END AS c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, "
            f"{s('c_mktsegment')} AS c_mktsegment FROM dd) SELECT * FROM cl WHERE NOT (c_custkey IS NULL AND c_name IS NULL "
            f"AND c_nationkey IS NULL AND c_acctbal IS NULL AND c_mktsegment IS NULL)")


O["clean_table"] = _clean_sql()


def q_preview(spark, sf):
    """SELECT * FROM review LIMIT 10, with an explicit order for a stable answer."""
    r = _reviews(spark, sf).select("asin", "sentiment", *ORD)
    return A.top_k(r, [F.col(c) for c in ORD], 10).select("asin", "sentiment", *KEYS_OUT)


def q_reviews_top_10(spark, sf):
    r = _reviews(spark, sf)
    return J.top_n_per_group(r, "asin", [F.col(c) for c in ORD], 10).select("asin", "reviewer", *KEYS_OUT)


O["reviews_top_10"] = with_fx(
    f"SELECT asin, reviewer, {KEYS_OUT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY asin ORDER BY {ORD_SQL}) rn "
    "FROM fx_reviews) t WHERE rn <= 10", "fx_reviews")


O["preview"] = with_fx(f"SELECT asin, sentiment, {KEYS_OUT_SQL} FROM fx_reviews ORDER BY {ORD_SQL} LIMIT 10", "fx_reviews")

for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
