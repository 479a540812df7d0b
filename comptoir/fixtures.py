"""Portable views that shape the driver tables into the reference's data model.

Each text runs unchanged in Spark SQL and DuckDB, so the same view feeds the
Spark operators and the SQL oracle. They are input adapters only; the
operators themselves are DataFrame code.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import prepare

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

ASIN_OF_PARTKEY = "'B' || lpad(CAST(p_partkey AS STRING), 9, '0')"

FX_SQL: dict[str, str] = {
    "fx_product_info1": f"""
SELECT {ASIN_OF_PARTKEY} AS asin,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS manufacturer,
  CASE WHEN p_size % 10 = 0 THEN 'aURES' ELSE p_type END AS processor_type,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size AS STRING) || 'TB'
       WHEN p_partkey % 5 = 1 THEN CAST(p_size * 16 AS STRING) || ' gb'
       WHEN p_partkey % 5 = 2 THEN CAST(p_size * 32 AS STRING) || 'GB'
       WHEN p_partkey % 5 = 3 THEN '512 GB SSD' ELSE NULL END AS hard_drive_size,
  p_name AS hard_disk_description, CAST(p_size AS STRING) AS ram_size,
  'https://shop.example/dp/' || {ASIN_OF_PARTKEY} || '/' AS url
FROM part""",
    "fx_product_info2": f"""
SELECT {ASIN_OF_PARTKEY} AS asin,
  CAST(p_partkey % 500 AS STRING) AS nombre_avis,
  CASE WHEN p_partkey % 50 = 7 THEN 'Prix non disponible' ELSE '£' ||
    CASE WHEN pounds >= 1000 THEN CAST(CAST(floor(pounds / 1000) AS BIGINT) AS STRING) || ',' || lpad(CAST(pounds % 1000 AS STRING), 3, '0')
         ELSE CAST(pounds AS STRING) END || '.' || lpad(CAST(cents % 100 AS STRING), 2, '0') END AS prix,
  CAST(CAST(floor(p_partkey / 20) AS BIGINT) + 1 AS STRING) AS page,
  CASE WHEN p_partkey % 29 = 0 THEN 'Note non disponible' ELSE
    CAST(CAST(floor(tenths / 10) AS BIGINT) AS STRING) || '.' || CAST(tenths % 10 AS STRING) || ' out of 5 stars' END AS note,
  'https://shop.example/gp/product/' || {ASIN_OF_PARTKEY} || '/ref=x' AS url,
  p_name AS titre
FROM (SELECT c.*, CAST(floor(cents / 100) AS BIGINT) AS pounds FROM
  (SELECT p_partkey, p_name,
    CAST(round(p_retailprice * 50 * CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS BIGINT) AS cents,
    10 + (p_partkey * 7) % 41 AS tenths FROM part) c) d""",
    "fx_reviews": """
SELECT 'B' || lpad(CAST(l_partkey AS STRING), 9, '0') AS asin,
  'user' || CAST(l_suppkey AS STRING) AS reviewer,
  CASE WHEN l_linenumber = 7 THEN 'no stars' ELSE CAST(1 + l_linenumber % 5 AS STRING) || '.0 out of 5 stars' END AS rating_text,
  CASE WHEN l_quantity < 2 THEN CAST(CAST(l_shipdate AS DATE) AS STRING)
       ELSE 'Reviewed in NATION_' || CAST(l_suppkey % 25 AS STRING) || ' on ' || CAST(CAST(l_shipdate AS DATE) AS STRING) END AS date_text,
  CASE WHEN l_quantity > 40 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' people found this helpful' ELSE 'One person found this helpful' END AS helpful_text,
  CASE l_returnflag WHEN 'R' THEN 'Negative' WHEN 'A' THEN 'Positive' ELSE 'Neutral' END AS sentiment,
  l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_returnflag, l_quantity
FROM lineitem""",
    "fx_product_pages": f"""
SELECT p_partkey AS page_id, 'https://shop.example/dp/' || {ASIN_OF_PARTKEY} || '/' AS url,
  '<html><body><div class="s-result-item" data-component-type="s-search-result" data-asin="' || {ASIN_OF_PARTKEY} || '">'
  || '<span class="a-size-base-plus a-color-base a-text-normal">' || p_name || '</span>'
  || '<a class="a-link-normal" href="/dp/' || {ASIN_OF_PARTKEY} || '/">x</a></div>'
  || '<table id="productDetails_techSpec_section_1"><tr><th> Brand </th><td>' || p_brand || '</td></tr><tr><th>Item  size</th><td> ' || CAST(p_size AS STRING) || ' </td></tr></table>'
  || '<span class="s-pagination-item" aria-disabled="true">' || CAST(p_size AS STRING) || '</span>'
  || CASE WHEN p_partkey % 40 = 3 THEN '<p>Robot Check</p>' ELSE '' END || '</body></html>' AS html
FROM part""",
    "fx_metric_samples": """
SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' THEN 'gauge' ELSE 'duration' END AS kind,
  event_type AS name, 'cat' || CAST(user_id % 4 AS STRING) AS category, value FROM events""",
    "fx_comments": """
SELECT doc_id, 'B' || lpad(CAST(CAST(floor(doc_id / 5) AS BIGINT) AS STRING), 9, '0') AS asin,
  text || CASE doc_id % 8 WHEN 0 THEN ' Not good.' WHEN 1 THEN ' A very good laptop, never slow' WHEN 2 THEN ' terrible and broken'
    WHEN 3 THEN ' pas vraiment mauvais' WHEN 4 THEN ' not in any way good' WHEN 5 THEN ' extremely slow, extremely slow, slightly nice' ELSE '' END AS comment
FROM documents""",
    "fx_lemmas": """
SELECT form, lemma, CASE length(form) % 4 WHEN 0 THEN 'NOUN' WHEN 1 THEN 'ADJ' WHEN 2 THEN 'VERB' ELSE 'ADV' END AS pos FROM
  (SELECT DISTINCT lang AS form, lang AS lemma FROM documents UNION ALL
   SELECT 'laptop', 'computer' UNION ALL SELECT 'slow', 'slow' UNION ALL SELECT 'nice', 'nice' UNION ALL SELECT 'way', 'way' UNION ALL
   SELECT 'broken', 'break' UNION ALL SELECT 'good', 'good' UNION ALL SELECT 'mauvais', 'mauvais') w""",
}

# Views of web pages: every row is a page to be taken apart.
PAGE_VIEWS = ("fx_product_pages",)


def with_fx(body: str, *names: str) -> str:
    """Prefix an oracle SQL body with the fixture views it needs as CTEs.

    ``body`` may itself start with ``WITH``; its CTEs are appended after the
    fixture CTEs.
    """
    ctes = [f"{n} AS ({FX_SQL[n].strip()})" for n in names]
    b = body.strip()
    if b[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes + [b[4:].strip()])
    if not ctes:
        return b
    return "WITH " + ",\n".join(ctes) + "\n" + b


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (Parquet: column pruning and filter pushdown apply).
    Applies the runtime settings first (UTC clock: NTZ -> TIMESTAMP casts stay exact)."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


DEAL_FROM = 10_000  # rows; fewer are read and worked on where they are
TASK_ROWS = 250_000  # rows of a task at most: tasks become more with the table, not larger


def dealt(df: DataFrame) -> DataFrame:
    """Rows of a large table dealt over all tasks, as files of a page corpus are: one table file, or one row group
    of it, is one task's read, however much work a page made from each row is."""
    n = df.count()
    if n < DEAL_FROM:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism * 2, -(-n // TASK_ROWS)))


def register(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


_TABLE_REF = re.compile(r"\bFROM (part|lineitem|events|documents)\b")


def fx(spark: SparkSession, sf_dir: str, name: str, deal: bool | None = None) -> DataFrame:
    """A fixture view as a DataFrame over the driver tables of ``sf_dir``; with ``deal`` (or for views of pages) over
    their rows dealt over all tasks, before the view's texts make them larger.

    The table names of the portable text are bound to DataFrames through
    ``spark.sql(text, name=df)``, so no session-wide view is left behind.
    """
    prepare(spark)
    used = sorted(set(_TABLE_REF.findall(FX_SQL[name])))
    text = _TABLE_REF.sub(lambda m: "FROM {" + m.group(1) + "}", FX_SQL[name].replace("{", "{{").replace("}", "}}"))
    tables = {t: table(spark, sf_dir, t) for t in used}
    return spark.sql(text, **({t: dealt(d) for t, d in tables.items()} if (name in PAGE_VIEWS if deal is None else deal) else tables))
