"""Registered queries: dashboard panels, filters, recommender, report query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fx, with_fx
from ..operators import aggregates as A
from ..operators.joins import semi_filter, sentiment_left_join
from ..plans import dashboard as D
from . import sqlbits as S

Q: dict = {}
O: dict = {}
FX = ("fx_product_info1", "fx_product_info2", "fx_reviews")


def _dash(spark, sf, mode="fanout"):
    p1, p2, r = (fx(spark, sf, n) for n in FX)
    return D.dashboard_load(p1, p2, r, mode=mode)


PROD_CTE = S.BANDS_CTE + f""",
prod AS (SELECT p1.asin, p1.manufacturer, p1.ram_size, p1.url AS url_info1, p2.prix, p2.note, p2.titre
  FROM fx_product_info1 p1 JOIN fx_product_info2 p2 ON p1.asin = p2.asin),
banded AS (SELECT p.*, c.classe FROM prod p LEFT JOIN bands c
  ON CAST({S.price_number('p.prix')} AS DOUBLE) BETWEEN c.prix_min AND c.prix_max)"""

BASE_CTE = PROD_CTE + f""",
base AS (SELECT asin AS "ASIN", manufacturer AS "MANUFACTURER", titre AS "TITRE", url_info1 AS "URL_INFO1",
  ram_size AS "RAM", {S.price_double('prix')} AS "PRIX",
  TRY_CAST(nullif(regexp_extract(note, '(\\d\\.\\d) out', 1), '') AS DOUBLE) AS "NOTE",
  coalesce(classe, 'nan') AS "CLASSE" FROM banded)"""

DASH_CTE = BASE_CTE + """,
kk AS (SELECT asin, count(*) AS k FROM fx_reviews GROUP BY asin),
sc AS (SELECT asin, sentiment, count(*) AS c FROM fx_reviews GROUP BY asin, sentiment),
dash AS (SELECT b.*, coalesce(sc.sentiment, 'Neutral') AS sentiment, CAST(kk.k * coalesce(sc.c, 1) AS BIGINT) AS n_rows
  FROM base b JOIN kk ON b."ASIN" = kk.asin LEFT JOIN sc ON b."ASIN" = sc.asin
  WHERE b."PRIX" IS NOT NULL AND b."NOTE" IS NOT NULL)"""


def dsql(body: str) -> str:
    return with_fx(f"WITH {DASH_CTE} {body}", *FX)


DASH_COLS = '"ASIN", "MANUFACTURER", "TITRE", "URL_INFO1", "RAM", "PRIX", "NOTE", "CLASSE", sentiment, n_rows'


def q_dashboard_load(spark, sf):
    return _dash(spark, sf)


O["dashboard_load"] = dsql(f"SELECT {DASH_COLS} FROM dash")


def q_dashboard_load_per_review(spark, sf):
    return _dash(spark, sf, "per_review")


O["dashboard_load_per_review"] = with_fx(
    f"WITH {BASE_CTE}, sc AS (SELECT asin, sentiment, count(*) AS c FROM fx_reviews GROUP BY asin, sentiment) "
    "SELECT b.*, coalesce(sc.sentiment, 'Neutral') AS sentiment, CAST(sc.c AS BIGINT) AS n_rows FROM base b "
    "JOIN sc ON b.\"ASIN\" = sc.asin WHERE b.\"PRIX\" IS NOT NULL AND b.\"NOTE\" IS NOT NULL", *FX)


def q_top_manufacturers(spark, sf):
    return D.top_manufacturers(D.dashboard_filter(_dash(spark, sf)))


O["top_manufacturers"] = dsql(
    'SELECT "MANUFACTURER", round(sum("NOTE" * n_rows) / sum(n_rows), 6) AS "NOTE" FROM dash '
    'WHERE "NOTE" >= 3.0 AND "MANUFACTURER" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10')


def q_avg_price_by_class(spark, sf):
    return D.avg_price_by_class(D.dashboard_filter(_dash(spark, sf)))


O["avg_price_by_class"] = dsql(
    'SELECT "CLASSE", round(sum("PRIX" * n_rows) / sum(n_rows), 6) AS "PRIX" FROM dash '
    'WHERE "NOTE" >= 3.0 GROUP BY 1')


def q_sentiment_counts(spark, sf):
    return D.sentiment_counts(D.dashboard_filter(_dash(spark, sf)))


O["sentiment_counts"] = dsql(
    'SELECT sentiment AS "Sentiment", CAST(sum(n_rows) AS BIGINT) AS "Count" FROM dash WHERE "NOTE" >= 3.0 GROUP BY 1')


def q_class_counts(spark, sf):
    return D.class_counts(D.dashboard_filter(_dash(spark, sf)))


O["class_counts"] = dsql(
    'SELECT "CLASSE" AS "Classe", CAST(sum(n_rows) AS BIGINT) AS "Nombre de produits" FROM dash '
    'WHERE "NOTE" >= 3.0 GROUP BY 1')


def q_sentiment_share(spark, sf):
    return D.sentiment_share(D.dashboard_filter(_dash(spark, sf)))


O["sentiment_share"] = dsql(
    'SELECT "Sentiment", "Count", round("Count" * 100.0 / sum("Count") OVER (), 1) AS pct FROM '
    '(SELECT sentiment AS "Sentiment", CAST(sum(n_rows) AS BIGINT) AS "Count" FROM dash WHERE "NOTE" >= 3.0 GROUP BY 1) t')


def _hist_sql(col: str, n: int) -> str:
    return dsql(
        f'SELECT b.bin, round(s.lo + (b.bin - 1) * (s.hi - s.lo) / s.nb, 6) AS lo, '
        f'round(s.lo + b.bin * (s.hi - s.lo) / s.nb, 6) AS hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count '
        f'FROM (SELECT min("{col}") AS lo, max("{col}") AS hi, CASE WHEN min("{col}") = max("{col}") THEN 1 ELSE {n} END AS nb '
        f'FROM dash WHERE "NOTE" >= 3.0) s JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {n + 1})) b ON b.bin <= s.nb '
        f'LEFT JOIN (SELECT CASE WHEN s2.hi = s2.lo THEN 1 ELSE least({n}, CAST(floor((d."{col}" - s2.lo) / ((s2.hi - s2.lo) / {n})) + 1 AS INTEGER)) END AS bin, '
        f'sum(n_rows) AS cnt FROM dash d, (SELECT min("{col}") AS lo, max("{col}") AS hi FROM dash WHERE "NOTE" >= 3.0) s2 '
        f'WHERE d."NOTE" >= 3.0 AND d."{col}" IS NOT NULL GROUP BY 1) c ON c.bin = b.bin')


def q_hist_rating(spark, sf):
    return A.histogram(D.dashboard_filter(_dash(spark, sf)), "NOTE", 20, D.WEIGHT)


O["hist_rating"] = _hist_sql("NOTE", 20)


def q_hist_price(spark, sf):
    return A.histogram(D.dashboard_filter(_dash(spark, sf)), "PRIX", 30, D.WEIGHT)


O["hist_price"] = _hist_sql("PRIX", 30)


def q_price_bounds(spark, sf):
    return A.bounds(_dash(spark, sf), "PRIX")


O["price_bounds"] = dsql('SELECT min("PRIX") AS min_prix, max("PRIX") AS max_prix FROM dash')


def q_distinct_manufacturers(spark, sf):
    return A.distinct_sorted(_dash(spark, sf), "MANUFACTURER")


O["distinct_manufacturers"] = dsql('SELECT DISTINCT "MANUFACTURER" FROM dash WHERE "MANUFACTURER" IS NOT NULL')


def q_dashboard_filter(spark, sf):
    return D.dashboard_filter(_dash(spark, sf), lo=100.0, hi=2500.0, note_min=3.0)


O["dashboard_filter"] = dsql(f'SELECT {DASH_COLS} FROM dash WHERE "PRIX" >= 100.0 AND "PRIX" <= 2500.0 AND "NOTE" >= 3.0')


def q_dashboard_filter_in(spark, sf):
    return D.dashboard_filter(_dash(spark, sf), manufacturers=["Brand#12", "Brand#23", "Brand#34"],
                              classes=["Moyen", "nan"])


O["dashboard_filter_in"] = dsql(
    f"SELECT {DASH_COLS} FROM dash WHERE \"NOTE\" >= 3.0 AND \"MANUFACTURER\" IN ('Brand#12', 'Brand#23', 'Brand#34') "
    "AND \"CLASSE\" IN ('Moyen', 'nan')")


def q_semi_filter(spark, sf):
    """Brand list as a table (brands that sell a large part), applied as a left-semi join."""
    part = fx(spark, sf, "fx_product_info1").join(
        fx(spark, sf, "fx_product_info2").select("asin", "nombre_avis"), "asin")
    allowed = (part.filter(F.col("nombre_avis").cast("int") >= 450)
               .select(F.col("manufacturer").alias("MANUFACTURER")).distinct())
    return semi_filter(_dash(spark, sf), allowed, "MANUFACTURER")


O["semi_filter"] = dsql(
    f"SELECT {DASH_COLS} FROM dash WHERE \"MANUFACTURER\" IN (SELECT p1.manufacturer FROM fx_product_info1 p1 "
    "JOIN fx_product_info2 p2 ON p1.asin = p2.asin WHERE CAST(p2.nombre_avis AS INTEGER) >= 450)")


def q_ram_filter(spark, sf):
    from ..operators.filters import ram_filter
    d = _dash(spark, sf)
    return ram_filter(d, "Intervalle", 4, 16).unionByName(ram_filter(d, "Exacte", ram_exact=8))


O["ram_filter"] = dsql(
    f"SELECT {DASH_COLS.replace('\"RAM\"', 'TRY_CAST(\"RAM\" AS DOUBLE) AS \"RAM\"')} FROM dash WHERE TRY_CAST(\"RAM\" AS DOUBLE) BETWEEN 4 AND 16 "
    f"UNION ALL SELECT {DASH_COLS.replace('\"RAM\"', 'TRY_CAST(\"RAM\" AS DOUBLE) AS \"RAM\"')} FROM dash WHERE TRY_CAST(\"RAM\" AS DOUBLE) = 8")


def q_recommend(spark, sf):
    return D.recommend(_dash(spark, sf), budget_min=200.0, budget_max=1200.0, note_min=4.0)


O["recommend"] = dsql(
    f"SELECT {DASH_COLS.replace('\"RAM\"', 'TRY_CAST(\"RAM\" AS DOUBLE) AS \"RAM\"')} FROM dash WHERE \"PRIX\" >= 200.0 AND \"PRIX\" <= 1200.0 AND \"NOTE\" >= 4.0 "
    "AND TRY_CAST(\"RAM\" AS DOUBLE) BETWEEN 4 AND 64 ORDER BY \"NOTE\" DESC, \"PRIX\"")


def q_recommend_display(spark, sf):
    reco = D.recommend(_dash(spark, sf), budget_min=200.0, budget_max=1200.0, note_min=4.0,
                       manufacturers=["Brand#11", "Brand#22", "Brand#33", "Brand#44", "Brand#55"])
    return D.recommend_display(reco)


O["recommend_display"] = dsql(
    "SELECT CASE WHEN \"URL_INFO1\" IS NOT NULL AND trim(\"URL_INFO1\") <> '' THEN '<a href=\"' || \"URL_INFO1\" || "
    "'\" target=\"_blank\">' || \"TITRE\" || '</a>' ELSE \"TITRE\" END AS \"TITRE\", \"PRIX\", \"NOTE\", \"MANUFACTURER\", n_rows "
    "FROM dash WHERE \"PRIX\" >= 200.0 AND \"PRIX\" <= 1200.0 AND \"NOTE\" >= 4.0 "
    "AND \"MANUFACTURER\" IN ('Brand#11', 'Brand#22', 'Brand#33', 'Brand#44', 'Brand#55') "
    "AND TRY_CAST(\"RAM\" AS DOUBLE) BETWEEN 4 AND 64")


def q_class_sentiment_report(spark, sf):
    p1, p2, r = (fx(spark, sf, n) for n in FX)
    return D.class_sentiment_report(p1, p2, r)


O["class_sentiment_report"] = with_fx(
    f"WITH {PROD_CTE} SELECT b.asin, b.titre, b.prix, b.classe AS gamme_prix, r.sentiment, "
    "CAST(count(r.asin) AS BIGINT) AS nombre_avis FROM banded b LEFT JOIN fx_reviews r ON b.asin = r.asin "
    "WHERE b.classe IS NOT NULL GROUP BY 1, 2, 3, 4, 5 ORDER BY nombre_avis DESC", *FX)


def q_sentiment_left_join(spark, sf):
    """Products left-joined to a per-product sentiment table (missing -> Neutral)."""
    p2 = fx(spark, sf, "fx_product_info2").select("asin", "titre")
    r = fx(spark, sf, "fx_reviews")
    # Majority sentiment per product; ties go to the greatest label.
    majority = (r.groupBy("asin", "sentiment").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("asin").agg(F.max(F.struct("n", "sentiment")).alias("m"))
                .select("asin", F.col("m.sentiment").alias("sentiment")))
    return sentiment_left_join(p2, majority, "asin")


O["sentiment_left_join"] = with_fx(
    "WITH c AS (SELECT asin, sentiment, count(*) AS n FROM fx_reviews GROUP BY 1, 2), "
    "m AS (SELECT asin, arg_max(sentiment, n * 100 + CASE sentiment WHEN 'Positive' THEN 3 WHEN 'Neutral' THEN 2 ELSE 1 END) AS sentiment FROM c GROUP BY 1) "
    "SELECT p.asin, p.titre, coalesce(m.sentiment, 'Neutral') AS sentiment FROM fx_product_info2 p LEFT JOIN m ON p.asin = m.asin",
    "fx_product_info2", "fx_reviews")


def q_drop_null_subset(spark, sf):
    """dropna(subset=[PRIX, NOTE]) on the product table with parsed price and note."""
    p2 = fx(spark, sf, "fx_product_info2")
    from ..functions.price import parse_price
    d = p2.select("asin", parse_price("prix").alias("PRIX"), D.parse_note("note").alias("NOTE"))
    return d.na.drop(subset=["PRIX", "NOTE"])


O["drop_null_subset"] = with_fx(
    f"SELECT asin, {S.price_double('prix')} AS \"PRIX\", TRY_CAST(nullif(regexp_extract(note, '(\\d\\.\\d) out', 1), '') AS DOUBLE) AS \"NOTE\" "
    f"FROM fx_product_info2 WHERE {S.price_double('prix')} IS NOT NULL AND nullif(regexp_extract(note, '(\\d\\.\\d) out', 1), '') IS NOT NULL",
    "fx_product_info2")

for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
