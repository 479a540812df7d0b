"""Registered queries: page extraction jobs and page predicates.

Pages come from ``fx_product_pages``, the real ``pages`` corpus, or page
texts generated row by row from ``part`` / ``lineitem`` (so every page set
grows with the tables). The oracle computes the expected fields directly
from the generating columns — an independent check of the regex jobs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import dealt, fx, table, with_fx
from ..operators import extract as X
from ..operators import markup as M
from ..functions.text import LRM
from ..operators.filters import is_blocked

Q: dict = {}
O: dict = {}


def _k(spark=None):
    return F.lpad(F.col("p_partkey").cast("string"), 9, "0")


K_SQL = "lpad(CAST(p_partkey AS VARCHAR), 9, '0')"


def _styled(html, key):
    """The same page in one of four ways of writing it, by ``key``: plain; single quotes; a further class,
    and a further attribute with a '>' before it; blanks around '=', comments with markup, a wrapper."""
    k = F.pmod(key, F.lit(4))
    return (F.when(k == 1, F.replace(html, F.lit('"'), F.lit("'")))
            .when(k == 2, F.replace(html, F.lit('class="'), F.lit('title="1 > 0" class="x1 ')))
            .when(k == 3, F.concat(F.lit("<main>"), F.replace(F.replace(html, F.lit('="'), F.lit(' = "')), F.lit("<span"), F.lit("<!-- <div> --><span")), F.lit("</main>")))
            .otherwise(html))


# ---------------------------------------------------------------- listing pages
def listing_pages(spark, sf):
    # one table file is one task's read: pages are dealt over all tasks, as files of a page corpus are
    p = table(spark, sf, "part").repartition(spark.sparkContext.defaultParallelism * 2)
    k = _k()
    price = F.format_number(F.col("p_retailprice"), 2)
    stars = F.concat((F.col("p_partkey") % 5 + 1).cast("string"), F.lit("."), (F.col("p_partkey") % 10).cast("string"))
    name = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.col("p_name"), F.lit(" &amp; co"))).otherwise(F.col("p_name"))
    html = F.concat(
        F.lit('<html><body><div class="s-result-item s-asin" data-asin="B'), k,
        F.lit('" data-component-type="s-search-result"><h2><a class="a-link-normal s-link" href="/dp/B'), k,
        F.lit('/ref=sr_1"><span class="a-size-base-plus a-color-base a-text-normal">'), name,
        F.lit('</span></a></h2><span class="a-price" data-a-size="xl"><span class="a-offscreen">£'), price,
        F.lit('</span></span><i class="a-icon a-icon-star-small a-star-small-4"><span class="a-icon-alt">'), stars,
        F.lit(' out of 5 stars</span></i><span class="a-size-small s-underline"><a class="a-link-normal s-underline-text" href="/r">'),
        F.col("p_size").cast("string"), F.lit('</a></span><img class="s-image" src="https://img.example/'), k,
        F.lit('.jpg"/></div><div class="s-result-item" data-component-type="s-search-result"><a class="a-link-normal" href="/dp/C'),
        F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit('X/"><span class="a-text-normal">'), F.col("p_brand"),
        F.lit('</span></a></div><div class="s-result-item" data-asin="" data-component-type="s-search-result"><span>sponsored</span></div>'),
        F.lit('<span class="s-pagination-item" aria-disabled="true">'), F.col("p_size").cast("string"),
        F.lit('</span><span class="s-pagination-item" aria-disabled="true">Next</span>'),
        F.when(F.col("p_size") % 3 != 0, F.concat(F.lit('<ul><li class="a-last"><a href="/s?page='), (F.col("p_size") + 1).cast("string"),
                                                  F.lit('&amp;k=x">Next</a></li></ul>'))).otherwise(F.lit("")),
        F.lit("</body></html>"))
    return p.select(F.col("p_partkey").alias("page_id"), _styled(html, F.col("p_partkey")).alias("html"), "p_size")


def q_extract_listing(spark, sf):
    return X.extract_listing(listing_pages(spark, sf))


O["extract_listing"] = (
    f"SELECT p_partkey AS page, 0 AS pos, CASE WHEN p_partkey % 7 = 0 THEN p_name || ' & co' ELSE p_name END AS titre, "
    f"'https://shop.example/dp/B' || {K_SQL} || '/ref=sr_1' AS url, '£' || format('{{:,.2f}}', p_retailprice) AS prix, "
    "CAST(p_partkey % 5 + 1 AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) || ' out of 5 stars' AS note, "
    f"CAST(p_size AS VARCHAR) AS nombre_avis, 'https://img.example/' || {K_SQL} || '.jpg' AS image_url, 'B' || {K_SQL} AS asin FROM part "
    "UNION ALL SELECT p_partkey, 1, p_brand, 'https://shop.example/dp/C' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || 'X/', "
    "NULL, NULL, NULL, NULL, 'C' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || 'X' FROM part "
    "UNION ALL SELECT p_partkey, 2, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part")


def q_max_page(spark, sf):
    pages = fx(spark, sf, "fx_product_pages").unionByName(listing_pages(spark, sf), allowMissingColumns=True)
    return pages.select("page_id", X.max_page("html").alias("max_page"),
                        F.col("url").isNull().alias("generated"))


O["max_page"] = with_fx(
    "SELECT page_id, greatest(1, p_size) AS max_page, false AS generated FROM fx_product_pages JOIN part ON page_id = p_partkey "
    "UNION ALL SELECT p_partkey, greatest(1, p_size), true FROM part", "fx_product_pages")


def q_config_extract_category(spark, sf):
    """Category-page attribute map of the configuration applied to every result block."""
    return X.config_extract_blocks(listing_pages(spark, sf))


O["config_extract_category"] = (
    f"SELECT p_partkey AS page, 0 AS pos, 'B' || {K_SQL} AS asin, CASE WHEN p_partkey % 7 = 0 THEN p_name || ' & co' "
    "ELSE p_name END AS title, '£' || format('{:,.2f}', p_retailprice) AS price FROM part "
    "UNION ALL SELECT p_partkey, 1, NULL, NULL, NULL FROM part UNION ALL SELECT p_partkey, 2, NULL, NULL, NULL FROM part")


def q_config_next_page(spark, sf):
    """Where the configured pagination goes on: pages with the link, up to the tenth."""
    return X.next_pages(listing_pages(spark, sf), number="p_size")


O["config_next_page"] = ("SELECT p_partkey AS page, 'https://shop.example/s?page=' || CAST(p_size + 1 AS VARCHAR) || '&k=x' AS next_url "
                         "FROM part WHERE p_size % 3 <> 0 AND p_size < 10")


def q_detail_candidates(spark, sf):
    """Listing rows that can be fetched for details: ASIN and URL present."""
    from ..operators.filters import detail_candidates
    return detail_candidates(X.extract_listing(listing_pages(spark, sf))).select("page", "pos", "asin", "url")


O["detail_candidates"] = (
    f"SELECT p_partkey AS page, 0 AS pos, 'B' || {K_SQL} AS asin, 'https://shop.example/dp/B' || {K_SQL} || '/ref=sr_1' AS url FROM part "
    "UNION ALL SELECT p_partkey, 1, 'C' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || 'X', "
    "'https://shop.example/dp/C' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || 'X/' FROM part")


# ------------------------------------------------------------------------ specs
def _spec_pages(spark, sf):
    fxp = fx(spark, sf, "fx_product_pages").select("page_id", "url", "html", F.lit("fx").alias("source"))
    real = table(spark, sf, "pages").select("page_id", "url", "html", F.lit("web").alias("source"))
    return fxp.unionByName(real)


def q_extract_specs(spark, sf):
    pages = _spec_pages(spark, sf)
    specs = X.extract_specs(pages)
    return specs.select("asin", "url", "pos", "spec_key", "spec_value")


O["extract_specs"] = (
    f"SELECT 'B' || {K_SQL} AS asin, 'https://shop.example/dp/B' || {K_SQL} || '/' AS url, 0 AS pos, 'Brand' AS spec_key, p_brand AS spec_value FROM part "
    f"UNION ALL SELECT 'B' || {K_SQL}, 'https://shop.example/dp/B' || {K_SQL} || '/', 1, 'Item size', CAST(p_size AS VARCHAR) FROM part "
    "UNION ALL SELECT NULL, url, NULL, NULL, NULL FROM pages")


def q_spec_pivot(spark, sf):
    specs = X.extract_specs(fx(spark, sf, "fx_product_pages"))
    return X.spec_pivot(specs, ["Brand", "Item size"])


O["spec_pivot"] = f"SELECT 'B' || {K_SQL} AS asin, p_brand AS \"Brand\", CAST(p_size AS VARCHAR) AS \"Item size\" FROM part"


def q_spec_map(spark, sf):
    pages = _spec_pages(spark, sf)
    from ..functions.url import asin_from_url
    return pages.select("page_id", "source", asin_from_url("url").alias("asin"),
                        F.to_json(X.spec_map("html")).alias("specs"))


O["spec_map"] = (
    f"SELECT p_partkey AS page_id, 'fx' AS source, 'B' || {K_SQL} AS asin, "
    "'{\"Brand\":\"' || p_brand || '\",\"Item size\":\"' || CAST(p_size AS VARCHAR) || '\"}' AS specs FROM part "
    "UNION ALL SELECT page_id, 'web', NULL, '{}' FROM pages")


def q_clean_spec_cells(spark, sf):
    """Spec cells with padding, newlines and a leading U+200E, cleaned by the spec job."""
    p = table(spark, sf, "part")
    html = F.concat(F.lit('<table id="productDetails_techSpec_section_1"><tr><th>\n Model  name </th><td>'),
                    F.lit(LRM), F.col("p_type"), F.lit("\n</td></tr><tr><th>Colour</th></tr></table>"))
    pages = p.select(F.col("p_partkey").alias("page_id"),
                     F.concat(F.lit("https://shop.example/dp/B"), _k(), F.lit("/")).alias("url"), _styled(html, F.col("p_partkey")).alias("html"))
    return X.extract_specs(pages).select("asin", "pos", "spec_key", "spec_value")


O["clean_spec_cells"] = f"SELECT 'B' || {K_SQL} AS asin, 0 AS pos, 'Model name' AS spec_key, p_type AS spec_value FROM part"


def q_blocked_pages(spark, sf):
    pages = _spec_pages(spark, sf)
    return pages.select("page_id", "source", is_blocked("html", url="url").alias("blocked"))


O["blocked_pages"] = with_fx(
    "SELECT page_id, 'fx' AS source, (contains(lower(html), 'captcha') OR contains(lower(html), 'robot check') OR "
    "regexp_matches(html, 'To discuss automated access to \\w+ data') OR contains(lower(url), 'captcha')) AS blocked "
    "FROM fx_product_pages UNION ALL SELECT page_id, 'web', (contains(lower(html), 'captcha') OR contains(lower(html), 'robot check') OR "
    "regexp_matches(html, 'To discuss automated access to \\w+ data') OR contains(lower(url), 'captcha')) FROM pages",
    "fx_product_pages")


def q_blocked_responses(spark, sf):
    """The same predicate with the response's status and redirects."""
    pages = _spec_pages(spark, sf).withColumns({"status": F.when(F.col("page_id") % 3 == 0, 503).otherwise(200), "n_redirects": (F.col("page_id") % 5).cast("int")})
    return pages.select("page_id", "source", is_blocked("html", status="status", n_redirects="n_redirects").alias("blocked"))


O["blocked_responses"] = with_fx(
    "SELECT page_id, source, ((page_id % 3 <> 0 AND contains(lower(html), 'captcha')) OR contains(lower(html), 'robot check') OR "
    "regexp_matches(html, 'To discuss automated access to \\w+ data') OR page_id % 5 > 2) AS blocked FROM "
    "(SELECT page_id, html, 'fx' AS source FROM fx_product_pages UNION ALL SELECT page_id, html, 'web' FROM pages) p", "fx_product_pages")


# ----------------------------------------------------------------------- facets
def facet_pages(spark, sf):
    p = dealt(table(spark, sf, "part"))
    title = lambda t: F.concat(F.lit('<div class="a-section"><span class="a-size-base a-color-base puis-bold-weight-text">'),
                               F.lit(t), F.lit("</span></div>"))
    item = lambda href, name: F.concat(
        F.lit('<span class="a-list-item"><a class="a-link-normal s-navigation-item" href="'), href,
        F.lit('"><span class="a-size-base a-color-base">'), name, F.lit("</span></a></span>"))
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))
    html = F.concat(
        title("Brand"), F.lit('<ul class="a-unordered-list a-nostyle">'),
        item(F.concat(F.lit("/s?rh=n%3A429886031%2Cp_89%3A"), brand, F.lit("&dc")), F.col("p_brand")),
        item(F.concat(F.lit("/s?k="), F.col("p_partkey").cast("string")), F.lit("Other")), F.lit("</ul>"),
        title("Size"), F.lit('<ul class="a-unordered-list">'),
        item(F.concat(F.lit("/s?rh=n%3A429886031%2Cp_n_size%3A"), F.col("p_size").cast("string")),
             F.concat(F.col("p_size").cast("string"), F.lit(" in"))), F.lit("</ul>"),
        title("Empty"))
    return p.select(F.col("p_partkey").alias("page_id"), "p_brand", _styled(html, F.col("p_partkey")).alias("html"))


FACETS_SQL = (
    "SELECT p_partkey AS page, 0 AS section_pos, 'Brand' AS category_name, 0 AS item_pos, p_brand AS name, "
    "'https://shop.example/s?rh=n%3A429886031%2Cp_89%3A' || replace(p_brand, '#', '') || '&dc' AS url, 'p_89' AS filter_key, "
    "replace(p_brand, '#', '') AS filter_value FROM part UNION ALL "
    "SELECT p_partkey, 0, 'Brand', 1, 'Other', 'https://shop.example/s?k=' || CAST(p_partkey AS VARCHAR), NULL, NULL FROM part UNION ALL "
    "SELECT p_partkey, 1, 'Size', 0, CAST(p_size AS VARCHAR) || ' in', 'https://shop.example/s?rh=n%3A429886031%2Cp_n_size%3A' || "
    "CAST(p_size AS VARCHAR), 'p_n_size', CAST(p_size AS VARCHAR) FROM part")


def q_extract_facets(spark, sf):
    return X.extract_facets(facet_pages(spark, sf))


O["extract_facets"] = FACETS_SQL


def q_facets_flat(spark, sf):
    """Flat rows -> nested document per page -> flat rows again (ARR-01 round trip)."""
    return X.facets_flatten(X.facets_document(facet_pages(spark, sf)))


O["facets_flat"] = f"SELECT page, category_name, item_pos, name, url, filter_key, filter_value FROM ({FACETS_SQL}) f"


def q_facets_nested(spark, sf):
    nested = X.facets_document(facet_pages(spark, sf), category="p_brand")
    return nested.select("page", "category", F.to_json("product_urls").alias("product_urls"), F.size("filters").alias("n_sections"),
                         F.aggregate(F.map_values("filters"), F.lit(0), lambda acc, v: acc + F.size(v)).alias("n_values"),
                         F.array_join(F.map_keys("filters"), "|").alias("sections"))


O["facets_nested"] = "SELECT p_partkey AS page, p_brand AS category, '[]' AS product_urls, 2 AS n_sections, 3 AS n_values, 'Brand|Size' AS sections FROM part"


# ---------------------------------------------------------------------- reviews
def review_pages(spark, sf):
    r = fx(spark, sf, "fx_reviews", deal=True)
    ln = F.col("l_linenumber")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      F.col("l_shipdate").cast("date").cast("string"))
    opener = F.when(ln == 4, F.concat(F.lit('<div id="R'), F.col("l_orderkey").cast("string"), F.lit('-review-card">'))) \
        .otherwise(F.lit('<div data-hook="review" class="a-section review">'))
    main = F.concat(
        opener,
        F.when(ln == 2, F.lit("")).otherwise(F.concat(F.lit('<a class="a-profile" href="/p"><span class="a-profile-name"> '),
                                                      F.col("reviewer"), F.lit(" </span></a>"))),
        F.lit('<i data-hook="review-star-rating" class="a-icon a-star-'), (ln % 5 + 1).cast("string"),
        F.lit('"><span class="a-icon-alt">'), F.col("rating_text"), F.lit("</span></i>"),
        F.lit('<a data-hook="review-title" href="/t"><span>Order '), F.col("l_orderkey").cast("string"), F.lit("</span></a>"),
        F.lit('<span data-hook="review-date">'), F.col("date_text"), F.lit("</span>"),
        F.when(F.col("l_returnflag") == "R", F.lit('<span data-hook="avp-badge">Verified Purchase</span>')).otherwise(F.lit("")),
        F.lit('<span data-hook="review-body"><span> Quantity '), F.col("l_quantity").cast("bigint").cast("string"),
        F.lit(" &amp; more\n</span></span>"),
        F.lit('<span data-hook="helpful-vote-statement">'), F.col("helpful_text"), F.lit("</span></div>"))
    extra = F.when(ln == 1, F.lit('<div data-hook="review"><i class="a-icon a-star-2"></i><span data-hook="review-date">3 May</span></div>')) \
        .otherwise(F.lit(""))
    # a text of its own first: it is written out once, not in each way of writing it
    r = r.select(key.alias("page_key"), F.concat(F.lit("https://shop.example/dp/"), F.col("asin"), F.lit("/reviews")).alias("url"),
                 F.concat(F.lit("<html><body>"), main, extra, F.lit("</body></html>")).alias("html"), (F.col("l_orderkey") + ln).alias("way"))
    return r.select("page_key", "url", _styled(F.col("html"), F.col("way")).alias("html"))


def q_extract_reviews(spark, sf):
    return X.extract_reviews(review_pages(spark, sf), page_col="page_key")


O["extract_reviews"] = with_fx(
    "WITH r AS (SELECT f.*, concat_ws('-', f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, "
    "CAST(CAST(f.l_shipdate AS DATE) AS VARCHAR)) AS page FROM fx_reviews f) "
    "SELECT page, 0 AS pos, asin, CASE WHEN l_linenumber = 2 THEN 'Anonyme' ELSE reviewer END AS reviewer, "
    r"coalesce(CAST(nullif(regexp_extract(rating_text, '(\d+\.\d+|\d+)', 1), '') AS DOUBLE), 0.0) AS rating, "
    "'Order ' || CAST(l_orderkey AS VARCHAR) AS title, "
    "CASE WHEN regexp_matches(date_text, 'Reviewed in (.*?) on (.*)') THEN regexp_extract(date_text, 'Reviewed in (.*?) on (.*)', 2) ELSE date_text END AS date, "
    "CASE WHEN regexp_matches(date_text, 'Reviewed in (.*?) on (.*)') THEN regexp_extract(date_text, 'Reviewed in (.*?) on (.*)', 1) ELSE 'Unknown' END AS location, "
    "l_returnflag = 'R' AS verified_purchase, 'Quantity ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' & more' AS comment, "
    r"coalesce(TRY_CAST(nullif(regexp_extract(helpful_text, '(\d+)', 1), '') AS INTEGER), 0) AS helpful_count FROM r "
    "UNION ALL SELECT page, 1, asin, 'Anonyme', 2.0, 'Sans titre', '3 May', 'Unknown', false, 'Aucun commentaire disponible', 0 "
    "FROM r WHERE l_linenumber = 1", "fx_reviews")


def q_review_ingest(spark, sf):
    """New review pages -> pairs not stored before 1996, all of them."""
    from ..plans.ingest import review_ingest
    known = fx(spark, sf, "fx_reviews").filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return review_ingest(review_pages(spark, sf), known, page_col="page_key").select(
        "page", "pos", "asin", "reviewer", "rating", "helpful_count")


O["review_ingest"] = with_fx(
    "WITH r AS (SELECT f.*, concat_ws('-', f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, "
    "CAST(CAST(f.l_shipdate AS DATE) AS VARCHAR)) AS page FROM fx_reviews f), "
    "ex AS (SELECT page, 0 AS pos, asin, CASE WHEN l_linenumber = 2 THEN 'Anonyme' ELSE reviewer END AS reviewer, "
    r"coalesce(CAST(nullif(regexp_extract(rating_text, '(\d+\.\d+|\d+)', 1), '') AS DOUBLE), 0.0) AS rating, "
    r"coalesce(TRY_CAST(nullif(regexp_extract(helpful_text, '(\d+)', 1), '') AS INTEGER), 0) AS helpful_count FROM r "
    "UNION ALL SELECT page, 1, asin, 'Anonyme', 2.0, 0 FROM r WHERE l_linenumber = 1), "
    "fresh AS (SELECT * FROM ex e WHERE NOT EXISTS (SELECT 1 FROM fx_reviews o WHERE o.l_shipdate < TIMESTAMP '1996-01-01' "
    "AND o.asin = e.asin AND o.reviewer = e.reviewer)) "
    "SELECT page, pos, asin, reviewer, rating, helpful_count FROM fresh", "fx_reviews")


def q_listing_ingest(spark, sf):
    """Listing pages -> valid titles, ASINs not stored (products with a price are), first per ASIN."""
    from ..plans.ingest import listing_ingest
    known = fx(spark, sf, "fx_product_info2").filter(F.col("prix") != "Prix non disponible").select("asin")
    return listing_ingest(listing_pages(spark, sf), known).select("page", "pos", "asin", "titre", "prix")


O["listing_ingest"] = with_fx(
    "SELECT p_partkey AS page, 0 AS pos, 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS asin, "
    "CASE WHEN p_partkey % 7 = 0 THEN p_name || ' & co' ELSE p_name END AS titre, '£' || format('{:,.2f}', p_retailprice) AS prix "
    "FROM part WHERE 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') NOT IN (SELECT asin FROM fx_product_info2 WHERE prix <> 'Prix non disponible') "
    "UNION ALL SELECT p_partkey, 1, 'C' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || 'X', p_brand, NULL FROM part",
    "fx_product_info2")


# ------------------------------------------------------------ declarative config
def product_pages(spark, sf):
    p = table(spark, sf, "part")
    html = F.concat(
        F.when(F.col("p_partkey") % 9 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<span id="productTitle" class="a-size-large"> '), F.col("p_name"), F.lit(" </span>"))),
        F.lit('<span class="a-price-whole">'), F.col("p_retailprice").cast("bigint").cast("string"), F.lit(".</span>"),
        F.lit('<i class="a-icon a-icon-star a-star-4"><span class="a-icon-alt">'),
        (F.col("p_partkey") % 5 + 1).cast("string"), F.lit(".5 out of 5 stars</span></i>"),
        F.lit('<div id="feature-bullets"><ul class="a-unordered-list"><li> '), F.col("p_type"), F.lit(" </li><li>Size "),
        F.col("p_size").cast("string"), F.lit("</li></ul></div>"))
    return p.select(F.col("p_partkey").alias("page_id"), _styled(html, F.col("p_partkey")).alias("html"))


def q_config_extract(spark, sf):
    out = X.config_extract(product_pages(spark, sf))
    return out.select("page_id", "title", "price", "rating", F.array_join("features", "|").alias("features"),
                      F.array_join("missing_required", ",").alias("missing_required"))


O["config_extract"] = (
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_name END AS title, "
    "CAST(CAST(trunc(p_retailprice) AS BIGINT) AS VARCHAR) || '.' AS price, CAST(p_partkey % 5 + 1 AS VARCHAR) || '.5' AS rating, "
    "p_type || '|Size ' || CAST(p_size AS VARCHAR) AS features, CASE WHEN p_partkey % 9 = 0 THEN 'title' ELSE '' END AS missing_required "
    "FROM part")


# ------------------------------------------------------------- generic corpus
def _inner_sql(x: str) -> str:
    y = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for a, b in M.ENTITIES:
        y = f"replace({y}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return f"regexp_replace({y}, '^\\s+|\\s+$', '', 'g')"


def _opt_sql(x: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{pattern}') THEN regexp_extract({x}, '{pattern}', 1) END"


# Patterns of the oracles, written for the corpus's own markup.
TITLE_SQL = r"(?s)<title[^>]*>(.*?)</title>"
H1_SQL = r"(?s)<h1[^>]*>(.*?)</h1>"
LINK_SQL = r'<a [^>]*href="([^"]*)"'


def q_page_title(spark, sf):
    return X.page_fields(table(spark, sf, "pages"))


O["page_title"] = (
    f"SELECT page_id, url, {_inner_sql(_opt_sql('html', TITLE_SQL))} AS title, {_inner_sql(_opt_sql('html', H1_SQL))} AS h1, "
    f"CAST(len(regexp_extract_all(html, '{LINK_SQL}', 1)) AS INTEGER) AS n_links FROM pages")


def q_page_links(spark, sf):
    """Links of the web corpus and of generated listing pages (other quotes, entities in the address)."""
    web = table(spark, sf, "pages").select("page_id", "html", F.lit("web").alias("source"))
    made = listing_pages(spark, sf).select("page_id", "html", F.lit("listing").alias("source"))
    both = web.unionByName(made)
    return X.page_links(both, keep=("page_id", "source"))


O["page_links"] = (
    f"SELECT page_id, 'web' AS source, CAST(unnest(range(len(a))) AS INTEGER) AS pos, unnest(a) AS href FROM "
    f"(SELECT page_id, regexp_extract_all(html, '{LINK_SQL}', 1) AS a FROM pages) t "
    f"UNION ALL SELECT p_partkey, 'listing', 0, '/dp/B' || {K_SQL} || '/ref=sr_1' FROM part UNION ALL SELECT p_partkey, 'listing', 1, '/r' FROM part "
    "UNION ALL SELECT p_partkey, 'listing', 2, '/dp/C' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || 'X/' FROM part "
    "UNION ALL SELECT p_partkey, 'listing', 3, '/s?page=' || CAST(p_size + 1 AS VARCHAR) || '&k=x' FROM part WHERE p_size % 3 <> 0")


def q_scan_pages(spark, sf):
    from ..sources.readers import scan_pages
    p = scan_pages(spark, f"{sf.rstrip('/')}/pages.parquet")
    return p.select("page_id", "url", F.length("html").alias("n_chars"))


O["scan_pages"] = "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages"

for _k2, _v in list(globals().items()):
    if _k2.startswith("q_"):
        Q[_k2[2:]] = _v
