"""Page-extraction jobs: pages DataFrame -> rows (EXT-01..07, FLT-09).

Each job is a projection over the page corpus. Pages are brought to canonical
markup first, so quotes, the order of attributes, further classes and wrappers
make no difference; blocks and fields are then found by selectors (see
``markup``), and ``posexplode`` yields one row per block in page order. All of it
is JVM-native, partitions with the pages and needs no shuffle.

Missing fields are NULL (canonical); ``sentinels=True`` writes the reference's
placeholder texts instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col, nullif_empty
from ..functions.review import (DATE_LOCATION, DEFAULT_COMMENT, DEFAULT_DATE, DEFAULT_LOCATION, DEFAULT_REVIEWER, DEFAULT_TITLE,
                                helpful_votes, parse_rating)
from ..functions.text import LISTING_SENTINELS, clean_spec_text
from ..functions.url import DEFAULT_HOST, facet_filter
from .markup import (all_elements, attribute, canonical, contents, element, elements, first_body, first_tag, first_text, inner_text, let,
                     selector, settled, with_texts)

# Selectors of the page jobs.
LISTING_BLOCK = "div[data-component-type='s-search-result']"
LISTING_TITLE = ".a-size-base-plus.a-color-base.a-text-normal"
LISTING_TITLE_FALLBACK = ".a-link-normal .a-text-normal"
LISTING_LINK = ".a-link-normal"
LISTING_PRICE = ".a-price .a-offscreen"
LISTING_STARS = ".a-icon-star-small"
LISTING_COUNT = ".a-size-small .a-link-normal"
LISTING_IMAGE = "img.s-image"
URL_ASIN = r"/dp/([A-Z0-9]{10})/"
PAGINATION_DISABLED = ".s-pagination-item[aria-disabled='true']"
SPEC_TABLE = "table#productDetails_techSpec_section_1"
FACET_TITLE = "span.a-size-base.a-color-base.puis-bold-weight-text"
FACET_LIST = "ul.a-unordered-list"
FACET_ITEM = "span.a-list-item"
FACET_LINK = "a.a-link-normal.s-navigation-item"
FACET_VALUE = "span.a-size-base.a-color-base"
REVIEW_BLOCK = "div[data-hook='review']"
REVIEW_BLOCK_FALLBACK = "div[id$='-review-card']"
REVIEW_PROFILE = "a.a-profile span.a-profile-name"
REVIEW_STARS = "i[data-hook='review-star-rating']"
REVIEW_STAR_CLASS = "[class*='a-star-']"
REVIEW_TITLE = "a[data-hook='review-title']"
REVIEW_DATE = "span[data-hook='review-date']"
REVIEW_BADGE = "span[data-hook='avp-badge']"
REVIEW_BODY = "span[data-hook='review-body']"
REVIEW_HELPFUL = "span[data-hook='helpful-vote-statement']"
PAGE_TITLE = "title"
PAGE_H1 = "h1"
PAGE_LINK = "a[href]"

# Field mappings of the configuration's product page
# (name, selector, type, value regex, required).
PRODUCT_PAGE_FIELDS = [
    ("title", "span#productTitle", "text", None, True),
    ("price", "span.a-price-whole", "text", r"\d+\.?\d*", False),
    ("rating", "i.a-icon-star span.a-icon-alt", "text", r"(\d\.\d) out", False),
    ("features", "div#feature-bullets ul li", "list", None, False),
]

# Block and attribute map of the configuration's category page. A name that begins with
# 'data-' is an attribute of the block itself, anything else a selector inside it.
CATEGORY_PAGE_BLOCK = "div[data-component-type='s-search-result']"
CATEGORY_PAGE_ATTRIBUTES = [("asin", "data-asin"), ("title", "h2 a span"), ("price", ".a-price .a-offscreen")]

# Pagination of the configuration's search results.
NEXT_PAGE = "li.a-last a"
MAX_PAGES = 10


def _sentinel(c: Column, field: str, sentinels: bool) -> Column:
    return F.coalesce(c, F.lit(LISTING_SENTINELS[field])) if sentinels else c


def _exploded(df: DataFrame, keep: list, values: Column, pos: str, value: str) -> DataFrame:
    """``posexplode`` for values that are costly to make: of the plain one, Spark infers a filter on their number,
    which makes them all a second and third time; rows without values are dropped here by their position."""
    return df.select(*keep, F.posexplode_outer(values).alias(pos, value)).filter(F.col(pos).isNotNull())


def _blocks(pages: DataFrame, sel: str, page_col: str, *keep: Column) -> DataFrame:
    """(page, keep..., pos, tag, body): one row per block of a canonical page, in page order."""
    h = pages.select(F.col(page_col).alias("page"), *keep, canonical("html").alias("html"))
    b = _exploded(h, [c for c in h.columns if c != "html"], all_elements("html", sel), "pos", "blk")
    return b.select(*[c for c in b.columns if c != "blk"], "blk.tag", "blk.body")


def extract_listing(pages: DataFrame, page_col: str = "page_id", host: str = DEFAULT_HOST,
                    sentinels: bool = False) -> DataFrame:
    """Search-result blocks -> (page, pos, titre, url, prix, note, nombre_avis, image_url, asin)."""
    b = _blocks(pages, LISTING_BLOCK, page_col)
    body = F.col("body")
    t = with_texts(b, "body", {"titre": LISTING_TITLE, "prix": LISTING_PRICE, "note": LISTING_STARS, "nombre_avis": LISTING_COUNT})
    # the second title selector is only asked where the first finds no element
    other = F.when(F.col("titre").isNull(), first_text(body, LISTING_TITLE_FALLBACK))
    href = attribute(first_tag(body, LISTING_LINK), "href")
    t = t.select("page", "pos", F.coalesce("titre", other).alias("titre"), F.concat(F.lit(f"https://{host}"), href).alias("url"),
                 "prix", "note", "nombre_avis", attribute(first_tag(body, LISTING_IMAGE), "src").alias("image_url"),
                 attribute("tag", "data-asin").alias("tag_asin"))
    t = t.withColumns({c: nullif_empty(F.col(c)) for c in ("titre", "prix", "note", "nombre_avis")})
    # an empty attribute is no ASIN; the URL is only asked when the attribute is missing
    asin = F.when(F.col("tag_asin").isNull(), nullif_empty(F.regexp_extract("url", URL_ASIN, 1))).otherwise(nullif_empty("tag_asin"))
    t = t.select("page", "pos", *[_sentinel(F.col(c), c, sentinels).alias(c)
                                  for c in ("titre", "url", "prix", "note", "nombre_avis", "image_url")],
                 _sentinel(asin, "asin", sentinels).alias("asin"))
    return settled(t, "titre", "url", "asin")  # the columns that jobs filter by


def max_page(html) -> Column:
    """Largest number among disabled pagination items, at least 1; non-numbers skipped."""
    nums = F.transform(all_elements(canonical(html), PAGINATION_DISABLED), lambda e: inner_text(e["body"]).try_cast("int"))
    return F.greatest(F.lit(1), F.coalesce(F.array_max(nums), F.lit(1)))


def spec_entries(html) -> Column:
    """array<struct<spec_key, spec_value>> of the tech-spec table, in row order;
    rows lacking a th or td are skipped; empty when there is no table."""
    table = first_body(canonical(html), SPEC_TABLE)
    cells = F.transform(elements(table, selector("tr")[0]), lambda r: F.struct(
        clean_spec_text(first_text(r["body"], "th")).alias("spec_key"),
        clean_spec_text(first_text(r["body"], "td")).alias("spec_value")))
    found = F.filter(cells, lambda e: e["spec_key"].isNotNull() & e["spec_value"].isNotNull())
    return F.coalesce(found, F.array().cast("array<struct<spec_key:string,spec_value:string>>"))


def extract_specs(pages: DataFrame, asin=None, titre=None) -> DataFrame:
    """Long form (asin, titre, url, pos, spec_key, spec_value); a page without a
    spec table still yields its product row with NULL spec columns."""
    from ..functions.url import asin_from_url
    a = asin_from_url("url") if asin is None else as_col(asin)
    t = F.lit(None).cast("string") if titre is None else as_col(titre)
    return (pages.select(a.alias("asin"), t.alias("titre"), "url",
                         F.posexplode_outer(spec_entries("html")).alias("pos", "e"))
            .select("asin", "titre", "url", "pos", F.col("e.spec_key").alias("spec_key"),
                    F.col("e.spec_value").alias("spec_value")))


def spec_map(html) -> Column:
    """map<spec_key, spec_value> per page; a repeated header keeps its last value.
    Built per row from the page itself: no shuffle, no grouping."""
    def last_only(e: Column) -> Column:
        return F.filter(e, lambda x, i: ~F.exists(F.slice(e, i + 2, F.greatest(F.size(e), F.lit(1))),
                                                  lambda y: y["spec_key"] == x["spec_key"]))
    return F.map_from_entries(let(spec_entries(html), last_only))


def spec_pivot(specs: DataFrame, keys, key_col: str = "asin") -> DataFrame:
    """Wide table: one column per spec header in ``keys`` (explicit list, so no
    extra job to discover values); the last value per header wins, in the order of
    page (its URL) and row."""
    return (specs.filter(F.col("spec_key").isNotNull())
            .groupBy(key_col).pivot("spec_key", list(keys))
            .agg(F.max_by("spec_value", F.struct("url", "pos", "spec_value"))))


def facet_sections(html, host: str = DEFAULT_HOST) -> Column:
    """array<struct<category_name, items>> of a page's facet sections in page order; an item is
    (item_pos, name, url, filter_key, filter_value). Links without a value span are skipped."""
    title, item = selector(FACET_TITLE)[0], selector(FACET_ITEM)[0]
    kind = "array<struct<item_pos:int,name:string,url:string,filter_key:string,filter_value:string>>"

    def value(e: Column, i: Column) -> Column:
        href = attribute(first_tag(e["body"], FACET_LINK), "href")
        name = first_text(first_body(e["body"], FACET_LINK), FACET_VALUE)
        return let(F.concat(F.lit(f"https://{host}"), href), lambda url: let(facet_filter(url), lambda f: F.struct(
            i.alias("item_pos"), name.alias("name"), url.alias("url"),
            f["filter_key"].alias("filter_key"), f["filter_value"].alias("filter_value"))))

    def section(chunk: Column) -> Column:
        items = F.filter(F.transform(elements(first_body(chunk, FACET_LIST), item), value),
                         lambda v: v["url"].isNotNull() & v["name"].isNotNull())
        return F.struct(inner_text(element(chunk, "span")).alias("category_name"),
                        F.coalesce(items, F.array().cast(kind)).alias("items"))

    return F.transform(F.slice(F.split(canonical(html), title.pattern), 2, 1 << 30), section)


def extract_facets(pages: DataFrame, page_col: str = "page_id", host: str = DEFAULT_HOST) -> DataFrame:
    """Facet sections -> (page, section_pos, category_name, item_pos, name, url, filter_key,
    filter_value). Sections without values yield no rows."""
    secs = _exploded(pages, [F.col(page_col).alias("page")], facet_sections("html", host), "section_pos", "s")
    return (secs.select("page", "section_pos", "s.category_name", F.explode("s.items").alias("i"))
            .select("page", "section_pos", "category_name", "i.*"))


def facets_document(pages: DataFrame, category=None, page_col: str = "page_id", host: str = DEFAULT_HOST) -> DataFrame:
    """(page, category, product_urls, filters): the facets document of each category page, made from the
    page's own text without a shuffle. ``filters`` maps a section's title to its values; sections without
    values are left out, a repeated title keeps its last section. ``product_urls`` is there to be filled
    by a later job, and empty."""
    secs = F.filter(facet_sections("html", host), lambda s: F.size(s["items"]) > 0)
    cat = F.lit(None).cast("string") if category is None else as_col(category)
    d = pages.select(F.col(page_col).alias("page"), cat.alias("category"), secs.alias("s"))
    last = F.filter("s", lambda x, i: ~F.exists(F.slice("s", i + 2, F.size("s")), lambda y: y["category_name"] == x["category_name"]))
    values = F.map_from_entries(F.transform(last, lambda x: F.struct(
        x["category_name"], F.transform(x["items"], lambda v: v.dropFields("item_pos")))))
    return d.select("page", "category", F.array().cast("array<string>").alias("product_urls"), values.alias("filters"))


def facets_nested(flat: DataFrame) -> DataFrame:
    """(page, filters map<category_name, array<struct(name,url,filter_key,filter_value)>>).
    Grouping is per page and section, bounded by the page's own facet list."""
    per_sec = (flat.groupBy("page", "section_pos", "category_name")
               .agg(F.array_sort(F.collect_list(F.struct("item_pos", "name", "url", "filter_key", "filter_value")))
                    .alias("vals")))
    per_sec = per_sec.select("page", "section_pos", "category_name",
                             F.transform("vals", lambda v: v.dropFields("item_pos")).alias("vals"))
    return (per_sec.groupBy("page")
            .agg(F.array_sort(F.collect_list(F.struct("section_pos", "category_name", "vals"))).alias("s"))
            # a repeated section title keeps its last section
            .select("page", F.filter("s", lambda x, i: ~F.exists(F.slice("s", i + 2, F.size("s")), lambda y: y["category_name"] == x["category_name"])).alias("s"))
            .select("page", F.map_from_entries(F.transform("s", lambda x: F.struct(x["category_name"], x["vals"])))
                    .alias("filters")))


def facets_flatten(nested: DataFrame) -> DataFrame:
    """Inverse of :func:`facets_nested`: one row per (page, category, value)."""
    # outer, as in _exploded: pages without sections are dropped by the missing key
    e = nested.select("page", F.explode_outer("filters").alias("category_name", "vals")).filter(F.col("category_name").isNotNull())
    return e.select("page", "category_name", F.posexplode("vals").alias("item_pos", "v")).select(
        "page", "category_name", "item_pos", "v.name", "v.url", "v.filter_key", "v.filter_value")


def extract_reviews(pages: DataFrame, asin=None, page_col: str = "page_id") -> DataFrame:
    """Review blocks (primary selector, else the fallback card selector) -> the nine
    review fields with the reference's defaults, one row per block in page order."""
    from ..functions.url import asin_from_url
    a = asin_from_url("url") if asin is None else as_col(asin)
    p = pages.select(F.col(page_col).alias("page"), a.alias("asin"), canonical("html").alias("html"))
    first, other = (selector(x)[0] for x in (REVIEW_BLOCK, REVIEW_BLOCK_FALLBACK))
    found = let(contents(F.col("html"), first), lambda e: F.when(F.size(e) > 0, e).otherwise(contents(F.col("html"), other)))
    b = _exploded(p, ["page", "asin"], found, "pos", "body")
    body = F.col("body")
    t = with_texts(b, "body", {"reviewer": REVIEW_PROFILE, "stars": REVIEW_STARS, "title": REVIEW_TITLE, "date_text": REVIEW_DATE,
                               "comment": REVIEW_BODY, "helpful": REVIEW_HELPFUL})
    badge = selector(REVIEW_BADGE)[0]
    t = t.withColumns({"verified_purchase": body.contains(badge.holds) & body.rlike(badge.pattern), "dated": F.col("date_text").rlike(DATE_LOCATION)})
    t = t.select(
        "page", "pos", "asin",
        F.coalesce("reviewer", F.lit(DEFAULT_REVIEWER)).alias("reviewer"),
        # the class is only asked in blocks without a rating element
        parse_rating("stars", F.when(F.col("stars").isNull(), first_tag(body, REVIEW_STAR_CLASS))).alias("rating"),
        F.coalesce("title", F.lit(DEFAULT_TITLE)).alias("title"),
        F.when(F.col("dated"), F.regexp_extract("date_text", DATE_LOCATION, 2)).otherwise(F.coalesce("date_text", F.lit(DEFAULT_DATE))).alias("date"),
        F.when(F.col("dated"), F.regexp_extract("date_text", DATE_LOCATION, 1)).otherwise(F.lit(DEFAULT_LOCATION)).alias("location"),
        "verified_purchase",
        F.coalesce("comment", F.lit(DEFAULT_COMMENT)).alias("comment"),
        helpful_votes("helpful").alias("helpful_count"))
    return settled(t, "asin", "reviewer")  # the columns that jobs join by


def page_fields(pages: DataFrame) -> DataFrame:
    """Generic fields of any page: title, h1, number of links (EXT-07)."""
    p = pages.select("page_id", "url", canonical("html").alias("html"))
    return p.select("page_id", "url", first_text("html", PAGE_TITLE).alias("title"), first_text("html", PAGE_H1).alias("h1"),
                    F.regexp_count("html", F.lit(selector(PAGE_LINK)[0].pattern)).alias("n_links"))


def page_links(pages: DataFrame, keep=("page_id",)) -> DataFrame:
    """One row per link: (keep..., pos, href), entities decoded."""
    tags = F.regexp_extract_all(canonical("html"), F.lit(selector(PAGE_LINK)[0].pattern), F.lit(0))
    return _exploded(pages, list(keep), tags, "pos", "tag").select(*keep, "pos", attribute("tag", "href").alias("href"))


def config_extract(pages: DataFrame, fields=PRODUCT_PAGE_FIELDS, keep=("page_id",)) -> DataFrame:
    """Declarative extraction: each (name, selector, type, regex, required) of the configuration becomes one
    column expression of a single projection (EXT-06). Types are ``text`` (first element) and ``list`` (all).
    ``missing_required`` lists the required fields that came out NULL."""
    p = pages.select(*keep, canonical("html").alias("__html"))
    cols, required = [], []
    for name, sel, kind, regex, req in fields:
        if kind == "list":
            c = F.transform(all_elements("__html", sel), lambda e: inner_text(e["body"]))
        else:
            c = nullif_empty(first_text("__html", sel))
            if regex:
                c = nullif_empty(F.regexp_extract(c, regex, 1 if "(" in regex else 0))
        cols.append(c.alias(name))
        if req:
            required.append(F.when(F.col(name).isNull(), F.lit(name)))
    out = p.select(*keep, *cols)
    return out.withColumn("missing_required", F.array_compact(F.array(*required)) if required
                          else F.array().cast("array<string>"))


def config_extract_blocks(pages: DataFrame, attributes=CATEGORY_PAGE_ATTRIBUTES, block: str = CATEGORY_PAGE_BLOCK,
                          page_col: str = "page_id") -> DataFrame:
    """Declarative block extraction: every element matching the selector ``block`` becomes a row and
    each configured attribute (``data-...`` of the block, else a selector inside it) one column;
    empty or missing gives NULL."""
    b = _blocks(pages, block, page_col)
    return b.select("page", "pos", *[
        nullif_empty(attribute("tag", where) if where.startswith("data-") else first_text("body", where)).alias(name)
        for name, where in attributes])


def next_pages(pages: DataFrame, sel: str = NEXT_PAGE, max_pages: int = MAX_PAGES, number=None, page_col: str = "page_id",
               host: str = DEFAULT_HOST) -> DataFrame:
    """(page, next_url): where the configuration's pagination goes on. No row for a page without
    the link or, with the page's own ``number`` given, at the last page allowed."""
    p = pages if number is None else pages.filter(as_col(number) < max_pages)
    href = attribute(first_tag(canonical("html"), sel), "href")
    url = let(href, lambda h: F.when(h.startswith("/"), F.concat(F.lit(f"https://{host}"), h)).otherwise(h))
    return p.select(F.col(page_col).alias("page"), url.alias("next_url")).filter("next_url IS NOT NULL")
