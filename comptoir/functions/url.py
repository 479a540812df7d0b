"""URL expressions: ASIN extraction, slug titles, URL building, object keys,
facet-filter parsing (STR-09..13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, let, nullif_empty

# ASIN patterns, tried in this order; the first that matches wins.
ASIN_PATTERNS = [
    r"/dp/([A-Z0-9]{10})/?",
    r"/gp/product/([A-Z0-9]{10})/?",
    r"/ASIN/([A-Z0-9]{10})/?",
    r"(?:product|dp|gp/product)/([A-Z0-9]{10})/?",
]

# Facet filter pair pattern and the base query of the category page.
FACET_PAIR_PATTERN = r"([p|n]_[^:,]+):([^,]+)"
BASE_RH = "n%3A429886031"
DEFAULT_HOST = "shop.example"


def asin_from_url(c) -> Column:
    """First ASIN found by the patterns above, else NULL."""
    x = as_col(c)
    return F.coalesce(*[nullif_empty(F.regexp_extract(x, p, 1)) for p in ASIN_PATTERNS])


def asin_by_split(c) -> Column:
    """Segment after '/dp/' (else after '/gp/product/') up to the next '/'; '' -> NULL."""
    x = as_col(c)
    seg = lambda marker: F.split_part(F.split_part(x, F.lit(marker), F.lit(2)), F.lit("/"), F.lit(1))
    return nullif_empty(F.when(x.contains("/dp/"), seg("/dp/"))
                        .when(x.contains("/gp/product/"), seg("/gp/product/")))


def slug_title(c) -> Column:
    """Last path segment, '-' -> ' ', words capitalised (``initcap``: words split on spaces)."""
    x = as_col(c)
    return F.initcap(F.replace(F.regexp_extract(x, r"[^/]*$", 0), F.lit("-"), F.lit(" ")))


def ensure_leading_slash(c) -> Column:
    x = as_col(c)
    return F.when(x.startswith("/"), x).otherwise(F.concat(F.lit("/"), x))


def build_url(path, params=None, host: str = DEFAULT_HOST) -> Column:
    """``https://<host><path>[?k=v&...]``, keys and values form-encoded (space -> '+').

    ``params`` is a map<string,string> Column (or None).
    """
    base = F.concat(F.lit(f"https://{host}"), ensure_leading_slash(path))
    if params is None:
        return base
    m = as_col(params)
    q = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(
        F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"]))), "&")
    return F.when(F.size(m) > 0, F.concat(base, F.lit("?"), q)).otherwise(base)


def object_key(c) -> Column:
    """'\\' -> '/', runs of '/' collapsed, one leading '/' removed."""
    x = F.replace(as_col(c), F.lit("\\"), F.lit("/"))
    return F.regexp_replace(F.regexp_replace(x, r"/+", "/"), r"^/", "")


def rh_part(url) -> Column:
    """Decoded ``rh`` query value: text after the first 'rh=' up to '&'; NULL when absent."""
    x = as_col(url)
    after = F.when(x.contains("rh="), F.substring_index(F.substring_index(x, "rh=", 2), "rh=", -1))
    raw = F.split_part(after, F.lit("&"), F.lit(1))
    return F.replace(F.replace(raw, F.lit("%3A"), F.lit(":")), F.lit("%2C"), F.lit(","))


def facet_pairs(url) -> Column:
    """array<struct<filter_key, filter_value>> of all filter pairs in ``rh``, in order."""
    def pairs(rh: Column) -> Column:
        keys, vals = (F.regexp_extract_all(rh, F.lit(FACET_PAIR_PATTERN), F.lit(i)) for i in (1, 2))
        return F.arrays_zip(keys.alias("filter_key"), vals.alias("filter_value"))
    return let(rh_part(url), pairs)


def base_pairs(base_rh: str = BASE_RH) -> list[tuple[str, str]]:
    """Filter pairs of the category page's own ``rh`` (a constant of the job)."""
    import re
    decoded = base_rh.replace("%3A", ":").replace("%2C", ",")
    return re.findall(FACET_PAIR_PATTERN, decoded)


def facet_filter(url, base_rh: str = BASE_RH) -> Column:
    """struct(filter_key, filter_value): the first pair of the link's ``rh`` that is
    not among the base page's pairs; NULL fields when there is none."""
    pairs = facet_pairs(url)
    base = base_pairs(base_rh)
    if base:
        base_arr = F.array(*[F.struct(F.lit(k).alias("filter_key"), F.lit(v).alias("filter_value"))
                             for k, v in base])
        pairs = F.filter(pairs, lambda p: ~F.array_contains(base_arr, p))
    return let(F.try_element_at(pairs, F.lit(1)), lambda first: F.struct(
        first["filter_key"].alias("filter_key"), first["filter_value"].alias("filter_value")))
