"""General text expressions: whitespace, sentinels, spec text, HTML link cell,
run ids, timestamps, list formatting (STR-07, 08, 18..23, NUM-01)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, let

# Sentinels the listing extractor writes for missing fields.
LISTING_SENTINELS = {
    "titre": "Titre non disponible",
    "url": "URL non disponible",
    "prix": "Prix non disponible",
    "note": "Note non disponible",
    "nombre_avis": "Nombre d'avis non disponible",
    "image_url": "Image non disponible",
    "asin": "ASIN non disponible",
}

LRM = "‎"


# The whitespace set stripped from both ends, that of Python's ``str.strip``.
WHITESPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c) -> Column:
    """Trim leading/trailing whitespace, as ``str.strip`` does; a character-set trim, no regex."""
    return F.trim(as_col(c), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    """Strip, then '' -> NULL (STR-07)."""
    return F.nullif(strip_ws(c), F.lit(""))


def clean_spec_text(c) -> Column:
    """strip, '\\n' -> ' ', one pass of '  ' -> ' ', drop one leading U+200E (STR-08)."""
    x = F.replace(F.replace(strip_ws(c), F.lit("\n"), F.lit(" ")), F.lit("  "), F.lit(" "))
    return let(x, lambda v: F.when(v.startswith(LRM), F.substring(v, 2, 1 << 30)).otherwise(v))


def sentinel_to_null(c, sentinel: str) -> Column:
    return F.nullif(as_col(c), F.lit(sentinel))


def null_to_sentinel(c, sentinel: str) -> Column:
    return F.coalesce(as_col(c), F.lit(sentinel))


def html_link(url, title) -> Column:
    """'<a href="url" target="_blank">title</a>' when url is non-blank, else the title."""
    u, t = as_col(url), as_col(title)
    return (F.when(u.isNotNull() & (strip_ws(u) != ""),
                   F.concat(F.lit('<a href="'), u, F.lit('" target="_blank">'), t, F.lit("</a>")))
            .otherwise(t))


def run_id(ts) -> Column:
    """'%Y%m%d_%H%M%S' of a timestamp."""
    return F.date_format(as_col(ts), "yyyyMMdd_HHmmss")


def to_timestamp_lenient(c) -> Column:
    """Text -> timestamp; unparsable -> NULL (``errors='coerce'``)."""
    x = as_col(c)
    return F.try_to_timestamp(x.cast("string"))


def bullet_list(arr, prefix: str = "- ") -> Column:
    """array<string> -> newline-joined '- item' lines."""
    return F.array_join(F.transform(as_col(arr), lambda v: F.concat(F.lit(prefix), v)), "\n")


def seconds_to_hours(c) -> Column:
    return F.round(as_col(c) / 3600.0, 2)


def bytes_to_mb(c) -> Column:
    return F.round(as_col(c) / (1024.0 * 1024.0), 2)
