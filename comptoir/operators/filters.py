"""Row filters and predicates (FLT-01..11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..functions.text import LISTING_SENTINELS

# Page texts that mark a blocked (CAPTCHA / robot check) response.
BLOCK_CAPTCHA = "captcha"
BLOCK_ROBOT = "robot check"
BLOCK_MESSAGE = r"To discuss automated access to \w+ data"
MAX_REDIRECTS = 2

# Validation rules of the configuration.
REQUIRED_FIELDS = ("title", "price")
PRICE_MIN, PRICE_MAX = 0.01, 10000.0


def range_filter(df: DataFrame, price: str = "PRIX", note: str = "NOTE", lo=None, hi=None,
                 note_min: float = 3.0) -> DataFrame:
    """price in [lo, hi] and note >= note_min (FLT-01). lo/hi default to no bound."""
    cond = F.col(note) >= F.lit(note_min)
    if lo is not None:
        cond = cond & (F.col(price) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(price) <= F.lit(hi))
    return df.filter(cond)


def ram_filter(df: DataFrame, mode: str = "Intervalle", ram_min: float = 4, ram_max: float = 64,
               ram_exact: float = 8, col: str = "RAM") -> DataFrame:
    """RAM coerced to a number, then interval or exact match; no RAM column -> no filter (FLT-03)."""
    if col not in df.columns:
        return df
    d = df.withColumn(col, F.col(col).try_cast("double"))
    if mode == "Intervalle":
        return d.filter((F.col(col) >= ram_min) & (F.col(col) <= ram_max))
    if mode == "Exacte":
        return d.filter(F.col(col) == ram_exact)
    raise ValueError("mode must be 'Intervalle' or 'Exacte'")


def listing_valid(df: DataFrame) -> DataFrame:
    """Listing rows with a real title (sentinel -> NULL first) (FLT-07)."""
    t = F.nullif(F.col("titre"), F.lit(LISTING_SENTINELS["titre"]))
    return df.filter(t.isNotNull())


def detail_candidates(df: DataFrame) -> DataFrame:
    """Rows that can be fetched for details: asin and url present (FLT-07)."""
    return df.filter(F.col("asin").isNotNull() & F.col("url").isNotNull())


def is_blocked(html, status=None, n_redirects=None, url=None, message: str = BLOCK_MESSAGE) -> Column:
    """Blocked-page predicate (FLT-09): CAPTCHA text on a 200 page, robot check,
    the automated-access message (a pattern), more than two redirects, or 'captcha' in the URL."""
    h = as_col(html)
    low = F.lower(h)
    st = F.lit(200) if status is None else as_col(status)
    cond = ((st == 200) & low.contains(BLOCK_CAPTCHA)) | low.contains(BLOCK_ROBOT) | h.rlike(message)
    if n_redirects is not None:
        cond = cond | (F.coalesce(as_col(n_redirects), F.lit(0)) > MAX_REDIRECTS)
    if url is not None:
        cond = cond | F.coalesce(F.lower(as_col(url)).contains(BLOCK_CAPTCHA), F.lit(False))
    return F.coalesce(cond, F.lit(False))


def validate_rows(df: DataFrame, required=REQUIRED_FIELDS, price: str = "price",
                  lo: float = PRICE_MIN, hi: float = PRICE_MAX) -> DataFrame:
    """Adds ``violations`` (array of rule names) and ``valid`` (FLT-10)."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in required]
    p = F.col(price).try_cast("double")
    checks.append(F.when(p.isNotNull() & ((p < lo) | (p > hi)), F.lit(f"{price}_out_of_range")))
    v = F.array_compact(F.array(*checks))
    return df.withColumn("violations", v).withColumn("valid", F.size(v) == 0)
