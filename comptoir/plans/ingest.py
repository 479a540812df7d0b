"""Incremental ingest flows of the collection DAG, as batch jobs over page corpora.

``review_ingest``: extract review blocks -> drop (asin, reviewer) pairs already
stored -> on request, keep the first ``max_reviews`` per product in page order. The cut
comes after the anti-join, as in the reference, and two reviews by the same
reviewer on the new pages both pass (only stored reviews are excluded).

``listing_ingest``: extract result blocks -> drop rows without title -> drop
ASINs already stored -> first row per ASIN in page order (rows without ASIN
are all kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.extract import extract_listing, extract_reviews
from ..operators.joins import anti_join, new_listings, top_n_per_group

def review_ingest(pages: DataFrame, known: DataFrame, max_reviews: int | None = None,
                  page_col: str = "page_id", asin=None) -> DataFrame:
    """All new reviews, or with ``max_reviews`` the first so many per product."""
    reviews = extract_reviews(pages, asin=asin, page_col=page_col)
    fresh = anti_join(reviews, known.select("asin", "reviewer"), ["asin", "reviewer"])
    return fresh if max_reviews is None else top_n_per_group(fresh, "asin", [F.col("page"), F.col("pos")], max_reviews)


def listing_ingest(pages: DataFrame, known: DataFrame, page_col: str = "page_id") -> DataFrame:
    rows = extract_listing(pages, page_col=page_col)
    return new_listings(rows, known, ("page", "pos"))
