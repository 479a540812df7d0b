"""Joins: product assembly (JN-01), band range join (JN-02), left/anti/semi joins (JN-03..09).

Equi-joins are left to Catalyst + AQE: the planner broadcasts a side only when
its size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-checks the real size at runtime; skewed keys (a product holding a third of
all reviews) are split by AQE's skew-join rule. Range joins become equi-joins
on the numbers that values have in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_col

PRODUCT1_COLS = ("asin", "manufacturer", "processor_type", "hard_drive_size",
                 "hard_disk_description", "ram_size", "url")
PRODUCT2_COLS = ("asin", "nombre_avis", "prix", "page", "note", "url", "titre")


def require_columns(df: DataFrame, cols, what: str = "input") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {missing}; has {df.columns}")


def product_info(p1: DataFrame, p2: DataFrame) -> DataFrame:
    """Both product tables, one row per asin."""
    require_columns(p1, PRODUCT1_COLS, "product_info1")
    require_columns(p2, PRODUCT2_COLS, "product_info2")
    return (p1.select("asin", "manufacturer", "processor_type", "hard_drive_size",
                      "hard_disk_description", "ram_size", F.col("url").alias("url_info1"))
            .join(p2.select("asin", "nombre_avis", "prix", "page", "note",
                            F.col("url").alias("url_info2"), "titre"), "asin"))


def full_product_info(p1: DataFrame, p2: DataFrame, review: DataFrame) -> DataFrame:
    """Three-way inner equi-join on asin (one output row per review).

    The two product tables are joined first (same grain, one row per asin),
    then the review fact is joined once on the product side.
    """
    require_columns(review, ("asin", "sentiment"), "review")
    return product_info(p1, p2).join(review.select("asin", "sentiment"), "asin")


def range_join(df: DataFrame, value: Column, ranges: DataFrame, lo: str, hi: str, how: str = "left") -> DataFrame:
    """``df LEFT/INNER JOIN ranges ON value BETWEEN lo AND hi``, for ranges of any number, width and overlap.

    The distinct values and the ends of the ranges are put in one order and the values counted through
    (``ranks.running_sum``): a range holds the values numbered from the count at its lower end to the count at its
    upper end. So ranges are matched to values by number, an equi-join whose size is that of the result per distinct
    value, and the rows of ``df`` meet the matches of their value in a second one. Nothing is broadcast unless
    Spark finds it small, and there is no width to choose. NULL and NaN values match nothing, nor do ranges with a
    NULL end or a lower end above the upper one."""
    if how not in ("left", "inner"):
        raise ValueError("range_join supports 'left' and 'inner'")
    from .ranks import running_sum
    extra = [c for c in ranges.columns if c not in df.columns]
    left = df.withColumn("__v", value.cast("double"))
    left = left.withColumn("__v", F.when(~F.isnan("__v"), F.col("__v") + F.lit(0.0)))  # -0.0 is 0.0
    known = ranges.filter(F.col(lo) <= F.col(hi)).select(F.col(lo).cast("double").alias("__lo"), F.col(hi).cast("double").alias("__hi"),
                                                         F.struct(*[F.col(c) for c in extra]).alias("__r"))
    # at an equal value a lower end comes before it, an upper end after it
    none = F.lit(None).cast(known.schema["__r"].dataType)
    values = left.filter(F.col("__v").isNotNull()).select("__v").distinct().select(
        F.col("__v").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("double").alias("__hi"), none.alias("__r"))
    lows = known.select(F.col("__lo").alias("__at"), F.lit(0).alias("__kind"), "__hi", "__r")
    numbered = running_sum(values.unionByName(lows), ["__at", "__kind"], weight=F.when(F.col("__kind") == 1, 1).otherwise(0), to="__n")
    points = numbered.filter("__kind = 1").select(F.col("__at").alias("__v"), "__n")
    begun = numbered.filter("__kind = 0").select(F.col("__hi").alias("__at"), F.lit(2).alias("__kind"), F.col("__n").alias("__from"), "__r")
    ends = running_sum(points.select(F.col("__v").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__from"), none.alias("__r"))
                       .unionByName(begun), ["__at", "__kind"], weight=F.when(F.col("__kind") == 1, 1).otherwise(0), to="__to")
    spans = ends.filter((F.col("__kind") == 2) & (F.col("__to") > F.col("__from")))
    covered = spans.select("__r", F.explode(F.sequence(F.col("__from"), F.col("__to") - 1)).alias("__n"))
    matches = points.join(covered, "__n").select("__v", "__r")
    out = left.join(matches, "__v", how)
    return out.select(*df.columns, *[F.col(f"__r.{c}").alias(c) for c in extra])


def price_class(number: Column) -> Column:
    """Class of a price by the built-in bands; an expression of the row, since the bands are three constants."""
    from ..functions.price import PRICE_BANDS
    picked = [F.when(number.between(lo, hi), F.lit(name)) for name, lo, hi in PRICE_BANDS]
    return F.coalesce(*picked)


def price_class_join(full: DataFrame, bands: DataFrame | None = None, price_col: str = "prix",
                     strict: bool = False) -> DataFrame:
    """``f.*, c.classe`` with the band picked on the integer-rounded price.
    ``bands=None`` uses the built-in three bands, which need no join."""
    from ..functions.price import parse_price_number
    value = parse_price_number(price_col, strict).cast("double")
    if bands is None:
        return full.withColumn("__value", value).withColumn("classe", price_class(F.col("__value"))).drop("__value")
    return range_join(full, value, bands.select("classe", "prix_min", "prix_max"),
                      "prix_min", "prix_max", "left").drop("prix_min", "prix_max")


def sentiment_left_join(products: DataFrame, sentiments: DataFrame, key: str = "asin",
                        default: str = "Neutral") -> DataFrame:
    """Left equi-join of a sentiment table, missing sentiment filled (JN-03)."""
    require_columns(products, (key,), "products")
    require_columns(sentiments, (key, "sentiment"), "sentiments")
    return (products.join(sentiments.select(key, "sentiment"), key, "left")
            .withColumn("sentiment", F.coalesce("sentiment", F.lit(default))))


def anti_join(df: DataFrame, known: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` whose key is not in ``known`` (NULL keys never match, so they stay)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    require_columns(df, keys, "input")
    require_columns(known, keys, "known keys")
    # distinct: copies of a hot known key are combined in the map tasks
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def semi_filter(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Membership filter as a left-semi join (scales to large value lists)."""
    return df.join(allowed.select(key).distinct(), key, "left_semi")


def isin_filter(df: DataFrame, col, values) -> DataFrame:
    """Optional membership filter: an empty/None list means no filter."""
    if not values:
        return df
    return df.filter(as_col(col).isin(list(values)))


def first_per_key(df: DataFrame, key: str, order_cols) -> DataFrame:
    """In-batch first wins per non-null key; rows with NULL key are all kept (JN-07).
    One pass: a row without a key is a group of its own. Partial top-1 per map task
    before the shuffle, so a hot key ships one row a task."""
    from .dedupe import tie_break
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in order_cols] + tie_break(df, [key, *order_cols], last=False)
    w = Window.partitionBy(key, "__alone").orderBy(*order)
    return (df.withColumn("__alone", alone).withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn", "__alone"))


def new_listings(batch: DataFrame, known: DataFrame, order_cols=("page", "pos")) -> DataFrame:
    """Listing rows to append: title present, ASIN not known, first occurrence of
    each ASIN in the batch; rows without ASIN always kept (JN-06/07, FLT-07)."""
    valid = batch.filter(F.col("titre").isNotNull())
    fresh = anti_join(valid, known.select("asin").filter(F.col("asin").isNotNull()), "asin")
    return first_per_key(fresh, "asin", order_cols)


def top_n_per_group(df: DataFrame, group, order, n: int) -> DataFrame:
    """First ``n`` rows of each group in ``order`` (WIN-03 / WIN-04).

    row_number() <= n is planned with a partial WindowGroupLimit before the
    shuffle, so each map task ships at most n rows per group.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
