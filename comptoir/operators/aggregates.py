"""Aggregations (AGG-*), share of total (WIN-05), histograms (AGG-05), top-k (SRT-04/05).

Every operator accepts an optional ``weight`` column: a row standing for
``weight`` identical rows. That is how the dashboard's row fan-out (each
product row repeated once per review of the product) is aggregated exactly
without ever materialising the repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranks


def _w(weight) -> Column:
    return F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")


def weighted_count(weight=None) -> Column:
    return F.sum(_w(weight)).cast("bigint") if weight is not None else F.count(F.lit(1))


def weighted_mean(x: str, weight=None) -> Column:
    if weight is None:
        return F.avg(x)
    w = F.when(F.col(x).isNotNull(), _w(weight))
    return F.sum(F.col(x) * w) / F.sum(w)


def value_counts(df: DataFrame, col: str, weight=None, null_label: str | None = None,
                 name: str = "count") -> DataFrame:
    """Counts per value, largest first; NULL values dropped unless ``null_label`` maps them."""
    c = F.col(col)
    d = df.withColumn(col, F.coalesce(c, F.lit(null_label))) if null_label is not None else df.filter(c.isNotNull())
    return d.groupBy(col).agg(weighted_count(weight).alias(name)).orderBy(F.desc(name), F.asc(col))


def share_of_total(counts: DataFrame, count_col: str = "count", pct_col: str = "pct",
                   digits: int = 1) -> DataFrame:
    """count / sum(count) as a rounded percentage. Runs on already-aggregated rows
    (a handful of groups), so the global window is cheap."""
    total = F.sum(count_col).over(Window.partitionBy())
    return counts.withColumn(pct_col, F.round(F.col(count_col) * 100.0 / total, digits))


def mean_by(df: DataFrame, key: str, x: str, weight=None, name: str | None = None) -> DataFrame:
    return (df.filter(F.col(key).isNotNull())
            .groupBy(key).agg(weighted_mean(x, weight).alias(name or x)))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """orderBy + limit -> TakeOrderedAndProject (per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def histogram(df: DataFrame, x: str, bins: int, weight=None) -> DataFrame:
    """Exactly ``bins`` equal-width bins over [min, max]; the maximum falls in the last
    bin; empty bins reported with 0; a constant column gives one bin holding all.

    Output: bin (1-based), lo, hi, count. The bin table is ``bins`` rows
    generated by Spark (bounded by the parameter), left-joined to the counts.
    """
    # Weights are first summed per distinct value (map-side combined); the bounds
    # subquery and the bin counts both read that table, and AQE reuses its shuffle,
    # so the input is computed once.
    vals = df.filter(F.col(x).isNotNull()).groupBy(x).agg(F.sum(_w(weight)).alias("__vw"))
    v = F.col(x)
    # (the subquery also reads the weight so its copy of ``vals`` is identical to the
    # main query's and the shuffle can be reused)
    b = vals.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.sum("__vw").alias("n"))).scalar()
    lo, hi = b["lo"], b["hi"]
    nb = F.when(hi == lo, F.lit(1)).otherwise(F.lit(bins))
    width = (hi - lo) / bins
    idx = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.lit(bins), (F.floor((v - lo) / width) + 1).cast("int")))
    counted = (vals.select(idx.alias("bin"), F.col("__vw"))
               .groupBy("bin").agg(F.sum("__vw").cast("bigint").alias("count")))
    frame = (df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
             .filter(F.col("bin") <= nb)
             .select("bin", (lo + (F.col("bin") - 1) * (hi - lo) / nb).alias("lo"),
                     (lo + F.col("bin") * (hi - lo) / nb).alias("hi")))
    return (frame.join(counted, "bin", "left")
            .select("bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def bounds(df: DataFrame, x: str, default_min=None, default_max=None) -> DataFrame:
    return df.agg(F.coalesce(F.min(x), F.lit(default_min)).alias(f"min_{x.lower()}"),
                  F.coalesce(F.max(x), F.lit(default_max)).alias(f"max_{x.lower()}"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def numeric_stats(df: DataFrame, x: str, exact_median: bool = True) -> DataFrame:
    """count, min, max, mean, median of a numeric column (AGG-06).

    The median is exact, by rank selection over ranges of the counted values (see
    ``ranks.exact_median``); ``exact_median=False`` uses percentile_approx.
    """
    stats = [F.count(x).alias("count"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean")]
    if not exact_median:
        return df.agg(*stats, F.percentile_approx(x, 0.5, 10000).cast("double").alias("median"))
    return df.agg(*stats).withColumn("median", ranks.exact_median(df, x).scalar())


def count_distinct_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Distinct values per key as a count (AGG-19). Planned as two aggregations
    (key,value) -> key, both with map-side combine; no per-key set is built."""
    return df.groupBy(key).agg(F.countDistinct(value).alias(name))
