"""Running sums in a total order, without a task that sees all rows.

Rows are dealt by ranges of the order (a sample of the order columns gives the
bounds, so a hot group is cut as well as any other, as long as the order tells
its rows apart), and written to the shared folder with the number of their
range. Sums per range are few; their prefix sums carry into each range, in
which rows are then added up locally. Rank selection, rolling windows and
range joins are made of this.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_subdir

RANGE = "__range"


def deal_by_order(df: DataFrame, order, by=()) -> DataFrame:
    """``df`` written by ranges of (``by``, ``order``), NULL first, with the range's number."""
    spark = df.sparkSession
    path = new_subdir(spark, "ordered")
    keys = [*by, *order]
    df.repartitionByRange(*keys).withColumn(RANGE, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def running_sum(df: DataFrame, order, by=(), weight: Column | None = None, to: str = "before") -> DataFrame:
    """``df`` with ``to``: the sum of ``weight`` (1) over the rows before this one, within ``by``, in
    ascending ``order`` (columns; rows that tie in all of them are in any order). NULL keys are a group
    and NULL order values come first."""
    order, by = list(order), list(by)
    d = deal_by_order(df.withColumn("__w", (F.lit(1) if weight is None else weight).cast("long")), order, by)
    sums = d.groupBy(RANGE, *by).agg(F.sum("__w").alias("__s"))
    earlier = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(F.col(RANGE).alias("__of_range"), *[F.col(c).alias(f"__by_{c}") for c in by],
                        F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__carry"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by], F.col(RANGE) == F.col("__of_range"))
    local = Window.partitionBy(RANGE, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = d.withColumn("__local", F.coalesce(F.sum("__w").over(local), F.lit(0)))
    return (here.join(carry, same).withColumn(to, F.col("__carry") + F.col("__local"))
            .drop("__of_range", "__carry", "__local", "__w", RANGE, *[f"__by_{c}" for c in by]))


def exact_median(df: DataFrame, x: str) -> DataFrame:
    """One row ``median`` (DOUBLE; NULL without values): the middle value, or the mean of the two middle
    ones. Values are counted first, the counts ranked by ranges of the value; no task holds all values."""
    counts = df.filter(F.col(x).isNotNull()).groupBy(F.col(x).alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_sum(counts, ["__x"], weight=F.col("__n"))
    total = ranked.agg(F.sum("__n").alias("n")).scalar()
    low, high = F.floor((total - 1) / 2), F.floor(total / 2)
    mid = ranked.filter((F.col("before") <= high) & (F.col("before") + F.col("__n") > low))
    # at most two rows: the values that hold the two middle ranks
    return mid.agg(F.avg(F.col("__x").cast("double")).alias("median"))
