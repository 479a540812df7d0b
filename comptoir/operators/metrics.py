"""Run-metric roll-ups over an event log (AGG-14..18, WIN-04, NUM-01).

The event log is a DataFrame ``(event_id, ts, kind, name, category, value)``
— one row per counter increment, gauge reading, request duration or error —
replacing the reference's in-process counters and deques.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import running_sum

# Size of the rolling sample buffer.
HISTORY_SIZE = 100


# Kinds that are a state, not a request; and kinds that are no increments.
NOT_REQUESTS = ("gauge", "counter")
NOT_COUNTERS = ("gauge", "duration")


def _is_request() -> Column:
    return ~F.coalesce(F.col("kind").isin(*NOT_REQUESTS), F.lit(False))


def counters(log: DataFrame) -> DataFrame:
    """All-time counter per name: number of increments and their summed value
    (gauge readings and durations are no increments)."""
    return log.filter(~F.coalesce(F.col("kind").isin(*NOT_COUNTERS), F.lit(False))).groupBy("name").agg(F.count(F.lit(1)).alias("increments"),
                                   F.round(F.sum("value"), 6).alias("total"))


def gauges(log: DataFrame, kind: str = "gauge") -> DataFrame:
    """Latest value per gauge name (ties on ts broken by event_id)."""
    g = log.filter(F.col("kind") == kind)
    latest = F.max_by(F.struct("value", "ts"), F.struct("ts", "event_id"))
    return g.groupBy("name").agg(latest.alias("m")).select("name", F.col("m.value").alias("value"),
                                                            F.col("m.ts").alias("ts"))


def error_counts(log: DataFrame, kind: str = "error", type_col: str = "category") -> DataFrame:
    """Errors per type plus a 'total' row (rollup over the type); errors without a type have a NULL row."""
    e = log.filter(F.col("kind") == kind)
    r = e.rollup(type_col).agg(F.count(F.lit(1)).alias("n"), F.grouping(type_col).alias("__total"))
    return r.select(F.when(F.col("__total") == 1, F.lit("total")).otherwise(F.col(type_col)).alias("error_type"), "n")


def _duration_stats(df: DataFrame, keys=()) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.avg("value"), 6).alias("avg"), F.min("value").alias("min"),
                                 F.max("value").alias("max"), F.count(F.lit(1)).alias("count"))


def last_n(log: DataFrame, n: int = HISTORY_SIZE, kind: str = "duration") -> DataFrame:
    """The ``n`` most recent samples overall (TakeOrderedAndProject: per-task top-n, then merge)."""
    d = log.filter(F.col("kind") == kind)
    return d.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def request_stats(log: DataFrame, n: int = HISTORY_SIZE) -> DataFrame:
    """avg/min/max/count of the last ``n`` request durations."""
    return _duration_stats(last_n(log, n))


def last_n_per_category(log: DataFrame, n: int = HISTORY_SIZE, kind: str = "duration") -> DataFrame:
    """The ``n`` most recent samples of each category (row_number <= n, planned with a
    partial WindowGroupLimit before the shuffle: a hot category ships n rows per task)."""
    d = log.filter(F.col("kind") == kind)
    w = Window.partitionBy("category").orderBy(F.desc("ts"), F.desc("event_id"))
    return d.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def category_stats(log: DataFrame, n: int = HISTORY_SIZE) -> DataFrame:
    return _duration_stats(last_n_per_category(log, n), ["category"])


def rolling_last_n(log: DataFrame, n: int = HISTORY_SIZE, kind: str = "duration") -> DataFrame:
    """For every sample: avg/min/max/count of the last ``n`` samples of its category
    (itself included), i.e. ``rowsBetween(-(n-1), 0)`` ordered by (ts, event_id).

    A plain window partitioned by category would put a whole category in one task. Instead samples are
    dealt by ranges of (category, ts, event_id), so that one category, or one minute of it, spreads over
    tasks, and get their number in the category from prefix sums (``ranks.running_sum``). Numbers are cut into
    blocks of ``n``; a sample goes to its own block and, as halo, to the next, and every window holds at
    most 2n rows. The input is read once.
    """
    d = log.filter(F.col("kind") == kind).select("event_id", "ts", "category", "value")
    ranked = running_sum(d, ["ts", "event_id"], by=["category"], to="__rank")
    block = F.floor(F.col("__rank") / n)
    both = ranked.withColumn("__block", F.explode(F.array(block, block + 1)))
    w = Window.partitionBy("category", "__block").orderBy("__rank").rowsBetween(-(n - 1), 0)
    out = both.select("event_id", "ts", "category", "value", (F.col("__block") == block).alias("__own"),
                      F.round(F.avg("value").over(w), 6).alias("rolling_avg"),
                      F.round(F.sum("value").over(w), 6).alias("rolling_sum"),
                      F.min("value").over(w).alias("rolling_min"),
                      F.max("value").over(w).alias("rolling_max"),
                      F.count(F.lit(1)).over(w).alias("rolling_n"))
    return out.filter("__own").drop("__own")


def success_rate(log: DataFrame, kind_error: str = "error", by=None, total_label: str | None = None) -> DataFrame:
    """round((1 - errors / requests) * 100, 2), 0 when there is no request; gauge readings and
    counter increments are no requests. Optionally per group. With ``total_label`` (one grouping column) the overall row is added by a rollup,
    in the same pass, with the label in the group column."""
    keys = [by] if isinstance(by, str) else list(by or [])
    aggs = [F.count_if(_is_request()).alias("requests"), F.count_if(F.col("kind") == kind_error).alias("errors")]
    if total_label is not None and len(keys) == 1:
        k = keys[0]
        g = (log.rollup(k).agg(*aggs, F.grouping(k).alias("__total"))
             .withColumn(k, F.when(F.col("__total") == 1, F.lit(total_label)).otherwise(F.col(k))).drop("__total"))
    else:
        g = log.groupBy(*keys).agg(*aggs)
    rate = F.when(F.col("requests") > 0, F.round((1 - F.col("errors") / F.col("requests")) * 100, 2)).otherwise(F.lit(0.0))
    return g.withColumn("success_rate", rate)


def windowed_rates(log: DataFrame, duration: str = "1 hour", kind_error: str = "error") -> DataFrame:
    """Requests, errors, error rate (%) per tumbling event-time window.
    A TIMESTAMP ``ts`` is used as is, so a watermark defined on it still applies."""
    ts = F.col("ts") if dict(log.dtypes).get("ts") == "timestamp" else F.col("ts").cast("timestamp")
    w = F.window(ts, duration)
    g = log.groupBy(w.alias("w")).agg(F.count_if(_is_request()).alias("requests"),
                                      F.count_if(F.col("kind") == kind_error).alias("errors"))
    return g.select(F.col("w.start").alias("window_start"), "requests", "errors",
                    F.when(F.col("requests") > 0, F.round(F.col("errors") * 100.0 / F.col("requests"), 4))
                    .otherwise(F.lit(0.0)).alias("error_rate_pct"))


# Alert thresholds of the configuration.
ALERT_ERROR_RATE_PCT = 5.0
ALERT_MIN_REQUESTS_PER_HOUR = 100


def alerts(rates: DataFrame, max_error_pct: float = ALERT_ERROR_RATE_PCT,
           min_requests: int = ALERT_MIN_REQUESTS_PER_HOUR) -> DataFrame:
    """Windows breaking a threshold, with the reason(s)."""
    reasons = F.array_compact(F.array(
        F.when(F.col("error_rate_pct") > max_error_pct, F.lit("error_rate")),
        F.when(F.col("requests") < min_requests, F.lit("throughput"))))
    return rates.withColumn("alerts", F.array_join(reasons, ",")).filter(F.size(reasons) > 0)
