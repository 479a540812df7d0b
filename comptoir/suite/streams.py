"""Registered queries: Structured Streaming twins.

The source is a folder of Parquet files written from a driver-derived table;
the stream drains it with ``trigger(availableNow=True)`` in several
micro-batches (``maxFilesPerTrigger``), with its checkpoint in the shared
folder, and the query returns what the sink holds at the end.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fx, table, with_fx
from ..sources import writers as W
from ..operators import metrics as M
from ..streaming import jobs as S
from .metrics import O as _METRIC_ORACLE

ALERT_SQL = _METRIC_ORACLE["alert_windows"]

Q: dict = {}
O: dict = {}


def _source(spark, df, name, files: int = 8):
    path = W.scratch_path(spark, f"stream-src/{name}")
    df.repartition(files).write.parquet(path)
    return path, df.schema


def _read(spark, path, schema, per_trigger: int = 2):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def _by_time(spark, df, name, writer, col: str = "ts", slices: int = 4):
    """Slices of event time come into a source folder one after another, each in as many files as tasks wrote it;
    after each, the stream of ``writer`` (source -> stream writer) drains the folder and goes on from its checkpoint."""
    path, checkpoint = W.scratch_path(spark, f"stream-src/{name}"), W.scratch_path(spark, f"stream-ckpt/{name}")
    lo, hi = df.agg(F.min(col).cast("long"), F.max(col).cast("long")).first()
    step = max(1, (hi - lo) // slices + 1)
    for i in range(slices):
        part = F.floor((F.col(col).cast("long") - lo) / step) == i
        df.filter(part).write.mode("append").parquet(path)
        S.run_available(writer(spark.readStream.schema(df.schema).parquet(path)), checkpoint)


def q_metrics_tumbling(spark, sf):
    """Five-minute windows in update mode: late state is dropped at the watermark, changed windows are merged."""
    log = fx(spark, sf, "fx_metric_samples").withColumn("ts", F.col("ts").cast("timestamp"))
    out = W.scratch_path(spark, "stream-out/metrics")
    _by_time(spark, log, "metrics", lambda s: S.tumbling_metrics(s, "5 minutes", "10 minutes")
             .writeStream.outputMode("update").foreachBatch(S.merge_windows(out)))
    return (S.read_windows(spark, out)
            .select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "name", "n",
                    F.round("total", 6).alias("total")))


O["metrics_tumbling"] = with_fx(
    "SELECT strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start, name, count(*) AS n, "
    "round(sum(value), 6) AS total FROM fx_metric_samples GROUP BY 1, 2", "fx_metric_samples")


def q_stream_dedupe(spark, sf):
    """Reviews delivered at least once (a third of them again up to two days later), kept once: the
    state of a key is dropped when the watermark of ten days has passed it."""
    r = fx(spark, sf, "fx_reviews").select("asin", "reviewer", "l_orderkey", "l_linenumber", "l_shipdate",
                                           F.col("l_shipdate").cast("timestamp").alias("ts"))
    again = r.filter(F.col("l_linenumber") % 3 == 0).withColumn("ts", F.col("ts") + F.make_dt_interval(F.pmod("l_orderkey", F.lit(3)).cast("int")))
    keys = ["asin", "reviewer", "l_orderkey", "l_linenumber", "l_shipdate"]
    out = W.scratch_path(spark, "stream-out/reviews")
    _by_time(spark, r.unionByName(again), "reviews", lambda s: S.dedupe_stream(s, keys, "ts", "10 days")
             .writeStream.outputMode("append").format("parquet").option("path", out))
    return spark.read.parquet(out).select("asin", "reviewer", "l_orderkey", "l_linenumber")


O["stream_dedupe"] = with_fx(
    "SELECT asin, reviewer, l_orderkey, l_linenumber FROM (SELECT DISTINCT asin, reviewer, l_orderkey, l_linenumber, l_shipdate FROM fx_reviews) d", "fx_reviews")


def q_stream_upsert(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("product_id"),
                                          F.col("o_orderdate").cast("timestamp").alias("last_updated"),
                                          "o_orderkey", "o_totalprice")
    src, schema = _source(spark, o, "orders")
    base = W.scratch_path(spark, "stream-out/snapshot")
    S.run_available(_read(spark, src, schema).writeStream.foreachBatch(
        S.upsert_snapshot_batch(base, "product_id", "last_updated", ["o_orderkey"])),
        W.scratch_path(spark, "stream-ckpt/snapshot"))
    return S.read_snapshot(spark, base).select("product_id", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
                       "o_orderkey", "o_totalprice")


O["stream_upsert"] = (
    "SELECT product_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_updated, o_orderkey, o_totalprice FROM "
    "(SELECT o_custkey AS product_id, o_orderdate AS ts, o_orderkey, o_totalprice, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders) t WHERE rn = 1")


def q_stream_alerts(spark, sf):
    """Hourly request/error windows kept by a stream in update mode; alerts are read off them."""
    log = fx(spark, sf, "fx_metric_samples").withColumn("ts", F.col("ts").cast("timestamp"))
    out = W.scratch_path(spark, "stream-out/alerts")
    _by_time(spark, log, "alerts", lambda s: S.window_rates(s)
             .writeStream.outputMode("update").foreachBatch(S.merge_windows(out, ["window_start"])))
    return M.alerts(S.read_windows(spark, out)).withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


O["stream_alerts"] = ALERT_SQL


for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
