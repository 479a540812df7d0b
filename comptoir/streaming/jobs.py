"""Structured Streaming forms of the incremental flows (STM-01..04).

* ``tumbling_metrics`` — event-time tumbling windows with a watermark.
* ``dedupe_stream``    — append-only ingest keeping the first row per key
                         (state bounded by a watermark when one is given).
* ``upsert_snapshot_batch`` — foreachBatch merge of each micro-batch into a snapshot of
                         key buckets (newest row per key wins; only touched buckets are written).
* ``window_rates``     — hourly request/error windows; alerts are read off them by thresholds.
* ``merge_windows``    — foreachBatch merge of update-mode windows, by day.

Checkpoints and outputs live under the shared folder (``spark.checkpoint.dir``),
so a restarted query resumes from its last committed batch; a batch that is
replayed is merged again into the newest version, with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedupe as DD
from ..operators import metrics as M


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (session time zone UTC), not TIMESTAMP_NTZ."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def tumbling_metrics(stream: DataFrame, duration: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    s = event_time(stream).withWatermark("ts", watermark)
    g = s.groupBy(F.window("ts", duration).alias("w"), "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "name", "n", "total")


def dedupe_stream(stream: DataFrame, keys, watermark_col: str | None = None, watermark: str | None = None) -> DataFrame:
    """First row per key across all micro-batches. With a watermark the key state
    is dropped once the event time has passed (``dropDuplicatesWithinWatermark``)."""
    keys = list(keys)
    if watermark_col and watermark:
        return event_time(stream, watermark_col).withWatermark(watermark_col, watermark) \
            .dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def window_rates(stream: DataFrame, duration: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Requests, errors and error rate per window. With the watermark, a window's state is dropped once
    no more events are waited for."""
    return M.windowed_rates(event_time(stream).withWatermark("ts", watermark), duration)


def window_alerts(stream: DataFrame, duration: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Alerts of closed windows (append mode). For windows as they change, merge :func:`window_rates` in
    update mode and apply ``metrics.alerts`` when reading: an alert may lapse while its window is open."""
    return M.alerts(window_rates(stream, duration, watermark))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def latest_version(spark: SparkSession, base: str) -> str | None:
    """Path of the newest committed snapshot version under ``base`` (``v=<n>``
    folders holding a ``_SUCCESS`` marker), or None."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return None
    best = None
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                n = int(name[2:])
                if best is None or n > best[0]:
                    best = (n, st.getPath().toString())
    return best[1] if best else None


def _versions(spark: SparkSession, base: str):
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return fs, []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            out.append((int(name[2:]), st.getPath()))
    return fs, sorted(out)


def prune_versions(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` snapshot versions (older readers of the
    previous version stay valid while ``keep`` >= 2)."""
    fs, vs = _versions(spark, base)
    for _, path in vs[:-keep] if keep > 0 else []:
        fs.delete(path, True)


def next_version(spark: SparkSession, base: str) -> str:
    """Path of the version after the newest committed one. Versions count on by themselves:
    batch ids start at 0 again with every new checkpoint."""
    newest = latest_version(spark, base)
    return f"{base}/v={int(newest.rstrip('/').rsplit('v=', 1)[1]) + 1 if newest else 0:012d}"


# -- snapshot in key buckets ---------------------------------------------------

BUCKET = "__bucket"


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def bucket_paths(spark: SparkSession, base: str) -> dict[int, str]:
    """Newest committed folder of each bucket of a snapshot (``v=<n>/__bucket=<k>``)."""
    fs, versions = _versions(spark, base)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    newest: dict[int, str] = {}
    for _, v in versions:
        if fs.exists(path(v, "_SUCCESS")):
            for st in fs.listStatus(v):
                if st.getPath().getName().startswith(BUCKET + "="):
                    newest[int(st.getPath().getName().split("=")[1])] = st.getPath().toString()
    return newest


def _prune_buckets(spark: SparkSession, base: str, keep: int) -> None:
    """Delete bucket folders with ``keep`` newer ones, and versions left without any."""
    fs, versions = _versions(spark, base)
    seen: dict[str, int] = {}
    for _, v in reversed(versions):
        left = 0
        for st in fs.listStatus(v):
            name = st.getPath().getName()
            if name.startswith(BUCKET + "="):
                seen[name] = seen.get(name, 0) + 1
                if seen[name] > keep:
                    fs.delete(st.getPath(), True)
                else:
                    left += 1
        if not left:
            fs.delete(v, True)


def read_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The snapshot: the newest version of every bucket."""
    paths = bucket_paths(spark, base)
    if not paths:
        raise FileNotFoundError(f"no committed version under {base}")
    return spark.read.parquet(*paths.values())


def _held(run):
    """``run`` on a batch that is kept while it is used more than once (lost blocks are computed again)."""
    def held(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            run(batch, batch_id)
        finally:
            batch.unpersist()
    return held


def upsert_snapshot_batch(base: str, key: str, ts_col: str, tie_break=(), keep_versions: int = 2, buckets: int = 64):
    """foreachBatch function: the newest row per key wins, in a snapshot cut into ``buckets`` by a hash of
    the key. Only buckets with keys of the batch are read, merged and written, as a new version of theirs; the
    others stay as they are. The newest ``keep_versions`` versions of a bucket are kept, so a reader of the
    one before can finish. A batch that is replayed is merged again, which changes nothing: its rows are in
    the snapshot or older."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn(BUCKET, bucket_of(key, buckets))
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # as many as buckets at most
        if not touched:
            return
        known = bucket_paths(spark, base)
        old = [known[b] for b in touched if b in known]
        target = spark.read.parquet(*old).drop(BUCKET) if old else batch.limit(0)
        merged = DD.incremental_update(target, batch, key, ts_col, tie_break, prefer_source=False)
        out = merged.withColumn(BUCKET, bucket_of(key, buckets))
        out.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(next_version(spark, base))
        _prune_buckets(spark, base, keep_versions)
    return _held(run)


# -- windows merged as they change ----------------------------------------------

DAY = "__day"


def merge_windows(base: str, keys=("window_start", "name")):
    """foreachBatch function for update-mode windows: the batch holds the present value of every window
    that changed, and replaces those rows in a table partitioned by day. Only days with a changed window are
    read and rewritten (dynamic partition overwrite); a replayed batch writes the same rows again."""
    keys = list(keys)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn(DAY, F.col("window_start").cast("date"))
        days = [r[0] for r in new.select(DAY).distinct().collect()]  # the days within the watermark
        if not days:
            return
        fs, p = _fs(spark, base)
        if fs.exists(p):
            old = spark.read.parquet(base).filter(F.col(DAY).isin(days)).select(*new.columns)
            new = old.join(new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)
        new.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(base)
    return _held(run)


def read_windows(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(base).drop(DAY)


def run_available(query_writer, checkpoint: str):
    """Start a writer with trigger(availableNow) and wait, however long, until it has
    drained the source; a failure of the query is raised."""
    q = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
