"""Running sums, medians and range joins without a task that sees all; stores, named tables and streams with bounded state."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from comptoir.operators import aggregates as A
from comptoir.operators import joins as J
from comptoir.operators import metrics as M
from comptoir.operators import ranks as R
from comptoir.operators import text as TX
from comptoir.session import new_subdir
from comptoir.sources import readers as RD
from comptoir.sources import writers as W
from comptoir.sources.known_keys import KnownKeys, ingest
from comptoir.streaming import jobs as S


@pytest.fixture
def spread(spark):
    """Small ranges are not put together again."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def test_running_sum_matches_a_plain_window(spark):
    r = random.Random(1)
    data = [(i, r.choice(["a", "a", "a", "b", None]), r.choice([None, r.randint(0, 50)]), r.randint(0, 9)) for i in range(700)]
    d = spark.createDataFrame(data, "i int, g string, v int, w int")
    w = Window.partitionBy("g").orderBy("v", "i").rowsBetween(Window.unboundedPreceding, -1)
    want = {x.i: x.s for x in d.withColumn("s", F.coalesce(F.sum("w").over(w), F.lit(0))).collect()}
    got = {x.i: x.before for x in R.running_sum(d, ["v", "i"], by=["g"], weight=F.col("w")).collect()}
    assert got == want
    assert R.running_sum(d.limit(0), ["v"]).count() == 0


def test_a_hot_category_and_minute_spread_over_tasks(spark, spread):
    """One category and one minute hold nearly all samples: ranges still share them out."""
    log = spark.range(4000).select(F.col("id").alias("event_id"), F.lit("duration").alias("kind"), F.lit("hot").alias("category"),
                                   F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod("id", F.lit(3))).alias("ts"), (F.col("id") % 7).cast("double").alias("value"))
    dealt = R.deal_by_order(log, ["ts", "event_id"], ["category"])
    sizes = [x["count"] for x in dealt.groupBy(R.RANGE).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2000
    out = M.rolling_last_n(log, 100)
    assert out.count() == 4000 and out.agg(F.max("rolling_n")).first()[0] == 100


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 9 + [1.0], [None, 1.0, None, 4.0], [None], [],
                                    [random.Random(3).choice([0.1, 2.5, 2.5, 7.0, 1e9]) for _ in range(301)], list(map(float, range(1000)))])
def test_median(spark, values):
    d = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v is not None]
    assert R.exact_median(d, "x").first()[0] == (statistics.median(known) if known else None)
    assert A.numeric_stats(d, "x").first().median == (statistics.median(known) if known else None)


def test_median_holds_no_task_with_all_values(spark, spread):
    dealt = R.deal_by_order(spark.range(8000).select(F.col("id").cast("double").alias("x"), F.lit(1).alias("n")), ["x"])
    sizes = [r["count"] for r in dealt.groupBy(R.RANGE).count().collect()]
    assert max(sizes) < 4000 and sum(sizes) == 8000
    p = A.numeric_stats(spark.range(50).select(F.col("id").cast("double").alias("x")), "x")._jdf.queryExecution().executedPlan().toString()
    assert "median(" not in p and "percentile" not in p


@pytest.mark.parametrize("how", ["left", "inner"])
def test_range_join_matches_brute_force(spark, how):
    r = random.Random(5)
    values = [None, float("nan"), 0.0, -0.0, 1e10, 1e10 + 1, -5.0] + [float(r.randint(-5, 40)) for _ in range(60)] + [7.0] * 50
    ranges = [("wide", -1e10, 1e10), ("point", 7.0, 7.0), ("turned", 9.0, 3.0), ("open", None, 3.0), ("open2", 1.0, None), ("far", 100.0, 200.0)]
    ranges += [(f"r{i}", float(lo), float(lo + r.choice([0, 1, 5, 20]))) for i, lo in enumerate(r.choices(range(-6, 42), k=25))] + [("point", 7.0, 7.0)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rr = spark.createDataFrame(ranges, "name string, lo double, hi double")
    want = []
    for i, v in enumerate(values):
        hits = [n for n, lo, hi in ranges if v is not None and v == v and lo is not None and hi is not None and lo <= v <= hi]
        want += [(i, n) for n in hits] or ([(i, None)] if how == "left" else [])
    got = [(x.i, x.name) for x in J.range_join(df, F.col("v"), rr, "lo", "hi", how).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert J.range_join(df, F.col("v"), rr.limit(0), "lo", "hi", how).count() == (len(values) if how == "left" else 0)


def test_first_per_key_reads_its_input_once(spark):
    d = spark.createDataFrame([(None, 1), (None, 1), ("a", 2), ("a", 1), ("b", 5)], "k string, o int")
    out = J.first_per_key(d, "k", ["o"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    assert sorted(((r.k or ""), r.o) for r in out.collect()) == [("", 1), ("", 1), ("a", 1), ("b", 5)]


# -- text ---------------------------------------------------------------------


@pytest.mark.parametrize(("text", "score"), [
    ("good", 0.7), ("not good", -0.35), ("not a very good one", -0.455), ("not in any real way good", 0.7), ("very good", 0.91), ("extremely excellent", 1.0),
    ("not bad", 0.35), ("good, not bad", 0.525), ("never", 0.0), ("", 0.0), (None, 0.0), ("pas mauvais", 0.35), ("very not good", -0.455), ("good very", 0.7),
])
def test_polarity_in_reading_order(spark, text, score):
    d = spark.createDataFrame([(1, text)], "doc_id int, comment string")
    assert TX.polarity(d).first().polarity == pytest.approx(score)


def test_polarity_keeps_documents_apart(spark):
    d = spark.createDataFrame([("a", "good"), ("a", "bad"), ("a", None)], "doc_id string, comment string")
    assert sorted(r.polarity for r in TX.polarity(d).collect()) == [-0.7, 0.0, 0.7]
    own = spark.createDataFrame([("good", -1.0)], "token string, valence double")
    assert sorted(r.polarity for r in TX.polarity(d, lexicon=own).collect()) == [-1.0, 0.0, 0.0]


# -- stores and tables -----------------------------------------------------------


def test_known_keys_are_read_without_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = KnownKeys(spark, "known_test", ["a", "b"], buckets=8)
        assert ingest(spark.createDataFrame([("x", 1), ("x", 1), (None, 2)], "a string, b int"), store).count() == 3
        batch = spark.createDataFrame([("x", 1), ("y", 1), (None, 2)], "a string, b int")
        new = store.new_rows(batch)
        plan = new._jdf.queryExecution().executedPlan().toString()
        at = plan.index("FileScan parquet")
        assert "Bucketed: true" in plan
        above = [line for line in plan[:at].splitlines() if "Exchange" in line]
        assert len(above) == 1 and "LocalTableScan" in plan[:at] or "Scan ExistingRDD" in plan[:at]  # the batch's own
        assert sorted((r.a or "", r.b) for r in ingest(batch, store).collect()) == [("", 2), ("y", 1)]
        assert ingest(batch, store).count() == 1 and store.table().count() == 2
        store.compact()
        assert sorted(map(tuple, store.table().collect())) == [("x", 1), ("y", 1)] and ingest(batch, store).count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_replaced_table_is_found_by_name(spark):
    name = "replaced_test"
    for i in range(4):
        W.replace_table(spark.createDataFrame([(i, f"v{i}")], "n int, s string") if i < 2 else spark.createDataFrame([(i,)], "n int"), name)
        assert spark.newSession().table(name).first().n == i
    assert len(S._versions(spark, W.table_base(spark, name))[1]) == 2
    spark.sql(f"DROP TABLE {name}")
    assert W.named_table(spark, name).first().n == 3 and spark.table(name).columns == ["n"]
    with pytest.raises(ValueError):
        W.named_table(spark, "no_such_table")


def test_json_with_schema_keeps_corrupt_lines(spark):
    path = new_subdir(spark, "json-bad-schema")
    spark.createDataFrame([('{"a": 1}',), ("{not json",)], "value string").write.text(path)
    rows = RD.scan_json(spark, path, schema=spark.createDataFrame([], "a int").schema).collect()
    assert sorted((r.a or 0, r._corrupt_record or "") for r in rows) == [(0, "{not json"), (1, "")]
    assert RD.scan_json(spark, path, schema=spark.createDataFrame([], "a int").schema, corrupt=None).columns == ["a"]


# -- streams -----------------------------------------------------------------------


def test_a_batch_of_one_key_writes_one_bucket(spark):
    base = new_subdir(spark, "buckets")
    write = S.upsert_snapshot_batch(base, "k", "ts", buckets=16)
    write(spark.range(200).select(F.col("id").alias("k"), F.lit("2024-01-01 00:00:00").alias("ts"), F.lit("old").alias("v")), 0)
    before = S.bucket_paths(spark, base)
    one = spark.createDataFrame([(7, "2024-01-02 00:00:00", "new")], "k long, ts string, v string")
    write(one, 1)
    after = S.bucket_paths(spark, base)
    assert len(before) > 8 and sum(after[b] != before[b] for b in before) == 1
    rows = sorted((r.k, str(r.ts), r.v) for r in S.read_snapshot(spark, base).collect())
    assert len(rows) == 200 and [r for r in rows if r[2] == "new"] == [(7, rows[7][1], "new")]
    write(one, 1)  # replayed
    assert sorted((r.k, str(r.ts), r.v) for r in S.read_snapshot(spark, base).collect()) == rows


def test_window_state_falls_past_the_watermark(spark):
    src, out = new_subdir(spark, "win-src"), new_subdir(spark, "win-out")
    times = ["2024-01-01 00:01:00", "2024-01-01 00:02:00", "2024-01-01 06:00:00", "2024-01-01 12:00:00", "2024-01-02 12:00:00"]
    schema = "event_id long, ts timestamp, name string, value double"
    for i, t in enumerate(times):
        (spark.createDataFrame([(i, t, "e", 1.0)], "event_id long, ts string, name string, value double")
         .withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.run_available(S.tumbling_metrics(stream).writeStream.outputMode("update").foreachBatch(S.merge_windows(out)), new_subdir(spark, "win-ckpt"))
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) <= 3 and held[-1] <= 1
    batch = S.tumbling_metrics(spark.read.parquet(src))
    assert sorted(map(tuple, S.read_windows(spark, out).collect())) == sorted(map(tuple, batch.collect()))
    # a replayed batch changes nothing
    S.merge_windows(out)(batch, 99)
    assert S.read_windows(spark, out).count() == batch.count()
