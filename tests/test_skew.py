"""Hot keys: one product holds a third of all reviews."""

from pyspark.sql import functions as F

from comptoir.operators import dedupe as DD
from comptoir.operators import joins as J
from comptoir.plans.segmentation import segment_class_counts
from tests.conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def skewed_reviews(spark, n=30000):
    r = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("B000000001"))
         .otherwise(F.concat(F.lit("B"), F.lpad((F.col("id") % 997 + 2).cast("string"), 9, "0"))).alias("asin"),
        F.concat(F.lit("user"), (F.col("id") % 101).cast("string")).alias("reviewer"),
        F.col("id").alias("ord"))
    return r


def with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_skewed_join_is_split_and_correct(spark):
    reviews = skewed_reviews(spark)
    products = spark.range(1, 1000).select(
        F.concat(F.lit("B"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("asin"),
        (F.col("id") * 3).cast("string").alias("titre"))

    def run():
        df = products.join(reviews, "asin")
        n = len(df.collect())  # runs this query's own adaptive plan to its final form
        final = df._jdf.queryExecution().executedPlan().toString()
        return n, final
    n, final = with_conf(spark, SKEW_CONF, run)
    assert n == 30000
    assert "isFinalPlan=true" in final and "SortMergeJoin" in final
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final


def test_hot_key_keep_last_and_first(spark):
    reviews = skewed_reviews(spark)
    got = rows(DD.dedupe_keep_last(reviews, ["asin", "reviewer"], ["ord"]), "asin", "reviewer", "ord")
    pdf = reviews.toPandas().sort_values("ord").drop_duplicates(["asin", "reviewer"], keep="last")
    assert got == sorted(map(tuple, pdf[["asin", "reviewer", "ord"]].values.tolist()),
                         key=lambda t: tuple((x is not None, str(x)) for x in t))
    first = J.first_per_key(reviews, "asin", ["ord"])
    assert first.filter(F.col("asin") == "B000000001").first().ord == 0


def test_hot_key_class_counts(spark):
    reviews = skewed_reviews(spark).withColumn("sentiment", F.lit("Neutral"))
    ids = spark.range(1, 1000)
    p1 = ids.select(F.concat(F.lit("B"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("asin"))
    p2 = ids.select(F.concat(F.lit("B"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("asin"),
                    F.concat(F.lit("£"), (F.col("id") * 3).cast("string"), F.lit(".00")).alias("prix"))
    got = dict(with_conf(spark, SKEW_CONF, lambda: [tuple(r) for r in segment_class_counts(p1, p2, reviews).collect()]))
    joined = p2.join(reviews, "asin").withColumn("v", F.regexp_replace("prix", "[£]", "").cast("double"))
    exp = {"Bas": joined.filter("v <= 500").count(), "Moyen": joined.filter("v > 500 AND v <= 1500").count(),
           "Élevé": joined.filter("v > 1500").count()}
    assert got == exp
