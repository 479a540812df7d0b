"""Operators: de-dup, incremental update, clean, listings, sentiment, histogram,
success rate, joins, plus properties of the scale-oriented rewrites."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from comptoir.operators import aggregates as A
from comptoir.operators import clean as C
from comptoir.operators import dedupe as DD
from comptoir.operators import joins as J
from comptoir.operators import metrics as M
from comptoir.operators import text as TX
from comptoir.operators.filters import is_blocked, ram_filter, validate_rows
from tests.conftest import rows


def test_keep_last_null_keys_collapse(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (None, "c", 2), (None, "d", 3)], "k int, v string, o int")
    assert rows(DD.dedupe_keep_last(df, "k", ["o"]), "k", "v") == [(None, "d"), (1, "b")]


def test_dedupe_idempotent(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    once = DD.dedupe_keep_last(df, "k", ["o"])
    assert rows(DD.dedupe_keep_last(once, "k", ["o"])) == rows(once)


def test_incremental_update_rules(spark):
    t = spark.createDataFrame([(1, "2024-01-02", "t"), (2, "2024-01-01", "t"), (3, "2024-01-01", "t")],
                              "product_id int, last_updated string, who string")
    s = spark.createDataFrame([(1, "2024-01-01", "s"), (2, "bad date", "s"), (3, "2024-01-01", "s"), (4, "x", "s")],
                              "product_id int, last_updated string, who string")
    out = {r.product_id: r.who for r in DD.incremental_update(t, s).collect()}
    assert out == {1: "t", 2: "t", 3: "s", 4: "s"}


def test_incremental_without_timestamp_prefers_source(spark):
    t = spark.createDataFrame([(1, "t")], "product_id int, who string")
    s = spark.createDataFrame([(1, "s")], "product_id int, who string")
    assert rows(DD.incremental_update(t, s, ts_col=None), "who") == [("s",)]


def test_merge_keyed_unique_and_upsert(spark):
    a = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "id int, v string, o int")
    b = spark.createDataFrame([(1, "z", 0)], "id int, v string, o int")
    m = DD.merge_tables([a, b], "id", ["o"])
    assert rows(m, "id", "v") == [(1, "z"), (2, "b")]
    assert rows(DD.upsert_by_key(a, b, ["o"]), "id", "v") == [(1, "z"), (2, "b")]
    nk = spark.createDataFrame([("q",)], "w string")
    assert DD.upsert_by_key(a.select("v"), nk.withColumnRenamed("w", "v")).count() == 3


def test_clean_table(spark):
    df = spark.createDataFrame([(" a", -1.0), ("a", 2.0), ("", None), ("", None), (None, None)],
                               "` My Col ` string, amount double")
    out = C.clean_table(df)
    assert out.columns == ["my_col", "amount"]
    assert rows(out) == [("a", None), ("a", 2.0)]


def test_listing_rules(spark):
    batch = spark.createDataFrame(
        [("A1", None, 1, 0), ("A1", "second", 1, 1), (None, "n1", 1, 2), (None, "n2", 1, 3), ("K", "known", 1, 4),
         ("A2", "first", 2, 0), ("A2", "again", 2, 1)], "asin string, titre string, page int, pos int")
    known = spark.createDataFrame([("K",)], "asin string")
    out = rows(J.new_listings(batch, known), "asin", "titre")
    # null title dropped and its ASIN not registered -> the later A1 row is first
    assert out == [(None, "n1"), (None, "n2"), ("A1", "second"), ("A2", "first")]


def test_anti_semi_partition_input(spark):
    df = spark.range(100).select((F.col("id") % 13).alias("k"), "id")
    keys = spark.range(0, 13, 2).select(F.col("id").alias("k"))
    anti, semi = J.anti_join(df, keys, "k"), J.semi_filter(df, keys, "k")
    assert sorted(rows(anti.unionByName(semi))) == sorted(rows(df))


def test_range_join_equals_a_plain_one(spark):
    df = spark.range(0, 3000, 7).select(F.col("id").cast("double").alias("x"))
    bands = spark.createDataFrame([("a", 0.0, 500.0), ("b", 500.01, 1500.0), ("c", 1500.01, 2800.0)],
                                  "classe string, lo double, hi double")
    small = J.range_join(df, F.col("x"), bands, "lo", "hi")
    big = df.join(bands, F.col("x").between(F.col("lo"), F.col("hi")), "left")
    assert rows(small, "x", "classe") == rows(big, "x", "classe")


def test_bands_partition_integers(spark):
    from comptoir.functions.price import price_bands
    ints = spark.range(0, 1_000_001, 997).select(F.col("id").cast("double").alias("v"))
    out = J.range_join(ints, F.col("v"), price_bands(spark), "prix_min", "prix_max")
    assert out.count() == ints.count()
    assert out.filter(F.col("classe").isNull()).count() == 0


def test_sentiment_thresholds(spark):
    df = spark.createDataFrame([(0.1,), (0.1001,), (-0.1,), (-0.2,), (None,)], "p double")
    assert [r[0] for r in df.select(TX.classify("p")).collect()] == [
        "Neutral", "Positive", "Neutral", "Negative", "Neutral"]


def test_polarity_null_comment_is_neutral(spark):
    docs = spark.createDataFrame([(1, None), (2, "good good bad"), (3, "")], "doc_id int, comment string")
    out = {r.doc_id: (round(r.polarity, 6), r.sentiment) for r in TX.classify_sentiment(docs, keep=("doc_id",)).collect()}
    assert out == {1: (0.0, "Neutral"), 2: (0.233333, "Positive"), 3: (0.0, "Neutral")}


def test_tokens_and_top(spark):
    docs = spark.createDataFrame([(1, "Le chat et le Chien"), (2, "chat, chat!")], "doc_id int, comment string")
    toks = TX.tokens_clean(docs)
    assert rows(toks, "doc_id", "token") == [(1, "chat"), (1, "chien"), (2, "chat"), (2, "chat")]
    assert [tuple(r) for r in TX.top_tokens(toks, 1).collect()] == [("chat", 3, 1.0)]


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (10.0,)], "x double")
    h = {r.bin: r["count"] for r in A.histogram(df, "x", 5).collect()}
    assert h == {1: 2, 2: 0, 3: 0, 4: 0, 5: 2}
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r.bin, r["count"]) for r in A.histogram(const, "x", 20).collect()] == [(1, 2)]


def test_histogram_weighted_sum(spark):
    df = spark.range(1, 50).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3 + 1).alias("w"))
    h = A.histogram(df, "x", 7, "w")
    assert h.agg(F.sum("count")).first()[0] == df.agg(F.sum("w")).first()[0]


def test_success_rate(spark):
    log = spark.createDataFrame([("error",)] * 3 + [("duration",)] * 197, "kind string")
    assert M.success_rate(log).first().success_rate == 98.5
    empty = spark.createDataFrame([], "kind string")
    assert M.success_rate(empty).first().success_rate == 0.0


def test_rolling_blocks_equal_plain_window(spark):
    n = 5
    log = spark.range(0, 137).select(
        F.col("id").alias("event_id"), F.lit("duration").alias("kind"),
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("category"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 17)).alias("ts"),
        (F.col("id") * 1.5 % 11).alias("value"))
    got = M.rolling_last_n(log, n).select("event_id", "rolling_sum", "rolling_min", "rolling_max", "rolling_n")
    w = Window.partitionBy("category").orderBy("ts", "event_id").rowsBetween(-(n - 1), 0)
    exp = log.select("event_id", F.round(F.sum("value").over(w), 6).alias("rolling_sum"), F.min("value").over(w),
                     F.max("value").over(w), F.count(F.lit(1)).over(w))
    assert rows(got) == rows(exp)


def test_blocked_predicate(spark):
    df = spark.createDataFrame([("<p>Robot Check</p>", 200, 0), ("captcha here", 200, 0), ("captcha", 503, 0),
                                ("fine", 200, 3), ("fine", 200, 1)], "h string, s int, r int")
    got = [r[0] for r in df.select(is_blocked("h", "s", "r")).collect()]
    assert got == [True, True, False, True, False]


def test_validate_and_ram(spark):
    df = spark.createDataFrame([("t", 5.0), (None, 0.0), ("t", None)], "title string, price double")
    got = [r.violations for r in validate_rows(df).collect()]
    assert got == [[], ["missing_title", "price_out_of_range"], ["missing_price"]]
    d = spark.createDataFrame([("8",), ("16",), ("x",)], "RAM string")
    assert ram_filter(d, "Exacte", ram_exact=8).count() == 1
    assert ram_filter(d, "Intervalle", 4, 64).count() == 2
    assert ram_filter(d.withColumnRenamed("RAM", "other"), "Exacte").count() == 3


def test_weighted_dashboard_equals_materialised_fanout(spark):
    """The (product, sentiment, n_rows) frame aggregates exactly like the n x n rows."""
    from comptoir.fixtures import fx
    from comptoir.functions.price import parse_price
    from comptoir.plans import dashboard as D
    sf = "/root/testdata/sf0.001"
    p1, p2, r = (fx(spark, sf, n) for n in ("fx_product_info1", "fx_product_info2", "fx_reviews"))
    dash = D.dashboard_load(p1, p2, r)
    base = D.product_table(p1, p2).select(
        F.col("asin").alias("ASIN"), F.col("manufacturer").alias("MANUFACTURER"),
        F.regexp_extract("note", r"(\d\.\d) out", 1).try_cast("double").alias("NOTE"),
        parse_price("prix").alias("PRIX"))
    full = base.join(r.select(F.col("asin").alias("ASIN")), "ASIN").join(
        r.select(F.col("asin").alias("ASIN"), "sentiment"), "ASIN", "left").filter(F.col("NOTE").isNotNull() & F.col("PRIX").isNotNull())
    pd_full = full.toPandas()
    exp = pd_full.groupby("sentiment").size().to_dict()
    got = {x["Sentiment"]: x["Count"] for x in D.sentiment_counts(dash).collect()}
    assert got == exp
    m_exp = pd_full.dropna(subset=["MANUFACTURER"]).groupby("MANUFACTURER")["NOTE"].mean().round(6)
    m_got = {x.MANUFACTURER: x.NOTE for x in A.mean_by(dash, "MANUFACTURER", "NOTE", "n_rows").collect()}
    assert all(abs(m_got[k] - v) < 1e-6 for k, v in m_exp.items()) and len(m_got) == len(m_exp)


def test_value_counts_null_label(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    assert [tuple(r) for r in A.value_counts(df, "c").collect()] == [("a", 2)]
    assert rows(A.value_counts(df, "c", null_label="nan")) == [("a", 2), ("nan", 1)]


def test_missing_column_errors(spark):
    import pytest
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        DD.dedupe_keep_last(df, "b", ["a"])
    with pytest.raises(ValueError):
        C.rename_cols(df, {"zz": "y"})


def test_tokens_with_lemma_table(spark):
    docs = spark.createDataFrame([(1, "Les chats mangent vite")], "doc_id int, comment string")
    lemmas = spark.createDataFrame([("chats", "chat", "NOUN"), ("mangent", "manger", "VERB"), ("vite", "vite", "ADV")],
                                   "form string, lemma string, pos string")
    out = TX.tokens_clean(docs, lemmas=lemmas)
    assert rows(out, "token") == [("chat",), ("manger",)]


def test_clean_compat_nan_text(spark):
    df = spark.createDataFrame([(None, 1), ("", 2)], "s string, n int")
    out = rows(C.clean_table(df, compat_nan_text=True))
    assert out == [("", 2), ("nan", 1)]


def test_text_column_gate(spark):
    import pytest
    docs = spark.createDataFrame([(1, "x")], "doc_id int, body string")
    with pytest.raises(ValueError):
        TX.tokens_clean(docs)
    with pytest.raises(ValueError):
        TX.polarity(docs)


def test_review_ingest_cut_after_anti_join(spark):
    from comptoir.plans.ingest import review_ingest
    block = ('<div data-hook="review"><a class="a-profile"><span class="a-profile-name">{}</span></a>'
             '<span data-hook="review-body">c</span></div>')
    html = "".join(block.format(n) for n in ["old", "a", "b", "a"])
    pages = spark.createDataFrame([(1, "https://x/dp/B000000001/", html)], "page_id long, url string, html string")
    known = spark.createDataFrame([("B000000001", "old")], "asin string, reviewer string")
    got = [(r.pos, r.reviewer) for r in review_ingest(pages, known, max_reviews=2).orderBy("pos").collect()]
    assert got == [(1, "a"), (2, "b")]


def test_fix_processor_exact_case_insensitive(spark):
    from comptoir.plans.segmentation import fix_processor
    df = spark.createDataFrame([("aURES",), ("Aures",), ("xAures",), ("Aures ",), (None,)], "p string")
    assert [r[0] for r in df.select(fix_processor("p")).collect()] == ["Autres", "Autres", "xAures", "Aures ", None]


def test_median_exact_and_approx(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert A.numeric_stats(df, "x").first().median == 2.5
    assert A.numeric_stats(df, "x", exact_median=False).first().median == 2.0


def test_recommend_order_nulls_last(spark):
    from comptoir.plans.dashboard import recommend
    dash = spark.createDataFrame(
        [("a", "M", "t", None, "8", None, 4.5, "Bas", "Neutral", 1), ("b", "M", "t", None, "8", 10.0, 4.5, "Bas", "Neutral", 1),
         ("c", "M", "t", None, "8", 5.0, 4.8, "Bas", "Neutral", 1), ("d", "M", "t", None, "8", 1.0, 3.9, "Bas", "Neutral", 1)],
        "ASIN string, MANUFACTURER string, TITRE string, URL_INFO1 string, RAM string, PRIX double, NOTE double, "
        "CLASSE string, sentiment string, n_rows long")
    assert [r.ASIN for r in recommend(dash).collect()] == ["c", "b", "a"]
