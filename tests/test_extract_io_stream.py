"""Extraction on the inline pages of FIXTURES.md section 4, sources/sinks, streams."""

from pyspark.sql import functions as F

from comptoir.operators import extract as X
from comptoir.operators.joins import anti_join
from comptoir.session import new_subdir
from comptoir.sources import readers as RD
from comptoir.sources import writers as W
from comptoir.streaming import jobs as S
from tests.conftest import rows

FACET_PAGE = (
    '<div class="a-section"><span class="a-size-base a-color-base puis-bold-weight-text">Brand</span></div>\n'
    '<ul class="a-unordered-list"><span class="a-list-item"><a class="a-link-normal s-navigation-item" '
    'href="/s?rh=n%3A429886031%2Cp_89%3AAcme&x=1"><span class="a-size-base a-color-base">Acme</span></a></span>\n'
    '<span class="a-list-item"><a class="a-link-normal s-navigation-item" href="/s?k=z">'
    '<span class="a-size-base a-color-base">Other</span></a></span></ul>\n'
    '<div class="a-section"><span class="a-size-base a-color-base puis-bold-weight-text">Empty</span></div>')

REVIEW_PAGE = (
    '<div data-hook="review"><a class="a-profile"><span class="a-profile-name"> Ann </span></a>'
    '<i data-hook="review-star-rating">4.0 out of 5 stars</i>\n<a data-hook="review-title">Good</a>'
    '<span data-hook="review-date">Reviewed in the United Kingdom on 3 May 2024</span><span data-hook="avp-badge">Verified</span>\n'
    '<span data-hook="review-body"> Fast laptop </span><span data-hook="helpful-vote-statement">12 people found this helpful</span></div>\n'
    '<div data-hook="review"><i class="a-star-2"></i><span data-hook="review-date">3 May</span></div>')


def test_facet_page(spark):
    pages = spark.createDataFrame([(1, FACET_PAGE)], "page_id long, html string")
    got = rows(X.extract_facets(pages), "category_name", "name", "url", "filter_key", "filter_value")
    assert got == [("Brand", "Acme", "https://shop.example/s?rh=n%3A429886031%2Cp_89%3AAcme&x=1", "p_89", "Acme"),
                   ("Brand", "Other", "https://shop.example/s?k=z", None, None)]
    nested = X.facets_nested(X.extract_facets(pages))
    assert rows(X.facets_flatten(nested), "category_name", "name") == [("Brand", "Acme"), ("Brand", "Other")]


def test_review_page_and_known_reviewers(spark):
    pages = spark.createDataFrame([(1, "https://x/dp/B000000001/", REVIEW_PAGE)], "page_id long, url string, html string")
    got = X.extract_reviews(pages).orderBy("pos").collect()
    assert [tuple(r)[3:] for r in got] == [
        ("Ann", 4.0, "Good", "3 May 2024", "the United Kingdom", True, "Fast laptop", 12),
        ("Anonyme", 2.0, "Sans titre", "3 May", "Unknown", False, "Aucun commentaire disponible", 0)]
    known = spark.createDataFrame([("B000000001", "Ann")], "asin string, reviewer string")
    assert rows(anti_join(X.extract_reviews(pages), known, ["asin", "reviewer"]), "reviewer") == [("Anonyme",)]


def test_listing_sentinels_and_max_page(spark):
    html = ('<div class="s-result-item" data-component-type="s-search-result"><span>x</span></div>'
            '<span class="s-pagination-item" aria-disabled="true">7</span>'
            '<span class="s-pagination-item" aria-disabled="true">...</span>')
    pages = spark.createDataFrame([(3, html), (4, "<p>none</p>")], "page_id long, html string")
    out = X.extract_listing(pages, sentinels=True).first()
    assert (out.titre, out.prix, out.asin) == ("Titre non disponible", "Prix non disponible", "ASIN non disponible")
    assert rows(pages.select("page_id", X.max_page("html"))) == [(3, 7), (4, 1)]


def test_spec_table_last_header_wins(spark):
    html = ('<table id="productDetails_techSpec_section_1"><tr><th>A</th><td>1</td></tr>'
            '<tr><th>A</th><td>2</td></tr><tr><td>orphan</td></tr></table>')
    pages = spark.createDataFrame([(1, "https://x/dp/B000000009/", html)], "page_id long, url string, html string")
    assert pages.select(X.spec_map("html")).first()[0] == {"A": "2"}
    specs = X.extract_specs(pages)
    assert rows(X.spec_pivot(specs, ["A"]), "asin", "A") == [("B000000009", "2")]


def test_csv_missing_path_gives_default(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("asin", T.StringType())])
    df = RD.scan_csv_infer(spark, new_subdir(spark, "missing"), default_schema=schema)
    assert df.count() == 0 and df.columns == ["asin"]


def test_json_corrupt_records_kept_aside(spark):
    path = new_subdir(spark, "json-bad")
    spark.createDataFrame([('{"a": 1}',), ("{not json",)], "value string").write.text(path)
    df = RD.scan_json(spark, path).cache()
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 1
    assert df.filter(F.col("a") == 1).count() == 1


def test_sink_append_by_name(spark):
    path = new_subdir(spark, "append")
    W.sink_append(spark.createDataFrame([("x", None)], "a string, b string"), path, ["a", "b", "c"])
    W.sink_append(spark.createDataFrame([("y",)], "c string"), path, ["a", "b", "c"])
    back = spark.read.option("header", True).csv(path).na.fill("")
    assert rows(back) == [("", "", "y"), ("x", "", "")]


def test_stream_append_emits_only_closed_windows(spark):
    log = spark.createDataFrame(
        [(1, "2024-01-01 00:01:00", "e", 1.0), (2, "2024-01-01 00:06:00", "e", 1.0),
         (3, "2024-01-01 00:31:00", "e", 1.0)], "event_id long, ts string, name string, value double"
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    src = new_subdir(spark, "stream-append-src")
    log.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(log.schema).parquet(src)
    out = new_subdir(spark, "stream-append-out")
    S.run_available(S.tumbling_metrics(stream).writeStream.outputMode("append").format("parquet").option("path", out),
                    new_subdir(spark, "stream-append-ckpt"))
    # watermark = 00:31 - 10 min: windows ending by 00:21 are closed; 00:30 window still open
    starts = sorted(str(r[0]) for r in spark.read.parquet(out).select("window_start").collect())
    assert starts == ["2024-01-01 00:00:00", "2024-01-01 00:05:00"]


def test_stream_dedupe_matches_batch(spark):
    df = spark.range(0, 500).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    src = new_subdir(spark, "dedupe-src")
    df.repartition(5).write.parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = new_subdir(spark, "dedupe-out")
    S.run_available(S.dedupe_stream(stream, ["k"]).writeStream.format("parquet").option("path", out),
                    new_subdir(spark, "dedupe-ckpt"))
    assert spark.read.parquet(out).select("k").distinct().count() == 37
    assert spark.read.parquet(out).count() == 37


def test_stream_dedupe_within_watermark(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00"),
         ("a", "2024-01-01 05:00:00")], "k string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    src = new_subdir(spark, "dww-src")
    df.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out = new_subdir(spark, "dww-out")
    S.run_available(S.dedupe_stream(stream, ["k"], "ts", "10 minutes").writeStream.format("parquet")
                    .option("path", out), new_subdir(spark, "dww-ckpt"))
    # one batch: duplicates of 'a' inside the batch collapse; the state would expire after the watermark
    assert rows(spark.read.parquet(out), "k") == [("a",), ("b",)]


def test_window_alerts_append_mode(spark):
    hour = [(i, "2024-01-01 00:%02d:00" % (i % 60), "error" if i < 10 else "duration") for i in range(120)]
    late = [(1000, "2024-01-01 05:00:00", "duration")]
    df = spark.createDataFrame(hour + late, "event_id long, ts string, kind string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    src = new_subdir(spark, "alerts-src")
    df.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out = new_subdir(spark, "alerts-out")
    S.run_available(S.window_alerts(stream).writeStream.outputMode("append").format("parquet").option("path", out),
                    new_subdir(spark, "alerts-ckpt"))
    got = [(str(r.window_start), r.requests, r.errors, r.alerts) for r in spark.read.parquet(out).collect()]
    # 00:00 window closed by the 05:00 event's watermark: 10/120 errors -> error_rate alert
    assert got == [("2024-01-01 00:00:00", 120, 10, "error_rate")]


def test_file_order_survives_many_splits(spark):
    """Keep-last in file order is exact even when files are cut into many small splits."""
    from comptoir.operators.dedupe import dedupe_keep_last
    n = 5000
    df = spark.range(n).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    path = new_subdir(spark, "order-csv")
    df.orderBy("v").write.option("header", True).csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        scan = RD.with_file_order(spark.read.schema("k long, v long").option("header", True).csv(path))
        assert scan.rdd.getNumPartitions() > 10
        got = rows(dedupe_keep_last(scan, "k", list(RD.FILE_ORDER)), "k", "v")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == [(k, max(v for v in range(n) if v % 97 == k)) for k in range(97)]


def test_scan_pages_one_page_per_file(spark):
    path = new_subdir(spark, "html-files")
    html = ["<html><title>a</title>\n<h1>x</h1></html>", "<html><title>b</title></html>", "<p>c</p>"]
    spark.createDataFrame([(h,) for h in html], "value string").repartition(3).write.text(path)
    pages = RD.scan_pages(spark, path, fmt="text")
    got = sorted(r.html.rstrip("\n") for r in pages.collect())
    assert got == sorted(html)
    assert pages.select("page_id").distinct().count() == 3
    titles = sorted(r.title for r in X.page_fields(pages).collect() if r.title)
    assert titles == ["a", "b"]


def test_snapshot_versions_are_pruned(spark):
    df = spark.range(0, 400).select((F.col("id") % 50).alias("product_id"),
                                    F.timestamp_seconds(F.col("id") * 60).alias("last_updated"), F.col("id").alias("v"))
    src = new_subdir(spark, "snap-src")
    df.repartition(6).write.parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    base = new_subdir(spark, "snap")
    S.run_available(stream.writeStream.foreachBatch(S.upsert_snapshot_batch(base, "product_id", "last_updated", ["v"])),
                    new_subdir(spark, "snap-ckpt"))
    newest = S.bucket_paths(spark, base)
    kept = [f for _, v in S._versions(spark, base)[1] for f in S._fs(spark, base)[0].listStatus(v) if S.BUCKET in f.getPath().getName()]
    assert len(newest) <= len(kept) <= 2 * len(newest)
    snap = S.read_snapshot(spark, base).drop(S.BUCKET)
    assert rows(snap, "product_id", "v") == rows(df.groupBy("product_id").agg(F.max("v").alias("v")))


def test_extraction_on_other_markup(spark):
    """Attribute order, extra classes, wrappers, nested spans, line breaks, entities and a widget after the last block."""
    from comptoir.operators import extract as X
    review = ('<div id="r1" data-hook="review" class="x"><a href="/p" class="a-profile"><div class="w"><span class="a-profile-name big"> Ann </span></div></a>'
              '<a href="/t" data-hook="review-title"><span>Good</span></a><span data-hook="review-date">Reviewed in <span>France</span> on 3 May 2024</span>'
              '<span data-hook="review-body"><span>first half</span><br/><span>second half</span></span></div>'
              '<span data-hook="helpful-vote-statement">9 people</span>')
    r = X.extract_reviews(spark.createDataFrame([("p", "https://shop.example/dp/B000000001/", review)], "page_id string, url string, html string")).collect()
    assert [(x.reviewer, x.title, x.comment, x.location, x.date, x.helpful_count) for x in r] == [
        ("Ann", "Good", "first halfsecond half", "France", "3 May 2024", 0)]
    span = X.extract_reviews(spark.createDataFrame([("p", "u", '<div data-hook="review"><span data-hook="review-title">x</span></div>')],
                                                   "page_id string, url string, html string")).first()
    assert span.title == "Sans titre"
    listing = ('<div data-asin="" class="a" data-component-type="s-search-result"><div><a href="/dp/B000000009/?a=1&amp;b=2" class="z a-link-normal">'
               '<span class="a-size-base-plus a-color-base a-text-normal">T</span></a></div></div>'
               '<div><span class="a-price"><span class="a-offscreen">&pound;99.00</span></span></div>'
               '<span aria-disabled="true" class="s-pagination-item s-pagination-disabled">20</span>')
    pages = spark.createDataFrame([(1, listing)], "page_id int, html string")
    x = X.extract_listing(pages, host="shop.example").first()
    assert (x.titre, x.url, x.prix, x.asin) == ("T", "https://shop.example/dp/B000000009/?a=1&b=2", None, None)
    assert pages.select(X.max_page("html")).first()[0] == 20
    facets = "".join(f'<span class="a-size-base a-color-base puis-bold-weight-text">S</span><ul class="a-unordered-list"><span class="a-list-item">'
                     f'<a href="/s?rh=p_{k}%3A1" class="a-link-normal s-navigation-item">\n<span class="a-size-base a-color-base">v{k}</span></a></span></ul>' for k in (1, 2))
    flat = X.extract_facets(spark.createDataFrame([(1, facets)], "page_id int, html string"), host="shop.example")
    assert flat.count() == 2
    nested = X.facets_nested(flat).first().filters
    assert [v.name for v in nested["S"]] == ["v2"]


def test_csv_round_trip_keeps_quotes_padding_and_line_breaks(spark, tmp_path):
    from comptoir.sources import readers, writers
    data = [('a "q", b', "  pad "), ("x\ny", "\\"), (",", '"')]
    df = spark.createDataFrame(data, "a string, b string")
    path = writers.sink_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, readers.scan_csv_schema(spark, path, df.schema, multi_line=True).collect())) == sorted(data)
    one = writers.sink_csv(df.filter("a not like '%\n%'"), str(tmp_path / "u"))
    assert sorted(map(tuple, readers.scan_csv_schema(spark, one, df.schema).collect())) == sorted([data[0], data[2]])


def test_snapshot_goes_on_after_a_new_checkpoint(spark, tmp_path):
    from comptoir.streaming import jobs
    base = str(tmp_path / "snap")
    rows = [spark.createDataFrame([(k, k)], "k int, ts int") for k in range(1, 5)]
    for batch_id, batch in [(5, rows[0]), (6, rows[1]), (0, rows[2]), (0, rows[2]), (1, rows[3])]:
        jobs.upsert_snapshot_batch(base, "k", "ts")(batch, batch_id)
    assert sorted(r.k for r in jobs.read_snapshot(spark, base).collect()) == [1, 2, 3, 4]


def test_part_files_are_ordered_by_number(spark, tmp_path):
    import pathlib
    from comptoir.operators.dedupe import dedupe_keep_last
    from comptoir.sources import readers
    for n, v in (("part-99999-x.csv", "old"), ("part-100000-x.csv", "new")):
        pathlib.Path(tmp_path, n).write_text(f"k,v\n1,{v}\n")
    scan = readers.with_file_order(spark.read.option("header", True).csv(str(tmp_path)))
    assert dedupe_keep_last(scan, "k", list(readers.FILE_ORDER)).first().v == "new"


def test_metrics_with_gauges_and_missing_categories(spark):
    from comptoir.operators import metrics as M
    log = spark.createDataFrame([("error", None), ("error", "a"), ("duration", None), ("gauge", "a")], "kind string, category string")
    assert M.success_rate(log).first().asDict() == {"requests": 3, "errors": 2, "success_rate": 33.33}
    assert sorted(((r.error_type or ""), r.n) for r in M.error_counts(log).collect()) == [("", 1), ("a", 1), ("total", 2)]
    one = spark.createDataFrame([(1, "2024-01-01 00:00:00", "duration", None, 2.0)], "event_id int, ts string, kind string, category string, value double")
    assert M.rolling_last_n(one.withColumn("ts", F.col("ts").cast("timestamp"))).count() == 1
