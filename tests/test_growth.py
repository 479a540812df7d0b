"""Work and memory that must not grow faster than the input: expressions written out once, tasks of bounded size."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from comptoir import fixtures
from comptoir.functions.text import clean_spec_text
from comptoir.functions.url import facet_filter
from comptoir.operators import extract as X
from comptoir.operators import markup as M
from comptoir.session import prepare
from comptoir.sources import writers as W
from comptoir.suite import streams
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


# a page's canonical form is made where its comments are dropped
@pytest.mark.parametrize("name", ["facets_flat", "facets_nested", "extract_facets", "extract_specs", "spec_map", "spec_pivot",
                                  "extract_reviews", "review_ingest", "extract_listing", "listing_ingest"])
def test_pages_are_made_canonical_once(spark, name):
    made = optimized(E.queries()[name](spark, SF)).count(f"{M.COMMENT}|")
    assert made == (2 if name == "spec_map" else 1)  # its projection is made on both sides of a union


def test_keys_of_extracted_reviews_are_not_written_out(spark):
    # Spark's rules look for a scan below the keys of a join: each projection passed writes their expressions out once more
    df = E.queries()["review_ingest"](spark, SF)
    qe = df._jdf.queryExecution()
    qe.optimizedPlan()
    spent = {}
    for name in ("dynamicpruning.PartitionPruning", "dynamicpruning.CleanupDynamicPruningFilters"):
        rule = qe.tracker().rules().get(f"org.apache.spark.sql.execution.{name}")
        spent[name] = rule.get().totalTimeNs() / 1e9 if rule.isDefined() else 0
    assert max(spent.values()) < 2, spent


def test_methods_of_extract_reviews_can_be_compiled(spark):
    # the JVM never compiles a method of more than 8,000 bytes; its rows would be worked on by the interpreter
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = E.queries()["extract_reviews"](spark, SF)
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # the query turned it on
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        prepare(spark)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) > 2 and max(sizes) < 8000, sizes


def test_titles_are_found_once_under_a_filter(spark):
    pattern = M.selector(X.LISTING_TITLE)[0].pattern
    pages = spark.createDataFrame([(1, "<p>")], "page_id int, html string")
    listing = X.extract_listing(pages)
    assert optimized(listing.filter("titre IS NOT NULL")).count(pattern) == optimized(listing).count(pattern)


def test_values_used_twice_are_written_once(spark):
    df = spark.createDataFrame([("  ‎a\n b ", "https://x/s?rh=n%3A429886031%2Cp_89%3AAcme%2Cp_n_1%3A2&dc"), (None, None)], "t string, u string")
    slow = F.concat(F.col("t"), F.lit("")).alias("slow")
    assert optimized(df.select(clean_spec_text(slow).alias("x"))).count("concat(") <= 1
    got = df.select(clean_spec_text("t").alias("t"), facet_filter("u").alias("f")).collect()
    assert [(r.t, tuple(r.f)) for r in got] == [("a b", ("p_89", "Acme")), (None, (None, None))]
    assert optimized(df.select(facet_filter("u").alias("x"))).count("rh=") <= 3  # once in the test, twice in the cut


def test_blocks_of_pages_without_any(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x</p>")], "page_id int, html string")
    for df in (X.extract_listing(pages), X.extract_facets(pages), X.page_links(pages), X.config_extract_blocks(pages),
               X.extract_reviews(pages, asin=F.lit("a")), X.facets_flatten(X.facets_document(pages))):
        assert df.count() == 0


def test_large_tables_are_dealt_over_all_tasks(spark):
    few, many = (spark.range(0, n, 1, 1).select(F.col("id").alias("p_partkey")) for n in (100, fixtures.DEAL_FROM + 1))
    assert fixtures.dealt(few).rdd.getNumPartitions() == 1
    out = fixtures.dealt(many)
    sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) > 4 and max(sizes) < many.count() / 4
    assert out.agg(F.sum("p_partkey"), F.count("*")).first() == many.agg(F.sum("p_partkey"), F.count("*")).first()


def test_tasks_become_more_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_ROWS", 500)
    assert fixtures.dealt(spark.range(0, fixtures.DEAL_FROM, 1, 1)).rdd.getNumPartitions() == 20


def test_tasks_read_bounded_splits(spark, tmp_path):
    prepare(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_slices_are_not_gathered_in_one_task(spark, monkeypatch):
    folders = []
    monkeypatch.setattr(streams.W, "scratch_path", lambda s, name, old=W.scratch_path: folders.append(old(s, name)) or folders[-1])
    out = W.scratch_path(spark, "growth-out")
    df = spark.range(0, 4000).repartition(3, "id").select("id", F.timestamp_seconds("id").alias("ts"))
    streams._by_time(spark, df, "growth", lambda s: s.writeStream.format("parquet").option("path", out))
    source = next(f for f in folders if "stream-src" in f)
    assert sum(f.endswith(".parquet") for f in os.listdir(source.removeprefix("file:"))) > 4
    assert rows(spark.read.parquet(out)) == rows(df)
