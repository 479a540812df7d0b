"""Physical-plan properties the scale design relies on."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
Q = E.queries()


def plan(spark, name):
    return Q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def below_first_exchange(p: str) -> str:
    return p[p.index("Exchange"):] if "Exchange" in p else ""


def test_keep_last_combines_before_shuffle(spark):
    p = plan(spark, "dedupe_keep_last")
    below = below_first_exchange(p)
    assert "WindowGroupLimit" in below and "Partial" in below


def test_top_n_limits_before_shuffle(spark):
    p = plan(spark, "reviews_top_n")
    assert "WindowGroupLimit" in p and "Partial" in below_first_exchange(p)


def test_class_counts_aggregate_reviews_before_join(spark):
    p = plan(spark, "price_segmentation")
    # reviews are counted per asin (partial_count under an aggregate) before the product join; bands need no join
    assert "partial_count" in p and "NestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["extract_specs", "page_title", "config_extract", "asin_from_url", "facets_nested"])
def test_row_jobs_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_page_jobs_do_not_shuffle(spark):
    from comptoir.operators import extract as X
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for df in (X.extract_listing(pages), X.extract_reviews(pages), X.extract_facets(pages), X.config_extract_blocks(pages), X.next_pages(pages)):
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in p and "Python" not in p


def test_polarity_collapses_documents_map_side(spark):
    p = plan(spark, "polarity_score")
    assert "partial_collect_list" in below_first_exchange(p)


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, "token_counts")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "doc_id" in scan and "text" in scan and "lang" not in scan and "source" not in scan


def test_filter_pushed_to_scan(spark):
    p = plan(spark, "new_reviews")
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in p or "LessThan(l_shipdate" in p


def test_no_cartesian_products(spark):
    for name in Q:
        if name.startswith(("stream_", "metrics_tumbling", "sink", "scan_csv", "export", "list_objects",
                            "discover_files", "run_report", "ctas")):
            continue
        assert "CartesianProduct" not in plan(spark, name), name
