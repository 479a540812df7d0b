"""Sinks (SNK-*): CSV overwrite/append, JSON export, object-store style keyed
export, replace-table, text report. All go through Spark's commit protocol
(task outputs are promoted only on job commit), which replaces the
reference's file locks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_subdir, shared_dir
from .readers import CSV_OPTIONS


def sink_csv(df: DataFrame, path: str) -> str:
    """Overwrite with header, UTF-8; quotes doubled, padding kept."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def sink_append(df: DataFrame, path: str, columns) -> str:
    """Append a fixed column list by name; missing columns and NULLs become ''."""
    cols = list(columns)
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns
                      else F.lit("").alias(c) for c in cols])
    out.write.mode("append").options(**CSV_OPTIONS).csv(path)
    return path


def export_json(df: DataFrame, path: str) -> str:
    """JSON Lines export (one object per row; parallel write)."""
    df.write.mode("overwrite").json(path)
    return path


def export_json_document(doc: DataFrame, path: str) -> str:
    """One JSON object per document row (nested structs and maps kept), e.g. the run
    statistics document or one facets document per category page."""
    doc.write.mode("overwrite").json(path)
    return path


def export_partitioned(df: DataFrame, path: str, partition_by, fmt: str = "parquet") -> str:
    """Keyed export (object-store layout ``key=value/part-*``).

    Rows are clustered by the partition keys so each task writes few files.
    The ``rebalance`` hint (not ``repartition``) lets AQE split a hot key's
    partition into several tasks instead of one task writing a third of the data.
    """
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    (df.hint("rebalance", *keys)
     .write.mode("overwrite").partitionBy(*keys).format(fmt).save(path))
    return path


def table_base(spark, name: str) -> str:
    return f"{shared_dir(spark)}/tables/{name}"


def replace_table(df: DataFrame, name: str, keep_versions: int = 2) -> DataFrame:
    """CREATE OR REPLACE TABLE: the rows are written as the next version ``v=<n>`` of the table's folder below
    the shared folder; once it is committed, ``name`` in the session catalog points at it. Until then, and for a
    reader that has begun, the version before stays; older ones than ``keep_versions`` are removed."""
    from ..streaming.jobs import next_version, prune_versions
    spark = df.sparkSession
    base = table_base(spark, name)
    path = next_version(spark, base)
    df.write.mode("overwrite").parquet(path)
    return _point(spark, name, path, prune=lambda: prune_versions(spark, base, keep_versions))


def _point(spark, name: str, path: str, prune=None) -> DataFrame:
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE `{name}`")  # an external table: its files stay
    spark.catalog.createTable(name, path=path, source="parquet")
    if prune:
        prune()
    return spark.table(name)


def named_table(spark, name: str) -> DataFrame:
    """A table by name, in its newest committed version; from the folder if this catalog doesn't know it yet."""
    from ..streaming.jobs import latest_version
    path = latest_version(spark, table_base(spark, name))
    if path is None:
        raise ValueError(f"no table {name!r}")
    return _point(spark, name, path)


def write_report(report: DataFrame, path: str) -> str:
    """Text report: one line per (section, metric, value) row, in one file (a few dozen rows)."""
    (report.select(F.concat_ws(": ", F.concat_ws(".", "section", "metric"),
                               F.coalesce(F.col("value").cast("string"), F.lit("N/A"))).alias("value"))
     .repartition(1).write.mode("overwrite").text(path))
    return path


def scratch_path(spark, name: str) -> str:
    shared_dir(spark)
    return new_subdir(spark, name)


def deduplicate_file(spark, path: str, key, schema=None, fmt: str = "csv", multi_line: bool = False) -> str:
    """Keep the last row per key in file order and write the result as a new
    version next to the input (the input is left untouched). Returns the new path."""
    from ..operators.dedupe import dedupe_keep_last
    from .readers import FILE_ORDER, with_file_order
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS).option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    scan = with_file_order(r.load(path))
    out = dedupe_keep_last(scan, key, list(FILE_ORDER)).drop(*FILE_ORDER)
    target = new_subdir(spark, "dedup")
    w = out.write.mode("overwrite")
    (w.options(**CSV_OPTIONS).csv(target) if fmt == "csv" else w.format(fmt).save(target))
    return target
