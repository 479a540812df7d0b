"""Sources (SRC-*): CSV with fixed or inferred schema, JSON documents, review
and page tables, object listings and recursive file discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    """Metadata check through the Hadoop FileSystem of ``path`` (no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


#: One set of CSV options for readers and writers: quotes are doubled, padding is kept.
CSV_OPTIONS = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


#: Column of the text of malformed JSON records.
CORRUPT = "_corrupt_record"


def scan_csv_schema(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Fixed schema, positional columns, header skipped, optional '"' enclosure.
    ``multi_line`` reads values with line breaks; files are then not split."""
    return (spark.read.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", True)
            .option("multiLine", multi_line).csv(path))


def scan_csv_infer(spark: SparkSession, path: str, default_schema: T.StructType | None = None,
                   infer: bool = True, multi_line: bool = False) -> DataFrame:
    """Header + inferred types; a missing path, or files without even a header, give an
    empty table of ``default_schema``. Inference reads all the data once more, since any row may widen a
    type. To read large or recurring files once, infer from a part with :func:`infer_csv_schema` and scan with
    that schema, or keep strings with ``infer=False``."""
    if not path_exists(spark, path):
        return empty(spark, default_schema or T.StructType([]))
    df = spark.read.options(**CSV_OPTIONS).option("inferSchema", infer).option("multiLine", multi_line).csv(path)
    return df if df.columns else empty(spark, default_schema or T.StructType([]))


def infer_csv_schema(spark: SparkSession, path: str, share: float = 1.0, multi_line: bool = False) -> T.StructType:
    """Inferred schema of a CSV folder, from the given share of its rows; to be kept and passed to :func:`scan_csv_schema`."""
    return (spark.read.options(**CSV_OPTIONS).option("inferSchema", True).option("samplingRatio", share)
            .option("multiLine", multi_line).csv(path).schema)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              multi_line: bool = False, default_schema: T.StructType | None = None, corrupt: str | None = CORRUPT) -> DataFrame:
    """JSON records; a malformed one gives a row with its text in the column ``corrupt`` and NULL in the others.
    With a schema the column is always there; ``corrupt=None`` leaves it out. (Spark refuses a query of that column
    alone on the files themselves: select another one with it.)"""
    if schema is not None and corrupt is not None and corrupt not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    if not path_exists(spark, path):
        return empty(spark, schema or default_schema or T.StructType([]))
    r = spark.read.option("mode", "PERMISSIVE").option("multiLine", multi_line)
    if corrupt is not None:
        r = r.option("columnNameOfCorruptRecord", corrupt)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def scan_reviews(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    """Review table (asin, comment, ...) from Parquet or CSV."""
    if fmt == "csv":
        return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path)
    return spark.read.format(fmt).load(path)


def scan_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw page corpus (page_id, url, html). ``fmt='text'`` reads one page per file."""
    if fmt == "text":
        # the argument, not .option(): text()'s own wholetext=False default would override it
        return (spark.read.text(path, wholetext=True)
                .select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
                .withColumn("page_id", F.xxhash64("url")))
    return spark.read.format(fmt).load(path)


def list_objects(spark: SparkSession, prefix: str) -> DataFrame:
    """Objects under a prefix: (path, key, name, length, modificationTime).

    ``binaryFile`` lists files in parallel; the ``content`` column is never
    selected, so no file body is read. "Folder" keys (ending in '/') are skipped.
    """
    base = prefix.rstrip("/")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
          .select("path", "length", "modificationTime"))
    return (df.filter(~F.col("path").endswith("/"))
            .withColumn("key", F.regexp_replace("path", r"^.*?" + _re_escape(base.split("://")[-1]) + "/", ""))
            .withColumn("name", F.element_at(F.split("path", "/"), -1)))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def discover_files(spark: SparkSession, root: str, extensions=("csv", "json")) -> DataFrame:
    """Recursive listing with the lower-cased extension and an ``is_data`` flag for the
    wanted extensions (case-insensitive); count / filter it for the totals."""
    pattern = r"\.(" + "|".join(extensions) + r")$"
    files = list_objects(spark, root)
    return (files.withColumn("ext", F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)))
            .withColumn("is_data", F.lower("name").rlike(pattern)))


FILE_ORDER = ("__file", "__block", "__row")


def with_file_order(scan: DataFrame) -> DataFrame:
    """Add the physical row order of a file scan: (file path, split start, row id).

    Must be applied directly on a file-source DataFrame, before any shuffle:
    inside one split rows are read in file order and the row id grows with
    them; the split start orders the splits of a file; files are ordered by
    folder, then part number (as a number: part-100000 follows part-99999), then path.
    """
    path = F.col("_metadata.file_path")
    part = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("long")
    return scan.select("*", F.struct(F.regexp_extract(path, "^(.*)/", 1).alias("folder"), part.alias("part"),
                                     path.alias("path")).alias("__file"),
                       F.col("_metadata.file_block_start").alias("__block"),
                       F.monotonically_increasing_id().alias("__row"))
