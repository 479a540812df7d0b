"""Store of known keys, kept in buckets by key (JN-04..07).

Each ingest asks which rows of a batch are new and adds their keys. The store
is a table bucketed and sorted by the keys in the session catalog, so an
anti-join reads it as it lies: only the batch is shuffled, however large the
store has grown. Appends write new files of the same buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_subdir


class KnownKeys:
    """Known keys under a table name. ``buckets`` is fixed when the store is made: about one per 100 MB
    of keys expected."""

    def __init__(self, spark: SparkSession, name: str, keys, buckets: int = 64, path: str | None = None):
        self.spark, self.name, self.keys, self.buckets = spark, name, [keys] if isinstance(keys, str) else list(keys), buckets
        self.path = path or new_subdir(spark, f"known-keys/{name}")

    def add(self, rows: DataFrame) -> None:
        """Append the keys of ``rows`` that are not stored yet (keys with a NULL are never known)."""
        k = rows.select(*self.keys).dropna().distinct()
        if self.spark.catalog.tableExists(self.name):
            k = self._unknown(k)
        # dealt like the buckets, so that each bucket gets one file
        (k.repartition(self.buckets, *self.keys).write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(self.name))

    def _unknown(self, batch: DataFrame) -> DataFrame:
        return batch.join(self.table(), self.keys, "left_anti")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key is not known (rows with a NULL in the key are new)."""
        return self._unknown(batch) if self.spark.catalog.tableExists(self.name) else batch

    def compact(self) -> None:
        """Rewrite the store with one file a bucket, after many appends."""
        whole = self.table()
        old, self.path = self.path, new_subdir(self.spark, f"known-keys/{self.name}")
        (whole.repartition(self.buckets, *self.keys).write.format("parquet").option("path", self.path)
         .bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(self.name + "__new"))
        self.spark.sql(f"DROP TABLE `{self.name}`")
        self.spark.sql(f"ALTER TABLE `{self.name}__new` RENAME TO `{self.name}`")
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(old)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ingest(batch: DataFrame, store: KnownKeys) -> DataFrame:
    """New rows of a batch, written before their keys are added, so that a failure in between finds
    them new again. Returns the written rows."""
    path = new_subdir(batch.sparkSession, "fresh")
    store.new_rows(batch).write.parquet(path)
    fresh = batch.sparkSession.read.schema(batch.schema).parquet(path)
    store.add(fresh)
    return fresh
