"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.session import new_subdir, prepare

ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, fixes
    the rows against re-execution, survives lost executors."""
    path = new_subdir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_bytes(text: Column | str) -> Column:
    """UTF-8 bytes of a text column; null becomes empty."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("binary"), F.lit(b""))


def rows(batches: Iterable[pa.RecordBatch], limit: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` rows, so that what is made
    from one slice stays bounded."""
    for b in batches:
        for at in range(0, b.num_rows, limit):
            yield b.slice(at, limit)


def held_out(doc_id: Column | str) -> Column:
    """Whether a document belongs to the held-out third (crc32 of the id as text, mod 3, is 1)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 3 == 1, F.lit(False))
