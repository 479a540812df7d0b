"""Table cleaning (PRJ-04/05, FLT-04/05/06, STR-07, AGG-12): ``clean_table`` and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null, strip_ws

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def normalise_names(df: DataFrame) -> DataFrame:
    """' My Col ' -> 'my_col' (metadata only, no job)."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def rename_cols(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by mapping; unknown names are an error (a silent no-op hides typos)."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise ValueError(f"rename: unknown column(s) {missing}")
    return df.withColumnsRenamed(mapping)


def drop_null_subset(df: DataFrame, subset) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset))


def clean_table(df: DataFrame, compat_nan_text: bool = False) -> DataFrame:
    """Order of the reference: names -> exact duplicates dropped -> strings stripped
    and '' -> NULL -> negatives -> NULL -> all-NULL rows dropped.

    Duplicates go before stripping, so ' a' and 'a' both survive.
    ``compat_nan_text`` reproduces the reference's text cast, where NULL
    strings become the text 'nan' (and so all-null rows rarely disappear).
    """
    d = normalise_names(df).dropDuplicates()
    cols = []
    for f in d.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = (F.coalesce(strip_ws(c), F.lit("nan")) if compat_nan_text else blank_to_null(c))
        elif isinstance(f.dataType, NUMERIC):
            c = F.when(c >= 0, c)
        cols.append(c.alias(f.name))
    return d.select(*cols).na.drop(how="all")
