"""Price text -> numbers (STR-01, STR-02) and the price-band dimension (SRC-08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PRICE_CLASS
from ._util import as_col

# The price-band dimension (classe, prix_min, prix_max), in the
# reference's order. Bounds are DOUBLE, as the reference's FLOAT columns.
PRICE_BANDS = [
    ("Bas", 0.0, 500.0),
    ("Moyen", 500.01, 1500.0),
    ("Élevé", 1500.01, 1000000.0),
]

BAND_SCHEMA = PRICE_CLASS


def _strip_currency(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("£"), F.lit("")), F.lit(","), F.lit(""))


def parse_price(c, strict: bool = False) -> Column:
    """'£1,299.00' -> 1299.0. Lenient (default): unparsable text -> NULL;
    strict: raise like the reference's ``astype(float)``."""
    s = _strip_currency(as_col(c))
    return s.cast("double") if strict else s.try_cast("double")


def parse_price_number(c, strict: bool = False) -> Column:
    """Price text -> integer-rounded NUMBER(38,0) (HALF_UP): '£500.50' -> 501."""
    s = _strip_currency(as_col(c))
    t = T.DecimalType(38, 0)
    return s.cast(t) if strict else s.try_cast(t)


def price_bands(spark: SparkSession) -> DataFrame:
    """The three-row band dimension as an inline table."""
    return spark.createDataFrame(PRICE_BANDS, BAND_SCHEMA)
