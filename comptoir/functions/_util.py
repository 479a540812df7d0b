from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nullif_empty(c: Column) -> Column:
    """regexp_extract gives '' on no match; map it to NULL."""
    return F.nullif(c, F.lit(""))


def number_text(x: Column, digits: int | None = None) -> Column:
    """Plain decimal text of a number, without an exponent or trailing zeros: 1500.0 -> '1500',
    512.5 -> '512.5', 2.0E7 -> '20000000'. All its decimals, or at most ``digits`` (rounded).
    Numbers beyond 38 places give NULL, never an error."""
    if digits is not None:
        s = x.try_cast(f"decimal(38,{digits})").cast("string")
    else:
        plain = x.cast("string")
        # a double with an exponent: 17 significant digits fit behind the point from 1E-18 on
        spelt = F.coalesce(F.when(F.abs(x) < 1, plain.try_cast("decimal(38,37)").cast("string")), plain.try_cast("decimal(38,6)").cast("string"))
        s = F.when(plain.contains("E") | plain.isin("NaN", "Infinity", "-Infinity"), spelt).otherwise(plain)
    return F.when(s.contains("."), F.regexp_replace(s, r"\.?0+$", "")).otherwise(s)
