"""Storage-size text normalisation (STR-03, STR-04)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, nullif_empty, number_text


def storage_gb(c, strict: bool = False) -> Column:
    """'2TB' -> '2000 GB', '256 gb' -> '256 GB'; TB tested before GB, case-insensitive.

    The last two characters are cut wherever the unit sits, so '512 GB SSD' is
    not a number: NULL (lenient) or an error (strict).
    """
    x = as_col(c)
    head = F.substring(x, F.lit(1), F.length(x) - 2)
    num = head.cast("double") if strict else head.try_cast("double")
    up = F.upper(x)
    return (F.when(up.like("%TB%"), F.concat(number_text(num * 1000), F.lit(" GB")))
            .when(up.like("%GB%"), F.concat(number_text(num), F.lit(" GB"))))


def storage_gb_1024(c) -> Column:
    """Integer GB with TB x 1024, case-sensitive units: '2TB' -> 2048, '512 gb' -> NULL."""
    x = as_col(c)
    digits = nullif_empty(F.regexp_extract(x, r"[0-9]+", 0)).try_cast("bigint")
    return F.when(x.like("%TB%"), F.try_multiply(digits, F.lit(1024))).when(x.like("%GB%"), digits)
