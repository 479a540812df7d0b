"""De-duplication, merge, upsert and incremental update (WIN-01/02, SET-01..04, SRT-07).

Spark rows have no file order, so "keep last" always takes explicit order
columns (file number, row number, timestamp, ...). The winner per key is
``row_number() = 1`` over the order: Spark plans it with a *partial*
WindowGroupLimit in every map task before the shuffle, so a key holding a
third of all rows ships one row per map task and never lands whole in one
task. Remaining payload columns break exact ties, so the pick is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import to_timestamp_lenient

_ORDERABLE = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BinaryType)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def tie_break(df: DataFrame, used, last: bool = True) -> list[Column]:
    """One sort column that tells rows apart beyond the columns ``used``: a hash of the payload, so that
    exact ties are broken the same way in every run without dragging all columns through the sort."""
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in used and isinstance(f.dataType, _ORDERABLE)]
    if not rest:
        return []
    h = F.xxhash64(*rest)
    return [h.desc() if last else h.asc()]


def pick_per_key(df: DataFrame, key, order: list[Column], last: bool = True) -> DataFrame:
    """One row per key: the greatest (``last``) or least by ``order``; NULL ranks lowest. Exact ties in
    ``order`` are broken by a hash of the other columns.

    NULL keys form one group (pandas ``drop_duplicates`` semantics).
    """
    keys = _keys(key)
    sort = [(c.desc_nulls_last() if last else c.asc_nulls_first()) for c in order]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*sort, *tie_break(df, keys, last))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def dedupe_keep_last(df: DataFrame, key, order_cols) -> DataFrame:
    """drop_duplicates(subset=key, keep='last') with the row order given by ``order_cols``."""
    missing = [k for k in _keys(key) if k not in df.columns]
    if missing:
        raise ValueError(f"key column(s) {missing} not found")
    return pick_per_key(df, key, [F.col(c) for c in order_cols], last=True)


def merge_tables(dfs, key=None, order_cols=(), file_col: str = "__file_no") -> DataFrame:
    """Union by column name (missing columns -> NULL); with ``key``, keep the last
    row per key in (file number, ``order_cols``) order (SET-01)."""
    tagged = [d.withColumn(file_col, F.lit(i)) for i, d in enumerate(dfs)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if key is None:
        return merged.drop(file_col)
    if any(k not in merged.columns for k in _keys(key)):
        return merged.drop(file_col)  # the reference skips de-dup when the key is absent
    out = pick_per_key(merged, key, [F.col(file_col)] + [F.col(c) for c in order_cols])
    return out.drop(file_col)


def schema_union(dfs) -> DataFrame:
    """Union whose schema is the union of the inputs' columns (SET-03)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def upsert_by_key(existing: DataFrame, new: DataFrame, order_cols=(), keys=("product_id", "id")) -> DataFrame:
    """Append with replacement: the first of ``keys`` present in both tables is the key,
    new rows replace old ones (keep last); without a key the rows are appended (SET-02)."""
    key = next((k for k in keys if k in existing.columns and k in new.columns), None)
    if key is None:
        return existing.unionByName(new, allowMissingColumns=True)
    return merge_tables([existing, new], key, order_cols)


def incremental_update(target: DataFrame, source: DataFrame, key: str = "product_id",
                       ts_col: str | None = "last_updated", tie_break=(), prefer_source: bool = True) -> DataFrame:
    """Keep the newest row per key by timestamp (WIN-02).

    Timestamps are parsed leniently (bad text -> NULL, ranked last). Equal
    timestamps: the source row wins, then ``tie_break`` columns (greatest);
    ``prefer_source=False`` ranks by ``tie_break`` before the source flag, which
    makes repeated merges independent of arrival order (used by the stream).
    Without a usable timestamp column the source simply wins (keep last).
    """
    for d, what in ((source, "source"), (target, "target")):
        if key not in d.columns:
            raise ValueError(f"key column {key!r} not found in {what}")
    src = "__is_source"
    t = target.withColumn(src, F.lit(0))
    s = source.withColumn(src, F.lit(1))
    if ts_col and ts_col in source.columns and ts_col in target.columns:
        t = t.withColumn(ts_col, to_timestamp_lenient(F.col(ts_col)))
        s = s.withColumn(ts_col, to_timestamp_lenient(F.col(ts_col)))
        both = t.unionByName(s, allowMissingColumns=True)
        ties = [F.col(c) for c in tie_break]
        order = [F.col(ts_col).isNotNull(), F.col(ts_col)] + ([F.col(src)] + ties if prefer_source else ties + [F.col(src)])
    else:
        both = t.unionByName(s, allowMissingColumns=True)
        order = [F.col(src)] + [F.col(c) for c in tie_break]
    return pick_per_key(both, key, order, last=True).drop(src)


def resume_after(df: DataFrame, order_col: str, last) -> DataFrame:
    """Rows strictly after the stored progress value (SRT-07)."""
    last_c = last if isinstance(last, Column) else F.lit(last)
    return df.filter(F.col(order_col) > last_c)
