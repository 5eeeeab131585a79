"""Joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Bound of the broadcast side for hot keys, and the least rows and share of the rows that make a key hot.
HOT_KEYS, HOT_ROWS, HOT_SHARE = 128, 10_000, 0.002


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[tuple]:
    """At most ``HOT_KEYS`` key tuples that hold at least ``HOT_SHARE`` of the rows and ``HOT_ROWS`` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.filter(F.col("_n") >= HOT_ROWS).orderBy(F.col("_n").desc(), *keys).limit(HOT_KEYS).collect()
    if not top:
        return []
    total = df.count()
    return [tuple(r[k] for k in keys) for r in top if r["_n"] >= HOT_SHARE * total]


def is_any(cols: Sequence[Column], values: list[tuple]) -> Column:
    """Whether the columns equal one of the tuples."""
    if len(cols) == 1:
        return cols[0].isin([v[0] for v in values])
    return reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (c == F.lit(x) for c, x in zip(cols, v))) for v in values))


def lookup_join(rows: DataFrame, keyed: DataFrame, row_keys: Sequence[str], keys: Sequence[str], how: str = "left", hot: list[tuple] | None = None) -> DataFrame:
    """Join ``rows`` to ``keyed``, which has one row per key.

    The rows of hot keys meet a broadcast of at most ``HOT_KEYS`` rows of ``keyed``; all others take the shuffle join,
    so no task gets a hot key's rows. Null keys match nothing. The column names of both sides must differ. ``hot`` are
    the hot keys where the caller has them already (:func:`hot_keys`).
    """
    on = reduce(lambda a, b: a & b, (F.col(r) == F.col(k) for r, k in zip(row_keys, keys)))
    hot = hot_keys(rows.dropna(subset=list(row_keys)), row_keys) if hot is None else hot
    if not hot:
        return rows.join(keyed, on, how)
    of_rows = F.coalesce(is_any([F.col(r) for r in row_keys], hot), F.lit(False))
    of_keyed = is_any([F.col(k) for k in keys], hot)
    return rows.filter(~of_rows).join(keyed, on, how).unionAll(rows.filter(of_rows).join(F.broadcast(keyed.filter(of_keyed)), on, how))
