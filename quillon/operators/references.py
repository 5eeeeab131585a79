"""Orphan references: keys that point at records which are missing, deleted or arrive later.

Semantics of :func:`orphan_references`
--------------------------------------
* Rows are grouped by the null mask of their reference columns. ``match`` declares what a mask means:
  ``simple`` - a row with any null part is not a reference; ``partial`` - the non-null parts must occur
  together in some target row; ``full`` - all parts null is no reference, some parts null is an orphan
  with reason ``mixed_null``.
* ``missing``: no target row has the key; ``deleted``: every target row of the key has a deletion time;
  ``late``: no target row of the key has a creation time at or before the time of the referring row. The
  first reason that holds is given. A null creation time never counts as early enough; a null referring
  time makes every existing target late.
* Repeated rows count once; empty tables give no rows (no references) or only ``missing`` (no targets).
  Extra columns of either side are ignored, so clashing names cannot occur.

Scale: the target is reduced to one row per key before the join, so no join multiplies rows. Keys that hold
a large part of the references are joined apart (see :mod:`quillon.operators.joins`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, functions as F

from quillon.operators.joins import lookup_join

def _key_state(targets: DataFrame, keys: Sequence[str], created: str | None, deleted: str | None) -> DataFrame:
    """One row per key: whether a live row exists, and the earliest creation time."""
    live = F.max(F.col(deleted).isNull()) if deleted else F.max(F.lit(True))
    first = F.min(F.col(created)) if created else F.lit(None).cast("timestamp")
    cols = [F.col(c).alias(f"_t{i}") for i, c in enumerate(keys)]
    return targets.groupBy(*cols).agg(live.alias("_live"), first.alias("_first"))


def orphan_references(
    refs: DataFrame,
    ref_keys: Sequence[str],
    targets: DataFrame,
    target_keys: Sequence[str],
    row_key: str,
    ref_time: str | None = None,
    created: str | None = None,
    deleted: str | None = None,
    match: str = "simple",
) -> DataFrame:
    """Orphans as distinct ``(row_key, period, reason)``; see the module text for the semantics."""
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match semantics: {match}")
    n = len(ref_keys)
    time = F.col(ref_time) if ref_time else F.lit(None).cast("timestamp")
    rows = refs.select(
        F.col(row_key).cast("string").alias("row_key"), time.alias("_at"),
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate(ref_keys)],
    )
    parts = []
    for mask in product((True, False), repeat=n):  # True: the part is present
        held = [i for i in range(n) if mask[i]]
        if not held or (match == "simple" and len(held) < n):
            continue
        is_mask = reduce(lambda a, b: a & b, (F.col(f"_r{i}").isNotNull() == F.lit(m) for i, m in enumerate(mask)))
        of_mask = rows.filter(is_mask)
        if len(held) < n and match == "full":
            parts.append(of_mask.select("row_key", "_at", F.lit("mixed_null").alias("reason")))
            continue
        state = _key_state(targets.dropna(subset=[target_keys[i] for i in held]), [target_keys[i] for i in held], created, deleted)
        rk = [f"_r{i}" for i in held]
        reason = (
            F.when(F.col("_live").isNull(), "missing")
            .when(~F.col("_live"), "deleted")
            .when(F.lit(bool(created and ref_time)) & ~F.coalesce(F.col("_first") <= F.col("_at"), F.lit(False)), "late")
        )
        joined = lookup_join(of_mask, state, rk, [f"_t{j}" for j in range(len(held))])
        parts.append(joined.select("row_key", "_at", reason.alias("reason")).filter("reason is not null"))
    if not parts:
        return rows.filter(F.lit(False)).select("row_key", F.lit("").alias("period"), F.lit("").alias("reason"))
    out = reduce(DataFrame.unionAll, parts)
    return out.select("row_key", F.date_format("_at", "yyyy-MM").alias("period"), "reason").distinct()
