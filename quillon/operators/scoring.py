"""Set-algebraic scores, one-to-one matching, issues and gold building."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F


def prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1 to 6 places. Without prediction the precision is 1 if there is no gold either, else 0;
    without gold the recall is 1; F1 is 0 if both are."""
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.when(tp + fn == 0, 1.0).otherwise(0.0))
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(1.0)
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return {"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": F.round(f1, 6)}


def confusion(predicted: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, tp, fp, fn``: one row per distinct identity of either side."""
    p = predicted.select(*keys).distinct().withColumn("_p", F.lit(1))
    g = gold.select(*keys).distinct().withColumn("_g", F.lit(1))
    both = p.join(g, keys, "full_outer")
    has_p, has_g = F.col("_p").isNotNull(), F.col("_g").isNotNull()
    return both.select(*keys, (has_p & has_g).cast("int").alias("tp"), (has_p & ~has_g).cast("int").alias("fp"), (~has_p & has_g).cast("int").alias("fn"))


def scores(conf: DataFrame, by: list[str]) -> DataFrame:
    """Counts and scores per group of a :func:`confusion`."""
    s = conf.groupBy(*by).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn")])
    return s.select(*by, "tp", "fp", "fn", *[c.alias(n) for n, c in prf(F.col("tp"), F.col("fp"), F.col("fn")).items()])


def issues(errors: DataFrame, reason: str, critical: list[str]) -> DataFrame:
    """Issues grouped by reason: low below 5, medium below 20, else high, critical ones marked."""
    g = errors.groupBy(F.col(reason).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("severity", F.when(F.col("n") < 5, "low").when(F.col("n") < 20, "medium").otherwise("high")).withColumn("critical", F.col("reason").isin(critical))


def maximum_matching(pairs: DataFrame, group: str) -> DataFrame:
    """``group, p, g``: a largest one-to-one matching of predictions ``p`` and gold ``g`` per group.

    Deterministic augmenting paths in the order of ``p``, then ``g``. ``pairs`` holds the allowed pairs.
    """

    def match(df: pd.DataFrame) -> pd.DataFrame:
        options: dict = {}
        for p, g in sorted(set(zip(df["p"], df["g"]))):
            options.setdefault(p, []).append(g)
        taken: dict = {}  # gold -> prediction
        has: dict = {}  # prediction -> gold
        for start in options:
            # breadth first over alternating paths, so that long paths need no recursion
            came: dict = {}
            queue, free = [start], None
            for p in queue:
                for g in options[p]:
                    if g not in came:
                        came[g] = p
                        if g not in taken:
                            free = g
                            break
                        queue.append(taken[g])
                if free is not None:
                    break
            while free is not None:
                p = came[free]
                before = has.get(p)
                taken[free], has[p] = p, free
                free = before  # the gold that p leaves goes to the prediction from which it was reached
        out = sorted((p, g) for g, p in taken.items())
        return pd.DataFrame([(df[group].iloc[0], p, g) for p, g in out], columns=[group, "p", "g"])

    return pairs.select(group, "p", "g").distinct().groupBy(group).applyInPandas(match, pairs.select(group, "p", "g").schema)


def longest_first(spans: DataFrame, group: list[str]) -> DataFrame:
    """Spans (``start, end``) kept longest first, then by start, where they overlap none kept before in their group."""
    schema = spans.schema

    def keep(p: pd.DataFrame) -> pd.DataFrame:
        p = p.assign(_n=p["start"] - p["end"]).sort_values(["_n", "start", "end"], kind="stable")
        kept: list = []
        rows = []
        for i, (a, b) in enumerate(zip(p["start"], p["end"])):
            if all(b <= x or a >= y for x, y in kept):
                kept.append((a, b))
                rows.append(i)
        return p.iloc[rows].drop(columns="_n")

    return spans.groupBy(*group).applyInPandas(keep, schema)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; rows with a null key stay as they are."""
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull().cast("int")
    w = W.partitionBy(*keys).orderBy(*order)
    return df.filter(null_key == 0).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r").unionByName(df.filter(null_key == 1))
