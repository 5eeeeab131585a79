"""Scoring of predicted relations and rules against expected ones by identity.

Identities are distinct before they meet, so a repeated prediction counts once. Null names match nothing. Empty sides give
precision or recall 1 where there is nothing to find and nothing found, else 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_SEPARATOR = "\x1f"


def project_relations(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``layer, s_type, s_name, predicate, o_type, o_name``: edges between nodes by what the nodes are, each once."""
    side = lambda c: nodes.select(F.col("node_id").alias(f"{c}_id"), F.col("node_type").alias(f"{c[0]}_type"), F.col("name").alias(f"{c[0]}_name"))
    return edges.join(side("subject"), "subject_id").join(side("object"), "object_id").select("layer", "s_type", "s_name", "predicate", "o_type", "o_name").distinct()


def project_rules(relations: DataFrame, rule_type: str, inputs: tuple[str, ...], outputs: tuple[str, ...]) -> DataFrame:
    """``layer, rule, inputs, outputs``: the sorted distinct names that a rule takes and gives, per layer."""
    of = lambda ps: F.array_sort(F.collect_set(F.when(F.col("predicate").isin(*ps), F.col("o_name"))))
    return relations.filter(F.col("s_type") == rule_type).groupBy("layer", F.col("s_name").alias("rule")).agg(of(inputs).alias("inputs"), of(outputs).alias("outputs"))


def rule_matches(candidates: DataFrame, expected: DataFrame) -> DataFrame:
    """``rule, outputs_equal, inputs_within, inputs_equal`` of rules on both sides.

    A match takes equal outputs and no input beyond the expected ones; a composite rule takes equal inputs.
    """
    want = expected.select("rule", F.col("inputs").alias("_i"), F.col("outputs").alias("_o"))
    both = candidates.join(want, "rule")
    return both.select("rule", (F.col("outputs") == F.col("_o")).alias("outputs_equal"), (F.size(F.array_except("inputs", "_i")) == 0).alias("inputs_within"), (F.col("inputs") == F.col("_i")).alias("inputs_equal"))


def _measures() -> list[Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return [
        F.when(tp + fp > 0, F.round(tp / (tp + fp), 6)).when(fn == 0, 1.0).otherwise(0.0).alias("precision"),
        F.when(tp + fn > 0, F.round(tp / (tp + fn), 6)).otherwise(1.0).alias("recall"),
        F.when(tp > 0, F.round(2 * tp / (2 * tp + fp + fn), 6)).when(fp + fn == 0, 1.0).otherwise(0.0).alias("f1"),
    ]


def case_scores(predicted: DataFrame, expected: DataFrame, case: str) -> DataFrame:
    """``case, kind, tp, fp, fn, precision, recall, f1`` of entities (subject names) and relations, per value of ``case``."""

    def keys(df: DataFrame, side: str) -> DataFrame:
        relation = F.concat_ws(_SEPARATOR, "s_name", "predicate", "o_type", "o_name")
        kinds = F.explode(F.array(F.struct(F.lit("entity").alias("kind"), F.col("s_name").alias("k")), F.struct(F.lit("relation").alias("kind"), relation.alias("k")))).alias("x")
        return df.select(F.col(case).alias("case"), kinds).select("case", "x.*").distinct().withColumn("p", F.lit(side == "p")).withColumn("g", F.lit(side == "g"))

    both = keys(predicted, "p").unionAll(keys(expected, "g")).groupBy("case", "kind", "k").agg(F.max("p").alias("p"), F.max("g").alias("g"))
    n = lambda c: F.count(F.when(c, 1))
    p, g = F.col("p"), F.col("g")
    out = both.groupBy("case", "kind").agg(n(p & g).alias("tp"), n(p & ~g).alias("fp"), n(g & ~p).alias("fn"))
    return out.select("case", "kind", "tp", "fp", "fn", *_measures())


def tier_scores(predicted: DataFrame, expected: DataFrame, tiers: dict[str, tuple[str, ...]]) -> DataFrame:
    """``tier, tp, fp, fn, precision, recall, f1``: predictions against the targets of each tier (a set of predicates).

    Predictions that meet a target of another tier are ignored, neither right nor wrong for this one. All tiers are counted
    in one pass.
    """
    triple = ["s_name", "predicate", "o_name"]
    rows = predicted.select(*triple).distinct().withColumn("p", F.lit(1)).join(expected.select(*triple).distinct().withColumn("g", F.lit(1)), triple, "full")
    tier = F.coalesce(*[F.when(F.col("predicate").isin(*ps), F.lit(t)) for t, ps in tiers.items()])
    counts = rows.groupBy(F.when(F.col("g") == 1, tier).alias("tier")).agg(F.count(F.when((F.col("p") == 1) & (F.col("g") == 1), 1)).alias("tp"), F.count(F.when(F.col("g").isNull(), 1)).alias("fp"), F.count(F.when(F.col("p").isNull(), 1)).alias("fn"))
    named = reduce(DataFrame.unionAll, [counts.agg(F.lit(t).alias("tier"), *[F.coalesce(F.sum(F.when(F.col("tier").isNull() if c == "fp" else F.col("tier") == t, F.col(c))), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]) for t in tiers])
    return named.select("tier", "tp", "fp", "fn", *_measures())


def layered_scores(predicted: DataFrame, expected: DataFrame) -> DataFrame:
    """``layer, tp, fp, fn, precision, recall, f1`` of relations by what is compared: mentions (names), canonical entities
    (type and name without spaces), links (which names stand for which entity type) and relations (canonical ends)."""
    label = lambda t, n: F.concat_ws(_SEPARATOR, t, F.regexp_replace(n, r"\s+", ""))

    def keys(df: DataFrame, side: str) -> DataFrame:
        ends = [(F.col(f"{x}_type"), F.col(f"{x}_name")) for x in "so"]
        made = [F.struct(F.lit("mention").alias("layer"), n.alias("k")) for _, n in ends] + [F.struct(F.lit("canonical").alias("layer"), label(t, n).alias("k")) for t, n in ends]
        made += [F.struct(F.lit("link").alias("layer"), F.concat_ws(_SEPARATOR, n, t).alias("k")) for t, n in ends]
        made += [F.struct(F.lit("relation").alias("layer"), F.concat_ws(_SEPARATOR, label(*ends[0]), F.col("predicate"), label(*ends[1])).alias("k"))]
        return df.select(F.explode(F.array(*made)).alias("x")).select("x.*").distinct().withColumn("p", F.lit(side == "p")).withColumn("g", F.lit(side == "g"))

    both = keys(predicted, "p").unionAll(keys(expected, "g")).groupBy("layer", "k").agg(F.max("p").alias("p"), F.max("g").alias("g"))
    n = lambda c: F.count(F.when(c, 1))
    p, g = F.col("p"), F.col("g")
    return both.groupBy("layer").agg(n(p & g).alias("tp"), n(p & ~g).alias("fp"), n(g & ~p).alias("fn")).select("layer", "tp", "fp", "fn", *_measures())
