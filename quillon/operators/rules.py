"""Interval comparison, atomic predicates, three-valued rule trees and case selection, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def decimal_of(text: Column) -> Column:
    """A finite decimal number, null for anything else."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def value_errors(text: Column) -> Column:
    """``invalid_value`` or ``non_finite_value`` for a text that is no finite number, null otherwise."""
    finite = F.lower(F.trim(text)).isin("nan", "inf", "-inf", "+inf", "infinity", "-infinity")
    return F.when(text.isNull(), "invalid_value").when(finite, "non_finite_value").when(~text.rlike(NUMBER), "invalid_value")


def interval_flag(value: Column, lower: Column, upper: Column, lower_inclusive: Column, upper_inclusive: Column) -> Column:
    """``low``, ``high`` or ``normal``; null without a value or without any bound, or if the bounds are reversed."""
    low = (value < lower) | ((value == lower) & ~F.coalesce(lower_inclusive, F.lit(True)))
    high = (value > upper) | ((value == upper) & ~F.coalesce(upper_inclusive, F.lit(True)))
    usable = value.isNotNull() & (lower.isNotNull() | upper.isNotNull()) & ~F.coalesce(lower > upper, F.lit(False))
    return F.when(usable, F.when(F.coalesce(low, F.lit(False)), "low").when(F.coalesce(high, F.lit(False)), "high").otherwise("normal"))


def evaluate_observations(rows: DataFrame) -> DataFrame:
    """``computed_flag`` and ``errors`` (array) for observations with ``value, unit, unit_source, ref_lower, ref_upper,
    lower_inclusive, upper_inclusive, report_flag``.

    A missing unit and an applied default unit are noted but do not keep the comparison from being made.
    """
    v = decimal_of(F.col("value"))
    flag = interval_flag(v, F.col("ref_lower"), F.col("ref_upper"), F.col("lower_inclusive"), F.col("upper_inclusive"))
    no_unit = F.col("unit").isNull() | (F.col("unit") == "")
    errors = F.array_compact(F.array(
        value_errors(F.col("value")),
        F.when(no_unit, "missing_unit").when(F.col("unit_source") == "controlled_default", "default_unit_applied"),
        F.when(F.col("ref_lower").isNull() & F.col("ref_upper").isNull(), "invalid_interval").when(F.col("ref_lower") > F.col("ref_upper"), "reversed_interval"),
        F.when(flag.isNotNull() & F.col("report_flag").isNotNull() & (flag != F.col("report_flag")), "report_flag_conflict"),
    ))
    return rows.withColumns({"computed_flag": flag, "errors": errors})


def atomic(operator: Column, value: Column, threshold: Column, upper: Column) -> Column:
    """A predicate on a number: ``lt le eq ge gt between``; null (unknown) where the value or the operator is."""
    return (
        F.when(operator == "lt", value < threshold).when(operator == "le", value <= threshold).when(operator == "eq", value == threshold)
        .when(operator == "ge", value >= threshold).when(operator == "gt", value > threshold).when(operator == "between", (value >= threshold) & (value <= upper))
    )


def combine(kind: Column, k: Column, n_true: Column, n_unknown: Column, n: Column) -> Column:
    """Three-valued combination of the children of a node: ``all any not at_least at_most``; null is unknown."""
    false, true = F.lit(False), F.lit(True)
    return (
        F.when(kind == "all", F.when(n_true + n_unknown < n, false).when(n_unknown > 0, None).otherwise(true))
        .when(kind == "any", F.when(n_true > 0, true).when(n_unknown > 0, None).otherwise(false))
        .when(kind == "not", F.when(n_unknown > 0, None).otherwise(n_true == 0))
        .when(kind == "at_least", F.when(n_true >= k, true).when(n_true + n_unknown >= k, None).otherwise(false))
        .when(kind == "at_most", F.when(n_true > k, false).when(n_true + n_unknown <= k, true))
    )


def heights(nodes: list[tuple[str, str, str | None]]) -> dict[tuple[str, str], int]:
    """Height of every node ``(rule, node, parent)`` above its lowest leaf."""
    parent = {(r, n): (r, p) if p is not None else None for r, n, p in nodes}
    out = dict.fromkeys(parent, 0)
    for key in parent:
        h, up, seen = 0, parent[key], {key}
        while up is not None and up in out and up not in seen:
            h += 1
            out[up] = max(out[up], h)
            seen.add(up)
            up = parent[up]
    return out


def evaluate_tree(nodes: DataFrame, facts: DataFrame, max_nodes: int = 100_000) -> DataFrame:
    """``case_id, rule_id, result`` (``true``, ``false``, ``unknown``) of rule trees.

    ``nodes``: ``rule_id, node_id, parent_id, kind, k, metric, op, threshold, upper`` (leaves have kind ``atom``), a list
    of at most ``max_nodes`` rows; ``facts``: one row per ``case_id, metric`` with ``value``. A missing or null fact is
    unknown; a case without any fact of a rule has no row for it. Each height of the trees is one aggregation by case
    and parent over the children evaluated so far.
    """
    rows = nodes.select("rule_id", "node_id", "parent_id").limit(max_nodes + 1).collect()
    if len(rows) > max_nodes:
        raise ValueError(f"more than {max_nodes} rule nodes")
    high = heights([tuple(r) for r in rows])
    levels = nodes.sparkSession.createDataFrame([(r, n, h) for (r, n), h in high.items()], "rule_id string, node_id string, h int")
    size = nodes.filter("parent_id is not null").groupBy("rule_id", F.col("parent_id").alias("node_id")).agg(F.count(F.lit(1)).alias("n"))
    inner = nodes.filter("kind <> 'atom'").select("rule_id", "node_id", "parent_id", "kind", "k").join(levels, ["rule_id", "node_id"]).join(size, ["rule_id", "node_id"])
    atoms = nodes.filter("kind = 'atom'").select("rule_id", "node_id", "parent_id", "metric", "op", "threshold", "upper")
    done = facts.join(F.broadcast(atoms), "metric").select("case_id", "rule_id", "node_id", "parent_id", atomic(F.col("op"), F.col("value"), F.col("threshold"), F.col("upper")).alias("v"))
    for h in range(1, max(high.values(), default=0) + 1):
        got = done.filter("parent_id is not null").groupBy("case_id", "rule_id", F.col("parent_id").alias("node_id")).agg(F.count(F.when(F.col("v"), 1)).alias("t"), F.count(F.when(F.col("v").isNotNull(), 1)).alias("m"))
        up = got.join(F.broadcast(inner.filter(F.col("h") == h)), ["rule_id", "node_id"])
        v = combine(F.col("kind"), F.col("k"), F.col("t"), F.col("n") - F.col("m"), F.col("n"))
        done = done.unionByName(up.select("case_id", "rule_id", "node_id", "parent_id", v.alias("v")))
    text = F.when(F.col("v").isNull(), "unknown").when(F.col("v"), "true").otherwise("false")
    return done.filter("parent_id is null").select("case_id", "rule_id", text.alias("result"))


def select_case(status: DataFrame, by: list[str]) -> DataFrame:
    """One outcome per key from the statuses of its cases (column ``status``): exactly one ``pass`` is a match, more are
    ambiguous, else the first of the listed failures that occurs."""
    order = ["unsupported", "unit_mismatch", "ambiguous", "missing", "boundary_ambiguous"]
    n = F.count(F.when(F.col("status") == "pass", 1))
    failures = F.coalesce(*[F.when(F.count(F.when(F.col("status") == s, 1)) > 0, s) for s in order], F.lit("no_case_match"))
    return status.groupBy(*by).agg(F.when(n == 1, "case_match").when(n > 1, "ambiguous").otherwise(failures).alias("outcome"), n.alias("n_pass"))
