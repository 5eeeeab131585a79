"""Rules over the graph: facts of their inputs, paths from observations to conclusions, chained preconditions.

All tables may be empty; null keys match nothing; repeated rows count once. A rule has a bounded number of inputs, so the
arrays of a group (report, rule) are small; no group holds all reports of a rule.

``condition_facts``, ``reasoning_paths`` and ``chained`` take tables with rows for pairs of a report and a rule. Where rules
hear observations by name, every report meets a share of all rules, so such tables grow with reports times rules.
``named_facts`` and ``named_paths`` give the same results from a row for each report (``report_profiles``) and one for each
kind of rule (``rule_shapes``): the pairs are made after the last exchange and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillon.session import broadcast_if_small, checkpointed

#: States that reported flags stand for.
STATES = {"high": "升高", "low": "降低", "normal": "正常"}
#: Statuses of a final graph that lead to a conclusion.
ACTIONABLE = ("final-case-match", "final-case-match-precondition-derived")
#: Rules and names are sent to every task where they are counted to be at most so many, else joined by key.
MOST_SENT = 500_000


def condition_facts(asked: DataFrame, links: DataFrame, context: DataFrame) -> DataFrame:
    """``report_id, rule_id, input, status, value``: what is known about each input of a rule.

    ``asked``: ``report_id, rule_id, input, node_id, is_state``, one row for each node that an input may mean (``node_id``
    null for none); ``links``: ``report_id, node_id, metric_id, value, flag``; ``context``: ``report_id, input, value``. A
    context fact goes first; else exactly one metric must be linked to the nodes of the input: none is ``missing``, more are
    ``ambiguous``. State inputs read the flag, and are missing where it stands for no state.
    """
    facts = links.select("report_id", "node_id", "metric_id", "value", "flag").dropna(subset=["report_id", "node_id", "metric_id"])
    got = asked.join(facts, ["report_id", "node_id"], "left").groupBy("report_id", "rule_id", "input")
    got = got.agg(F.max("is_state").alias("is_state"), F.count_distinct("metric_id").alias("n"), F.max(F.struct("metric_id", "value", "flag")).alias("b"))
    told = context.groupBy("report_id", "input").agg(F.min("value").alias("told"), F.lit(True).alias("in_context"))
    got = got.join(told, ["report_id", "input"], "left")
    state = F.coalesce(*[F.when(F.col("b.flag") == k, F.lit(v)) for k, v in STATES.items()])
    value = F.when(F.col("in_context"), F.col("told")).when(F.col("n") == 1, F.when(F.col("is_state"), state).otherwise(F.col("b.value")))
    status = F.when(F.col("in_context"), "ok").when(F.col("n") == 0, "missing").when(F.col("n") > 1, "ambiguous").when(F.col("is_state") & state.isNull(), "missing").otherwise("ok")
    return got.select("report_id", "rule_id", "input", status.alias("status"), value.alias("value"))


def endpoint_mismatches(subjects: DataFrame, terms: DataFrame) -> DataFrame:
    """``rule_id, reason``: rules with a subject edge whose declared terms mean other nodes only.

    ``subjects``: ``rule_id, node_id``; ``terms``: ``rule_id, node_id, term_node_id``, the nodes that the terms declared on a
    subject edge mean.
    """
    declared = terms.filter("term_node_id is not null").groupBy("rule_id", "node_id").agg(F.max((F.col("node_id") == F.col("term_node_id")).cast("int")).alias("fits"))
    bad = subjects.join(declared, ["rule_id", "node_id"]).filter("fits = 0").select("rule_id").distinct()
    return bad.withColumn("reason", F.lit("subject_endpoint_mismatch"))


def reasoning_paths(links: DataFrame, subjects: DataFrame, conclusions: DataFrame, rules: DataFrame, context: DataFrame, outcomes: DataFrame, prefix: str) -> DataFrame:
    """``report_id, rule_id, metrics, roles, missing, status``: the rules that a report's observations speak to.

    ``links``: ``report_id, node_id, metric_id``; ``subjects``: ``rule_id, node_id, required``; ``conclusions``:
    ``rule_id, node_id``; ``rules``: ``rule_id, preconditions`` (how many it has); ``context``: ``report_id, rule_id, role`` of
    met population roles; ``outcomes``: ``report_id, rule_id, outcome`` of the cases of rules that have some; ``prefix`` the
    status of the graph. A path needs two metrics, or one and a role, and a rule with a conclusion. Where required subjects
    are named only these must be there. The status is partial with missing inputs, else that of the cases, else complete;
    preconditions keep it unverified.
    """
    needs = subjects.dropna(subset=["rule_id", "node_id"]).groupBy("rule_id").agg(F.collect_set("node_id").alias("subjects"), F.collect_set(F.when(F.col("required"), F.col("node_id"))).alias("named"))
    needs = needs.join(conclusions.select("rule_id").distinct(), "rule_id", "left_semi")
    there = links.select("report_id", "node_id", "metric_id").dropna().distinct().join(subjects.select("rule_id", "node_id").distinct(), "node_id")
    there = there.groupBy("report_id", "rule_id").agg(F.array_sort(F.collect_set("metric_id")).alias("metrics"), F.collect_set("node_id").alias("matched"))
    roles = context.groupBy("report_id", "rule_id").agg(F.array_sort(F.collect_set("role")).alias("roles"))
    rows = there.join(roles, ["report_id", "rule_id"], "left").withColumn("roles", F.coalesce("roles", F.array().cast("array<string>")))
    rows = rows.filter((F.size("metrics") >= 2) | (F.size("roles") >= 1)).join(needs, "rule_id")
    required = F.when(F.size("named") > 0, F.col("named")).otherwise(F.col("subjects"))
    rows = rows.withColumn("missing", F.array_sort(F.array_except(required, "matched")))
    rows = rows.join(outcomes.select("report_id", "rule_id", "outcome").distinct(), ["report_id", "rule_id"], "left").join(rules.groupBy("rule_id").agg(F.max("preconditions").alias("pre")), "rule_id", "left")
    open_ = F.coalesce(F.col("pre") > 0, F.lit(False))
    status = (
        F.when(F.size("missing") > 0, "partial")
        .when((F.col("outcome") == "case_match") & open_, "case-match-precondition-unverified")
        .when(F.col("outcome").isNotNull(), F.replace("outcome", F.lit("_"), F.lit("-")))
        .when(open_, "precondition-unverified")
        .otherwise("complete")
    )
    return rows.select("report_id", "rule_id", "metrics", "roles", "missing", F.concat(F.lit(f"{prefix}-"), status).alias("status"))


def chained(paths: DataFrame, dependencies: DataFrame, preconditions: DataFrame, prefix: str) -> DataFrame:
    """``paths`` with the status after one hop of preconditions, and ``verified`` (null where a context stays open).

    ``paths``: ``report_id, rule_id, status, outcome, result``; ``dependencies``: ``producer, consumer, context, result``, the
    results of the producer that satisfy a context of the consumer, a row each; ``preconditions``: ``rule_id, context``. A
    context passes if the producer's case matches with such a result in the same report; of several producers any may pass.
    """
    names = paths.columns
    produced = paths.select("report_id", F.col("rule_id").alias("producer"), F.col("outcome").alias("_o"), F.col("result").alias("_r"))
    passed = F.coalesce((F.col("_o") == "case_match") & (F.col("_r") == F.col("result")), F.lit(False))
    told = dependencies.join(produced, "producer").groupBy("report_id", "consumer", "context").agg(F.max(passed).alias("passed"))
    asked = paths.select("report_id", "rule_id").join(preconditions.dropna().distinct(), "rule_id")
    told = asked.join(told.withColumnRenamed("consumer", "rule_id"), ["report_id", "rule_id", "context"], "left")
    told = told.groupBy("report_id", "rule_id").agg(F.when(F.count("passed") == F.count(F.lit(1)), F.min("passed")).alias("verified"))
    rows = paths.join(told, ["report_id", "rule_id"], "left")
    status: Column = (
        F.when(F.col("verified") & (F.col("outcome") == "case_match"), f"{prefix}-case-match-precondition-derived")
        .when(F.coalesce(~F.col("verified"), F.lit(False)), f"{prefix}-precondition-failed")
        .otherwise(F.col("status"))
    )
    return rows.withColumn("status", status).select(*names, "verified")


def reportable(paths: DataFrame) -> DataFrame:
    """Paths of candidate graphs, and of final graphs those that lead to a conclusion."""
    return paths.filter(~F.col("status").startswith("final-") | F.col("status").isin(*ACTIONABLE))


def name_numbers(subjects: DataFrame) -> DataFrame:
    """``name, id`` of the names of subjects, the null name too; a number each, as arrays of numbers are compared fast."""
    return subjects.select("name").distinct().select("name", F.row_number().over(W.orderBy("name")).alias("id"))


def rule_shapes(rules: DataFrame, key: list[str], members: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rules that no report can tell apart: ``id, shape, *key`` for each name of a shape, and ``shape, *members`` for each rule.

    ``rules``: a row per ``rule_id``; ``key`` are its columns that decide about a report, ``names`` (numbers) among them. A
    shape is known by its first rule.
    """
    shapes = rules.groupBy(*key).agg(F.min("rule_id").alias("shape"))
    rows = rules.join(shapes, [rules[k].eqNullSafe(shapes[k]) for k in key]).select("shape", *[rules[m] for m in members])
    return shapes.select(F.explode("names").alias("id"), "shape", *key), rows


def report_profiles(observed: DataFrame, names: DataFrame, told: Column, partitions: int) -> DataFrame:
    """``report_id, told, clash, ids, odd_ids, facts``: a row for each report, placed by ``report_id``.

    ``observed``: ``report_id, name, metric_id, value, flag`` and what ``told`` needs. ``facts`` are ``metrics, value, flag`` by
    the number of the name; ``odd_ids`` the names with a high or low metric; ``told`` whether that holds for a row;
    ``clash`` whether one metric stands under two names, and then ``same`` are the names with the metrics of a name. Repeated rows count once, as all that is taken of them is sets, least and greatest values.
    """
    n = broadcast_if_small(names.filter("name is not null"), MOST_SENT)
    known = observed.withColumn("told", F.coalesce(told, F.lit(False))).join(n, "name", "left").filter("id is not null or told")
    mine = lambda c: F.when(F.col("id").isNotNull(), F.col(c)).alias(c)
    known = known.select("report_id", "told", "id", mine("metric_id"), mine("value"), mine("flag")).repartition(partitions, "report_id")
    metrics = known.groupBy("report_id", "id", "metric_id").agg(F.max("told").alias("told"), F.min("value").alias("value"), F.max("flag").alias("flag"))
    by_name = metrics.groupBy("report_id", "id").agg(
        F.max("told").alias("told"), F.sort_array(F.collect_set("metric_id")).alias("metrics"), F.min("value").alias("value"), F.min("flag").alias("flag"), F.max(F.coalesce(F.col("flag").isin("high", "low"), F.lit(False))).alias("odd")
    )
    heard = F.col("id").isNotNull()
    entry = F.struct("id", F.struct("metrics", "value", "flag", F.lit(None).cast("array<int>").alias("same")))
    r = by_name.groupBy("report_id").agg(F.max("told").alias("told"), F.map_from_entries(F.collect_list(F.when(heard, entry))).alias("facts"), F.collect_list(F.when(heard & F.col("odd"), F.col("id"))).alias("odd_ids"), F.flatten(F.collect_list(F.when(heard, F.col("metrics")))).alias("all"))
    r = r.withColumn("clash", F.size(F.array_distinct("all")) < F.size("all"))
    same = F.transform_values("facts", lambda _, f: f.withField("same", F.map_keys(F.map_filter("facts", lambda _, g: g["metrics"] == f["metrics"]))))
    return r.select("report_id", "told", "clash", F.map_keys("facts").alias("ids"), "odd_ids", F.when(F.col("clash"), same).otherwise(F.col("facts")).alias("facts"))


def _met(profiles: DataFrame, shapes: DataFrame) -> DataFrame:
    """Each pair of a report and a shape with a name in common once, with ``present``, the names in common, and ``fact`` of the first."""
    rows = profiles.select("*", F.explode("facts").alias("id", "fact")).join(broadcast_if_small(shapes, MOST_SENT), "id")
    rows = rows.withColumn("present", F.when(F.size("names") == 1, F.col("names")).otherwise(F.array_intersect("names", "ids")))
    return rows.filter(F.col("id") == F.col("present")[0])


def named_facts(profiles: DataFrame, subjects: DataFrame, names: DataFrame, told_name: str, told_value: str) -> DataFrame:
    """:func:`condition_facts` where metrics are linked to nodes by name and ``told`` gives ``told_value`` for one name.

    ``subjects``: ``rule_id, node_id, name, is_state``. Of reports without a key nothing is known.
    """
    inputs = subjects.groupBy("rule_id", "name").agg(F.max("is_state").alias("is_state"))
    inputs = inputs.join(names, inputs["name"].eqNullSafe(names["name"])).select("rule_id", "id", inputs["name"].alias("name"), "is_state")
    rules = checkpointed(inputs.groupBy("rule_id").agg(F.sort_array(F.collect_set(F.struct("id", "name", "is_state"))).alias("inputs")))
    asked = _inputs_by_name(rules)
    if rules.select(F.explode("inputs")).limit(MOST_SENT + 1).count() <= MOST_SENT:
        asked = F.broadcast(asked)
    rows = profiles.select("report_id", "told", "ids", F.explode("facts").alias("id", "fact")).join(asked, "id")
    met = F.when(F.size("earlier") == 0, False).when(F.size("earlier") == 1, F.array_contains("ids", F.col("earlier")[0])).otherwise(F.arrays_overlap("earlier", "ids"))
    rows = rows.filter(~met).withColumn("i", F.explode("inputs")).filter(F.col("own") | ~F.array_contains("ids", F.col("i.id")))
    known = F.col("report_id").isNotNull()
    in_context = F.coalesce(known & F.col("told") & (F.col("i.name") == told_name), F.lit(False))
    n = F.when(known & F.col("own"), F.size("fact.metrics")).otherwise(0)
    state = F.coalesce(*[F.when(F.col("fact.flag") == k, F.lit(v)) for k, v in STATES.items()])
    value = F.when(in_context, told_value).when(n == 1, F.when(F.col("is_state"), state).otherwise(F.col("fact.value")))
    status = F.when(in_context, "ok").when(n == 0, "missing").when(n > 1, "ambiguous").when(F.col("is_state") & state.isNull(), "missing").otherwise("ok")
    rows = rows.select("report_id", "rules", F.col("i.name").alias("input"), status.alias("status"), value.alias("value"))
    return rows.select("report_id", F.explode("rules").alias("rule_id"), "input", "status", "value")


def _inputs_by_name(rules: DataFrame) -> DataFrame:
    """``id, own, is_state, earlier, inputs, rules``: what a report with the name ``id`` is asked, by ``rules`` with ``rule_id, inputs``.

    ``own`` rows ask for the name itself, a row for all rules that do so alike. The others ask for ``inputs`` that the report
    lacks, a row for all rules of the same names, at the first of their names that it has: where it has none of ``earlier``.
    """
    none, pair = F.array().cast("array<int>"), lambda i: F.struct(i["id"].alias("id"), i["name"].alias("name"))
    own = rules.select("rule_id", F.explode("inputs").alias("i")).groupBy("i").agg(F.sort_array(F.collect_list("rule_id")).alias("rules"))
    own = own.select("i.id", F.lit(True).alias("own"), "i.is_state", none.alias("earlier"), F.array(pair(F.col("i"))).alias("inputs"), "rules")
    sets = rules.filter(F.size("inputs") > 1).groupBy(F.transform("inputs", pair).alias("inputs")).agg(F.sort_array(F.collect_list("rule_id")).alias("rules"))
    sets = sets.select("*", F.posexplode("inputs.id").alias("at", "id"))
    return own.union(sets.select("id", F.lit(False), F.lit(None).cast("boolean"), F.slice("inputs.id", F.lit(1), F.col("at")), "inputs", "rules"))


def named_rules(subjects: DataFrame, edges: DataFrame, names: DataFrame, conclusion: tuple, context: tuple) -> DataFrame:
    """``rule_id, names, needed, needs, product, place, contexts`` of the rules with a conclusion.

    ``subjects``: ``rule_id, node_id, name, required``; ``edges``: ``rule_id, predicate, node_id, node_type``. ``needs`` are
    ``node_id, id`` of the subjects that must be there, the required ones where any is; ``needed`` their names.
    """
    yes = lambda c: F.coalesce(F.max(c), F.lit(False))
    is_context = F.col("predicate").isin(*context) & (F.col("node_type") == "Disease")
    kinds = edges.groupBy("rule_id").agg(
        yes(F.col("predicate").isin(*conclusion)).alias("concluded"), yes(F.col("predicate") == "PRODUCES").alias("product"), yes(F.col("node_type") == "ClinicalContext").alias("place"), F.count_distinct(F.when(is_context, F.col("node_id"))).alias("contexts")
    )
    s = subjects.join(names, subjects["name"].eqNullSafe(names["name"])).select("rule_id", "node_id", "id", "required")
    node = F.struct("node_id", "id")
    s = s.groupBy("rule_id").agg(F.sort_array(F.collect_set("id")).alias("names"), F.collect_set(F.when(F.col("required"), node)).alias("named"), F.collect_set(node).alias("subjects"))
    s = s.withColumn("needs", F.sort_array(F.when(F.size("named") > 0, F.col("named")).otherwise(F.col("subjects"))))
    return s.join(kinds.filter("concluded"), "rule_id").select("rule_id", "names", F.array_sort(F.array_distinct("needs.id")).alias("needed"), "needs", "product", "place", "contexts")


def named_paths(profiles: DataFrame, rules: DataFrame, prefix: str, role: str = "", dependencies: DataFrame | None = None, odd_only: bool = False) -> DataFrame:
    """:func:`reasoning_paths`, with ``dependencies`` then :func:`chained`, where metrics are linked to nodes by name.

    ``profiles``: a report that is ``told`` has the ``role`` of all rules with a ``place``; ``rules``: those of
    :func:`named_rules`, computed already; a rule with a ``product`` has cases, which match where one of its metrics is odd. The
    result has ``report_id, rule_id, odd, status`` and, without ``dependencies``, ``metrics, roles, missing``, with them ``verified``.
    ``dependencies``: ``producer, consumer, context``; of several producers of a context any may match. ``odd_only`` gives
    the paths whose case matches. Reports without a key have neither roles nor cases.
    """
    key, members = ["names", "needed", "product", "place", "pre"], ["rule_id", "needs"]
    rules = rules.withColumn("pre", F.col("contexts") > 0)
    if dependencies is not None:
        # a context that nothing produces stays open, and so does its rule
        made = dependencies.groupBy("consumer").agg(F.count_distinct("context").alias("made"))
        rules = rules.join(made, rules["rule_id"] == made["consumer"], "left").withColumn("chain", F.coalesce(F.col("made") == F.col("contexts"), F.lit(False)))
        produced = _paths_of(profiles, *rule_shapes(rules.join(dependencies.select(F.col("producer").alias("rule_id")), "rule_id", "left_semi"), key, ["rule_id"]))
        closed = dependencies.join(rules.filter("chain").select(F.col("rule_id").alias("consumer"), "contexts"), "consumer")
        told = produced.filter("report_id is not null").select("report_id", F.col("rule_id").alias("producer"), "odd").join(broadcast_if_small(closed, MOST_SENT), "producer")
        told = told.groupBy("report_id", "consumer", "contexts", "context").agg(F.max(F.coalesce("odd", F.lit(False))).alias("passed"))
        told = told.groupBy("report_id", "consumer", "contexts").agg(F.count(F.lit(1)).alias("n"), F.min("passed").alias("verified")).filter(F.col("n") == F.col("contexts"))
        told = told.groupBy("report_id").agg(F.map_from_entries(F.collect_list(F.struct("consumer", "verified"))).alias("v"))
        profiles = profiles.join(told, "report_id", "left")
        key, members = [*key, "chain"], ["rule_id"]
    rows = _paths_of(profiles, *rule_shapes(rules, key, members), odd_only)
    status = (
        F.when(F.size("absent") > 0, "partial")
        .when(F.col("odd") & F.col("pre"), "case-match-precondition-unverified")
        .when(F.col("odd"), "case-match")
        .when(~F.col("odd"), "no-case-match")
        .when(F.col("pre"), "precondition-unverified")
        .otherwise("complete")
    )
    status = F.concat(F.lit(f"{prefix}-"), status)
    if dependencies is not None:
        rows = rows.withColumn("verified", F.when(F.col("chain"), F.col("v")[F.col("rule_id")]))
        status = F.when(F.col("verified") & F.col("odd"), f"{prefix}-case-match-precondition-derived").when(~F.col("verified"), f"{prefix}-precondition-failed").otherwise(status)
        return rows.select("report_id", "rule_id", "odd", status.alias("status"), "verified")
    missing = F.when(F.size("absent") > 0, F.filter("needs", lambda x: F.array_contains("absent", x["id"]))["node_id"]).otherwise(F.array().cast("array<string>"))
    roles = F.when(F.col("role"), F.array(F.lit(role))).otherwise(F.array().cast("array<string>"))
    return rows.select("report_id", "rule_id", "odd", status.alias("status"), "metrics", roles.alias("roles"), missing.alias("missing"))


def _paths_of(profiles: DataFrame, shapes: DataFrame, members: DataFrame, odd_only: bool = False) -> DataFrame:
    """The pairs of reports and rules with two metrics, or one and a role, with what they have in common."""
    rows = _met(profiles, shapes)
    known = F.col("report_id").isNotNull()
    listed = F.sort_array(F.flatten(F.transform("present", lambda x: F.col("facts")[x]["metrics"])))
    one = F.size("present") == 1
    metrics = F.when(one, F.col("fact.metrics")).when(F.col("clash"), F.array_distinct(listed)).otherwise(listed)
    many = F.when(one, F.size("fact.metrics") >= 2).when(F.col("clash"), (F.size("fact.metrics") >= 2) | (F.size(F.array_except("present", "fact.same")) > 0)).otherwise(True)
    rows = rows.withColumn("role", F.col("told") & F.col("place") & known).filter(F.col("role") | many)
    rows = rows.withColumn("odd", F.when(F.col("product") & known, F.arrays_overlap("names", "odd_ids")))
    if odd_only:
        rows = rows.filter("odd")
    rows = rows.withColumn("absent", F.when(F.size("names") == 1, F.array().cast("array<int>")).otherwise(F.array_except("needed", "ids"))).withColumn("metrics", metrics)
    return rows.join(broadcast_if_small(members, MOST_SENT), "shape").drop("facts", "fact", "ids", "odd_ids", "present", "names", "needed")


def rule_issues(nodes: DataFrame) -> DataFrame:
    """``rule_id, node_id, issue`` of rule trees: what keeps a node from being executed.

    ``nodes``: ``rule_id, node_id, parent_id, kind, k, op, unit, anchor``; ``kind`` is ``atom`` or the connective. Unknown
    parents are no issue here; a connective without children is.
    """
    kids = nodes.filter("parent_id is not null").groupBy("rule_id", F.col("parent_id").alias("node_id")).agg(F.count(F.lit(1)).alias("n"))
    rows = nodes.join(kids, ["rule_id", "node_id"], "left")
    atom = F.col("kind") == "atom"
    compare = F.col("op").isin("lt", "le", "eq", "ge", "gt", "between", "in", "positive", "negative")
    logic = F.col("kind").isin("all", "any", "not", "at_least", "at_most")
    yes = lambda c: F.coalesce(c, F.lit(False))
    issues = F.array(
        F.when(F.col("anchor").isNull(), "missing_anchor"),
        F.when(atom & ~yes(compare), "unsupported_operator"),
        F.when(atom & F.col("unit").isNull() & ~yes(F.col("op").isin("positive", "negative")), "missing_unit"),
        F.when(~yes(atom) & (~yes(logic) | F.col("n").isNull()), "invalid_logic"),
        F.when(F.col("kind").isin("at_least", "at_most") & ~yes(F.col("k") >= 0), "invalid_threshold"),
    )
    return rows.select("rule_id", "node_id", F.explode(F.array_compact(issues)).alias("issue"))
