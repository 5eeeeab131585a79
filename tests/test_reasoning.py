import pytest
from pyspark.sql import functions as F

from quillon.functions import names as N
from quillon.operators.matching import case_scores, rule_matches, tier_scores
from quillon.operators.reasoning import chained, condition_facts, reasoning_paths, reportable, rule_issues
from quillon.operators.structures import best_ranks, cue_pairs, json_strings, missing_endpoints, smallest_shared, superseded
from quillon.operators.terms import annotate


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_names(spark):
    f = lambda fn, x: one(spark, fn(F.lit(x)))
    assert f(N.normal_name, r"\(\mathrm{A}_1\)&nbsp;（Ｂ：c） ß") == "a_1ｂcss" and f(N.normal_name, "") == "" and one(spark, N.normal_name(F.lit(None).cast("string"))) is None
    assert f(N.variant_key, " 平均血红蛋白量百分率 ") == "平均血红蛋白含量百分数" and f(N.surface, "抗体 为阳性") == "抗体阳性" and f(N.surface, "为人") == "为人"
    assert f(N.condition_error, "") == "invalid_condition" and f(N.condition_error, "a >= 3") == "unsupported_operator" and f(N.condition_error, "a is 3") == "missing_operator" and f(N.condition_error, "a GE 3") is None
    p = f(N.parsed_expression, " r = any(a, b，c) ")
    assert (p.output, p.name, p.inputs, p.error) == ("r", "any", ["a", "b", "c"], None)
    assert [f(N.parsed_expression, x).error for x in ("r", "r = f()", "r = f(a, a)")] == ["invalid_rule_expression", "missing_inputs", "duplicate_inputs"]
    assert f(N.layout_text, r"$10^{9}$ \mathrm{g}\cdot L") == "10^9g*L" and f(N.layout_unit, "mmol/") is None and f(N.layout_unit, r"$\mu$mol/L") == "μmol/L" and f(N.layout_unit, "null") is None
    m = f(N.report_metadata, "某市医院 检验报告单\n性别：女 年龄: 41 科室:内科\n2024年3月9日 标本类型：血清")
    assert (m.hospital, str(m.report_date), m.patient_sex, m.patient_age_years, m.sample_type, m.department) == ("某市医院", "2024-03-09", "女", 41, "血清", "内科")
    assert f(N.report_metadata, "2024年13月9日 年龄 230").report_date is None and f(N.report_metadata, "年龄 230").patient_age_years is None
    link = lambda r, e, t: one(spark, N.result_linked(F.lit(r), F.lit(e), F.lit(t)))
    assert link("high", "is high", "x") and link("anaemia", "Hb < 100", "1、anaemia\nHb < 100") and not link("anaemia", "Hb < 100", "anaemia.\nHb < 100") and not link("anaemia", "Hb < 100", "anaemia Hb < 100")
    assert f(N.state_base, "血钾升高明显") == "血钾" and one(spark, N.category_error(F.lit("MethodOrDrug"), F.lit("血液检查"))) is not None and one(spark, N.category_error(F.lit("Disease"), F.lit("人"))) == "generic term is not an entity"


def test_condition_facts(spark):
    asked = spark.createDataFrame([("r", "u", "a", "n1", False), ("r", "u", "b", "n2", False), ("r", "u", "b", "n3", False), ("r", "u", "c", None, False), ("r", "u", "d", "n1", True), ("r", "u", "e", "n9", False), ("r", "u", "f", "n4", True)], "report_id string, rule_id string, input string, node_id string, is_state boolean")
    links = spark.createDataFrame([("r", "n1", "m1", "5", "high")] * 2 + [("r", "n2", "m2", "1", None), ("r", "n3", "m3", "2", None), ("r", "n4", "m4", "2", "odd"), (None, "n1", "m9", "7", None)], "report_id string, node_id string, metric_id string, value string, flag string")
    context = spark.createDataFrame([("r", "e", "told")], "report_id string, input string, value string")
    out = {r.input: (r.status, r.value) for r in condition_facts(asked, links, context).collect()}
    assert out == {"a": ("ok", "5"), "b": ("ambiguous", None), "c": ("missing", None), "d": ("ok", "升高"), "e": ("ok", "told"), "f": ("missing", None)}
    assert condition_facts(asked.limit(0), links, context).count() == 0


def test_paths_and_chains(spark):
    links = spark.createDataFrame([("r", "n1", "m1"), ("r", "n2", "m2"), ("r", "n2", "m2"), ("s", "n1", "m1"), (None, "n1", "m1")], "report_id string, node_id string, metric_id string")
    subjects = spark.createDataFrame([("u", "n1", False), ("u", "n2", False), ("v", "n1", True), ("v", "n2", False), ("v", "n3", False), ("w", "n1", False), ("w", "n2", False), ("x", "n1", False), ("x", "n2", False), ("x", "n3", False)], "rule_id string, node_id string, required boolean")
    conclusions = spark.createDataFrame([(x, "z") for x in "uvx"], "rule_id string, node_id string")
    rules = spark.createDataFrame([("v", 1)], "rule_id string, preconditions int")
    context = spark.createDataFrame([("s", "u", "age")], "report_id string, rule_id string, role string")
    outcomes = spark.createDataFrame([("r", "u", "case_match"), ("r", "v", "case_match")], "report_id string, rule_id string, outcome string")
    p = reasoning_paths(links, subjects, conclusions, rules, context, outcomes, "final")
    got = {(r.report_id, r.rule_id): (r.metrics, r.missing, r.status) for r in p.collect()}
    assert got == {("r", "u"): (["m1", "m2"], [], "final-case-match"), ("r", "v"): (["m1", "m2"], [], "final-case-match-precondition-unverified"), ("r", "x"): (["m1", "m2"], ["n3"], "final-partial"), ("s", "u"): (["m1"], ["n2"], "final-partial")}
    paths = p.join(outcomes, ["report_id", "rule_id"], "left").withColumn("result", F.lit("yes"))
    need = spark.createDataFrame([("v", "c")], "rule_id string, context string")
    dep = lambda result: spark.createDataFrame([("u", "v", "c", result)], "producer string, consumer string, context string, result string")
    status = lambda d: {r.rule_id: (r.status, r.verified) for r in chained(paths, d, need, "final").filter("report_id = 'r'").collect()}
    assert status(dep("yes"))["v"] == ("final-case-match-precondition-derived", True) and status(dep("no"))["v"] == ("final-precondition-failed", False)
    assert status(dep("yes").limit(0))["v"] == ("final-case-match-precondition-unverified", None) and status(dep("yes"))["x"] == ("final-partial", None)
    assert {r.rule_id for r in reportable(chained(paths, dep("yes"), need, "final")).collect()} == {"u", "v"}


def test_rule_issues(spark):
    nodes = [("a", "r", None, "all", None, None, None, "q"), ("a", "x", "r", "atom", None, "lt", "g/L", "q"), ("a", "y", "r", "atom", None, "near", None, None), ("b", "r", None, "at_least", -1, None, None, "q"), ("c", "r", None, "atom", None, "positive", None, "q")]
    out = sorted((r.rule_id, r.node_id, r.issue) for r in rule_issues(spark.createDataFrame(nodes, "rule_id string, node_id string, parent_id string, kind string, k int, op string, unit string, anchor string")).collect())
    assert out == [("a", "y", "missing_anchor"), ("a", "y", "missing_unit"), ("a", "y", "unsupported_operator"), ("b", "r", "invalid_logic"), ("b", "r", "invalid_threshold")]


def test_structures(spark):
    words = spark.createDataFrame([("ab",), ("b c",), ("x",), (None,), ("",), ("ab",)], "word string")
    texts = spark.createDataFrame([("1", "ab c ab, abc b c"), ("2", None), ("3", ""), ("4", "x" + " ab" * 3)], "id string, text string")
    assert sorted((r.id, r.word, r.start) for r in annotate(texts, words).collect()) == [("1", "ab", 0), ("1", "ab", 5), ("1", "b c", 13), ("4", "ab", 2), ("4", "ab", 5), ("4", "ab", 8), ("4", "x", 0)]
    with pytest.raises(ValueError, match="dictionary"):
        annotate(texts, words, 2)
    assert annotate(texts, words.limit(0)).count() == 0
    m = spark.createDataFrame([("t", "a", 0, 1), ("t", "b", 5, 6), ("t", "c", 2, 3), ("t", "a", 8, 9)], "id string, word string, start int, end int")
    cues = spark.createDataFrame([("t", 3, 5)], "id string, start int, end int")
    assert {(r.a, r.b): r.opposite for r in cue_pairs(m, cues, ["id"]).collect()} == {("a", "b"): True, ("a", "c"): True, ("b", "c"): True}
    units = spark.createDataFrame([("t", 0, 4), ("t", 4, 9), ("t", 0, 9)], "id string, u_start int, u_end int")
    assert {(r.a, r.b): (r.unit_start, r.unit_end) for r in smallest_shared(m, units).collect()} == {("a", "b"): (4, 9), ("a", "c"): (0, 4), ("b", "c"): (0, 9)}
    r = spark.createDataFrame([("t", "n", 2), ("t", "n", 1), ("t", "o", 1), ("t", "p", 3), (None, "p", 0)], "k string, node_id string, rank int")
    assert sorted((x.k, x.node_id) for x in best_ranks(r, "k").collect()) == [("t", "n"), ("t", "o")]
    e = spark.createDataFrame([("1", "n", "P", "o"), ("2", "n", "P", None), ("3", "n", "P", "gone"), ("3", "n", "P", "gone")], "triple_id string, subject_id string, predicate string, object_id string")
    n = spark.createDataFrame([("n", "x"), ("o", "y")], "node_id string, place string")
    assert sorted((x.triple_id, x.side, x.node_id) for x in missing_endpoints(e, n).collect()) == [("2", "object", None), ("3", "object", "gone")]
    assert {x.triple_id: x.reason for x in superseded(e, e.filter("triple_id = '9'"), n).collect()} == {"1": "cross_place", "2": "dangling", "3": "dangling"}
    assert superseded(e.filter("triple_id = '1'"), e, n).count() == 0
    j = spark.createDataFrame([("a", '[{"x": "1", "y": [true, "2"]}, "3", null]'), ("b", '"z"'), ("c", "no json"), ("d", None)], "k string, j string")
    assert sorted((x.k, x.path, x.text) for x in json_strings(j, "k", "j").collect()) == [("a", "0.x", "1"), ("a", "0.y.1", "2"), ("a", "1", "3"), ("b", "", "z")]
    with pytest.raises(ValueError, match="deeper"):
        json_strings(j, "k", "j", 2)


def test_scores(spark):
    schema = "s_type string, s_name string, predicate string, o_type string, o_name string"
    p = spark.createDataFrame([("T", "a", "P", "T", "b"), ("T", "a", "P", "T", "b"), ("T", "a", "Q", "T", "b"), ("T", "c", "P", "T", "d")], schema)
    g = spark.createDataFrame([("T", "a", "P", "T", "b"), ("T", "a", "Q", "T", "b"), ("T", "e", "Q", "T", "b")], schema)
    out = {(r.case, r.kind): (r.tp, r.fp, r.fn, r.f1) for r in case_scores(p, g, "s_type").collect()}
    assert out == {("T", "entity"): (1, 1, 1, 0.5), ("T", "relation"): (2, 1, 1, round(2 / 3, 6))}
    tiers = {r.tier: (r.tp, r.fp, r.fn) for r in tier_scores(p, g, {"one": ("P",), "two": ("Q",)}).collect()}
    assert tiers == {"one": (1, 1, 0), "two": (1, 1, 1)}
    assert {r.tier: r.f1 for r in tier_scores(p.limit(0), g.limit(0), {"one": ("P",)}).collect()} == {"one": 1.0}
    rules = lambda x: spark.createDataFrame(x, "rule string, inputs array<string>, outputs array<string>")
    r = rule_matches(rules([("u", ["a"], ["z"]), ("v", ["a", "b"], ["z"])]), rules([("u", ["a", "b"], ["z"]), ("v", ["a"], ["y"]), ("w", [], [])])).collect()
    assert sorted((x.rule, x.outputs_equal, x.inputs_within, x.inputs_equal) for x in r) == [("u", True, True, False), ("v", False, False, False)]


@pytest.mark.parametrize("sent", [500_000, 0])
def test_named_rules_against_pairs(spark, monkeypatch, sent):
    """The queries by name give what the operators over pairs give, and shuffle no pairs."""
    import random

    from quillon.operators import reasoning as R

    monkeypatch.setattr(R, "MOST_SENT", sent)
    rng = random.Random(7)
    names = ["a", "a/b", "c", "c d", "e"]
    obs = [(r, rng.choice([*names, "z", None]), rng.choice(["b", "x", None]), str(rng.randrange(3)), rng.choice(["high", "low", "normal", "odd", None]), rng.choice(["serum", "plasma", None])) for r in [*map(str, range(30))] for _ in range(rng.randrange(1, 7))]
    obs += [("twin", "a", "b", "1", "high", "plasma"), ("twin", "a/b", None, "2", None, None)]
    o = spark.createDataFrame([*obs, *obs], "report_id string, name string, abbreviation string, value string, flag string, sample_type string").withColumn("metric_id", F.concat_ws("/", "name", "abbreviation"))
    nodes = [(f"n{i}", rng.choice([*names, None])) for i in range(12)]
    subjects = [(f"u{i:02}", n, name, rng.random() < 0.4, rng.random() < 0.5) for i in range(25) for n, name in rng.sample(nodes, rng.randrange(1, 4))] + [("twins", "p", "a", False, False), ("twins", "q", "a/b", False, False)]
    s = spark.createDataFrame(subjects, "rule_id string, node_id string, name string, required boolean, is_state boolean")
    kinds = [("PRODUCES", "Disease"), ("SUGGESTS", "Disease"), ("EXCLUDES", "Disease"), ("PART_OF", "Disease"), ("OBSERVED_IN", "Disease"), ("USES", "ClinicalContext"), ("USES", None)]
    edges = [(f"u{i:02}", p, f"d{rng.randrange(5)}", t) for i in range(25) for p, t in rng.sample(kinds, rng.randrange(1, 5))] + [("twins", "EXCLUDES", "d", "Disease")]
    e = spark.createDataFrame(edges, "rule_id string, predicate string, node_id string, node_type string")
    # the tables of pairs
    m = o.filter("name is not null").groupBy("report_id", "name", "metric_id").agg(F.min("value").alias("value"), F.max("flag").alias("flag"))
    links = m.join(s.select("node_id", "name").distinct(), "name").select("report_id", "node_id", "metric_id", "value", "flag")
    heard = links.join(s, "node_id").select("report_id", "rule_id").distinct()
    serum = o.filter("sample_type = 'serum'").select("report_id").distinct()
    told = o.filter("sample_type = 'serum' and name = 'c'").select("report_id", F.lit("c").alias("input"), F.lit("serum").alias("value")).distinct()
    asked = heard.join(s.select("rule_id", F.col("name").alias("input"), "node_id", "is_state"), "rule_id")
    numbers = R.name_numbers(s)
    rows = lambda df: sorted(map(str, df.collect()))
    facts = R.named_facts(R.report_profiles(o, numbers, (F.col("sample_type") == "serum") & (F.col("name") == "c"), 3), s, numbers, "c", "serum")
    assert rows(facts) == rows(R.condition_facts(asked, links, told)) and facts.count() > 100
    flags = links.join(s.select("rule_id", "node_id"), "node_id").join(e.filter("predicate = 'PRODUCES'").select("rule_id").distinct(), "rule_id")
    outcomes = flags.groupBy("report_id", "rule_id").agg(F.max(F.coalesce(F.col("flag").isin("high", "low"), F.lit(False))).alias("odd")).select("report_id", "rule_id", F.when(F.col("odd"), "case_match").otherwise("no_case_match").alias("outcome"), F.when(F.col("odd"), "abnormal").alias("result"))
    is_context = F.col("predicate").isin("PART_OF", "OBSERVED_IN") & (F.col("node_type") == "Disease")
    contexts = e.filter(is_context).select("rule_id", F.col("node_id").alias("context")).distinct()
    roles = heard.join(e.filter("node_type = 'ClinicalContext'").select("rule_id").distinct(), "rule_id").join(serum, "report_id").withColumn("role", F.lit("serum"))
    concluded = e.filter("predicate in ('PRODUCES', 'SUGGESTS', 'EXCLUDES')").select("rule_id", "node_id")
    want = reasoning_paths(links, s, concluded, contexts.groupBy("rule_id").agg(F.count(F.lit(1)).alias("preconditions")), roles, outcomes, "final")
    rules = R.named_rules(s, e, numbers, ("PRODUCES", "SUGGESTS", "EXCLUDES"), ("PART_OF", "OBSERVED_IN"))
    profiles = R.report_profiles(o, numbers, F.col("sample_type") == "serum", 3)
    got = R.named_paths(profiles, rules, "final", "serum")
    assert rows(got.select(*want.columns)) == rows(want) and got.count() > 50 and not any(r.rule_id == "twins" and r.report_id == "twin" for r in got.collect())
    made = e.filter("predicate in ('PRODUCES', 'SUGGESTS')").select(F.col("rule_id").alias("producer"), F.col("node_id").alias("context")).distinct()
    needs = made.join(contexts.withColumnRenamed("rule_id", "consumer"), "context").filter("producer <> consumer").select("producer", "consumer", "context")
    want = chained(want.join(outcomes, ["report_id", "rule_id"], "left"), needs.withColumn("result", F.lit("abnormal")), contexts, "final").select("report_id", "rule_id", "status", "verified")
    got = R.named_paths(profiles, rules, "final", "serum", needs)
    assert rows(got.select(*want.columns)) == rows(want) and {True, False, None} == {r.verified for r in got.collect()}
    odd = R.named_paths(profiles, rules, "final", "serum", needs, odd_only=True)
    assert rows(reportable(odd).select("report_id", "rule_id", "status")) == rows(reportable(want).select("report_id", "rule_id", "status"))


@pytest.mark.parametrize("query", ["rul09_facts", "rul11_paths", "rul12_chained", "flt13_reportable"])
def test_no_pairs_are_shuffled(spark, query):
    """No exchange of these queries has the rows of both reports and rules: the rules are sent, the reports placed once."""
    from quillon.plans.reasoning import QUERIES

    df = QUERIES[query](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    placed = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "report_id" in x]
    assert placed and all("REPARTITION_BY_NUM" in x for x in placed)


@pytest.mark.parametrize("query", ["rul09_facts", "flt13_reportable", "rul11_paths"])
def test_pairs_stay_off_the_disk(spark, tmp_path, query):
    """500 reports that all meet 200 rules: 100,000 rows, of which none is shuffled or spilled."""
    from quillon.plans.reasoning import QUERIES

    nodes = [*((f"u{i}", "RuleDefinition", f"u{i}") for i in range(200)), ("m", "LabIndicator", "Urea"), ("d", "Disease", "d")]
    edges = [(f"u{i}", p, n) for i in range(200) for p, n in (("USES", "m"), ("PRODUCES", "d"))]
    obs = [(f"r{i}", "Urea", a, "1", "high", "serum") for i in range(500) for a in ("U", "V")]
    spark.createDataFrame(nodes, "node_id string, node_type string, name string").selectExpr("*", "timestamp'2024-01-01' created_at", "cast(null as timestamp) deleted_at").write.parquet(f"{tmp_path}/nodes.parquet")
    spark.createDataFrame(edges, "subject_id string, predicate string, object_id string").selectExpr("*", *(f"'' {c}" for c in ("triple_id", "layer", "status", "properties_json", "evidence_json", "origins_json")), "timestamp'2024-01-01' created_at").write.parquet(f"{tmp_path}/edges.parquet")
    spark.createDataFrame(obs, "report_id string, standard_name string, abbreviation string, value string, report_flag string, sample_type string").selectExpr("monotonically_increasing_id() obs_id", "*").write.parquet(f"{tmp_path}/observation.parquet")
    sc = spark.sparkContext

    def stages() -> dict[int, tuple[int, int]]:
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        rows = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {rows.apply(i).stageId(): (rows.apply(i).shuffleWriteRecords(), rows.apply(i).diskBytesSpilled()) for i in range(rows.size())}

    before = stages()
    QUERIES[query](spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    new = [x for k, x in stages().items() if k not in before]
    assert spark.read.parquet(f"{tmp_path}/out").distinct().count() == 100_000
    assert 0 < sum(records for records, _ in new) < 20_000 and not any(spilled for _, spilled in new)


def test_joins_of_facts_have_no_row_per_rule(spark):
    """100 reports, one of them without a key, and 100 rules with one or two names: pairs are made by the last operator only."""
    from quillon.operators import reasoning as R

    obs = [(f"r{i}" if i else None, name, "m", "1", "high") for i in range(100) for name in ("a", "b")[: 1 + i % 2]]
    o = spark.createDataFrame(obs, "report_id string, name string, metric_id string, value string, flag string")
    s = spark.createDataFrame([(f"u{i}", n, n, n == "b") for i in range(100) for n in ("a", "b")[: 1 + i // 50]], "rule_id string, node_id string, name string, is_state boolean")
    numbers = R.name_numbers(s)
    facts = R.named_facts(R.report_profiles(o, numbers, F.col("name") == "b", 3), s, numbers, "b", "told")
    got = sorted(map(str, facts.collect()))

    def joined(p) -> int:
        kind = p.getClass().getSimpleName()
        kids = [p.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [p.plan()] if kind.endswith("QueryStageExec") else [p.children().apply(i) for i in range(p.children().size())]
        return (p.metrics().apply("numOutputRows").value() if "Join" in kind else 0) + sum(map(joined, kids))

    links = o.join(s.select("node_id", "name").distinct(), "name").select("report_id", "node_id", "metric_id", "value", "flag")
    asked = links.join(s, "node_id").select("report_id", "rule_id").distinct().join(s.select("rule_id", F.col("name").alias("input"), "node_id", "is_state"), "rule_id")
    told = o.filter("name = 'b'").select("report_id", F.lit("b").alias("input"), F.lit("told").alias("value")).distinct()
    assert got == sorted(map(str, R.condition_facts(asked, links, told).collect())) and len(got) == 15_000
    assert 0 < joined(facts._jdf.queryExecution().executedPlan()) < 2_000
