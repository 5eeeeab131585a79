"""Queries of rules over the graph and of the scoring of one layer of the graph against another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.operators.matching import case_scores, layered_scores, project_relations, project_rules, rule_matches, tier_scores
from quillon.operators.reasoning import endpoint_mismatches, name_numbers, named_facts, named_paths, named_rules, report_profiles, reportable, rule_issues
from quillon.plans.graph import _edges
from quillon.plans.retrieval import ND, live_nodes
from quillon.plans.rules import RULE_SCHEMA, RULES
from quillon.session import checkpointed
from quillon.sources.tables import table

SUBJECT, CONCLUSION, CONTEXT = ("USES", "HAS_METRIC", "HAS_STATE", "OBSERVED_IN", "PART_OF"), ("PRODUCES", "SUGGESTS", "EXCLUDES"), ("OBSERVED_IN", "PART_OF")
TIERS = {"state": ("HAS_STATE", "HAS_METRIC", "PART_OF", "OBSERVED_IN", "USES"), "claim": ("PRODUCES", "SUGGESTS", "EXCLUDES")}


def _rule_edges(spark: SparkSession, d: str) -> DataFrame:
    """``rule_id, predicate, node_id, node_type, name`` of the edges that leave rules for live nodes."""
    n = live_nodes(spark, d)
    e = table(spark, d, "edges").select("subject_id", "predicate", "object_id").distinct()
    e = e.join(n.filter("node_type = 'RuleDefinition'").select(F.col("node_id").alias("subject_id")), "subject_id")
    return e.join(n.select(F.col("node_id").alias("object_id"), "node_type", "name"), "object_id").select(F.col("subject_id").alias("rule_id"), "predicate", F.col("object_id").alias("node_id"), "node_type", "name")


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return _subjects_of(_rule_edges(spark, d))


def _subjects_of(e: DataFrame) -> DataFrame:
    e = e.filter(F.col("predicate").isin(*SUBJECT) & (F.col("node_type") == "LabIndicator"))
    return e.groupBy("rule_id", "node_id", "name").agg(F.max(F.col("predicate") == "USES").alias("required"), F.max(F.col("predicate") == "HAS_STATE").alias("is_state"))


def _profiles(spark: SparkSession, d: str, names: DataFrame, told: Column, finer: int = 1) -> DataFrame:
    """The reports, in ``finer`` times the partitions of a shuffle where what is made of them takes much longer than they."""
    o = table(spark, d, "observation").select("report_id", F.col("standard_name").alias("name"), F.concat_ws("/", "standard_name", "abbreviation").alias("metric_id"), "value", F.col("report_flag").alias("flag"), "sample_type")
    return report_profiles(o, names, told, finer * int(spark.conf.get("spark.sql.shuffle.partitions")))


def rul09_facts(spark: SparkSession, d: str) -> DataFrame:
    """What the reports that speak to a rule know about each of its inputs."""
    subjects = checkpointed(_subjects(spark, d))
    names = name_numbers(subjects)
    return named_facts(_profiles(spark, d, names, (F.col("sample_type") == "serum") & (F.col("name") == "Sodium"), 4), subjects, names, "Sodium", "serum")


def _paths(spark: SparkSession, d: str, chain: bool = False, odd_only: bool = False) -> DataFrame:
    """The paths; a rule with a product has the cases abnormal and not. With ``chain`` after one hop of preconditions."""
    e = checkpointed(_rule_edges(spark, d))
    subjects = _subjects_of(e)
    names = checkpointed(name_numbers(subjects))
    rules = checkpointed(named_rules(subjects, e, names, CONCLUSION, CONTEXT))
    needs = None
    if chain:
        contexts = e.filter(F.col("predicate").isin(*CONTEXT) & (F.col("node_type") == "Disease")).select(F.col("rule_id").alias("consumer"), F.col("node_id").alias("context")).distinct()
        made = e.filter("predicate in ('PRODUCES', 'SUGGESTS')").select(F.col("rule_id").alias("producer"), F.col("node_id").alias("context")).distinct()
        needs = checkpointed(made.join(contexts, "context").filter("producer <> consumer").select("producer", "consumer", "context"))
    return named_paths(_profiles(spark, d, names, F.col("sample_type") == "serum"), rules, "final", "serum", needs, odd_only)


def rul11_paths(spark: SparkSession, d: str) -> DataFrame:
    """The rules that each report speaks to, with matched and missing inputs and the status."""
    return _paths(spark, d).select("report_id", "rule_id", F.concat_ws("|", "metrics").alias("metrics"), F.concat_ws("|", "roles").alias("roles"), F.concat_ws("|", "missing").alias("missing"), "status")


def rul11_rejections(spark: SparkSession, d: str) -> DataFrame:
    """Rules whose subject edge leads to another indicator than the name it declares means; the first subject of a rule gives the name."""
    s = _subjects(spark, d)
    first = s.groupBy("rule_id").agg(F.min("name").alias("term"))
    n = live_nodes(spark, d).filter("node_type = 'LabIndicator'").select(F.col("node_id").alias("term_node_id"), F.col("name").alias("term"))
    terms = s.filter("required").select("rule_id", "node_id").join(first, "rule_id").join(n, "term").select("rule_id", "node_id", "term_node_id")
    return endpoint_mismatches(s.select("rule_id", "node_id"), terms)


def rul12_chained(spark: SparkSession, d: str) -> DataFrame:
    """Paths after one hop of preconditions."""
    return _paths(spark, d, chain=True).select("report_id", "rule_id", "status", "verified")


def flt13_reportable(spark: SparkSession, d: str) -> DataFrame:
    """Paths that lead to a conclusion; in a final graph only those whose case matches do."""
    return reportable(_paths(spark, d, chain=True, odd_only=True)).select("report_id", "rule_id", "status")


def rul03_issues(spark: SparkSession, d: str) -> DataFrame:
    """What keeps the rule trees of these queries from being executed as they are: none has an anchor or a unit."""
    nodes = spark.createDataFrame(RULES, RULE_SCHEMA).select("rule_id", "node_id", "parent_id", "kind", "k", "op", F.lit(None).cast("string").alias("unit"), F.when(F.col("kind") == "atom", F.lit("quote")).alias("anchor"))
    return rule_issues(nodes)


def _named(spark: SparkSession, d: str) -> DataFrame:
    """``layer, s_type, s_name, predicate, o_type, o_name`` of edges between live nodes."""
    return project_relations(_edges(spark, d), live_nodes(spark, d))


def match02_relations(spark: SparkSession, d: str) -> DataFrame:
    """Relations of each layer by the names and types of their ends, each once."""
    return _named(spark, d)


def match02_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of each layer by the names of their inputs and outputs."""
    return _rules(spark, d).select("layer", "rule", F.concat_ws("|", "inputs").alias("inputs"), F.concat_ws("|", "outputs").alias("outputs"))


def _rules(spark: SparkSession, d: str) -> DataFrame:
    return project_rules(_named(spark, d), "IndicatorState", SUBJECT, CONCLUSION)


def match04_rule_matches(spark: SparkSession, d: str) -> DataFrame:
    """Which rules of the candidate layer match a rule of the official layer with the same name, by inputs and outputs."""
    r = _rules(spark, d)
    return rule_matches(r.filter("layer = 'candidate'"), r.filter("layer = 'official'"))


def match05_case_scores(spark: SparkSession, d: str) -> DataFrame:
    """The candidate layer against the official one, per subject type: entities and relations, exactly by name."""
    r = _named(spark, d)
    return case_scores(r.filter("layer = 'candidate'"), r.filter("layer = 'official'"), "s_type")


def match06_layers(spark: SparkSession, d: str) -> DataFrame:
    """The candidate layer against the official one by mentions, canonical entities, links and relations."""
    r = _named(spark, d)
    return layered_scores(r.filter("layer = 'candidate'"), r.filter("layer = 'official'"))


def agg37_tiers(spark: SparkSession, d: str) -> DataFrame:
    """The candidate layer against each tier of the official one; what meets the other tier's targets is ignored."""
    r = _named(spark, d)
    return tier_scores(r.filter("layer = 'candidate'"), r.filter("layer = 'official'"), TIERS)


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_RE = f"""{ND}, re as (select distinct subject_id rule_id, predicate, object_id node_id, o.node_type node_type, o.name as name from edges join nd s on s.node_id = subject_id and s.node_type = 'RuleDefinition' join nd o on o.node_id = object_id),
su as (select rule_id, node_id, name, bool_or(predicate = 'USES') required, bool_or(predicate = 'HAS_STATE') is_state from re where predicate in {_in(SUBJECT)} and node_type = 'LabIndicator' group by 1, 2, 3),
mf as (select report_id, standard_name, concat_ws('/', standard_name, abbreviation) metric_id, min(value) as value, max(report_flag) flag from observation where standard_name is not null group by 1, 2, 3),
li as (select distinct report_id, node_id, metric_id, value, flag from mf join nd on node_type = 'LabIndicator' and name = standard_name)"""
_PA = f"""{_RE}, oc as (select report_id, rule_id, bool_or(coalesce(flag in ('high', 'low'), false)) odd from li join su using (node_id) where rule_id in (select rule_id from re where predicate = 'PRODUCES') group by 1, 2),
cx as (select distinct rule_id, node_id context from re where predicate in {_in(CONTEXT)} and node_type = 'Disease'),
ro as (select distinct report_id, rule_id from li join su using (node_id) where rule_id in (select rule_id from re where node_type = 'ClinicalContext') and report_id in (select report_id from observation where sample_type = 'serum')),
ne as (select rule_id, case when count(*) filter (required) > 0 then list(distinct node_id) filter (required) else list(distinct node_id) end need from su where rule_id in (select rule_id from re where predicate in {_in(CONCLUSION)}) group by 1),
th as (select report_id, rule_id, list(distinct metric_id order by metric_id) metrics, list(distinct node_id) matched from li join su using (node_id) group by 1, 2),
p0 as (select report_id, rule_id, metrics, ro.rule_id is not null has_role, list_sort(list_filter(need, lambda x: not list_contains(matched, x))) missing, odd, rule_id in (select rule_id from cx) pre
 from th join ne using (rule_id) left join ro using (report_id, rule_id) left join oc using (report_id, rule_id)),
pa as (select report_id, rule_id, array_to_string(metrics, '|') metrics, case when has_role then 'serum' else '' end roles, array_to_string(missing, '|') missing, odd,
 'final-' || case when len(missing) > 0 then 'partial' when odd and pre then 'case-match-precondition-unverified' when odd then 'case-match' when not odd then 'no-case-match' when pre then 'precondition-unverified' else 'complete' end status
 from p0 where len(metrics) >= 2 or has_role)"""
_CH = f"""{_PA}, dp as (select distinct m.rule_id producer, cx.rule_id consumer, context from re m join cx on m.node_id = context where m.predicate in ('PRODUCES', 'SUGGESTS') and m.rule_id <> cx.rule_id),
tl as (select pa.report_id, consumer, context, bool_or(coalesce(odd, false)) passed from dp join pa on pa.rule_id = producer group by 1, 2, 3),
ve as (select pa.report_id, pa.rule_id, case when count(passed) = count(*) then bool_and(passed) end verified from pa join cx using (rule_id) left join tl on tl.report_id = pa.report_id and consumer = pa.rule_id and tl.context = cx.context group by 1, 2),
pc as (select report_id, rule_id, case when verified and odd then 'final-case-match-precondition-derived' when not verified then 'final-precondition-failed' else status end status, verified from pa left join ve using (report_id, rule_id))"""
_NR = f"""{ND}, nr as (select distinct layer, s.node_type s_type, s.name s_name, predicate, o.node_type o_type, o.name o_name from edges join nd s on s.node_id = subject_id join nd o on o.node_id = object_id)"""
_RU = f"""{_NR}, ru as (select layer, s_name as rule, coalesce(list(distinct o_name order by o_name) filter (predicate in {_in(SUBJECT)}), []) inputs, coalesce(list(distinct o_name order by o_name) filter (predicate in {_in(CONCLUSION)}), []) outputs from nr where s_type = 'IndicatorState' group by 1, 2)"""
_F1 = """case when tp + fp > 0 then round(tp / (tp + fp), 6) when fn = 0 then 1.0 else 0.0 end "precision", case when tp + fn > 0 then round(tp / (tp + fn), 6) else 1.0 end recall, case when tp > 0 then round(2 * tp / (2 * tp + fp + fn), 6) when fp + fn = 0 then 1.0 else 0.0 end f1"""
SQL = {
    "rul09_facts": f"""with {_RE}, he as (select distinct report_id, rule_id from li join su using (node_id)), g as (select report_id, rule_id, su.name input, bool_or(is_state) is_state, count(distinct metric_id) n, min(li.value) v, min(flag) f
 from he join su using (rule_id) left join li using (report_id, node_id) group by 1, 2, 3), c as (select distinct report_id, 'Sodium' input from observation where sample_type = 'serum' and standard_name = 'Sodium'),
s as (select g.*, c.input is not null told, case f when 'high' then '升高' when 'low' then '降低' when 'normal' then '正常' end st from g left join c using (report_id, input))
select report_id, rule_id, input, case when told then 'ok' when n = 0 then 'missing' when n > 1 then 'ambiguous' when is_state and st is null then 'missing' else 'ok' end status, case when told then 'serum' when n = 1 then case when is_state then st else v end end as value from s""",
    "rul11_paths": f"with {_PA} select report_id, rule_id, metrics, roles, missing, status from pa",
    "rul11_rejections": f"""with {_RE}, t as (select rule_id, min(name) term from su group by 1), d as (select s.rule_id, s.node_id, bool_or(nd.node_id = s.node_id) fits from su s join t using (rule_id) join nd on nd.name = term and nd.node_type = 'LabIndicator' where required group by 1, 2)
select distinct rule_id, 'subject_endpoint_mismatch' reason from d where not fits""",
    "rul12_chained": f"with {_CH} select * from pc",
    "flt13_reportable": f"with {_CH} select report_id, rule_id, status from pc where status in ('final-case-match', 'final-case-match-precondition-derived')",
    "match02_relations": f"with {_NR} select * from nr",
    "match02_rules": f"with {_RU} select layer, rule, array_to_string(inputs, '|') inputs, array_to_string(outputs, '|') outputs from ru",
    "match04_rule_matches": f"""with {_RU} select c.rule, c.outputs = o.outputs outputs_equal, list_has_all(o.inputs, c.inputs) inputs_within, c.inputs = o.inputs inputs_equal from ru c join ru o using (rule) where c.layer = 'candidate' and o.layer = 'official'""",
    "match05_case_scores": f"""with {_NR}, x as (select distinct layer, s_type as "case", 'entity' kind, s_name k from nr union all select distinct layer, s_type, 'relation', s_name || chr(31) || predicate || chr(31) || o_type || chr(31) || o_name from nr),
y as (select "case", kind, k, bool_or(layer = 'candidate') p, bool_or(layer = 'official') g from x where layer in ('candidate', 'official') group by 1, 2, 3),
z as (select "case", kind, count(*) filter (p and g) tp, count(*) filter (p and not g) fp, count(*) filter (g and not p) fn from y group by 1, 2) select "case", kind, tp, fp, fn, {_F1} from z""",
    "match06_layers": f"""with {_NR}, e as (select layer, unnest([s_type, o_type]) t, unnest([s_name, o_name]) n from nr), x as (select distinct layer l, 'mention' kind, n k from e union all select distinct layer, 'canonical', t || chr(31) || regexp_replace(n, '\\s+', '', 'g') from e union all select distinct layer, 'link', n || chr(31) || t from e
 union all select distinct layer, 'relation', s_type || chr(31) || regexp_replace(s_name, '\\s+', '', 'g') || chr(31) || predicate || chr(31) || o_type || chr(31) || regexp_replace(o_name, '\\s+', '', 'g') from nr),
y as (select kind, k, bool_or(l = 'candidate') p, bool_or(l = 'official') g from x where l in ('candidate', 'official') group by 1, 2), z as (select kind layer, count(*) filter (p and g) tp, count(*) filter (p and not g) fp, count(*) filter (g and not p) fn from y group by 1) select layer, tp, fp, fn, {_F1} from z""",
    "agg37_tiers": f"""with {_NR}, t as (select unnest(['claim', 'state']) tier), g as (select distinct s_name, predicate, o_name, case when predicate in {_in(TIERS["claim"])} then 'claim' else 'state' end tier from nr where layer = 'official'),
p as (select distinct s_name, predicate, o_name from nr where layer = 'candidate'),
z as (select t.tier, (select count(*) from p join g using (s_name, predicate, o_name) where g.tier = t.tier) tp, (select count(*) from p where not exists (select 1 from g where (g.s_name, g.predicate, g.o_name) = (p.s_name, p.predicate, p.o_name))) fp,
 (select count(*) from g where g.tier = t.tier and not exists (select 1 from p where (g.s_name, g.predicate, g.o_name) = (p.s_name, p.predicate, p.o_name))) fn from t) select tier, tp, fp, fn, {_F1} from z""",
}
QUERIES = {f.__name__: f for f in (rul09_facts, rul11_paths, rul11_rejections, rul12_chained, flt13_reportable, rul03_issues, match02_relations, match02_rules, match04_rule_matches, match05_case_scores, match06_layers, agg37_tiers)}
