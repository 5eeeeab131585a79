"""Queries of rule evaluation and report operators over observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.functions.text import unit_key
from quillon.operators.rules import atomic, decimal_of, evaluate_observations, evaluate_tree, select_case, value_errors
from quillon.sources.tables import table

_OBS = ["obs_id", "report_id", "site_code", "raw_name", "standard_name", "abbreviation", "value", "unit", "ref_lower", "ref_upper", "lower_inclusive", "upper_inclusive", "report_flag", "sample_type", "unit_source"]
# rule, node, parent, kind, k, metric, op, threshold, upper
RULES = [
    ("anaemia", "r", None, "all", None, None, None, None, None), ("anaemia", "a", "r", "atom", None, "Hemoglobin", "lt", 120.0, None), ("anaemia", "o", "r", "any", None, None, None, None, None),
    ("anaemia", "b", "o", "atom", None, "Red cell count", "lt", 4.2, None), ("anaemia", "c", "o", "atom", None, "Hematocrit", "lt", 0.38, None),
    ("two_of_three", "r", None, "at_least", 2, None, None, None, None), ("two_of_three", "a", "r", "atom", None, "Albumin", "lt", 36.0, None), ("two_of_three", "b", "r", "atom", None, "Total protein", "lt", 65.0, None), ("two_of_three", "c", "r", "atom", None, "Phosphate", "between", 0.8, 1.5),
    ("at_most_one", "r", None, "at_most", 1, None, None, None, None), ("at_most_one", "a", "r", "atom", None, "Serum iron", "gt", 20.0, None), ("at_most_one", "b", "r", "atom", None, "Ferritin", "ge", 100.0, None),
    ("not_high", "r", None, "not", None, None, None, None, None), ("not_high", "a", "r", "atom", None, "Fibrinogen", "gt", 4.0, None),
]
RULE_SCHEMA = "rule_id string, node_id string, parent_id string, kind string, k int, metric string, op string, threshold double, upper double"


def _obs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "observation").select(*_OBS).distinct()


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """Smallest value of each metric of a report."""
    o = _obs(spark, d).filter("standard_name is not null")
    return o.groupBy(F.col("report_id").alias("case_id"), F.col("standard_name").alias("metric")).agg(F.min(decimal_of(F.col("value"))).alias("value"))


def rul06_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Every observation compared with its interval, with the list of what is wrong with it."""
    return evaluate_observations(_obs(spark, d)).select("obs_id", "computed_flag", F.concat_ws(",", "errors").alias("errors"))


def rul07_flags(spark: SparkSession, d: str) -> DataFrame:
    """The reported flag, else the computed one."""
    return evaluate_observations(_obs(spark, d)).select("obs_id", F.coalesce("report_flag", "computed_flag").alias("flag"))


def agg20_overview(spark: SparkSession, d: str) -> DataFrame:
    """Per report: observations in all, normal, high, low and indeterminate."""
    f = evaluate_observations(_obs(spark, d)).withColumn("flag", F.coalesce("report_flag", "computed_flag"))
    return f.groupBy("report_id").agg(F.count(F.lit(1)).alias("total"), *[F.count(F.when(F.col("flag") == x, 1)).alias(f"n_{x}") for x in ("normal", "high", "low")], F.count(F.when(F.col("flag").isNull(), 1)).alias("n_indeterminate"))


def agg07_errors(spark: SparkSession, d: str) -> DataFrame:
    """Histogram of the error codes."""
    return evaluate_observations(_obs(spark, d)).select(F.explode("errors").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def rul02_atomic(spark: SparkSession, d: str) -> DataFrame:
    """Each fact against each threshold of its metric: true, false or unknown."""
    atoms = spark.createDataFrame(RULES, RULE_SCHEMA).filter("kind = 'atom'")
    j = _facts(spark, d).join(F.broadcast(atoms), "metric")  # the rule list above
    v = atomic(F.col("op"), F.col("value"), F.col("threshold"), F.col("upper"))
    return j.select("case_id", "rule_id", "node_id", F.when(v.isNull(), "unknown").when(v, "true").otherwise("false").alias("result"))


def rul01_trees(spark: SparkSession, d: str) -> DataFrame:
    """Every rule tree on every report that has at least one of its facts."""
    return evaluate_tree(spark.createDataFrame(RULES, RULE_SCHEMA), _facts(spark, d))


def rul10_cases(spark: SparkSession, d: str) -> DataFrame:
    """Per report the outcome of the case table low / normal / high of its haemoglobin rows."""
    o = _obs(spark, d).filter("standard_name = 'Hemoglobin'")
    v = decimal_of(F.col("value"))
    status = F.when(v.isNull(), "missing").when(~F.coalesce(F.col("unit") == "g/L", F.lit(False)), "unit_mismatch")
    cases = F.explode(F.array(*[F.struct(F.lit(i).alias("case_no"), F.coalesce(status, F.when(c, "pass").otherwise("fail")).alias("status")) for i, c in enumerate((v < 120, v.between(120, 160), v > 160))])).alias("c")
    return select_case(o.select("report_id", cases).select("report_id", "c.*"), ["report_id"])


def fn11_value_errors(spark: SparkSession, d: str) -> DataFrame:
    """How often a value text is a number, no number or not finite."""
    return _obs(spark, d).select(F.coalesce(value_errors(F.col("value")), F.lit("ok")).alias("state")).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def fn09_unit_keys(spark: SparkSession, d: str) -> DataFrame:
    """Distinct unit keys with the number of spellings and rows."""
    u = _obs(spark, d).filter("unit is not null")
    return u.groupBy(unit_key(F.col("unit")).alias("unit_key")).agg(F.countDistinct("unit").alias("n_spellings"), F.count(F.lit(1)).alias("n_rows"))


def fn34_convert(spark: SparkSession, d: str) -> DataFrame:
    """Values whose written unit is a source unit of the conversion list, converted by its factor; others have none."""
    terms = table(spark, d, "lab_term").select("standard_name", "term_id")
    conv = table(spark, d, "unit_conversion").select("term_id", F.col("source_unit").alias("unit"), "target_unit", "factor")
    o = _obs(spark, d).join(terms, "standard_name").join(conv, ["term_id", "unit"], "left")
    return o.select("obs_id", F.col("target_unit"), F.round(decimal_of(F.col("value")) * F.col("factor"), 6).alias("converted"))


def fn31_canonical_term(spark: SparkSession, d: str) -> DataFrame:
    """Standard name by exact name, alias or abbreviation; unknown names stay as they are."""
    t = table(spark, d, "lab_term")
    keys = t.select(F.explode(F.array_compact(F.concat(F.array("standard_name", "abbreviation"), "aliases"))).alias("k"), F.col("standard_name").alias("canonical")).groupBy("k").agg(F.min("canonical").alias("canonical"))
    return _obs(spark, d).join(keys, F.col("raw_name") == F.col("k"), "left").select("obs_id", F.coalesce("canonical", "raw_name").alias("name"))


def join26_units(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a unit that take the one of the other rows of the report with the same name and value, if it is the only one."""
    o = _obs(spark, d)
    have = o.filter("unit is not null and value is not null").groupBy("report_id", F.coalesce("standard_name", "raw_name").alias("nm"), "value").agg(F.countDistinct("unit").alias("n"), F.min("unit").alias("found"))
    bare = o.filter("unit is null and value is not null").select("obs_id", "report_id", F.coalesce("standard_name", "raw_name").alias("nm"), "value")
    return bare.join(have.filter("n = 1"), ["report_id", "nm", "value"], "left").select("obs_id", F.col("found").alias("unit"))


def agg16_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Mean, least and greatest share of abnormal rows over the sites, per standard name."""
    e = evaluate_observations(_obs(spark, d)).filter("standard_name is not null and computed_flag is not null")
    site = e.groupBy("standard_name", "site_code").agg(F.avg((F.col("computed_flag") != "normal").cast("int")).alias("x"))
    return site.groupBy("standard_name").agg(F.round(F.avg("x"), 6).alias("mean"), F.round(F.min("x"), 6).alias("least"), F.round(F.max("x"), 6).alias("greatest"))


def rul04_table_checks(spark: SparkSession, d: str) -> DataFrame:
    """Decision table of site, name and sample type to flag: keys with several outcomes are conflicts, repeated ones overlaps."""
    o = _obs(spark, d).filter("standard_name is not null and report_flag is not null")
    g = o.groupBy("site_code", "standard_name", "sample_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("report_flag").alias("k"))
    kind = F.when(F.col("k") > 1, "conflict").when(F.col("n") > 1, "overlap").otherwise("unique")
    return g.groupBy(kind.alias("state")).agg(F.count(F.lit(1)).alias("n_keys"))


_O = "o as (select distinct " + ", ".join(_OBS) + " from observation)"
_NUM = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_V = f"case when regexp_matches(value, '{_NUM}') then try_cast(trim(value) as double) end"
_EV = f"""{_O}, v as (select *, {_V} v from o), ev as (select *, case when v is not null and (ref_lower is not null or ref_upper is not null) and not coalesce(ref_lower > ref_upper, false) then
  case when coalesce(v < ref_lower or (v = ref_lower and not coalesce(lower_inclusive, true)), false) then 'low' when coalesce(v > ref_upper or (v = ref_upper and not coalesce(upper_inclusive, true)), false) then 'high' else 'normal' end end computed_flag,
  case when value is null then 'invalid_value' when lower(trim(value)) in ('nan', 'inf', '-inf', '+inf', 'infinity', '-infinity') then 'non_finite_value' when not regexp_matches(value, '{_NUM}') then 'invalid_value' end e1,
  case when unit is null or unit = '' then 'missing_unit' when unit_source = 'controlled_default' then 'default_unit_applied' end e2,
  case when ref_lower is null and ref_upper is null then 'invalid_interval' when ref_lower > ref_upper then 'reversed_interval' end e3 from v),
er as (select *, case when computed_flag <> report_flag then 'report_flag_conflict' end e4 from ev)"""
_FACT = f"{_O}, facts as (select report_id case_id, standard_name metric, min({_V}) as value from o where standard_name is not null group by all)"
_RULES = "rn(rule_id, node_id, parent_id, kind, k, metric, op, threshold, upper) as (values " + ", ".join("(" + ", ".join("null" if x is None else f"'{x}'" if isinstance(x, str) else f"{x}::double" if isinstance(x, float) else str(x) for x in r) + ")" for r in RULES) + ")"
_ATOM = f"""{_FACT}, {_RULES}, atm as (select case_id, rule_id, node_id, parent_id, case op when 'lt' then value < threshold when 'ge' then value >= threshold when 'gt' then value > threshold when 'between' then value between threshold and upper end v
  from facts join rn using (metric) where kind = 'atom')"""
_LEVEL = """select case_id, i.rule_id, i.node_id, i.parent_id, case kind when 'all' then case when t + (n - m) < n then false when n - m > 0 then null else true end
 when 'any' then case when t > 0 then true when n - m > 0 then null else false end when 'not' then case when n - m > 0 then null else t = 0 end
 when 'at_least' then case when t >= k then true when t + n - m >= k then null else false end when 'at_most' then case when t > k then false when t + n - m <= k then true end end v
 from (select case_id, rule_id, parent_id p, count(*) filter (v) t, count(v) m from %s where parent_id is not null group by all) g join hi i on i.h = %s and i.rule_id = g.rule_id and i.node_id = g.p
 join (select rule_id, parent_id, count(*) n from rn where parent_id is not null group by all) z on z.rule_id = i.rule_id and z.parent_id = i.node_id"""
SQL = {
    "rul06_intervals": f"with {_EV} select obs_id, computed_flag, concat_ws(',', e1, e2, e3, e4) errors from er",
    "rul07_flags": f"with {_EV} select obs_id, coalesce(report_flag, computed_flag) flag from er",
    "agg20_overview": f"with {_EV}, f as (select report_id, coalesce(report_flag, computed_flag) flag from er) select report_id, count(*) total, count(*) filter (flag = 'normal') n_normal, count(*) filter (flag = 'high') n_high, count(*) filter (flag = 'low') n_low, count(*) filter (flag is null) n_indeterminate from f group by 1",
    "agg07_errors": f"with {_EV} select code, count(*) n from (select unnest([e1, e2, e3, e4]) code from er) where code is not null group by 1",
    "rul02_atomic": f"with {_ATOM} select case_id, rule_id, node_id, case when v is null then 'unknown' when v then 'true' else 'false' end as result from atm",
    "rul01_trees": f"with {_ATOM}, hi as (select a.*, 1 + (exists (select 1 from rn b where b.rule_id = a.rule_id and b.parent_id = a.node_id and b.kind <> 'atom'))::int h from rn a where kind <> 'atom'), l1 as ({_LEVEL % ('atm', 1)}), l2 as ({_LEVEL % ('(select * from atm union all select * from l1)', 2)}) select case_id, rule_id, case when v is null then 'unknown' when v then 'true' else 'false' end as result from (select * from l1 where parent_id is null union all select * from l2 where parent_id is null)",
    "rul10_cases": f"""with {_O}, v as (select report_id, unit, {_V} v from o where standard_name = 'Hemoglobin'), c as (select report_id, case when v is null then 'missing' when not coalesce(unit = 'g/L', false) then 'unit_mismatch' when ok then 'pass' else 'fail' end s
from (select report_id, unit, v, unnest([v < 120, v between 120 and 160, v > 160]) ok from v))
select report_id, case when count(*) filter (s = 'pass') = 1 then 'case_match' when count(*) filter (s = 'pass') > 1 then 'ambiguous' when count(*) filter (s = 'unit_mismatch') > 0 then 'unit_mismatch' when count(*) filter (s = 'missing') > 0 then 'missing' else 'no_case_match' end outcome, count(*) filter (s = 'pass') n_pass from c group by 1""",
    "fn11_value_errors": f"with {_EV} select coalesce(e1, 'ok') state, count(*) n from er group by 1",
    "fn09_unit_keys": f"with {_O}, k as (select unit, translate(regexp_replace(lower(translate(unit, '{''.join(chr(0xFF01 + i) for i in range(94))}　', '{''.join(chr(0x21 + i) for i in range(94)).replace(chr(39), chr(39) * 2)} ')), '\\s', '', 'g'), 'μµ', 'uu') unit_key from o where unit is not null) select unit_key, count(distinct unit) n_spellings, count(*) n_rows from k group by 1",
    "fn34_convert": f"with {_O} select obs_id, target_unit, round(({_V}) * factor, 6) converted from o join lab_term t using (standard_name) left join unit_conversion c on c.term_id = t.term_id and c.source_unit = o.unit",
    "fn31_canonical_term": f"with {_O}, k as (select k, min(c) c from (select unnest(list_concat([standard_name, abbreviation], aliases)) k, standard_name c from lab_term) group by 1) select obs_id, coalesce(c, raw_name) as name from o left join k on k = raw_name",
    "join26_units": f"with {_O}, h as (select report_id, coalesce(standard_name, raw_name) nm, value, min(unit) u from o where unit is not null and value is not null group by 1, 2, 3 having count(distinct unit) = 1) select obs_id, u as unit from (select *, coalesce(standard_name, raw_name) nm from o where unit is null and value is not null) b left join h using (report_id, nm, value)",
    "agg16_repeats": f"with {_EV}, s as (select standard_name, site_code, avg((computed_flag <> 'normal')::int) x from er where standard_name is not null and computed_flag is not null group by 1, 2) select standard_name, round(avg(x), 6) mean, round(min(x), 6) least, round(max(x), 6) greatest from s group by 1",
    "rul04_table_checks": f"with {_O}, g as (select site_code, standard_name, sample_type, count(*) n, count(distinct report_flag) k from o where standard_name is not null and report_flag is not null group by 1, 2, 3) select case when k > 1 then 'conflict' when n > 1 then 'overlap' else 'unique' end state, count(*) n_keys from g group by 1",
}
QUERIES = {f.__name__: f for f in (
    rul06_intervals, rul07_flags, agg20_overview, agg07_errors, rul02_atomic, rul01_trees, rul10_cases, fn11_value_errors, fn09_unit_keys, fn34_convert, fn31_canonical_term, join26_units, agg16_repeats, rul04_table_checks,
)}

