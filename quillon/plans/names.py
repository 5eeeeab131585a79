"""Queries of name forms, checks and structure over graph, terminology, observations and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.functions import names as N
from quillon.operators.segments import lines_with_offsets
from quillon.operators.structures import best_ranks, clauses, cue_pairs, json_strings, missing_endpoints, smallest_shared, superseded
from quillon.operators.terms import annotate
from quillon.plans.graph import _edges
from quillon.plans.retrieval import CH, ND, chunks, fold_sql, live_nodes
from quillon.plans.scoring import _SP, _dictionary, _spans
from quillon.sources.tables import table

#: English words that part a state name of these tables from its indicator, and phrases that join two quantities.
ENGLISH_STATES = (" raised", " lowered", " unchanged", " critical", " fluctuating", " not interpretable", " borderline", " normal")
CUES = ("was compared with", "explained the", "separate from", "disagree")
SENTENCE_END = "[。！？；\n]|</td>|\\. "
_EV = "array<struct<chunk_id:string,chunk_sha256:string,exact_quote:string>>"


def _names(spark: SparkSession, d: str) -> DataFrame:
    """Every name and alias of graph, supplement and terminology."""
    w = table(spark, d, "wbc_supplement").select(F.explode(F.array_compact(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("name"))
    t = table(spark, d, "lab_term").select(F.explode(F.array_compact(F.concat(F.array("standard_name", "abbreviation"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("name"))
    return table(spark, d, "nodes").select("name").unionAll(w).unionAll(t).filter("name is not null").distinct()


def _quotes(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).select("triple_id", "object_id", F.explode(F.from_json("evidence_json", _EV)).alias("e")).select("triple_id", "object_id", "e.chunk_id", F.col("e.exact_quote").alias("quote")).filter("quote is not null").distinct()


def fn07_normal_names(spark: SparkSession, d: str) -> DataFrame:
    """Names in the form in which the catalog compares them."""
    return _names(spark, d).select("name", N.normal_name(F.col("name")).alias("normal_name"))


def fn08_variant_keys(spark: SparkSession, d: str) -> DataFrame:
    """Names with one spelling for each family of variants."""
    return _names(spark, d).select("name", N.variant_key(F.col("name")).alias("variant_key"))


def fn19_surfaces(spark: SparkSession, d: str) -> DataFrame:
    """Names as compared surfaces."""
    return _names(spark, d).select("name", N.surface(F.col("name")).alias("surface"))


def fn21_identities(spark: SparkSession, d: str) -> DataFrame:
    """Identities of live nodes: type and name without spaces, with the number of nodes that share one."""
    return live_nodes(spark, d).groupBy("node_type", N.no_spaces(F.col("name")).alias("label")).agg(F.count(F.lit(1)).alias("n_nodes"))


def _expressions(spark: SparkSession, d: str) -> DataFrame:
    """The rule expressions that the graph spells: a product, the predicates as name, the subjects as inputs."""
    n = live_nodes(spark, d)
    e = _edges(spark, d).join(n.select(F.col("node_id").alias("object_id"), F.col("name").alias("object")), "object_id")
    ins = e.filter("predicate in ('USES', 'HAS_METRIC')").groupBy("subject_id").agg(F.array_join(F.array_sort(F.collect_list("object")), ", ").alias("inputs"))
    outs = e.filter("predicate in ('PRODUCES', 'SUGGESTS')").groupBy("subject_id").agg(F.min("object").alias("output"))
    return outs.join(ins, "subject_id", "left").select("subject_id", F.concat("output", F.lit(" = rule("), F.coalesce("inputs", F.lit("")), F.lit(")")).alias("expression"))


def fn23_expressions(spark: SparkSession, d: str) -> DataFrame:
    """Rule expressions taken apart, or what is wrong with them."""
    x = _expressions(spark, d).select("subject_id", N.parsed_expression(F.col("expression")).alias("p"))
    return x.select("subject_id", "p.output", F.array_join("p.inputs", "|").alias("inputs"), "p.error")


def fn24_conditions(spark: SparkSession, d: str) -> DataFrame:
    """Which texts of result rows would be conditions, and what is wrong with the others."""
    v = table(spark, d, "observation").select(F.explode(F.array("value", F.concat_ws(" ", F.lit("value"), F.when(F.col("ref_lower").isNotNull(), "GE").otherwise("<"), "unit"))).alias("condition")).distinct()
    return v.groupBy(F.coalesce(N.condition_error(F.col("condition")), F.lit("ok")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def fn26_result_links(spark: SparkSession, d: str) -> DataFrame:
    """Quotes of edges, and whether the name of the object stands in them or in the heading right before them."""
    q = _quotes(spark, d).join(live_nodes(spark, d).select(F.col("node_id").alias("object_id"), "name"), "object_id").join(chunks(spark, d).select("chunk_id", "text"), "chunk_id")
    return q.select("triple_id", "chunk_id", "quote", N.result_linked(F.col("name"), F.col("quote"), F.col("text")).alias("linked"))


def fn29_layout_units(spark: SparkSession, d: str) -> DataFrame:
    """Unit cells as layout text and as units, the second null where the cell holds none."""
    u = table(spark, d, "observation").select("unit").filter("unit is not null").distinct()
    return u.select("unit", N.layout_text(F.col("unit")).alias("layout_text"), N.layout_unit(F.col("unit")).alias("layout_unit"))


def fn38_grounded(spark: SparkSession, d: str) -> DataFrame:
    """Quotes of edges, and whether they stand in their chunk when spaces do not count."""
    q = _quotes(spark, d).join(chunks(spark, d).select("chunk_id", "text"), "chunk_id")
    key = lambda c: N.no_spaces(F.col(c))
    return q.select("triple_id", "chunk_id", "quote", ((key("quote") != "") & F.contains(key("text"), key("quote"))).alias("grounded"))


def fn39_strings(spark: SparkSession, d: str) -> DataFrame:
    """Every string in the evidence of edges with its path."""
    return json_strings(_edges(spark, d).select("triple_id", "evidence_json").distinct(), "triple_id", "evidence_json").distinct()


def flt14_categories(spark: SparkSession, d: str) -> DataFrame:
    """Names that are no entity of their type, the contexts of the graph and the test names of report rows taken as methods."""
    rows = live_nodes(spark, d).select(F.when(F.col("node_type") == "ClinicalContext", "MethodOrDrug").otherwise(F.col("node_type")).alias("category"), "name")
    rows = rows.unionAll(table(spark, d, "page_text").select(F.lit("MethodOrDrug"), F.explode(F.regexp_extract_all(F.coalesce("cleaned_text", F.lit("")), F.lit("[㐀-鿿]{1,6}(?:检验|检查|改变)"), F.lit(0))))).distinct()
    return rows.select("category", "name", N.category_error(F.col("category"), N.no_spaces(F.col("name"))).alias("error"))


def flt17_states(spark: SparkSession, d: str) -> DataFrame:
    """State nodes with the indicator nodes that they are states of: the name before the state is the indicator's."""
    n = live_nodes(spark, d)
    key = lambda c: N.endpoint_text(c)
    s = n.filter("node_type = 'IndicatorState'").select(F.col("node_id").alias("state_id"), key(N.state_base(F.col("name"), (*N.STATE_STARTS, *ENGLISH_STATES))).alias("k")).filter("k <> ''")
    i = n.filter("node_type = 'LabIndicator'").select(F.col("node_id").alias("indicator_id"), key(F.col("name")).alias("k"))
    return s.join(i, "k").select("state_id", "indicator_id")


def win10_best_matches(spark: SparkSession, d: str) -> DataFrame:
    """For each name of the terminology the nodes that match it best: exactly, folded, by variant, or by an ending of four letters or more."""
    t = table(spark, d, "lab_term").select("term_id", F.explode(F.array_compact(F.concat(F.array("standard_name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("term")).distinct()
    n = live_nodes(spark, d).select("node_id", "name").distinct()
    ways = [(F.col("term"), F.col("name"), 0)] + [(f(F.col("term")), f(F.col("name")), k) for k, f in ((1, N.fold_case), (2, N.variant_key))]
    rows = [t.withColumn("k", a).join(n.withColumn("k", b), "k").select("term_id", "node_id", F.lit(r).alias("rank")) for a, b, r in ways]
    ends = lambda c: F.explode(F.transform(F.sequence(F.lit(4), F.greatest(F.lit(4), F.length(c))), lambda i: F.right(c, i)))
    kt, kn = t.select("term_id", N.variant_key(F.col("term")).alias("k")).filter("length(k) >= 4"), n.select("node_id", N.variant_key(F.col("name")).alias("k")).filter("length(k) >= 4")
    rows.append(kt.join(kn.select("node_id", ends(F.col("k")).alias("k")), "k").select("term_id", "node_id", F.lit(3).alias("rank")))
    rows.append(kt.select("term_id", ends(F.col("k")).alias("k")).join(kn, "k").select("term_id", "node_id", F.lit(3).alias("rank")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionAll(r)
    return best_ranks(out, "term_id")


def join13_missing_endpoints(spark: SparkSession, d: str) -> DataFrame:
    """Endpoints of edges that are no live node."""
    return missing_endpoints(_edges(spark, d), live_nodes(spark, d))


def join23_superseded(spark: SparkSession, d: str) -> DataFrame:
    """Candidate edges that neither the book nor the official layer has, with the reason."""
    e = _edges(spark, d)
    return superseded(e.filter("layer = 'candidate'"), e.filter("layer in ('book', 'official')"), live_nodes(spark, d).select("node_id", F.col("node_type").alias("place")))


def join24_first_evidence(spark: SparkSession, d: str) -> DataFrame:
    """For each name of the dictionary the first chunk and place where it stands, its own chapter's chunks first."""
    own = table(spark, d, "wbc_supplement").select(F.col("canonical_name").alias("word"), "chapter_id").filter("word is not null and chapter_id is not null").distinct()
    s = _spans(spark, d).join(chunks(spark, d).select(F.col("chunk_id").alias("id"), "chapter_id"), "id").join(own.withColumn("own", F.lit(1)), ["word", "chapter_id"], "left")
    best = s.groupBy("word").agg(F.min(F.struct((1 - F.coalesce("own", F.lit(0))).alias("other"), "id", "start")).alias("b"))
    return best.select("word", F.col("b.id").alias("chunk_id"), "b.start")


def join19_shared_lines(spark: SparkSession, d: str) -> DataFrame:
    """For each pair of dictionary words of a chunk the shortest line with both."""
    lines = lines_with_offsets(chunks(spark, d).select("chunk_id", "text"), "chunk_id", "text").select(F.col("chunk_id").alias("id"), F.col("line_start").alias("u_start"), F.col("line_end").alias("u_end"))
    return smallest_shared(_spans(spark, d), lines).withColumnRenamed("id", "chunk_id")


def _cue_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = clauses(chunks(spark, d).select(F.col("chunk_id").alias("id"), "text"), SENTENCE_END)
    texts = c.select(F.struct("id", "clause_no").alias("id"), F.col("clause").alias("text"))
    texts = texts.select(F.concat_ws("\x01", "id.id", "id.clause_no").alias("id"), "text")
    cues = annotate(texts, spark.createDataFrame([(x,) for x in CUES], "word string"))
    cues = cues.select("id", "start", (F.col("start") + F.length("word")).alias("end"))
    at = annotate(texts.join(cues.select("id").distinct(), "id", "left_semi"), _dictionary(spark, d))
    return cue_pairs(at.select("id", "word", "start", (F.col("start") + F.length("word")).alias("end")), cues, ["id"]).select(F.split("id", "\x01")[0].alias("chunk_id"), F.split("id", "\x01")[1].cast("int").alias("clause_no"), "a", "b", "opposite")


def flt15_cue_clauses(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of dictionary words in one clause with a cue, with the number of such clauses."""
    return _cue_pairs(spark, d).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def flt16_opposite_sides(spark: SparkSession, d: str) -> DataFrame:
    """The clauses in which a cue stands between the words of a pair."""
    return _cue_pairs(spark, d).filter("opposite").select("chunk_id", "clause_no", "a", "b")


_WS = "\\s\\x1c-\\x1f\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_NM = """nm as (select distinct name from (select name from nodes union all select unnest(list_concat([canonical_name], coalesce(aliases, []))) from wbc_supplement
 union all select unnest(list_concat([standard_name, abbreviation], coalesce(aliases, []))) from lab_term) where name is not null)"""
_ED = "ed as (select distinct triple_id, subject_id, predicate, object_id, layer, status, properties_json, evidence_json, origins_json, created_at from edges)"
_QU = f"""{_ED}, qu as (select distinct triple_id, object_id, x->>'chunk_id' chunk_id, x->>'exact_quote' quote from (select triple_id, object_id, unnest(from_json(evidence_json, '["json"]')) x from ed) where x->>'exact_quote' is not null)"""
_FOLD = lambda x: f"replace({fold_sql(x)}, 'ß', 'ss')"


def _variant_sql(x: str) -> str:
    x = _FOLD(x)
    for a, b in N.VARIANTS:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def _unescaped_sql(x: str) -> str:
    for a, b in N._REFERENCES:
        x = f"replace({x}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return x


_CLAUSES = f"""cl as (select id, i::int - 1 clause_no, cs[i] clause from (select chunk_id id, string_split_regex(text, '[。！？；\\n]|</td>|\\. ') cs from ch), unnest(range(1, len(cs) + 1)) t(i)),
cu as (select unnest([{", ".join(f"'{x}'" for x in CUES)}]) cue), bare as (select 1),
cp as (select id, clause_no, p - 1 s, p - 1 + length(cue) e from (select id, clause_no, clause, cue, unnest(list_filter(range(1, length(clause) + 1), lambda i: substr(clause, i, length(cue)) = cue)) p from cl join cu on contains(clause, cue))
 where (p = 1 or not regexp_matches(substr(clause, p - 1, 1), '[A-Za-z0-9_]')) and not regexp_matches(substr(clause, p + length(cue), 1), '[A-Za-z0-9_]')),
wd as (select distinct word from (select unnest(list_concat([standard_name, abbreviation], coalesce(aliases, []))) word from lab_term union all select name from nodes) where length(word) >= 2),
cc as (select distinct id, clause_no from cp),
mp as (select id, clause_no, word, p - 1 s, p - 1 + length(word) e from (select id, clause_no, clause, word, unnest(list_filter(range(1, length(clause) + 1), lambda i: substr(clause, i, length(word)) = word)) p from cl join cc using (id, clause_no) join wd on contains(clause, word))
 where (p = 1 or not regexp_matches(substr(clause, p - 1, 1), '[A-Za-z0-9_]')) and not regexp_matches(substr(clause, p + length(word), 1), '[A-Za-z0-9_]'))"""
_STATES = "|".join((*N.STATE_STARTS, *ENGLISH_STATES))
SQL = {
    "fn07_normal_names": f"with {_NM} select name, replace(lower(regexp_replace(regexp_replace({_unescaped_sql('name')}, '\\\\\\(|\\\\\\)|\\\\mathrm|[{{}}$]', '', 'g'), '[{_WS}（）()·,:：，。]', '', 'g')), 'ß', 'ss') normal_name from nm",
    "fn08_variant_keys": f"with {_NM} select name, {_variant_sql('name')} variant_key from nm",
    "fn19_surfaces": f"with {_NM} select name, regexp_replace(regexp_replace(name, '[{_WS}]+', '', 'g'), '为({'|'.join(N.STATE_WORDS)})', '\\1', 'g') surface from nm",
    "fn21_identities": f"with {ND} select node_type, regexp_replace(name, '[{_WS}]+', '', 'g') as label, count(*) n_nodes from nd group by all",
    "fn23_expressions": f"""with {ND}, {_ED}, e as (select ed.*, name o from ed join nd on object_id = node_id), i as (select subject_id, list(o order by o) ins from e where predicate in ('USES', 'HAS_METRIC') group by 1),
u as (select subject_id, min(o) o from e where predicate in ('PRODUCES', 'SUGGESTS') group by 1), x as (select subject_id, o, coalesce(ins, []) ins, regexp_matches(o || coalesce(array_to_string(ins, ''), ''), '[=()]') bad from u left join i using (subject_id)),
y as (select subject_id, o, bad, list_filter(list_transform(string_split_regex(array_to_string(ins, ', '), '[,，]'), lambda v: trim(v)), lambda v: v <> '') ins from x)
select subject_id, case when not bad then o end as output, case when not bad then array_to_string(ins, '|') end inputs,
 case when bad then 'invalid_rule_expression' when len(ins) = 0 then 'missing_inputs' when len(list_distinct(ins)) < len(ins) then 'duplicate_inputs' end error from y""",
    "fn24_conditions": """with c as (select distinct c from (select unnest([value, concat_ws(' ', 'value', case when ref_lower is not null then 'GE' else '<' end, unit)]) c from observation))
select case when c is null or c = '' then 'invalid_condition' when regexp_matches(c, '==|!=|>=|<=|(?:^|[^A-Za-z])=|>|<') then 'unsupported_operator' when not regexp_matches(c, '\\b(?:EQ|NE|GT|GE|LT|LE|BETWEEN|IN|POSITIVE|NEGATIVE)\\b') then 'missing_operator' else 'ok' end code, count(*) n from c group by 1""",
    "fn26_result_links": f"""with {CH}, {ND}, {_QU}, x as (select triple_id, chunk_id, quote, name, case when instr(text, quote) > 0 then substr(text, 1, instr(text, quote) - 1) else '' end b from qu join nd on object_id = node_id join ch using (chunk_id)),
y as (select *, trim(list_extract(string_split(regexp_replace(b, '[{_WS}]+$', ''), chr(10)), -1)) l from x)
select triple_id, chunk_id, quote, contains(quote, name) or (regexp_matches(b, '\\n[ \\t]*$') and length(l) between 1 and 80 and right(l, 1) not in ('。', '！', '？', '；', '.', '!', '?', ';')
 and contains(regexp_replace(l, '^(?:\\(?\\d+\\)?[、.)]?|[一二三四五六七八九十]+[、.])\\s*', ''), name)) linked from y""",
    "fn38_grounded": f"with {CH}, {_QU} select triple_id, chunk_id, quote, regexp_replace(quote, '[{_WS}]+', '', 'g') <> '' and contains(regexp_replace(text, '[{_WS}]+', '', 'g'), regexp_replace(quote, '[{_WS}]+', '', 'g')) grounded from qu join ch using (chunk_id)",
    "fn39_strings": f"""with {_ED}, i as (select distinct triple_id, evidence_json from ed), x as (select triple_id, unnest(from_json(evidence_json, '["json"]')) x, generate_subscripts(from_json(evidence_json, '["json"]'), 1) - 1 n from i)
select distinct triple_id, n || '.' || k path, x->>k as text from x, unnest(json_keys(x)) t(k) where json_type(x, k) = 'VARCHAR'""",
    "flt14_categories": f"""with {ND}, r as (select distinct category, name from (select case when node_type = 'ClinicalContext' then 'MethodOrDrug' else node_type end category, name from nd
 union all select 'MethodOrDrug', unnest(regexp_extract_all(coalesce(cleaned_text, ''), '[㐀-鿿]{{1,6}}(?:检验|检查|改变)')) from page_text)), k as (select *, regexp_replace(name, '[{_WS}]+', '', 'g') k from r)
select category, name, case when k in ('疾病', '人') then 'generic term is not an entity' when category = 'MethodOrDrug' and (k in ('形态学改变', '肌红蛋白', '运铁蛋白', '血常规检验') or regexp_matches(k, '(检验|检查|改变)$')) then 'not a method, specimen, device, operation, or drug' end error from k""",
    "flt17_states": f"""with {ND}, s as (select node_id state_id, regexp_replace(lower(regexp_replace(name, '(?s)({_STATES}).*$', '')), '[^\\pL\\pN]+', '', 'g') k from nd where node_type = 'IndicatorState')
select state_id, node_id indicator_id from s join nd on node_type = 'LabIndicator' and k = regexp_replace(lower(name), '[^\\pL\\pN]+', '', 'g') where k <> ''""",
    "win10_best_matches": f"""with {ND}, t as (select distinct term_id, unnest(list_concat([standard_name], coalesce(aliases, []))) term from lab_term), n as (select node_id, name, {_FOLD('name')} f, {_variant_sql('name')} v from nd),
k as (select term_id, term, {_FOLD('term')} f, {_variant_sql('term')} v from t where term is not null),
m as (select term_id, node_id, min(case when term = name then 0 when k.f = n.f then 1 when k.v = n.v then 2 else 3 end) "rank" from k, n where term = name or k.f = n.f or k.v = n.v or (length(k.v) >= 4 and length(n.v) >= 4 and (ends_with(k.v, n.v) or ends_with(n.v, k.v))) group by 1, 2)
select term_id, node_id, "rank" from m where "rank" = (select min("rank") from m x where x.term_id = m.term_id)""",
    "join13_missing_endpoints": f"""with {ND}, {_ED}, x as (select distinct triple_id, 'subject' side, subject_id node_id from ed union select distinct triple_id, 'object', object_id from ed)
select triple_id, side, node_id from x where not exists (select 1 from nd where nd.node_id = x.node_id)""",
    "join23_superseded": f"""with {ND}, {_ED}, o as (select distinct triple_id, subject_id, predicate, object_id from ed where layer = 'candidate')
select triple_id, case when s.node_type is null or b.node_type is null then 'dangling' when s.node_type <> b.node_type then 'cross_place' else 'not_recovered' end reason from o left join nd s on s.node_id = subject_id left join nd b on b.node_id = object_id
where not exists (select 1 from ed where layer in ('book', 'official') and ed.subject_id = o.subject_id and ed.predicate = o.predicate and ed.object_id = o.object_id)""",
    "join24_first_evidence": f"""with {_SP}, own as (select distinct canonical_name word, chapter_id from wbc_supplement where canonical_name is not null and chapter_id is not null),
x as (select sp.word, sp.chunk_id, start, case when own.word is null then 1 else 0 end other from sp join ch using (chunk_id) left join own on own.word = sp.word and own.chapter_id = ch.chapter_id)
select word, chunk_id, start from (select *, row_number() over (partition by word order by other, chunk_id, start) r from x) where r = 1""",
    "join19_shared_lines": f"""with {_SP}, ln as (select chunk_id, x.s, x.e from (select chunk_id, unnest(list_transform(range(1, len(l) + 1), lambda i: {{'s': coalesce(list_sum(list_transform(l[1:i-1], lambda v: length(v) + 1)), 0)::int, 'e': coalesce(list_sum(list_transform(l[1:i-1], lambda v: length(v) + 1)), 0)::int + length(l[i])}})) x from (select chunk_id, string_split(text, chr(10)) l from ch))),
m as (select distinct chunk_id, word, s, e from sp join ln using (chunk_id) where start >= s and "end" <= e), p as (select x.chunk_id, x.word a, y.word b, x.s, x.e from m x join m y on x.chunk_id = y.chunk_id and x.s = y.s and x.e = y.e and x.word < y.word)
select chunk_id, a, b, s unit_start, e unit_end from (select *, row_number() over (partition by chunk_id, a, b order by e - s, s) r from p) where r = 1""",
    "flt15_cue_clauses": f"""with {CH}, {_CLAUSES}, w as (select distinct id, clause_no, word from mp) select x.word a, y.word b, count(*) n from w x join w y on x.id = y.id and x.clause_no = y.clause_no and x.word < y.word group by 1, 2""",
    "flt16_opposite_sides": f"""with {CH}, {_CLAUSES} select distinct x.id chunk_id, x.clause_no, least(x.word, y.word) a, greatest(x.word, y.word) b from mp x join cp c on x.id = c.id and x.clause_no = c.clause_no and x.e <= c.s join mp y on y.id = x.id and y.clause_no = x.clause_no and y.s >= c.e where x.word <> y.word""",
}
QUERIES = {f.__name__: f for f in (
    fn07_normal_names, fn08_variant_keys, fn19_surfaces, fn21_identities, fn23_expressions, fn24_conditions, fn26_result_links, fn29_layout_units, fn38_grounded, fn39_strings, flt14_categories, flt17_states, win10_best_matches,
    join13_missing_endpoints, join23_superseded, join24_first_evidence, join19_shared_lines, flt15_cue_clauses, flt16_opposite_sides,
)}
