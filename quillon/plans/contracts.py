"""Queries of contract checks, chaining, pairing, adjudication and composition over graph, chunks and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quillon.functions.text import disjoint_count
from quillon.operators.rules import decimal_of, evaluate_observations, select_case
from quillon.operators.segments import lines_with_offsets
from quillon.plans.documents import _FACTS, join31_facts
from quillon.plans.graph import _E, _edges
from quillon.plans.retrieval import CH, ND, chunks, live_nodes
from quillon.plans.rules import _EV, _O, _V, _obs
from quillon.plans.scoring import _CF, _SP, _conf, _gold, _predicted, _spans
from quillon.plans.segments import _LN, _pages
from quillon.sources.tables import table

FORBIDDEN = [("Hemoglobin", "EXCLUDES"), ("Albumin", "SUGGESTS"), ("Potassium", "PART_OF"), ("control chart", "EXCLUDES")]


def seg13_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Pages with running text, pages of headings only, and pages without any text, counted per document."""
    r = lines_with_offsets(_pages(spark, d), "page_id", "cleaned_text").join(_pages(spark, d).select("page_id", "document_id"), "page_id")
    t = F.trim("line")
    p = r.groupBy("document_id", "page_id").agg(F.max((t != "") & ~t.startswith("#")).alias("body"), F.max(t.startswith("#")).alias("head"))
    kind = F.when(F.col("body"), "semantic").when(F.col("head"), "structural").otherwise("empty")
    return p.groupBy("document_id", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_pages"))


def win07_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    """The latest observation with a unit before each row of a report, in the order of the rows."""
    w = W.partitionBy("report_id").orderBy("obs_id").rowsBetween(W.unboundedPreceding, -1)
    o = _obs(spark, d).groupBy("report_id", "obs_id").agg(F.min("unit").alias("unit"))
    return o.select("obs_id", F.last("unit", ignorenulls=True).over(w).alias("unit_before"))


def join21_nearest_before(spark: SparkSession, d: str) -> DataFrame:
    """For each mention the nearest mention before it in its chunk (as-of)."""
    w = W.partitionBy("id").orderBy("start", "end", "word").rowsBetween(W.unboundedPreceding, -1)
    s = _spans(spark, d)
    return s.select(F.col("id").alias("chunk_id"), "word", "start", F.last("word").over(w).alias("before")).filter("before is not null")


def join18_all_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All unordered pairs of different words on one line of a chunk, with the number of such lines."""
    c = chunks(spark, d).select(F.col("chunk_id").alias("id"), "text")
    head = F.substring("text", F.lit(1), F.col("start"))
    s = _spans(spark, d).join(c, "id").select("id", "word", (F.length(head) - F.length(F.replace(head, F.lit("\n")))).alias("line"))
    words = s.groupBy("id", "line").agg(F.collect_set("word").alias("ws")).filter("size(ws) > 1")  # of the dictionary only
    pairs = F.flatten(F.transform("ws", lambda a: F.transform(F.filter("ws", lambda b: a < b), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return words.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def set06_partition(spark: SparkSession, d: str) -> DataFrame:
    """Whether the layers of the edges partition them: rows of either side that the other lacks."""
    e = _edges(spark, d).select("triple_id")
    parts = _edges(spark, d).filter("layer = 'book'").select("triple_id").unionAll(_edges(spark, d).filter("layer = 'official'").select("triple_id")).unionAll(_edges(spark, d).filter("layer = 'candidate'").select("triple_id"))
    a = e.exceptAll(parts).agg(F.count(F.lit(1)).alias("n")).select(F.lit("missing").alias("side"), "n")
    return a.unionByName(parts.exceptAll(e).agg(F.count(F.lit(1)).alias("n")).select(F.lit("extra").alias("side"), "n"))


def set08_forbidden(spark: SparkSession, d: str) -> DataFrame:
    """Predicted facts that are forbidden: a subject with a predicate."""
    f = spark.createDataFrame(FORBIDDEN, "subject string, predicate string")
    return join31_facts(spark, d).join(F.broadcast(f), ["subject", "predicate"], "left_semi").select("triple_id", "subject", "predicate")  # the list above


def agg17_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Edges by status with rates, the four statuses also where there are none."""
    names = ["candidate", "approved", "rejected", "final"]
    e = _edges(spark, d).agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in names])
    return e.select(F.explode(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n"), F.round(F.col(s) / F.col("n"), 6).alias("rate")) for s in names])).alias("v")).select("v.*")


def agg19_channels(spark: SparkSession, d: str) -> DataFrame:
    """Per document the chunks that the edges cite, that have a vector, and that have both."""
    c = chunks(spark, d).select("document_id", "chunk_id")
    cited = _edges(spark, d).select(F.explode(F.from_json("evidence_json", "array<struct<chunk_id:string>>")["chunk_id"]).alias("chunk_id")).distinct().withColumn("g", F.lit(1))
    v = table(spark, d, "vectors").select("chunk_id").dropna().distinct().withColumn("v", F.lit(1))
    return c.join(cited, "chunk_id", "left").join(v, "chunk_id", "left").groupBy("document_id").agg(F.count("g").alias("n_graph"), F.count("v").alias("n_vector"), F.count(F.when(F.col("g").isNotNull() & F.col("v").isNotNull(), 1)).alias("n_both"))


def fn25_grounding(spark: SparkSession, d: str) -> DataFrame:
    """Whether every number of a chunk's first line stands in the rest of its page."""
    p = _pages(spark, d).select("page_id", "cleaned_text").filter("cleaned_text is not null")
    c = chunks(spark, d).join(p, "page_id").select("chunk_id", F.regexp_extract_all(F.element_at(F.split("text", "\n"), 1), F.lit("[0-9]+"), F.lit(0)).alias("nums"), F.replace("cleaned_text", F.col("text"), F.lit("")).alias("rest"))
    return c.filter("size(nums) > 0").select("chunk_id", F.size("nums").alias("n_numbers"), F.forall("nums", lambda x: F.contains(F.col("rest"), x)).alias("grounded"))


def fn25_all_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Whether every number of a chunk, on any of its lines, stands in the rest of its page."""
    p = _pages(spark, d).select("page_id", "cleaned_text").filter("cleaned_text is not null")
    c = chunks(spark, d).join(p, "page_id").select("chunk_id", F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)).alias("nums"), F.replace("cleaned_text", F.col("text"), F.lit("")).alias("rest"))
    return c.filter("size(nums) > 0").select("chunk_id", F.size("nums").alias("n_numbers"), F.forall("nums", lambda x: F.contains(F.col("rest"), x)).alias("grounded"))


def fn22_endpoint_keys(spark: SparkSession, d: str) -> DataFrame:
    """Node names by their letters and digits only: how many names share a key."""
    k = F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}]", "")
    return live_nodes(spark, d).groupBy(k.alias("key")).agg(F.countDistinct("name").alias("n_names"), F.count(F.lit(1)).alias("n_nodes"))


def rul08_conditions(spark: SparkSession, d: str) -> DataFrame:
    """Per report the status of the condition "glucose of at least 7 mmol/L": its failures in the order of precedence."""
    o = _obs(spark, d).filter("standard_name = 'Glucose'")
    v = decimal_of(F.col("value"))
    status = F.when(~F.coalesce(F.col("unit").isin("mmol/L", "mmol/l"), F.lit(False)), "unit_mismatch").when(v.isNull(), "missing").when(v >= 7, "pass").otherwise("fail")
    return select_case(o.select("report_id", status.alias("status")), ["report_id"])


def rul13_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps that keep a report from a claim, in the order of first occurrence, without repeats."""
    e = evaluate_observations(_obs(spark, d)).select("report_id", "obs_id", F.posexplode("errors").alias("i", "code"))
    first = e.groupBy("report_id", "code").agg(F.min(F.struct("obs_id", "i")).alias("o"))
    codes = F.transform(F.array_sort(F.collect_list(F.struct("o", "code"))), lambda x: x["code"])
    return first.groupBy("report_id").agg(F.array_join(codes, ",").alias("gaps"))


def val10_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """Every mention with the line that encloses it."""
    c = chunks(spark, d).select(F.col("chunk_id").alias("id"), "text")
    s = _spans(spark, d).join(c, "id")
    n = F.size(F.split(F.substring("text", F.lit(1), F.col("start")), "\n"))
    return s.select(F.col("id").alias("chunk_id"), "word", "start", n.alias("line_no"), F.element_at(F.split("text", "\n"), n).alias("line"))


def val20_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries of observations: rows that repeat an earlier one in all but its arrival."""
    cols = [c for c in table(spark, d, "observation").columns if c != "received_at"]
    g = table(spark, d, "observation").groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return g.filter("n > 1").select("obs_id", (F.col("n") - 1).alias("n_repeats"))


def val33_all_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Per chunk and pair of different words the shortest stretch, then the first, that holds each of them exactly once."""
    s = _spans(spark, d)
    left = s.select("id", F.col("word").alias("a"), F.col("start").alias("sa"), F.col("end").alias("ea"))
    right = s.select("id", F.col("word").alias("b"), F.col("start").alias("sb"), F.col("end").alias("eb"))
    begin, stop = F.least("sa", "sb"), F.greatest("ea", "eb")
    p = left.join(right, "id").filter("a < b").select("id", "a", "b", begin.alias("start"), (stop - begin).alias("n")).distinct()
    p = p.join(chunks(spark, d).select(F.col("chunk_id").alias("id"), "text"), "id").withColumn("quote", F.substring("text", F.col("start") + 1, F.col("n")))
    once = p.filter((disjoint_count(F.col("quote"), F.col("a")) == 1) & (disjoint_count(F.col("quote"), F.col("b")) == 1))
    m = once.groupBy("id", "a", "b").agg(F.min(F.struct("n", "start")).alias("m"))
    return m.select(F.col("id").alias("chunk_id"), "a", "b", F.col("m.n").alias("n"), F.col("m.start").alias("start"))


def gld03_types(spark: SparkSession, d: str) -> DataFrame:
    """Type of each node name by agreement, else by a list of priorities, with how it was decided."""
    order = ["Disease", "IndicatorState", "LabIndicator", "LabPanel", "ClinicalContext"]
    g = live_nodes(spark, d).groupBy("name").agg(F.collect_set("node_type").alias("t"))
    pick = F.coalesce(*[F.when(F.array_contains("t", x), x) for x in order], F.array_min("t"))
    return g.select("name", pick.alias("node_type"), F.when(F.size("t") == 1, "unanimous").otherwise("priority").alias("decided"))


def gld05_bases(spark: SparkSession, d: str) -> DataFrame:
    """The indicator of each state name: what stands before its last word."""
    s = live_nodes(spark, d).filter("node_type = 'IndicatorState'").select("name").distinct()
    base = F.regexp_extract("name", r"^(.+) (raised|lowered|critical|unchanged|high|low|[a-z]+)$", 1)
    known = table(spark, d, "lab_term").select(F.col("standard_name").alias("base")).distinct().withColumn("known", F.lit(True))
    return s.select("name", base.alias("base")).filter("base <> ''").join(known, "base", "left").select("name", "base", F.coalesce("known", F.lit(False)).alias("known"))


def match03_representatives(spark: SparkSession, d: str) -> DataFrame:
    """One representative per identity of the wrong predictions: the smallest observation."""
    return _conf(spark, d).filter("fp = 1").groupBy("standard_name", "site_code").agg(F.min("obs_id").alias("first_obs"), F.count(F.lit(1)).alias("n"))


_CJ = """cj as (select triple_id, layer, j->>'chunk_id' chunk_id from (select triple_id, layer, unnest(from_json(evidence_json, '["JSON"]')) j from ed))"""
SQL = {
    "seg13_kinds": f"""with {_LN}, p as (select document_id, page_id, bool_or(trim(line) <> '' and trim(line) not like '#%') b, bool_or(trim(line) like '#%') h from ln join pg using (page_id) group by 1, 2)
select document_id, case when b then 'semantic' when h then 'structural' else 'empty' end kind, count(*) n_pages from p group by 1, 2""",
    "win07_carry_forward": f"with {_O}, x as (select report_id, obs_id, min(unit) unit from o group by 1, 2) select obs_id, last_value(unit ignore nulls) over (partition by report_id order by obs_id rows between unbounded preceding and 1 preceding) unit_before from x",
    "join21_nearest_before": f"""with {_SP} select * from (select chunk_id, word, start, lag(word) over (partition by chunk_id order by start, "end", word) "before" from sp) where "before" is not null""",
    "join18_all_pairs": f"""with {_SP}, l as (select distinct chunk_id, word, length(substr(text, 1, start)) - length(replace(substr(text, 1, start), chr(10), '')) line from sp join ch using (chunk_id))
select x.word a, y.word b, count(*) n from l x join l y on x.chunk_id = y.chunk_id and x.line = y.line and x.word < y.word group by 1, 2""",
    "set06_partition": f"""with {_E}, p as (select triple_id from ed where layer in ('book', 'official', 'candidate')) select 'missing' side, count(*) n from (select triple_id from ed except all select triple_id from p) union all select 'extra', count(*) from (select triple_id from p except all select triple_id from ed)""",
    "set08_forbidden": f"with {_FACTS} select triple_id, subject, predicate from facts where (subject, predicate) in (" + ", ".join(f"('{a}', '{b}')" for a, b in FORBIDDEN) + ")",
    "agg17_verdicts": f"with {_E}, s as (select unnest(['candidate', 'approved', 'rejected', 'final']) status) select s.status, count(ed.status) n, round(count(ed.status) / (select count(*) from ed)::double, 6) rate from s left join ed on ed.status = s.status group by 1",
    "agg19_channels": f"""with {CH}, {_E}, {_CJ}, g as (select distinct chunk_id from cj where chunk_id is not null), v as (select distinct chunk_id from vectors where chunk_id is not null)
select document_id, count(g.chunk_id) n_graph, count(v.chunk_id) n_vector, count(*) filter (g.chunk_id is not null and v.chunk_id is not null) n_both from ch left join g on g.chunk_id = ch.chunk_id left join v on v.chunk_id = ch.chunk_id group by 1""",
    "fn25_grounding": f"""with {CH}, p as (select page_id, any_value(cleaned_text) t from page_text where cleaned_text is not null group by 1), c as (select chunk_id, regexp_extract_all(string_split(text, chr(10))[1], '[0-9]+') nums, replace(t, text, '') rest from ch join p using (page_id))
select chunk_id, len(nums)::int n_numbers, len(list_filter(nums, lambda x: not contains(rest, x))) = 0 grounded from c where len(nums) > 0""",
    "fn25_all_numbers": f"""with {CH}, p as (select page_id, any_value(cleaned_text) t from page_text where cleaned_text is not null group by 1), c as (select chunk_id, regexp_extract_all(text, '[0-9]+') nums, replace(t, text, '') rest from ch join p using (page_id))
select chunk_id, len(nums)::int n_numbers, len(list_filter(nums, lambda x: not contains(rest, x))) = 0 grounded from c where len(nums) > 0""",
    "fn22_endpoint_keys": rf"with {ND} select regexp_replace(lower(name), '[^\p{{L}}\p{{N}}]', '', 'g') as key, count(distinct name) n_names, count(*) n_nodes from nd group by 1",
    "rul08_conditions": f"""with {_O}, s as (select report_id, case when not coalesce(unit in ('mmol/L', 'mmol/l'), false) then 'unit_mismatch' when ({_V}) is null then 'missing' when ({_V}) >= 7 then 'pass' else 'fail' end s from o where standard_name = 'Glucose')
select report_id, case when count(*) filter (s = 'pass') = 1 then 'case_match' when count(*) filter (s = 'pass') > 1 then 'ambiguous' when count(*) filter (s = 'unit_mismatch') > 0 then 'unit_mismatch' when count(*) filter (s = 'missing') > 0 then 'missing' else 'no_case_match' end outcome, count(*) filter (s = 'pass') n_pass from s group by 1""",
    "rul13_gaps": f"""with {_EV}, e as (select report_id, obs_id, list_filter([e1, e2, e3, e4], lambda x: x is not null) l from er), x as (select report_id, obs_id, generate_subscripts(l, 1) i, unnest(l) code from e),
f as (select report_id, code, min(struct_pack(o := obs_id, i := i)) o from x group by 1, 2) select report_id, string_agg(code, ',' order by o, code) gaps from f group by 1""",
    "val10_occurrences": f"""with {_SP}, l as (select chunk_id, word, start, len(string_split(substr(text, 1, start), chr(10)))::int line_no, text from sp join ch using (chunk_id)) select chunk_id, word, start, line_no, string_split(text, chr(10))[line_no] line from l""",
    "val20_duplicates": "select obs_id, count(*) - 1 n_repeats from (select * exclude (received_at) from observation) group by all having count(*) > 1",
    "val33_all_pairs": f"""with {_SP}, p as (select x.chunk_id, x.word a, y.word b, least(x.start, y.start) s, greatest(x."end", y."end") - least(x.start, y.start) n from sp x join sp y on x.chunk_id = y.chunk_id and x.word < y.word),
q as (select p.*, substr(text, p.s + 1, n) t from p join ch using (chunk_id)), o as (select * from q where len(string_split(t, a)) = 2 and len(string_split(t, b)) = 2)
select chunk_id, a, b, m.n n, m.s as start from (select chunk_id, a, b, min(struct_pack(n := n, s := s)) m from o group by 1, 2, 3)""",
    "gld03_types": f"""with {ND}, g as (select name, list(distinct node_type) t from nd group by 1) select name, coalesce({", ".join(f"case when list_contains(t, '{x}') then '{x}' end" for x in ("Disease", "IndicatorState", "LabIndicator", "LabPanel", "ClinicalContext"))}, list_min(t)) node_type,
case when len(t) = 1 then 'unanimous' else 'priority' end decided from g""",
    "gld05_bases": f"""with {ND}, s as (select distinct name, regexp_extract(name, '^(.+) (raised|lowered|critical|unchanged|high|low|[a-z]+)$', 1) base from nd where node_type = 'IndicatorState') select name, base, base in (select standard_name from lab_term) known from s where base <> ''""",
    "match03_representatives": f"with {_CF} select standard_name, site_code, min(obs_id) first_obs, count(*) n from cf where fp = 1 group by 1, 2",
}
QUERIES = {f.__name__: f for f in (
    seg13_kinds, win07_carry_forward, join21_nearest_before, join18_all_pairs, set06_partition, set08_forbidden, agg17_verdicts, agg19_channels, fn25_grounding, fn25_all_numbers, fn22_endpoint_keys,
    rul08_conditions, rul13_gaps, val10_occurrences, val20_duplicates, val33_all_pairs, gld03_types, gld05_bases, match03_representatives,
)}
