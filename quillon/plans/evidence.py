"""Queries of quote replay, judged relations, name merging, ranges and the composition of graphs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quillon.functions import names as N
from quillon.operators.evidence import anchors, indexed_places, judged_relations, longest_spans, merged_names, range_graph, redirected, replayed_quotes, within_quote
from quillon.operators.segments import overlap_join
from quillon.plans.graph import _edges
from quillon.plans.names import _ED, _QU, _WS, _unescaped_sql
from quillon.plans.reasoning import _NR, _RE, _named, _rule_edges
from quillon.plans.retrieval import CH, ND, chunks, live_nodes
from quillon.plans.scoring import _SP, _spans
from quillon.sources.tables import table

_EV = "array<struct<chunk_id:string,chunk_sha256:string,exact_quote:string>>"
ALLOWED = [("HAS_METRIC", "LabPanel", "LabIndicator"), ("HAS_STATE", "LabIndicator", "IndicatorState"), ("SUGGESTS", "IndicatorState", "Disease"), ("SUGGESTS", "IndicatorState", "IndicatorState"), ("OBSERVED_IN", "IndicatorState", "ClinicalContext"),
           ("OBSERVED_IN", "IndicatorState", "LabIndicator"), ("USES", "RuleDefinition", "LabIndicator"), ("USES", "IndicatorState", "LabIndicator"), ("PRODUCES", "RuleDefinition", "IndicatorState"), ("PRODUCES", "IndicatorState", "IndicatorState"), ("EXCLUDES", "IndicatorState", "IndicatorState"), ("PART_OF", "LabIndicator", "LabPanel")]


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).select("triple_id", "object_id", F.explode(F.from_json("evidence_json", _EV)).alias("e")).select("triple_id", "object_id", "e.chunk_id", "e.chunk_sha256", F.col("e.exact_quote").alias("quote")).distinct()


def _bound(spark: SparkSession, d: str) -> DataFrame:
    """One row a chunk with the hash of its text, live chunks first delivered last."""
    return chunks(spark, d).groupBy("chunk_id").agg(F.max("text").alias("text")).withColumn("sha256", F.sha2("text", 256))


def val06_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Every quote of an edge replayed in its hash-bound chunk, whole, with its place where it stands exactly once."""
    return replayed_quotes(_refs(spark, d), _bound(spark, d)).select("triple_id", "chunk_id", "quote", "status", "start")


def val07_overlapping_quotes(spark: SparkSession, d: str) -> DataFrame:
    """How the quotes of edges replay when overlapping occurrences count too."""
    return replayed_quotes(_refs(spark, d), _bound(spark, d), overlapping=True).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def val08_within_quotes(spark: SparkSession, d: str) -> DataFrame:
    """The place in the chunk of the object's name where it stands exactly once in the quote of its edge."""
    r = replayed_quotes(_refs(spark, d), _bound(spark, d)).filter("status = 'ok'").join(live_nodes(spark, d).select(F.col("node_id").alias("object_id"), "name"), "object_id")
    return r.select("triple_id", "chunk_id", "quote", within_quote(F.col("quote"), F.col("start"), F.col("name")).alias("name_start"))


def val03_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The checks of the page package and how many pages break each: null texts, hashes, carriage returns, repeated keys with other content, gaps of a chapter."""
    p = table(spark, d, "page_text").select("page_id", "document_id", "chapter_id", "chapter_page_index", "cleaned_text", "cleaned_sha256").distinct()
    n = lambda c: F.count(F.when(c, 1))
    own = p.agg(n(F.col("cleaned_text").isNull()).alias("null_text"), n(F.sha2("cleaned_text", 256) != F.col("cleaned_sha256")).alias("hash"), n(F.contains("cleaned_text", F.lit("\r"))).alias("carriage_return"), F.count(F.lit(1)).alias("pages"))
    again = p.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).agg(n(F.col("n") > 1).alias("repeated_key"))
    chapter = p.groupBy("document_id", "chapter_id").agg((F.max("chapter_page_index") - F.min("chapter_page_index") + 1 - F.count_distinct("chapter_page_index")).alias("gap")).agg(F.coalesce(F.sum("gap"), F.lit(0)).alias("gap"))
    checks = ["null_text", "hash", "carriage_return", "pages", "repeated_key", "gap"]
    rows = reduce(DataFrame.unionAll, [x.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("n")) for c in x.columns])).alias("x")).select("x.*") for x in (own, again, chapter)])
    return rows.filter(F.col("check").isin(*checks))


def val26_relationships(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of every edge as a candidate relation."""
    quotes = _refs(spark, d).groupBy("triple_id").agg(F.collect_set("quote").alias("quotes"))
    e = _edges(spark, d).select("triple_id", "subject_id", "predicate", "object_id").distinct().join(quotes, "triple_id", "left")
    return judged_relations(e, live_nodes(spark, d), spark.createDataFrame(ALLOWED, "predicate string, s_type string, o_type string")).distinct()


def agg18_adjudication(spark: SparkSession, d: str) -> DataFrame:
    """Edges per layer and verdict."""
    e = _edges(spark, d).select("triple_id", "layer").distinct()
    return val26_relationships(spark, d).join(e, "triple_id").groupBy("layer", "verdict").agg(F.count(F.lit(1)).alias("n"))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """``id, name, key, own`` of the supplement and the terminology; ``own`` marks the name of an entry."""
    parts = []
    for t, i, c in (("wbc_supplement", "canonical_id", "canonical_name"), ("lab_term", "term_id", "standard_name")):
        x = table(spark, d, t).select(F.col(i).alias("id"), F.col(c).alias("own_name"), F.explode(F.concat(F.array(c), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
        parts.append(x.filter("name is not null").select("id", "name", N.normal_name(F.col("name")).alias("key"), (F.col("name") == F.col("own_name")).alias("own")))
    return parts[0].unionAll(parts[1]).distinct()


def agg23_merged_names(spark: SparkSession, d: str) -> DataFrame:
    """Entries of supplement and terminology that share names, merged over all of them, with one name each."""
    return merged_names(_entries(spark, d).select("id", "name", "key"))


def gld11_alias_redirects(spark: SparkSession, d: str) -> DataFrame:
    """Entries whose name is an alias of another entry, and the entry they fold into."""
    g = _entries(spark, d).groupBy("id").agg(F.min(F.when(F.col("own"), F.col("key"))).alias("key"), F.collect_set(F.when(~F.coalesce("own", F.lit(False)), F.col("key"))).alias("alias_keys"))
    return redirected(g)


def gld17_range_graph(spark: SparkSession, d: str) -> DataFrame:
    """Edges and rules from the intervals that observations print most often in the default unit of their term."""
    t = table(spark, d, "lab_term").select("standard_name", F.col("default_unit").alias("unit"), F.substring("term_id", 1, 4).alias("panel"))
    o = table(spark, d, "observation").select("obs_id", "standard_name", "unit", "ref_lower", "ref_upper").distinct().join(t, ["standard_name", "unit"]).filter("ref_lower is not null or ref_upper is not null")
    n = o.groupBy("standard_name", "panel", "unit", "ref_lower", "ref_upper").agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy("standard_name", "panel", "unit").agg(F.max(F.struct("n", "ref_lower", "ref_upper")).alias("b"))
    return range_graph(best.select(F.col("standard_name").alias("name"), "panel", "unit", F.col("b.ref_lower").alias("lower"), F.col("b.ref_upper").alias("upper")))


def exp01_range_replacement(spark: SparkSession, d: str) -> DataFrame:
    """Edges after list lines of the chunks took over: edges of rules stay, others go where their quote overlaps such a line."""
    q = replayed_quotes(_refs(spark, d), _bound(spark, d)).filter("status = 'ok'").select("chunk_id", F.col("triple_id").alias("l_id"), F.col("start").alias("l_start"), (F.col("start") + F.length("quote")).alias("l_end"))
    from quillon.operators.segments import lines_with_offsets

    lines = lines_with_offsets(_bound(spark, d), "chunk_id", "text").filter(F.col("line").rlike(r"^(?:[0-9]+[.)]|[-*]) "))
    over = overlap_join(q, lines.select("chunk_id", F.col("line_no").alias("r_id"), F.col("line_start").alias("r_start"), F.col("line_end").alias("r_end")), "chunk_id").select(F.col("l_id").alias("triple_id")).distinct().withColumn("overlaps", F.lit(True))
    rules = live_nodes(spark, d).filter("node_type = 'RuleDefinition'").select(F.col("node_id").alias("subject_id"), F.lit(True).alias("rule"))
    e = _edges(spark, d).select("triple_id", "subject_id").distinct().join(rules, "subject_id", "left").join(over, "triple_id", "left")
    fate = F.when(F.col("rule"), "rule").when(F.col("overlaps"), "replaced").otherwise("kept")
    return e.groupBy("triple_id").agg(F.max(fate).alias("fate"))


def exp03_groups(spark: SparkSession, d: str) -> DataFrame:
    """The relations of the groups A (official), B (rules of the book and candidates), C (both) and D (rules, structure of the official layer, other candidates)."""
    r = _named(spark, d)
    key = ["s_type", "s_name", "predicate", "o_type", "o_name"]
    rule, structure = F.col("s_type") == "RuleDefinition", F.col("predicate").isin("HAS_METRIC", "HAS_STATE", "PART_OF")
    official, candidate = F.col("layer") == "official", F.col("layer") == "candidate"
    groups = {"A": official, "B": (rule & (F.col("layer") == "book")) | candidate, "C": official | (rule & (F.col("layer") == "book")) | candidate, "D": (rule & (F.col("layer") == "book")) | (official & structure) | (candidate & ~structure)}
    member = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(g)) for g, c in groups.items()])))
    return r.select(member.alias("group_name"), *key).distinct()


def exp04_gold_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Official relations by predicate: those whose ends stand in one chunk, and of these the share that the candidates have, in this direction."""
    key = ["s_name", "predicate", "o_name"]
    r = _named(spark, d)
    gold = r.filter("layer = 'official'").select(*key).distinct()
    words = _spans(spark, d).select(F.col("id").alias("chunk_id"), "word").distinct()
    need = gold.select("s_name", "o_name").distinct()
    at = need.join(words.withColumnRenamed("word", "s_name"), "s_name").join(words.withColumnRenamed("word", "o_name"), ["chunk_id", "o_name"]).select("s_name", "o_name").distinct().withColumn("there", F.lit(True))
    have = r.filter("layer = 'candidate'").select(*key).distinct().withColumn("have", F.lit(True))
    x = gold.join(at, ["s_name", "o_name"], "left").join(have, key, "left").groupBy("predicate").agg(F.count(F.lit(1)).alias("n_gold"), F.count("there").alias("accessible"), F.count(F.when(F.col("there") & F.col("have"), 1)).alias("covered"))
    return x.withColumn("coverage", F.when(F.col("accessible") > 0, F.round(F.col("covered") / F.col("accessible"), 6)).otherwise(1.0))


def exp18_complete_rules(spark: SparkSession, d: str) -> DataFrame:
    """Edges of the rules that are complete: live ends throughout, an input and an output, no edge twice."""
    e = _edges(spark, d).join(live_nodes(spark, d).filter("node_type = 'RuleDefinition'").select(F.col("node_id").alias("subject_id")), "subject_id").select("triple_id", "subject_id", "predicate", "object_id").distinct()
    e = e.join(live_nodes(spark, d).select(F.col("node_id").alias("object_id"), F.lit(True).alias("live")), "object_id", "left")
    sums = e.groupBy("subject_id").agg(F.count("live").alias("n_live"), F.count(F.lit(1)).alias("n"), F.count_distinct("predicate", "object_id").alias("n_edges"), F.max(F.col("predicate").isin("USES", "HAS_METRIC", "HAS_STATE", "OBSERVED_IN", "PART_OF")).alias("has_in"), F.max(F.col("predicate").isin("PRODUCES", "SUGGESTS", "EXCLUDES")).alias("has_out"))
    whole = sums.filter("n_live = n and n = n_edges and has_in and has_out").select("subject_id")
    return e.join(whole, "subject_id").select("triple_id", F.col("subject_id").alias("rule_id"), "predicate", "object_id")


def grf24_rule_states(spark: SparkSession, d: str) -> DataFrame:
    """Every rule that has an edge with the parts of its subgraph: inputs, outputs, and what is missing."""
    g = _rule_edges(spark, d).groupBy("rule_id").agg(F.count(F.when(F.col("predicate").isin("USES", "HAS_METRIC", "HAS_STATE", "OBSERVED_IN", "PART_OF"), 1)).alias("n_inputs"), F.count(F.when(F.col("predicate").isin("PRODUCES", "SUGGESTS", "EXCLUDES"), 1)).alias("n_outputs"))
    return g.withColumn("state", F.when((F.col("n_inputs") > 0) & (F.col("n_outputs") > 0), "complete").when(F.col("n_inputs") > 0, "no_output").otherwise("no_input"))


def grf18_dependencies(spark: SparkSession, d: str) -> DataFrame:
    """Rules whose product is an input of another rule: producer, consumer and the node between them."""
    e = _rule_edges(spark, d)
    made = e.filter("predicate in ('PRODUCES', 'SUGGESTS')").select(F.col("rule_id").alias("producer"), "node_id").distinct()
    used = e.filter("predicate in ('USES', 'HAS_STATE', 'OBSERVED_IN', 'PART_OF')").select(F.col("rule_id").alias("consumer"), "node_id").distinct()
    return made.join(used, "node_id").filter("producer <> consumer").select("producer", "consumer", "node_id")


def gld13_anchored_gold(spark: SparkSession, d: str) -> DataFrame:
    """Edges with evidence, and the first declared chunk with both names, or why there is none."""
    n = live_nodes(spark, d)
    e = _refs(spark, d).select("triple_id", "object_id", "chunk_id").distinct().join(_edges(spark, d).select("triple_id", "subject_id").distinct(), "triple_id")
    e = e.join(n.select(F.col("node_id").alias("subject_id"), F.col("name").alias("s_name")), "subject_id", "left").join(n.select(F.col("node_id").alias("object_id"), F.col("name").alias("o_name")), "object_id", "left")
    w = _spans(spark, d).select(F.col("id").alias("chunk_id"), "word").distinct()
    e = e.join(w.select("chunk_id", F.col("word").alias("s_name"), F.lit(True).alias("s_there")), ["chunk_id", "s_name"], "left").join(w.select("chunk_id", F.col("word").alias("o_name"), F.lit(True).alias("o_there")), ["chunk_id", "o_name"], "left")
    g = e.groupBy("triple_id").agg(F.min(F.when(F.col("s_there") & F.col("o_there"), F.col("chunk_id"))).alias("chunk_id"), F.max((F.col("s_name").isNull() | F.col("o_name").isNull()).cast("int")).alias("lost"), F.max("s_there").alias("s"), F.max("o_there").alias("o"))
    reason = F.when(F.col("chunk_id").isNotNull(), "kept").when(F.col("lost") == 1, "no_node").when(F.col("s"), "no_object").when(F.col("o"), "no_subject").otherwise("neither")
    return g.select("triple_id", "chunk_id", reason.alias("reason"))


def val09_indexed(spark: SparkSession, d: str) -> DataFrame:
    """Claimed mentions found again: offsets that are off by one at odd places, the claims numbered backwards in a chunk and word."""
    s = _spans(spark, d).select("id", "word", "start")
    w = W.partitionBy("id", "word").orderBy(F.desc("start"))
    claims = s.select(F.concat_ws(":", "id", "word", "start").alias("claim_id"), "id", "word", (F.col("start") + F.col("start") % 2).alias("claimed"), (F.row_number().over(w) - 1).alias("nth"))
    return indexed_places(claims, s)


def fn16_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Mentions with the context of up to 32 characters on either side that stands once in their chunk."""
    return anchors(_spans(spark, d), _bound(spark, d).select(F.col("chunk_id").alias("id"), "text")).withColumnRenamed("id", "chunk_id")


def gld12_longest_spans(spark: SparkSession, d: str) -> DataFrame:
    """The longest dictionary word of each chunk and its first place."""
    return longest_spans(_spans(spark, d)).withColumnRenamed("id", "chunk_id")


def src29_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Annotation tasks: a row per chunk with its distinct spans in order."""
    s = _spans(spark, d).groupBy(F.col("id").alias("chunk_id")).agg(F.array_sort(F.collect_set(F.struct("start", "end", "word"))).alias("spans"))
    return s.select("chunk_id", F.size("spans").cast("bigint").alias("n_spans"), F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"], x["word"])), ";").alias("spans"))


def exp14_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Chunks without blanks and structural lines: how many characters stay, their hash, and the offset of the last of them."""
    from quillon.operators.segments import lines_with_offsets

    lines = lines_with_offsets(_bound(spark, d), "chunk_id", "text").filter(~F.ltrim("line").rlike(r"^(?:#|```|\$\$)"))
    bare = lines.select("chunk_id", "line_no", N.no_spaces(F.col("line")).alias("t"), (F.col("line_start") + F.length(F.regexp_replace("line", f"[{N.SPACES}]+$", "")) - 1).alias("last")).filter("t <> ''")
    out = bare.groupBy("chunk_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "t"))), lambda x: x["t"]), "").alias("t"), F.max("last").alias("last_offset"))
    return out.select("chunk_id", F.length("t").cast("bigint").alias("n_kept"), F.sha2("t", 256).alias("sha256"), "last_offset")


def exp15_range_contract(spark: SparkSession, d: str) -> DataFrame:
    """Printed intervals by what is wrong with them: no bound, bounds in the wrong order, a value that is a word against a numeric interval."""
    o = table(spark, d, "observation").select("obs_id", "value", "ref_lower", "ref_upper").distinct()
    code = F.when(F.col("ref_lower").isNull() & F.col("ref_upper").isNull(), F.when(F.col("value").rlike("[0-9]"), "no_bound").otherwise("qualitative")).when(F.col("ref_lower") > F.col("ref_upper"), "order").when(~F.coalesce(F.col("value").rlike("[0-9]"), F.lit(False)), "qualitative_value").otherwise("ok")
    return o.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


def exp16_compact_graph(spark: SparkSession, d: str) -> DataFrame:
    """The graph as a second pass gets it: per subject its relations in one ordered list of names."""
    r = _named(spark, d).select("s_type", "s_name", "predicate", "o_name").distinct()
    return r.groupBy("s_type", "s_name").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(">", "predicate", "o_name"))), ";").alias("relations"))


def win06_section_ends(spark: SparkSession, d: str) -> DataFrame:
    """Headings of a chunk with the place where their section ends: the next heading of the same or a higher level, else the end of the chunk."""
    from quillon.operators.segments import heading_level, lines_with_offsets

    c = _bound(spark, d)
    h = lines_with_offsets(c, "chunk_id", "text").withColumn("level", heading_level(F.col("line"))).filter("level is not null").select("chunk_id", "line_start", "level")
    w = W.partitionBy("chunk_id").orderBy("line_start").rowsBetween(1, W.unboundedFollowing)
    by = [F.min(F.when(F.col("level") <= k, F.col("line_start"))).over(w) for k in (1, 2, 3)]
    end = F.when(F.col("level") == 1, by[0]).when(F.col("level") == 2, by[1]).otherwise(by[2])
    return h.select("chunk_id", "line_start", "level", end.alias("e")).join(c.select("chunk_id", F.length("text").alias("n")), "chunk_id").select("chunk_id", "line_start", "level", F.coalesce("e", "n").alias("section_end"))


_BO = f"{CH}, bo as (select chunk_id, max(text) as text from ch group by 1), bs as (select *, sha256(text) sha from bo)"
_RF = f"""{_ED}, rf as (select distinct triple_id, object_id, x->>'chunk_id' chunk_id, x->>'chunk_sha256' chunk_sha256, x->>'exact_quote' quote from (select triple_id, object_id, unnest(from_json(evidence_json, '["json"]')) x from ed))"""
_RP = f"""{_BO}, {_RF}, rp as (select *, case when status = 'ok' then instr(text, quote) - 1 end as start from (select rf.*, text, case when text is null then 'no_chunk' when chunk_sha256 is distinct from sha then 'hash_mismatch' when coalesce(quote, '') = '' then 'empty_quote'
 when not contains(text, quote) then 'absent' when (length(text) - length(replace(text, quote, ''))) // length(quote) > 1 then 'ambiguous' else 'ok' end status from rf left join bs using (chunk_id)))"""
_EN = f"""en as (select distinct id, name, replace(lower(regexp_replace(regexp_replace({_unescaped_sql('name')}, '\\\\\\(|\\\\\\)|\\\\mathrm|[{{}}$]', '', 'g'), '[{_WS}（）()·,:：，。]', '', 'g')), 'ß', 'ss') k, name = own_name own
 from (select canonical_id id, canonical_name own_name, unnest(list_concat([canonical_name], coalesce(aliases, []))) as name from wbc_supplement union all select term_id, standard_name, unnest(list_concat([standard_name], coalesce(aliases, []))) from lab_term) where name is not null)"""
_VE = f"""{ND}, {_RF}, al(predicate, s_type, o_type) as (values {", ".join(str(x) for x in ALLOWED)}), qs as (select triple_id, list(distinct quote) qs from rf where quote is not null group by 1), ee as (select distinct triple_id, subject_id, predicate, object_id from ed),
fi as (select subject_id, predicate, object_id, min(triple_id) f from ee group by all),
ve as (select distinct ee.triple_id, case when s.name is null or o.name is null then 'no_endpoint' when ee.triple_id <> f then 'duplicate' when al.predicate is null then 'type_not_allowed' when qs is null then 'no_evidence'
 when len(list_filter(qs, lambda q: contains(q, s.name) and contains(q, o.name))) = 0 then 'partial' else 'valid' end verdict
 from ee left join nd s on s.node_id = subject_id left join nd o on o.node_id = object_id left join fi using (subject_id, predicate, object_id) left join al on al.predicate = ee.predicate and al.s_type = s.node_type and al.o_type = o.node_type left join qs using (triple_id))"""
_IN, _OUT = "('USES', 'HAS_METRIC', 'HAS_STATE', 'OBSERVED_IN', 'PART_OF')", "('PRODUCES', 'SUGGESTS', 'EXCLUDES')"
_BL = """bl as (select chunk_id, i line_no, l[i] line, coalesce(list_sum(list_transform(l[1:i-1], lambda v: length(v) + 1)), 0)::int s from (select chunk_id, string_split(text, chr(10)) l from bo), unnest(range(1, len(l) + 1)) t(i))"""
_DEC = lambda c: f"cast(cast({c} as decimal(18,4)) as varchar)"
SQL = {
    "val06_quotes": f"with {_RP} select triple_id, chunk_id, quote, status, start from rp",
    "val07_overlapping_quotes": f"""with {_RP}, x as (select case when status in ('ok', 'ambiguous') then case when len(list_filter(range(1, length(text) + 1), lambda i: substr(text, i, length(quote)) = quote)) > 1 then 'ambiguous' else 'ok' end else status end status from rp) select status, count(*) n from x group by 1""",
    "val08_within_quotes": f"""with {_RP}, {ND} select triple_id, chunk_id, quote, case when name <> '' and len(list_filter(range(1, length(quote) + 1), lambda i: substr(quote, i, length(name)) = name)) = 1 then start + instr(quote, name) - 1 end name_start from rp join nd on node_id = object_id where status = 'ok'""",
    "val03_manifest": """with p as (select distinct page_id, document_id, chapter_id, chapter_page_index, cleaned_text, cleaned_sha256 from page_text)
select 'null_text' "check", count(*) n from p where cleaned_text is null union all select 'hash', count(*) from p where sha256(cleaned_text) <> cleaned_sha256 union all select 'carriage_return', count(*) from p where contains(cleaned_text, chr(13)) union all select 'pages', count(*) from p
union all select 'repeated_key', count(*) from (select page_id from p group by 1 having count(*) > 1) union all select 'gap', coalesce(sum(g), 0)::bigint from (select max(chapter_page_index) - min(chapter_page_index) + 1 - count(distinct chapter_page_index) g from p group by document_id, chapter_id)""",
    "val26_relationships": f"with {_VE} select * from ve",
    "agg18_adjudication": f"with {_VE} select layer, verdict, count(*) n from ve join (select distinct triple_id, layer from ed) using (triple_id) group by 1, 2",
    "agg23_merged_names": f"""with recursive {_EN}, lk as (select distinct x.id a, y.id b from en x join en y using (k) where k <> ''), re(id, c) as (select distinct id, id from en union select lk.b, re.c from re join lk on lk.a = re.id),
co as (select id, min(c) component from re group by 1), nm as (select component, name, regexp_matches(name, '[㐀-鿿]') h from en join co using (id)),
be as (select component, name canonical from (select *, row_number() over (partition by component order by h desc, case when h then length(name) else 0 end desc, name desc) r from nm) where r = 1)
select id, component, canonical from co join be using (component)""",
    "gld11_alias_redirects": f"""with {_EN}, o as (select id, min(k) k from en where own group by 1) select o.id, min(en.id) "to" from o join en on en.k = o.k and not coalesce(en.own, false) and en.id <> o.id where o.k <> '' group by 1""",
    "gld17_range_graph": f"""with o as (select distinct obs_id, standard_name, unit, ref_lower, ref_upper from observation), n as (select o.standard_name, substr(term_id, 1, 4) panel, unit, ref_lower, ref_upper, count(*) n from o join lab_term t on t.standard_name = o.standard_name and t.default_unit = o.unit where ref_lower is not null or ref_upper is not null group by all),
b as (select * from (select *, row_number() over (partition by standard_name, panel, unit order by n desc, ref_lower desc nulls last, ref_upper desc nulls last) r from n) where r = 1),
u as (select * from b where standard_name in (select standard_name from b group by 1 having count(*) = 1))
select panel subject, 'HAS_METRIC' predicate, standard_name as object, null as condition from u union all select standard_name, 'HAS_STATE', standard_name || ' lowered', 'value LT ' || {_DEC('ref_lower')} || ' ' || unit from u where ref_lower is not null
union all select standard_name, 'HAS_STATE', standard_name || ' normal', 'value BETWEEN ' || {_DEC('ref_lower')} || ' ' || {_DEC('ref_upper')} || ' ' || unit from u where ref_lower is not null and ref_upper is not null union all select standard_name, 'HAS_STATE', standard_name || ' raised', 'value GT ' || {_DEC('ref_upper')} || ' ' || unit from u where ref_upper is not null""",
    "exp01_range_replacement": f"""with {_RP}, {ND}, {_BL}, ov as (select distinct triple_id from rp join bl on bl.chunk_id = rp.chunk_id and status = 'ok' and start < s + length(line) and s < start + length(quote) where regexp_matches(line, '^(?:[0-9]+[.)]|[-*]) '))
select triple_id, max(case when nd.node_type = 'RuleDefinition' then 'rule' when triple_id in (select triple_id from ov) then 'replaced' else 'kept' end) fate from ed left join nd on node_id = subject_id group by 1""",
    "exp03_groups": f"""with {_NR}, x as (select *, s_type = 'RuleDefinition' and layer = 'book' r, predicate in ('HAS_METRIC', 'HAS_STATE', 'PART_OF') st from nr)
select 'A' group_name, s_type, s_name, predicate, o_type, o_name from x where layer = 'official' union select 'B', s_type, s_name, predicate, o_type, o_name from x where r or layer = 'candidate' union select 'C', s_type, s_name, predicate, o_type, o_name from x where r or layer in ('candidate', 'official')
union select 'D', s_type, s_name, predicate, o_type, o_name from x where r or (layer = 'official' and st) or (layer = 'candidate' and not st)""",
    "exp04_gold_coverage": f"""with {_SP}, {_NR.replace(ND + ", ", ND + ", ")}, w as (select distinct chunk_id, word from sp), g as (select distinct s_name, predicate, o_name from nr where layer = 'official'), c as (select distinct s_name, predicate, o_name from nr where layer = 'candidate'),
x as (select g.*, exists (select 1 from w a join w b using (chunk_id) where a.word = g.s_name and b.word = g.o_name) there, exists (select 1 from c where (c.s_name, c.predicate, c.o_name) = (g.s_name, g.predicate, g.o_name)) have from g)
select predicate, count(*) n_gold, count(*) filter (there) accessible, count(*) filter (there and have) covered, case when count(*) filter (there) > 0 then round(count(*) filter (there and have) / count(*) filter (there), 6) else 1.0 end coverage from x group by 1""",
    "exp18_complete_rules": f"""with {ND}, {_ED}, e as (select distinct triple_id, subject_id, predicate, object_id from ed where subject_id in (select node_id from nd where node_type = 'RuleDefinition')),
w as (select subject_id from e group by 1 having count(*) filter (object_id in (select node_id from nd)) = count(*) and count(*) = count(distinct (predicate, object_id)) and bool_or(predicate in {_IN}) and bool_or(predicate in {_OUT}))
select triple_id, subject_id rule_id, predicate, object_id from e join w using (subject_id)""",
    "grf24_rule_states": f"""with {_RE} select rule_id, n_inputs, n_outputs, case when n_inputs > 0 and n_outputs > 0 then 'complete' when n_inputs > 0 then 'no_output' else 'no_input' end state from (select rule_id, count(*) filter (predicate in {_IN}) n_inputs, count(*) filter (predicate in {_OUT}) n_outputs from re group by 1)""",
    "grf18_dependencies": f"""with {_RE} select distinct a.rule_id producer, b.rule_id consumer, node_id from re a join re b using (node_id) where a.predicate in ('PRODUCES', 'SUGGESTS') and b.predicate in ('USES', 'HAS_STATE', 'OBSERVED_IN', 'PART_OF') and a.rule_id <> b.rule_id""",
    "gld13_anchored_gold": f"""with {_SP}, {ND}, {_RF}, w as (select distinct chunk_id, word from sp), e as (select distinct r.triple_id, r.object_id, r.chunk_id, ed.subject_id from rf r join ed using (triple_id)),
x as (select e.triple_id, e.chunk_id, s.name s_name, o.name o_name, exists (select 1 from w where w.chunk_id = e.chunk_id and word = s.name) st, exists (select 1 from w where w.chunk_id = e.chunk_id and word = o.name) ot from e left join nd s on s.node_id = subject_id left join nd o on o.node_id = object_id)
select triple_id, min(chunk_id) filter (st and ot) chunk_id, case when bool_or(st and ot) then 'kept' when bool_or(s_name is null or o_name is null) then 'no_node' when bool_or(st) then 'no_object' when bool_or(ot) then 'no_subject' else 'neither' end reason from x group by 1""",
    "val09_indexed": f"""with {_SP}, c as (select chunk_id || ':' || word || ':' || start claim_id, chunk_id, word, start + start % 2 claimed, row_number() over (partition by chunk_id, word order by start desc) - 1 nth from sp),
q as (select chunk_id, word, start, row_number() over (partition by chunk_id, word order by start) - 1 n from sp)
select claim_id, coalesce(max(start) filter (start = claimed), case when count(*) = 1 then min(start) end, max(start) filter (n = nth)) as start from c join q using (chunk_id, word) group by 1""",
    "gld12_longest_spans": f"""with {_SP} select chunk_id, word, start from (select *, row_number() over (partition by chunk_id order by length(word) desc, start, word) r from sp) where r = 1""",
    "src29_tasks": f"""with {_SP}, s as (select distinct chunk_id, start, "end" e, word from sp) select chunk_id, count(*) n_spans, string_agg(start || ':' || e || ':' || word, ';' order by start, e, word) spans from s group by 1""",
    "exp14_compacted": f"""with {_BO}, {_BL}, x as (select chunk_id, line_no, regexp_replace(line, '[{_WS}]+', '', 'g') t, s + length(regexp_replace(line, '[{_WS}]+$', '')) - 1 l from bl where not regexp_matches(ltrim(line), '^(?:#|```|\\$\\$)'))
select chunk_id, sum(length(t))::bigint n_kept, sha256(string_agg(t, '' order by line_no)) sha256, max(l)::int last_offset from x where t <> '' group by 1""",
    "exp15_range_contract": """with o as (select distinct obs_id, value, ref_lower, ref_upper from observation) select case when ref_lower is null and ref_upper is null then case when regexp_matches(value, '[0-9]') then 'no_bound' else 'qualitative' end when ref_lower > ref_upper then 'order' when not coalesce(regexp_matches(value, '[0-9]'), false) then 'qualitative_value' else 'ok' end code, count(*) n from o group by 1""",
    "exp16_compact_graph": f"""with {_NR}, x as (select distinct s_type, s_name, predicate || '>' || o_name r from nr) select s_type, s_name, count(*) n, string_agg(r, ';' order by r) relations from x group by 1, 2""",
    "win06_section_ends": f"""with {_BO}, {_BL}, h as (select chunk_id, s line_start, case when regexp_matches(line, '^#{{1,6}}\\s') then least(length(regexp_extract(line, '^(#{{1,6}})\\s', 1)), 3) when regexp_matches(line, '^[一二三四五六七八九十]+、') then 2 when regexp_matches(line, '^[（(][一二三四五六七八九十]+[）)]') then 3 end "level" from bl)
select h.chunk_id, h.line_start, h."level"::int "level", coalesce(min(x.line_start), length(text))::int section_end from h join bo using (chunk_id) left join h x on x.chunk_id = h.chunk_id and x.line_start > h.line_start and x."level" <= h."level" where h."level" is not null group by 1, 2, 3, text""",
}
QUERIES = {f.__name__: f for f in (
    val06_quotes, val07_overlapping_quotes, val08_within_quotes, val03_manifest, val26_relationships, agg18_adjudication, agg23_merged_names, gld11_alias_redirects, gld17_range_graph, exp01_range_replacement, exp03_groups, exp04_gold_coverage,
    exp18_complete_rules, grf24_rule_states, grf18_dependencies, gld13_anchored_gold, val09_indexed, fn16_anchors, gld12_longest_spans, src29_tasks, exp14_compacted, exp15_range_contract, exp16_compact_graph, win06_section_ends,
)}
