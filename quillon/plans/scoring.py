"""Queries of scoring, matching, term and gold-building operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.functions.text import fold_case
from quillon.operators.scoring import confusion, first_per_key, issues, longest_first, maximum_matching, prf, scores
from quillon.operators.segments import overlap_join
from quillon.operators.terms import annotate, candidate_terms
from quillon.plans.retrieval import CH, chunks
from quillon.sources.tables import table



def _gold(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "lab_term").select("standard_name").distinct()
    o = table(spark, d, "observation").select("obs_id", "site_code", "sample_type", "standard_name")
    return o.join(known, "standard_name", "left_semi").distinct()


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    """The term whose name, abbreviation or alias is the raw name."""
    t = table(spark, d, "lab_term")
    keys = t.select(F.explode(F.array_compact(F.concat(F.array("standard_name", "abbreviation"), "aliases"))).alias("k"), F.col("standard_name").alias("p")).groupBy(F.col("k")).agg(F.min("p").alias("p"))
    o = table(spark, d, "observation").select("obs_id", "site_code", "sample_type", "raw_name").distinct()
    return o.join(keys, F.col("raw_name") == F.col("k")).select("obs_id", "site_code", "sample_type", F.col("p").alias("standard_name"))


_KEYS = ["obs_id", "site_code", "sample_type", "standard_name"]


def _conf(spark: SparkSession, d: str) -> DataFrame:
    fill = lambda df: df.fillna("", ["sample_type", "site_code"])
    return confusion(fill(_predicted(spark, d)), fill(_gold(spark, d)), _KEYS)


def agg09_scores(spark: SparkSession, d: str) -> DataFrame:
    """Exact naming against the standard names: one overall row."""
    return scores(_conf(spark, d).withColumn("all", F.lit("all")), ["all"])


def agg11_by_site(spark: SparkSession, d: str) -> DataFrame:
    """The same by site."""
    return scores(_conf(spark, d), ["site_code"])


def agg14_by_term(spark: SparkSession, d: str) -> DataFrame:
    """The same by term."""
    return scores(_conf(spark, d), ["standard_name"])


def agg12_macro(spark: SparkSession, d: str) -> DataFrame:
    """Mean of the terms' scores."""
    return scores(_conf(spark, d), ["standard_name"]).agg(F.round(F.avg("precision"), 4).alias("precision"), F.round(F.avg("recall"), 4).alias("recall"), F.round(F.avg("f1"), 4).alias("f1"), F.count(F.lit(1)).alias("n_terms"))


def agg13_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Counts by sample type and in all, by one roll-up."""
    s = _conf(spark, d).rollup("sample_type").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn")])
    p = prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return s.select(F.coalesce("sample_type", F.lit("(all)")).alias("sample_type"), "tp", "fp", "fn", p["f1"].alias("f1"))


def agg15_issues(spark: SparkSession, d: str) -> DataFrame:
    """Missed names grouped to issues with their severity."""
    return issues(_conf(spark, d).filter("fn = 1"), "standard_name", ["Hemoglobin", "Potassium"])


def set01_sets(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the intersection and both differences of found and wanted identities."""
    p, g = _predicted(spark, d).select("obs_id", "standard_name"), _gold(spark, d).select("obs_id", "standard_name")
    parts = [("both", p.intersect(g)), ("only_predicted", p.subtract(g)), ("only_gold", g.subtract(p))]
    out = [x.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("part"), "n") for k, x in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


def set02_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Union of node deliveries where the first version of a key wins."""
    n = table(spark, d, "nodes").select("node_id", "node_type", "name", "created_at").distinct()
    return first_per_key(n, ["node_id"], ["created_at", "name", "node_type"]).select("node_id", "node_type", "name")


def set07_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Pages with text and pages with chunks compared: only here, only there, both."""
    p = table(spark, d, "page_text").filter("cleaned_text is not null").select("page_id").distinct().withColumn("a", F.lit(1))
    c = chunks(spark, d).select("page_id").distinct().withColumn("b", F.lit(1))
    side = F.when(F.col("b").isNull(), "page_only").when(F.col("a").isNull(), "chunk_only").otherwise("both")
    return p.join(c, "page_id", "full_outer").groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n_pages"))


def match01_matching(spark: SparkSession, d: str) -> DataFrame:
    """Per report a largest one-to-one matching of rows and terms with the raw name as name, abbreviation or alias."""
    o = table(spark, d, "observation").select("report_id", "obs_id", "raw_name").distinct()
    t = table(spark, d, "lab_term").select("term_id", F.explode(F.array_compact(F.concat(F.array("standard_name", "abbreviation"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("n"))
    key = lambda c: fold_case(F.col(c)).alias("k")
    names = t.select("term_id", key("n")).filter("k <> ''").distinct()
    pairs = o.select("report_id", "obs_id", key("raw_name")).join(names, "k").select("report_id", F.col("obs_id").cast("string").alias("p"), F.col("term_id").alias("g"))
    return maximum_matching(pairs, "report_id")


def _dictionary(spark: SparkSession, d: str, heads: bool = False) -> DataFrame:
    """The names, abbreviations and aliases of the terminology and the names of the graph, of two characters or more.

    ``heads`` adds the last words of all of them.
    """
    terms = table(spark, d, "lab_term").select(F.explode(F.array_compact(F.concat(F.array("standard_name", "abbreviation"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("word"))
    words = terms.unionAll(table(spark, d, "nodes").select("name"))
    words = words.unionAll(words.select(F.substring_index("word", " ", -1))) if heads else words
    return words.filter(F.length("word") >= 2).distinct()


def _spans(spark: SparkSession, d: str, heads: bool = False) -> DataFrame:
    a = annotate(chunks(spark, d).select(F.col("chunk_id").alias("id"), "text"), _dictionary(spark, d, heads))
    return a.select("id", "word", F.col("start"), (F.col("start") + F.length("word")).alias("end"))


def trm02_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Every place of a dictionary word in the chunks."""
    return _spans(spark, d).select(F.col("id").alias("chunk_id"), "word", "start", "end")


def gld01_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions kept longest first without overlap."""
    return longest_first(_spans(spark, d), ["id"]).select(F.col("id").alias("chunk_id"), "word", "start", "end")


def gld09_nested(spark: SparkSession, d: str) -> DataFrame:
    """Mentions that lie within another mention of the chunk."""
    s = _spans(spark, d, heads=True)
    o = overlap_join(s.select("id", F.struct("word", "start", "end").alias("l_id"), F.col("start").alias("l_start"), F.col("end").alias("l_end")), s.select("id", F.struct("word", "start", "end").alias("r_id"), F.col("start").alias("r_start"), F.col("end").alias("r_end")), "id")
    inside = (F.col("r_id.start") <= F.col("l_id.start")) & (F.col("l_id.end") <= F.col("r_id.end")) & (F.col("l_id") != F.col("r_id"))
    return o.filter(inside).select(F.col("id").alias("chunk_id"), F.col("l_id.word").alias("inner_word"), F.col("r_id.word").alias("outer_word"), F.col("l_id.start").alias("start"))


def trm01_terms(spark: SparkSession, d: str) -> DataFrame:
    """Phrases of up to three words that stand in at least a hundredth of the documents and twenty of them."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return candidate_terms(docs, 3, max(20, docs.count() // 100))


def src19_properties(spark: SparkSession, d: str) -> DataFrame:
    """Units named in the properties of the nodes."""
    n = table(spark, d, "nodes").select("node_id", F.get_json_object("properties_json", "$.unit").alias("unit")).distinct()
    return n.filter("unit is not null").groupBy("unit").agg(F.count(F.lit(1)).alias("n_nodes"))


def exp06_means(spark: SparkSession, d: str) -> DataFrame:
    """Mean share of right names over the months, in percent with two places."""
    o = table(spark, d, "observation").select("obs_id", F.date_format("observed_at", "yyyy-MM").alias("month")).filter("month is not null").distinct()
    m = _conf(spark, d).join(o, "obs_id").groupBy("month").agg((F.sum("tp") / F.sum(F.col("tp") + F.col("fn")) * 100).alias("recall"))
    return m.agg(F.round(F.avg("recall"), 2).alias("mean_recall"), F.count(F.lit(1)).alias("n_months"))


_CF = """k as (select k, min(p) p from (select unnest(list_concat([standard_name, abbreviation], aliases)) k, standard_name p from lab_term) where k is not null group by k),
gold as (select distinct obs_id, coalesce(site_code, '') site_code, coalesce(sample_type, '') sample_type, standard_name from observation where standard_name in (select standard_name from lab_term)),
pred as (select distinct obs_id, coalesce(site_code, '') site_code, coalesce(sample_type, '') sample_type, p standard_name from observation join k on raw_name = k),
cf as (select obs_id, site_code, sample_type, standard_name, (g.x is not null and p.x is not null)::int tp, (g.x is null)::int fp, (p.x is null)::int fn
  from (select *, 1 x from gold) g full join (select *, 1 x from pred) p using (obs_id, site_code, sample_type, standard_name))"""


def _scored(by: str) -> str:
    return f"""sc as (select {by}, tp, fp, fn, round(p, 6) "precision", round(r, 6) recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 6) f1 from (select *,
 case when tp + fp > 0 then tp / (tp + fp)::double when tp + fn = 0 then 1.0 else 0.0 end p, case when tp + fn > 0 then tp / (tp + fn)::double else 1.0 end r
 from (select {by}, sum(tp)::bigint tp, sum(fp)::bigint fp, sum(fn)::bigint fn from cf group by {by})))"""


_SP = f"""{CH}, wd as (select distinct word from (select unnest(list_concat([standard_name, abbreviation], coalesce(aliases, []))) word from lab_term union all select name from nodes) where length(word) >= 2), pl as (select chunk_id, word, text, unnest(list_filter(range(1, length(text) + 1), lambda i: substr(text, i, length(word)) = word)) p from ch join wd on contains(text, word)),
sp as (select chunk_id, word, (p - 1)::int as start, (p - 1 + length(word))::int as "end" from pl where (p = 1 or not regexp_matches(substr(text, p - 1, 1), '[A-Za-z0-9_]')) and not regexp_matches(substr(text, p + length(word), 1), '[A-Za-z0-9_]'))"""
SQL = {
    "agg09_scores": f"""with {_CF.replace("cf as (select obs_id", "cf as (select 'all' as \"all\", obs_id")}, {_scored('"all"')} select * from sc""",
    "agg11_by_site": f"with {_CF}, {_scored('site_code')} select * from sc",
    "agg14_by_term": f"with {_CF}, {_scored('standard_name')} select * from sc",
    "agg12_macro": f'with {_CF}, {_scored("standard_name")} select round(avg("precision"), 4) "precision", round(avg(recall), 4) recall, round(avg(f1), 4) f1, count(*) n_terms from sc',
    "agg13_rollup": f"""with {_CF}, a as (select coalesce(sample_type, '(all)') sample_type, sum(tp)::bigint tp, sum(fp)::bigint fp, sum(fn)::bigint fn from cf group by rollup (sample_type))
select sample_type, tp, fp, fn, round(case when tp = 0 then 0 else 2.0e0 * tp / (2 * tp + fp + fn) end, 6) f1 from a""",
    "agg15_issues": f"with {_CF} select standard_name reason, count(*) n, case when count(*) < 5 then 'low' when count(*) < 20 then 'medium' else 'high' end severity, standard_name in ('Hemoglobin', 'Potassium') critical from cf where fn = 1 group by 1",
    "set01_sets": f"""with {_CF}, p as (select distinct obs_id, standard_name from pred), g as (select distinct obs_id, standard_name from gold)
select 'both' part, count(*) n from (select * from p intersect select * from g) union all select 'only_predicted', count(*) from (select * from p except select * from g) union all select 'only_gold', count(*) from (select * from g except select * from p)""",
    "set02_first_wins": """with n as (select distinct node_id, node_type, name, created_at from nodes) select node_id, node_type, name from (select *, row_number() over (partition by node_id order by created_at, name, node_type) r from n) where r = 1 or node_id is null""",
    "set07_coverage": f"""with {CH}, p as (select distinct page_id, 1 a from page_text where cleaned_text is not null), c as (select distinct page_id, 1 b from ch)
select case when b is null then 'page_only' when a is null then 'chunk_only' else 'both' end side, count(*) n_pages from p full join c using (page_id) group by 1""",
    "trm02_annotations": f"with {_SP} select * from sp",
    "gld09_nested": f"""with {_SP.replace("select distinct word from (", "select distinct unnest([word, split_part(word, ' ', -1)]) word from (").replace("on contains(text, word)", "on length(word) >= 2 and contains(text, word)")} select i.chunk_id, i.word inner_word, o.word outer_word, i.start from sp i join sp o on i.chunk_id = o.chunk_id and o.start <= i.start and i."end" <= o."end" and (i.word, i.start) <> (o.word, o.start)""",
    "trm01_terms": """with w as (select doc_id, regexp_extract_all(lower(text), '[a-z]{3,}') w from documents where text is not null),
p as (select doc_id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) term from w)
select term, count(*) n, count(distinct doc_id) n_docs from p group by term having count(distinct doc_id) >= (select greatest(20, count(*) // 100) from documents)""",
    "src19_properties": "select unit, count(*) n_nodes from (select distinct node_id, properties_json::json->>'unit' unit from nodes) where unit is not null group by 1",
    "exp06_means": f"""with {_CF}, o as (select distinct obs_id, strftime(observed_at, '%Y-%m') m from observation where observed_at is not null), x as (select m, sum(tp) / sum(tp + fn)::double * 100 r from cf join o using (obs_id) group by m)
select round(avg(r), 2) mean_recall, count(*) n_months from x""",
}
QUERIES = {f.__name__: f for f in (
    agg09_scores, agg11_by_site, agg14_by_term, agg12_macro, agg13_rollup, agg15_issues, set01_sets, set02_first_wins, set07_coverage, match01_matching, trm02_annotations, gld01_mentions,
    gld09_nested, trm01_terms, src19_properties, exp06_means,
)}
