"""Queries of the retrieval operators over evidence chunks and graph nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quillon.functions.text import distinct_tokens, first_sentence, fold_lower, grams, query_terms
from quillon.operators.retrieval import bm25, cosine_search, expand_neighbours, fuse, lexical_search, record_search, tfidf_weights
from quillon.sources.tables import table

QUERY, NAME, K = "heparin level 血涂片", "hemoglobin raised", 20


def chunks(spark: SparkSession, d: str) -> DataFrame:
    """Live chunks, once each."""
    cols = ["chunk_id", "page_id", "document_id", "chapter_id", "chapter_page_index", F.col("cleaned_char_start").alias("s"), F.col("cleaned_char_end").alias("e"), "text", "chunk_sha256"]
    return table(spark, d, "evidence_chunk").filter("deleted_at is null").select(*cols).distinct()


def live_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Live nodes, the latest version of each."""
    n = table(spark, d, "nodes").filter("deleted_at is null and node_id is not null").select("node_id", "node_type", "name", "created_at").distinct()
    last = n.groupBy("node_id").agg(F.max(F.struct("created_at", "node_type", "name")).alias("r"))
    return last.select("node_id", "r.node_type", "r.name", "r.created_at")


CH = """ch as (select distinct chunk_id, page_id, document_id, chapter_id, chapter_page_index, cleaned_char_start s, cleaned_char_end e, text, chunk_sha256
  from evidence_chunk where deleted_at is null)"""
ND = """nd as (select node_id, r.node_type node_type, r.name as name, r.created_at created_at from (select node_id, max(struct_pack(created_at := created_at, node_type := node_type, name := name)) r
  from nodes where deleted_at is null and node_id is not null group by node_id))"""
_W = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_P = ("".join(chr(0x21 + i) for i in range(94)) + " ").replace("'", "''")


def fold_sql(x: str) -> str:
    """The SQL of :func:`quillon.functions.text.fold_lower`."""
    return f"trim(lower(translate({x}, '{_W}', '{_P}')))"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_LEX = f"""{CH}, f as (select chunk_id, page_id, s, {fold_sql('text')} t from ch), q as (select unnest({_list(query_terms(QUERY))}) x), n as (select count(*) n from f),
df as (select x, count(chunk_id) df from q left join f on contains(t, x) group by x),
sc as (select chunk_id, sum(ln((n + 1.0e0) / (df + 1.0e0)) + 1.0e0) v from f join q on contains(t, x) join df using (x), n group by chunk_id),
hits as (select chunk_id, round(coalesce(v, 0) + case when contains(t, '{QUERY}') then 1 else 0 end, 6) score from f left join sc using (chunk_id)),
lexical as (select * from hits where score > 0 order by score desc, chunk_id limit {K})"""


def ret01_lexical(spark: SparkSession, d: str) -> DataFrame:
    """Lexical evidence search (top-k report)."""
    return lexical_search(chunks(spark, d).select("chunk_id", "text"), QUERY, K)


def join29_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """A search of three hits, filled up with the neighbouring chunks (top-k report)."""
    c = chunks(spark, d)
    return expand_neighbours(lexical_search(c.select("chunk_id", "text"), QUERY, 3), c, 8)


def agg01_document_frequency(spark: SparkSession, d: str) -> DataFrame:
    """How many chunks hold each query term."""
    f = chunks(spark, d).select(fold_lower(F.col("text")).alias("t"))
    row = f.agg(*[F.count(F.when(F.col("t").contains(x), 1)).alias(x) for x in query_terms(QUERY)])
    return row.select(F.explode(F.map_from_arrays(F.array(*[F.lit(x) for x in query_terms(QUERY)]), F.array(*[F.col(f"`{x}`") for x in query_terms(QUERY)]))).alias("term", "df"))


def ret05_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Size and length of the n-gram vector of every node name."""
    docs = live_nodes(spark, d).select(F.col("node_id").alias("id"), F.col("name").alias("text"))
    return tfidf_weights(docs).groupBy("id").agg(F.count(F.lit(1)).alias("n_grams"), F.round(F.max("norm"), 6).alias("norm"))


def agg02_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """The n-gram vocabulary of the node names with document frequencies."""
    docs = live_nodes(spark, d).select("node_id", F.explode(F.array_distinct(grams(fold_lower(F.col("name")), 2, 3))).alias("gram"))
    return docs.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))


def ret06_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Nearest node names by cosine (top-k report)."""
    docs = live_nodes(spark, d).select(F.col("node_id").alias("id"), F.col("name").alias("text"))
    return cosine_search(docs, NAME, K)


def _records(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return live_nodes(spark, d).select(F.col("node_id").alias("record_id"), F.col("name").alias("standard_name"), F.col("name").alias("title"), F.concat_ws(" ", "name", "name", "node_type").alias("body"), F.col("node_type").alias("rule_type"), F.array().cast("array<string>").alias("conditions"), F.array().cast("array<string>").alias("aliases"), none.alias("parent_id"))


def ret03_records(spark: SparkSession, d: str) -> DataFrame:
    """Rule-record search over the nodes (top-k report)."""
    return record_search(_records(spark, d), NAME, K)


def flt02_type_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rule-record search in one type of records (top-k report)."""
    return record_search(_records(spark, d), NAME, K, ["IndicatorState"])


def fn41_bm25(spark: SparkSession, d: str) -> DataFrame:
    """The token score of every node that has one."""
    return bm25(_records(spark, d).select("record_id", "body"), NAME).filter("bm25 > 0")


def _graph_channel(spark: SparkSession, d: str) -> DataFrame:
    """Chunks cited by the edges, scored by their number of citing edges."""
    ev = F.from_json("evidence_json", "array<struct<chunk_id:string,chunk_sha256:string,exact_quote:string>>")
    cited = table(spark, d, "edges").select("triple_id", F.explode(ev).alias("v")).select("triple_id", "v.chunk_id").distinct()
    return cited.groupBy("chunk_id").agg(F.round(1 - 1 / (1 + F.count(F.lit(1))), 6).alias("score"))


def ret02_fusion(spark: SparkSession, d: str) -> DataFrame:
    """Lexical and graph channel fused (top-k report)."""
    c = chunks(spark, d)
    graph = _graph_channel(spark, d).join(c.select("chunk_id"), "chunk_id", "left_semi").orderBy(F.desc("score"), "chunk_id").limit(3 * K)
    return fuse(lexical_search(c.select("chunk_id", "text"), QUERY, K), graph, K)


def ret10_expansion(spark: SparkSession, d: str) -> DataFrame:
    """Search phrases of every abnormal observation: each of its names, raised or lowered."""
    o = table(spark, d, "observation").filter("report_flag in ('high', 'low')").select("obs_id", "abbreviation", "standard_name", "raw_name", "report_flag").distinct()
    word = F.when(F.col("report_flag") == "high", "升高").otherwise("降低")
    return o.select("obs_id", F.explode(F.array_distinct(F.transform(F.array_compact(F.array("abbreviation", "standard_name", "raw_name")), lambda n: F.concat(n, word)))).alias("phrase")).distinct()


def ret11_answer(spark: SparkSession, d: str) -> DataFrame:
    """The first sentence of each hit, numbered in the order of the hits."""
    c = chunks(spark, d).select("chunk_id", "text")
    hits = lexical_search(c, QUERY, 5)
    ranked = hits.withColumn("n", F.row_number().over(W.partitionBy().orderBy(F.desc("score"), "chunk_id")))  # five rows
    return c.join(F.broadcast(ranked), "chunk_id").select("n", "chunk_id", F.concat(first_sentence(F.col("text")), F.lit("["), F.col("n"), F.lit("]")).alias("sentence"))


def ret12_diagnostic(spark: SparkSession, d: str) -> DataFrame:
    """Whether each distinct raw name of the observations stands for a node: matched, a missing alias or a missing entity."""
    raw = table(spark, d, "observation").select(fold_lower(F.col("raw_name")).alias("q"), F.col("raw_name").rlike("^[A-Z0-9%#-]{2,8}$").alias("short")).filter("q is not null").groupBy("q").agg(F.max("short").alias("short"))
    names = live_nodes(spark, d).select(fold_lower(F.col("name")).alias("q")).distinct().withColumn("known", F.lit(True))
    state = F.when(F.col("known"), "matched").when(F.col("short"), "alias_missing").otherwise("entity_missing")
    return raw.join(names, "q", "left").groupBy(state.alias("diagnostic")).agg(F.count(F.lit(1)).alias("n_names"))


def fn03_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Distinct tokens of every document."""
    return table(spark, d, "documents").select("doc_id", F.concat_ws(" ", distinct_tokens(fold_lower(F.col("text")))).alias("tokens"), F.size(distinct_tokens(fold_lower(F.col("text")))).alias("n_tokens"))


def agg04_average_length(spark: SparkSession, d: str) -> DataFrame:
    """Average number of distinct tokens of a document, at least one each."""
    return table(spark, d, "documents").agg(F.round(F.avg(F.greatest(F.lit(1), F.coalesce(F.size(distinct_tokens(fold_lower(F.col("text")))), F.lit(0)))), 6).alias("average"))


def fn40_hashes(spark: SparkSession, d: str) -> DataFrame:
    """The hash of every document's text."""
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


_GR = f"""{ND}, t as (select node_id id, regexp_replace({fold_sql('name')}, '\\s+', ' ', 'g') t from nd), n as (select count(*) n from t),
g as (select id, unnest(list_concat(list_transform(range(1, greatest(length(t), 1)), lambda i: substr(t, i, 2)), list_transform(range(1, greatest(length(t) - 1, 1)), lambda i: substr(t, i, 3)))) gram from t),
tf as (select id, gram, count(*) tf from g where trim(gram) <> '' group by all), df as (select gram, count(*) df from tf group by gram),
w as (select id, gram, tf * (ln((n + 1.0e0) / (df + 1.0e0)) + 1.0e0) w from tf join df using (gram), n)"""
_REC = f"""{ND}, r as (select node_id record_id, node_type, {fold_sql('name')} t, name || ' ' || name || ' ' || node_type body from nd),
k as (select record_id, list_distinct(list_concat(regexp_extract_all(body, '[a-z0-9]+'), regexp_extract_all(body, '[㐀-鿿]+'))) raw,
  list_distinct(list_concat(regexp_extract_all({fold_sql('body')}, '[a-z0-9]+'), regexp_extract_all({fold_sql('body')}, '[㐀-鿿]+'))) own from r),
st as (select count(*) n, sum(greatest(1, len(raw))) / count(*)::double av from k), q as (select unnest({_list(query_terms(NAME))}) x),
df as (select x, count(record_id) df from q left join k on list_contains(raw, x) group by x),
bm as (select record_id, round(sum(ln(1 + (n - df + 0.5e0) / (df + 0.5e0))) * 2.0e0 / (1 + 1.2e0 * (0.25e0 + 0.75e0 * max(len(own)) / max(av))), 6) bm25
  from k join q on list_contains(own, x) join df using (x), st group by record_id)"""
_HIT = f"""select record_id, round(case when t = '{NAME}' then 100 else 0 end + case when contains(t, '{NAME}') and t <> '{NAME}' then 30 else 0 end + %s + coalesce(bm25, 0), 6) score
  from r left join bm using (record_id) where (contains(t, '{NAME}') or coalesce(bm25, 0) > 0) %s order by score desc, record_id limit {K}"""
_GC = """gc as (select chunk_id, round(1 - 1.0e0 / (1 + count(*)), 6) score from (select distinct triple_id, unnest(from_json(evidence_json, '["JSON"]'))->>'chunk_id' chunk_id from edges) group by chunk_id),
gr as (select * from gc where chunk_id in (select chunk_id from ch) order by score desc, chunk_id limit 60)"""
SQL = {
    "ret01_lexical": f"with {_LEX} select chunk_id, score from lexical",
    "join29_neighbours": f"""with {_LEX}, top as (select chunk_id, score, row_number() over (order by score desc, chunk_id) rk from (select * from lexical order by score desc, chunk_id limit 3)),
near as (select chunk_id, lag(chunk_id) over (partition by page_id order by s, chunk_id) b, lead(chunk_id) over (partition by page_id order by s, chunk_id) a from ch),
x as (select rk, 0 side, b chunk_id from top join near using (chunk_id) union all select rk, 1, a from top join near using (chunk_id)),
y as (select chunk_id, min(rk * 10 + side) o from x where chunk_id is not null and chunk_id not in (select chunk_id from top) group by 1)
select chunk_id, score, reason from (select chunk_id, score, 'hit' reason, rk o from top union all select chunk_id, 0.0, 'neighbour', 1000 + o from y) order by o limit 8""",
    "agg01_document_frequency": f"with {_LEX} select x as term, df from df",
    "ret05_vectors": f"with {_GR} select id, count(*) n_grams, round(sqrt(sum(w * w)), 6) norm from w group by id",
    "agg02_vocabulary": f"with {_GR} select gram, df from df",
    "ret06_cosine": f"""with {_GR}, qg as (select unnest(list_concat(list_transform(range(1, {len(NAME)}), lambda i: substr('{NAME}', i, 2)), list_transform(range(1, {len(NAME) - 1}), lambda i: substr('{NAME}', i, 3)))) gram),
qv as (select gram, count(*) * (ln((any_value(n) + 1.0e0) / (any_value(df) + 1.0e0)) + 1.0e0) qw from qg join df using (gram), n group by gram), qn as (select sqrt(sum(qw * qw)) qn from qv)
select * from (select id, round(sum(w * coalesce(qw, 0)) / (sqrt(sum(w * w)) * any_value(qn)), 6) score from w left join qv using (gram), qn group by id) where score >= 0.12 order by score desc, id limit {K}""",
    "ret03_records": f"with {_REC} " + _HIT % ("0", ""),
    "flt02_type_filter": f"with {_REC} " + _HIT % ("8", "and node_type = 'IndicatorState'"),
    "fn41_bm25": f"with {_REC} select record_id, bm25 from bm where bm25 > 0",
    "ret02_fusion": f"""with {_LEX}, {_GC} select chunk_id, round(coalesce(l.score, 0) + 2 * coalesce(g.score, 0), 6) score, concat_ws('+', case when l.score is not null then 'lexical' end, case when g.score is not null then 'graph' end) reason
from lexical l full join gr g using (chunk_id) order by score desc, chunk_id limit {K}""",
    "ret10_expansion": """select distinct obs_id, n || case when report_flag = 'high' then '升高' else '降低' end phrase from (
select obs_id, report_flag, unnest([abbreviation, standard_name, raw_name]) n from observation where report_flag in ('high', 'low')) where n is not null""",
    "ret11_answer": f"""with {_LEX}, top as (select chunk_id, row_number() over (order by score desc, chunk_id) n from (select * from lexical order by score desc, chunk_id limit 5))
select n::int n, chunk_id, trim(case when regexp_matches(trim(text), '[。！？.!?]') then regexp_extract(trim(text), '^((?s:.)*?[。！？.!?])', 1) else trim(text) end) || '[' || n || ']' as sentence from ch join top using (chunk_id)""",
    "ret12_diagnostic": f"""with {ND}, raw as (select {fold_sql('raw_name')} q, bool_or(regexp_matches(raw_name, '^[A-Z0-9%#-]{{2,8}}$')) short from observation where raw_name is not null group by 1),
nm as (select distinct {fold_sql('name')} q from nd) select case when nm.q is not null then 'matched' when short then 'alias_missing' else 'entity_missing' end as diagnostic, count(*) n_names from raw left join nm using (q) group by 1""",
    "fn03_tokens": f"""with f as (select doc_id, {fold_sql('text')} t from documents), k as (select doc_id, list_sort(list_distinct(list_concat(regexp_extract_all(t, '[a-z0-9]+'), regexp_extract_all(t, '[㐀-鿿]+')))) k from f)
select doc_id, array_to_string(k, ' ') tokens, len(k)::int n_tokens from k""",
    "agg04_average_length": f"""with f as (select doc_id, {fold_sql('text')} t from documents)
select round(avg(greatest(1, len(list_distinct(list_concat(regexp_extract_all(t, '[a-z0-9]+'), regexp_extract_all(t, '[㐀-鿿]+')))))), 6) average from f""",
    "fn40_hashes": "select doc_id, sha256(text) as sha256 from documents",
}
QUERIES = {f.__name__: f for f in (
    ret01_lexical, join29_neighbours, agg01_document_frequency, ret05_vectors, agg02_vocabulary, ret06_cosine, ret03_records, flt02_type_filter, fn41_bm25, ret02_fusion, ret10_expansion, ret11_answer,
    ret12_diagnostic, fn03_tokens, agg04_average_length, fn40_hashes,
)}
