"""Queries of the graph operators over nodes and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.functions.text import disjoint_count, overlapping_count
from quillon.operators.graph import adjacency, bounded_search, components, constraint_violations, counts_by, replay_evidence, strongest_per_chunk, suffix_parents, upsert
from quillon.plans.retrieval import CH, ND, chunks, live_nodes
from quillon.sources.tables import table

START = "Hemoglobin raised"
EV = "array<struct<chunk_id:string,chunk_sha256:string,exact_quote:string>>"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "edges").select("triple_id", "subject_id", "predicate", "object_id", "layer", "status", "properties_json", "evidence_json", "origins_json", "created_at").distinct()


def join10_adjacency(spark: SparkSession, d: str) -> DataFrame:
    """In- and outgoing edges of every referenced node by relation."""
    return adjacency(_edges(spark, d)).groupBy("src", "relation").agg(F.count(F.lit(1)).alias("degree"), F.count(F.when(F.col("forward"), 1)).alias("outgoing"))


def grf01_search(spark: SparkSession, d: str) -> DataFrame:
    """All nodes within three steps of the nodes of one name, with the step at which they are reached."""
    starts = live_nodes(spark, d).filter(F.col("name") == START).select(F.col("node_id").alias("start"))
    return bounded_search(starts, adjacency(_edges(spark, d))).select("start", "node", "hops", "score")


def agg27_strongest(spark: SparkSession, d: str) -> DataFrame:
    """Per cited chunk the strongest hit: the nearest edge from the start nodes, by its score and key."""
    near = grf01_search(spark, d).groupBy("node").agg(F.max("score").alias("score"))
    e = _edges(spark, d).join(near, F.col("subject_id") == F.col("node"))
    hits = e.select(F.explode(F.from_json("evidence_json", EV)).alias("v"), "score", F.col("triple_id").alias("path")).select("v.chunk_id", "score", "path")
    return strongest_per_chunk(hits.filter("chunk_id is not null")).select("chunk_id", "score", "path")


def join09_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Every citation of the edges replayed against the live chunks."""
    cited = _edges(spark, d).select(F.col("triple_id").alias("key"), F.explode(F.from_json("evidence_json", EV)).alias("v")).select("key", "v.*")
    return replay_evidence(cited, chunks(spark, d)).groupBy("status").agg(F.count(F.lit(1)).alias("n_citations"))


def _quotes(spark: SparkSession, d: str) -> DataFrame:
    """``triple_id, chunk_id, exact_quote, text``: the distinct quotes of the edges with the live chunk of the cited hash."""
    q = _edges(spark, d).select("triple_id", F.explode(F.from_json("evidence_json", EV)).alias("v")).select("triple_id", "v.*").filter("exact_quote <> ''").distinct()
    return q.join(chunks(spark, d).select("chunk_id", "chunk_sha256", "text").distinct(), ["chunk_id", "chunk_sha256"])


def val06_unique_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Quotes of the edges that stand exactly once in their chunk, places without overlap counted."""
    return _quotes(spark, d).filter(disjoint_count(F.col("text"), F.col("exact_quote")) == 1).select("triple_id", "chunk_id", "exact_quote", F.expr("locate(exact_quote, text)").alias("place"))


def val07_quote_places(spark: SparkSession, d: str) -> DataFrame:
    """How often the quotes of the edges stand in their chunk, overlapping places counted."""
    n = F.when(F.contains("text", "exact_quote"), overlapping_count(F.col("text"), F.col("exact_quote"))).otherwise(0)
    return _quotes(spark, d).select("triple_id", "chunk_id", "exact_quote", n.alias("n"))


def agg06_counts(spark: SparkSession, d: str) -> DataFrame:
    """Histograms of the graph: node types, predicates, layers, origins."""
    n = counts_by(live_nodes(spark, d), {"node_type": F.col("node_type")})
    e = counts_by(_edges(spark, d), {"predicate": F.col("predicate"), "layer": F.col("layer"), "status": F.col("status")})
    o = _edges(spark, d).select(F.explode(F.from_json("origins_json", "array<string>")).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(F.lit("origin").alias("kind"), "value", "n")
    return n.unionByName(e).unionByName(o)


def grf19_constraints(spark: SparkSession, d: str) -> DataFrame:
    """Broken constraints of the candidate graph, counted by rule."""
    nodes = table(spark, d, "nodes").select("node_id", "node_type", "created_at", "deleted_at").distinct()
    return constraint_violations(nodes, _edges(spark, d), {"PART_OF": ("LabIndicator", "LabPanel")}).groupBy("rule").agg(F.count(F.lit(1)).alias("n_violations"))


def agg30_upsert(spark: SparkSession, d: str) -> DataFrame:
    """All versions of a node merged: latest scalars, united origins."""
    n = table(spark, d, "nodes").select("node_id", "node_type", "name", "status", "origins_json", "created_at").distinct()
    merged = upsert(n.withColumn("origins", F.from_json("origins_json", "array<string>")), ["node_id"], "created_at", ["node_type", "name", "status"], ["origins"])
    return merged.select("node_id", "node_type", "name", "status", F.concat_ws(",", "origins").alias("origins"), "n_rows")


def agg31_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges merged by subject, predicate and object: latest status, united origins."""
    e = _edges(spark, d).filter("subject_id is not null and object_id is not null").withColumn("origins", F.from_json("origins_json", "array<string>"))
    m = upsert(e, ["subject_id", "predicate", "object_id"], "created_at", ["status", "layer"], ["origins"])
    return m.select("subject_id", "predicate", "object_id", "status", "layer", F.concat_ws(",", "origins").alias("origins"), "n_rows")


def agg23_all_components(spark: SparkSession, d: str) -> DataFrame:
    """Connected components of all edges, whatever their layer."""
    links = _edges(spark, d).select(F.col("subject_id").alias("a"), F.col("object_id").alias("b"))
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).filter("node is not null")
    return components(ends, links)


def grf20_final(spark: SparkSession, d: str) -> DataFrame:
    """Final projection: live approved-free triples with both ends alive, predicates renamed, new triple ids."""
    n = live_nodes(spark, d).select("node_id")
    e = _edges(spark, d).filter("status <> 'rejected'").join(n.withColumnRenamed("node_id", "subject_id"), "subject_id", "left_semi").join(n.withColumnRenamed("node_id", "object_id"), "object_id", "left_semi")
    p = F.when(F.col("predicate") == "SUGGESTS", "INDICATES").when(F.col("predicate") == "OBSERVED_IN", "SEEN_IN").otherwise(F.col("predicate"))
    new = F.concat(F.lit("final:"), F.substring(F.sha2(F.concat_ws("|", "subject_id", p, "object_id"), 256), 1, 16))
    return e.select(new.alias("triple_id"), "subject_id", p.alias("predicate"), "object_id").distinct()


def grf25_is_a(spark: SparkSession, d: str) -> DataFrame:
    """Names that end with another name."""
    names = live_nodes(spark, d).select(F.lower("name").alias("name")).union(table(spark, d, "lab_term").select(F.explode(F.transform(F.concat(F.array("standard_name"), "aliases"), F.lower)))).distinct()
    return suffix_parents(names)


def val30_hydrate(spark: SparkSession, d: str) -> DataFrame:
    """Vectors that belong to a live chunk with the same hash."""
    v = table(spark, d, "vectors").select("chunk_id", "chunk_sha256").distinct()
    return v.join(chunks(spark, d).select("chunk_id", "chunk_sha256"), ["chunk_id", "chunk_sha256"], "left_semi").select("chunk_id")


def val31_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Persisted vectors that break the contract: no entries, a negative weight, or a length other than 1."""
    v = table(spark, d, "vectors").select("chunk_id", "vector_json").distinct()
    w = F.map_values(F.from_json("vector_json", "map<string,double>"))
    norm = F.sqrt(F.aggregate(w, F.lit(0.0), lambda a, x: a + x * x))
    bad = F.when(F.coalesce(F.size(w), F.lit(0)) <= 0, "empty").when(F.exists(w, lambda x: x < 0), "negative").when(F.abs(norm - 1) > 2e-11, "not_unit")
    return v.select(F.coalesce(bad, F.lit("ok")).alias("state")).groupBy("state").agg(F.count(F.lit(1)).alias("n_vectors"))


_E = "ed as (select distinct triple_id, subject_id, predicate, object_id, layer, status, properties_json, evidence_json, origins_json, created_at from edges)"
_ADJ = "adj as (select subject_id src, predicate relation, object_id dst, 1 fw from ed where subject_id is not null and object_id is not null union all select object_id, predicate, subject_id, 0 from ed where subject_id is not null and object_id is not null)"
_BFS = f"""{ND}, {_E}, {_ADJ}, pr as (select distinct src, dst from adj), s0 as (select node_id st, node_id n from nd where name = '{START}'),
s1 as (select distinct st, dst n from s0 join pr on n = src where (st, dst) not in (select (st, n) from s0)),
s2 as (select distinct st, dst n from s1 join pr on n = src where (st, dst) not in (select (st, n) from s0 union all select (st, n) from s1)),
s3 as (select distinct st, dst n from s2 join pr on n = src where (st, dst) not in (select (st, n) from s0 union all select (st, n) from s1 union all select (st, n) from s2)),
bfs as (select st as "start", n node, hops, round(1 / (1 + hops::double), 6) score from (select st, n, 0 hops from s0 union all select st, n, 1 from s1 union all select st, n, 2 from s2 union all select st, n, 3 from s3))"""
_CITE = """cited as (select triple_id, j->>'chunk_id' chunk_id, j->>'chunk_sha256' h, j->>'exact_quote' q from (select triple_id, unnest(from_json(evidence_json, '["JSON"]')) j from ed))"""
_ORIG = "list_sort(list_distinct(flatten(list(from_json(origins_json, '[\"VARCHAR\"]')))))"
SQL = {
    "join10_adjacency": f"with {_E}, {_ADJ} select src, relation, count(*) degree, sum(fw)::bigint outgoing from adj group by all",
    "grf01_search": f'with {_BFS} select "start", node, hops, score from bfs',
    "agg27_strongest": f"""with {_BFS}, {_CITE}, near as (select node, max(score) score from bfs group by node)
select chunk_id, score, path from (select chunk_id, score, ed.triple_id path, row_number() over (partition by chunk_id order by score desc, ed.triple_id) r from ed join near on subject_id = node join cited on cited.triple_id = ed.triple_id where chunk_id is not null) where r = 1""",
    "join09_evidence": f"""with {_E}, {CH}, {_CITE}, c as (select chunk_id c, any_value(chunk_sha256) s, any_value(text) t from ch group by 1)
select case when c is null then 'missing' when s <> h then 'drifted' when q is null or (length(t) - length(replace(t, q, '')) = length(q)) then 'verified' else 'not_unique' end status, count(*) n_citations from cited left join c on c = chunk_id group by 1""",
    "agg06_counts": f"""with {ND}, {_E} select 'node_type' kind, node_type as value, count(*) n from nd group by 2 union all select 'predicate', predicate, count(*) from ed group by 2
union all select 'layer', layer, count(*) from ed group by 2 union all select 'status', status, count(*) from ed group by 2
union all select 'origin', o, count(*) from (select unnest(from_json(origins_json, '["VARCHAR"]')) o from ed) group by 2""",
    "grf19_constraints": f"""with {_E}, nk as (select node_id, count(*) n, max(node_type) t from (select distinct node_id, node_type, created_at, deleted_at from nodes) group by 1),
b as (select ed.*, s.t st, o.t ot from ed left join nk s on s.node_id = subject_id left join nk o on o.node_id = object_id)
select 'repeated_node' as rule, count(*) n_violations from nk where n > 1 having count(*) > 0 union all
select r, count(*) from (select unnest([case when subject_id is null or object_id is null then 'null_end' end, case when subject_id is not null and st is null then 'dangling_subject' end,
case when object_id is not null and ot is null then 'dangling_object' end, case when subject_id = object_id then 'self_loop' end, case when predicate = 'PART_OF' and (st <> 'LabIndicator' or ot <> 'LabPanel') then 'wrong_type_PART_OF' end]) r from b) where r is not null group by 1""",
    "agg30_upsert": f"""select node_id, arg_max(node_type, struct_pack(a := created_at, b := node_type)) node_type, arg_max(name, struct_pack(a := created_at, b := name)) as name, arg_max(status, struct_pack(a := created_at, b := status)) status,
array_to_string({_ORIG}, ',') origins, count(*) n_rows from (select distinct node_id, node_type, name, status, origins_json, created_at from nodes) group by node_id""",
    "agg31_edges": f"""with {_E} select subject_id, predicate, object_id, arg_max(status, struct_pack(a := created_at, b := status)) status, arg_max(layer, struct_pack(a := created_at, b := layer)) layer,
array_to_string({_ORIG}, ',') origins, count(*) n_rows from ed where subject_id is not null and object_id is not null group by 1, 2, 3""",
    "grf20_final": f"""with {ND}, {_E}, p as (select subject_id, case predicate when 'SUGGESTS' then 'INDICATES' when 'OBSERVED_IN' then 'SEEN_IN' else predicate end p, object_id from ed
where status <> 'rejected' and subject_id in (select node_id from nd) and object_id in (select node_id from nd)) select distinct 'final:' || substr(sha256(subject_id || '|' || p || '|' || object_id), 1, 16) triple_id, subject_id, p as predicate, object_id from p""",
    "grf25_is_a": f"""with {ND}, nm as (select lower(name) as name from nd union select lower(unnest(list_concat([standard_name], aliases))) from lab_term), s as (select name, substr(name, i::bigint) parent from (select name, unnest(range(3, greatest(length(name), 3) + 1)) i from nm))
select distinct name, parent from s where parent <> '' and parent <> name and parent in (select name from nm)""",
    "val30_hydrate": f"with {CH} select chunk_id from (select distinct chunk_id, chunk_sha256 from vectors) where (chunk_id, chunk_sha256) in (select (chunk_id, chunk_sha256) from ch)",
    "val31_vectors": """with v as (select map_values(from_json(vector_json, '{}'::json)::map(varchar, double)) w from (select distinct chunk_id, vector_json from vectors)) select 1""",
}
SQL["val31_vectors"] = """with v as (select list_transform(json_keys(vector_json), lambda k: (vector_json::json->>k)::double) w from (select distinct chunk_id, vector_json from vectors))
select case when coalesce(len(w), 0) = 0 then 'empty' when list_min(w) < 0 then 'negative' when abs(sqrt(list_sum(list_transform(w, lambda x: x * x))) - 1) > 2e-11 then 'not_unit' else 'ok' end state, count(*) n_vectors from v group by 1"""
_QT = f"{_E}, {CH}, {_CITE}, qt as (select distinct triple_id, c.chunk_id, q exact_quote, text from cited c join ch on ch.chunk_id = c.chunk_id and chunk_sha256 = h where q <> '')"
SQL["val06_unique_quotes"] = f"with {_QT} select triple_id, chunk_id, exact_quote, instr(text, exact_quote)::int place from qt where length(text) - length(replace(text, exact_quote, '')) = length(exact_quote)"
SQL["val07_quote_places"] = f"with {_QT} select triple_id, chunk_id, exact_quote, len(list_filter(range(1, length(text) + 1), lambda i: substr(text, i, length(exact_quote)) = exact_quote))::int n from qt"
QUERIES = {f.__name__: f for f in (
    join10_adjacency, grf01_search, agg27_strongest, join09_evidence, agg06_counts, grf19_constraints, agg30_upsert, agg31_edges, agg23_all_components, grf20_final, grf25_is_a, val06_unique_quotes, val07_quote_places, val30_hydrate, val31_vectors,
)}
