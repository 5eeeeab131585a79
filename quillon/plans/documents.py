"""Queries over tables, formulas, evidence units, provenance and gold building on the pages, chunks and nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quillon.functions.text import fold_case, overlapping_count
from quillon.operators.segments import lines_with_offsets
from quillon.plans.graph import _edges
from quillon.plans.retrieval import CH, ND, chunks, fold_sql, live_nodes
from quillon.plans.scoring import _SP, _spans
from quillon.plans.segments import _LN, _PG, _pages
from quillon.sources.tables import table


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return lines_with_offsets(_pages(spark, d), "page_id", "cleaned_text")


def rpt01_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the pipe tables of every page; separator lines are no rows."""
    t = _lines(spark, d).filter(F.trim("line").rlike(r"^\|.*\|$") & ~F.trim("line").rlike(r"^[|:\-\s]+$"))
    inner = F.regexp_replace(F.trim("line"), r"^\||\|$", "")
    return t.select("page_id", "line_no", F.posexplode(F.split(inner, r"\|")).alias("col", "cell")).select("page_id", "line_no", "col", F.trim("cell").alias("cell"))


def rpt03_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of analyte, result and unit of the page tables as observations, joined to the terms by their code."""
    c = rpt01_cells(spark, d).groupBy("page_id", "line_no").agg(*[F.max(F.when(F.col("col") == i, F.col("cell"))).alias(n) for i, n in enumerate(("code", "result", "unit"))], F.count(F.lit(1)).alias("n"))
    rows = c.filter("n = 3 and code <> 'analyte'")
    terms = table(spark, d, "lab_term").select(F.col("abbreviation").alias("code"), "term_id").dropna()
    return rows.join(terms, "code", "left").select("page_id", "line_no", "code", "term_id", F.col("result").try_cast("double").alias("value"), "unit")


def grf06_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables of every page: runs of neighbouring table lines, with rows and columns."""
    c = rpt01_cells(spark, d).groupBy("page_id", "line_no").agg(F.count(F.lit(1)).alias("n_cols"))
    all_lines = _lines(spark, d).filter(F.trim("line").rlike(r"^\|.*\|$")).select("page_id", "line_no")
    run = F.col("line_no") - F.row_number().over(W.partitionBy("page_id").orderBy("line_no"))
    runs = all_lines.withColumn("run", run)
    return runs.join(c, ["page_id", "line_no"], "left").groupBy("page_id", "run").agg(F.min("line_no").alias("first_line"), F.count("n_cols").alias("n_rows"), F.max("n_cols").alias("n_cols")).drop("run")


def grf07_formulas(spark: SparkSession, d: str) -> DataFrame:
    """Display formulas of every page in order."""
    p = _pages(spark, d).filter("cleaned_text is not null")
    return p.select("page_id", F.posexplode(F.regexp_extract_all("cleaned_text", F.lit(r"\$\$\n([^$]+)\n\$\$"), F.lit(1))).alias("no", "formula"))


def seg24_units(spark: SparkSession, d: str) -> DataFrame:
    """Evidence units of every page by kind: table rows, list items, other lines."""
    t = F.trim("line")
    kind = F.when(t.rlike(r"^\|.*\|$"), "table_row").when(t.rlike(r"^(\d+[.)]|[-*])\s"), "list_item").when(t.startswith("#"), "heading").otherwise("line")
    return _lines(spark, d).filter(t != "").groupBy("page_id", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_units"))


def src03_repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines that stand on at least a fifth of the pages of a document of five pages or more."""
    p = _pages(spark, d).withColumn("raw_text", F.replace("raw_text", F.lit("\r"), F.lit("")))
    r = lines_with_offsets(p, "page_id", "raw_text").filter("trim(line) <> ''").join(_pages(spark, d).select("page_id", "document_id"), "page_id")
    n = _pages(spark, d).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_pages"))
    c = r.select("document_id", F.trim("line").alias("line"), "page_id").distinct().groupBy("document_id", "line").agg(F.count(F.lit(1)).alias("n"))
    return c.join(n, "document_id").filter("n_pages >= 5 and n >= 0.2 * n_pages").select("document_id", "line", "n")


def src02_markers(spark: SparkSession, d: str) -> DataFrame:
    """Lines that hold nothing but the printed number of their page."""
    p = table(spark, d, "page_text").select("page_id", "printed_page_number", "raw_text").filter("printed_page_number is not null").dropDuplicates(["page_id"])
    r = lines_with_offsets(p.withColumn("raw_text", F.replace("raw_text", F.lit("\r"), F.lit(""))), "page_id", "raw_text")
    return r.join(p.select("page_id", "printed_page_number"), "page_id").filter(F.trim("line") == F.col("printed_page_number").cast("string")).select("page_id", "line_no")


def src32_digests(spark: SparkSession, d: str) -> DataFrame:
    """One digest per document over the hashes of its pages in order."""
    h = F.sha2(F.coalesce("cleaned_text", F.lit("")), 256)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page_id", h.alias("h")))), lambda x: F.concat_ws(":", x["page_id"], x["h"]))
    return _pages(spark, d).groupBy("document_id").agg(F.sha2(F.array_join(parts, "\n"), 256).alias("digest"))


def join31_facts(spark: SparkSession, d: str) -> DataFrame:
    """Edges with the names of their ends, where there are any."""
    n = live_nodes(spark, d)
    s, o = n.select(F.col("node_id").alias("subject_id"), F.col("name").alias("subject")), n.select(F.col("node_id").alias("object_id"), F.col("name").alias("object"))
    return _edges(spark, d).join(s, "subject_id", "left").join(o, "object_id", "left").select("triple_id", "subject", "predicate", "object")


def flt10_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts of one predicate whose subject holds a word."""
    return join31_facts(spark, d).filter((F.col("predicate") == "SUGGESTS") & F.lower("subject").contains("count"))


def exp08_items(spark: SparkSession, d: str) -> DataFrame:
    """Items for a judge: nodes and edges in one table with a snapshot of their ends."""
    n = live_nodes(spark, d).select(F.lit("node").alias("kind"), F.col("node_id").alias("item_id"), F.col("name").alias("snapshot"))
    e = join31_facts(spark, d).select(F.lit("edge").alias("kind"), F.col("triple_id").alias("item_id"), F.concat_ws(" ", F.coalesce("subject", F.lit("?")), "predicate", F.coalesce("object", F.lit("?"))).alias("snapshot"))
    return n.unionByName(e)


def join25_source_lines(spark: SparkSession, d: str) -> DataFrame:
    """The first line of each page that names a term, on the first three pages of every document (a top-k report)."""
    r = _lines(spark, d).filter(F.col("line").contains("fibrin clot")).join(_pages(spark, d).select("page_id", "document_id"), "page_id")
    first = r.groupBy("document_id", "page_id").agg(F.min(F.struct("line_no", "line")).alias("f"))
    w = W.partitionBy("document_id").orderBy("page_id")
    return first.withColumn("r", F.row_number().over(w)).filter("r <= 3").select("document_id", "page_id", "f.line_no", "f.line")


def gld02_span_union(spark: SparkSession, d: str) -> DataFrame:
    """Dictionary hits united by exact span, with their words."""
    return _spans(spark, d).groupBy(F.col("id").alias("chunk_id"), "start", "end").agg(F.concat_ws("|", F.array_sort(F.collect_set("word"))).alias("words"))


def gld06_parenthetical(spark: SparkSession, d: str) -> DataFrame:
    """Raw names of the form ``label (alias)`` split, with their rows."""
    n = table(spark, d, "observation").select("obs_id", "raw_name").distinct()
    p = n.select(F.trim(F.regexp_extract("raw_name", r"^(.+?)\s*[(（]([^()（）]+)[)）]$", 1)).alias("label"), F.trim(F.regexp_extract("raw_name", r"^(.+?)\s*[(（]([^()（）]+)[)）]$", 2)).alias("alias"))
    return p.filter("label <> ''").groupBy("label", "alias").agg(F.count(F.lit(1)).alias("n_rows"))


def gld08_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Supplement records grouped by type and folded name: aliases united."""
    w = table(spark, d, "wbc_supplement").select("canonical_id", "entity_type", F.lower(F.trim("canonical_name")).alias("k"), F.coalesce("aliases", F.array().cast("array<string>")).alias("al"), "canonical_name").distinct()
    return w.groupBy("entity_type", "k").agg(F.countDistinct("canonical_id").alias("n_records"), F.size(F.array_distinct(F.array_compact(F.flatten(F.collect_list("al"))))).alias("n_aliases"))


def fn14_stable_ids(spark: SparkSession, d: str) -> DataFrame:
    """Stable id of every edge from its three parts."""
    key = F.concat(F.lit('["'), F.concat_ws('","', "subject_id", "predicate", "object_id"), F.lit('"]'))
    return _edges(spark, d).filter("subject_id is not null and object_id is not null").select("triple_id", F.sha2(key, 256).alias("stable_id"))


def fn12_safe_ids(spark: SparkSession, d: str) -> DataFrame:
    """Node names as identifiers: a slug and a part of the hash."""
    slug = F.regexp_replace(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return live_nodes(spark, d).select("name").distinct().select("name", F.concat(slug, F.lit("-"), F.substring(F.sha2("name", 256), 1, 16)).alias("safe_id"))


def fn37_name_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Distinct raw names by kind of writing."""
    n = table(spark, d, "observation").select("raw_name").filter("raw_name is not null").distinct()
    kind = F.when(F.col("raw_name").rlike("[㐀-鿿]"), "ideographs").when(F.col("raw_name").rlike("^[A-Z][A-Z0-9%#.]*$"), "abbreviation").when(F.col("raw_name").rlike("[À-ÿ]"), "accented").otherwise("plain")
    return n.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_names"))


def rul16_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """A hash of every report over its rows in order."""
    o = table(spark, d, "observation").select("report_id", "obs_id", "raw_name", "value", "unit").distinct()
    parts = F.transform(F.array_sort(F.collect_list(F.struct("obs_id", F.coalesce("raw_name", F.lit("")).alias("n"), F.coalesce("value", F.lit("")).alias("v"), F.coalesce("unit", F.lit("")).alias("u")))), lambda x: F.concat_ws("|", x["obs_id"].cast("string"), x["n"], x["v"], x["u"]))
    return o.groupBy("report_id").agg(F.sha2(F.array_join(parts, "\n"), 256).alias("snapshot"), F.count(F.lit(1)).alias("n_rows"))


def srt06_interleave(spark: SparkSession, d: str) -> DataFrame:
    """Two rankings of the chunks of each page, by length and by order, interleaved; the first three of a page are kept (a top-k report)."""
    c = chunks(spark, d).withColumn("n", F.length("text"))
    a = c.select("page_id", "chunk_id", F.lit(0).alias("channel"), F.row_number().over(W.partitionBy("page_id").orderBy(F.desc("n"), "chunk_id")).alias("rank"))
    b = c.select("page_id", "chunk_id", F.lit(1).alias("channel"), F.row_number().over(W.partitionBy("page_id").orderBy("s", "chunk_id")).alias("rank"))
    first = a.unionByName(b).groupBy("page_id", "chunk_id").agg(F.min(F.struct("rank", "channel")).alias("o"))
    return first.withColumn("place", F.row_number().over(W.partitionBy("page_id").orderBy("o", "chunk_id"))).filter("place <= 3").select("page_id", "chunk_id", "place")


def agg26_vote(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent node type of each name, the smallest of equally frequent ones."""
    n = live_nodes(spark, d).groupBy(F.lower("name").alias("name"), "node_type").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("name").orderBy(F.desc("n"), "node_type")
    return n.withColumn("r", F.row_number().over(w)).filter("r = 1").select("name", "node_type", "n")


def agg24_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Terms linked by a shared folded name or alias: the components of the catalogue."""
    from quillon.operators.graph import components

    t = table(spark, d, "lab_term").select("term_id", F.explode(F.array_compact(F.concat(F.array("standard_name", "abbreviation"), "aliases"))).alias("a")).select("term_id", fold_case(F.col("a")).alias("k")).distinct()
    links = t.select(F.concat(F.lit("t:"), "term_id").alias("a"), F.concat(F.lit("z:"), "k").alias("b"))
    c = components(links.select(F.col("a").alias("node")), links)
    return c.select(F.col("node").alias("term"), "component")


_TB = r"regexp_matches(trim(line), '^\|.*\|$')"
_CELL = _LN + rf""", tl as (select page_id, line_no, string_split(regexp_replace(trim(line), '^\||\|$', '', 'g'), '|') c from ln where {_TB} and not regexp_matches(trim(line), '^[|:\-\s]+$')),
cells as (select page_id, line_no::int line_no, (generate_subscripts(c, 1) - 1)::int col, trim(unnest(c)) cell from tl)"""
_FACTS = f"""{ND}, ed as (select distinct triple_id, subject_id, predicate, object_id, layer, status, properties_json, evidence_json, origins_json, created_at from edges),
facts as (select triple_id, s.name subject, predicate, o.name as object from ed left join nd s on s.node_id = subject_id left join nd o on o.node_id = object_id)"""
SQL = {
    "rpt01_cells": f"with {_CELL} select * from cells",
    "rpt03_rows": f"""with {_CELL}, r as (select page_id, line_no, max(cell) filter (col = 0) code, max(cell) filter (col = 1) res, max(cell) filter (col = 2) unit from cells group by 1, 2 having count(*) = 3)
select page_id, line_no, code, term_id, try_cast(res as double) as value, unit from r left join lab_term on abbreviation = code where code <> 'analyte'""",
    "grf06_tables": f"""with {_CELL}, n as (select page_id, line_no, count(*) k from cells group by 1, 2), t as (select page_id, line_no, line_no - row_number() over (partition by page_id order by line_no) run from ln where {_TB})
select t.page_id, min(t.line_no)::int first_line, count(k) n_rows, max(k) n_cols from t left join n using (page_id, line_no) group by t.page_id, run""",
    "grf07_formulas": rf"with {_PG}, f as (select page_id, regexp_extract_all(cleaned_text, '\$\$\n([^$]+)\n\$\$', 1) f from pg where cleaned_text is not null) select page_id, (generate_subscripts(f, 1) - 1)::int as no, unnest(f) formula from f",
    "seg24_units": rf"with {_LN} select page_id, case when {_TB} then 'table_row' when regexp_matches(trim(line), '^(\d+[.)]|[-*])\s') then 'list_item' when trim(line) like '#%' then 'heading' else 'line' end kind, count(*) n_units from ln where trim(line) <> '' group by 1, 2",
    "src03_repeated_lines": f"""with {_PG}, l as (select page_id, document_id, trim(unnest(string_split(replace(raw_text, chr(13), ''), chr(10)))) line from pg), c as (select document_id, line, count(distinct page_id) n from l where line <> '' group by 1, 2),
n as (select document_id, count(*) np from pg group by 1) select document_id, line, n from c join n using (document_id) where np >= 5 and n >= 0.2 * np""",
    "src02_markers": """with p as (select page_id, any_value(printed_page_number) n, any_value(raw_text) t from page_text where printed_page_number is not null group by 1),
l as (select page_id, n, generate_subscripts(string_split(replace(t, chr(13), ''), chr(10)), 1)::int line_no, unnest(string_split(replace(t, chr(13), ''), chr(10))) line from p) select page_id, line_no from l where trim(line) = n::int::varchar""",
    "src32_digests": f"with {_PG} select document_id, sha256(string_agg(page_id || ':' || sha256(coalesce(cleaned_text, '')), chr(10) order by page_id)) digest from pg group by 1",
    "join31_facts": f"with {_FACTS} select * from facts",
    "flt10_facts": f"with {_FACTS} select * from facts where predicate = 'SUGGESTS' and contains(lower(subject), 'count')",
    "exp08_items": f"with {_FACTS} select 'node' kind, node_id item_id, name as snapshot from nd union all select 'edge', triple_id, coalesce(subject, '?') || ' ' || predicate || ' ' || coalesce(object, '?') from facts",
    "join25_source_lines": f"""with {_LN}, f as (select document_id, page_id, min(struct_pack(line_no := line_no, line := line)) f from ln join pg using (page_id) where contains(line, 'fibrin clot') group by 1, 2)
select document_id, page_id, f.line_no::int line_no, f.line line from (select *, row_number() over (partition by document_id order by page_id) r from f) where r <= 3""",
    "gld02_span_union": f"""with {_SP} select chunk_id, start, "end", string_agg(distinct word, '|' order by word) words from sp group by 1, 2, 3""",
    "gld06_parenthetical": r"""with n as (select distinct obs_id, raw_name from observation), p as (select trim(regexp_extract(raw_name, '^(.+?)\s*[(（]([^()（）]+)[)）]$', 1)) as label, trim(regexp_extract(raw_name, '^(.+?)\s*[(（]([^()（）]+)[)）]$', 2)) alias from n)
select label, alias, count(*) n_rows from p where label <> '' group by 1, 2""",
    "gld08_canonical": """with w as (select distinct canonical_id, entity_type, lower(trim(canonical_name)) k, coalesce(aliases, []) al, canonical_name from wbc_supplement)
select entity_type, k, count(distinct canonical_id) n_records, len(list_distinct(flatten(list(al))))::int n_aliases from w group by 1, 2""",
    "fn14_stable_ids": f"""with {_FACTS} select triple_id, sha256('["' || subject_id || '","' || predicate || '","' || object_id || '"]') stable_id from ed where subject_id is not null and object_id is not null""",
    "fn12_safe_ids": f"with {ND} select distinct name, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') || '-' || substr(sha256(name), 1, 16) safe_id from nd",
    "fn37_name_kinds": "select case when regexp_matches(raw_name, '[㐀-鿿]') then 'ideographs' when regexp_matches(raw_name, '^[A-Z][A-Z0-9%#.]*$') then 'abbreviation' when regexp_matches(raw_name, '[À-ÿ]') then 'accented' else 'plain' end kind, count(*) n_names from (select distinct raw_name from observation where raw_name is not null) group by 1",
    "rul16_snapshots": "select report_id, sha256(string_agg(obs_id || '|' || coalesce(raw_name, '') || '|' || coalesce(value, '') || '|' || coalesce(unit, ''), chr(10) order by obs_id, coalesce(raw_name, ''), coalesce(value, ''), coalesce(unit, ''))) as snapshot, count(*) n_rows from (select distinct report_id, obs_id, raw_name, value, unit from observation) group by 1",
    "srt06_interleave": f"""with {CH}, r as (select page_id, chunk_id, 0 c, row_number() over (partition by page_id order by length(text) desc, chunk_id) k from ch union all select page_id, chunk_id, 1, row_number() over (partition by page_id order by s, chunk_id) from ch),
f as (select page_id, chunk_id, min(k * 2 + c) o from r group by 1, 2) select page_id, chunk_id, place from (select page_id, chunk_id, (row_number() over (partition by page_id order by o, chunk_id))::int place from f) where place <= 3""",
    "agg26_vote": f"with {ND}, n as (select lower(name) as name, node_type, count(*) n from nd group by all) select name, node_type, n from (select *, row_number() over (partition by name order by n desc, node_type) r from n) where r = 1",
    "agg24_catalog": f"""with recursive t as (select distinct 't:' || term_id t, replace({fold_sql('a')}, 'ß', 'ss') k from (select term_id, unnest(list_concat([standard_name, abbreviation], aliases)) a from lab_term) where a is not null),
r(n, c) as (select distinct t, t from t union select b.t, r.c from r join t a on a.t = r.n join t b on b.k = a.k) select n term, min(c) component from r group by n""",
}
QUERIES = {f.__name__: f for f in (
    rpt01_cells, rpt03_rows, grf06_tables, grf07_formulas, seg24_units, src03_repeated_lines, src02_markers, src32_digests, join31_facts, flt10_facts, exp08_items, join25_source_lines,
    gld02_span_union, gld06_parenthetical, gld08_canonical, fn14_stable_ids, fn12_safe_ids, fn37_name_kinds, rul16_snapshots, srt06_interleave, agg26_vote, agg24_catalog,
)}

