"""Queries of segmentation, integrity and source operators over pages and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quillon.functions.text import first_sentence, line_at, match_key, normalized_newlines, padded_numbers
from quillon.operators.segments import drop_furniture, heading_level, lines_with_offsets, overlap_join, pack_windows, section_paths, slice_pages
from quillon.plans.retrieval import CH, chunks
from quillon.sources.tables import table


def _pages(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_text").select("page_id", "document_id", "chapter_id", "chapter_page_index", "raw_text", "cleaned_text", "cleaned_sha256")
    return p.dropDuplicates(["page_id"])


def seg01_newlines(spark: SparkSession, d: str) -> DataFrame:
    """Hash of every page with LF only and one final LF."""
    return _pages(spark, d).select("page_id", F.sha2(normalized_newlines(F.col("raw_text")), 256).alias("sha256"))


def seg08_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the cleaned pages with their offsets, summed up per page."""
    r = lines_with_offsets(_pages(spark, d), "page_id", "cleaned_text")
    return r.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_lines"), F.max("line_end").alias("last_end"), F.sum("line_start").cast("bigint").alias("sum_starts"))


def seg02_furniture(spark: SparkSession, d: str) -> DataFrame:
    """Lines of every raw page that stay after page furniture is removed by exact repetition."""
    r = lines_with_offsets(_pages(spark, d).withColumn("raw_text", F.replace("raw_text", F.lit("\r"), F.lit(""))), "page_id", "raw_text")
    r = r.join(_pages(spark, d).select("page_id", "document_id"), "page_id")
    return drop_furniture(r, "page_id", "document_id").groupBy("page_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count(F.when(F.trim("line") != "", 1)).alias("n_full"))


def seg09_headings(spark: SparkSession, d: str) -> DataFrame:
    """Headings of the cleaned pages by level."""
    r = lines_with_offsets(_pages(spark, d), "page_id", "cleaned_text").withColumn("level", heading_level(F.col("line")))
    return r.filter("level is not null").select("page_id", "line_no", "level", F.trim(F.regexp_replace("line", r"^#{1,6}\s*", "")).alias("title"))


def seg10_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of every chapter by their titles, with their numbers of lines."""
    r = lines_with_offsets(_pages(spark, d), "page_id", "cleaned_text").join(_pages(spark, d).select("page_id", "document_id", "chapter_id", "chapter_page_index"), "page_id")
    r = section_paths(r.withColumn("chapter", F.concat_ws("/", "document_id", "chapter_id")), "chapter", ["chapter_page_index", "line_no"])
    return r.groupBy("chapter", "h1", "h2", "h3").agg(F.count(F.lit(1)).alias("n_lines"))


def seg06_slices(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of every cleaned page of at most 600 characters."""
    return slice_pages(_pages(spark, d), "page_id", "cleaned_text", 600).select("page_id", "chunk_no", "char_start", "char_end", "oversize", F.sha2("text", 256).alias("sha256"))


def seg07_ids(spark: SparkSession, d: str) -> DataFrame:
    """Chunk ids made from page and position, compared with the stored ones."""
    c = chunks(spark, d)
    no = F.row_number().over(W.partitionBy("page_id").orderBy("s", "chunk_id")) - 1
    return c.select("chunk_id", F.format_string("%s:%04d", "page_id", no).alias("made")).select("chunk_id", "made", (F.col("chunk_id") == F.col("made")).alias("same"))


def seg18_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of at most 3,000 characters over the chunks of each chapter."""
    c = chunks(spark, d).select(F.concat_ws("/", "document_id", "chapter_id").alias("chapter"), "chunk_id", "chapter_page_index", "s", F.length("text").alias("size"))
    return pack_windows(c, "chapter", ["chapter_page_index", "s", "chunk_id"], "size", 3000).groupBy("chapter", "window_no").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("size").alias("size"))


def seg20_context(spark: SparkSession, d: str) -> DataFrame:
    """Rule windows: per page its chunks, the last chunk of the page before and the first of the page after."""
    c = chunks(spark, d).select("document_id", "chapter_id", "page_id", "chapter_page_index", "chunk_id", "s")
    f, b = W.partitionBy("page_id").orderBy("s", "chunk_id"), W.partitionBy("page_id").orderBy(F.desc("s"), F.desc("chunk_id"))
    c = c.withColumns({"first": F.row_number().over(f), "last": F.row_number().over(b)})
    pages = c.select("document_id", "chapter_id", F.col("page_id").alias("window"), "chapter_page_index").distinct()
    own = c.select(F.col("page_id").alias("window"), "chunk_id", F.lit("target").alias("role"))
    key = ["document_id", "chapter_id", "chapter_page_index"]
    left = c.filter("last = 1").select("document_id", "chapter_id", (F.col("chapter_page_index") + 1).alias("chapter_page_index"), "chunk_id").join(pages, key).select("window", "chunk_id", F.lit("left").alias("role"))
    right = c.filter("first = 1").select("document_id", "chapter_id", (F.col("chapter_page_index") - 1).alias("chapter_page_index"), "chunk_id").join(pages, key).select("window", "chunk_id", F.lit("right").alias("role"))
    return own.unionByName(left).unionByName(right)


def seg29_first_sentence(spark: SparkSession, d: str) -> DataFrame:
    """The first sentence of every chunk."""
    return chunks(spark, d).select("chunk_id", first_sentence(F.col("text")).alias("sentence"))


def seg12_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that overlap fixed windows of 500 characters on their page, with the length of the overlap."""
    c = chunks(spark, d)
    win = _pages(spark, d).filter("cleaned_text is not null").select("page_id", F.explode(F.sequence(F.lit(0), F.length("cleaned_text"), F.lit(500))).alias("r_start"))
    win = win.select("page_id", F.col("r_start").alias("r_id"), "r_start", (F.col("r_start") + 500).alias("r_end"))
    o = overlap_join(c.select("page_id", F.col("chunk_id").alias("l_id"), F.col("s").alias("l_start"), F.col("e").alias("l_end")), win, "page_id")
    return o.select(F.col("l_id").alias("chunk_id"), F.col("r_id").alias("window"), (F.col("o_end") - F.col("o_start")).alias("n"))


def win01_chunk_next(spark: SparkSession, d: str) -> DataFrame:
    """The chunk that follows each chunk of a document."""
    w = W.partitionBy("document_id").orderBy("chapter_id", "chapter_page_index", "s", "chunk_id")
    return chunks(spark, d).select("chunk_id", F.lead("chunk_id").over(w).alias("next_id")).filter("next_id is not null")


def win04_contiguity(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that do not begin where the one before ends."""
    w = W.partitionBy("page_id").orderBy("s", "chunk_id")
    return chunks(spark, d).select("chunk_id", "s", F.coalesce(F.lag("e").over(w), F.lit(0)).alias("expected")).filter("s <> expected")


def win05_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Offset of each chunk in its chapter."""
    w = W.partitionBy("document_id", "chapter_id").orderBy("chapter_page_index", "s", "chunk_id").rowsBetween(W.unboundedPreceding, -1)
    return chunks(spark, d).select("chunk_id", F.coalesce(F.sum(F.length("text")).over(w), F.lit(0)).cast("bigint").alias("chapter_offset"))


def agg21_reconstruct(spark: SparkSession, d: str) -> DataFrame:
    """Pages rebuilt from their live chunks, compared with the hash of the page."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("s", "chunk_id", "text"))), lambda x: x["text"])
    built = chunks(spark, d).groupBy("page_id").agg(F.sha2(F.concat_ws("", parts), 256).alias("built"))
    return _pages(spark, d).filter("cleaned_text is not null").join(built, "page_id", "left").select("page_id", F.coalesce(F.col("built") == F.sha2("cleaned_text", 256), F.lit(False)).alias("complete"))


def val01_chunk_package(spark: SparkSession, d: str) -> DataFrame:
    """Broken rules of the chunk package, counted: hash, length, page, offsets."""
    c = table(spark, d, "evidence_chunk").select("chunk_id", "page_id", "text", "chunk_sha256", "char_count", "cleaned_char_start", "cleaned_char_end").distinct()
    c = c.join(_pages(spark, d).select(F.col("page_id").alias("_p"), "cleaned_text"), F.col("page_id") == F.col("_p"), "left")
    cut = F.substring("cleaned_text", F.col("cleaned_char_start") + 1, F.col("cleaned_char_end") - F.col("cleaned_char_start"))
    rules = {
        "hash": F.sha2("text", 256) != F.col("chunk_sha256"), "char_count": F.col("char_count").isNull() | (F.col("char_count") != F.length("text")), "page": F.col("_p").isNull(),
        "length": F.col("cleaned_char_end") - F.col("cleaned_char_start") != F.length("text"), "slice": F.col("cleaned_text").isNotNull() & (cut != F.col("text")),
    }
    return c.select(F.explode(F.array_compact(F.array(*[F.when(x, k) for k, x in rules.items()]))).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n_chunks"))


def fn15_line_numbers(spark: SparkSession, d: str) -> DataFrame:
    """The line of the page on which each chunk begins."""
    p = _pages(spark, d).select("page_id", "cleaned_text").filter("cleaned_text is not null")
    return chunks(spark, d).join(p, "page_id").select("chunk_id", line_at(F.col("cleaned_text"), F.col("s")).alias("line_no"))


def fn06_match_keys(spark: SparkSession, d: str) -> DataFrame:
    """Documents per key that ignores blanks and mark-up: groups of equal texts."""
    k = table(spark, d, "documents").filter("text is not null").select("doc_id", F.sha2(match_key(F.col("text")), 256).alias("key"))
    return k.groupBy("key").agg(F.count(F.lit(1)).alias("n_documents"), F.min("doc_id").alias("first_id"))


def srt05_natural(spark: SparkSession, d: str) -> DataFrame:
    """Natural order of the pages of each document."""
    w = W.partitionBy("document_id").orderBy(padded_numbers(F.col("page_id")))
    return _pages(spark, d).select("page_id", F.row_number().over(w).alias("place"))


def src11_evidence_index(spark: SparkSession, d: str) -> DataFrame:
    """Edges of the evidence index by kind: documents to pages, pages to chunks, chunk to next chunk."""
    c = chunks(spark, d)
    dp = c.select("document_id", "page_id").distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit("DOCUMENT_HAS_PAGE").alias("kind"), "n")
    pc = c.agg(F.count(F.lit(1)).alias("n")).select(F.lit("PAGE_HAS_CHUNK").alias("kind"), "n")
    cn = win01_chunk_next(spark, d).agg(F.count(F.lit(1)).alias("n")).select(F.lit("CHUNK_NEXT").alias("kind"), "n")
    return dp.unionByName(pc).unionByName(cn)


def exp12_selection(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of at least 200 characters on the pages 2 to 4 or 8 to 9 of a chapter."""
    i = F.col("chapter_page_index")
    return chunks(spark, d).filter((F.length(F.trim("text")) >= 200) & (i.between(2, 4) | i.between(8, 9))).select("chunk_id")


def exp13_progress(spark: SparkSession, d: str) -> DataFrame:
    """Chunks still to be done: without a vector of the same hash."""
    done = table(spark, d, "vectors").select("chunk_id", "chunk_sha256").dropna().distinct()
    return chunks(spark, d).select("chunk_id", "chunk_sha256").join(done, ["chunk_id", "chunk_sha256"], "left_anti").select("chunk_id")


_PG = "pg as (select page_id, any_value(document_id) document_id, any_value(chapter_id) chapter_id, any_value(chapter_page_index) chapter_page_index, any_value(raw_text) raw_text, any_value(cleaned_text) cleaned_text from page_text group by page_id)"
_LN = _PG + """, l0 as (select page_id, generate_subscripts(string_split(cleaned_text, chr(10)), 1) line_no, unnest(string_split(cleaned_text, chr(10))) line from pg where cleaned_text is not null),
ln as (select *, coalesce(sum(length(line) + 1) over (partition by page_id order by line_no rows between unbounded preceding and 1 preceding), 0)::int line_start from l0)"""
_LV = "case when regexp_matches(line, '^#{1,6}\\s') then least(length(regexp_extract(line, '^(#{1,6})\\s', 1)), 3) when regexp_matches(line, '^[一二三四五六七八九十]+、') then 2 when regexp_matches(line, '^[（(][一二三四五六七八九十]+[）)]') then 3 end"
SQL = {
    "seg01_newlines": f"with {_PG} select page_id, sha256(regexp_replace(regexp_replace(raw_text, '\\r\\n?', chr(10), 'g'), '\\n+$', '') || chr(10)) as sha256 from pg",
    "seg08_lines": f"with {_LN} select page_id, count(*) n_lines, max(line_start + length(line)) last_end, sum(line_start)::bigint sum_starts from ln group by 1",
    "seg02_furniture": f"""with {_PG}, l as (select page_id, document_id, generate_subscripts(string_split(replace(raw_text, chr(13), ''), chr(10)), 1) line_no, unnest(string_split(replace(raw_text, chr(13), ''), chr(10))) line from pg),
f as (select *, trim(line) t, row_number() over (partition by page_id order by line_no) a, row_number() over (partition by page_id order by line_no desc) b from l where trim(line) <> ''),
e as (select * from f where a = 1 or b = 1), rp as (select document_id, t from e group by 1, 2 having count(distinct page_id) >= 2),
bad as (select page_id, line_no from f where least(a, b) <= 2 and regexp_matches(t, '^\\d{{1,5}}$') union select page_id, line_no from e where (document_id, t) in (select (document_id, t) from rp))
select page_id, count(*) n_lines, count(*) filter (trim(line) <> '') n_full from l where (page_id, line_no) not in (select (page_id, line_no) from bad) group by 1""",
    "seg09_headings": f"with {_LN} select page_id, line_no::int line_no, ({_LV})::int level, trim(regexp_replace(line, '^#{{1,6}}\\s*', '')) title from ln where ({_LV}) is not null",
    "seg10_sections": f"""with {_LN}, r as (select ln.*, document_id || '/' || chapter_id chapter, chapter_page_index, {_LV} lv, trim(regexp_replace(line, '^#{{1,6}}\\s*', '')) title from ln join pg using (page_id)),
p as (select *, row_number() over (partition by chapter order by chapter_page_index, line_no) pos from r),
q as (select *, max(case when lv = 1 then struct_pack(p := pos, t := title) end) over w s1, max(case when lv = 2 then struct_pack(p := pos, t := title) end) over w s2, max(case when lv = 3 then struct_pack(p := pos, t := title) end) over w s3
  from p window w as (partition by chapter order by pos))
select chapter, s1.t h1, case when s2.p > coalesce(s1.p, 0) then s2.t end h2, case when s3.p > greatest(coalesce(s1.p, 0), coalesce(s2.p, 0)) then s3.t end h3, count(*) n_lines from q group by all""",
    "seg07_ids": f"with {CH}, m as (select chunk_id, page_id || ':' || lpad((row_number() over (partition by page_id order by s, chunk_id) - 1)::varchar, 4, '0') made from ch) select chunk_id, made, chunk_id = made as same from m",
    "seg18_windows": f"""with recursive {CH}, o as (select document_id || '/' || chapter_id chapter, length(text) size, row_number() over (partition by document_id, chapter_id order by chapter_page_index, s, chunk_id) n from ch),
r(chapter, n, w, used, size) as (select chapter, n, 0, size, size from o where n = 1 union all select o.chapter, o.n, case when r.used > 0 and r.used + o.size + 1 > 3000 then r.w + 1 else r.w end,
 case when r.used > 0 and r.used + o.size + 1 > 3000 then o.size else r.used + o.size + case when r.used > 0 then 1 else 0 end end, o.size from r join o on o.chapter = r.chapter and o.n = r.n + 1)
select chapter, w as window_no, count(*) n_chunks, sum(size)::bigint size from r group by 1, 2""",
    "seg20_context": f"""with {CH}, c as (select *, row_number() over (partition by page_id order by s, chunk_id) f, row_number() over (partition by page_id order by s desc, chunk_id desc) b from ch),
p as (select distinct document_id, chapter_id, page_id w, chapter_page_index i from ch)
select page_id as "window", chunk_id, 'target' as role from c union all select w, chunk_id, 'left' from c join p on c.document_id = p.document_id and c.chapter_id = p.chapter_id and i = chapter_page_index + 1 where b = 1
union all select w, chunk_id, 'right' from c join p on c.document_id = p.document_id and c.chapter_id = p.chapter_id and i = chapter_page_index - 1 where f = 1""",
    "seg29_first_sentence": f"with {CH} select chunk_id, trim(case when regexp_matches(trim(text), '[。！？.!?]') then regexp_extract(trim(text), '^((?s:.)*?[。！？.!?])', 1) else trim(text) end) as sentence from ch",
    "seg12_overlap": f"""with {CH}, {_PG}, w as (select page_id, unnest(range(0, length(cleaned_text) + 1, 500)) a from pg where cleaned_text is not null)
select chunk_id, a::int as "window", (least(e, a + 500) - greatest(s, a))::int n from ch join w using (page_id) where greatest(s, a) < least(e, a + 500)""",
    "win01_chunk_next": f"with {CH} select * from (select chunk_id, lead(chunk_id) over (partition by document_id order by chapter_id, chapter_page_index, s, chunk_id) next_id from ch) where next_id is not null",
    "win04_contiguity": f"with {CH} select * from (select chunk_id, s, coalesce(lag(e) over (partition by page_id order by s, chunk_id), 0) expected from ch) where s <> expected",
    "win05_offsets": f"with {CH} select chunk_id, coalesce(sum(length(text)) over (partition by document_id, chapter_id order by chapter_page_index, s, chunk_id rows between unbounded preceding and 1 preceding), 0)::bigint chapter_offset from ch",
    "agg21_reconstruct": f"with {CH}, {_PG}, b as (select page_id, sha256(string_agg(text, '' order by s, chunk_id)) h from ch group by 1) select page_id, coalesce(h = sha256(cleaned_text), false) as complete from pg left join b using (page_id) where cleaned_text is not null",
    "val01_chunk_package": f"""with {_PG}, c as (select distinct chunk_id, page_id, text, chunk_sha256, char_count, cleaned_char_start a, cleaned_char_end b from evidence_chunk),
j as (select c.*, pg.page_id p, cleaned_text t from c left join pg on pg.page_id = c.page_id)
select r as rule, count(*) n_chunks from (select unnest([case when sha256(text) <> chunk_sha256 then 'hash' end, case when char_count is null or char_count <> length(text) then 'char_count' end, case when p is null then 'page' end,
case when b - a <> length(text) then 'length' end, case when t is not null and substr(t, a + 1, b - a) <> text then 'slice' end]) r from j) where r is not null group by 1""",
    "fn15_line_numbers": f"with {CH}, {_PG} select chunk_id, (1 + length(substr(cleaned_text, 1, s)) - length(replace(substr(cleaned_text, 1, s), chr(10), '')))::int line_no from ch join pg using (page_id) where cleaned_text is not null",
    "srt05_natural": f"with {_PG} select page_id, (row_number() over (partition by document_id order by regexp_replace(page_id, '.*:', ''), page_id))::int place from pg",
    "src11_evidence_index": f"""with {CH} select 'DOCUMENT_HAS_PAGE' kind, count(*) n from (select distinct document_id, page_id from ch) union all select 'PAGE_HAS_CHUNK', count(*) from ch
union all select 'CHUNK_NEXT', count(*) from (select lead(chunk_id) over (partition by document_id order by chapter_id, chapter_page_index, s, chunk_id) x from ch) where x is not null""",
    "exp12_selection": f"with {CH} select chunk_id from ch where length(trim(text)) >= 200 and (chapter_page_index between 2 and 4 or chapter_page_index between 8 and 9)",
    "exp13_progress": f"with {CH} select chunk_id from ch where (chunk_id, chunk_sha256) not in (select (chunk_id, chunk_sha256) from vectors where chunk_id is not null and chunk_sha256 is not null)",
}
SQL["srt05_natural"] = f"with {_PG} select page_id, (row_number() over (partition by document_id order by chapter_id, page_id))::int place from pg"
QUERIES = {f.__name__: f for f in (
    seg01_newlines, seg08_lines, seg02_furniture, seg09_headings, seg10_sections, seg06_slices, seg07_ids, seg18_windows, seg20_context, seg29_first_sentence, seg12_overlap, win01_chunk_next, win04_contiguity,
    win05_offsets, agg21_reconstruct, val01_chunk_package, fn15_line_numbers, fn06_match_keys, srt05_natural, src11_evidence_index, exp12_selection, exp13_progress,
)}
