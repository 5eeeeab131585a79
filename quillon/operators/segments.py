"""Pages, lines, chunks, sections and windows of text: exploding and packing rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

# What must not be cut. Tables in tags run to the end of the text where they are not closed.
_BLOCKS = (re.compile(r"<table\b[^>]*>(?:.*?</table\s*>|.*\Z)", re.I | re.S), re.compile(r"\\\\\[.*?\\\\\]", re.S), re.compile(r"\$\$.*?\$\$", re.S))
_FENCE = re.compile(r"^\s*(`{3,}|~{3,})[^\n]*(?:\n|$)", re.M)


def lines_with_offsets(pages: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line_no, line, line_start, line_end``: lines without their LF, offsets in code points, null texts left out."""
    parts = F.split(F.col(text), "\n")
    rows = pages.filter(F.col(text).isNotNull()).select(F.col(key), F.posexplode(parts).alias("pos", "line"))
    w = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0))
    rows = rows.withColumn("line_start", start.cast("int"))
    return rows.select(key, (F.col("pos") + 1).alias("line_no"), "line", "line_start", (F.col("line_start") + F.length("line")).alias("line_end"))


def drop_furniture(lines: DataFrame, page: str, book: str, least_pages: int = 2) -> DataFrame:
    """Lines without edge numbers and without first and last lines that repeat on ``least_pages`` pages of a book.

    ``lines`` has ``page, book, line_no, line``. The two outermost lines with text on either side count as the edge.
    """
    text = F.trim("line")
    full = lines.filter(text != "")
    top = F.row_number().over(W.partitionBy(page).orderBy("line_no"))
    bottom = F.row_number().over(W.partitionBy(page).orderBy(F.desc("line_no")))
    full = full.withColumns({"top": top, "bottom": bottom, "t": text})
    numbers = full.filter((F.least("top", "bottom") <= 2) & F.col("t").rlike(r"^\d{1,5}$")).select(page, "line_no")
    edge = full.filter("top = 1 or bottom = 1").select(page, book, "line_no", "t")
    repeated = edge.select(book, "t", page).distinct().groupBy(F.col(book).alias("_b"), F.col("t").alias("_t")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
    furniture = edge.join(repeated, (F.col(book) == F.col("_b")) & (F.col("t") == F.col("_t")), "left_semi").select(page, "line_no")
    return lines.join(numbers.unionAll(furniture).distinct(), [page, "line_no"], "left_anti")


def heading_level(line: Column) -> Column:
    """1 to 3 for marked headings, 2 and 3 for numbered Chinese ones, null otherwise."""
    marks = F.length(F.regexp_extract(line, r"^(#{1,6})\s", 1))
    return F.when(marks > 0, F.least(marks, F.lit(3))).when(line.rlike("^[一二三四五六七八九十]+、"), 2).when(line.rlike("^[（(][一二三四五六七八九十]+[）)]"), 3)


def section_paths(lines: DataFrame, book: str, order: list[str]) -> DataFrame:
    """Lines with the titles ``h1, h2, h3`` of the section they lie in; a shallower heading ends the deeper ones."""
    w = W.partitionBy(book).orderBy(*order)
    lv = heading_level(F.col("line"))
    title = F.trim(F.regexp_replace("line", r"^#{1,6}\s*", ""))
    rows = lines.withColumn("_lv", lv).withColumn("_pos", F.row_number().over(w))
    at = {k: F.max(F.when(F.col("_lv") == k, F.struct("_pos", title.alias("t")))).over(w) for k in (1, 2, 3)}
    rows = rows.withColumns({f"_h{k}": c for k, c in at.items()})
    h2 = F.when(F.coalesce(F.col("_h2._pos") > F.coalesce(F.col("_h1._pos"), F.lit(0)), F.lit(False)), F.col("_h2.t"))
    above = F.greatest(F.coalesce(F.col("_h1._pos"), F.lit(0)), F.coalesce(F.col("_h2._pos"), F.lit(0)))
    h3 = F.when(F.coalesce(F.col("_h3._pos") > above, F.lit(False)), F.col("_h3.t"))
    return rows.withColumns({"h1": F.col("_h1.t"), "h2": h2, "h3": h3}).drop("_lv", "_pos", "_h1", "_h2", "_h3")


def protected_spans(text: str) -> list[tuple[int, int]]:
    """Tables, formulas and fences, merged where they touch.

    A fence ends at a mark of its kind and length or at the end of the text; the closing mark opens another fence, as it
    does in the package format, so that in effect the rest of the page stays with it.
    """
    found = [m.span() for rx in _BLOCKS for m in rx.finditer(text)]
    for m in _FENCE.finditer(text):
        close = re.compile(rf"^\s*{m[1][0]}{{{len(m[1])},}}\s*(?:\n|$)", re.M).search(text, m.end())
        found.append((m.start(), close.end() if close else len(text)))
    spans: list[list[int]] = []
    for a, b in sorted(found):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


def preferred_cut(text: str, start: int, limit: int, spans: list[tuple[int, int]]) -> int | None:
    """The last place behind a blank line in ``text[start:limit]``, else behind a line end, never inside a span."""
    for mark in ("\n\n", "\n"):
        at = text.rfind(mark, start, limit)
        while at >= 0:
            cut = at + len(mark)
            if not any(a < cut < b for a, b in spans):
                return cut
            at = text.rfind(mark, start, cut - 1)
    return None


def slice_page(text: str, most: int) -> list[tuple[int, int, bool]]:
    """Chunks ``(start, end, oversize)`` of a page, cut at the preferred place within ``most`` or, where there is none, at ``most``.

    A block that crosses the limit moves to the next chunk, and one that begins a chunk stays whole; ``oversize`` marks
    chunks that hold a block longer than ``most``.
    """
    spans, out, at = protected_spans(text), [], 0
    while at < len(text):
        limit = min(len(text), at + most)
        across = next(((a, b) for a, b in spans if a < limit < b), None)
        if across is None:
            end = preferred_cut(text, at, limit, spans) or limit
        elif across[0] <= at:
            end = across[1]
        else:
            end = preferred_cut(text, at, across[0], spans) or across[0]
        out.append((at, end, any(at <= a and b <= end and b - a > most for a, b in spans)))
        at = end
    return out


def slice_pages(pages: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """``key, chunk_no, char_start, char_end, oversize, text`` for every page; the chunks of a page join to its text."""
    schema = f"{key} string, chunk_no int, char_start int, char_end int, oversize boolean, text string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [(k, n, a, b, o, t[a:b]) for k, t in zip(p["k"], p["t"]) for n, (a, b, o) in enumerate(slice_page(t, most))]
            yield pd.DataFrame(rows, columns=[key, "chunk_no", "char_start", "char_end", "oversize", "text"])

    return pages.filter(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInPandas(run, schema)


def pack_windows(items: DataFrame, group: str, order: list[str], size: str, most: int) -> DataFrame:
    """Items with ``window_no``: consecutive items of a group while their sizes, one apart, stay within ``most``.

    Packing is sequential in a group (a chapter). An item larger than ``most`` is a window of its own.
    """
    cols = [c for c in items.columns if c != "window_no"]
    schema = items.select(*cols).schema.add("window_no", T.IntegerType())

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order, kind="stable")
        numbers, no, used = [], 0, 0
        for n in p[size]:
            n = int(n)
            if used and used + n + 1 > most:
                no, used = no + 1, 0
            used += n + (1 if used else 0)
            numbers.append(no)
        return p.assign(window_no=numbers)

    return items.select(*cols).groupBy(group).applyInPandas(run, schema)


def masked(text: Column, spans: Column) -> Column:
    """The text with every span (``start, end``) replaced by blanks, line ends kept, so that offsets stay."""
    blank = lambda part: F.regexp_replace(part, r"[^\r\n]", " ")
    one = lambda t, s: F.concat(F.substring(t, F.lit(1), s["start"]), blank(F.substring(t, s["start"] + 1, s["end"] - s["start"])), F.substring(t, s["end"] + 1, F.length(t)))
    return F.aggregate(spans, text, one)


def overlap_join(left: DataFrame, right: DataFrame, key: str, bin_size: int = 512) -> DataFrame:
    """Pairs of intervals of one key that overlap, with ``o_start, o_end``.

    ``left``: ``key, l_id, l_start, l_end``; ``right``: ``key, r_id, r_start, r_end``. Intervals are cut into bins and
    joined on key and bin; a pair is kept in its first common bin only, so no pair is made twice.
    """
    cut = lambda df, s, e: df.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(s) / bin_size), F.floor(F.greatest(F.col(e) - 1, F.col(s)) / bin_size))))
    j = cut(left, "l_start", "l_end").join(cut(right, "r_start", "r_end"), [key, "_bin"])
    start, end = F.greatest("l_start", "r_start"), F.least("l_end", "r_end")
    return j.filter((start < end) & (F.floor(start / bin_size) == F.col("_bin"))).select(key, "l_id", "r_id", start.alias("o_start"), end.alias("o_end"))
