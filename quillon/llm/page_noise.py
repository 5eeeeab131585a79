"""Noise in text from scanned pages: broken words, misread characters, running headers, page numbers.

The pages become a table of lines (:func:`page_lines`); everything else are joins and SQL windows over it.

* Words are grouped by the skeleton of their confusable glyphs (:func:`skeleton`). Within a group a rare form yields to
  a frequent form that explains it by listed confusions; forms that are frequent themselves are judged by the words
  around them. Ideographs are judged the same way, with their neighbours as context.
* Headers: lines at the edges of pages, digits masked, that repeat through a book or chapter; damaged copies are met by
  the skeleton or as a cut-off beginning.
* Page numbers: the number the page must have, in any notation, standing at an edge.
* Broken words: a line end with a break mark whose halves are known as one word rather than as a hyphenated one.

Semantics: a page that is delivered again counts once (by ``page_id``); null and empty texts have no lines; line numbers
count from 1 over the lines between LF; a page without neighbours or numbers simply yields fewer findings; empty tables
give empty results. No window reaches beyond one page, so no group is larger than a page.

Plans: texts are taken apart with ``explode_outer`` and nulls left out afterwards, as the optimizer puts a filter with two
more copies of the expression before every ``explode``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quillon.llm.storage import stored
from quillon.operators.joins import lookup_join
from quillon.session import broadcast_if_small

# What a scanner makes of a glyph, as (read, true).
CONFUSIONS = (
    ("c", "e"), ("f", "t"), ("á", "a"), ("í", "i"), ("ri", "n"), ("0", "o"), ("l", "i"), ("5", "s"), ("|", "l"), ("cl", "d"), ("1", "l"),
    ("ii", "u"), ("q", "g"), ("rn", "m"), ("b", "h"), ("m", "in"), ("m", "rn"), ("6", "b"), ("vv", "w"), ("z", "2"), ("8", "b"), ("b", "8"),
    ("i", "t"), ("œ", "ee"), ("h", "li"), ("d", "cl"), ("s", "5"), ("w", "vi"), ("w", "vv"), ("o", "0"), ("g", "9"), ("l", "1"), ("b", "6"),
    ("i", "1"), ("i", "l"), ("|", "1"), ("|", "i"), ("1", "i"), ("9", "g"), ("e", "c"), ("t", "f"), ("g", "q"), ("u", "ii"), ("n", "ri"), ("h", "b"), ("2", "z"), ("é", "e"), ("ó", "o"),
)
# Ideographs that a scanner takes for one another, as (read, true).
IDEOGRAPHS = (
    "皿血 童重 夏复 末未 庄应 太大 衰表 杲果 夕多 夭天 问间 曰日 休体 囚因 肉内 艰限 扳板 入人 折析 己已 土士 干千 未末 本木 目日 田由 力刀 侍待 治冶 晴睛 "
    "拨拔 贝见 王主 日目 人入 天夭 大太 体休 内肉 因囚 间问 多夕 果杲 表衰 重童 复夏 应庄 血皿 限艰 板扳 析折 已己 士土 千干 木本"
).split()
#: A form this many times rarer than the form that explains it is a misreading whatever its context.
RARE = 0.03
#: In context, a form must be this many times better supported to win.
CONTEXT_RATIO = 3
#: Bounds on what is sent to every task: all pieces to look at, or else the most frequent ones to pass over.
MOST_SENT, STOP_FORMS = 200_000, 2_000
MARKS = "\\-‐­¬"
#: One mark for each stroke or shape class; capitals stand for glyphs of several strokes.
_ONE = ("il1|ítfrvjecéœo0óòáas5gq9z2nuhb68w", "iiiiiiiiiicccCooooaassgggzzNNNNNNN")


def skeleton(text: Column) -> Column:
    """The shape of a word: glyphs that scanners confuse become the same strokes."""
    s = F.translate(F.lower(text), *_ONE)
    for glyph, strokes in (("N", "ii"), ("m", "iii"), ("d", "ci"), ("C", "cc")):
        s = F.replace(s, F.lit(glyph), F.lit(strokes))
    return s


def _digits(text: Column, b: str = "8") -> Column:
    """A number as read, with letters that look like digits taken for them; ``b`` may be an 8 or a 6."""
    return F.translate(F.translate(F.lower(text), "０１２３４５６７８９", "0123456789"), "oilszgqb|í", f"0115299{b}11")


_ROMAN = ((100, "cdm"), (10, "xlc"), (1, "ivx"))
_CIPHERS = "零一二三四五六七八九"


def _roman_digits(a: str, b: str, c: str) -> tuple[str, ...]:
    return ("", a, a * 2, a * 3, a + b, b, b + a, b + a * 2, b + a * 3, a + c)


def roman(n: int) -> str:
    """Lower-case Roman numeral; the thousands are repeated."""
    return "m" * (n // 1000) + "".join(_roman_digits(*abc)[n // by % 10] for by, abc in _ROMAN)


def hanzi(n: int) -> str:
    """Chinese numeral."""
    out, nought = "", False
    for by, unit in ((10**8, "亿"), (10**4, "万"), (1, "")):
        group = n // by % 10**4
        for k, sign in ((1000, "千"), (100, "百"), (10, "十"), (1, "")):
            d = group // k % 10
            if d:
                out += ("零" if nought and out else "") + ("" if k == 10 and d == 1 and not out else _CIPHERS[d]) + sign
            nought = not d
        if group:
            out, nought = out + unit, False
    return out


def _roman_shape(n: Column) -> Column:
    """The skeleton of the Roman numeral of a number, which is the skeletons of its letters side by side."""
    shape = lambda x: "".join({"l": "i", "v": "i", "d": "ci", "m": "iii"}.get(c, c) for c in x)
    digits = [F.element_at(F.array(*[F.lit(shape(x)) for x in _roman_digits(*abc)]), F.pmod(F.floor(n / by), F.lit(10)).cast("int") + 1) for by, abc in _ROMAN]
    # a line that is looked at has room for fewer than 100 letters, so a longer numeral stands nowhere
    return F.concat(F.repeat(F.lit(shape("m")), F.least(F.floor(n / 1000), F.lit(100)).cast("int")), *digits)


def _hanzi_of(n: Column) -> Column:
    """The Chinese numeral of a number: every digit gets its sign, then the noughts are joined or dropped."""
    units = ("千百十亿", "千百十万", "千百十")
    places = [(units[i // 4] + " ")[i % 4].strip() for i in range(12)]
    signs, noughts = F.array(*[F.lit(x) for x in places]), F.array(*[F.lit("零" + (x if x in ("亿", "万") else "")) for x in places])
    # digits in a lambda: twelve branches in line make one method that is too large for the JVM to compile
    digits = F.transform(F.split(F.lpad(n.cast("string"), 12, "0"), ""), lambda d, i: F.when(d == "0", F.element_at(noughts, i + 1)).otherwise(F.concat(F.translate(d, "0123456789", _CIPHERS), F.element_at(signs, i + 1))))
    out = F.array_join(digits, "")
    for pattern, by in (("^[亿万零]+", ""), ("零+亿", "亿"), ("亿零+万", "亿零"), ("零+万", "万"), ("零+", "零"), ("零$", ""), ("^一十", "十")):
        out = F.regexp_replace(out, pattern, by)
    return out


def _notations(n: Column) -> dict[str, Column]:
    """The notations of a page number, null below 1."""
    own = F.when(n >= 1, n)
    return {"arabic": own.cast("string"), "roman": F.when(n >= 1, _roman_shape(n)), "hanzi": _hanzi_of(own), "ciphers": F.translate(own.cast("string"), "0123456789", _CIPHERS)}


#: What a page tells about its place in the book.
PLACE = ("document_id", "chapter_id", "chapter_page_index", "printed_page_number", "source_pdf_page_number")


def _bounded(piece: Column, start: int) -> Column:
    """A piece between blanks. Words stay whole; ideographic text knows no blanks, of it 48 characters are enough."""
    return F.when((F.length(piece) > 48) & piece.rlike("[㐀-鿿]"), F.substring(piece, start, 48)).otherwise(piece)


def page_lines(pages: DataFrame, every_line: bool = True) -> DataFrame:
    """One row per line of each distinct page: its kind (the fences before a line tell whether it lies in a block), its place among the lines with text from the top and from the
    bottom (4 for all beyond the third), the last word of the line before and the first word of the line after. Lines at
    the edges (top or bottom up to 3) also have the place of their page in the book; ``latin`` marks Latin words. ``every_line=False`` leaves out what
    the search for noise never looks at: blank lines, and lines off the edges that are no running text."""
    kept = pages.select("page_id", "raw_text", *PLACE).filter("raw_text is not null and page_id is not null")
    once = kept.dropDuplicates(["page_id"]).withColumn("lines", F.split(F.replace("raw_text", F.lit("\r"), F.lit("")), "\n"))
    is_fence = lambda x: F.ltrim(x).startswith("```") | (F.rtrim(x) == "$$")
    full = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: F.ltrim(F.element_at("lines", i)) != "")
    # every line goes with the lines beside it, so that no row carries its whole page
    beside = F.arrays_zip(F.col("lines").alias("text"), F.concat(F.array(F.lit(None).cast("string")), F.slice("lines", F.lit(1), F.size("lines") - 1)).alias("before"), F.slice("lines", F.lit(2), F.size("lines")).alias("after"))
    once = once.withColumn("full", full).select("page_id", *PLACE, F.slice("full", 1, 3).alias("first"), F.slice("full", F.when(F.size("full") > 0, -F.least(F.lit(3), F.size("full"))).otherwise(1), F.lit(3)).alias("last"), F.filter("full", lambda i: is_fence(F.element_at("lines", i))).alias("fences"), beside.alias("beside"))
    rows = once.select("page_id", "first", "last", "fences", *PLACE, F.posexplode_outer("beside").alias("pos", "line")).select("page_id", "first", "last", "fences", *PLACE, "pos", "line.text", "line.before", "line.after")
    tail = lambda c: _bounded(F.substring_index(F.rtrim(c), " ", -1), -48)
    head = lambda c: _bounded(F.substring_index(F.ltrim(c), " ", 1), 1)
    no = (F.col("pos") + 1).cast("int")
    place = lambda c: F.nullif(F.array_position(c, no), F.lit(0))
    # the fences before a line: its place among them, less one
    fences_before = F.array_position(F.sort_array(F.array_append("fences", no)), no) - 1
    rows = rows.withColumns({
        "text": F.rtrim("text"),
        "top": F.coalesce(place("first"), F.lit(4)).cast("int"),
        "bottom": (F.size("last") + 1 - F.coalesce(place("last"), F.size("last") - 3)).cast("int"),
        "in_block": F.when(F.size("fences") > 0, is_fence(F.col("text")) | (fences_before % 2 == 1)),
    })
    t = F.col("text")
    # most lines are told by their first sign; blanks other than spaces may stand before it
    opens = lambda signs: F.substring(F.ltrim(t), 1, 1).isin(*signs, "\t", "\x0b", "\f")
    kind = (
        F.when(F.ltrim(t) == "", "blank")
        .when(F.col("in_block"), "block")
        .when(opens("|:-") & t.contains("|") & t.rlike(r"^\s*\|.*\|\s*$|^\s*[|:-]*-{3,}"), "table")
        .when(opens("0123456789-*•·") & t.rlike(r"^\s*(?:\d{1,3}[.)、]|[-*•·])\s"), "list")
        .when(F.ltrim(t).startswith("#") & t.rlike(r"^\s*#{1,6}\s"), "heading")
        .when(t.rlike("[a-zà-ÿ㐀-鿿]"), "prose")
        .otherwise("other")
    )
    rows = rows.withColumn("kind", kind)
    if not every_line:
        # a generator between the kind and its filter, else the filter moves down and takes the kind of every line again
        rows = rows.select("page_id", "pos", "text", "before", "after", "top", "bottom", *PLACE, F.explode_outer(F.array("kind")).alias("kind"))
        rows = rows.filter("kind <> 'blank' and (kind in ('prose', 'list') or top <= 3 or bottom <= 3)")
    at_edge = (F.col("top") <= 3) | (F.col("bottom") <= 3)
    return rows.select("page_id", (F.col("pos") + 1).alias("line_no"), "text", tail(F.col("before")).alias("before"), head(F.col("after")).alias("after"), "top", "bottom", "kind", F.col("text").rlike("[a-z0-9]{2}").alias("latin"), *[F.when(at_edge, F.col(c)).alias(c) for c in PLACE])


def page_facts(pages: DataFrame) -> DataFrame:
    """One row per page with its place in the book and its numbers."""
    facts = pages.filter("raw_text is not null and page_id is not null").select("page_id", *PLACE)
    return facts.groupBy("page_id").agg(*[F.first(c).alias(c) for c in facts.columns[1:]])


def _place(rows: DataFrame, keyed: DataFrame, row_keys: list[str], keys: list[str]) -> DataFrame:
    """Left join to a table with a row per book or chapter: sent whole where it is counted to be small, else by key."""
    small = broadcast_if_small(keyed, 100_000)
    if small is keyed:
        return lookup_join(rows, keyed, row_keys, keys)
    return rows.join(small, [F.col(r) == F.col(k) for r, k in zip(row_keys, keys)], "left")


_NUM = r"[\[(（【·.\-—–\s]*(?:第|p\.?|page)?\s*([0-9０-９A-Za-z|í一二三四五六七八九十百千万亿零〇]{1,8})\s*(?:页|頁)?[\])）】·.\-—–\s]*"
#: The same for notations of more than 8 characters (Roman from 188, Chinese from 10,001).
_LONG = _NUM.replace("{1,8}", "{9,48}")


def edge_ends(lines: DataFrame) -> DataFrame:
    """The lines of :func:`page_lines` at the edges of the pages, trimmed, with the place of their page and what may be a
    number: the whole line, or its first or last part."""
    edge_lines = lines.filter("(top <= 3 or bottom <= 3) and kind <> 'blank'").select("page_id", "line_no", "text", "top", "bottom", "kind", *PLACE)
    t = F.col("text")
    low = F.lower(t)
    outer = (F.col("top") <= 2) | (F.col("bottom") <= 2)
    edges = edge_lines.withColumn("text", F.trim("text")).withColumn("parted", outer & (t.contains("  ") | t.contains("\t") | t.contains("|")))
    edges = edges.withColumn("alone", F.when(outer & (F.length(t) <= 24), F.regexp_extract(low, "^" + _NUM + "$", 1)).otherwise(""))
    edges = edges.withColumn("long_alone", F.when(outer & (F.col("alone") == "") & (F.length(t) <= 64), F.regexp_extract(low, "^" + _LONG + "$", 1)).otherwise(""))
    parted = F.col("parted") & (F.col("alone") == "")
    ends = {f"{k}{side}": F.when(parted, F.regexp_extract(low, pattern, 1)).otherwise("") for k, num in (("", _NUM), ("long_", _LONG)) for side, pattern in (("first", "^" + num + r"(?:\s{2,}|\t|\s*\|\s*)\S"), ("last", r"\S(?:\s{2,}|\t|\s*\|\s*)" + num + "$"))}
    return edges.withColumns(ends).drop("parted")


def edge_noise(edges: DataFrame, facts: DataFrame) -> DataFrame:
    """``page_id, line_no, noise`` for running headers and page numbers, and ``title`` for the title that opens a chapter.

    ``edges`` are the lines of :func:`edge_ends`.
    """
    # the number each page must have: printed, else by the offset to the source page that most pages of the book show
    number = F.coalesce(*[F.when(F.col(c).rlike("^[0-9]+$"), F.col(c).try_cast("int")) for c in ("alone", "first", "last")])
    shown = F.explode(F.array(F.col("source_pdf_page_number") - F.col("printed_page_number"), F.col("source_pdf_page_number") - number)).alias("offset")
    offsets = edges.select("document_id", shown).filter("offset is not null").groupBy("document_id", "offset").count()
    offsets = stored(offsets.groupBy("document_id").agg(F.max(F.struct("count", -F.col("offset"), "offset")).alias("o")).select(F.col("document_id").alias("_d"), F.col("o.offset").alias("offset")), "offsets")
    edges = _place(edges, offsets, ["document_id"], ["_d"]).drop("_d")
    edges = edges.withColumn("n", F.coalesce(F.col("printed_page_number"), F.col("source_pdf_page_number") - F.col("offset")))
    found = F.concat_ws(" ", "alone", "first", "last", "long_alone", "long_first", "long_last")
    needed = {"hanzi": "[一二三四五六七八九十]", "ciphers": "[一二三四五六七八九零〇]"}  # others are spared the work
    edges = edges.withColumns({k: F.when((F.trim(found) != "") & (found.rlike(needed[k]) if k in needed else F.lit(True)), x) for k, x in _notations(F.col("n")).items()})

    def is_number(x: Column) -> Column:
        plain = F.translate(x, "〇", "零")
        return F.coalesce((x != "") & ((_digits(x) == F.col("arabic")) | (_digits(x, "6") == F.col("arabic")) | (skeleton(x) == F.col("roman")) | (plain == F.col("hanzi")) | (plain == F.col("ciphers"))), F.lit(False))

    edges = edges.withColumns({f"is_{c}": F.exists(F.array(c, f"long_{c}"), is_number) for c in ("alone", "first", "last")})
    digit_like = lambda c: F.coalesce((F.col(c) != "") & F.col(c).rlike("[0-9]") & _digits(F.col(c)).rlike("^[0-9]+$"), F.lit(False))
    title = (
        F.when(F.col("is_first") | digit_like("first"), F.regexp_replace("text", r"^\S+(?:\s{2,}|\t|\s*\|\s*)", ""))
        .when(F.col("is_last") | digit_like("last"), F.regexp_replace("text", r"(?:\s{2,}|\t|\s*\|\s*)\S+$", ""))
        .when(F.col("is_alone"), F.lit(""))
        .otherwise(F.col("text"))
    )
    edges = edges.select("page_id", "document_id", "chapter_id", "chapter_page_index", "line_no", "top", "bottom", "kind", (F.col("is_alone") | F.col("is_first") | F.col("is_last")).alias("numbered"), F.when(title.startswith("#"), F.regexp_replace(title, r"^#+\s*", "")).otherwise(title).alias("title"))
    candidate = F.col("kind").isin("prose", "other", "heading") & (F.col("top").between(1, 2) | F.col("bottom").between(1, 2)) & (F.length("title") <= 120) & ~F.substring("title", -1, 1).isin(*".。;；!?！？") & ~F.ltrim("title").rlike("^[a-z]") & ~_hyphen_end(F.col("title"))
    shape = F.regexp_replace(skeleton(F.when(F.col("title").rlike("[0-9]"), F.regexp_replace("title", r"\b[0-9]+\b", "#")).otherwise(F.col("title"))), r"[\s,.:;'’·\-—]+", "")
    edges = edges.withColumn("shape", F.when(candidate, shape))
    long_enough = F.length("shape") >= F.when(F.col("shape").rlike("[㐀-鿿]"), 2).otherwise(3)
    edges = stored(edges.withColumn("key", F.when(long_enough, F.col("shape"))).drop("shape"), "keyed")
    keyed = edges.filter("key is not null")
    opens = keyed.filter("chapter_page_index = 1 and top <= 2").select("document_id", "chapter_id", "key", "top", (F.col("kind") == "heading").alias("h"))
    opening = opens.groupBy("document_id", "chapter_id").agg(F.max(F.struct("h", -F.col("top"), "key")).alias("o")).select(F.col("document_id").alias("_od"), F.col("chapter_id").alias("_oc"), F.col("o.key").alias("opening"))
    opening = stored(opening, "opening")
    keyed = _place(keyed, opening, ["document_id", "chapter_id"], ["_od", "_oc"]).drop("_od", "_oc")
    is_title = F.coalesce((F.col("chapter_page_index") == 1) & (F.col("top") <= 2) & (F.col("key") == F.col("opening")), F.lit(False))
    keyed = keyed.withColumn("is_title", is_title)  # a join with a row per chapter: cheaper made again than written
    # repeated through the book or the chapter
    votes = keyed.filter((F.col("kind") != "heading") | F.col("is_title"))
    per_chapter = facts.groupBy("document_id", "chapter_id").agg(F.count(F.lit(1)).alias("n_chapter"))
    per_book = per_chapter.groupBy("document_id").agg(F.sum("n_chapter").alias("n_book"))
    by_chapter = stored(votes.select("document_id", "chapter_id", "key", "page_id").distinct().groupBy("document_id", "chapter_id", "key").agg(F.count(F.lit(1)).alias("c")).filter("c >= 1"), "by_chapter")
    by_book = by_chapter.groupBy("document_id", "key").agg(F.sum("c").alias("c"), F.max("c").alias("most"))
    books = _place(by_book, per_book.withColumnRenamed("document_id", "_bd"), ["document_id"], ["_bd"]).filter("c >= 2 and c >= 0.12 * n_book").select("document_id", F.lit(None).cast("string").alias("chapter_id"), "key")
    chapters = _place(by_chapter, per_chapter.withColumnsRenamed({"document_id": "_bd", "chapter_id": "_bc"}), ["document_id", "chapter_id"], ["_bd", "_bc"]).filter("c >= 2 and c >= 0.15 * n_chapter").select("document_id", "chapter_id", "key")
    known = books.unionAll(chapters).unionAll(opening.select(F.col("_od").alias("document_id"), F.col("_oc").alias("chapter_id"), F.col("opening").alias("key"))).distinct()
    starts = known.select("document_id", "chapter_id", F.explode(F.transform(F.sequence(F.least(F.when(F.col("key").rlike("[㐀-鿿]"), 2).otherwise(5), F.length("key")), F.length("key")), lambda i: F.substring("key", F.lit(1), i))).alias("_k"), "key")
    starts = starts.select(F.col("document_id").alias("_kd"), F.col("chapter_id").alias("_kc"), "_k", (F.col("_k") == F.col("key")).alias("whole"))
    match = keyed.filter("not is_title").join(starts, (F.col("document_id") == F.col("_kd")) & (F.col("key") == F.col("_k")) & (F.col("_kc").isNull() | (F.col("_kc") == F.col("chapter_id"))), "left_semi")
    headers = match.filter(F.col("kind") != "heading").select("page_id", "line_no", F.lit("running_header").alias("noise"))
    numbers = edges.filter("numbered").select("page_id", "line_no", F.lit("page_number").alias("noise"))
    titles = keyed.filter("is_title").select("page_id", "line_no", F.lit("title").alias("noise"))
    return headers.unionAll(numbers).unionAll(titles).distinct()


#: What separates words: spaces and punctuation but not the break marks, which stay at the end of a half.
_SPLIT = "[\\s!-,./:-@\\[-`{}~‑-⁯　-〿！-／：-＠《-》]+"
_CUT = "\x01"


def _words(text: Column) -> Column:
    """The words of a Latin line in lower case, without hyphens; a stroke counts as a letter inside a word only."""
    return F.filter(F.split(F.lower(text), _SPLIT.replace("[", f"[{MARKS}", 1)), lambda w: (w != "") & (w != "|"))


def _ends_cut(text: Column) -> Column:
    return F.coalesce(text.rlike(f"[A-Za-z0-9|][{MARKS}]$"), F.lit(False))


def _hyphen_end(text: Column) -> Column:
    """A cheap test that holds for every text that ends with a break mark."""
    return text.endswith("-") | text.endswith("‐") | text.endswith("­") | text.endswith("¬")


def _latin(lines: DataFrame, kinds: list[str]) -> DataFrame:
    return lines.filter(F.col("kind").isin(kinds)).filter("latin")


def raw_counts(lines: DataFrame) -> DataFrame:
    """``raw, n``: the pieces between blanks in running text, in lower case; what follows a broken word is marked."""
    cut = F.coalesce(_hyphen_end(F.col("before")), F.lit(False))
    text = F.when(cut, F.concat(F.lit(_CUT), F.ltrim("text"))).otherwise(F.col("text"))
    return _latin(lines, ["prose", "list"]).select(F.explode_outer(F.split(F.lower(text), " ")).alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


def raw_forms(raw: DataFrame) -> DataFrame:
    """``raw, form, n``: the word forms of each distinct piece, halves of broken words left out.

    Hyphenated compounds stand as such and by their parts.
    """
    # plain words need no splitting; conditions stay within the generators, as a filter would move down and count the pieces again
    split = F.split("raw", _SPLIT)
    forms_of = lambda pieces: raw.select("raw", F.explode_outer(pieces).alias("form"), "n").filter(~F.col("form").rlike(f"^[{MARKS}|]*$|[{MARKS}]$|{_CUT}"))
    forms = forms_of(F.when(F.col("raw").rlike("^[a-z]+$"), F.array("raw")).otherwise(split))
    marked = forms_of(F.when(F.col("raw").rlike(f"[{MARKS}]"), split))
    parts = marked.filter(F.col("form").rlike(f"[{MARKS}]")).select("raw", F.explode_outer(F.split("form", f"[{MARKS}]")).alias("form"), "n").filter("form <> ''")
    return forms.unionAll(parts)


def word_counts(forms: DataFrame) -> DataFrame:
    """``form, n``: how often each word form stands in running text."""
    return forms.groupBy("form").agg(F.sum("n").alias("n"))


def _explains(read: str, true: str, most: int = 3) -> bool:
    """Whether ``read`` comes from ``true`` by one to ``most`` listed confusions."""
    reach = {(0, 0): 0}
    order = [(0, 0)]
    for i, j in order:  # grows while it is walked
        used = reach[i, j]
        if i == len(read) and j == len(true):
            return 0 < used
        steps = [(1, 1, 0)] if i < len(read) and j < len(true) and read[i] == true[j] else []
        steps += [(len(a), len(b), 1) for a, b in CONFUSIONS if read.startswith(a, i) and true.startswith(b, j)]
        for a, b, cost in steps:
            to = (i + a, j + b)
            if used + cost <= most and to not in reach:
                reach[to] = used + cost
                order.append(to)
    return False


def suspects(counts: DataFrame) -> DataFrame:
    """``form, other, n, n_other``: forms with the better or rival forms that explain them by confusions."""
    words = counts.filter("not form like '%-%'").withColumn("skeleton", skeleton(F.col("form")))
    words = words.filter(F.col("form").rlike(r"\p{L}|\|"))
    better = counts.filter("n >= 2 and not form like '%-%'").withColumn("skeleton", skeleton(F.col("form"))).select("skeleton", F.col("form").alias("other"), F.col("n").alias("n_other"))
    # a number has no fixed vocabulary: its digits are the form that explains it
    mixed = words.filter(F.col("form").rlike("^[0-9oilszgqb|í]{2,6}$") & F.col("form").rlike("[0-9]"))
    mixed = mixed.select("form", _digits(F.col("form")).alias("other"), "n")
    mixed = mixed.join(counts.select(F.col("form").alias("other"), F.col("n").alias("n_other")), "other", "left").select("form", "other", "n", F.coalesce("n_other", F.lit(0)).alias("n_other"))
    pairs = words.join(better, "skeleton").filter("form <> other and n_other * 400 >= n").select("form", "other", "n", "n_other")

    @F.pandas_udf("boolean")
    def explained(read: pd.Series, true: pd.Series) -> pd.Series:
        return pd.Series([_explains(a, b) for a, b in zip(read, true)], dtype=bool)

    return pairs.filter(explained("form", "other")).unionAll(mixed).distinct()


def misread_words(lines: DataFrame, raw: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Body prose lines with a surely misread word or number (``page_id, line_no, form, meant``); the occurrences of forms
    that have rivals, for :func:`in_context`; and the rivals (``form, other``).

    ``raw`` are the forms of the distinct pieces (:func:`raw_forms`), ``counts`` those of the forms.
    """
    pairs = stored(suspects(counts), "pairs")
    number = F.col("form").rlike("[0-9]") & _digits(F.col("form")).rlike("^[0-9]+$")
    sure = F.when(number, F.col("n") <= 0.3 * F.greatest("n_other", F.lit(1)) + 1).otherwise(F.col("n") <= RARE * F.col("n_other"))
    rare = pairs.filter(sure).groupBy("form").agg(F.max_by("other", "n_other").alias("meant"))
    rare = stored(rare.select(F.col("form").alias("_rare"), "meant"), "rare")
    # rivals are forms that both stand on their own: neither is a sure misreading
    rivals = pairs.filter(~number).join(rare, F.col("form") == F.col("_rare"), "left_anti").join(rare, F.col("other") == F.col("_rare"), "left_anti").select("form", "other")
    rivals = stored(rivals.distinct(), "rivals")
    judged = rivals.select("form").unionAll(rivals.select(F.col("other").alias("form"))).distinct()
    odd = rare.select(F.col("_rare").alias("_o"), "meant", F.lit(False).alias("judged")).unionAll(judged.select(F.col("form").alias("_o"), F.lit(None).cast("string").alias("meant"), F.lit(True).alias("judged")))
    odd_raw = stored(raw.join(odd, F.col("form") == F.col("_o")).select(F.col("raw").alias("_raw"), "form", "meant", "judged").distinct(), "odd")
    before, after, text = F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")), F.lower("text")
    prose = _latin(lines, ["prose"])
    pieces = prose.select("page_id", "line_no", "before", "after", F.split(text, " ").alias("w")).withColumn("end", F.size("w") - 1)
    pieces = pieces.select("page_id", "line_no", "before", "after", "w", "end", F.posexplode_outer("w").alias("i", "raw"))
    small = broadcast_if_small(odd_raw, MOST_SENT)
    if small is odd_raw:
        # too many to send: first drop the most frequent pieces that are surely right, of which a bounded number is sent
        stop = raw.select("raw", "n").distinct().join(odd_raw, F.col("raw") == F.col("_raw"), "left_anti").orderBy(F.col("n").desc(), "raw").limit(STOP_FORMS).select(F.col("raw").alias("_stop"))
        pieces = pieces.join(F.broadcast(stop), F.col("raw") == F.col("_stop"), "left_anti")
    pieces = pieces.join(small, F.col("raw") == F.col("_raw"))
    here = pieces.filter(~((F.col("i") == 0) & F.coalesce(_hyphen_end(F.col("before")) & _ends_cut(F.col("before")), F.lit(False))) & ~((F.col("i") == F.col("end")) & _hyphen_end(F.col("raw")) & _ends_cut(F.col("raw"))))
    # most neighbours are plain words, which need no splitting
    word = lambda c, n: F.when(c.rlike("^[a-z]+$"), c).otherwise(F.coalesce(F.try_element_at(_words(c), F.lit(n)), F.lit("^")))
    near = lambda i, other, n: F.when(F.col("judged"), word(F.coalesce(F.try_element_at("w", F.when(i > 0, i)), other), n))
    here = here.select("page_id", "line_no", "form", "judged", "meant", near(F.col("i"), before, -1).alias("p"), near(F.col("i") + 2, after, 1).alias("q"), F.lit(None).cast("int").alias("least"), F.lit(None).cast("int").alias("below"))
    # a broken word is judged whole, at both of its lines; only the half with the wrong character counts
    last_word, first_word = lambda c: F.try_element_at(_words(c), F.lit(-1)), lambda c: F.try_element_at(_words(c), F.lit(1))
    ends = F.when(_hyphen_end(F.col("text")) & _ends_cut(F.col("text")), F.struct(last_word(F.substring_index("text", " ", -1)).alias("a"), first_word(after).alias("b"), F.lit(True).alias("first")))
    cuts = F.when(_hyphen_end(before) & _ends_cut(F.col("before")), F.struct(last_word(before).alias("a"), first_word(F.substring_index(F.ltrim("text"), " ", 1)).alias("b"), F.lit(False).alias("first")))
    halves = lines.filter("kind = 'prose'").filter(_hyphen_end(F.col("text")) | _hyphen_end(before))
    whole = halves.select("page_id", "line_no", F.explode_outer(F.array_compact(F.array(ends, cuts))).alias("h")).filter("h is not null").select("page_id", "line_no", "h.*")
    whole = whole.withColumn("form", F.concat("a", "b")).join(odd.filter("not judged"), F.col("form") == F.col("_o"))
    n_a = F.length("a")
    whole = whole.select("page_id", "line_no", "form", "judged", "meant", F.lit(None).cast("string").alias("p"), F.lit(None).cast("string").alias("q"), F.when(~F.col("first"), n_a).alias("least"), F.when(F.col("first"), n_a).alias("below"))
    tokens = stored(here.unionAll(whole), "tokens")
    same = F.length(F.regexp_extract(F.concat_ws("\n", "form", "meant"), r"(?s)^(.*).*\n\1", 1))
    right_half = F.when(F.col("below").isNotNull(), same < F.col("below")).when(F.col("least").isNotNull(), same >= F.col("least")).otherwise(F.lit(True))
    hit = tokens.filter(~F.col("judged") & right_half).select("page_id", "line_no", "form", "meant")
    mask = lambda c: F.when(F.col(c).rlike("^[0-9]+$"), "#").otherwise(F.col(c))
    return hit, tokens.filter("judged").select("page_id", "line_no", "form", mask("p").alias("p"), mask("q").alias("q")), rivals


def in_context(occurrences: DataFrame, rivals: DataFrame) -> DataFrame:
    """``page_id, line_no, form, p, q, meant`` of occurrences whose neighbours speak for a rival form.

    ``occurrences``: ``page_id, line_no, form, p, q`` with the neighbours ``p`` and ``q``. A rival must be
    ``CONTEXT_RATIO`` times better supported between the same neighbours; where it never stands between both,
    beside one of them.
    """
    occurrences = stored(occurrences, "occurrences")
    tri = stored(occurrences.groupBy("p", "form", "q").agg(F.count(F.lit(1)).alias("n3")), "contexts")
    left = tri.groupBy("p", "form").agg(F.sum("n3").alias("nl"))
    right = tri.groupBy("form", "q").agg(F.sum("n3").alias("nr"))
    cand = tri.join(rivals, "form")
    r3 = tri.select("p", F.col("form").alias("other"), "q", F.col("n3").alias("o3"))
    rl = left.select("p", F.col("form").alias("other"), F.col("nl").alias("ol"))
    rr = right.select(F.col("form").alias("other"), "q", F.col("nr").alias("orr"))
    cand = cand.join(r3, ["p", "other", "q"], "left").join(rl, ["p", "other"], "left").join(rr, ["other", "q"], "left").join(left, ["p", "form"], "left").join(right, ["form", "q"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    wins = F.when(z("o3") > 0, z("o3") >= CONTEXT_RATIO * F.col("n3")).otherwise((F.least(z("ol"), z("orr")) > 0) & (z("ol") + z("orr") >= CONTEXT_RATIO * (F.col("nl") + F.col("nr") - 2 * F.col("n3") + 1)))
    bad = cand.filter(wins).groupBy("p", "form", "q").agg(F.max_by("other", F.struct(z("o3"), z("ol") + z("orr"), F.col("other"))).alias("meant"))
    bad = broadcast_if_small(stored(bad, "bad"), MOST_SENT)
    return occurrences.join(bad, ["p", "form", "q"]).select("page_id", "line_no", "form", "p", "q", "meant")


def _codes() -> tuple[str, str]:
    """The ideographs that have look-alikes, and a private code point for each."""
    chars = sorted({c for pair in IDEOGRAPHS for c in pair})
    return "".join(chars), "".join(chr(0xE000 + i) for i in range(len(chars)))


def ideographs(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences of ideographs that have look-alikes, with their neighbours, and the rivals (``form, other``)."""
    chars, codes = _codes()
    code = dict(zip(chars, codes))  # one range of code points, so that the pattern stays simple
    own = lines.filter("kind = 'prose'").filter(F.col("text").rlike("[㐀-鿿]"))
    near = lambda c, n: F.coalesce(F.when(F.length(F.trim(c)) > 0, F.substring(F.trim(c), n, 1)), F.lit("^"))
    ctx = F.translate(F.concat(near("before", -1), F.trim("text"), near("after", 1)), chars + "123456789", codes + "0" * 9)
    found = own.select("page_id", "line_no", F.explode_outer(F.regexp_extract_all(ctx, F.lit(f"(?=(.[{chr(0xE000)}-{chr(0xE000 + len(chars))}].))"), F.lit(1))).alias("c")).filter("c is not null")
    occ = found.select("page_id", "line_no", F.substring("c", 2, 1).alias("form"), F.substring("c", 1, 1).alias("p"), F.substring("c", 3, 1).alias("q"))
    return occ, lines.sparkSession.createDataFrame([(code[a], code[b]) for a, b in IDEOGRAPHS], "form string, other string")


def broken_words(lines: DataFrame, edges: DataFrame, noise: DataFrame, counts: DataFrame) -> DataFrame:
    """``page_id, line_no, one`` of lines that end inside a word, with the whole word."""
    ends = lines.filter("kind in ('prose', 'list')").filter(_hyphen_end(F.col("text")) & _ends_cut(F.col("text"))).select("page_id", "line_no", F.substring_index("text", " ", -1).alias("text"), "after")
    # first and last line of running text of each page, past headers and numbers
    edges = edges.select("page_id", "line_no", _bounded(F.substring_index(F.ltrim("text"), " ", 1), 1).alias("text"), *PLACE[:3]).join(noise.select("page_id", "line_no").distinct(), ["page_id", "line_no"], "left_anti")
    body = stored(edges.groupBy("page_id", *PLACE[:3]).agg(F.max("line_no").alias("last_line"), F.min(F.struct("line_no", "text")).alias("f")), "body")
    following = body.select(F.col("document_id").alias("_d"), F.col("chapter_id").alias("_c"), (F.col("chapter_page_index") - 1).alias("_i"), F.col("f.text").alias("next_text"))
    tail = body.select(F.col("page_id").alias("_p"), "last_line", "document_id", "chapter_id", "chapter_page_index")
    tail = tail.join(following, (F.col("document_id") == F.col("_d")) & (F.col("chapter_id") == F.col("_c")) & (F.col("chapter_page_index") == F.col("_i")), "left").select("_p", "last_line", "next_text")
    rows = ends.join(tail, F.col("page_id") == F.col("_p"), "left")
    goes_on = F.when(F.col("line_no") >= F.col("last_line"), F.col("next_text")).otherwise(F.col("after"))
    word = r"([\p{L}\p{N}|]+(?:-[\p{L}\p{N}|]+)*)"
    rows = rows.select("page_id", "line_no", F.regexp_extract(F.lower("text"), word + f"[{MARKS}]$", 1).alias("a"), F.substring("text", -1, 1).alias("mark"), F.regexp_extract(F.lower(F.coalesce(goes_on, F.lit(""))), r"^\s*" + word, 1).alias("b")).filter("a <> ''")
    rows = rows.withColumn("last_a", F.regexp_extract("a", r"([^-]+)$", 1)).withColumn("first_b", F.regexp_extract("b", r"^([^-]+)", 1))
    rows = rows.withColumn("one", F.concat("last_a", "first_b")).withColumn("two", F.concat_ws("-", "a", "b"))
    shapes = counts.groupBy(skeleton(F.col("form")).alias("_s")).agg(F.sum("n").alias("_n"))
    shapes = stored(shapes, "shapes")
    rows = stored(rows.withColumn("s1", skeleton(F.col("one"))).withColumn("s2", skeleton(F.col("two"))), "breaks")
    rows = rows.join(shapes.withColumnsRenamed({"_s": "_s1", "_n": "n1"}), F.col("s1") == F.col("_s1"), "left").join(shapes.withColumnsRenamed({"_s": "_s2", "_n": "n2"}), F.col("s2") == F.col("_s2"), "left")
    n1, n2 = F.coalesce("n1", F.lit(0)), F.coalesce("n2", F.lit(0))
    known = counts.filter("n >= 20").select(F.col("form").alias("_w"), F.lit(True).alias("known_a"))
    rows = rows.join(known, F.col("last_a") == F.col("_w"), "left")
    # an unknown word: a mark that is no hyphen always breaks, a hyphen does where its left side is no word
    broken = (F.col("b") != "") & ((F.col("mark") != "-") | (n1 > n2) | ((n1 == n2) & F.col("known_a").isNull()))
    end_of_page = (F.col("b") == "") & ((F.col("mark") != "-") | F.col("known_a").isNull())
    return rows.filter(broken | end_of_page).select("page_id", "line_no", "one")


def _analysed(pages: DataFrame, every_line: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Lines, edge noise, sure misreadings, misreadings by context, broken words - of all pages."""
    lines = stored(page_lines(pages, every_line), "lines")
    facts = stored(page_facts(pages), "facts")
    edges = stored(edge_ends(lines), "edges")
    edge = stored(edge_noise(edges, facts), "edge")
    raw = stored(raw_forms(raw_counts(lines)), "raw")
    counts = stored(word_counts(raw), "counts")
    hit, words, rivals = misread_words(lines, raw, counts)
    signs, looks = ideographs(lines)
    return lines, edge, hit, in_context(words.unionAll(signs), rivals.unionAll(looks)), broken_words(lines, edges, edge, counts)


def page_noise(pages: DataFrame) -> DataFrame:
    """``page_id, line_no, noise`` for every noisy line and kind of noise."""
    _, edge, hit, judged, broken = _analysed(pages, every_line=False)
    bad = hit.select("page_id", "line_no").unionAll(judged.select("page_id", "line_no")).distinct()
    found = stored(bad.withColumn("noise", F.lit("misread")).unionAll(broken.select("page_id", "line_no", F.lit("broken_word").alias("noise"))), "found")
    found = found.join(edge.select("page_id", "line_no"), ["page_id", "line_no"], "left_anti")
    return found.unionAll(edge.filter("noise <> 'title'")).distinct()


def repaired_paragraphs(pages: DataFrame) -> DataFrame:
    """``page_id, paragraph_no, kind, first_line, last_line, text, goes_on``: the continuous text of every page.

    Headers and page numbers are left out, misread words and ideographs are replaced, broken words joined. A paragraph
    is a run of lines of one kind without a blank line (SQL windows over the page); list items and headings stand alone,
    tables and blocks keep their lines. ``goes_on``: prose that does not end a sentence.
    """
    lines, edge, hit, judged, broken = _analysed(pages, every_line=True)
    chars, codes = _codes()
    sign = F.col("form").rlike("[\ue000-\uf8ff]")
    real = lambda c: F.translate(c, codes, chars)
    by_left = F.col("p") != "^"
    read = F.when(sign, F.when(by_left, F.concat("p", "form")).otherwise(F.concat("form", "q"))).otherwise(F.col("form"))
    true = F.when(sign, F.when(by_left, F.concat("p", "meant")).otherwise(F.concat("meant", "q"))).otherwise(F.col("meant"))
    fixes = hit.select("page_id", "line_no", F.col("form").alias("read"), F.col("meant").alias("true"), F.lit(False).alias("sign"))
    fixes = fixes.unionAll(judged.select("page_id", "line_no", real(read).alias("read"), real(true).alias("true"), sign.alias("sign"))).filter("true is not null")
    fixes = fixes.groupBy("page_id", "line_no").agg(F.array_sort(F.collect_set(F.struct("read", "true", "sign"))).alias("fixes"))
    gone = edge.filter("noise <> 'title'").select("page_id", "line_no").distinct()
    rows = lines.select("page_id", "line_no", "text", "kind").join(gone, ["page_id", "line_no"], "left_anti").join(fixes, ["page_id", "line_no"], "left")
    rows = rows.join(broken.select("page_id", "line_no", F.lit(True).alias("broken")).distinct(), ["page_id", "line_no"], "left")

    def mend(t: Column, f: Column) -> Column:
        whole = lambda x, y: F.regexp_replace(t, F.concat(F.lit(r"(?<![\p{L}\p{N}|])\Q"), x, F.lit(r"\E(?![\p{L}\p{N}|])")), y)
        low = whole(f["read"], f["true"])
        t_cap = F.regexp_replace(low, F.concat(F.lit(r"(?<![\p{L}\p{N}|])(?i)\Q"), f["read"], F.lit(r"\E(?![\p{L}\p{N}|])")), F.concat(F.upper(F.substring(f["true"], 1, 1)), F.substring(f["true"], F.lit(2), F.length(f["true"]))))
        return F.when(f["sign"], F.replace(t, f["read"], f["true"])).otherwise(t_cap)

    text = F.when(F.col("fixes").isNotNull(), F.aggregate("fixes", F.col("text"), mend)).otherwise(F.col("text"))
    rows = rows.select("page_id", "line_no", "kind", F.when(F.col("broken"), F.regexp_replace(text, f"[{MARKS}]$", _CUT)).otherwise(text).alias("text"))
    w = W.partitionBy("page_id").orderBy("line_no")
    before = F.lag("kind").over(w)
    starts = (before.isNull() | (before != F.col("kind")) | F.col("kind").isin("list", "heading")).cast("int")
    rows = rows.withColumn("starts", starts).withColumn("paragraph_no", F.sum("starts").over(w)).filter("kind <> 'blank'")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"])
    out = rows.groupBy("page_id", "paragraph_no", "kind").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), parts.alias("parts"))
    flow = F.array_join("parts", "\n")
    flow = F.regexp_replace(flow, f"{_CUT}\\s*", "")  # a broken word goes on without a gap
    flow = F.regexp_replace(flow, "(?<=[A-Za-z]-)\n(?=[a-z])", "")  # a hyphen of the word itself stays
    flow = F.regexp_replace(flow, "(?<=[㐀-鿿，。；：、！？0-9])\n(?=[㐀-鿿，。；：、！？0-9])", "")
    flow = F.regexp_replace(flow, "\\s*\n\\s*", " ")
    text = F.when(F.col("kind").isin("table", "block", "other"), F.array_join("parts", "\n")).otherwise(F.trim(flow))
    out = out.select("page_id", F.dense_rank().over(W.partitionBy("page_id").orderBy("paragraph_no")).alias("paragraph_no"), "kind", "first_line", "last_line", text.alias("text"))
    return out.withColumn("goes_on", (F.col("kind") == "prose") & ~F.substring("text", -1, 1).isin(*".。!?！？:：;；\"”)）"))
