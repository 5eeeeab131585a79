"""Report layouts: table grids, column roles, intervals in text, rows from OCR lines, metadata."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Header words of report tables by role.
ROLES = {
    "name": ("项目", "检验项目", "项目名称", "analyte", "test", "name"), "code": ("代号", "缩写", "code"), "value": ("结果", "result", "value"),
    "unit": ("单位", "unit"), "range": ("参考区间", "参考范围", "参考值", "reference", "range"), "flag": ("提示", "flag"),
}
_NUM = r"[+-]?\d+(?:\.\d+)?"


def grid(html: str) -> list[tuple[int, int, str, int]]:
    """Cells ``(row, col, text, source)`` of an HTML table, spans expanded; ``source`` numbers the cell they come from.

    Overlapping spans raise ``ValueError``.
    """
    out: dict = {}
    source = 0
    for r, row in enumerate(re.findall(r"<tr[^>]*>(.*?)</tr>", html, re.S | re.I)):
        c = 0
        for attrs, cell in re.findall(r"<t[dh]([^>]*)>(.*?)</t[dh]>", row, re.S | re.I):
            while (r, c) in out:
                c += 1
            span = lambda k: int((re.search(rf'{k}\s*=\s*["\']?(\d+)', attrs, re.I) or [0, 1])[1])
            text = re.sub(r"<[^>]+>", "", cell).strip()
            for i in range(span("rowspan")):
                for j in range(span("colspan")):
                    if (r + i, c + j) in out:
                        raise ValueError("overlapping spans")
                    out[r + i, c + j] = (text, source)
            c += span("colspan")
            source += 1
    return [(r, c, t, s) for (r, c), (t, s) in sorted(out.items())]


def table_grids(blocks: DataFrame) -> DataFrame:
    """``block_id, row, col, text, source`` for blocks (``block_id, html``); broken tables give one row with null text."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows: list = []
            for b, h in zip(p["block_id"], p["html"]):
                try:
                    rows += [(b, *cell) for cell in grid(h or "")]
                except ValueError:
                    rows.append((b, None, None, None, None))
            out = pd.DataFrame(rows, columns=["block_id", "row", "col", "text", "source"])
            yield out.astype({"row": "Int32", "col": "Int32", "source": "Int32"})

    return blocks.select("block_id", "html").mapInPandas(run, "block_id string, row int, col int, text string, source int")


def column_role(header: Column) -> Column:
    """The role of a column by its header, null for none."""
    h = F.lower(F.regexp_replace(header, r"\s", ""))
    return F.coalesce(*[F.when(h.isin(list(words)), role) for role, words in ROLES.items()])


def reference_bounds(text: Column) -> Column:
    """``lower, upper, lower_inclusive, upper_inclusive`` of ``a-b``, ``<b``, ``≤b``, ``>a``, ``≥a``; nulls for anything else."""
    t = F.translate(F.regexp_replace(F.trim(text), r"^[(\[（【]|[)\]）】]$", ""), "～~—–－＜＞", "-----<>")
    t = F.regexp_replace(F.regexp_replace(t, r"\s", ""), "--+", "-")
    two = rf"^({_NUM})-({_NUM})$"
    low, high = rf"^(?:>|>=|≥)({_NUM})$", rf"^(?:<|<=|≤)({_NUM})$"
    n = lambda p, g: F.nullif(F.regexp_extract(t, p, g), F.lit("")).try_cast("double")
    return F.struct(
        F.coalesce(n(two, 1), n(low, 1)).alias("lower"), F.coalesce(n(two, 2), n(high, 1)).alias("upper"),
        (t.rlike(two) | t.rlike("^(>=|≥)")).alias("lower_inclusive"), (t.rlike(two) | t.rlike("^(<=|≤)")).alias("upper_inclusive"),
    )


def ocr_rows(lines: DataFrame) -> DataFrame:
    """``doc_id, page, row, cells``: OCR lines (``doc_id, page, text, top, left, height``) grouped to table rows.

    A line joins the row whose running mean centre is within the larger of 4 and 0.65 of the page's median height.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        tolerance = max(4.0, 0.65 * float(p["height"].median()))
        p = p.assign(centre=p["top"] + p["height"] / 2).sort_values(["centre", "left"], kind="stable")
        rows: list = []
        for r in p.itertuples():
            if rows and abs(rows[-1][0] - r.centre) <= tolerance:
                mean, cells = rows[-1]
                rows[-1] = ((mean * len(cells) + r.centre) / (len(cells) + 1), [*cells, (r.left, r.text)])
            else:
                rows.append((r.centre, [(r.left, r.text)]))
        head = (p["doc_id"].iloc[0], int(p["page"].iloc[0]))
        return pd.DataFrame([(*head, i, [t for _, t in sorted(cells)]) for i, (_, cells) in enumerate(rows)], columns=["doc_id", "page", "row", "cells"])

    used = lines.filter("text is not null and top is not null and height is not null")
    return used.groupBy("doc_id", "page").applyInPandas(run, "doc_id string, page int, row int, cells array<string>")


def first_match_merge(entities: DataFrame, group: str) -> DataFrame:
    """Entities (``order, names array``) of a group merged in order: each joins the one earlier group it shares a name
    with; sharing names with several is ``ambiguous`` and starts none. Columns ``group, order, merged, ambiguous``."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        owner: dict = {}
        rows, made = [], 0
        for r in p.sort_values("order", kind="stable").itertuples():
            names = list(r.names) if r.names is not None else []
            hits = sorted({owner[n] for n in names if n in owner})
            if len(hits) > 1:
                rows.append((r.order, None, True))
                continue
            if not hits:
                hits, made = [made], made + 1
            for n in names:
                owner.setdefault(n, hits[0])
            rows.append((r.order, hits[0], False))
        out = pd.DataFrame(rows, columns=["order", "merged", "ambiguous"]).astype({"merged": "Int32"})
        return out.assign(**{group: p[group].iloc[0]})[[group, "order", "merged", "ambiguous"]]

    kind = dict(entities.dtypes)[group]
    return entities.select(group, "order", "names").groupBy(group).applyInPandas(run, f"{group} {kind}, order int, merged int, ambiguous boolean")


def rule_parts(text: Column) -> Column:
    """``predicates, conclusion`` of ``Rule: IF a AND b THEN c``; null for any other text."""
    p = r"(?is)^\s*rule\s*:\s*if\s+(.+?)\s+then\s+(.+?)\s*$"
    return F.when(text.rlike(p), F.struct(F.split(F.regexp_extract(text, p, 1), r"(?i)\s+and\s+").alias("predicates"), F.regexp_extract(text, p, 2).alias("conclusion")))


def gate_reason(inputs: Column, outputs: Column, logic: Column, quote: Column) -> Column:
    """Why a candidate rule is refused, null for an accepted one; the first reason in this order holds."""
    return (
        F.when(F.size(F.array_intersect(inputs, outputs)) > 0, "rule_input_output_overlap")
        .when(F.exists(outputs, lambda o: F.contains(quote, F.concat(F.lit("(如 "), o)) | F.contains(quote, F.concat(F.lit("（如"), o))), "rule_output_is_explicit_example")
        .when(logic.rlike(r"[<>≤≥]\s*\d"), "threshold_rule")
        .when(F.size(inputs) < 2, "single_input")
    )
