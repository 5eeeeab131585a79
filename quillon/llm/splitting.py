"""Splitting oversized items at natural boundaries, content-defined.

A rolling hash over the text gives landmarks: within the window of allowed piece ends the place with the largest hash is
the landmark, and the cut snaps to the nearest boundary of the best kind in the window (paragraph, line, sentence, word).
Landmarks depend on the text around them only, so an edit moves the cuts of neighbouring pieces and no others.

Semantics
---------
* Sizes are code points. An item of at most ``max_size`` stays whole (one piece). A piece, with the ``overlap`` code
  points it repeats from before its cut, is at most ``max_size``; the parts without overlap join to the item's text.
* Tables, fenced blocks and formulas are not cut while a place outside them is allowed; one that is larger than a piece
  is cut between its lines, a line larger than a piece between words, else anywhere but before a combining mark.
* Null texts are no items; empty texts are one empty piece. ``overlap`` must be smaller than half of ``max_size``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Width of the rolling hash in code points, and its base.
WINDOW, BASE = 32, np.uint64(0x9E3779B97F4A7C15)
KINDS = ("paragraph", "line", "sentence", "word")
_ENDS = (re.compile(r"\n[ \t]*\n+"), re.compile(r"\n"), re.compile(r"[.!?…][\"'”’)\]]*\s+|[。！？；][”’」』）]*"), re.compile(r"[ \t]+|，|、"))
_ZONES = re.compile(r"^```.*?(?:^```[^\n]*$|\Z)|^\$\$.*?(?:^\$\$[^\n]*$|\Z)|(?:^[ \t]*\|[^\n]*(?:\n|\Z))+|\$\$[^$]+\$\$|\\\[.*?\\\]", re.M | re.S)


def rolling_hash(text: str) -> np.ndarray:
    """A hash of the ``WINDOW`` code points before each place of the text."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(min(WINDOW, len(codes))):
            total[j + 1 :] += (codes[: len(codes) - j] + np.uint64(1)) * power
            power *= BASE
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
    return total


def cut_points(text: str, max_size: int, overlap: int) -> list[tuple[int, str]]:
    """Places where the text is cut, with the kind of boundary; the last is the end of the text."""
    size = len(text)
    if size <= max_size:
        return [(size, "end")]
    if not 0 <= overlap < max_size / 2:
        raise ValueError("overlap must be less than half of max_size")
    core = max_size - overlap
    least = max(core // 3, overlap, 1)
    hashes = rolling_hash(text)
    zones = [m.span() for m in _ZONES.finditer(text)]
    starts = [a for a, _ in zones]
    ends: list[list[int]] = [[m.end() for m in e.finditer(text)] for e in _ENDS]

    def zone_of(p: int) -> tuple[int, int] | None:
        i = bisect_left(starts, p) - 1
        return zones[i] if i >= 0 and p < zones[i][1] else None

    out, at = [], 0
    while size - at > core:
        lo, hi = at + least, at + core
        landmark = lo + int(hashes[lo : hi + 1].argmax())

        def nearest(kind: int, inside: bool, a: int = lo, b: int = hi) -> int | None:
            places = ends[kind][bisect_left(ends[kind], a) : bisect_right(ends[kind], b)]
            if not inside:
                places = [p for p in places if not zone_of(p)]
            return min(places, key=lambda p: (abs(p - landmark), p), default=None)

        cut, how = None, "hard"
        # outside protected zones first; the place before a zone also when the piece gets short by it; inside last
        for kind in range(3):
            if (cut := nearest(kind, False)) is not None:
                how = KINDS[kind]
                break
        if cut is None and (z := zone_of(hi)) and z[0] > at and z[0] - at >= min(overlap, least):
            cut, how = z[0], "line"
        if cut is None and not zone_of(hi):
            cut = nearest(3, False)
            how = "word"
        for kind in range(1, 4) if cut is None else ():
            if (cut := nearest(kind, True)) is not None:
                how = KINDS[kind]
                break
        if cut is None:
            cut, how = hi, "hard"
            while cut > lo and unicodedata.combining(text[cut]):
                cut -= 1
        out.append((cut, how))
        at = cut
    return [*out, (size, "end")]


def split_items(items: DataFrame, max_size: int, overlap: int, with_text: bool = True) -> DataFrame:
    """Pieces of every item of ``items`` (``item_id, text``) larger than ``max_size``, in order.

    Columns ``item_id, piece_no, char_start, char_end, overlap, boundary[, text]``; ``char_start`` is where the piece
    begins with its overlap. Items within the size are left to the caller: they are one piece as they stand.
    """
    schema = "item_id string, piece_no int, char_start int, char_end int, overlap int, boundary string" + (", text string" if with_text else "")

    def pieces(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for item, text in zip(p["item_id"], p["text"]):
                begin = 0
                for n, (end, how) in enumerate(cut_points(text, max_size, overlap)):
                    repeat = overlap if n else 0
                    row = (item, n, begin - repeat, end, repeat, how)
                    out.append((*row, text[begin - repeat : end]) if with_text else row)
                    begin = end
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return items.filter(F.length("text") > max_size).select(F.col("item_id").cast("string").alias("item_id"), "text").mapInPandas(pieces, schema)
