"""Visually identical text with different characters: one consistent form.

A vocabulary trie is walked by a weighted edit automaton. Substituting a look-alike of the same glyph class and
skipping an ignorable character cost nothing, every other edit costs 1; with the budget 0 only texts that look the
same are accepted. Accepted texts take the vocabulary's spelling, all others are rewritten by the table.

Semantics
---------
* Same look: full-width and half-width forms, spaces of any width, compatibility ideographs and radicals, dashes,
  letters of another script with the same shape, composed and combining accents, characters of no width.
* Not the same look: other case, a missing accent, an added, doubled or wrong character (two spaces are not one).
* Spaces at the ends of a text are ignored. Null and empty texts match nothing; nulls stay null.
* A text that looks like several vocabulary entries is reported with each.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Bound on the vocabulary that is sent to every task.
MAX_VOCABULARY = 200_000
# Letters of other scripts that look like a Latin letter.
LOOK_ALIKES = dict(
    zip(
        "аеорсухіјѕһԁԛԝӏ" "АВЕКМНОРСТУХІЈЅԌ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "οανι" "ɑɡıℓ",
        "aeopcyxijshdqwl" "ABEKMHOPCTYXIJSG" "ABEZHIKMNOPTYX" "oavi" "agil",
    )
)
_SAME_SHAPE = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>")


@lru_cache(maxsize=65_536)
def glyph(ch: str) -> str:
    """The glyph class of a character as base letter and combining marks; empty for an ignorable one."""
    kind = unicodedata.category(ch)
    if kind == "Cf" or 0xFE00 <= ord(ch) <= 0xFE0F or ch in "͏ᅟᅠ឴឵ㅤﾠ":
        return ""
    if kind == "Zs" or ch == "\t":
        return " "
    if kind == "Pd" or ch == "−":
        return "-"
    tag, _, rest = unicodedata.decomposition(ch).rpartition("> ")
    if tag:
        parts = rest.split()
        if tag + ">" in _SAME_SHAPE and len(parts) == 1:
            return glyph(chr(int(parts[0], 16)))
        return ch
    if rest:  # canonical: base letter and marks, or another code point of the same ideograph
        return "".join(glyph(chr(int(p, 16))) for p in rest.split())
    return LOOK_ALIKES.get(ch, ch)


def by_table(text: str) -> str:
    """The text with every character replaced by its glyph class, accents composed, ends trimmed."""
    return unicodedata.normalize("NFC", "".join(map(glyph, text))).strip(" ")


class Trie:
    """A vocabulary trie over glyph classes; an accepting node holds the entries that end there."""

    def __init__(self, entries: Iterable[tuple[str, str]]):
        self.root: dict = {}
        self.words: set[str] = set()
        for text, owner in entries:
            node = self.root
            for ch in "".join(map(glyph, text)).strip(" "):
                node = node.setdefault(ch, {})
            node.setdefault(None, set()).add((text, owner))
            self.words.add(text)

    def walk(self, text: str, budget: int = 0) -> list[tuple[int, str, str]]:
        """``(cost, entry, owner)`` of every vocabulary entry within ``budget`` edits of ``text``, cheapest first."""
        states = {id(self.root): (self.root, 0)}

        def relax(into: dict, node: dict, cost: int) -> None:
            # entering a node also enters those reached by leaving out characters of the vocabulary
            stack = [(node, cost)]
            while stack:
                n, c = stack.pop()
                if c > budget or (id(n) in into and into[id(n)][1] <= c):
                    continue
                into[id(n)] = (n, c)
                if c < budget:
                    stack.extend((child, c + 1) for ch, child in n.items() if ch is not None)

        start: dict = {}
        relax(start, self.root, 0)
        states = start
        for ch in text.strip():
            for g in glyph(ch):  # nothing for an ignorable character: the states stay, at no cost
                after: dict = {}
                for node, cost in states.values():
                    if g in node:
                        relax(after, node[g], cost)
                    if cost < budget:
                        relax(after, node, cost + 1)
                        for other, child in node.items():
                            if other is not None and other != g:
                                relax(after, child, cost + 1)
                if not after:
                    return []
                states = after
        found: dict = {}
        for node, cost in states.values():
            for entry in node.get(None, ()):
                found[entry] = min(cost, found.get(entry, cost))
        return sorted((c, t, o) for (t, o), c in found.items())


def vocabulary_of(terms: DataFrame, key: str, scalars: list[str], arrays: list[str]) -> list[tuple[str, str]]:
    """Distinct ``(text, key)`` of a reference list, refused beyond ``MAX_VOCABULARY`` entries."""
    texts = F.array_compact(F.flatten(F.array(F.array(*scalars), *[F.coalesce(F.col(a), F.array().cast("array<string>")) for a in arrays])))
    rows = terms.select(F.explode(texts).alias("t"), F.col(key).alias("k")).filter("k is not null and trim(t) <> ''").distinct().limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} vocabulary entries")
    return sorted((r.t, r.k) for r in rows)


def canonical_forms(records: DataFrame, key: str, name: str, aliases: str, vocabulary: list[tuple[str, str]]) -> DataFrame:
    """One row per distinct text of each record and matching entry: its consistent form and how it was found.

    Columns ``key, text, canonical, term_id, how``; ``how`` is ``exact`` (the text is a vocabulary entry),
    ``look_alike`` (it only looks like one) or ``table`` (no entry, rewritten by the table, ``term_id`` null).
    """
    trie = records.sparkSession.sparkContext.broadcast(Trie(vocabulary))

    @F.pandas_udf("array<struct<canonical:string,term_id:string,how:string>>")
    def matched(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = trie.value

        @lru_cache(maxsize=100_000)
        def of(text: str) -> list[dict]:
            how = "exact" if text in t.words else "look_alike"
            hits = [(e, o) for c, e, o in t.walk(text)]
            if how == "exact":
                hits = [(e, o) for e, o in hits if e == text]
            return [{"canonical": e, "term_id": o, "how": how} for e, o in hits] or [{"canonical": by_table(text), "term_id": None, "how": "table"}]

        for texts in parts:
            yield texts.map(of)

    texts = F.array_compact(F.concat(F.array(name), F.coalesce(F.col(aliases), F.array().cast("array<string>"))))
    rows = records.select(F.col(key).alias("key"), F.explode(F.array_distinct(texts)).alias("text")).distinct()
    return rows.withColumn("m", F.explode(matched("text"))).select("key", "text", "m.*")
