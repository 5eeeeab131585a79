"""Mapping freely typed values to a canonical list.

Each distinct value is cut into tokens; each distinct token is repaired by a join with the reference vocabulary on
edit distance (shared deletion neighbourhoods, then an exact check); the repaired tokens rank the entries by soft
TF-IDF. Values below the threshold are reported as unmatched.

Semantics of :func:`map_values`
-------------------------------
* Full-width forms, look-alike letters, case and accents are folded; a unit at the end of a value is left out; dots
  between single letters are dropped (``A.B.C.`` is ``abc``); ``word.`` may stand for a longer word.
* A token of five or more letters is repaired within one edit or one swap of neighbours; shorter tokens and tokens with
  digits or signs must be exact. A value without its spaces, or with misplaced ones, is compared as a whole.
* Words in ``neutral`` weigh little unless the entry has them. Any other word that no entry explains counts against it.
* Null, empty and word-less values are unmatched. Of entries with the same score the smallest key is taken.

Scale: all work is on distinct values and distinct tokens; no pair of a value and an entry is formed without a shared
token. The reference list is a dictionary of at most ``MAX_ENTRIES`` texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quillon.functions.units import readings
from quillon.llm.lookalike import by_table
from quillon.operators.joins import lookup_join
from quillon.operators.quantities import NAME_TAILS
from quillon.session import broadcast_if_small, checkpointed

MAX_ENTRIES = 100_000
#: Soft TF-IDF from which a value counts as an entry.
THRESHOLD = 0.78
# Words on a report line that name the specimen or the occasion, not the quantity.
NEUTRAL = ("serum", "plasma", "blood", "venous", "capillary", "arterial", "fasting", "repeat", "repeated", "s", "p", "b")
_NEUTRAL_WEIGHT = 0.3
_DOTTED = re.compile(r"\b(?:[^\W\d_]\.){2,}(?:[^\W\d_]\b)?")
_TOKEN = re.compile(r"([^\W_]+[#%]?)(\.?)")


def folded(text: str) -> str:
    """One form for comparison: glyph classes, lower case, no accents."""
    low = unicodedata.normalize("NFD", by_table(text).casefold())
    return "".join(c for c in low if not unicodedata.combining(c))


def tokens_of(text: str) -> list[tuple[str, bool]]:
    """``(token, whether a dot follows)``; a unit at the end is left out."""
    for tail in NAME_TAILS:
        if (m := tail.search(text)) and readings(m[1].strip()):
            text = text[: m.start()]
    text = _DOTTED.sub(lambda m: m[0].replace(".", ""), folded(text))
    return [(m[1], bool(m[2])) for m in _TOKEN.finditer(text)]


def _deletions(t: Column) -> Column:
    """The text itself and every text with one character less."""
    return F.array_distinct(F.concat(F.array(t), F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))))


def _repairable(t: Column) -> Column:
    return (F.length(t) >= 5) & ~t.rlike("[0-9#%]") | (F.length(t) >= 4) & t.rlike("^[㐀-鿿]+$")


def repaired(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(t, dot, v, sim)``: the vocabulary words that each distinct token may stand for.

    ``tokens`` has ``t, dot``; ``vocabulary`` has distinct ``v``. A token that is a word of the vocabulary is not repaired,
    but with a dot it may still be cut from a longer word.
    """
    exact = tokens.join(vocabulary, F.col("t") == F.col("v"), "left")
    known = exact.filter("v is not null").select("t", "dot", "v", F.lit(1.0).alias("sim"))
    other = exact.filter("v is null").drop("v")
    left = other.filter(_repairable(F.col("t"))).select("t", "dot", F.explode(_deletions(F.col("t"))).alias("key"))
    right = vocabulary.filter(_repairable(F.col("v"))).select("v", F.explode(_deletions(F.col("v"))).alias("key"))
    d = F.levenshtein("t", "v")
    sorted_ = lambda c: F.array_sort(F.split(c, ""))
    swap = (d == 2) & (F.length("t") == F.length("v")) & (sorted_("t") == sorted_("v"))
    edited = left.join(right, "key").select("t", "dot", "v").distinct().filter((d <= 1) | swap)
    edited = edited.select("t", "dot", "v", (1 - F.lit(0.5) / F.length("v")).alias("sim"))
    starts = vocabulary.select("v", F.explode(F.transform(F.sequence(F.lit(3), F.greatest(F.lit(3), F.length("v") - 1)), lambda i: F.substring("v", F.lit(1), i))).alias("start"))
    cut = tokens.filter("dot and length(t) >= 3").join(starts, F.col("t") == F.col("start")).filter("t <> v").select("t", "dot", "v", F.lit(0.95).alias("sim"))
    return known.unionAll(edited).unionAll(cut).groupBy("t", "dot", "v").agg(F.max("sim").alias("sim"))


def _values(values: DataFrame, neutral: tuple[str, ...]) -> DataFrame:
    """Distinct non-null values with their tokens and their two whole forms."""

    @F.pandas_udf("struct<tokens:array<struct<t:string,dot:boolean>>,whole:array<string>>")
    def parsed(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for text in p:
                toks = tokens_of(text)
                wholes = {"".join(t for t, _ in toks), "".join(t for t, _ in toks if t not in neutral)} - {""}
                out.append(([{"t": t, "dot": d} for t, d in toks], sorted(wholes)))
            yield pd.DataFrame(out, columns=["tokens", "whole"])

    return values.select("value").filter("value is not null").distinct().withColumn("_p", parsed("value")).select("value", "_p.*")


def map_values(values: DataFrame, entries: list[tuple[str, str]], threshold: float = THRESHOLD, neutral: tuple[str, ...] = NEUTRAL) -> DataFrame:
    """``value, key, score`` for every distinct non-null ``value``; ``key`` is null where nothing reaches the threshold.

    ``entries`` are ``(text, key)`` pairs of the reference list.
    """
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} reference texts")
    spark = values.sparkSession
    texts = [(k, i, [t for t, _ in tokens_of(x)]) for i, (x, k) in enumerate(entries)]
    texts = [(k, i, toks) for k, i, toks in texts if toks]
    df = Counter(t for _, _, toks in texts for t in set(toks))
    idf2 = {t: math.log(1 + len(texts) / n) ** 2 for t, n in df.items()}
    unknown = math.log(1 + max(1, len(texts))) ** 2
    per_entry = spark.createDataFrame(
        [(k, i, t, idf2[t], sum(idf2[x] for x in set(toks))) for k, i, toks in texts for t in sorted(set(toks))],
        "key string, entry int, v string, idf2 double, norm2 double",
    )
    wholes = spark.createDataFrame(sorted({("".join(toks), k) for k, _, toks in texts}), "v string, key string")
    parsed = checkpointed(_values(values, neutral))
    tokens = parsed.select("value", F.posexplode("tokens").alias("pos", "_t")).select("value", "pos", "_t.t", "_t.dot")
    repair = checkpointed(repaired(tokens.select("t", "dot").distinct(), per_entry.select("v").distinct()))
    # weight of a token that the entry does not explain
    weight = F.when(F.col("t").isin(*neutral), _NEUTRAL_WEIGHT).otherwise(F.lit(unknown))
    total = tokens.groupBy("value").agg(F.sum(weight).alias("all2"))
    hits = lookup_join(tokens, repair.groupBy("t", "dot").agg(F.collect_list(F.struct("v", "sim")).alias("_v")).withColumnsRenamed({"t": "_kt", "dot": "_kd"}), ["t", "dot"], ["_kt", "_kd"], "inner")
    hits = hits.select("value", "pos", "t", F.inline("_v")).join(broadcast_if_small(per_entry, MAX_ENTRIES), "v")
    by_pos = hits.groupBy("value", "key", "pos").agg(F.max(F.struct((F.col("idf2") * F.col("sim")).alias("got"), "idf2", weight.alias("w"))).alias("b"))
    by_name = by_pos.groupBy("value", "key").agg(F.sum("b.got").alias("got2"), F.sum(F.col("b.idf2") - F.col("b.w")).alias("more2"))
    by_word = hits.groupBy("value", "key", "entry", "v").agg(F.max(F.col("idf2") * F.col("sim")).alias("got"), F.max("norm2").alias("norm2"))
    by_entry = by_word.groupBy("value", "key", "entry").agg((F.sum("got") / F.max("norm2")).alias("cover")).groupBy("value", "key").agg(F.max("cover").alias("cover"))
    soft = by_name.join(by_entry, ["value", "key"]).join(total, "value").select("value", "key", F.sqrt(F.col("got2") / (F.col("all2") + F.col("more2")) * F.col("cover")).alias("score"))
    whole = parsed.select("value", F.explode("whole").alias("t")).withColumn("dot", F.lit(False))
    fixed = repaired(whole.select("t", "dot").distinct(), wholes.select("v").distinct()).join(broadcast_if_small(wholes, MAX_ENTRIES), "v")
    as_whole = whole.join(fixed, "t").select("value", "key", F.col("sim").alias("score"))
    ranked = soft.unionAll(as_whole).groupBy("value", "key").agg(F.max("score").alias("score"))
    best = ranked.groupBy("value").agg(F.max(F.struct(F.round("score", 9).alias("score"), F.transform(F.split("key", ""), lambda c: -F.ascii(c)).alias("o"), "key")).alias("b"))
    return parsed.select("value").join(best, "value", "left").select("value", F.when(F.col("b.score") >= threshold, F.col("b.key")).alias("key"), F.col("b.score").alias("score"))
