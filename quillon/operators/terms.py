"""Term discovery and dictionary annotation."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quillon.functions.text import let

#: Bound on a dictionary that is sent to every task.
MAX_WORDS = 200_000


def phrases(tokens: Column, most: int) -> Column:
    """All runs of 1 to ``most`` neighbouring tokens, joined by a blank."""

    def of(t: Column, n: int) -> Column:
        places = F.sequence(F.lit(1), F.size(t) - n + 1)
        run = lambda i: F.concat_ws(" ", *[F.element_at(t, i + k) for k in range(n)])
        return F.when(F.size(t) >= n, F.transform(places, run)).otherwise(F.array().cast("array<string>"))

    return let(tokens, lambda t: F.concat(*[of(t, n) for n in range(1, most + 1)]))


def candidate_terms(docs: DataFrame, most: int, least_docs: int) -> DataFrame:
    """``term, n, n_docs``: phrases of words of at least three letters that stand in ``least_docs`` texts or more.

    ``docs`` has ``id, text``. Counts are made per text first, so a long text sends each phrase once.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    per = docs.filter("text is not null").select("id", F.explode(phrases(words, most)).alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= least_docs)


def annotate(texts: DataFrame, words: DataFrame, most: int = MAX_WORDS) -> DataFrame:
    """``id, word, start``: every place (from 0) where a dictionary word stands as a whole word, overlapping ones included.

    ``texts``: ``id, text``; ``words``: ``word``, a dictionary of at most ``most`` words (a larger one is refused). The
    texts pass an automaton of all words once, in Arrow batches, so the work does not grow with the dictionary. Null texts
    have no places, null and empty words stand nowhere, repeated words count once.
    """
    known = [r.word for r in words.filter("word <> ''").select("word").distinct().limit(most + 1).collect()]
    if len(known) > most:
        raise ValueError(f"more than {most} words: not a dictionary")
    kind = texts.schema["id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        trie = ahocorasick.Automaton()
        for w in known:
            trie.add_word(w, w)
        trie.make_automaton()
        inside = re.compile(r"[A-Za-z0-9_]").match
        for p in parts:
            rows = []
            for key, text in zip(p["id"], p["text"]):
                for last, w in trie.iter(text):
                    at = last - len(w) + 1
                    if not (at and inside(text[at - 1])) and not (last + 1 < len(text) and inside(text[last + 1])):
                        rows.append((key, w, at))
            yield pd.DataFrame(rows, columns=["id", "word", "start"])

    schema = f"id {kind}, word string, start int"
    if not known:
        return texts.sparkSession.createDataFrame([], schema)
    return texts.filter("text is not null").select("id", "text").mapInPandas(run, schema)
