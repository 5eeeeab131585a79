"""Quotes replayed in their chunks, relations judged by their evidence, merged and redirected names, rules from ranges.

Null keys and texts match nothing and are reported where the operator reports; repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillon.functions.text import disjoint_count, overlapping_count
from quillon.operators.graph import components


def replayed_quotes(refs: DataFrame, chunks: DataFrame, overlapping: bool = False) -> DataFrame:
    """``refs`` with ``status, start``: where each quote stands in its chunk.

    ``refs`` has ``chunk_id, chunk_sha256, quote``; ``chunks``: ``chunk_id, text, sha256`` (one row a chunk). The status is
    the first that holds: ``no_chunk``, ``hash_mismatch``, ``empty_quote``, ``absent``, ``ambiguous``, ``ok``. ``overlapping``
    also counts occurrences that overlap.
    """
    rows = refs.join(chunks.select(F.col("chunk_id"), F.col("text").alias("_text"), F.col("sha256").alias("_sha")), "chunk_id", "left")
    count = (overlapping_count if overlapping else disjoint_count)(F.col("_text"), F.col("quote"))
    empty = F.coalesce(F.col("quote"), F.lit("")) == ""
    status = (
        F.when(F.col("_text").isNull(), "no_chunk")
        .when(~F.col("chunk_sha256").eqNullSafe(F.col("_sha")), "hash_mismatch")
        .when(empty, "empty_quote")
        .when(~F.contains("_text", F.col("quote")), "absent")
        .when(count > 1, "ambiguous")
        .otherwise("ok")
    )
    rows = rows.withColumn("status", status)
    return rows.withColumn("start", F.when(F.col("status") == "ok", F.instr("_text", F.col("quote")) - 1)).drop("_text", "_sha")


def within_quote(quote: Column, start: Column, text: Column) -> Column:
    """The place in the chunk of a text that stands exactly once in its quote, else null."""
    return F.when((text != "") & F.contains(quote, text) & (overlapping_count(quote, text) == 1), start + F.instr(quote, text) - 1)


def judged_relations(relations: DataFrame, nodes: DataFrame, allowed: DataFrame) -> DataFrame:
    """``triple_id, verdict``: what becomes of each candidate relation.

    ``relations``: ``triple_id, subject_id, predicate, object_id, quotes`` (array, null for none); ``nodes``: ``node_id,
    node_type, name``; ``allowed``: ``predicate, s_type, o_type``. The verdict is the first that holds: ``no_endpoint``,
    ``duplicate`` (another relation of the same ends and predicate has a smaller id), ``type_not_allowed``, ``no_evidence``,
    ``partial`` (no quote names both ends), ``valid``.
    """
    side = lambda c: nodes.select(F.col("node_id").alias(f"{c}_id"), F.col("node_type").alias(f"{c[0]}_type"), F.col("name").alias(f"{c[0]}_name"))
    triple = ["subject_id", "predicate", "object_id"]
    first = relations.groupBy(*triple).agg(F.min("triple_id").alias("first"))
    fits = allowed.select("predicate", "s_type", "o_type").distinct().withColumn("fits", F.lit(True))
    rows = relations.join(side("subject"), "subject_id", "left").join(side("object"), "object_id", "left").join(first, triple, "left").join(fits, ["predicate", "s_type", "o_type"], "left")
    both = F.exists("quotes", lambda q: F.contains(q, F.col("s_name")) & F.contains(q, F.col("o_name")))
    verdict = (
        F.when(F.col("s_name").isNull() | F.col("o_name").isNull(), "no_endpoint")
        .when(F.col("triple_id") != F.col("first"), "duplicate")
        .when(F.col("fits").isNull(), "type_not_allowed")
        .when(F.coalesce(F.size("quotes"), F.lit(0)) <= 0, "no_evidence")
        .when(~F.coalesce(both, F.lit(False)), "partial")
        .otherwise("valid")
    )
    return rows.select("triple_id", verdict.alias("verdict"))


def merged_names(names: DataFrame) -> DataFrame:
    """``id, component, canonical``: entries that share a normal form, directly or through others, with one name for all.

    ``names``: ``id, name, key`` (``key`` the normal form; empty ones join nothing). The canonical name of a component is its
    longest name with an ideograph, of equal ones the largest; without such names the largest of all. ``component`` is the
    smallest id.
    """
    # keys sort behind all ids, so that the smallest node of a component is an id
    links = names.filter("key <> ''").select(F.col("id").alias("a"), F.concat(F.lit("\uffff"), "key").alias("b")).dropna().distinct()
    comp = components(names.select(F.col("id").alias("node")), links)
    rows = names.select("id", "name").join(comp.select(F.col("node").alias("id"), "component"), "id")
    han = F.col("name").rlike("[㐀-鿿]")
    best = rows.groupBy("component").agg(F.max(F.struct(han.alias("han"), F.when(han, F.length("name")).otherwise(0).alias("n"), "name")).alias("b"))
    return rows.select("id", "component").distinct().join(best, "component").select("id", "component", F.col("b.name").alias("canonical"))


def redirected(groups: DataFrame) -> DataFrame:
    """``id, to``: groups whose own key is an alias of another group, which they are folded into.

    ``groups``: ``id, key, alias_keys`` (array). One pass, not followed further; of several targets the smallest id; a group
    is never folded into itself.
    """
    alias = groups.select(F.col("id").alias("to"), F.explode(F.array_distinct("alias_keys")).alias("key")).filter("key <> ''")
    return groups.select("id", "key").join(alias, "key").filter("id <> to").groupBy("id").agg(F.min("to").alias("to"))


def range_graph(ranges: DataFrame) -> DataFrame:
    """``subject, predicate, object, condition``: metric and state edges, each state with the rule that gives it.

    ``ranges``: ``name, panel, unit, lower, upper``. A name with more than one range is refused with all its rows; a range
    without bounds has its metric edge only; a bound that is missing gives no state beyond it.
    """
    one = ranges.distinct().groupBy("name").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("panel", "unit", "lower", "upper")]).filter("n = 1")
    text = lambda c: F.col(c).cast("decimal(18,4)").cast("string")
    low, high = F.concat_ws(" ", F.lit("value LT"), text("lower"), "unit"), F.concat_ws(" ", F.lit("value GT"), text("upper"), "unit")
    both = F.concat_ws(" ", F.lit("value BETWEEN"), text("lower"), text("upper"), "unit")
    states = F.array_compact(F.array(*[F.when(c, F.struct(F.col("name").alias("subject"), F.lit("HAS_STATE").alias("predicate"), F.concat_ws(" ", "name", F.lit(s)).alias("object"), r.alias("condition"))) for c, s, r in (
        (F.col("lower").isNotNull(), "lowered", low), (F.col("lower").isNotNull() & F.col("upper").isNotNull(), "normal", both), (F.col("upper").isNotNull(), "raised", high),
    )]))
    metric = F.array(F.struct(F.col("panel").alias("subject"), F.lit("HAS_METRIC").alias("predicate"), F.col("name").alias("object"), F.lit(None).cast("string").alias("condition")))
    return one.select(F.explode(F.concat(metric, states)).alias("x")).select("x.*")


def indexed_places(claims: DataFrame, places: DataFrame) -> DataFrame:
    """``claim_id, start``: where each claimed mention stands.

    ``claims``: ``claim_id, id, word, claimed, nth`` (a claimed offset and the number of the occurrence from 0, either may be
    null); ``places``: ``id, word, start``. A claimed offset that is an occurrence wins, else the only occurrence, else the
    ``nth``; null where none of them holds.
    """
    per = places.select("id", "word", "start").distinct().withColumn("n", F.row_number().over(W.partitionBy("id", "word").orderBy("start")) - 1)
    rows = claims.join(per, ["id", "word"], "left").groupBy("claim_id").agg(
        F.max(F.when(F.col("start") == F.col("claimed"), F.col("start"))).alias("own"), F.count("start").alias("k"), F.min("start").alias("only"), F.max(F.when(F.col("n") == F.col("nth"), F.col("start"))).alias("by_index"),
    )
    return rows.select("claim_id", F.coalesce("own", F.when(F.col("k") == 1, F.col("only")), "by_index").alias("start"))


def anchor(text: str, start: int, end: int, most: int = 32) -> tuple[int, int] | None:
    """The widest span around ``text[start:end]``, at most ``most`` characters more on either side, that stands once in the text."""
    for k in range(most, -1, -1):
        a, b = max(0, start - k), min(len(text), end + k)
        at = text.find(text[a:b])
        if at == a and text.find(text[a:b], at + 1) < 0:
            return a, b
    return None


def anchors(mentions: DataFrame, texts: DataFrame, most: int = 32) -> DataFrame:
    """``id, start, end, a_start, a_end``: mentions with the unique context that anchors them, null where there is none.

    ``mentions``: ``id, start, end``; ``texts``: ``id, text``. The context shrinks from ``most`` characters on either side until
    it stands once; overlapping occurrences count. Texts and their mentions meet in one row each, no longer than the text.
    """
    per = mentions.select("id", "start", "end").distinct().groupBy("id").agg(F.collect_list("start").alias("s"), F.collect_list("end").alias("e")).join(texts.filter("text is not null"), "id")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [(k, int(a), int(b), *(anchor(t, a, b, most) or (None, None))) for k, t, ss, ee in zip(p["id"], p["text"], p["s"], p["e"]) for a, b in zip(ss, ee)]
            yield pd.DataFrame(rows, columns=["id", "start", "end", "a_start", "a_end"]).astype({"a_start": "Int32", "a_end": "Int32"})

    kind = texts.schema["id"].dataType.simpleString()
    return per.select("id", "text", "s", "e").mapInPandas(run, f"id {kind}, start int, end int, a_start int, a_end int")


def longest_spans(spans: DataFrame) -> DataFrame:
    """``id, word, start``: of each text the longest word, the first of equal ones by place, then by word."""
    best = spans.groupBy("id").agg(F.min(F.struct((-F.length("word")).alias("n"), "start", "word")).alias("b"))
    return best.select("id", "b.word", "b.start")
