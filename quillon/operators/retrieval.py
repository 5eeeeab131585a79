"""Ranked retrieval: lexical, vector, record and graph channels, their fusion and expansion.

Query terms are a short list of constants, so each channel is one scan with partial aggregation for the corpus figures
and one scan that ends in a top-k; nothing is joined with the query.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillon.functions.text import distinct_tokens, fold_lower, grams, query_terms

MAX_QUERY, MAX_K = 400, 20


def guard(query: str, top_k: int) -> None:
    """Refuse queries beyond the limits of the search surface."""
    if not isinstance(query, str) or not 0 < len(query.strip()) <= MAX_QUERY:
        raise ValueError("a query has 1 to 400 characters")
    if isinstance(top_k, bool) or not isinstance(top_k, int) or not 1 <= top_k <= MAX_K:
        raise ValueError("top_k is between 1 and 20")


def _total(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols, F.lit(0.0))


def lexical_search(chunks: DataFrame, query: str, top_k: int = 5) -> DataFrame:
    """``chunk_id, score``: inverse document frequencies of the terms that stand in the folded text, plus 1 for the phrase.

    ``chunks`` has ``chunk_id, text`` with one row per chunk. Ties are ranked by ``chunk_id``; no hit gives no rows.
    """
    guard(query, top_k)
    terms = query_terms(query)
    folded = chunks.select("chunk_id", fold_lower(F.col("text")).alias("t"))
    has = [F.col("t").contains(x) for x in terms]
    seen = folded.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(h, 1)).alias(f"d{i}") for i, h in enumerate(has)]).first()
    idf = [math.log((seen.n + 1) / (seen[f"d{i}"] + 1)) + 1 for i in range(len(terms))]
    score = _total([F.when(h, x).otherwise(0.0) for h, x in zip(has, idf)]) + F.when(F.col("t").contains(query.lower().strip()), 1.0).otherwise(0.0)
    return folded.select("chunk_id", F.round(score, 6).alias("score")).filter("score > 0").orderBy(F.desc("score"), "chunk_id").limit(top_k)


def expand_neighbours(hits: DataFrame, chunks: DataFrame, top_k: int) -> DataFrame:
    """Fill ``hits`` (``chunk_id, score``) up to ``top_k`` with the chunks before and after, in the order of the hits.

    ``chunks`` has ``chunk_id, page_id`` and the order ``s`` on the page. Result ``chunk_id, score, reason``.
    """
    order = W.partitionBy("page_id").orderBy("s", "chunk_id")
    near = chunks.select("chunk_id", F.lag("chunk_id").over(order).alias("before"), F.lead("chunk_id").over(order).alias("after"))
    ranked = hits.withColumn("rank", F.row_number().over(W.partitionBy().orderBy(F.desc("score"), "chunk_id")))  # at most top_k rows
    around = near.join(F.broadcast(ranked), "chunk_id").select("rank", F.posexplode(F.array("before", "after")).alias("side", "chunk_id")).filter("chunk_id is not null")
    extra = around.join(F.broadcast(hits.select("chunk_id")), "chunk_id", "left_anti").groupBy("chunk_id").agg(F.min(F.struct("rank", "side")).alias("o"))
    both = ranked.select("chunk_id", "score", F.lit("hit").alias("reason"), F.struct(F.lit(0).alias("a"), F.col("rank").alias("b"), F.lit(0).alias("c")).alias("o"))
    both = both.unionByName(extra.select("chunk_id", F.lit(0.0).alias("score"), F.lit("neighbour").alias("reason"), F.struct(F.lit(1).alias("a"), F.col("o.rank").alias("b"), F.col("o.side").alias("c")).alias("o")))
    return both.orderBy("o").limit(top_k).select("chunk_id", "score", "reason")


def tfidf_weights(docs: DataFrame, low: int = 2, high: int = 3) -> DataFrame:
    """``id, gram, weight, norm``: character n-gram counts times ``ln((N+1)/(df+1))+1``, with the length of the vector.

    ``docs`` has ``id, text``. Texts without a gram have no rows.
    """
    n = docs.count()
    counts = docs.select("id", F.explode(grams(fold_lower(F.col("text")), low, high)).alias("gram")).groupBy("id", "gram").agg(F.count(F.lit(1)).alias("tf"))
    df = counts.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    w = counts.join(df, "gram").select("id", "gram", (F.col("tf") * (F.log((n + 1) / (F.col("df") + 1)) + 1)).alias("weight"))
    return w.withColumn("norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy("id"))))


def cosine_search(docs: DataFrame, query: str, top_k: int = 5, threshold: float = 0.12, low: int = 2, high: int = 3) -> DataFrame:
    """``id, score`` of the nearest texts by the cosine of their n-gram vectors; grams unknown to the corpus are left out."""
    guard(query, top_k)
    spark = docs.sparkSession
    q = spark.createDataFrame([(query,)], "text string").select(F.explode(grams(fold_lower(F.col("text")), low, high)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("qtf"))
    n = docs.count()
    counts = docs.select("id", F.explode(grams(fold_lower(F.col("text")), low, high)).alias("gram")).groupBy("id", "gram").agg(F.count(F.lit(1)).alias("tf"))
    df = counts.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1
    qv = df.join(F.broadcast(q), "gram").select("gram", (F.col("qtf") * idf).alias("qw"))  # at most the grams of 400 characters
    qn = math.sqrt(qv.agg(F.sum(F.col("qw") * F.col("qw"))).first()[0] or 0.0)
    if qn == 0:
        return docs.select("id", F.lit(0.0).alias("score")).limit(0)
    w = counts.join(df, "gram").select("id", "gram", (F.col("tf") * idf).alias("w"))
    dot = w.join(F.broadcast(qv), "gram", "left").groupBy("id").agg(F.sum(F.col("w") * F.coalesce("qw", F.lit(0.0))).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    return dot.select("id", F.round(F.col("dot") / (F.col("n") * qn), 6).alias("score")).filter(F.col("score") >= threshold).orderBy(F.desc("score"), "id").limit(top_k)


def bm25(records: DataFrame, query: str) -> DataFrame:
    """``record_id, bm25`` with distinct tokens; the corpus figures use the text as it is written, the record is folded.

    ``records`` has ``record_id, body``. A written upper-case letter separates tokens in the corpus figures.
    """
    terms = [t for t in sorted(set(query_terms(query)))]
    written = distinct_tokens(F.col("body"))
    seen = records.agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.lit(1), F.size(written))).alias("len"), *[F.count(F.when(F.array_contains(written, t), 1)).alias(f"d{i}") for i, t in enumerate(terms)]).first()
    average = (seen.len or 0) / max(1, seen.n)
    own = records.select("record_id", distinct_tokens(fold_lower(F.col("body"))).alias("k"))
    idf = [math.log(1 + (seen.n - seen[f"d{i}"] + 0.5) / (seen[f"d{i}"] + 0.5)) for i in range(len(terms))]
    gain = F.lit(2.0) / (1 + 1.2 * (0.25 + 0.75 * F.size("k") / (average or 1.0)))
    score = _total([F.when(F.array_contains("k", t), x).otherwise(0.0) for t, x in zip(terms, idf)]) * gain
    return own.select("record_id", F.round(score, 6).alias("bm25"))


def record_search(records: DataFrame, query: str, top_k: int = 5, rule_types: list[str] | None = None, required: list[str] | None = None) -> DataFrame:
    """``record_id, score``: exact name 100, alias 80, phrase in the title 30, type 8, conditions 8, and the token score.

    ``records``: ``record_id, standard_name, title, body, rule_type, conditions, aliases, parent_id``. Rows with a parent
    are context and never hits; a hit needs the exact name, an alias, the title phrase or a token.
    """
    q = query.lower().strip()
    fold = lambda c: fold_lower(F.coalesce(F.col(c), F.lit("")))
    types = [t.lower() for t in rule_types or []]
    needs = F.array(*[F.lit(c.lower()) for c in required]) if required else None
    scored = records.join(bm25(records.select("record_id", "body"), query), "record_id").filter("parent_id is null")
    if types:
        scored = scored.filter(fold("rule_type").isin(types))
    if needs is not None:
        scored = scored.filter(F.size(F.array_except(needs, F.transform(F.coalesce("conditions", F.array().cast("array<string>")), fold_lower))) == 0)
    exact = (fold("standard_name") == q) | (fold("title") == q)
    alias = F.exists(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: fold_lower(a) == q)
    phrase = fold("title").contains(q) & (fold("title") != q)
    points = F.when(exact, 100.0).otherwise(0.0) + F.when(alias, 80.0).otherwise(0.0) + F.when(phrase, 30.0).otherwise(0.0) + F.lit(8.0 if types else 0.0) + F.lit(8.0 if required else 0.0)
    hits = scored.filter(exact | alias | phrase | (F.col("bm25") > 0)).select("record_id", F.round(points + F.col("bm25"), 6).alias("score"))
    return hits.orderBy(F.desc("score"), "record_id").limit(top_k)


def fuse(lexical: DataFrame, graph: DataFrame, top_k: int) -> DataFrame:
    """Full outer fusion of two channels (``chunk_id, score``): lexical score plus twice the graph score."""
    both = lexical.select("chunk_id", F.col("score").alias("lex")).join(graph.select("chunk_id", F.col("score").alias("gr")), "chunk_id", "full_outer")
    total = F.round(F.coalesce("lex", F.lit(0.0)) + 2 * F.coalesce("gr", F.lit(0.0)), 6)
    reason = F.concat_ws("+", F.when(F.col("lex").isNotNull(), "lexical"), F.when(F.col("gr").isNotNull(), "graph"))
    return both.select("chunk_id", total.alias("score"), reason.alias("reason")).orderBy(F.desc("score"), "chunk_id").limit(top_k)
