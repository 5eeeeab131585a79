"""Property graph as two DataFrames: adjacency, bounded search, components, constraints, merges, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillon.operators.joins import lookup_join
from quillon.session import checkpointed


def adjacency(edges: DataFrame) -> DataFrame:
    """``src, relation, dst, triple_id, forward``: every edge in both directions. Edges with a null end are left out."""
    e = edges.filter("subject_id is not null and object_id is not null")
    there = e.select(F.col("subject_id").alias("src"), F.col("predicate").alias("relation"), F.col("object_id").alias("dst"), "triple_id", F.lit(True).alias("forward"))
    back = e.select(F.col("object_id").alias("src"), F.col("predicate").alias("relation"), F.col("subject_id").alias("dst"), "triple_id", F.lit(False).alias("forward"))
    return there.unionByName(back)


def bounded_search(starts: DataFrame, near: DataFrame, hops: int = 3) -> DataFrame:
    """``start, node, hops, via``: every node within ``hops`` steps, reached once, by its first discovered path.

    ``starts`` has ``start``; ``near`` comes from :func:`adjacency`. Of the parents of a node the one discovered first
    wins, then the smallest relation; nodes of one step are discovered in the order (parent, node). ``via`` is the path.
    The frontier is cut to new nodes before the next step, so a step costs one join with the adjacency.
    """
    pairs = near.select("src", "dst", "relation").groupBy("src", "dst").agg(F.min("relation").alias("relation"))
    seen = starts.select("start", F.col("start").alias("node"), F.lit(0).alias("hops"), F.array("start").alias("via"), F.array(F.lit("")).alias("order")).distinct()
    frontier = seen
    for step in range(1, hops + 1):
        stepped = frontier.withColumnRenamed("node", "_n").join(pairs, F.col("_n") == F.col("src"))
        # the discovery order of a path is the path of (node) keys: parents earlier in the queue have smaller keys
        cand = stepped.select("start", F.col("dst").alias("node"), F.concat("via", F.array("dst")).alias("via"), F.concat("order", F.array("dst")).alias("order"), "relation")
        fresh = cand.join(seen.select("start", "node"), ["start", "node"], "left_anti")
        first = fresh.groupBy("start", "node").agg(F.min(F.struct("order", "relation", "via")).alias("b"))
        frontier = checkpointed(first.select("start", "node", F.lit(step).alias("hops"), F.col("b.via").alias("via"), F.col("b.order").alias("order")))
        seen = seen.unionByName(frontier)
    return seen.select("start", "node", "hops", F.concat_ws(">", "via").alias("via"), F.round(1 / (1 + F.col("hops")), 6).alias("score"))


def components(nodes: DataFrame, links: DataFrame, rounds: int = 40) -> DataFrame:
    """``node, component``: the smallest node of each connected component.

    ``nodes`` has ``node``, ``links`` has ``a, b``. Each round alternates large-star and small-star steps, so the number
    of rounds grows with the logarithm of the diameter and a hub's links are re-hung rather than multiplied. Links that
    are not merged after ``rounds`` are an error.
    """
    e = checkpointed(links.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour hangs on the smallest neighbour
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "_u")
        large = lookup_join(both, least, ["u"], ["_u"], "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour, and the node, hang on the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        small = lookup_join(large, least, ["u"], ["_u"], "inner").select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")), F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("p"))
        new = checkpointed(small.select(F.col("p.x").alias("u"), F.col("p.y").alias("v")).filter("u <> v").distinct())
        changed = new.exceptAll(e).limit(1).count() + e.exceptAll(new).limit(1).count()
        e = new
        if not changed:
            break
    else:
        raise RuntimeError(f"components not merged after {rounds} rounds")
    return nodes.select("node").distinct().join(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("c")), "node", "left").select("node", F.coalesce("c", "node").alias("component"))


def constraint_violations(nodes: DataFrame, edges: DataFrame, allowed: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``rule, key`` of every broken constraint: null or repeated keys, dangling ends, self loops, wrong end types.

    ``nodes``: ``node_id, node_type``, ``edges``: ``triple_id, subject_id, predicate, object_id``; ``allowed`` maps a
    predicate to the types of its ends.
    """
    keyed = nodes.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"), F.max("node_type").alias("t")).withColumnRenamed("node_id", "_id")
    out = keyed.filter("n > 1").select(F.lit("repeated_node").alias("rule"), F.col("_id").alias("key"))
    types = keyed.filter("_id is not null").select("_id", "t")
    s = lookup_join(edges, types.withColumnsRenamed({"_id": "_s", "t": "st"}), ["subject_id"], ["_s"])
    both = lookup_join(s, types.withColumnsRenamed({"_id": "_o", "t": "ot"}), ["object_id"], ["_o"])
    rules = [
        F.when(F.col("subject_id").isNull() | F.col("object_id").isNull(), "null_end"),
        F.when(F.col("subject_id").isNotNull() & F.col("st").isNull(), "dangling_subject"),
        F.when(F.col("object_id").isNotNull() & F.col("ot").isNull(), "dangling_object"),
        F.when(F.col("subject_id") == F.col("object_id"), "self_loop"),
    ]
    for predicate, (a, b) in (allowed or {}).items():
        wrong = (F.col("st") != a) | (F.col("ot") != b)
        rules.append(F.when((F.col("predicate") == predicate) & wrong, f"wrong_type_{predicate}"))
    return out.unionAll(both.select(F.explode(F.array_compact(F.array(*rules))).alias("rule"), F.col("triple_id").alias("key")))


def upsert(rows: DataFrame, key: list[str], order: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """Merge rows of one key: scalars from the last row by ``order`` (null counts as no value), lists as sorted unions."""
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col(order), F.col(c)))).alias(c) for c in scalars]
    union = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(F.col(c), F.array().cast("array<string>")))))).alias(c) for c in lists]
    return rows.groupBy(*key).agg(*last, *union, F.count(F.lit(1)).alias("n_rows"))


def replay_evidence(cited: DataFrame, chunks: DataFrame) -> DataFrame:
    """Status of every cited quote: ``verified``, ``moved`` (found in exactly one other chunk), ``drifted`` or ``missing``.

    ``cited``: ``key, chunk_id, chunk_sha256, exact_quote``; ``chunks``: ``chunk_id, chunk_sha256, text``.
    """
    c = chunks.select(F.col("chunk_id").alias("_c"), F.col("chunk_sha256").alias("_h"), "text")
    j = lookup_join(cited, c.dropDuplicates(["_c"]), ["chunk_id"], ["_c"])
    unique = F.coalesce((F.length("text") - F.length(F.replace("text", F.col("exact_quote"), F.lit("")))) == F.length("exact_quote"), F.lit(False))
    status = F.when(F.col("_c").isNull(), "missing").when(F.col("_h") != F.col("chunk_sha256"), "drifted").when(F.col("exact_quote").isNull() | unique, "verified").otherwise("not_unique")
    return j.select("key", "chunk_id", status.alias("status"))


def suffix_parents(names: DataFrame, least: int = 2) -> DataFrame:
    """``name, parent``: names that end with another whole name and have at least ``least`` characters before it.

    The suffixes of each name are looked up among the names, so no pair is formed without a match.
    """
    s = names.select("name", F.explode(F.transform(F.sequence(F.lit(least + 1), F.greatest(F.length("name"), F.lit(least + 1))), lambda i: F.substring("name", i, F.length("name")))).alias("parent"))
    return s.filter("parent <> ''").join(names.select(F.col("name").alias("parent")).distinct(), "parent", "left_semi").filter("parent <> name").select("name", "parent").distinct()


def counts_by(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``kind, value, n``: one histogram per named column, null values as an empty text."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(c.cast("string"), F.lit("")).alias("value")) for k, c in columns.items()])).alias("p")
    return df.select(pairs).groupBy("p.kind", "p.value").agg(F.count(F.lit(1)).alias("n"))


def strongest_per_chunk(hits: DataFrame) -> DataFrame:
    """Of the hits (``chunk_id, score, path``) of a chunk the strongest, then the smallest path."""
    w = W.partitionBy("chunk_id").orderBy(F.desc("score"), "path")
    return hits.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
