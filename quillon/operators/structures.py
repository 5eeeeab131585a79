"""Structure around mentions: clauses with a cue, smallest shared lines, first lines of evidence, best matches, lost edges.

Null texts and keys have no structure and match nothing; repeated rows count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: What ends a clause.
CLAUSE_END = "[。！？；\n]|</td>"


def clauses(texts: DataFrame, end: str = CLAUSE_END) -> DataFrame:
    """``id, clause_no, clause``: the clauses of each text (``id, text``) in order, counted from 0, empty ones included."""
    return texts.filter("text is not null").select("id", F.posexplode_outer(F.split("text", end)).alias("clause_no", "clause"))


def cue_pairs(mentions: DataFrame, cues: DataFrame, key: list[str]) -> DataFrame:
    """``*key, a, b, opposite``: pairs ``a < b`` of different words in a clause with a cue, and whether a cue parts them.

    ``mentions``: ``*key, word, start, end``; ``cues``: ``*key, start, end``. Per clause only the first end and the last start
    of a word matter on either side of a cue, so words are brought down to one row each before they meet: no more pairs are
    made than a clause has different words.
    """
    words = mentions.groupBy(*key, "word").agg(F.min("end").alias("first_end"), F.max("start").alias("last_start"))
    per = words.groupBy(*key).agg(F.collect_list(F.struct("word", "first_end", "last_start")).alias("ws")).filter("size(ws) > 1")
    both = per.join(cues.groupBy(*key).agg(F.collect_list(F.struct(F.col("start").alias("s"), F.col("end").alias("e"))).alias("cs")), key)
    pairs = F.flatten(F.transform("ws", lambda a: F.transform(F.filter("ws", lambda b: a["word"] < b["word"]), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    rows = both.select(*key, "cs", F.explode(pairs).alias("p"))
    apart = lambda x, y: F.exists("cs", lambda c: (F.col(x)["first_end"] <= c["s"]) & (F.col(y)["last_start"] >= c["e"]))
    return rows.select(*key, F.col("p.a.word").alias("a"), F.col("p.b.word").alias("b"), (apart("p.a", "p.b") | apart("p.b", "p.a")).alias("opposite"))


def smallest_shared(mentions: DataFrame, units: DataFrame) -> DataFrame:
    """``id, a, b, unit_start, unit_end``: for each pair ``a < b`` of words the smallest unit of a text that holds both.

    ``mentions``: ``id, word, start, end``; ``units``: ``id, u_start, u_end`` (lines, rows: disjoint). Of equal lengths the
    first unit is taken. A unit is brought down to its different words before pairs are made.
    """
    inside = mentions.join(units, "id").filter("start >= u_start and end <= u_end")
    words = inside.groupBy("id", "u_start", "u_end").agg(F.collect_set("word").alias("ws")).filter("size(ws) > 1")
    pairs = F.flatten(F.transform("ws", lambda a: F.transform(F.filter("ws", lambda b: a < b), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    rows = words.select("id", "u_start", "u_end", F.explode(pairs).alias("p"))
    best = rows.groupBy("id", "p.a", "p.b").agg(F.min(F.struct((F.col("u_end") - F.col("u_start")).alias("n"), "u_start", "u_end")).alias("u"))
    return best.select("id", "a", "b", F.col("u.u_start").alias("unit_start"), F.col("u.u_end").alias("unit_end"))


def best_ranks(matches: DataFrame, key: str) -> DataFrame:
    """The rows of ``matches`` (``key, node_id, rank``) with the best rank of their key, each node once."""
    one = matches.dropna(subset=[key, "node_id"]).groupBy(key, "node_id").agg(F.min("rank").alias("rank"))
    return one.join(one.groupBy(key).agg(F.min("rank").alias("rank")), [key, "rank"]).select(key, "node_id", "rank")


def missing_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``triple_id, side, node_id``: endpoints of edges that are no node; null endpoints included."""
    ends = edges.select("triple_id", F.explode(F.array(F.struct(F.lit("subject").alias("side"), F.col("subject_id").alias("node_id")), F.struct(F.lit("object").alias("side"), F.col("object_id").alias("node_id")))).alias("x")).select("triple_id", "x.*").distinct()
    return ends.join(nodes.select("node_id").distinct(), "node_id", "left_anti").select("triple_id", "side", "node_id")


def superseded(old: DataFrame, new: DataFrame, places: DataFrame) -> DataFrame:
    """``triple_id, reason``: old edges without a new edge of the same triple.

    ``old`` has ``triple_id`` and, like ``new``, ``subject_id, predicate, object_id``; ``places``: ``node_id, place``. The
    reason is ``cross_place`` where the ends lie in different places, ``dangling`` where one has none, else ``not_recovered``.
    """
    triple = ["subject_id", "predicate", "object_id"]
    lost = old.select("triple_id", *triple).distinct().join(new.select(*triple).distinct(), triple, "left_anti")
    side = lambda c: places.groupBy(F.col("node_id").alias(f"{c}_id")).agg(F.min("place").alias(f"_{c}"))
    lost = lost.join(side("subject"), "subject_id", "left").join(side("object"), "object_id", "left")
    return lost.select("triple_id", F.when(F.col("_subject").isNull() | F.col("_object").isNull(), "dangling").when(F.col("_subject") != F.col("_object"), "cross_place").otherwise("not_recovered").alias("reason"))


def json_strings(rows: DataFrame, key: str, json: str, most_depth: int = 16) -> DataFrame:
    """``key, path, text``: every string in a JSON column with its path (members and places from 0, joined by dots).

    A JSON text that is a string itself has the empty path. Null and malformed texts have no strings. Nesting beyond
    ``most_depth`` is refused.
    """
    level = rows.select(key, F.lit("").alias("path"), F.try_parse_json(json).alias("v")).filter("v is not null")
    out = None
    for _ in range(most_depth):
        kind = F.schema_of_variant("v")
        strings = level.filter(kind == "STRING").select(key, "path", F.col("v").cast("string").alias("text"))
        out = strings if out is None else out.unionAll(strings)
        deep = level.filter(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        child = rows.sparkSession.tvf.variant_explode(F.col("v").outer())
        level = deep.lateralJoin(child.select(F.col("pos"), F.col("key").alias("_k"), F.col("value").alias("_v"))).select(key, F.concat_ws(".", F.nullif("path", F.lit("")), F.coalesce("_k", F.col("pos").cast("string"))).alias("path"), F.col("_v").alias("v"))
        if level.isEmpty():
            return out
    raise ValueError(f"JSON nested deeper than {most_depth}")
