"""Subject areas of documents by label propagation over a verified similarity graph of their passages.

* Sentences, terms: every distinct sentence (lower case, digits masked) has its terms, that is its neighbouring words and,
  in ideographic text, neighbouring characters. A term tells a subject when that subject's mass in it exceeds the corpus
  by ``TELLING`` (a smoothed log-ratio against the largest possible), first by the labels, then by all sentences that speak (``WEIGHINGS``). A sentence
  speaks for the subject with the most telling terms; the strongest of them is its signature.
* Graph: the nodes are passages. Of each signature the passage with the most speaking sentences is the representative; a
  passage with the signature is a candidate neighbour of it. An edge is verified by an exact similarity: the share of the
  passage's distinct signatures that lead to the same representative, and so stand in it, is at least ``OVERLAP``. A
  passage has at most ``1 / OVERLAP`` edges, and no group is listed in pairs.
* Propagation: in each step the passages give their subject mass along the edges to the representatives and get the
  normalised mass of their representatives back, by joins. What a passage says itself hangs on it as one more neighbour
  (the dongle node of Zhu, Ghahramani and Lafferty, 2003), with weight 1 - ``NEAR``. Passages of labelled documents are
  clamped in every step: they hold no other subjects than their labels. Steps end when at most ``TOLERANCE`` of the mass
  moves; a run that does not come to rest within ``MAX_STEPS`` is refused.
* A label is trusted unless its document has passages with a subject and none of them, before clamping, is of the labelled
  one. Trusted labels are part of the result, beside further subjects that are found.

Semantics: a passage deals with the subject that holds at least half of its mass after propagation, if sentences that speak
for it make up at least 15 % of its length; so the neighbours decide where a passage speaks for several. A document has every subject whose passages make up at least ``SHARE`` of its length and every
trusted label, so none, one or several. Empty and null texts have no subject unless labelled. Labels of unknown documents,
of unknown codes and null labels are ignored, repeated ones count once. Without usable labels of two subjects nothing is
found but the labels, as no term tells subjects apart. Sentences
and terms are known by 64-bit hashes: two that collide lend each other their evidence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from quillon.llm.storage import stored
from quillon.operators.joins import hot_keys, lookup_join
from quillon.session import broadcast_if_small

SHARE, WEIGHINGS, MAX_SUBJECTS = 0.2, 2, 200
#: Share of the mass that may still move in a step that ends the propagation, and the most steps.
TOLERANCE, MAX_STEPS = 0.01, 30
#: Strength of the corpus prior in a term's mass; the strength (1 for a term of one subject only) from which a term tells;
#: the share of a sentence's strength and the strength from which it speaks for a subject.
SMOOTHING, TELLING, CERTAIN, LEAST = 0.5, 0.35, 0.6, 0.8
#: Least similarity of a passage and a representative; weight of the neighbours against what a passage says itself.
OVERLAP, NEAR = 0.25, 0.5
#: Share of its mass from which a representative passes a subject on.
FAINT = 0.05
#: Terms and representatives are sent to every task where they are counted to be at most so many, else joined by key.
MOST_SENT = 200_000


def sentences_of(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, passage, sid, size)`` of every sentence, and ``(sid, terms)`` of every distinct sentence."""
    passages = documents.filter("text is not null").select("doc_id", F.posexplode_outer(F.split("text", r"\n+")).alias("passage", "p"))
    marked = F.col("p")
    for end in (". ", "! ", "? ", "。", "！", "？"):
        marked = F.replace(marked, F.lit(end), F.lit(end.strip() + "\x01"))
    s = passages.select("doc_id", "passage", F.explode_outer(F.split(marked, "\x01")).alias("s")).filter(F.trim("s") != "")
    norm = F.trim(F.regexp_replace(F.lower("s"), "[0-9]+", "#"))
    rows = stored(s.select("doc_id", "passage", norm.alias("s"), F.length("s").alias("size")), "sentences")
    spaced = F.when(F.col("s").rlike("[㐀-鿿]"), F.regexp_replace("s", "([㐀-鿿])", " $1 ")).otherwise(F.col("s"))
    words = F.split(F.trim(spaced), r"[^\p{L}\p{M}#]+")
    distinct = rows.groupBy("s").agg(F.count(F.lit(1)).alias("n")).select(F.xxhash64("s").alias("sid"), words.alias("w"))
    pairs = F.arrays_zip("w", F.slice("w", F.lit(2), F.size("w")).alias("v"))
    terms = distinct.select("sid", F.array_distinct(F.transform(pairs, lambda x: F.xxhash64(x["w"], x["v"]))).alias("terms"))
    return rows.select("doc_id", "passage", F.xxhash64("s").alias("sid"), "size"), stored(terms, "terms")


def telling_terms(terms: DataFrame, mass: DataFrame) -> DataFrame:
    """``term, k, s``: the subject that a term tells and how strongly. ``mass``: ``sid, k, y`` of sentences."""
    by_subject = mass.groupBy("k").agg(F.sum("y").alias("y")).filter("y > 0").collect()  # a row per subject, at most MAX_SUBJECTS
    if not by_subject:
        return terms.sparkSession.createDataFrame([], "term bigint, k int, s double")
    whole = sum(r.y for r in by_subject)
    prior = F.element_at(F.create_map(*[F.lit(x) for r in by_subject for x in (r.k, r.y / whole)]), F.col("k"))
    seen = terms.join(mass, "sid").select(F.explode_outer("terms").alias("term"), "k", "y").groupBy("term", "k").agg(F.sum("y").alias("y"))
    seen = seen.withColumn("p", prior).groupBy("term").agg(F.sum("y").alias("all"), F.max(F.struct((F.col("y") / F.col("p")).alias("r"), "k", "y", "p")).alias("b"))
    s = F.log((F.col("b.y") + SMOOTHING * F.col("b.p")) / (F.col("all") + SMOOTHING) / F.col("b.p"))
    return seen.select("term", F.col("b.k").alias("k"), (s / F.nullif(-F.log("b.p"), F.lit(0.0))).alias("s")).filter(F.col("s") >= TELLING)


def speaking(terms: DataFrame, telling: DataFrame) -> DataFrame:
    """``sid, k, signature``: the subject that a distinct sentence speaks for, and its strongest term for it."""
    hits = terms.select("sid", F.explode_outer("terms").alias("term")).join(broadcast_if_small(telling, MOST_SENT), "term")
    score = hits.groupBy("sid", "k").agg(F.sum("s").alias("s"), F.max(F.struct("s", "term")).alias("b"))
    best = score.groupBy("sid").agg(F.max(F.struct("s", "k", "b")).alias("m"), F.sum("s").alias("z"))
    return best.filter((F.col("m.s") >= CERTAIN * F.col("z")) & (F.col("m.s") >= LEAST)).select("sid", F.col("m.k").alias("k"), F.col("m.b.term").alias("signature"))


def verified_edges(spoken: DataFrame) -> DataFrame:
    """``doc_id, passage, rep, w, u``: passages and their representatives; ``w`` is the similarity, ``u`` its share of the passage's edges.

    ``spoken``: ``doc_id, passage, signature`` of speaking sentences.
    """
    # by document once, then neither the groups nor the windows, none larger than a passage, move rows again
    passage = W.partitionBy("doc_id", "passage")
    counted = spoken.repartition("doc_id").groupBy("doc_id", "passage", "signature").agg(F.count(F.lit(1)).alias("c"))
    nodes = stored(counted.select("doc_id", "passage", "signature", F.count(F.lit(1)).over(passage).alias("n"), F.sum("c").over(passage).alias("c_all")), "signatures")
    rep = nodes.groupBy("signature").agg(F.max(F.struct("c_all", "doc_id", "passage")).alias("r")).select("signature", F.xxhash64("r.doc_id", "r.passage").alias("rep"))
    rep = broadcast_if_small(stored(rep, "representatives"), MOST_SENT)
    edges = nodes.join(rep, "signature").repartition("doc_id").groupBy("doc_id", "passage", "rep").agg((F.count(F.lit(1)) / F.max("n")).alias("w")).filter(F.col("w") >= OVERLAP)
    return edges.select("doc_id", "passage", "rep", "w", (F.col("w") / F.sum("w").over(passage)).alias("u"))


def propagate(edges: DataFrame, own: DataFrame, seeds: DataFrame) -> DataFrame:
    """``doc_id, passage, k, y``: the subject mass of every passage before its clamping in the last step.

    ``own``: ``doc_id, passage, k, y``, what passages say themselves; ``seeds``: ``doc_id, codes``.
    """
    seeds = broadcast_if_small(seeds, MOST_SENT)

    def clamped(mass: DataFrame) -> DataFrame:
        return mass.join(seeds, "doc_id", "left").filter(F.col("codes").isNull() | F.array_contains("codes", F.col("k"))).drop("codes")

    mass = own
    zero = F.lit(0.0)
    for _ in range(MAX_STEPS):
        hubs = edges.join(clamped(mass), ["doc_id", "passage"]).groupBy("rep", "k").agg(F.sum(F.col("w") * F.col("y")).alias("y"))
        hubs = stored(hubs, "hubs")
        total = hubs.groupBy("rep").agg(F.sum("y").alias("_y"))
        hubs = hubs.join(total, "rep").select("rep", "k", (F.col("y") / F.col("_y")).alias("h")).filter(F.col("h") >= FAINT)
        near = edges.join(broadcast_if_small(hubs, MOST_SENT), "rep").select("doc_id", "passage", "k", (F.col("u") * F.col("h") * NEAR).alias("y"), zero.alias("old"))
        parts = near.unionAll(own.select("doc_id", "passage", "k", F.col("y") * (1 - NEAR), zero)).unionAll(mass.select("doc_id", "passage", "k", zero, "y"))
        mass = stored(parts.groupBy("doc_id", "passage", "k").agg(F.sum("y").alias("y"), F.sum("old").alias("old")), "mass")
        whole, moved = mass.agg(F.sum("y"), F.sum(F.abs(F.col("y") - F.col("old")))).first()
        mass = mass.filter("y > 0").drop("old")
        if (moved or 0.0) <= TOLERANCE * (whole or 0.0) or not whole:
            return mass
    raise RuntimeError(f"the subjects did not come to rest within {MAX_STEPS} steps")


def subject_shares(documents: DataFrame, labels: DataFrame, codes: list[str]) -> DataFrame:
    """``doc_id, subject_code, share, labelled``: the share of the document's length in passages of each subject.

    Trusted labels (``labelled``) have a row whatever their share.
    """
    if len(codes) > MAX_SUBJECTS:
        raise ValueError(f"more than {MAX_SUBJECTS} subjects")
    number = F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("subject_code")).cast("int") - 1
    known = labels.filter(F.col("subject_code").isin(codes)).select("doc_id", "subject_code").dropna().distinct()
    known = stored(known.join(documents.select("doc_id"), "doc_id", "left_semi").withColumn("k", number), "labels")
    seeds = known.groupBy("doc_id").agg(F.collect_set("k").alias("codes"))
    sentences, terms = sentences_of(documents)
    hot = hot_keys(sentences, ["sid"])
    mass = sentences.join(seeds, "doc_id").select("sid", F.explode("codes").alias("k"), (1 / F.size("codes")).alias("y")).groupBy("sid", "k").agg(F.sum("y").alias("y"))
    spoken = None
    for r in range(WEIGHINGS):
        telling = stored(telling_terms(terms, mass), f"telling{r}")
        spoken = stored(speaking(terms, telling), f"speaking{r}")
        mass = spoken.select("sid", "k", F.lit(1.0).alias("y"))
    rows = lookup_join(sentences, spoken.withColumnRenamed("sid", "_sid"), ["sid"], ["_sid"], "left", hot)
    rows = stored(rows.select("doc_id", "passage", "size", "k", "signature").repartition("doc_id"), "spoken")
    passage = W.partitionBy("doc_id", "passage")
    by_subject = rows.repartition("doc_id").groupBy("doc_id", "passage", "k").agg(F.sum("size").alias("own"))
    by_subject = by_subject.select("doc_id", "passage", "k", "own", F.sum("own").over(passage).alias("size"), F.sum(F.when(F.col("k").isNotNull(), F.col("own"))).over(passage).alias("told"))
    own = stored(by_subject.filter("k is not null").withColumn("y", F.col("own") / F.col("told")), "own")
    told = rows.filter("k is not null")
    held = propagate(stored(verified_edges(told), "edges"), own.select("doc_id", "passage", "k", "y"), seeds)
    lead = held.groupBy("doc_id", "passage").agg(F.max(F.struct("y", -F.col("k"), "k")).alias("m"), F.sum("y").alias("all"))
    lead = lead.filter(F.col("m.y") >= 0.5 * F.col("all")).select("doc_id", "passage", F.col("m.k").alias("k"))
    fits = own.filter(F.col("own") >= 0.15 * F.col("size")).select("doc_id", "passage", "k", "size")
    parts = stored(fits.join(lead, ["doc_id", "passage", "k"], "left_semi").groupBy("doc_id", "k").agg(F.sum("size").alias("part")), "parts")
    total = rows.groupBy("doc_id").agg(F.sum("size").alias("total"))
    found = parts.groupBy("doc_id").agg(F.lit(True).alias("found"))
    out = parts.join(known.select("doc_id", "k", F.lit(True).alias("labelled")), ["doc_id", "k"], "full").join(total, "doc_id", "left").join(found, "doc_id", "left")
    # a label is not trusted where other subjects are found and it is not
    out = out.filter("part is not null or found is null")
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), F.col("k") + 1)
    return out.select("doc_id", code.alias("subject_code"), F.coalesce(F.col("part") / F.col("total"), F.lit(0.0)).alias("share"), F.coalesce("labelled", F.lit(False)).alias("labelled"))
