"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

* Documents are summed up to cells (source, language, topic). The cells' token weights are raked until the sources reach
  their target shares and languages and topics keep the shares they have in the corpus, no cell being used more than its
  source allows. The last step always fits the sources.
* A document's expected number of uses is its cell's weight. The whole part is given to each document; the fractional
  part is sampled with probabilities in that proportion (sequential Poisson sampling by a hash of the key) until the
  tokens of its source are reached.

Semantics: sources are compared in lower case with ``-`` and blanks as ``_``, languages by their first part; documents of
sources without a target get no use. Null or empty texts have no tokens and no use. A source whose tokens, repeated as
often as allowed, do not reach its share of ``total`` falls short and is used to its limit. Sampling is by hash, so the
same input gives the same uses. Repeated target rows count once; a source with two different targets is refused.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Bound on the cells that go to the driver; rounds of fitting; resolution of the sampling order, and of its last slot.
MAX_CELLS, ROUNDS, SLOTS = 200_000, 200, 4_096


def source_name(source: Column) -> Column:
    """One spelling of a source."""
    return F.regexp_replace(F.trim(F.lower(source)), r"[\s\-]+", "_")


def language(lang: Column) -> Column:
    """The main language of a tag; ``und`` for none."""
    return F.coalesce(F.nullif(F.split(F.trim(F.lower(lang)), "[-_]")[0], F.lit("")), F.lit("und"))


def rake(cells: dict[tuple[str, str, str], float], goal: dict[str, float], most: dict[str, int], rounds: int = ROUNDS) -> dict[tuple[str, str, str], float]:
    """Uses per token of each cell ``(source, language, topic)``.

    ``goal`` is the number of tokens wanted of each source, ``most`` the uses allowed. Languages and topics keep their
    corpus shares as far as the sources allow.
    """
    size = {c: t for c, t in cells.items() if t > 0 and goal.get(c[0], 0) > 0}
    weight = {c: t for c, t in size.items()}
    total = sum(goal.values())
    corpus = sum(size.values()) or 1.0
    margins = []
    for axis in (1, 2):
        share: dict = defaultdict(float)
        for c, t in size.items():
            share[c[axis]] += t / corpus * total
        margins.append((axis, dict(share)))

    def fit(axis: int, target: dict) -> float:
        now: dict = defaultdict(float)
        for c, w in weight.items():
            now[c[axis]] += w
        off = max((abs(now[k] / target[k] - 1) for k in now if target.get(k)), default=0.0)
        for c in weight:
            if now[c[axis]] > 0:
                weight[c] *= target[c[axis]] / now[c[axis]]
        return off

    def fit_sources() -> None:
        for s, want in goal.items():
            own = [c for c in weight if c[0] == s]
            want = min(want, most[s] * sum(size[c] for c in own))
            full: set = set()
            for _ in range(len(own) + 1):  # cells at their limit stay there, the others share the rest
                rest = want - sum(size[c] * most[s] for c in full)
                free = sum(weight[c] for c in own if c not in full)
                if free <= 0:
                    break
                for c in own:
                    weight[c] = size[c] * most[s] if c in full else weight[c] * rest / free
                over = {c for c in own if c not in full and weight[c] > size[c] * most[s] * (1 + 1e-12)}
                if not over:
                    break
                full |= over

    fit_sources()
    for _ in range(rounds):
        off = max(fit(axis, target) for axis, target in margins)
        fit_sources()
        if off < 1e-6:
            break
    return {c: w / size[c] for c, w in weight.items()}


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17) -> DataFrame:
    """``doc_id, source, n_tokens, uses`` of every document of a target source.

    ``documents``: ``doc_id, source, lang, topic, n_tokens``; ``targets``: ``source, target_share, max_repeats``.
    ``total`` is the wanted size in tokens, by default that of all documents of the target sources.
    """
    spark = documents.sparkSession
    wanted = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").dropna().distinct().limit(MAX_CELLS + 1).collect()
    if len(wanted) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} targets")
    aim = {r.source: r for r in wanted}
    if len(aim) < len(wanted):
        raise ValueError("a source has two targets")
    docs = documents.select("doc_id", source_name(F.col("source")).alias("source"), language(F.col("lang")).alias("lang"), F.coalesce("topic", F.lit("none")).alias("topic"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
    names = spark.createDataFrame([(s,) for s in aim], "source string")
    docs = docs.join(F.broadcast(names), "source")  # the target list, read above with its bound
    rows = docs.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("t")).limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of source, language and topic")
    cells = {(r.source, r.lang, r.topic): float(r.t) for r in rows}
    supply: dict = defaultdict(float)
    for c, t in cells.items():
        supply[c[0]] += t
    whole = float(total if total is not None else sum(supply.values()))
    goal = {s: min(float(r.target_share) * whole, supply[s] * r.max_repeats) for s, r in aim.items()}
    weights = rake(cells, goal, {s: int(r.max_repeats) for s, r in aim.items()})
    table = spark.createDataFrame([(*c, w) for c, w in weights.items()], "source string, lang string, topic string, weight double")
    docs = docs.join(F.broadcast(table), ["source", "lang", "topic"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))  # at most MAX_CELLS rows
    docs = docs.withColumn("base", F.floor(F.col("weight") + 1e-9)).withColumn("part", F.greatest(F.col("weight") - F.col("base"), F.lit(0.0)))
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) + 1) / float(1 << 40)
    order = F.when((F.col("part") > 1e-9) & (F.col("n_tokens") > 0), u / F.col("part"))
    docs = docs.withColumn("order", order).withColumn("slot", F.least(F.floor(F.col("order") * SLOTS / 4), F.lit(SLOTS)).cast("int"))
    sums = docs.groupBy("source", "slot").agg(F.sum("n_tokens").alias("t"), F.sum(F.col("base") * F.col("n_tokens")).alias("given")).collect()  # at most SLOTS + 2 rows a source
    open_: dict = dict(goal)
    slots: dict = defaultdict(dict)
    for r in sums:
        open_[r.source] -= float(r.given or 0)
        if r.slot is not None:
            slots[r.source][r.slot] = float(r.t)
    edges = []
    for s in aim:
        left, edge = open_.get(s, 0.0), -1
        for slot in sorted(slots[s]):
            edge = slot
            if slots[s][slot] >= left:
                break
            left -= slots[s][slot]
            edge = slot + 1
        edges.append((s, edge, max(left, 0.0)))
    edge = spark.createDataFrame(edges, "source string, edge int, left_over double")
    docs = docs.join(F.broadcast(edge), "source")  # a row per target
    # in the slot where the tokens are reached, one after the other; slots are narrow, so this group is small
    at_edge = docs.filter("slot = edge")
    run = F.sum("n_tokens").over(W.partitionBy("source", "slot").orderBy("order", "doc_id"))
    at_edge = at_edge.withColumn("more", (run - F.col("n_tokens") / 2 <= F.col("left_over")).cast("int"))
    other = docs.filter("slot is null or slot <> edge").withColumn("more", F.coalesce((F.col("slot") < F.col("edge")).cast("int"), F.lit(0)))
    return at_edge.unionByName(other).select("doc_id", "source", "n_tokens", (F.col("base") + F.col("more")).cast("int").alias("uses"))


def shares_reached(uses: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source of the target list: tokens there and used, the share wanted and reached, and whether it falls short."""
    got = uses.groupBy("source").agg(F.sum("n_tokens").alias("tokens_there"), F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens_used"), F.max("uses").alias("most_uses"))
    got = got.withColumn("all_used", F.sum("tokens_used").over(W.partitionBy()))
    want = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").dropna().distinct()
    share = F.col("tokens_used") / F.col("all_used")
    return want.join(got, "source", "left").select("source", "target_share", F.round(F.coalesce(share, F.lit(0.0)), 6).alias("reached_share"), "max_repeats", "most_uses", F.coalesce("tokens_there", F.lit(0)).alias("tokens_there"), F.coalesce("tokens_used", F.lit(0)).alias("tokens_used"), (F.coalesce(share, F.lit(0.0)) < F.col("target_share") - 0.005).alias("falls_short"))
