from pyspark.sql import functions as F

from quillon.llm.subjects import subject_shares

WORDS = {"A": ["fibrin clot", "heparin level", "factor assay"], "B": ["sprint test", "rowing crew", "race season"]}


def _text(kind, i, n=5):
    w = WORDS[kind]
    return " ".join(f"The {w[(i + j) % 3]} was looked at with the {w[(i + j + 1) % 3]} again." for j in range(n))


def test_subjects(spark):
    docs = [(i, _text("AB"[i % 2], i), "clash") for i in range(40)]
    docs += [(100, _text("A", 1) + "\n\n" + _text("B", 2), ""), (101, "Nothing to report. The rest is given on page 9.", ""), (102, None, ""), (103, "", ""), (104, _text("A", 0, 9) + " The sprint test was looked at.", ""), (105, _text("B", 1, 2000), "")]
    docs += [(i, "Nothing to report. The rest is given on page 9. " + _text("AB"[i % 2], i), "") for i in range(200, 220)]
    labels = [(i, "AB"[i % 2]) for i in range(10)] + [(0, "A"), (999, "A"), (1, None), (2, "Z")] + [(i, "AB"[i % 2]) for i in range(200, 206)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, subject_code string")
    out = subject_shares(d, spark.createDataFrame(labels, "doc_id bigint, subject_code string"), ["A", "B"])
    got = {(r.doc_id, r.subject_code) for r in out.filter(F.col("share") >= 0.2).collect()}
    assert {x for x in got if x[0] < 40} == {(i, "AB"[i % 2]) for i in range(40)}
    assert {x for x in got if 100 <= x[0] < 200} == {(100, "A"), (100, "B"), (104, "A"), (105, "B")}


def test_nothing_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, _text("A", 1))], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, subject_code string")
    assert subject_shares(d, none, ["A", "B"]).count() == 0
    assert subject_shares(d.limit(0), none, ["A"]).count() == 0


def test_trusted_labels_stay(spark):
    docs = [(i, _text("AB"[i % 2], i)) for i in range(40)] + [(50, _text("A", 1)), (51, _text("A", 2)), (52, "Nothing to report.")]
    labels = [(i, "AB"[i % 2]) for i in range(20)] + [(50, "B"), (51, "A"), (51, "B"), (52, "B")]
    out = subject_shares(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, subject_code string"), ["A", "B"])
    rows = {(r.doc_id, r.subject_code): r.labelled for r in out.filter("share >= 0.2 or labelled").collect()}
    assert all(rows.get((i, "AB"[i % 2])) is (i < 20) for i in range(40))
    # what a label says against all passages is not trusted; where no passage says anything, it is
    assert (50, "B") not in rows and (51, "B") not in rows and rows[(51, "A")] and rows[(52, "B")]


def test_edges_against_brute_force(spark):
    import random
    from collections import Counter, defaultdict

    from quillon.llm.subjects import OVERLAP, verified_edges

    rng = random.Random(5)
    rows = [(d, p, rng.randrange(8) + 10 * (d % 3)) for d in range(30) for p in range(3) for _ in range(rng.randrange(1, 9))]
    own = defaultdict(Counter)
    for d, p, t in rows:
        own[d, p][t] += 1
    rep = {t: max((sum(c.values()), *n) for n, c in own.items() if t in c)[1:] for _, _, t in rows}
    want = {(*n, r): sum(rep[t] == r for t in c) / len(c) for n, c in own.items() for r in {rep[t] for t in c}}
    # each of these signatures stands in the representative too
    assert all(t in own[rep[t]] for c in own.values() for t in c)
    df = spark.createDataFrame(rows, "doc_id bigint, passage int, signature bigint")
    ids = {r.rep: (r.d, r.p) for r in spark.createDataFrame(sorted(set(rep.values())), "d bigint, p int").select("d", "p", F.xxhash64("d", "p").alias("rep")).collect()}
    got = {(r.doc_id, r.passage, ids[r.rep]): r.w for r in verified_edges(df).collect()}
    assert got == {k: v for k, v in want.items() if v >= OVERLAP}


def test_propagation_decides_what_follows(spark, monkeypatch):
    """What the propagation gives is the subject, also against what most of the passage says; before, such a passage had none."""
    from quillon.llm import subjects as S

    docs = [(i, _text("AB"[i % 2], i)) for i in range(40)] + [(50, _text("A", 1, 3) + " " + _text("B", 1, 2))]
    d, labels = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(i, "AB"[i % 2]) for i in range(20)], "doc_id bigint, subject_code string")
    found = lambda: {r.subject_code for r in S.subject_shares(d, labels, ["A", "B"]).filter("doc_id = 50").collect()}
    real = S.propagate

    def favoured(k):
        y = F.when(F.col("doc_id") == 50, F.when(F.col("k") == k, 0.6).otherwise(0.4)).otherwise(F.col("y"))
        return lambda edges, own, seeds: real(edges, own, seeds).withColumn("y", y)

    for k, code in enumerate("AB"):
        monkeypatch.setattr(S, "propagate", favoured(k))
        assert found() == {code}
