from pyspark.sql import functions as F

from quillon.operators.evidence import judged_relations, merged_names, range_graph, redirected, replayed_quotes, within_quote


def test_replayed_quotes(spark):
    chunks = spark.createDataFrame([("c", "aaa b", "h"), ("e", "", "h"), (None, "x", "h")], "chunk_id string, text string, sha256 string")
    refs = spark.createDataFrame([("c", "h", "b", "x"), ("c", "g", "b", "x"), ("c", "h", "", "x"), ("c", "h", None, "x"), ("c", "h", "aa", "x"), ("c", "h", "a", "x"), ("c", "h", "z", "x"), ("d", "h", "b", "x"), (None, "h", "x", "x"), ("e", "h", "b", "x")], "chunk_id string, chunk_sha256 string, quote string, text string")
    of = lambda **k: [(r.chunk_id, r.quote, r.status, r.start) for r in replayed_quotes(refs, chunks, **k).orderBy(F.desc_nulls_last("chunk_id"), "chunk_sha256", F.desc_nulls_last("quote")).collect()]
    assert of() == [("e", "b", "absent", None), ("d", "b", "no_chunk", None), ("c", "b", "hash_mismatch", None), ("c", "z", "absent", None), ("c", "b", "ok", 4), ("c", "aa", "ok", 0), ("c", "a", "ambiguous", None), ("c", "", "empty_quote", None), ("c", None, "empty_quote", None), (None, "x", "no_chunk", None)]
    assert ("c", "aa", "ambiguous", None) in of(overlapping=True)
    q = spark.createDataFrame([("a b a", 10, "b"), ("a b a", 10, "a"), ("a", 3, ""), ("a", 3, None)], "q string, s int, t string")
    assert [r.x for r in q.select(within_quote(F.col("q"), F.col("s"), F.col("t")).alias("x")).collect()] == [12, None, None, None]


def test_judged_relations(spark):
    nodes = spark.createDataFrame([("n", "T", "left"), ("o", "U", "right")], "node_id string, node_type string, name string")
    allowed = spark.createDataFrame([("P", "T", "U")] * 2, "predicate string, s_type string, o_type string")
    rel = [("1", "n", "P", "o", ["left of right"]), ("2", "n", "P", "o", ["left of right"]), ("3", "o", "P", "n", ["left of right"]), ("4", "n", "P", None, ["x"]), ("5", "n", "Q", "o", ["x"])]
    schema = "triple_id string, subject_id string, predicate string, object_id string, quotes array<string>"
    got = lambda rows: {r.triple_id: r.verdict for r in judged_relations(spark.createDataFrame(rows, schema), nodes, allowed).collect()}
    assert got(rel) == {"1": "valid", "2": "duplicate", "3": "type_not_allowed", "4": "no_endpoint", "5": "type_not_allowed"}
    assert got([("1", "n", "P", "o", None)]) == {"1": "no_evidence"} and got([("1", "n", "P", "o", ["left", "right"])]) == {"1": "partial"} and got([]) == {}


def test_names_and_redirects(spark):
    names = [("1", "A", "a"), ("1", "B", "b"), ("2", "b", "b"), ("2", "血糖", "血糖"), ("3", "葡萄糖", "c"), ("3", "血 糖", "血糖"), ("4", "Z", ""), ("5", "Y", "")]
    out = {r.id: (r.component, r.canonical) for r in merged_names(spark.createDataFrame(names, "id string, name string, key string")).collect()}
    assert out == {"1": ("1", "血 糖"), "2": ("1", "血 糖"), "3": ("1", "血 糖"), "4": ("4", "Z"), "5": ("5", "Y")}
    groups = spark.createDataFrame([("1", "a", ["b", "a"]), ("2", "b", []), ("3", "c", ["b", None]), ("4", None, None)], "id string, key string, alias_keys array<string>")
    assert [(r.id, r.to) for r in redirected(groups).collect()] == [("2", "1")]
    assert merged_names(spark.createDataFrame([], "id string, name string, key string")).count() == 0


def test_range_graph(spark):
    rows = [("K", "p", "mmol/L", 3.5, 5.1)] * 2 + [("Na", "p", "mmol/L", None, 145.0), ("X", "p", "u", None, None), ("D", "p", "u", 1.0, 2.0), ("D", "p", "u", 1.0, 3.0)]
    out = {(r.subject, r.object): r.condition for r in range_graph(spark.createDataFrame(rows, "name string, panel string, unit string, lower double, upper double")).collect()}
    assert out == {("p", "K"): None, ("K", "K lowered"): "value LT 3.5000 mmol/L", ("K", "K normal"): "value BETWEEN 3.5000 5.1000 mmol/L", ("K", "K raised"): "value GT 5.1000 mmol/L", ("p", "Na"): None, ("Na", "Na raised"): "value GT 145.0000 mmol/L", ("p", "X"): None}


def test_places_and_anchors(spark):
    from quillon.operators.evidence import anchor, anchors, indexed_places, longest_spans

    places = spark.createDataFrame([("t", "a", 0), ("t", "a", 4), ("t", "a", 9), ("t", "b", 7), ("t", "b", 7)], "id string, word string, start int")
    claims = [("1", "t", "a", 4, 0), ("2", "t", "a", 5, 2), ("3", "t", "b", 1, 5), ("4", "t", "a", None, None), ("5", "t", "z", 1, 0)]
    out = indexed_places(spark.createDataFrame(claims, "claim_id string, id string, word string, claimed int, nth int"), places)
    assert {r.claim_id: r.start for r in out.collect()} == {"1": 4, "2": 9, "3": 7, "4": None, "5": None}

    def brute(text, s, e, most):
        spans = [(max(0, s - k), min(len(text), e + k)) for k in range(most, -1, -1)]
        return next(((a, b) for a, b in spans if sum(text.startswith(text[a:b], i) for i in range(len(text))) == 1), None)

    texts = ["abcabcab", "aaaa", "xy xz xy", "", "ab" * 40 + "c" + "ab" * 40]
    for t in texts:
        for s in range(len(t)):
            for most in (0, 1, 3, 32):
                assert anchor(t, s, min(s + 2, len(t)), most) == brute(t, s, min(s + 2, len(t)), most)
    m = spark.createDataFrame([("1", 0, 2), ("1", 0, 2), ("2", 1, 2), ("3", 0, 1)], "id string, start int, end int")
    df = spark.createDataFrame([("1", "xy xz xy"), ("2", "aaaa"), ("3", None)], "id string, text string")
    assert sorted((r.id, r.start, r.a_start, r.a_end) for r in anchors(m, df, 1).collect()) == [("1", 0, 0, 3), ("2", 1, None, None)]
    s = spark.createDataFrame([("t", "ab", 5), ("t", "cd", 3), ("t", "x", 0)], "id string, word string, start int")
    assert [(r.word, r.start) for r in longest_spans(s).collect()] == [("cd", 3)]


def test_layers(spark):
    from quillon.operators.matching import layered_scores

    schema = "s_type string, s_name string, predicate string, o_type string, o_name string"
    p = spark.createDataFrame([("T", "a b", "P", "U", "c")], schema)
    g = spark.createDataFrame([("T", "ab", "P", "U", "c"), ("T", "ab", "Q", "U", "c")], schema)
    out = {r.layer: (r.tp, r.fp, r.fn) for r in layered_scores(p, g).collect()}
    assert out == {"mention": (1, 1, 1), "canonical": (2, 0, 0), "link": (1, 1, 1), "relation": (1, 0, 1)}
    assert layered_scores(p.limit(0), g.limit(0)).count() == 0
