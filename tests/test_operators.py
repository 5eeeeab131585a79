import random

import pytest
from pyspark.sql import functions as F

from quillon.functions.text import disjoint_count, first_sentence, grams, overlapping_count, query_terms
from quillon.operators.graph import adjacency, bounded_search, components, suffix_parents, upsert
from quillon.operators.retrieval import cosine_search, expand_neighbours, guard, lexical_search, record_search
from quillon.operators.rules import evaluate_observations, evaluate_tree, heights, interval_flag, select_case
from quillon.operators.scoring import longest_first, maximum_matching, prf
from quillon.operators.segments import lines_with_offsets, masked, overlap_join, pack_windows, section_paths, slice_page
from quillon.streaming.incremental import pending


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text_functions(spark):
    assert query_terms("Heparin 血涂片 level") == ["heparin", "level", "涂片", "血涂"]
    assert one(spark, overlapping_count(F.lit("aaaa"), F.lit("aa"))) == 3 and one(spark, disjoint_count(F.lit("aaaa"), F.lit("aa"))) == 2
    assert one(spark, first_sentence(F.lit("甲乙。丙丁。"))) == "甲乙。" and one(spark, first_sentence(F.lit("no end"))) == "no end"
    assert sorted(one(spark, grams(F.lit("a  bc"), 2, 3))) == [" b", " bc", "a ", "a b", "bc"]


def test_lexical_search_prefers_the_rare_term_and_fills_with_neighbours(spark):
    df = spark.createDataFrame([(f"c{i}", "p", i, "alpha common" if i % 2 else "common") for i in range(6)] + [("c9", "p", 9, "rare common")], "chunk_id string, page_id string, s int, text string")
    hits = lexical_search(df, "rare alpha", 2)
    assert [r.chunk_id for r in hits.collect()] == ["c9", "c1"]
    rows = [(r.chunk_id, r.reason) for r in expand_neighbours(hits, df, 4).collect()]
    assert rows == [("c9", "hit"), ("c1", "hit"), ("c5", "neighbour"), ("c0", "neighbour")]
    assert lexical_search(df, "zzz", 2).count() == 0 and lexical_search(df.limit(0), "rare", 2).count() == 0
    for bad in (("", 1), ("x" * 401, 1), ("x", 0), ("x", True)):
        with pytest.raises(ValueError):
            guard(*bad)


def test_cosine_weighs_rare_grams(spark):
    docs = spark.createDataFrame([("common", "aaaa"), ("rare", "aabb")], "id string, text string")
    assert [r.id for r in cosine_search(docs, "aaaabb", 2, 0.0, 2, 2).collect()] == ["rare", "common"]
    assert cosine_search(docs, "zz", 2).count() == 0


def test_record_search(spark):
    rows = [("alpha", "Alpha Clearance Index", "t", "body", "rule", ["paired"], ["ACI"], None), ("beta", "Beta", "t", "clearance of beta", "rule", [], [], None), ("ctx", "x", "alpha clearance index", "", "rule", [], [], "alpha")]
    df = spark.createDataFrame(rows, "record_id string, standard_name string, title string, body string, rule_type string, conditions array<string>, aliases array<string>, parent_id string")
    assert record_search(df, "alpha clearance index", 3).first().record_id == "alpha"
    assert record_search(df, "ACI", 3).first().record_id == "alpha"
    assert record_search(df, "alpha clearance index", 3, required=["single"]).count() == 0


def test_bounded_search_reaches_each_node_once(spark):
    e = spark.createDataFrame([("1", "a", "R", "b"), ("2", "b", "R", "c"), ("3", "a", "R", "c"), ("4", "c", "R", "d"), ("5", "d", "R", "e"), ("6", "e", "R", "f"), ("7", None, "R", "a")], "triple_id string, subject_id string, predicate string, object_id string")
    out = {r.node: (r.hops, r.via) for r in bounded_search(spark.createDataFrame([("a",)], "start string"), adjacency(e)).collect()}
    assert out == {"a": (0, "a"), "b": (1, "a>b"), "c": (1, "a>c"), "d": (2, "a>c>d"), "e": (3, "a>c>d>e")}


def test_components_against_brute_force(spark):
    rnd = random.Random(3)
    links = [(f"n{rnd.randint(0, 40):02}", f"n{rnd.randint(0, 40):02}") for _ in range(30)] + [(f"p{i:02}", f"p{i + 1:02}") for i in range(30)] + [(None, "n01")]
    nodes = sorted({x for p in links for x in p if x})
    comp = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            if a and b:
                comp[a] = comp[b] = min(comp[a], comp[b])
    df = spark.createDataFrame(links, "a string, b string")
    out = {r.node: r.component for r in components(spark.createDataFrame([(n,) for n in nodes] + [("alone",)], "node string"), df).collect()}
    assert out == comp | {"alone": "alone"}


def test_upsert_and_suffixes(spark):
    df = spark.createDataFrame([("k", 1, "a", ["x"]), ("k", 2, None, ["y", "x"]), ("l", 1, "b", None)], "k string, o int, s string, l array<string>")
    assert {(r.k, r.s, tuple(r.l), r.n_rows) for r in upsert(df, ["k"], "o", ["s"], ["l"]).collect()} == {("k", "a", ("x", "y"), 2), ("l", "b", (), 1)}
    names = spark.createDataFrame([("iron anaemia",), ("anaemia",), ("xanaemia",), ("",)], "name string")
    assert {tuple(r) for r in suffix_parents(names).collect()} == {("iron anaemia", "anaemia")}


@pytest.mark.parametrize(
    "v, lo, hi, li, ui, flag",
    [(6, 2, 5, True, True, "high"), (1, 2, 5, True, True, "low"), (2, 2, 5, True, True, "normal"), (2, 2, 5, False, True, "low"), (5, 2, 5, True, False, "high"), (6, None, 5, True, True, "high"), (1, 2, None, True, True, "low"), (3, 2, None, True, True, "normal"), (3, None, None, True, True, None), (3, 5, 2, True, True, None)],
)
def test_intervals(spark, v, lo, hi, li, ui, flag):
    c = lambda x, t: F.lit(x).cast(t)
    assert one(spark, interval_flag(c(v, "double"), c(lo, "double"), c(hi, "double"), c(li, "boolean"), c(ui, "boolean"))) == flag


def test_errors(spark):
    cols = "value string, unit string, unit_source string, ref_lower double, ref_upper double, lower_inclusive boolean, upper_inclusive boolean, report_flag string"
    rows = [("1.25e1", "g/L", None, 0.1, 12.5, True, True, "normal"), ("x", None, None, None, None, None, None, None), ("nan", "g/L", "controlled_default", 5.0, 2.0, True, True, "high"), ("9", "g/L", None, 1.0, 2.0, None, None, "low")]
    out = [(r.computed_flag, r.errors) for r in evaluate_observations(spark.createDataFrame(rows, cols)).collect()]
    assert out == [("normal", []), (None, ["invalid_value", "missing_unit", "invalid_interval"]), (None, ["non_finite_value", "default_unit_applied", "reversed_interval"]), ("high", ["report_flag_conflict"])]


TREE = [("r", None, "all", None, None), ("a", "r", "atom", None, "a"), ("o", "r", "any", None, None), ("b", "o", "atom", None, "b"), ("t", "o", "at_least", 2, None), ("c", "t", "atom", None, "c"), ("d", "t", "atom", None, "d")]


@pytest.mark.parametrize("facts, result", [({"a": 11, "b": None, "c": 11, "d": 11}, "true"), ({"a": 11, "b": None, "c": 1, "d": None}, "unknown"), ({"a": 9, "b": None, "c": 1, "d": 1}, "false"), ({"a": 11}, "unknown")])
def test_three_valued_tree(spark, facts, result):
    schema = "rule_id string, node_id string, parent_id string, kind string, k int, metric string, op string, threshold double, upper double"
    nodes = spark.createDataFrame([("R", n, p, kind, k, m, "ge" if m else None, 10.0 if m else None, None) for n, p, kind, k, m in TREE], schema)
    f = spark.createDataFrame([("c1", m, float(v) if v is not None else None) for m, v in facts.items()], "case_id string, metric string, value double")
    assert [r.result for r in evaluate_tree(nodes, f).collect()] == [result]
    assert heights([("R", n, p) for n, p, *_ in TREE])[("R", "r")] == 3


def test_case_selection(spark):
    rows = [(1, "pass"), (1, "fail"), (2, "pass"), (2, "pass"), (3, "missing"), (3, "unit_mismatch"), (4, "fail")]
    out = {r.k: r.outcome for r in select_case(spark.createDataFrame(rows, "k int, status string"), ["k"]).collect()}
    assert out == {1: "case_match", 2: "ambiguous", 3: "unit_mismatch", 4: "no_case_match"}


def test_segments(spark):
    assert [(a, b) for a, b, _ in slice_page("one\ntwo\n\nthree\nfour\n", 10)] == [(0, 9), (9, 15), (15, 20)]
    table = "<table>\ncell contents\n</table>\n"
    assert slice_page("x\n" + table + "y\n", 10) == [(0, 2, False), (2, 32, True), (32, 35, False)]
    # without a break the cut is hard; the mark that closes a fence opens another one, so a fence holds the rest of its page
    assert slice_page("a" * 30, 10) == [(0, 10, False), (10, 20, False), (20, 30, False)]
    assert slice_page("x\n```\ncode\n```\nrest of it\nmore\n", 8) == [(0, 2, False), (2, 31, True)]
    for text in ("", "a", "a\n" * 50, "```\n" + "z\n" * 30, "long line " * 30, "\n\n\n", "| a |\n$$\nx\n$$\n" * 20, "<table> never closed " * 9):
        assert "".join(text[a:b] for a, b, _ in slice_page(text, 12)) == text
    p = spark.createDataFrame([("p", "ab\n\ncd"), ("q", None), ("r", "")], "id string, t string")
    assert [(r.id, r.line_no, r.line, r.line_start, r.line_end) for r in lines_with_offsets(p, "id", "t").orderBy("id", "line_no").collect()] == [("p", 1, "ab", 0, 2), ("p", 2, "", 3, 3), ("p", 3, "cd", 4, 6), ("r", 1, "", 0, 0)]
    items = spark.createDataFrame([("g", i, n) for i, n in enumerate([5, 4, 30, 3, 3])], "g string, o int, n int")
    assert [r.window_no for r in pack_windows(items, "g", ["o"], "n", 10).orderBy("o").collect()] == [0, 0, 1, 2, 2]
    spans = F.array(F.struct(F.lit(1).alias("start"), F.lit(4).alias("end")))
    assert one(spark, masked(F.lit("ab\ncd"), spans)) == "a \n d"
    lines = spark.createDataFrame([("b", i, t) for i, t in enumerate(["# A", "x", "一、B", "y", "（一）C", "z", "# D", "w"])], "book string, n int, line string")
    got = [(r.h1, r.h2, r.h3) for r in section_paths(lines, "book", ["n"]).orderBy("n").collect()]
    assert got[5] == ("A", "一、B", "（一）C") and got[7] == ("D", None, None)


def test_a_repeated_batch_replaces_what_it_wrote(spark, tmp_path):
    from quillon.streaming.incremental import run_stream

    src, out, progress = (str(tmp_path / x) for x in ("src", "out", "progress"))
    units = [(f"u{i}", f"h{i}") for i in range(6)]
    spark.createDataFrame(units[:4], "unit_id string, content_sha256 string").coalesce(1).write.parquet(src)
    read = lambda: spark.readStream.schema("unit_id string, content_sha256 string").parquet(src)
    work = lambda df: df.select("unit_id", F.length("content_sha256").alias("n"))
    run_stream(read(), work, out, progress, str(tmp_path / "c1"), "v1").awaitTermination()
    # a crash between the two writes: the results are there, the progress and the commit of the batch are not
    import shutil

    shutil.rmtree(next((tmp_path / "progress").glob("run=*")) / "batch=0")
    shutil.rmtree(tmp_path / "c1" / "commits")
    spark.createDataFrame(units[2:], "unit_id string, content_sha256 string").coalesce(1).write.mode("append").parquet(src)
    for _ in range(2):
        run_stream(read(), work, out, progress, str(tmp_path / "c1"), "v1").awaitTermination()
    assert sorted(r.unit_id for r in spark.read.parquet(out).collect()) == [u for u, _ in units]
    run_stream(read(), work, out, progress, str(tmp_path / "c2"), "v2").awaitTermination()
    assert spark.read.parquet(progress).select("identity").distinct().count() == 12


def test_overlap_join_against_brute_force(spark):
    rnd = random.Random(5)
    mk = lambda n: [("k", i, s, s + rnd.randint(1, 2000)) for i, s in enumerate(rnd.randint(0, 5000) for _ in range(n))]
    a, b = mk(40), mk(40)
    out = overlap_join(spark.createDataFrame(a, "key string, l_id int, l_start int, l_end int"), spark.createDataFrame(b, "key string, r_id int, r_start int, r_end int"), "key")
    rows = [(r.l_id, r.r_id) for r in out.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(i, j) for _, i, s, e in a for _, j, t, f in b if max(s, t) < min(e, f)}


def test_scores_and_matching(spark):
    c = lambda *x: {k: one(spark, v) for k, v in prf(*[F.lit(i) for i in x]).items()}
    assert c(1, 1, 1) == {"precision": 0.5, "recall": 0.5, "f1": 0.5}
    assert c(0, 0, 0) == {"precision": 1.0, "recall": 1.0, "f1": 1.0} and c(0, 2, 0)["recall"] == 1.0 and c(0, 0, 2)["precision"] == 0.0
    rnd = random.Random(8)
    for trial in range(6):
        pairs = sorted({(f"p{rnd.randint(0, 6)}", f"g{rnd.randint(0, 6)}") for _ in range(12)})

        def best(i, used):
            if i == len(ps):
                return 0
            return max([best(i + 1, used)] + [1 + best(i + 1, used | {g}) for p, g in pairs if p == ps[i] and g not in used])

        ps = sorted({p for p, _ in pairs})
        rows = maximum_matching(spark.createDataFrame([("x", *r) for r in pairs], "k string, p string, g string"), "k").collect()
        assert len(rows) == best(0, frozenset()) == len({r.p for r in rows}) == len({r.g for r in rows}) and all((r.p, r.g) in pairs for r in rows)
    s = spark.createDataFrame([("c", 0, 5), ("c", 3, 9), ("c", 10, 12), ("c", 4, 6)], "id string, start int, end int")
    assert {(r.start, r.end) for r in longest_first(s, ["id"]).collect()} == {(3, 9), (10, 12)}


def test_pending_units(spark):
    u = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2")], "unit_id string, content_sha256 string")
    first = pending(u, spark.createDataFrame([], "identity string"), "v1")
    assert first.count() == 2
    done = first.filter("unit_id = 'a'").select("identity")
    assert [r.unit_id for r in pending(u, done, "v1").collect()] == ["b"] and pending(u, done, "v2").count() == 2
