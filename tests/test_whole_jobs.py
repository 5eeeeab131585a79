import random

import pytest

from quillon.operators.graph import components


def test_components_of_all_layers(spark, tmp_path):
    from quillon.plans.graph import QUERIES

    rnd = random.Random(7)
    cols = ["triple_id", "subject_id", "predicate", "object_id", "layer", "status", "properties_json", "evidence_json", "origins_json", "created_at"]
    ends = [(f"n{rnd.randint(0, 60):02}", f"n{rnd.randint(0, 60):02}") for _ in range(45)] + [(None, "n01"), ("lone", None)]
    rows = [(f"t{i}", a, "R", b, ("official", "book", "candidate")[i % 3], "final", "{}", "[]", "[]", "x") for i, (a, b) in enumerate(ends)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).write.parquet(str(tmp_path / "edges.parquet"))
    want = {n: n for p in ends for n in p if n}
    for _ in list(want):
        for a, b in ends:
            if a and b:
                want[a] = want[b] = min(want[a], want[b])
    assert {r.node: r.component for r in QUERIES["agg23_all_components"](spark, str(tmp_path)).collect()} == want


def test_components_that_do_not_converge_are_an_error(spark):
    links = spark.createDataFrame([(f"p{i:02}", f"p{i + 1:02}") for i in range(30)], "a string, b string")
    with pytest.raises(RuntimeError):
        components(links.selectExpr("a as node"), links, rounds=1)


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(folder / f"{name}.parquet"))


def write_chunks(spark, folder, texts):
    rows = [(f"c{i}", "p", "b", "k", 1, 0, len(t), t, f"h{i}", None) for i, t in enumerate(texts)]
    write(spark, folder, "evidence_chunk", rows, "chunk_id string, page_id string, document_id string, chapter_id string, chapter_page_index int, cleaned_char_start int, cleaned_char_end int, text string, chunk_sha256 string, deleted_at string")


def write_dictionary(spark, folder):
    write(spark, folder, "lab_term", [("t1", "PT", "APTT", ["quality"])], "term_id string, standard_name string, abbreviation string, aliases array<string>")
    write(spark, folder, "nodes", [("n1", "clot"), ("n2", "fibrin clot"), ("n3", None), ("n4", "z")], "node_id string, name string")


def test_numbers_of_every_line_are_grounded(spark, tmp_path, monkeypatch):
    from quillon.plans import contracts

    texts = ["7\n8 mg\n99", "no number\n7", "none"]
    write_chunks(spark, tmp_path, texts)
    pages = spark.createDataFrame([("p", "7 8\n" + "".join(texts))], "page_id string, cleaned_text string")
    monkeypatch.setattr(contracts, "_pages", lambda s, d: pages)
    out = {r.chunk_id: (r.n_numbers, r.grounded) for r in contracts.fn25_all_numbers(spark, str(tmp_path)).collect()}
    assert out == {"c0": (3, False), "c1": (1, True)}


def test_quotes_are_those_of_the_edges(spark, tmp_path):
    from quillon.plans import graph

    write_chunks(spark, tmp_path, ["first line\naaa and the quote"])
    cite = lambda q, h="h0": f'{{"chunk_id":"c0","chunk_sha256":"{h}","exact_quote":"{q}"}}'
    cols = ["triple_id", "subject_id", "predicate", "object_id", "layer", "status", "properties_json", "evidence_json", "origins_json", "created_at"]
    evidence = ["[" + ",".join(x) + "]" for x in ([cite("the quote"), cite("aa")], [cite("line", "old")], [cite("gone")])]
    write(spark, tmp_path, "edges", [(f"t{i}", "a", "R", "b", "book", "final", "{}", e, "[]", "x") for i, e in enumerate(evidence)], ", ".join(f"{c} string" for c in cols))
    assert {(r.triple_id, r.exact_quote, r.place) for r in graph.val06_unique_quotes(spark, str(tmp_path)).collect()} == {("t0", "the quote", 20), ("t0", "aa", 12)}
    assert {(r.triple_id, r.exact_quote, r.n) for r in graph.val07_quote_places(spark, str(tmp_path)).collect()} == {("t0", "the quote", 1), ("t0", "aa", 2), ("t2", "gone", 0)}


def test_matching_takes_whole_names(spark, tmp_path):
    from quillon.plans.scoring import match01_matching

    write(spark, tmp_path, "observation", [("r", 1, "HEMOGLOBIN A1c"), ("r", 2, "Hemoglobin"), ("r", 3, "Hgb"), ("r", 4, "Hemopexin"), ("r", 5, None)], "report_id string, obs_id int, raw_name string")
    write(spark, tmp_path, "lab_term", [("t1", "Hemoglobin", "Hb", ["Hgb"]), ("t2", "Hemoglobin A1c", None, None), ("t3", "Hemofuscin", "", [])], "term_id string, standard_name string, abbreviation string, aliases array<string>")
    assert {(r.p, r.g) for r in match01_matching(spark, str(tmp_path)).collect()} == {("1", "t2"), ("2", "t1")}


def test_all_pairs_of_a_line(spark, tmp_path):
    from quillon.plans.contracts import join18_all_pairs

    write_dictionary(spark, tmp_path)
    write_chunks(spark, tmp_path, ["PT, quality and clot, PT\nAPTT", "clot PT"])
    assert {tuple(r) for r in join18_all_pairs(spark, str(tmp_path)).collect()} == {("PT", "clot", 2), ("PT", "quality", 1), ("clot", "quality", 1)}


def test_minimal_quotes_of_all_pairs(spark, tmp_path):
    from quillon.plans.contracts import val33_all_pairs

    write_dictionary(spark, tmp_path)
    write_chunks(spark, tmp_path, ["clot x clot yy quality\nz PT quality", "clot clot", "APTT PT", "fibrin clot"])
    assert {tuple(r) for r in val33_all_pairs(spark, str(tmp_path)).collect()} == {("c0", "clot", "quality", 15, 7), ("c0", "PT", "clot", 20, 7), ("c0", "PT", "quality", 10, 25), ("c3", "clot", "fibrin clot", 11, 0)}
