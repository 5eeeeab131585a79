import json

import pytest
from pyspark.sql import functions as F

from quillon.operators.reports import column_role, first_match_merge, gate_reason, grid, ocr_rows, reference_bounds, rule_parts, table_grids
from quillon.sources.packages import changed_tables, index_entries, read_decisions, read_dictionary, read_ocr, read_reports, write_package


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_grid_expands_spans(spark):
    html = "<table><tr><td rowspan=2>a</td><td colspan='2'>b</td></tr><tr><td>c</td><td>d</td></tr><tr><td>e</td><td>f</td><td>g</td></tr></table>"
    cells = grid(html)
    assert len(cells) == 9 and [c[2] for c in cells] == ["a", "b", "b", "a", "c", "d", "e", "f", "g"] and cells[0][3] == cells[3][3]
    with pytest.raises(ValueError):
        grid("<tr><td>x</td><td rowspan=2>a</td></tr><tr><td colspan=2>b</td></tr>")
    out = table_grids(spark.createDataFrame([("1", html), ("2", None), ("3", "<tr><td>x</td><td rowspan=2>a</td></tr><tr><td colspan=2>b</td></tr>")], "block_id string, html string"))
    assert out.filter("block_id = '1'").count() == 9 and out.filter("block_id = '3' and text is null").count() == 1


@pytest.mark.parametrize(
    "text, lo, hi, li, ui", [("2-5", 2, 5, True, True), ("(3.5 ~ 5.1)", 3.5, 5.1, True, True), ("2--5", 2, 5, True, True), ("<5", None, 5, False, False), ("≤5", None, 5, False, True), (">1.5", 1.5, None, False, False), ("neg", None, None, False, False), ("", None, None, False, False)]
)
def test_bounds(spark, text, lo, hi, li, ui):
    r = one(spark, reference_bounds(F.lit(text)))
    assert (r.lower, r.upper, r.lower_inclusive, r.upper_inclusive) == (lo, hi, li, ui)


def test_columns_rules_and_gates(spark):
    assert one(spark, column_role(F.lit("检验 项目"))) == "name" and one(spark, column_role(F.lit("?"))) is None
    r = one(spark, rule_parts(F.lit("Rule: IF MCV < 80 AND MCH < 23 THEN microcytic")))
    assert r.predicates == ["MCV < 80", "MCH < 23"] and r.conclusion == "microcytic" and one(spark, rule_parts(F.lit("no"))) is None
    arr = lambda *x: F.array(*map(F.lit, x))
    gate = lambda i, o, l, q: one(spark, gate_reason(arr(*i), arr(*o), F.lit(l), F.lit(q)))
    assert gate(["a", "b"], ["b"], "", "") == "rule_input_output_overlap" and gate(["a", "b"], ["DIC"], "", "x (如 DIC)") == "rule_output_is_explicit_example"
    assert gate(["a", "b"], ["c"], "a < 5", "") == "threshold_rule" and gate(["a"], ["c"], "", "") == "single_input" and gate(["指标甲", "指标乙"], ["分类"], "", "结果分类") is None


def test_reports_and_ocr(spark):
    good = json.dumps({"report_id": "r", "observations": [{"raw_name": "HGB", "value": "1"}, {"standard_name": "A", "raw_name": "HGB"}, {"value": "3"}, {"raw_name": "HGB"}]})
    out = read_reports(spark.createDataFrame([(good,), ("no json",), (None,)], "raw_response string"))
    assert sorted((r.key or "", r.problem or "") for r in out.collect()) == [("", "no_key"), ("", "not_a_report"), ("", "not_a_report"), ("A", ""), ("HGB", "repeated_key"), ("HGB", "repeated_key")]
    box = lambda x, y: [x, y, x + 9, y + 10]
    ocr = json.dumps({"pages": [{"texts": ["b", "a", "c"], "scores": [1, 1, 1], "boxes": [box(50, 1), box(0, 3), box(0, 30)]}, {"texts": ["x"], "scores": [], "boxes": []}]})
    lines = read_ocr(spark.createDataFrame([("d", ocr)], "doc_id string, raw_response string"))
    assert lines.filter("text is null").count() == 1
    assert [(r.row, r.cells) for r in ocr_rows(lines).orderBy("row").collect()] == [(0, ["a", "b"]), (1, ["c"])]


def test_order_dependent_merge(spark):
    rows = [("g", 0, ["a"]), ("g", 1, ["b"]), ("g", 2, ["a", "c"]), ("g", 3, ["b", "c"]), ("g", 4, ["c"]), ("g", 5, None)]
    out = [(r.merged, r.ambiguous) for r in first_match_merge(spark.createDataFrame(rows, "k string, order int, names array<string>"), "k").orderBy("order").collect()]
    assert out == [(0, False), (1, False), (0, False), (None, True), (0, False), (2, False)]


def test_files(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("term\taliases\treview_status\nMCH\ta|b\tAPPROVED\nX\t\tPENDING\n")
    assert [(r.term, r.aliases) for r in read_dictionary(spark, str(tmp_path / "d.tsv")).collect()] == [("MCH", ["a", "b"])]
    (tmp_path / "j.jsonl").write_text('{"item_id":"1","decision":"yes","decided_at":"2024-01-01T00:00:00"}\nbroken\n{"item_id":"1","decision":"no","decided_at":"2024-01-02T00:00:00"}\n')
    assert [tuple(r) for r in read_decisions(spark, str(tmp_path / "j.jsonl")).collect()] == [("1", "no")]
    pages = spark.createDataFrame([("p", "<table><tr><td>MCV Mean cell volume</td><td>平均体积</td></tr><tr><td>x</td></tr></table>")], "page_id string, html string")
    assert [tuple(r)[1:] for r in index_entries(pages, "html").collect()] == [("MCV", "Mean cell volume", "平均体积")]
    df = spark.range(5)
    manifest = write_package({"nodes": df, "edges": df.limit(0)}, str(tmp_path / "pkg"))
    assert {(r.name, r.n_rows) for r in manifest.collect()} == {("nodes", 5), ("edges", 0)} and changed_tables(spark, str(tmp_path / "pkg")).count() == 0
    df.write.mode("append").parquet(str(tmp_path / "pkg/nodes"))
    assert [r.name for r in changed_tables(spark, str(tmp_path / "pkg")).collect()] == ["nodes"]
