import pytest

from quillon.functions.units import readings, resolve
from quillon.operators.quantities import converted, normalize_quantities, unit_in_name, unit_in_words

GL = (("g/L", 1.0), ("g/dL", 10.0), ("mmol/L", 16.114))
COUNT = (("10^9/L", 1.0), ("/µL", 0.001))
SHARE = (("%", 1.0), ("ratio", 100.0))


@pytest.mark.parametrize("text", ["g/dL", "g / dL", "g per dL", "g·dL⁻¹", "ｇ/dL", "g／dL", "gm/dL", "g%", "g/100 mL", "g/dl"])
def test_spellings_of_one_unit(text):
    assert resolve(text, GL) == ("g/dL", 10.0)


@pytest.mark.parametrize("text, factor", [("10E9/L", 1.0), ("G/L", 1.0), ("x10^9/L", 1.0), ("10⁹/l", 1.0), ("K/µL", 1.0), ("/cumm", 0.001), ("cells/uL", 0.001), ("万/µL", 10.0)])
def test_counts(text, factor):
    assert resolve(text, COUNT)[1] == pytest.approx(factor)


def test_field_prior_decides_between_giga_and_gram():
    assert resolve("G/L", GL) == ("g/L", 1.0) and resolve("G/L", COUNT)[1] == 1.0


@pytest.mark.parametrize("text", ["", None, "HGB", "fasting", "no unit at all", "x" * 100, "/", "10^"])
def test_no_unit(text):
    assert resolve(text, GL) is None


def test_against_brute_force_of_prefix_and_root():
    scale = {"": 1.0, "m": 1e-3, "u": 1e-6, "n": 1e-9}
    for p, s in scale.items():
        for q, t in scale.items():
            assert readings(f"{p}mol/{q}L")[0][2] == pytest.approx(s / (t * 1e-3), rel=1e-6)


def test_units_in_names_and_remarks():
    assert unit_in_name("Albumin [g/dL]", GL) == ("g/dL", 10.0)
    assert unit_in_name("Basophil fraction", SHARE) is None
    assert unit_in_words("reported in g/dL per local sheet", GL) == ("g/dL", 10.0)
    assert unit_in_words("previous result 12.1 g/dL", GL) is None


def test_rows(spark):
    terms = spark.createDataFrame([("T1", "Hemoglobin", "g/L", "x")], "term_id string, standard_name string, default_unit string, unit string")
    conv = spark.createDataFrame([("T1", "g/dL", 10.0)], "term_id string, source_unit string, factor double")
    cols = "obs_id bigint, raw_name string, standard_name string, value string, unit string, unit_source string, ref_lower double, ref_upper double, remark string, received_at timestamp, term_id string"
    row = lambda i, v, u, src=None, lo=None, hi=None, name="HGB", remark=None: (i, name, "Hemoglobin", v, u, src, lo, hi, remark, None, "clash")
    data = [
        row(1, "13,5 H", "g/dL", "report", 12.0, 16.0), row(1, "13,5 H", "g/dL", "report", 12.0, 16.0), row(2, "<140", "g/L", None, 120.0, 160.0), row(3, "neg", "g/dL"), row(4, None, "g/dL"),
        row(5, "14.1", None, None, 12.0, 16.0), row(6, "141", None, None, None, 160.0), row(7, "14.1", None), row(8, "14.1", "g/L", "controlled_default", 12.0, 16.0), row(9, "１４．１g/dL", None),
        row(10, "14.1", "", None, name="HGB (g/dL)"), row(11, "14.1", None, remark="units: g/dL"), row(12, "1.4e1", "g/dL"), (13, None, None, "1", "g/dL", None, None, None, None, None, None), (14, "x", "Other", "1", "g/dL", None, None, None, None, None, None),
    ]
    out = normalize_quantities(spark.createDataFrame(data, cols), terms, conv)
    rows = {r.obs_id: r for r in out.collect()}
    assert len(rows) == out.count() == 12
    assert rows[1].value_normalized == 135.0 and rows[1].ref_upper_normalized == 160.0 and rows[2].factor == 1.0
    assert rows[3].value_num is None and rows[4].value_num is None
    assert (rows[5].unit_origin, rows[5].factor) == ("interval", 10.0) and (rows[6].unit_origin, rows[6].factor) == ("interval", 1.0)
    assert rows[7].unit_origin == "none" and rows[7].factor is None and rows[8].factor == 10.0
    assert [rows[i].unit_origin for i in (9, 10, 11)] == ["value", "raw_name", "remark"]
    assert {r.obs_id for r in converted(out).collect()} == {1, 5, 8, 9, 10, 11, 12}
    assert normalize_quantities(spark.createDataFrame([], cols), terms, conv).count() == 0


def test_unit_texts_that_are_no_unit_hide_nothing(spark):
    terms = spark.createDataFrame([("T1", "Hemoglobin", "g/L")], "term_id string, standard_name string, default_unit string")
    conv = spark.createDataFrame([("T1", "g/dL", 10.0)], "term_id string, source_unit string, factor double")
    cols = "obs_id bigint, raw_name string, standard_name string, value string, unit string, unit_source string, ref_lower double, ref_upper double, remark string"
    row = lambda i, v, u, name="HGB", remark=None, lo=None: (i, name, "Hemoglobin", v, u, "report", lo, None, remark)
    data = [row(1, "14", "see remark", remark="units: g/dL"), row(2, "14 g/dL", "-"), row(3, "14", " ? ", name="HGB (g/dL)"), row(4, "140", "g/L", remark="previous 12 g/dL", lo=120.0), row(5, "14", "-", lo=12.0), row(6, "14", "-"), row(7, "14", "gram per decilitre")]
    out = {r.obs_id: (r.unit_origin, r.factor) for r in normalize_quantities(spark.createDataFrame(data, cols), terms, conv).collect()}
    assert out == {1: ("remark", 10.0), 2: ("value", 10.0), 3: ("raw_name", 10.0), 4: ("unit", 1.0), 5: ("interval", 10.0), 6: ("none", None), 7: ("unit", 10.0)}


def test_too_many_conversions_are_refused(spark, monkeypatch):
    import quillon.operators.quantities as m

    monkeypatch.setattr(m, "MAX_TERMS", 1)
    terms = spark.createDataFrame([("T1", "Hemoglobin", "g/L")], "term_id string, standard_name string, default_unit string")
    conv = spark.createDataFrame([("T1", f"u{i}", float(i)) for i in range(51)], "term_id string, source_unit string, factor double")
    with pytest.raises(ValueError, match="conversions"):
        m.fields_of(terms, conv)
