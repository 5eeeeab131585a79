import pytest

from quillon.llm.mapping import map_values, tokens_of

ENTRIES = [
    ("Serum albumin", "T1"), ("ALBU", "T1"), ("Albumin", "T1"), ("Albumine sérique", "T1"), ("Hemoglobin", "T2"), ("HGB", "T2"), ("Eosinophil count", "T3"), ("EOS#", "T3"),
    ("Eosinophil fraction", "T4"), ("EOS%", "T4"), ("Red cell count", "T5"), ("血糖测定值", "T6"), ("Red cell distribution width", "T7"), ("Protéines totales", "T8"),
]
CASES = {
    "albumin": "T1", "S-Albumin": "T1", "Serum album.": "T1", "Seru malbumin": "T1", "sérique, Albumine": "T1", "Albuminexserique": "T1", "A.L.B.U.": "T1", "ALBU/Albumin": "T1", "Albumin (g/L)": "T1",
    "АLВU": "T1", "Hemoglobin, fasting": "T2", "Hgb*": "T2", "Hemolgobin": "T2", "EOS#": "T3", "eos%": "T4", "Redcellcount": "T5", "⾎糖测定值": "T6", "血糖测定": "T6", "Protéines total.": "T8",
    "Fetal hemoglobin band": None, "Carboxyhemoglobin": None, "???": None, "": None, "n.n.": None, "repeat": None, "Zinc": None,
}


def test_mapping(spark):
    values = spark.createDataFrame([(v, 1) for v in [*CASES, "albumin"]] + [(None, 2)], "value string, key int")
    out = map_values(values, ENTRIES)
    got = {r.value: r.key for r in out.collect()}
    assert got == CASES and out.count() == len(CASES)


def test_empty_and_long(spark):
    schema = "value string"
    assert map_values(spark.createDataFrame([], schema), ENTRIES).count() == 0
    assert map_values(spark.createDataFrame([("word " * 5000,)], schema), ENTRIES).first().key is None


@pytest.mark.parametrize("text, tokens", [("A.B.C. x", ["abc", "x"]), ("Time, s", ["time"]), ("", []), ("D-dimère", ["d", "dimere"])])
def test_tokens(text, tokens):
    assert [t for t, _ in tokens_of(text)] == tokens
