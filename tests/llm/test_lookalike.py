import unicodedata

import pytest

from quillon.llm.lookalike import Trie, by_table, canonical_forms, vocabulary_of

VOCAB = [("Hemoglobin", "T1"), ("Hémoglobine", "T1"), ("C-reactive protein", "T2"), ("血糖测定值", "T3"), ("MCH", "T4"), ("Same", "T5"), ("Same", "T6")]


@pytest.mark.parametrize(
    "text, owner",
    [("Ｈｅｍｏｇｌｏｂｉｎ", "T1"), ("Неmоglоbіn", "T1"), ("Hemo​glo­bin", "T1"), (unicodedata.normalize("NFD", "Hémoglobine"), "T1"), ("C‑reactive protein", "T2"), ("⾎糖测定值", "T3"), ("ΜСН", "T4"), ("  MCH ", "T4")],
)
def test_same_look(text, owner):
    assert [(c, o) for c, _, o in Trie(VOCAB).walk(text)] == [(0, owner)]


@pytest.mark.parametrize("text", ["hemoglobin", "Hemoglobine", "Hemoglobinn", "C-reactive  protein", "Hemog1obin", "", "​", "Hemoglobin²"])
def test_other_look(text):
    assert Trie(VOCAB).walk(text) == []


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_brute_force():
    words = ["abc", "abd", "axc", "bcd", "abcd", "a", "cab"]
    trie = Trie([(w, w) for w in words])
    for text in ("abc", "ab", "acb", "zzz", "abcde", "ca"):
        for budget in (0, 1, 2):
            expected = {(w, _distance(text, w)) for w in words if _distance(text, w) <= budget}
            assert {(w, c) for c, w, _ in trie.walk(text, budget)} == expected, (text, budget)


def test_table():
    assert by_table("Ｆｅ　Сеll‍ ") == "Fe Cell"


def test_records(spark):
    terms = spark.createDataFrame([("T1", "Hemoglobin", None, ["Hb", None]), ("T2", "Same", "S", None)], "term_id string, standard_name string, abbreviation string, aliases array<string>")
    vocabulary = vocabulary_of(terms, "term_id", ["standard_name", "abbreviation"], ["aliases"])
    assert vocabulary == [("Hb", "T1"), ("Hemoglobin", "T1"), ("S", "T2"), ("Same", "T2")]
    rows = [("a", "Неmoglobin", ["Hb", None, "Hb"], "x"), ("a", "Неmoglobin", ["Hb"], "x"), ("b", None, None, "y"), ("c", "", ["ｚ" * 3000], "z")]
    df = spark.createDataFrame(rows, "id string, n string, al array<string>, text string")
    out = {tuple(r) for r in canonical_forms(df, "id", "n", "al", vocabulary).collect()}
    assert out == {("a", "Неmoglobin", "Hemoglobin", "T1", "look_alike"), ("a", "Hb", "Hb", "T1", "exact"), ("c", "", "", None, "table"), ("c", "ｚ" * 3000, "z" * 3000, None, "table")}
    assert canonical_forms(df.limit(0), "id", "n", "al", vocabulary).count() == 0
