import pytest
from hypothesis import given, settings, strategies as st

from quillon.llm.splitting import cut_points, split_items

TEXT = st.text(alphabet="ab c.\n|$`é́一。", max_size=600)


def pieces(text, most, overlap):
    out, at = [], 0
    for end, _ in cut_points(text, most, overlap):
        out.append((at, end))
        at = end
    return out


@given(TEXT, st.integers(20, 120), st.integers(0, 9))
@settings(max_examples=300, deadline=None)
def test_round_trip_and_size(text, most, overlap):
    parts = pieces(text, most, overlap)
    assert "".join(text[a:b] for a, b in parts) == text
    assert all(b - a + (overlap if i else 0) <= most for i, (a, b) in enumerate(parts))
    assert all(b > a for a, b in parts) or text == ""
    assert len(parts) > 1 if len(text) > most else len(parts) == 1


def test_natural_boundaries_and_protected_zones():
    table = "".join(f"| r{i} | {i} |\n" for i in range(20))
    text = "First sentence here. Second one there.\n\n" * 6 + table + "Tail sentence. " * 30
    a = text.index("| r0"), text.index("Tail")
    for end, how in cut_points(text, 400, 20)[:-1]:
        assert not a[0] < end < a[1] and how in ("paragraph", "line", "sentence")


def test_an_edit_moves_only_neighbouring_cuts():
    import random

    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(6000)]
    text = " ".join(w + ("." if rnd.random() < 0.1 else "") for w in words)
    new = text[:9000] + " an edit of some words here." + text[9000:]
    shift = len(new) - len(text)
    old = {e for e, _ in cut_points(text, 900, 60)}
    moved = {e - shift if e > 9000 else e for e, _ in cut_points(new, 900, 60)}
    assert len(old & moved) >= 0.85 * len(old)


def test_rows(spark):
    df = spark.createDataFrame([("a", "x" * 100), ("a2", "x" * 101), ("b", None), ("c", ""), ("d", "y" * 5000)], "item_id string, text string")
    out = split_items(df, 100, 10).collect()
    assert {r.item_id for r in out} == {"a2", "d"}
    d = sorted((r for r in out if r.item_id == "d"), key=lambda r: r.piece_no)
    assert all(len(r.text) <= 100 for r in d) and "".join(r.text[r.overlap :] for r in d) == "y" * 5000
    assert split_items(df.limit(0), 100, 10).count() == 0
    with pytest.raises(ValueError):
        cut_points("x" * 200, 100, 50)
