from datetime import datetime as dt

from quillon.operators.references import orphan_references

REFS = "k string, a string, b string, at timestamp"
TARGETS = "a string, b string, made timestamp, gone timestamp, k string"


def found(df):
    return {tuple(r) for r in df.collect()}


def test_reasons_nulls_repeats_and_extra_columns(spark):
    refs = spark.createDataFrame(
        [("r1", "x", None, dt(2024, 1, 5)), ("r1", "x", None, dt(2024, 1, 5)), ("r2", "y", None, dt(2024, 2, 1)), ("r3", "z", None, dt(2024, 3, 1)), ("r4", None, None, dt(2024, 1, 1)), ("r5", "w", None, dt(2024, 1, 1)), ("r6", "x", None, None)], REFS
    )
    targets = spark.createDataFrame(
        [("x", None, dt(2024, 1, 1), None, "clash"), ("y", None, dt(2024, 1, 1), dt(2024, 1, 2), ""), ("z", None, dt(2024, 4, 1), None, ""), ("z", None, dt(2024, 1, 1), dt(2024, 1, 9), ""), (None, None, dt(2024, 1, 1), None, "")], TARGETS
    )
    out = found(orphan_references(refs, ["a"], targets, ["a"], "k", "at", "made", "gone"))
    assert out == {("r2", "2024-02", "deleted"), ("r5", "2024-01", "missing"), ("r6", None, "late")}


def test_match_semantics_of_partial_nulls(spark):
    t0 = dt(2024, 1, 1)
    refs = spark.createDataFrame([("1", "x", "p", t0), ("2", "x", "q", t0), ("3", "x", None, t0), ("4", None, "q", t0), ("5", None, None, t0)], REFS)
    targets = spark.createDataFrame([("x", "p", t0, None, "")], TARGETS)
    keys = (["a", "b"], targets, ["a", "b"], "k", "at", "made", "gone")
    assert {r[0] for r in found(orphan_references(refs, *keys, match="simple"))} == {"2"}
    assert {r[0] for r in found(orphan_references(refs, *keys, match="partial"))} == {"2", "4"}
    full = found(orphan_references(refs, *keys, match="full"))
    assert {(r[0], r[2]) for r in full} == {("2", "missing"), ("3", "mixed_null"), ("4", "mixed_null")}


def test_empty_tables(spark):
    refs = spark.createDataFrame([("1", "x", None, dt(2024, 1, 1))], REFS)
    none = spark.createDataFrame([], TARGETS)
    assert found(orphan_references(refs, ["a"], none, ["a"], "k", "at", "made", "gone")) == {("1", "2024-01", "missing")}
    assert found(orphan_references(refs.limit(0), ["a"], none, ["a"], "k", "at", "made", "gone")) == set()


def test_hot_key_takes_the_broadcast_path_with_the_same_result(spark, monkeypatch):
    import quillon.operators.joins as joins

    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    refs = spark.range(40).selectExpr("cast(id as string) k", "if(id < 30, 'hot', concat('c', id)) a", "cast(null as string) b", "timestamp'2024-01-01' at")
    targets = spark.createDataFrame([("hot", None, dt(2023, 1, 1), dt(2023, 2, 1), ""), ("c31", None, dt(2023, 1, 1), None, "")], TARGETS)
    out = found(orphan_references(refs, ["a"], targets, ["a"], "k", "at", "made", "gone"))
    assert {r[2] for r in out if int(r[0]) < 30} == {"deleted"} and len(out) == 39
