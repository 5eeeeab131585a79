from quillon.llm.mixing import mix, rake, shares_reached

TARGETS = [("big", 0.5, 2), ("small", 0.3, 4), ("tiny", 0.2, 2)]
SCHEMA = "doc_id bigint, source string, lang string, topic string, n_tokens int, uses string"


def test_rake_meets_the_margins():
    cells = {("a", "en", "x"): 100.0, ("a", "zh", "x"): 50.0, ("b", "en", "x"): 30.0, ("b", "zh", "y"): 20.0}
    w = rake(cells, {"a": 100.0, "b": 100.0}, {"a": 4, "b": 8})
    used = {c: w[c] * t for c, t in cells.items()}
    assert abs(sum(v for c, v in used.items() if c[0] == "a") - 100) < 1e-6 and abs(sum(v for c, v in used.items() if c[0] == "b") - 100) < 1e-6


def test_mix(spark):
    docs = [(i, "Big " if i % 3 else "BIG", "en" if i % 2 else "zh-CN", "t" if i % 5 else None, 50 + i % 90, "x") for i in range(1200)]
    docs += [(5000 + i, "small", None, None, 40 + i % 30, "x") for i in range(300)] + [(9000 + i, "tiny", "EN", "t", 30, "x") for i in range(20)]
    docs += [(9900, "other", "en", "t", 10, "x"), (9901, "small", "en", None, None, "x"), (9902, "small", "en", None, 0, "x")]
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    out = mix(spark.createDataFrame(docs, SCHEMA), targets, total=60_000)
    rows = out.collect()
    assert len(rows) == len({r.doc_id for r in rows}) == len(docs) - 1
    most = {s: m for s, _, m in TARGETS}
    assert all(0 <= r.uses <= most[r.source] for r in rows)
    got = {r.source: r for r in shares_reached(out, targets).collect()}
    assert abs(got["big"].tokens_used - 30_000) < 200 and abs(got["small"].tokens_used - 18_000) < 200
    assert got["tiny"].falls_short and got["tiny"].tokens_used == 1200 and not got["big"].falls_short


def test_empty(spark):
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    assert mix(spark.createDataFrame([], SCHEMA), targets).count() == 0


def test_a_source_with_two_targets_is_refused(spark):
    import pytest

    targets = spark.createDataFrame([*TARGETS, ("BIG", 0.1, 2)], "source string, target_share double, max_repeats int")
    with pytest.raises(ValueError, match="two targets"):
        mix(spark.createDataFrame([], SCHEMA), targets)
