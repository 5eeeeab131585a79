import pytest

from quillon.llm.page_noise import _explains, hanzi, page_noise, roman

SCHEMA = "page_id string, document_id string, chapter_id string, chapter_page_index int, printed_page_number int, source_pdf_page_number int, raw_text string, noise string"
BODY = "The management review was closed after the weekend. The control\nchart was kept separate from the review and the table was read\nagain by the senior technician in the morning of that day."


@pytest.mark.parametrize("n, r, h", [(4, "iv", "四"), (19, "xix", "十九"), (48, "xlviii", "四十八"), (105, "cv", "一百零五"), (240, "ccxl", "二百四十")])
def test_notations(n, r, h):
    assert roman(n) == r and hanzi(n) == h


@pytest.mark.parametrize("read, true, yes", [("rnorning", "morning", True), ("culturc", "culture", True), ("follovvs", "follows", True), ("morning", "morning", False), ("evening", "morning", False), ("deadhne", "deadline", True)])
def test_confusions(read, true, yes):
    assert _explains(read, true) is yes


def page(i, text, n=None, **k):
    return (f"b:c:{i:04d}", "b", k.get("chapter", "c"), i, n, 10 + i, text, "clash")


def test_pages(spark):
    rows = [page(1, "# On Control\n\n" + BODY + "\n11", 11)]
    for i in range(2, 12):
        head = "Notes from the Bench" if i % 2 else "On Control"
        rows.append(page(i, f"{head}\n\n{BODY}\n{BODY}\n\n{10 + i}", 10 + i if i != 5 else None))
    rows[3] = page(4, "ON CONTROL\r\n\r\n" + BODY.replace("\n", "\r\n") + "\r\nl4", 14)
    rows[5] = page(6, "On Con | 16\n" + BODY.replace("morning", "rnorning"), 16)
    rows[6] = page(7, "N o t e s f r o m t h e B e n c h\n" + BODY + "\nThe manage-", 17)
    rows[7] = page(8, "On Control\nment review was closed.\n| tab1e | b |\n1) the tab1e was kept\n- 18 -", 18)
    rows[8] = page(9, "Notes from the Bench\n" + BODY.replace("senior technician", "senior tech-\nnician") + "\n199", 19)
    rows += [rows[2], page(12, None), page(13, "")]
    out = {(int(r.page_id[-4:]), r.line_no, r.noise) for r in page_noise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {(i, 1, "running_header") for i in range(2, 12)} <= out and not any(x[:2] == (1, 1) for x in out)
    assert {(1, 6, "page_number"), (4, 6, "page_number"), (6, 1, "page_number"), (8, 5, "page_number"), (5, 10, "page_number")} <= out
    assert not any(x[0] == 9 and x[2] == "page_number" for x in out)
    assert {x for x in out if x[2] == "misread"} == {(6, 4, "misread")}
    assert {x for x in out if x[2] == "broken_word"} == {(7, 5, "broken_word"), (9, 4, "broken_word")}


def test_empty(spark):
    assert page_noise(spark.createDataFrame([], SCHEMA)).count() == 0


def test_both_ways_to_the_pieces_agree(spark, monkeypatch):
    import quillon.llm.page_noise as m

    rows = [page(i, f"Notes from the Bench\n\n{BODY}\n{BODY.replace('morning', 'rnorning') if i == 3 else BODY}\n\n{10 + i}", 10 + i) for i in range(2, 12)]
    df = spark.createDataFrame(rows, SCHEMA)
    few = {tuple(r) for r in page_noise(df).collect()}
    monkeypatch.setattr(m, "MOST_SENT", 0)
    assert {tuple(r) for r in page_noise(df).collect()} == few and (f"b:c:{3:04d}", 8, "misread") in few


def test_paragraphs(spark):
    from quillon.llm.page_noise import repaired_paragraphs

    # every page begins with a line of its own, else its first line would repeat through the book like a header
    rows = [page(i, f"Notes from the Bench\n\nIt was begun by {'abcdefghijkl'[i]}.\n{BODY.replace('senior technician', 'senior tech-' + chr(10) + 'nician') if i == 4 else BODY}\n\n| a | b |\n| c | d |\n1) one\n2) two\n{10 + i}", 10 + i) for i in range(2, 12)]
    rows[3] = page(5, f"Notes from the Bench\n\nIt was begun by f.\n{BODY.replace('morning', 'rnorning')}\n15", 15)
    out = {(int(r.page_id[-4:]), r.paragraph_no): r for r in repaired_paragraphs(spark.createDataFrame(rows, SCHEMA)).collect()}
    flowing = BODY.replace("\n", " ")
    assert [out[(i, 1)].text.split(". ", 1)[1] for i in (2, 4, 5)] == [flowing] * 3 and not out[(2, 1)].goes_on
    assert out[(2, 2)].text == "| a | b |\n| c | d |" and [out[(2, k)].text for k in (3, 4)] == ["1) one", "2) two"]
    assert (5, 2) not in out


def test_notations_have_no_largest_number(spark):
    from pyspark.sql import functions as F

    from quillon.llm.page_noise import _notations, skeleton

    assert (hanzi(1008), hanzi(1010), hanzi(1234), hanzi(10203), hanzi(101000)) == ("一千零八", "一千零一十", "一千二百三十四", "一万零二百零三", "十万一千") and roman(1944) == "mcmxliv"
    ns = [*range(1, 3200), 9999, 10000, 10010, 12345, 20034, 99999, 100200, 101000, 100000001, 2147483647]
    df = spark.createDataFrame([(n, hanzi(n), roman(n) if n < 99999 else None) for n in ns], "n int, h string, r string")
    out = df.withColumns(_notations(F.col("n"))).withColumn("s", skeleton(F.col("r")))
    assert out.filter("not (arabic = cast(n as string) and hanzi = h and (s is null or roman = s))").count() == 0
    assert spark.createDataFrame([(0,), (-3,), (None,)], "n int").withColumns(_notations(F.col("n"))).filter("coalesce(arabic, roman, hanzi, ciphers) is not null").count() == 0


def test_pages_beyond_999(spark):
    text = {1000: "m", 1001: "一千零一", 1002: "1OO2", 1003: "一〇〇三", 1004: "- 1004 -", 1005: "mv", 1838: "mdcccxxxviii", 288: "cclxxxviii", 1888: "MDCCCLXXXVIII  Notes from the Bench", 12345: "第一万二千三百四十五页"}
    rows = [page(i, f"It was begun by {i}.\n{BODY}\n{x}" if "  " not in x else f"{x}\nIt was begun by {i}.\n{BODY}", n) for i, (n, x) in enumerate(text.items(), 2)]
    rows += [page(20 + i, f"Notes from the Bench\nIt was begun by {i}.\n{BODY}\nmv", 2000 + i) for i in range(3)]
    out = {(int(r.page_id[-4:]), r.noise) for r in page_noise(spark.createDataFrame(rows, SCHEMA)).collect() if r.noise in ("page_number", "running_header")}
    assert {i for i, x in out if x == "page_number"} == set(range(2, 12))
    assert (10, "running_header") in out


def test_long_words_and_pieces_are_judged(spark):
    long = "un" + "characteristic" * 4 + "morning"  # over 60 letters
    rows = [page(i, f"Notes from the Bench\n\nIt was begun by {'abcdefghijkl'[i - 2]}.\nThe {long.replace('morning', 'rnorning') if i == 3 else long} was kept.\n{'；'.join(['morning'] * 40)} {'a/' * 150}rnorning\n\n{10 + i}", 10 + i) for i in range(2, 60) if i < 14]
    rows = [(*r[:6], r[6].replace("a/" * 150 + "rnorning", ("a/" * 150 + "rnorning") if r[3] == 4 else "x"), r[7]) for r in rows]
    out = {(int(r.page_id[-4:]), r.line_no) for r in page_noise(spark.createDataFrame(rows, SCHEMA)).collect() if r.noise == "misread"}
    assert out == {(3, 4), (4, 5)}


def test_a_long_word_broken_at_the_end_of_a_line(spark):
    half = "deoxy" * 12
    rows = [page(i, f"It was begun by {'abcdefghijkl'[i - 2]}.\nThe {half}ribose was read.\n" + (f"It was the {half}-\nribose that counted.\n" if i == 5 else "") + str(10 + i), 10 + i) for i in range(2, 12)]
    assert [(r.page_id[-4:], r.line_no) for r in page_noise(spark.createDataFrame(rows, SCHEMA)).collect() if r.noise == "broken_word"] == [("0005", 3)]


def test_every_method_is_small_enough_to_be_compiled(spark, monkeypatch):
    import quillon.llm.page_noise as m

    real, sizes = m.stored, {}

    def methods(df, name):
        def walk(plan):
            if plan.nodeName().startswith("WholeStageCodegen"):
                compiled = spark._jvm.org.apache.spark.sql.catalyst.expressions.codegen.CodeGenerator.compile(plan.doCodeGen()._2())
                sizes[name] = max(sizes.get(name, 0), compiled._2().maxMethodCodeSize())
            for i in range(plan.children().size()):
                walk(plan.children().apply(i))

        walk(df._jdf.queryExecution().executedPlan())
        return real(df, name)

    monkeypatch.setattr(m, "stored", methods)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        page_noise(spark.createDataFrame([page(i, f"Notes from the Bench\n{BODY}\n{10 + i}", 10 + i) for i in range(2, 6)], SCHEMA)).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(sizes) > 20 and {k: v for k, v in sizes.items() if v > 8000} == {}  # the JVM leaves larger methods uncompiled


def test_lines_beside_a_line_and_blocks(spark):
    from quillon.llm.page_noise import page_lines

    text = "One  \r\n\n```\n| a |\n $$\n1. x\n```\n\t| a | b |\n:---|\n2) two\nlast $$\n\t\x0b7. seven\nend | of"
    df = spark.createDataFrame([page(1, text), page(2, "alone"), page(3, "$$\nx"), page(4, "")], SCHEMA)
    out = {(int(r.page_id[-4:]), r.line_no): r for r in page_lines(df).collect()}
    assert [out[1, i].kind for i in range(1, 14)] == ["prose", "blank", "block", "block", "block", "block", "block", "table", "table", "list", "prose", "list", "prose"]
    assert [(out[1, i].before, out[1, i].after) for i in (1, 2, 10, 13)] == [(None, ""), ("One", "```"), (":---|", "last"), ("seven", None)]
    assert [(out[1, i].top, out[1, i].bottom) for i in (1, 3, 4, 5, 11, 12, 13)] == [(1, 4), (2, 4), (3, 4), (4, 4), (4, 3), (4, 2), (4, 1)]
    assert (out[2, 1].before, out[2, 1].after, out[2, 1].top, out[2, 1].bottom) == (None, None, 1, 1)
    assert [out[3, i].kind for i in (1, 2)] == ["block", "block"] and out[4, 1].kind == "blank"
