from pyspark.sql import functions as F

from tomeflow.functions import text as T
from tomeflow.operators import chunking, clean


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "text string").select(f("text")).first()[0]


def test_readable(spark):
    rows = [("你好，世界。这里！", True), ("# title", True), ("one two three four five six seven eight nine tens eleven", None), ("ab cd", False), ("", False), ("  \u3000", False), (None, False)]
    got = [one(spark, t, T.is_readable) for t, _ in rows]
    assert got == [True, True, True, False, False, False, False]


def test_garbled_ratio(spark):
    assert one(spark, None, T.garbled_ratio) == 1.0
    assert one(spark, "", T.garbled_ratio) == 1.0
    assert one(spark, "abc\n", T.garbled_ratio) == 0.25
    assert one(spark, "字。 a1", T.garbled_ratio) == 0.0


def test_types_and_names(spark):
    row = spark.createDataFrame([("a\\b/c.CONF",)], "p string").select(T.extension("p").alias("e"), T.file_name("p").alias("f"))
    assert row.select("e", "f", T.doc_type(F.col("e")).alias("t")).first() == ("conf", "c.CONF", "ini")


def test_marker(spark):
    text = "<!-- x:source_ext=.sql -->\n```sql\nSELECT 1;\n```\n"
    assert one(spark, text, T.source_marker) == ".sql"
    assert one(spark, text, T.strip_marker) == "SELECT 1;"
    assert one(spark, "plain", T.source_marker) is None


def test_final_passes(spark):
    text = "| a | b |\n|  |  |\n\n\n\n<!-- x\ny -->end  "
    assert one(spark, text, lambda c: clean.final_passes(T.drop_blank_rows(c))) == "| a | b |\n\nend"
    assert one(spark, "| a | b |\r\n|\u3000|\xa0|\r\nend", T.drop_blank_rows) == "| a | b |\r\n\nend"
    assert one(spark, None, T.drop_blank_rows) is None


def test_tidy_rows():
    cases = {
        "no cells": "no cells", "": "", "|": "|", "| |": "", "|\u3000|\xa0|\r": "", " | | |": " |", "| a | b |  |  |": "| a | b |", "|  |  | a | b |": "| a | b |", "|a|": "| a|", "|---|---|": "| ---|---|",
        "| a |  | b |": "| a |  | b |", "| a |  |  | b |": "| a | | b |", "| a | | | | b |": "| a | | | b |", "| a | | | | | b |": "| a | | | b |", "a | b | |": "a | b |", "| a |  ": "| a |  ", "| a | | b": "| a | | b",
    }
    for line, want in cases.items():
        assert clean.tidy_row(line) == want, line


def test_boilerplate_in_spark_and_in_python(spark):
    """Columns and Python agree, white space of Unicode and line ends of Windows included."""
    yes = ["# 前 言", "## 目录", "# Contents of it", "版权所有", "© 2024 x", "All  Rights Reserved.", "Confidential", "版 本 ： 2", "版\u3000本号", "修 订 记 录", "作者：x", "第 12 页", "Page  3", "— 4 —", "-5-", "用户手册 v", "文档版本 2", "③ x"]
    no = ["前言", "# 前沿", "Page", "Page3", "第 页", "— x —", "© x", "文档版本", "版本", "text", "", "--", "Pages 3"]
    lines = [f"{a}{x}{b}" for x in yes + no for a, b in (("", ""), ("\u3000 ", "\r"))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = [r[0] for r in df.orderBy("i").select(T.is_boilerplate(F.col("line"))).collect()]
    assert got == [clean.boilerplate(x.strip()) for x in lines] == [x.strip() in [y.strip() for y in yes] for x in lines]


def test_contents():
    for line in ("目录", "# 目 录", "## 目　录", "# 録", "Contents", "# Contents"):
        assert clean.opens_contents(line), line
    for line in ("记录", "# 记录", "the Contents", "# 目录外" * 0 + "# 附录"):
        assert not clean.opens_contents(line), line
    for line in ("", "....", "… ·", "1.2 概要 …… 12", "1 概要12x . 3", "1. 概要", "三、维护", "12．x"):
        assert clean.in_contents(line), line
    for line in ("text", "1.2 概要", "1. two words", "1. " + "x" * 41, "1.", "概要 … 3", "1..2 概要 . 3", "1.2. 概要 . 3"):
        assert not clean.in_contents(line), line


def test_clean(spark):
    toc = "# 目录\n1. 概要\n2. 安装\n3. 维护\n# Text\nAll rights reserved\nWords."
    assert one(spark, toc, clean.clean_markdown) == "# Text\nWords."
    assert one(spark, None, clean.clean_markdown) is None
    assert one(spark, "  ", clean.clean_markdown) == "  "
    assert "目录" in one(spark, toc, lambda c: clean.clean_markdown(c, False))


def test_tables():
    assert clean.compact_table(["| a |  | b |  | 0 |", "|  | 0 |"]) == ["| a |  | b |  |"]  # empty cells go before zeros do, and only once
    assert clean.compact_table(["| 0 |  |"]) == []
    assert clean.compact_table(["| a | b |  |", "| --- | --- | --- |", "| 1 | 2 |  |", "|  |  |  |"]) == ["| a | b |", "|---|---|", "| 1 | 2 |"]
    assert clean.compact_table(["| a |", "| --- |"]) == ["| a |", "| --- |"]


SQL = "-- head; x\nCREATE TABLE a (b text DEFAULT ';');\n/* ; */ CREATE TABLE c (d int);\nCREATE INDEX i ON a (b)"


def test_pieces():
    assert len(chunking.sql_statements(SQL)) == 3
    assert chunking.sql_statements(SQL)[-1] == "CREATE INDEX i ON a (b)"
    assert chunking.yaml_keys("# c\na: 1\nb:\n  x: 2\nd: 3") == ["# c\na: 1", "b:\n  x: 2", "d: 3"]
    assert chunking.ini_sections("; c\n[a]\nx=1\n[b]\ny=2") == ["; c", "[a]\nx=1", "[b]\ny=2"]
    assert len(chunking.json_keys('{"a": 1, "b": {"c": 2}, "d": []}')) == 3
    assert chunking.chunk_text("{broken", "json") == ["{broken"]


def test_grouping():
    assert chunking.grouped(["a" * 10] * 3, 100) == ["\n\n".join(["a" * 10] * 3)]
    parts = chunking.grouped(["b" * 250], 100)
    assert len(parts) == 3 and "".join(parts) == "b" * 250
    assert chunking.grouped(["", "\n"], 5) == []


def test_prose_chunks():
    text = "# A\n\n" + "word " * 900
    parts = chunking.prose(text)
    assert all(len(p) <= 1200 for p in parts) and parts[0].startswith("# A")
    assert chunking.prose("x" * 3000)[0] == "x" * 1200


def test_chunk_frame(spark):
    docs = spark.createDataFrame([("a.sql", "h", "sql", SQL, 1), ("b.md", "h", "doc", None, 2), ("c.md", "h", "doc", " ", 3), ("d.md", "h", "doc", "hi", 4)], "source string, file_hash string, doc_type string, text string, chunk_index int")
    rows = chunking.chunk(docs).collect()
    assert sorted((r.source, r.chunk_index, r.chunk_total) for r in rows) == [("a.sql", 0, 1), ("d.md", 0, 1)]
    assert chunking.chunk(docs.limit(0)).count() == 0


def test_hard_slices(spark):
    df = spark.createDataFrame([(1, "x" * 2500), (2, ""), (3, None)], "k int, text string")
    rows = chunking.hard_slices(df, "k", "text").orderBy("chunk_index").collect()
    assert [len(r.text) for r in rows] == [1200, 1200, 100]
