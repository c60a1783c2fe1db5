import json

from tomeflow import cli
from tomeflow.functions.registry import register


def test_cli(spark, tmp_path, capsys):
    src, out = tmp_path / "s", tmp_path / "o"
    src.mkdir()
    (src / "a.md").write_text("# Pump\n\nThe red pump stands in the north hall and is checked every single week.")
    (src / "b.docx").write_bytes(b"no zip")
    run = lambda *a: (cli.main([str(src), str(out), *a], spark), [json.loads(x) for x in capsys.readouterr().out.splitlines()])[1]
    assert run("build") == [{"reason": "new", "files": 2}]
    assert {r["stage"]: r["ok"] for r in run("status")} == {"conversion": 1, "ingestion": 1}
    assert len(run("list-failed")) == 2 and run("stats") == [{"total_chunks": 1, "file_count": 1}]
    assert run("check")[0]["rel_path"] == "b.docx" and run("sources") == [{"source": "a.md", "chunks": 1}]
    got = run("search", "red pump", " ")
    assert got[0]["hits"] in (0, 1) and got[1]["error"] == "empty question"
    assert run("delete", "--prefix", "a") == [{"sources": 1, "chunks": 1}] and run("stats")[0]["total_chunks"] == 1
    run("delete", "--prefix", "a", "--yes")
    assert run("stats")[0]["total_chunks"] == 0


def test_sql_functions(spark):
    register(spark)
    df = spark.createDataFrame([("a.SQL", "SELECT 1; SELECT 2;"), ("b", None)], "p string, t string")
    df.createOrReplaceTempView("_docs")
    assert spark.sql("SELECT file_extension(p) e, garbled_ratio(t) g, cjk_punctuation(t) c, utrim(' x ') u FROM _docs WHERE p = 'a.SQL'").first() == ("sql", 0.0, 0, "x")
    assert spark.sql("SELECT p, c.text FROM _docs, LATERAL chunk_sql(t) c").collect() == [("a.SQL", "SELECT 1;\n\nSELECT 2;")]
    assert spark.sql("SELECT without_boilerplate('All rights reserved')").first()[0] == ""
