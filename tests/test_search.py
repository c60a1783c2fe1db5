import numpy as np

from tomeflow.operators import glossary, search
from tomeflow.operators.ordering import running_total
from tomeflow.sources.glossary import load_glossary


def test_glossary(spark, tmp_path):
    path = tmp_path / "g.yaml"
    path.write_text("KPI:\n  full: key figure\n  aliases: [measure, 3]\n指标: indicator\n", encoding="utf-8")
    g = load_glossary(spark, str(path))
    q = spark.createDataFrame([(1, "the kpi now"), (2, "SKPI999"), (3, None), (4, "KPI的定义"), (5, "指标"), (6, "")], "query_id int, question string")
    got = {r.query_id: r.expanded for r in glossary.expand(q, g).collect()}
    assert got == {1: "the kpi now key figure measure", 2: "SKPI999", 3: None, 4: "KPI的定义", 5: "指标 indicator", 6: ""}
    path.write_text("[broken", encoding="utf-8")
    assert load_glossary(spark, str(path)).count() == 0
    assert load_glossary(spark, str(tmp_path / "none")).count() == 0


def test_vector_topk(spark):
    rng = np.random.default_rng(0)
    m = rng.standard_normal((60, 8))
    m[7] = m[3]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(100, None), (101, []), (102, [0.0] * 8), (103, [float("nan")] * 8)]
    v = spark.createDataFrame(rows, "id long, vector array<double>")
    q = v.where("id in (3, 100)").withColumnRenamed("id", "q")
    got = [r.id for r in search.vector_topk(v, q, "id", "q", 5).orderBy("place").collect()]
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(u @ u[3], 4)
    assert got == sorted(range(60), key=lambda i: (-s[i], i))[:5]
    assert search.vector_topk(v, q.limit(0), "id", "q", 5).count() == 0


def test_vectors_of_several_lengths_and_blocks(spark, monkeypatch):
    """Vectors of different lengths have no similarity; blocks of queries give what all at once give."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(8 if i % 3 else 5)]) for i in range(90)]
    v = spark.createDataFrame(rows, "id long, vector array<double>")
    q = v.where("id < 40").withColumnRenamed("id", "q")
    whole = sorted(map(tuple, search.vector_topk(v, q, "id", "q", 4).collect()))
    assert len(whole) == 160 and all((a % 3 == 0) == (b % 3 == 0) for a, b, *_ in whole)
    monkeypatch.setattr(search, "BLOCK", 7)
    assert sorted(map(tuple, search.vector_topk(v, q, "id", "q", 4).collect())) == whole


def _search(spark, threshold=0.1):
    chunks = spark.createDataFrame([(1, "red pump in the hall", "a/x.md", "doc"), (2, "blue valve", "a/y.md", None), (3, None, "b", "SQL"), (4, "red red pump", "c", "doc")], "chunk_id int, text string, source string, doc_type string")
    q = spark.createDataFrame([(10, "red pump", "red pump"), (11, " ", " "), (12, None, None)], "query_id int, question string, expanded string")
    hits = search.hybrid_hits(q, search.build_index(chunks, "chunk_id", "text"), threshold=threshold)
    return search.answers(q, hits, chunks, "chunk_id")


def test_answers(spark):
    got = {r.query_id: r for r in _search(spark).collect()}
    assert got[10].found and got[10].results[0].text == "red red pump" and got[10].error is None
    assert got[11].error == "empty question" and got[12].error == "empty question" and got[12].confidence == "low"
    ctx = {r.query_id: r.context for r in search.as_context(_search(spark)).collect()}
    assert ctx[12] == "[知识库检索无结果]" and ctx[10].startswith("【知识片段 1】📄 c (相关度: ")


def test_running_total(spark):
    rows = [(g, i, i % 3) for g in ("a", "b", None) for i in range(200)]
    got = running_total(spark.createDataFrame(rows, "g string, i int, v long"), ["g"], ["i"], "v", "s").collect()
    for g in ("a", "b", None):
        mine = sorted((r.i, r.s) for r in got if r.g == g)
        assert [s for _, s in mine] == list(np.cumsum([i % 3 for i in range(200)]))
    assert running_total(spark.createDataFrame([], "g string, i int, v long"), ["g"], ["i"], "v", "s").count() == 0


def test_stored_tables_lie_with_their_application(spark):
    from pathlib import Path

    from tomeflow.functions import durable

    df = durable.stored(spark.range(3).toDF("i"), "x")
    own = Path(durable.shared_dir(spark).removeprefix("file:")) / "tomeflow" / spark.sparkContext.applicationId
    assert df.count() == 3 and any(p.name.startswith("x-") for p in own.iterdir())


def test_snapshots_are_added_once(spark, tmp_path):
    import pytest

    from tomeflow.functions.filesystem import Folder

    f = Folder(spark, str(tmp_path / "f"))
    assert f.names() == [] and f.names("m") == []
    f.add("m/1.json", "ä")
    assert f.read("m/1.json") == "ä" and f.names("m") == ["1.json"]
    with pytest.raises(FileExistsError):
        f.add("m/1.json", "other")
    assert f.read("m/1.json") == "ä" and f.names("m") == ["1.json"]
    f.remove("m")
    assert f.names() == []
