import json

import numpy as np

from tomeflow.llm import splitting as S


def starts(text, kind):
    return S.Boundaries(text, kind).units


def test_units():
    sql = "-- a;\nSELECT ';' FROM t; -- b\nCREATE FUNCTION f() AS $x$ a; b; $x$;\n/* ; */ DROP TABLE t;\n"
    assert [sql[i:][:8] for i in starts(sql, "sql")] == ["-- a;\nSE", "-- b\nCRE", "/* ; */ "]
    yaml = "# c\na:\n- x: 1\n  y: |\n    z: 2\n\"b c\": 3\nd.e: f: g\n# n\n- k\nhttp://x: 1\n"
    assert [yaml[i:].split("\n")[0] for i in starts(yaml, "yaml")][1:] == ['"b c": 3', "d.e: f: g", "http://x: 1"]
    obj = ' {"a": {"x": [1, "}{"]}, "b\\"": "c, \\"d\\": 1", "e": null}'
    assert [obj[i:][:3] for i in starts(obj, "json")][1:] == ['"b\\', '"e"']
    assert starts("[1, 2]", "json") == [0] and starts('{"a": NaN, "b": 1}', "json") == [0]
    ini = "; c\n[a]\nx=1\n  [b:c]\n; [d]\n"
    assert [ini[i:].split("\n")[0] for i in starts(ini, "ini")] == ["; c", "[a]", "  [b:c]"]
    toml = '[a]  # t\nx = [\n  [1, 2],\n  [3]\n]\ns = """\n[no]\n"""\n[[b]]\n'
    assert [toml[i:].split("\n")[0] for i in starts(toml, "toml")] == ["[a]  # t", "[[b]]"]
    doc = "\n# h\ntext\n \n```\na\n\nb\n~~~\n```\n\nend\n"
    assert [doc[i:].split("\n")[0] for i in starts(doc, "doc")] == ["", "```", "end"]


def test_strongest_is_range_maximum():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("ab .\n"), 4000))
    b = S.Boundaries(text, "doc", 200)
    value = {p: int(b.table[0][k]) for k, p in enumerate(b.at)}
    for low in range(0, 3700, 37):
        inside = [p for p in b.at if low < p <= low + 150]
        assert b.strongest(low, low + 150) == (max(inside, key=value.get) if inside else low + 150)


def test_pieces():
    text = ("Sentence one is here. " * 30 + "\n\n") * 6
    for overlap in (0, 300):
        got = S.Boundaries(text, "doc").pieces(overlap)
        assert got[0][0] == 0 and got[-1][1] == len(text) and all(0 < b - a <= 1200 for a, b in got)
        assert all(x[1] - y[0] == overlap for x, y in zip(got, got[1:]))
    assert S.Boundaries("x" * 3000, "doc").pieces(0) == [(0, 1200), (1200, 2400), (2400, 3000)]
    assert S.Boundaries("", "sql").pieces(0) == [(0, 0)]


def test_no_slivers():
    """A lone unit behind the start doesn't win over good lines near the limit, but does over a broken line."""
    lines = "a line of some words that goes on to the end\n" * 100
    for text, kind, overlap in ((lines[:302] + "\n\n" + lines, "doc", 300), ("a: 1\nb:\n  " + lines.replace("\n", "\n  "), "yaml", 0)):
        got = S.Boundaries(text, kind).pieces(overlap)
        assert all(600 < b - a <= 1200 for a, b in got[:-1]) and all(text[b - 1] == "\n" for _, b in got[:-1]), kind
    assert S.Boundaries("a: 1\nb: " + "x" * 3000, "yaml").pieces(0)[0] == (0, 5)


def test_frames(spark):
    big = json.dumps({f"key{i}": "v" * 300 for i in range(8)})
    rows = [(1, "a.json", "h", 0, None, big, 1), (2, "a.json", "h", 1, None, "small", 1), (3, "a.json", "h", 0, "JSON", big, 2), (4, "b.md", "h", 0, "doc", None, 1), (5, None, None, None, None, "", None), (6, "a.json", "h", 2, "json", big, 1)]
    df = spark.createDataFrame(rows, "chunk_id long, source string, file_hash string, chunk_index int, doc_type string, text string, ingested_at int")
    cut = {r.chunk_id: r for r in S.split_oversized(df.withColumn("units", df.text)).collect()}
    assert set(cut) == {1, 3, 6} and len(cut[1].units) == 8
    got = S.rechunk(df).collect()
    index = {(r.chunk_id, r.piece_no): r.chunk_index for r in got}
    n = len({p for c, p in index if c == 1})
    assert index[1, 0] == 0 and index[3, 0] == 0 and index[6, 0] == n + 1
    assert "".join(r.text for r in sorted((r for r in got if r.chunk_id == 1), key=lambda r: r.piece_no)) == big
    assert S.split_oversized(df.limit(0)).count() == 0 and S.rechunk(df.limit(0)).count() == 0
