import numpy as np

from tomeflow.llm import graph_search as G


def test_search(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((20, 32))
    m = np.concatenate([c + 0.3 * rng.standard_normal((25, 32)) for c in centres]).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(900, None), (950, [0.0] * 32)]
    df = spark.createDataFrame(rows, "chunk_id long, vector array<float>")
    got = G.search(df, df.where("chunk_id % 25 = 0"), "chunk_id", "vector", dim=32).toPandas()
    u = m.astype(np.float64) / np.linalg.norm(m.astype(np.float64), axis=1, keepdims=True)
    want = set()
    for i in range(0, 500, 25):
        s = np.round(u @ u[i], 12)
        s[i] = -2
        want |= {(i, int(j)) for j in np.lexsort((np.arange(500), -s))[:5] if s[j] >= 0.7}
    pairs = set(zip(got.chunk_id, got.neighbour))
    assert len(pairs & want) / len(want) >= 0.9 and not {900, 950} & {x for p in pairs for x in p}
    ranked = got.sort_values(["chunk_id", "rank"])
    assert all((np.diff(g.similarity) <= 0).all() and list(g["rank"]) == list(range(1, len(g) + 1)) for _, g in ranked.groupby("chunk_id"))
    assert G.search(df, df.limit(0), "chunk_id", "vector", dim=32).count() == 0


def test_index_is_written_once(spark, tmp_path):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((5, 32))
    m = np.concatenate([c + 0.3 * rng.standard_normal((20, 32)) for c in centres]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "chunk_id long, vector array<float>")
    G.build_index(df, "chunk_id", "vector", dim=32).write(str(tmp_path / "index"))
    index, asked = G.Index.read(spark, str(tmp_path / "index")), df.where("chunk_id % 10 = 0")
    found = sorted(map(tuple, G.search_index(index, asked, "chunk_id", "vector", dim=32).collect()))
    assert found and found == sorted(map(tuple, G.search(df, asked, "chunk_id", "vector", dim=32).collect()))
