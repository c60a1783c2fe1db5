import numpy as np
import pytest

from tomeflow.llm import neighbours as N


def brute(ids, m, k, least):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    out = set()
    for i, a in enumerate(ids):
        for j in sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[i, j], ids[j]))[:k]:
            if s[i, j] >= least:
                out.add((min(a, ids[j]), max(a, ids[j])))
    return out


@pytest.mark.parametrize("cell", [64, 1024])
def test_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(N, "BLOCK", cell)
    monkeypatch.setattr(N, "CELL", cell)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((25, 32))
    m = np.concatenate([c + 0.35 * rng.standard_normal((30, 32)) for c in centres] + [rng.standard_normal((150, 32))]).astype(np.float32)
    m[5:20] = m[4]  # equal vectors, more of them than neighbours asked for
    m[40] = m[41] * 2
    ids = [int(x) for x in rng.permutation(len(m)) * 3]
    rows = [(i, [float(x) for x in v], "x") for i, v in zip(ids, m)] + [(9001, None, ""), (9002, [], ""), (9004, [0.0] * 32, ""), (9005, [float("nan")] * 32, ""), (9006, [1.0] * 31, "")]
    df = spark.createDataFrame(rows, "chunk_id long, vector array<float>, node string")
    got = {(r.chunk_id_a, r.chunk_id_b) for r in N.similar_pairs(df, "chunk_id", "vector", dim=32).collect()}
    want = brute(ids, m.astype(np.float64), 5, 0.70)
    assert len(got & want) / len(want) >= 0.97 and len(got & want) / len(got) >= 0.97
    assert N.similar_pairs(df.limit(0), "chunk_id", "vector", dim=32).count() == 0


def test_no_node_is_dropped(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "CELL", 8)
    rng = np.random.default_rng(7)
    m = rng.standard_normal((400, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "chunk_id long, vector array<float>")
    found = N.nodes(df, "chunk_id", "vector", 32)
    graph = N.first_graph(found, 0.99)
    assert graph.count() == 400 and {r.n for r in graph.selectExpr("size(links) n").collect()} == {N.FEW}
    assert N._cells(graph, found.coded, found).select("node").distinct().count() == 400
    assert N._cells(graph.where("node % 2 = 0"), found.coded, found).count() == 400


def test_orders_grow():
    assert N.orders_for(0) == N.orders_for(20_000) == N.ORDERS
    assert N.orders_for(20_000_000) > N.orders_for(2_000_000) > N.orders_for(200_000) > N.ORDERS


def test_equal_vectors_for_any_k(spark):
    """A group of equal vectors is larger than k + 1: each row still has k neighbours, the smallest ids but its own."""
    df = spark.createDataFrame([(i, [1.0] * 8) for i in range(30)] + [(50, [-1.0] * 8)], "chunk_id long, vector array<float>")
    for k in (1, 5, 10):
        got = N.neighbours(df, "chunk_id", "vector", k=k, dim=8).toPandas()
        want = {(i, j) for i in range(30) for j in [x for x in range(30) if x != i][:k]}
        assert set(zip(got.chunk_id, got.neighbour)) == want and len(got) == 30 * k


def test_slices(spark, monkeypatch):
    """What a cell reaches is compared a slice at a time, with the same result."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((10, 32))
    m = np.concatenate([c + 0.4 * rng.standard_normal((40, 32)) for c in centres]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "chunk_id long, vector array<float>")
    whole = set(map(tuple, N.similar_pairs(df, "chunk_id", "vector", dim=32).collect()))
    monkeypatch.setattr(N, "SLICE", 37)
    assert set(map(tuple, N.similar_pairs(df, "chunk_id", "vector", dim=32).collect())) == whole and len(whole) > 500
    ids, codes = np.arange(90), rng.standard_normal((90, 16)).astype(np.float32)
    one = N._links(ids[:20], codes[:20], ids, codes, 7, 0.1)
    monkeypatch.setattr(N, "SLICE", 1000)
    other = N._links(ids[:20], codes[:20], ids, codes, 7, 0.1)
    assert one[0].to_pylist() == other[0].to_pylist() and np.allclose(one[1].flatten(), other[1].flatten())


def test_rounds_end(spark, monkeypatch):
    """Rounds end when at most the given share of links is new, and at the latest after the given number."""
    rng = np.random.default_rng(9)
    m = rng.standard_normal((300, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "chunk_id long, vector array<float>")
    found, taken = N.nodes(df, "chunk_id", "vector", 32), []
    descend = N.descend
    monkeypatch.setattr(N, "descend", lambda *a: taken.append(a[-1]) or descend(*a))
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "CELL", 32)
    monkeypatch.setattr(N, "ROUNDS", 3)
    for share, want in ((1.0, ["links"]), (-1.0, ["links", "fresh", "fresh"])):
        taken.clear()
        monkeypatch.setattr(N, "FRESH", share)
        graph = N.settled_graph(found, 0.2)
        assert taken == want and graph.columns == ["node", "links", "sims"] and graph.count() == 300
