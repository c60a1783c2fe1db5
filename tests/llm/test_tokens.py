import numpy as np
import pytest

from tomeflow.llm import bpe, budget, packing, tokens

TEXTS = [
    None, "", " ", "\n\n \t x", "Hello, world's  best!", "你好，世界。泵在这里！" * 3, "naïve Ünïcödé 　 \x1c \x85 x", "a" * 500 + " " * 300 + "1234567890" * 20, "<|endoftext|> is text",
    "🙂🙃 � ‍", "'s't're don't DON'T  'll", "SELECT * FROM t WHERE a='b;c';\r\n\r\n", "Hello, world's  best!",
]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_prefixes_equal_the_library(reference):
    vocab = bpe.vocabulary(bpe.default_path())
    rng = np.random.default_rng(1)
    words = sorted({" " * int(rng.integers(0, 2)) + "".join(rng.choice(list("abcdeést台账ü1 "), size=int(rng.integers(1, 12)))).strip() for _ in range(3000)} - {""})
    states = bpe.Prefixes(vocab)
    pieces = sorted({p for w in words for p in bpe._PIECE.findall(w)}, key=lambda p: p.encode())
    for p in pieces:
        n = states.push(p.encode())
        assert states.tokens() == reference(p) and n == len(reference(p))


def test_ids_and_counts(spark, reference):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    got = {r.doc_id: list(r.ids) for r in tokens.token_ids(df, "doc_id", "text").collect()}
    assert got == {i: reference(t) for i, t in enumerate(TEXTS)}
    n = {r.doc_id: r.n_tokens for r in tokens.token_counts(df, "doc_id", "text").collect()}
    assert n == {i: len(v) for i, v in got.items()}
    assert tokens.token_ids(df.limit(0), "doc_id", "text").count() == 0


def test_small_blocks(spark, reference, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 40)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 3)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: list(r.ids) for r in tokens.token_ids(df, "doc_id", "text").collect()}
    assert got == {i: reference(t) for i, t in enumerate(TEXTS * 3)}


def test_budget(spark):
    chunks = spark.createDataFrame(
        [(1, "ops\\a.docx", "h1", 0, "DOC", "one two", 1), (2, "ops\\a.docx", "h1", 0, "doc", "one two", 2), (3, "gone/x.sql", "h9", 0, None, "three", 1), (4, None, None, None, None, None, None), (5, "ops/b.md", "h3", 0, "doc", "four", 1)],
        "chunk_id long, source string, file_hash string, chunk_index int, doc_type string, text string, ingested_at int",
    )
    files = spark.createDataFrame([("ops/a.md", "h1", "EN-us"), ("ops/a.md", "h2", "de"), ("ops/b.md", "h4", "fr"), ("ops/b.md", "h5", "und")], "rel_path string, sha256 string, lang string")
    spaces = spark.createDataFrame([("ops", "operations")], "space string, domain string")
    rows = budget.budget_rows(chunks, files, spaces)
    got = {r.chunk_id: (r.doc_type, r.lang, r.domain, r.n_tokens, r.current) for r in rows.collect()}
    assert got == {1: ("doc", "en", "operations", 2, False), 2: ("doc", "en", "operations", 2, True), 3: ("unknown", "unknown", "unknown", 1, True), 4: ("unknown", "unknown", "unknown", 0, True), 5: ("doc", "fr", "operations", 1, True)}
    totals = budget.budget_totals(chunks, files, spaces)
    whole = rows.groupBy("source", "doc_type", "lang", "domain").agg({"n_tokens": "sum", "chunk_id": "count"})
    assert sorted(map(tuple, whole.select("source", "doc_type", "lang", "domain", "count(chunk_id)", "sum(n_tokens)").collect())) == sorted(tuple(r)[:6] for r in budget.token_budget(totals).collect())
    total = budget.token_budget(totals).agg({"n_tokens": "sum", "current_tokens": "sum", "n_chunks": "sum"}).first()
    assert (total["sum(n_tokens)"], total["sum(current_tokens)"], total["sum(n_chunks)"]) == (6, 4, 5)
    by = {(r.by, r.slice): r.n_tokens for r in budget.slices(totals).collect()}
    assert by["lang", "en"] == 4 and by["domain", "operations"] == 5


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_pack(spark, capacity):
    rng = np.random.default_rng(capacity)
    sizes = [*map(int, rng.integers(1, 90, 400)), 5000, 4096, 2048, 2049] + [0, None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, n_tokens long")
    rows = packing.pack(df, capacity).collect()
    held, parts = {}, {}
    for r in rows:
        held[r.container_id] = held.get(r.container_id, 0) + r.n_tokens
        parts.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
    assert max(held.values()) <= capacity and set(held) == set(range(len(held)))
    for i, n in enumerate(sizes):
        if not n:
            assert i not in parts
        else:
            assert sum(k for _, k in parts[i]) == n and (n > capacity or len(parts[i]) == 1)
            at = 0
            for start, k in sorted(parts[i]):
                assert start == at
                at += k
    if capacity == 2048:
        assert packing.fill(packing.pack(df, capacity), capacity).first().used_share > 0.9
    assert packing.pack(df.limit(0), capacity).count() == 0


def test_buckets_are_optimal():
    rng = np.random.default_rng(0)
    h = {int(k): int(rng.integers(1, 50)) for k in rng.integers(1, 30, 12)}
    counts = np.zeros(31, dtype=np.int64)
    for k, v in h.items():
        counts[k] = v
    lengths = sorted(h)
    from itertools import combinations

    for cost in (1.0, 20.0, 200.0):
        best = min(
            sum(v * (next(e for e in (*ends, lengths[-1]) if e >= k) - k) for k, v in h.items()) + cost * (len(ends) + 1)
            for n in range(len(lengths))
            for ends in combinations(lengths[:-1], n)
        )
        ends, padding = packing._cut(counts, cost)
        assert abs(padding + cost * len(ends) - best) < 1e-6


def test_buckets_are_optimal():
    """The hull gives what trying every beginning gives."""
    rng = np.random.default_rng(4)
    for size, cost in ((1, 0.0), (5, 3.0), (60, 0.0), (60, 25.0), (300, 400.0), (300, 1e9)):
        counts = np.where(rng.random(size + 1) < 0.7, rng.integers(1, 50, size + 1), 0)
        counts[0], counts[size] = 0, 3
        lengths = [int(x) for x in np.flatnonzero(counts)]
        best = [0.0]
        for r in range(1, len(lengths) + 1):
            best.append(min(best[i] + cost + sum(int(counts[x]) * (lengths[r - 1] - x) for x in lengths[i:r]) for i in range(r)))
        ends, padding = packing._cut(counts, cost)
        assert ends[-1] == size and abs(padding + cost * len(ends) - best[-1]) < 1e-6 * max(1.0, best[-1])
    assert packing._cut(np.zeros(5, np.int64), 1.0) == ([], 0.0)
