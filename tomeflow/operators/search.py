"""Retrieval: keyword index and BM25, vectors and cosine, reciprocal rank fusion, graded answers.

Questions are a DataFrame, and all of them are answered by one plan. Only ids, terms and scores travel through
the shuffles; texts join at the end. An index is built once and read by every search; what makes vectors of texts,
on both sides, is a function that the caller may bring along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tomeflow.functions.durable import stored
from tomeflow.functions.text import file_name, utrim

K1, B, RRF = 1.2, 0.75, 60
DIM = 256
#: Rows up to which a side of a join is sent to every task, and queries that are compared at once.
SMALL, BLOCK = 100_000, 2000

#: Makes (key, vector) of (key, text).
Embedder = Callable[[DataFrame, str, str], DataFrame]


def terms(c: Column) -> Column:
    """Runs of letters and digits, in small letters; null text has none."""
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), 1), F.array().cast("array<string>"))


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf): how often each term stands in each text. Repeated keys add up."""
    return df.select(key, F.explode(terms(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def _small(df: DataFrame) -> DataFrame:
    """``df``, to be sent to every task if its rows, counted, are few; other sides are shuffled."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def bm25(index: DataFrame, asked: DataFrame, key: str, query: str, limit: int, lengths: DataFrame | None = None) -> DataFrame:
    """(query, key, score, place): the best ``limit`` texts for each query by Okapi BM25, the smaller key first among equals.

    ``index`` is (key, term, tf), with ``dl``, the length of each text in terms, if ``lengths`` (key, dl) of all texts
    are given; ``asked`` is (query, term). Scores are rounded to 6 digits before they are ranked.
    """
    if lengths is None:
        lengths = stored(index.groupBy(key).agg(F.sum("tf").alias("dl")), "lengths")
        index = index.join(lengths, key)
    n, avgdl = lengths.agg(F.count("*"), F.avg("dl")).first()
    wanted = stored(asked.select(query, "term").distinct(), "asked-terms")
    hits = index.join(_small(wanted.select("term").distinct()), "term", "left_semi")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    rows = hits.join(_small(stored(wanted.join(df, "term"), "asked-df")), "term")
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(avgdl or 1.0)))
    scored = rows.groupBy(query, key).agg(F.round(F.sum(part), 6).alias("score"))
    return ranked(scored, [query], [F.desc("score"), F.asc(key)], limit)


def ranked(df: DataFrame, by: list[str], order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, with their ``place`` from 1."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= limit)


def hashed_vectors(index: DataFrame, key: str, dim: int = DIM) -> DataFrame:
    """(key, bucket, w): term frequencies by hash bucket, a sparse vector that needs no model."""
    bucket = (F.conv(F.substring(F.md5("term"), 1, 4), 16, 10).cast("int") % dim).alias("bucket")
    return index.select(key, bucket, "tf").groupBy(key, "bucket").agg(F.sum("tf").alias("w"))


def dense(sparse: DataFrame, key: str, dim: int = DIM) -> DataFrame:
    """(key, vector) of a sparse vector (key, bucket, w)."""

    @F.pandas_udf("array<double>")
    def fill(buckets: pd.Series, weights: pd.Series) -> pd.Series:
        out = []
        for b, w in zip(buckets, weights, strict=True):
            v = np.zeros(dim)
            v[np.asarray(b)] = w
            out.append(v)
        return pd.Series(out, dtype=object)

    lists = sparse.groupBy(key).agg(F.collect_list(F.struct("bucket", F.col("w").cast("double").alias("w"))).alias("x"))  # at most dim entries
    return lists.select(key, fill("x.bucket", "x.w").alias("vector"))


def embed_hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, vector): term frequencies by hash bucket. Texts without terms have no vector."""
    return dense(hashed_vectors(postings(df, key, text), key), key)


def check_dimensions(vectors: DataFrame, asked: DataFrame) -> None:
    """Raises ValueError if both sides have vectors, and no length is common to both."""
    sides = [{r[0] for r in df.select(F.size("vector")).where("vector is not null").distinct().limit(1000).collect()} for df in (vectors, asked)]
    if sides[0] and sides[1] and not sides[0] & sides[1]:
        raise ValueError(f"stored vectors have {sorted(sides[0])} components, those of the questions {sorted(sides[1])}: embed both alike")


def vector_topk(vectors: DataFrame, asked: DataFrame, key: str, query: str, limit: int, digits: int = 4) -> DataFrame:
    """(query, key, sim, place): the ``limit`` vectors most similar to each query vector by cosine.

    Both sides are (key, vector); vectors that are null or empty, not finite or all zero have no similarity, and
    vectors of different lengths none to each other. The queries are a stated set: blocks of bounded size go to the
    tasks one after the other, each scans the vectors once and keeps its best rows before anything is shuffled.
    """
    slim = asked.select(query, "vector", F.size("vector").alias("_dim")).where("_dim > 0")
    counted = {r["_dim"]: r["n"] for r in slim.groupBy("_dim").agg(F.count("*").alias("n")).collect()}  # a row a length
    blocks = [(dim, b, -(-n // BLOCK)) for dim, n in sorted(counted.items()) for b in range(-(-n // BLOCK))]
    if len(blocks) > 1:
        slim = stored(slim, "query-vectors")
    found = None
    for dim, b, n in blocks:
        block = slim.where((F.col("_dim") == dim) & (F.pmod(F.xxhash64(query), F.lit(n)) == b))
        best = _nearest(vectors, block, key, query, dim, limit, digits)
        best = ranked(best, [query], [F.desc("sim"), F.asc(key)], limit)
        # the block is let go before the next one is read
        best = stored(best, "nearest") if len(blocks) > 1 else best
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], _near_schema(vectors, asked, key, query) + ", place int")
    return found


def _near_schema(vectors: DataFrame, asked: DataFrame, key: str, query: str) -> str:
    return f"`{query}` {asked.schema[query].dataType.simpleString()}, `{key}` {vectors.schema[key].dataType.simpleString()}, sim double"


def _nearest(vectors: DataFrame, block: DataFrame, key: str, query: str, dim: int, limit: int, digits: int) -> DataFrame:
    """(query, key, sim): of each task the best rows for a block of query vectors of one length."""
    kind = to_arrow_type(block.schema[query].dataType)
    rows = [(r[0], np.array(r[1], dtype=np.float64)) for r in block.select(query, "vector").collect()]  # about BLOCK rows
    rows = [(q, v / np.linalg.norm(v)) for q, v in rows if np.isfinite(v).all() and v.any()]
    names, matrix = [q for q, _ in rows], np.stack([v for _, v in rows]) if rows else np.zeros((0, dim))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(lengths == dim)
            if not len(at) or not names:
                continue
            flat = batch.column(1).take(pa.array(at)).flatten()
            m = (flat.fill_null(float("nan")) if flat.null_count else flat).to_numpy(zero_copy_only=False).reshape(len(at), -1).astype(np.float64)
            good = np.isfinite(m).all(axis=1) & m.any(axis=1)
            m, at = m[good], at[good]
            if not len(at):
                continue
            sims = np.round((m / np.linalg.norm(m, axis=1, keepdims=True)) @ matrix.T, digits) + 0.0
            ids = batch.column(0).take(pa.array(at))
            # ties at the edge are kept for the ranking over all batches
            edge = np.sort(sims, axis=0)[-min(limit, len(at))]
            r, c = np.nonzero(sims >= edge)
            yield pa.record_batch([pa.array([names[x] for x in c], kind), ids.take(pa.array(r)), pa.array(sims[r, c])], names=[query, key, "sim"])

    return vectors.select(key, "vector").mapInArrow(near, _near_schema(vectors, block, key, query))


def fuse(lists: list[DataFrame], query: str, key: str, limit: int) -> DataFrame:
    """(query, key, rrf, place): reciprocal rank fusion of ranked lists (query, key, place)."""
    one = lists[0].select(query, key, "place")
    for x in lists[1:]:
        one = one.unionByName(x.select(query, key, "place"))
    scored = one.groupBy(query, key).agg(F.round(F.sum(F.lit(1.0) / (RRF + F.col("place"))), 8).alias("rrf"))
    return ranked(scored, [query], [F.desc("rrf"), F.asc(key)], limit)


@dataclass(frozen=True)
class Index:
    """What searches read: postings (key, term, tf, dl), lengths (key, dl) and vectors (key, vector) of all texts."""

    key: str
    postings: DataFrame
    lengths: DataFrame
    vectors: DataFrame


def index_tables(texts: DataFrame, key: str, text: str, embed: Embedder | None = None) -> dict[str, DataFrame]:
    """The tables of an index by name. Without ``embed`` vectors are term frequencies by hash bucket, made of the postings."""
    found = stored(postings(texts, key, text), "postings")
    lengths = stored(found.groupBy(key).agg(F.sum("tf").alias("dl")), "lengths")
    vectors = embed(texts, key, text) if embed else dense(hashed_vectors(found, key), key)
    return {"postings": found.join(lengths, key).select(key, "term", "tf", "dl"), "lengths": lengths, "vectors": vectors}


def build_index(texts: DataFrame, key: str, text: str, embed: Embedder | None = None) -> Index:
    """The index of (key, text), written down: no search computes any of it again."""
    tables = index_tables(texts, key, text, embed)
    return Index(key, stored(tables["postings"], "postings"), tables["lengths"], stored(tables["vectors"], "vectors"))


def hybrid_hits(questions: DataFrame, index: Index, k: int = 5, threshold: float = 0.5, embed: Embedder | None = None) -> DataFrame:
    """(query_id, key, place, sim, rrf, matched_by): the graded hits of every question (query_id, expanded).

    Candidates are the first max(3k, 10) by BM25 and by cosine, fused and cut to as many; similarities are those of the
    first max(4k, 20) by cosine. A hit without one was "matched by keyword" and passes the threshold, others must reach it.
    ``embed`` must be what the vectors of the index were made with.
    """
    wide, wider, key = max(3 * k, 10), max(4 * k, 20), index.key
    asked = questions.where("expanded is not null")
    words = bm25(index.postings, postings(asked, "query_id", "expanded"), key, "query_id", wide, index.lengths)
    q_vectors = stored((embed or embed_hashed)(asked, "query_id", "expanded"), "question-vectors")
    if embed:
        check_dimensions(index.vectors, q_vectors)
    near = stored(vector_topk(index.vectors, q_vectors, key, "query_id", wider), "near")
    fused = fuse([words, near.where(F.col("place") <= wide)], "query_id", key, wide).drop("place")
    hits = fused.join(near.select("query_id", key, "sim"), ["query_id", key], "left").where(F.col("sim").isNull() | (F.col("sim") >= threshold))
    hits = ranked(hits, ["query_id"], [F.desc("rrf"), F.asc(key)], k)
    return hits.withColumn("matched_by", F.when(F.col("sim").isNull(), "keyword").otherwise("hybrid"))


def confidence(hits: Column, best: Column) -> Column:
    return F.when(hits == 0, "low").when(best.isNull(), "medium").when(best >= 0.75, "high").when(best >= 0.55, "medium").otherwise("low")


def answers(questions: DataFrame, hits: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """One row a question: found, hits, best_similarity (of the first hit that has one), confidence, results, error.

    Blank and null questions are rows with an error. ``questions`` is (query_id, question, expanded), ``chunks`` (key,
    text, source, doc_type).
    """
    told = chunks.select(key, utrim("text").alias("text"), file_name("source").alias("file_name"), "source", F.coalesce(F.lower("doc_type"), F.lit("doc")).alias("doc_type"))
    rows = hits.join(told, key).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("place", "text", "file_name", "source", "sim", "matched_by", "doc_type"))).alias("results"))
    out = questions.join(rows, "query_id", "left").withColumn("hits", F.coalesce(F.size("results"), F.lit(0)))
    best = F.element_at(F.filter(F.transform("results", lambda r: r["sim"]), lambda s: s.isNotNull()), 1)
    best = F.when(F.size(F.filter(F.coalesce("results", F.array()), lambda r: r["sim"].isNotNull())) > 0, best)
    blank = F.col("question").isNull() | ~F.col("question").rlike(r"(?U)\S")
    return out.select(
        "query_id", F.col("question").alias("query"), F.when(F.col("expanded") != F.col("question"), F.col("expanded")).alias("expanded_query"), (F.col("hits") > 0).alias("found"), "hits",
        best.alias("best_similarity"), confidence(F.col("hits"), best).alias("confidence"), "results", F.when(blank, "empty question").alias("error"),
    )


def as_context(answered: DataFrame, most: int = 2000) -> DataFrame:
    """(query_id, context): the results of an answer as numbered blocks of text, each cut to ``most`` characters."""
    def block(r: Column, i: Column) -> Column:
        how = F.when(r["sim"].isNull(), "关键词命中").otherwise(F.format_string("%.2f%%", r["sim"] * 100))
        body = F.when(F.length(r["text"]) > most, F.concat(F.substring(r["text"], 1, most), F.lit("...(截断)"))).otherwise(r["text"])
        return F.concat(F.lit("【知识片段 "), (i + 1).cast("string"), F.lit("】📄 "), r["file_name"], F.lit(" (相关度: "), how, F.lit(")\n"), body)

    text = F.array_join(F.transform("results", block), "\n\n---\n\n")
    return answered.select("query_id", F.when(F.col("hits") == 0, "[知识库检索无结果]").otherwise(text).alias("context"))
