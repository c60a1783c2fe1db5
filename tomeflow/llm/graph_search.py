"""Greedy search of a neighbour graph for a set of query vectors.

The graph is an index: built once by NN-descent, written down, and read again by every search. All queries walk at
once: in each step the links of the nodes in every query's beam are joined, nodes seen before are left out, the rest
is compared by code, and the best of old and new form the next beam. A walk starts at nodes that share the longest
prefixes of hyperplane signs with the query. In the end the beam is compared in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored
from tomeflow.llm.neighbours import DIM, ORDERS, SLACK, _codes, _unpacked, nodes, settled_graph

#: Nodes in a beam, steps, and the lengths in bits of the prefixes that a walk may start from.
BEAM, STEPS, PREFIXES = 32, 5, (8, 12, 16, 20)


def _near(a: Column, b: Column) -> Column:
    """Cosine of two codes."""

    @F.pandas_udf("float")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(np.einsum("ij,ij->i", _codes(x.tolist()), _codes(y.tolist())) if len(x) else np.zeros(0), dtype=np.float32)

    return near(a, b)


def _exact(a: Column, b: Column, dim: int) -> Column:
    @F.pandas_udf("double")
    def exact(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(np.round(np.minimum(np.einsum("ij,ij->i", _unpacked(x.tolist(), dim), _unpacked(y.tolist(), dim)), 1.0), 12) if len(x) else np.zeros(0))

    return exact(a, b)


def _prefixed(df: DataFrame, *keep: str) -> DataFrame:
    """(keep, order, bits, prefix): a row for every order and prefix length."""
    each = F.array(*[F.struct(F.lit(t).alias("order"), F.lit(b).alias("bits"), F.shiftright(F.col("signs")[t], 48 - b).alias("prefix")) for t in range(ORDERS) for b in PREFIXES])
    return df.select(*keep, F.inline(each))


def _best(df: DataFrame, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), F.asc("node")))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


@dataclass(frozen=True)
class Index:
    """Tables of an index: (node, links) of the graph, (node, firsts, code), (node, packed vector), and (order, bits, prefix, node): where a walk may start."""

    links: DataFrame
    coded: DataFrame
    packed: DataFrame
    doors: DataFrame

    def write(self, path: str) -> None:
        for name, df in vars(self).items():
            df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Index:
        return cls(*[spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in ("links", "coded", "packed", "doors")])


def build_index(vectors: DataFrame, key: str, vector: str, k: int = 5, least: float = 0.70, dim: int = DIM) -> Index:
    """The index of all usable rows of (``key``, vector); each node knows the first k + 1 rows that hold its vector."""
    found = nodes(vectors, key, vector, dim, k)
    links = settled_graph(found, least - SLACK).select("node", "links")
    doors = stored(_prefixed(found.coded, "node").groupBy("order", "bits", "prefix").agg(F.min("node").alias("node")), "doors")
    return Index(links, found.coded.select("node", "firsts", "code"), found.packed, doors)


def search(vectors: DataFrame, asked: DataFrame, key: str, vector: str, k: int = 5, least: float = 0.70, dim: int = DIM) -> DataFrame:
    """``search_index`` in the index of ``vectors``, built for it."""
    return search_index(build_index(vectors, key, vector, k, least, dim), asked, key, vector, k, least, dim)


def search_index(index: Index, asked: DataFrame, key: str, vector: str, k: int = 5, least: float = 0.70, dim: int = DIM) -> DataFrame:
    """(``key``, neighbour, rank, similarity): for each row of ``asked`` (``key``, vector) the k most similar other rows of the index.

    A row of the index with the key of the query is left out. Vectors that are null, of another length, not finite or
    all zero take no part. Fewer than k rows of at least ``least`` give fewer results.
    """
    links, coded, packed, doors = index.links, index.coded, index.packed, index.doors
    queries = nodes(asked, key, vector, dim, k)
    of_query, q_packed = queries.rows, queries.packed
    q_coded = queries.coded.select(F.col("node").alias("query"), F.col("code").alias("q_code"), "signs")
    q_codes = q_coded.select("query", "q_code")
    codes = coded.select("node", "code")
    start = _prefixed(q_coded, "query").join(doors, ["order", "bits", "prefix"]).select("query", "node").distinct()

    def compared(pairs: DataFrame) -> DataFrame:
        return pairs.join(codes, "node").join(q_codes, "query").select("query", "node", _near(F.col("code"), F.col("q_code")).alias("sim"))

    seen = stored(compared(start), "walk-0")
    beam = stored(_best(seen, BEAM), "beam-0")
    fresh = beam
    for step in range(1, STEPS + 1):
        reached = fresh.join(links, "node").select("query", F.explode("links").alias("node")).distinct()
        new = stored(compared(reached.join(seen.select("query", "node"), ["query", "node"], "left_anti")), f"walk-{step}")
        seen = seen.unionByName(new)
        both = beam.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        both = stored(_best(both, BEAM), f"beam-{step}")
        beam, fresh = both.drop("_new"), both.where("_new").drop("_new")

    last = beam.select("query", "node").join(packed, "node").join(q_packed.select(F.col("node").alias("query"), F.col("packed").alias("q_packed")), "query")
    last = last.select("query", "node", _exact(F.col("packed"), F.col("q_packed"), dim).alias("similarity")).where(F.col("similarity") >= least)
    rows = last.join(coded.select("node", "firsts"), "node").select("query", "similarity", F.explode("firsts").alias("neighbour"))
    found = of_query.withColumnRenamed("node", "query").join(rows, "query").where(F.col("neighbour") != F.col("id"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), F.asc("neighbour")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("id").alias(key), "neighbour", "rank", "similarity")
