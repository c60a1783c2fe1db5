"""The most similar vectors of every vector, by NN-descent on Spark.

Vectors that are equal form one node. Short codes (random projections in eight bits) order the nodes by the signs of
random hyperplanes; blocks of that order give a first graph. Nodes are then gathered in cells with those that they
are linked to, and in every round each cell joins the neighbours of its neighbours from wherever they are: the links
that leave the cell are joined with the graph, what they lead to is joined with its code, and the cell keeps the best
of all. Rounds end when hardly any link is new. The last step does the same with the vectors themselves, in double
precision. Blocks and cells have a fixed size however many vectors resemble each other; what a cell reaches is
compared in slices. The number of tasks grows with the number of nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored

DIM = 512
#: Length of a code, number of hyperplane orders for the first graph, nodes in a block or cell, links a node.
CODE, ORDERS, BLOCK, CELL, LINKS = 128, 6, 1024, 1536, 20
#: Rounds at most, and the share of new links from which on a further round is worth it.
ROUNDS, FRESH = 8, 0.05
#: So many links of a node are kept whatever their similarity: it may be near nodes that lead on to its neighbours.
FEW = 3
#: Nodes that a cell is compared with at once, and nodes a task.
SLICE, TASK = 4096, 6144
#: How far a code's similarity may lie below the least similarity asked for.
SLACK = 0.18
SEED = 20240601


def _planes(n: int, dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng(SEED + seed).standard_normal((dim, n)).astype(np.float32) / np.sqrt(n)


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are of the right length, finite and not all zero, and where they are."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    if not len(at):
        return np.zeros((0, dim), np.float32), at
    flat = column.take(pa.array(at)).flatten()
    m = (flat.fill_null(float("nan")) if flat.null_count else flat).to_numpy(zero_copy_only=False).reshape(-1, dim)
    good = np.isfinite(m).all(axis=1) & m.any(axis=1)
    return m[good], at[good]


def _packed(m: np.ndarray) -> list[bytes]:
    """Vectors as bytes: in half precision where that loses nothing, else in single."""
    with np.errstate(over="ignore"):
        half = m.astype(np.float16)
    exact = (half.astype(np.float32) == m).all(axis=1)
    return [h.tobytes() if e else x.tobytes() for h, x, e in zip(half, m, exact, strict=True)]


def _unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision."""
    m = np.stack([np.frombuffer(b, np.float16 if len(b) == 2 * dim else np.float32).astype(np.float64) for b in rows]) if rows else np.zeros((0, dim))
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def _codes(rows: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(rows), np.int8).reshape(len(rows), -1).astype(np.float32)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)


def orders_for(n: int) -> int:
    """Hyperplane orders for ``n`` vectors: one more for each doubling of the blocks from 128 on, since a longer prefix of signs is shared more seldom."""
    return ORDERS + max(0, int(np.ceil(np.log2(max(1.0, n / BLOCK / 128)))))


@dataclass(frozen=True)
class Nodes:
    """(id, node) of every usable row; (node, first ids, code, signs of each order) of every node, their number and that of the orders; (node, packed vector)."""

    rows: DataFrame
    coded: DataFrame
    packed: DataFrame
    size: int
    orders: int

    @property
    def parts(self) -> int:
        """Partitions for work on cells: the session's number, and more if there are many nodes."""
        return max(int(self.coded.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-self.size // TASK))


def nodes(vectors: DataFrame, key: str, vector: str, dim: int = DIM, k: int = 5) -> Nodes:
    """The nodes of the usable rows. A node is named by the smallest id of the rows that hold its vector, and knows the first k + 1 of them."""
    orders_used = orders_for(vectors.count())

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection, planes = _planes(CODE, dim, 0), [_planes(48, dim, 1 + t) for t in range(orders_used)]
        for batch in batches:
            m, at = _matrix(batch.column(1), dim)
            ids = batch.column(0).take(pa.array(at))
            unit = m / np.linalg.norm(m, axis=1, keepdims=True)
            code = unit @ projection
            code = np.clip(np.rint(code * (127 / np.maximum(np.abs(code).max(axis=1, keepdims=True), 1e-9))), -127, 127).astype(np.int8)
            signs = [((unit @ p) > 0) @ (1 << np.arange(47, -1, -1, dtype=np.int64)) if len(m) else np.zeros(0, np.int64) for p in planes]
            digest = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in m]
            orders = pa.ListArray.from_arrays(pa.array(np.arange(0, len(m) * orders_used + 1, orders_used, dtype=np.int32)), pa.array(np.stack(signs, axis=1).ravel() if len(m) else np.zeros(0, np.int64)))
            yield pa.record_batch([ids.cast(pa.int64()), pa.array(digest, pa.binary()), pa.array([c.tobytes() for c in code], pa.binary()), orders], names=["id", "digest", "code", "signs"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, at = _matrix(batch.column(1), dim)
            yield pa.record_batch([batch.column(0).take(pa.array(at)).cast(pa.int64()), pa.array(_packed(m), pa.binary())], names=["node", "packed"])

    slim = vectors.select(F.col(key).cast("long"), vector)
    usable = stored(slim.mapInArrow(prepare, "id long, digest binary, code binary, signs array<long>"), "vectors")
    of = usable.groupBy("digest").agg(F.min("id").alias("node"))
    rows = usable.select("id", "digest").join(of, "digest").select("id", "node")
    firsts = Window.partitionBy("node").orderBy("id")
    first = rows.distinct().withColumn("_k", F.row_number().over(firsts)).where(F.col("_k") <= k + 1).groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("firsts"))
    rows = stored(rows, "node-of-row")
    coded = stored(first.join(usable.select(F.col("id").alias("node"), "code", "signs"), "node"), "nodes")
    return Nodes(rows, coded, slim.mapInArrow(pack, "node long, packed binary"), coded.count(), orders_used)


def _in_blocks(df: DataFrame, order: str, size: int, name: str, n: int) -> DataFrame:
    """Numbers blocks of at most ``size`` rows along an order; rows next to each other share one."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            block = base + (seen + np.arange(batch.num_rows)) // size
            seen += batch.num_rows
            yield batch.append_column("block", pa.array(block, pa.int64()))

    placed = df.repartitionByRange(n, order, "node").sortWithinPartitions(order, "node")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return stored(placed.mapInArrow(number, f"{schema}, block long"), name)


def _by_blocks(df: DataFrame, order: str, size: int, work, schema: str, n: int) -> DataFrame:  # noqa: ANN001
    """``work`` over tables of at most ``size`` rows that are next to each other along an order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - rows)
                held.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)  # noqa: PLW2901
                if rows == size:
                    yield from work(pa.Table.from_batches(held)).to_batches()
                    held, rows = [], 0
        if held:
            yield from work(pa.Table.from_batches(held)).to_batches()

    return df.repartitionByRange(n, order, "node").sortWithinPartitions(order, "node").mapInArrow(run, schema)


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    k = min(k, sims.shape[1])
    part = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.broadcast_to(np.arange(k), (len(sims), k))
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(sims, part, axis=1), axis=1, kind="stable"), axis=1)


def _links(ids: np.ndarray, own: np.ndarray, others: np.ndarray, codes: np.ndarray, k: int, least: float) -> tuple[pa.Array, pa.Array]:
    """Of each own row, the k most similar others of at least a similarity, and the first few of any: their ids and similarities."""
    best, value = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0), np.float32)
    for a in range(0, len(others), SLICE):
        sims = own @ codes[a : a + SLICE].T
        sims[ids[:, None] == others[None, a : a + SLICE]] = -2.0
        top = _top(sims, k)
        best, value = np.concatenate([best, top + a], axis=1), np.concatenate([value, np.take_along_axis(sims, top, axis=1)], axis=1)
        if a:
            top = _top(value, k)
            best, value = np.take_along_axis(best, top, axis=1), np.take_along_axis(value, top, axis=1)
    keep = (value >= least) | (np.arange(value.shape[1])[None, :] < FEW) & (value > -2)
    ends = np.concatenate([[0], np.cumsum(keep.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(others[best][keep])), pa.ListArray.from_arrays(pa.array(ends), pa.array(value[keep].astype(np.float32)))


_GRAPH = "node long, links array<long>, sims array<float>"


def first_graph(found: Nodes, least: float, links: int = LINKS) -> DataFrame:
    """Links within the blocks of each hyperplane order, the best of all orders."""

    def link(table: pa.Table) -> pa.Table:
        ids, m = table["node"].to_numpy(), _codes(table["code"].to_pylist())
        to, sims = _links(ids, m, ids, m, links, least)
        return pa.table({"node": table["node"], "links": to, "sims": sims})

    graph = None
    for t in range(found.orders):
        part = _by_blocks(found.coded.select("node", "code", F.col("signs")[t].alias("sign")), "sign", BLOCK, link, _GRAPH, found.parts)
        graph = part if graph is None else graph.unionByName(part)
    return _best_links(graph.withColumn("new", F.lit(False)), least, links, found.parts)


def _best_links(graph: DataFrame, least: float, k: int, n: int) -> DataFrame:
    """One row a node from several: its best links over all of them, of at least a similarity or among its first few, and those of them that are ``new`` only."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([*batches]) if (batches := [*batches]) else None
        if table is None or not table.num_rows:
            return
        lists = table["links"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        node, new = np.repeat(table["node"].to_numpy(), sizes), np.repeat(table["new"].to_numpy(zero_copy_only=False), sizes)
        other, sim = lists.flatten().to_numpy(), table["sims"].combine_chunks().flatten().to_numpy()
        order = np.lexsort((new, other, node))  # of a link that was there before, that one is kept
        node, other, sim, new = node[order], other[order], sim[order], new[order]
        first = np.r_[True, (node[1:] != node[:-1]) | (other[1:] != other[:-1])] if len(node) else np.zeros(0, bool)
        node, other, sim, new = node[first], other[first], sim[first], new[first]
        order = np.lexsort((other, -sim, node))
        node, other, sim, new = node[order], other[order], sim[order], new[order]
        begin = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
        place = np.arange(len(node)) - np.repeat(begin, np.diff(np.r_[begin, len(node)]))
        keep = (place < k) & ((sim >= least) | (place < FEW))
        node, other, sim, new = node[keep], other[keep], sim[keep], new[keep]
        names, start, count = np.unique(node, return_index=True, return_counts=True)
        ends = pa.array(np.append(start, len(node)).astype(np.int32))
        fresh = np.append(0, np.cumsum(new))[np.append(start, len(node))].astype(np.int32)
        yield pa.record_batch([pa.array(names), pa.ListArray.from_arrays(ends, pa.array(other)), pa.ListArray.from_arrays(ends, pa.array(sim)), pa.ListArray.from_arrays(pa.array(fresh), pa.array(other[new]))], names=["node", "links", "sims", "fresh"])

    return stored(graph.where(F.size("links") > 0).repartition(n, "node").mapInArrow(merge, _GRAPH + ", fresh array<long>"), "graph")


def _labelled(graph: DataFrame) -> DataFrame:
    """(node, mark): a node takes the smallest mark among its neighbours' neighbours, so that linked nodes share one."""
    mark = graph.select("node", F.array_min(F.transform(F.concat(F.array("node"), "links"), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x"))))["h"].alias("mark"))
    edges = graph.select("node", F.explode(F.concat(F.array("node"), "links")).alias("other"))
    return edges.join(mark.select(F.col("node").alias("other"), "mark"), "other").groupBy("node").agg(F.min("mark").alias("mark"))


def _cells(graph: DataFrame, members: DataFrame, found: Nodes) -> DataFrame:
    """(node, cell) of ``members``: linked nodes side by side."""
    whole = members.select("node").join(graph, "node", "left").select("node", F.coalesce("links", F.array().cast("array<long>")).alias("links"))
    return _in_blocks(_labelled(whole), "mark", CELL, "cells", found.parts).select("node", F.col("block").alias("cell"))


def _outside(pairs: DataFrame, inside: DataFrame) -> DataFrame:
    """(cell, node) of pairs (cell, other) whose node is of another cell, each once."""
    return pairs.distinct().join(inside, "other").where("home <> cell").select("cell", F.col("other").alias("node"))


def _reached(graph: DataFrame, cells: DataFrame, further: str | None = None) -> DataFrame:
    """(cell, node): the nodes outside of a cell that its nodes' links lead to in one step, and in two by ways on which a link is in the column ``further``."""
    inside = cells.withColumnRenamed("node", "other").withColumnRenamed("cell", "home")
    placed = graph.join(cells, "node")
    out = _outside(placed.select("cell", F.explode("links").alias("other")), inside)
    if further is None:
        return out
    out = stored(out, "out")
    second = out.join(graph.select("node", F.col(further).alias("_to")), "node").select("cell", F.explode("_to").alias("other"))
    if further != "links":
        new = stored(_outside(placed.select("cell", F.explode(further).alias("other")), inside), "new-out")
        second = second.unionByName(new.join(graph.select("node", "links"), "node").select("cell", F.explode("links").alias("other")))
    return out.unionByName(_outside(second, inside)).distinct()


def _joined(members: DataFrame, reached: DataFrame, payload: DataFrame, n: int, *columns: str):  # noqa: ANN202
    """Cells with the payload of their own nodes and of the nodes they reach, grouped alike."""
    all_rows = members.select("cell", "node", F.lit(True).alias("own")).unionByName(reached.select("cell", "node", F.lit(False).alias("own")))
    return all_rows.join(payload, "node").select("cell", "node", *columns, "own").repartition(n, "cell").groupBy("cell")


def descend(graph: DataFrame, found: Nodes, cells: DataFrame, least: float, links: int = LINKS, further: str = "links") -> DataFrame:
    """One round: every node looks at its cell and at the neighbours of its cell's neighbours; with ``further`` "fresh" only
    at those that a link of the round before leads to, since the others were looked at then."""

    def improve(table: pa.Table) -> pa.Table:
        ids, m, own = table["node"].to_numpy(), _codes(table["code"].to_pylist()), table["own"].to_numpy()
        to, sims = _links(ids[own], m[own], ids, m, links, least)
        return pa.table({"node": pa.array(ids[own]), "links": to, "sims": sims})

    better = _joined(cells, _reached(graph, cells, further), found.coded.select("node", "code"), found.parts, "code").applyInArrow(improve, _GRAPH)
    both = graph.select("node", "links", "sims", F.lit(False).alias("new")).unionByName(better.withColumn("new", F.lit(True)))
    return _best_links(both, least, links, found.parts)


def settled_graph(found: Nodes, least: float, links: int = LINKS) -> DataFrame:
    """(node, links, sims): the first graph, improved in rounds until hardly any link is new."""
    graph = first_graph(found, least, links)
    for turn in range(ROUNDS):
        graph = descend(graph, found, _cells(graph, found.coded, found), least, links, "fresh" if turn else "links")
        fresh, whole = graph.agg(F.sum(F.size("fresh")), F.sum(F.size("links"))).first()
        if not whole or fresh <= FRESH * whole:
            break
    return graph.drop("fresh")


def neighbour_graph(vectors: DataFrame, key: str, vector: str, k: int = 5, least: float = 0.70, dim: int = DIM) -> tuple[DataFrame, DataFrame]:
    """(id, node) of the usable rows, and (node, ids, sims): of each node the rows most similar to it, its own among them.

    Rows whose vector is null, of another length, with NaN or infinite components or all zero take no part. The lists
    hold the first k + 1 rows by similarity (rounded to 12 digits), the smaller id first among equals, of at least
    ``least``; a row's neighbours are the first k of its node's list without itself.
    """
    found = nodes(vectors, key, vector, dim, k)
    graph = settled_graph(found, least - SLACK, max(LINKS, 4 * k))
    # links kept for their way on only aren't compared again
    near = F.filter(F.arrays_zip("links", "sims"), lambda x: x["sims"] >= least - SLACK)["links"]
    close = graph.select("node", near.alias("links")).where(F.size("links") > 0)
    members = close.select(F.explode(F.concat(F.array("node"), "links")).alias("node")).distinct()
    cells = _cells(close, members, found)

    def exact(table: pa.Table) -> pa.Table:
        ids, own, first, packed = table["node"].to_numpy(), table["own"].to_numpy(), table["firsts"].to_pylist(), table["packed"].to_pylist()
        mine = _unpacked([p for p, o in zip(packed, own, strict=True) if o], dim)
        names = ids[own]
        # the (k + 2)-nd best similarity so far: nodes that tie with it may come first by their ids
        low, best = np.full(len(mine), least), np.full((len(mine), 0), least)
        rows, cols, values = [], [], []
        for a in range(0, len(ids), SLICE):
            sims = np.round(mine @ _unpacked(packed[a : a + SLICE], dim).T, 12)
            sims = np.where(names[:, None] == ids[None, a : a + SLICE], 1.0, np.minimum(sims, 1.0))
            r, c = np.nonzero(sims >= low[:, None])
            rows.append(r)
            cols.append(c + a)
            values.append(sims[r, c])
            best = -np.sort(-np.concatenate([best, np.take_along_axis(sims, _top(sims, k + 2), axis=1)], axis=1), axis=1)[:, : k + 2]
            if best.shape[1] > k + 1:
                low = np.maximum(best[:, -1], least)
        rows, cols, values = np.concatenate(rows), np.concatenate(cols), np.concatenate(values)
        keep = values >= low[rows]
        lists: list[list[tuple[float, int]]] = [[] for _ in range(len(mine))]
        for r, c, v in zip(rows[keep].tolist(), cols[keep].tolist(), values[keep].tolist(), strict=True):
            lists[r] += [(-v, i) for i in first[c]]
        lists = [sorted(x)[: k + 1] for x in lists]
        return pa.table({"node": pa.array(names), "ids": pa.array([[i for _, i in x] for x in lists], pa.list_(pa.int64())), "sims": pa.array([[-v for v, _ in x] for x in lists], pa.list_(pa.float64()))})

    payload = found.coded.select("node", "firsts").join(found.packed, "node")
    compared = _joined(cells, _reached(close, cells), payload, found.parts, "packed", "firsts").applyInArrow(exact, "node long, ids array<long>, sims array<double>")
    alone = found.coded.join(cells, "node", "left_anti").where(F.size("firsts") > 1).select("node", F.slice("firsts", 1, k + 1).alias("ids"), F.transform(F.slice("firsts", 1, k + 1), lambda x: F.lit(1.0)).alias("sims"))
    return found.rows, stored(compared.unionByName(alone), "neighbours")


def neighbours(vectors: DataFrame, key: str, vector: str, k: int = 5, least: float = 0.70, dim: int = DIM) -> DataFrame:
    """(``key``, neighbour, rank, similarity): the k most similar rows of every usable row, equal vectors included."""
    rows, lists = neighbour_graph(vectors, key, vector, k, least, dim)
    each = rows.join(lists, "node").select("id", F.filter(F.arrays_zip("ids", "sims"), lambda x: x["ids"] != F.col("id")).alias("all"))
    each = each.select("id", F.posexplode(F.slice("all", 1, k)).alias("rank", "x"))
    return each.select(F.col("id").alias(key), F.col("x.ids").alias("neighbour"), (F.col("rank") + 1).alias("rank"), F.col("x.sims").alias("similarity"))


def similar_pairs(vectors: DataFrame, key: str, vector: str, k: int = 5, least: float = 0.70, dim: int = DIM) -> DataFrame:
    """(``key``_a, ``key``_b), a < b: pairs of which one is among the k most similar of the other, each once."""
    found = neighbours(vectors, key, vector, k, least, dim)
    return found.select(F.least(key, "neighbour").alias(f"{key}_a"), F.greatest(key, "neighbour").alias(f"{key}_b")).distinct()
