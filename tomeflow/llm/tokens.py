"""Tokens of whole tables: ids of every text, and counts of every text with their totals.

Distinct pieces are gathered a block of texts, sorted over the cluster by range, encoded once along their
shared prefixes, and sent back to the blocks that hold them. Only pieces that differ within a block travel;
a piece that every text holds is one row a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored
from tomeflow.llm import bpe

#: Characters of text in a block. A longer text is a block of its own.
BLOCK_CHARS = 6_000_000
#: Pieces a task.
PIECES = 100_000

_BLOCKS = pa.schema([("block", pa.string()), ("key", pa.int64()), ("codes", pa.list_(pa.int32())), ("piece", pa.string()), ("idx", pa.int32())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, a row a text with the numbers of its pieces, and a row a distinct piece."""
    import uuid

    pieces, keys, codes, held = bpe.Pieces(), [], [], 0

    def close() -> Iterator[pa.RecordBatch]:
        block, n = uuid.uuid4().hex, len(keys)
        ends = np.cumsum([0, *map(len, codes)], dtype=np.int32)
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        yield pa.record_batch([pa.array([block] * n), pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32())], schema=_BLOCKS)
        words = list(pieces.number)
        for a in range(0, len(words), 50_000):
            part = words[a : a + 50_000]
            m = len(part)
            yield pa.record_batch([pa.array([block] * m), pa.nulls(m, pa.int64()), pa.nulls(m, _BLOCKS.field("codes").type), pa.array(part, pa.string()), pa.array(np.arange(a, a + m, dtype=np.int32))], schema=_BLOCKS)

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys.append(key)
            codes.append(pieces.codes(text))
            held += len(text or "")
            if held >= BLOCK_CHARS:
                yield from close()
                pieces, keys, codes, held = bpe.Pieces(), [], [], 0
    if keys:
        yield from close()


def blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """The table of blocks, written down: its block names are chosen as it runs, so it must run once."""
    slim = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return stored(slim.mapInArrow(_blocks, "block string, key long, codes array<int>, piece string, idx int"), "blocks")


def encoded_pieces(table: DataFrame, vocabulary: str, ids: bool) -> DataFrame:
    """Each block's pieces with their number of tokens and, if asked for, their ids.

    A range partition of the sorted pieces is a part of the trie of all pieces, visited depth first.
    """

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = bpe.Prefixes(bpe.vocabulary(vocabulary))
        before, n, tokens = None, 0, None
        for batch in batches:
            counts, lists = [], []
            for piece in batch.column(0).cast(pa.binary()).to_pylist():
                if piece != before:
                    n, before = states.push(piece), piece
                    tokens = states.tokens() if ids else None
                counts.append(n)
                lists.append(tokens)
            yield pa.record_batch([batch.column(1), batch.column(2), pa.array(counts, pa.int32()), pa.array(lists, pa.list_(pa.int32()))], names=["block", "idx", "n", "ids"])

    # a piece that every block holds is a row a block: its rows may span partitions, each of which begins with its own prefixes
    words = table.where("piece is not null").select("piece", "block", "idx")
    words = words.repartitionByRange(max(shuffles(table), -(-words.count() // PIECES)), "piece", "block").sortWithinPartitions("piece")
    return words.mapInArrow(visit, "block string, idx int, n int, ids array<int>")


def shuffles(df: DataFrame) -> int:
    """The session's number of shuffle partitions; given outright, it isn't lowered for rows that are few bytes but much work."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _by_block(left: DataFrame, right: DataFrame):  # noqa: ANN202
    """Both sides by block, about a block a task: the number of tasks grows with the texts."""
    n = max(shuffles(left), left.select("block").distinct().count())
    return left.repartition(n, "block").groupBy("block").cogroup(right.repartition(n, "block").groupBy("block"))


def _order(pieces: pa.Table) -> np.ndarray:
    return np.argsort(pieces["idx"].to_numpy(), kind="stable")


def token_ids(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """``key`` and ``ids`` of every row. Null and empty texts have the empty list; rows may repeat.

    ``vocabulary`` is the path of a byte-level vocabulary; it must be readable on every executor. Special
    tokens are never produced: their names are ordinary text.
    """
    table = blocks(df, key, text)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.take(pa.array(_order(right)))
        n = right["n"].to_numpy()
        flat = right["ids"].combine_chunks().flatten().to_numpy() if len(n) else np.zeros(0, np.int32)
        begin = np.cumsum(n, dtype=np.int64) - n
        lists = left["codes"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        codes = lists.flatten().to_numpy()
        took = n[codes]
        total = np.cumsum(took, dtype=np.int64)
        at = np.repeat(begin[codes] - (total - took), took) + np.arange(int(total[-1]) if len(total) else 0)
        ends = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(sizes)])]
        return pa.table({key: left["key"], "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[at], pa.int32()))})

    texts = table.where("piece is null").select("block", "key", "codes")
    pieces = encoded_pieces(table, vocabulary or bpe.default_path(), True)
    return _by_block(texts, pieces).applyInArrow(gather, f"{key} long, ids array<int>")


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """``key`` and ``n_tokens`` of every row; null and empty texts have none."""
    table = blocks(df, key, text)

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        n = right["n"].to_numpy()[_order(right)]
        lists = left["codes"].combine_chunks()
        sums = np.concatenate([[0], np.cumsum(n[lists.flatten().to_numpy()], dtype=np.int64)])
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        return pa.table({key: left["key"], "n_tokens": pa.array(np.diff(sums[ends]), pa.int64())})

    texts = table.where("piece is null").select("block", "key", "codes")
    pieces = encoded_pieces(table, vocabulary or bpe.default_path(), False).drop("ids")
    return _by_block(texts, pieces).applyInArrow(total, f"{key} long, n_tokens long")
