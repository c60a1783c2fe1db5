"""Queries of the training-data operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.llm import budget, credentials, graph_search, mojibake, neighbours, packing, quality, splitting, tokens
from tomeflow.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.credential_lines(table(spark, folder, "chunk", "chunk_id", "text", *credentials.PLACE))


def p1_masked(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.mask(table(spark, folder, "chunk", "chunk_id", "text", *credentials.PLACE))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.garbled_rows(table(spark, folder, "chunk", "chunk_id", "source", "doc_type", "text"), table(spark, folder, "pipeline_state", "rel_path", "status"))


def p2_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.repaired(table(spark, folder, "chunk", "chunk_id", "source", "doc_type", "text"), table(spark, folder, "pipeline_state", "rel_path", "status"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.similar_pairs(table(spark, folder, "chunk", "chunk_id", "vector"), "chunk_id", "vector")


def p3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbours(table(spark, folder, "chunk", "chunk_id", "vector"), "chunk_id", "vector")


def p3_search(spark: SparkSession, folder: str) -> DataFrame:
    """The stated query set against all rows: every row whose id is divisible by 50."""
    rows = table(spark, folder, "chunk", "chunk_id", "vector")
    return graph_search.search(rows, rows.where(F.col("chunk_id") % 50 == 0), "chunk_id", "vector")


_CHUNK = ("chunk_id", "source", "file_hash", "chunk_index", "doc_type", "text", "ingested_at")


def _budget(spark: SparkSession, folder: str) -> DataFrame:
    return budget.budget_totals(table(spark, folder, "chunk", *_CHUNK), table(spark, folder, "source_file", "rel_path", "sha256", "lang"), table(spark, folder, "kb_space", "space", "domain"))


def p4_budget(spark: SparkSession, folder: str) -> DataFrame:
    return budget.token_budget(_budget(spark, folder))


def p4_slices(spark: SparkSession, folder: str) -> DataFrame:
    return budget.slices(_budget(spark, folder))


def p4_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "chunk", "chunk_id", "text"), "chunk_id", "text")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    cut = splitting.split_oversized(table(spark, folder, "chunk", "chunk_id", "source", "doc_type", "text"))
    return cut.select("chunk_id", F.explode("units").alias("unit_start"))


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.rechunk(table(spark, folder, "chunk", *_CHUNK))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_ids(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(tokens.token_counts(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text"))


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill(p7_containers(spark, folder))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    return quality.not_prose(documents, table(spark, folder, "common_word"), table(spark, folder, "doc_label", "doc_id", "kind"))


def p8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "common_word"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_masked": p1_masked,
    "p2_found": p2_found,
    "p2_repaired": p2_repaired,
    "p3_found": p3_found,
    "p3_neighbours": p3_neighbours,
    "p3_search": p3_search,
    "p4_budget": p4_budget,
    "p4_slices": p4_slices,
    "p4_tokens": p4_tokens,
    "p5_found": p5_found,
    "p5_pieces": p5_pieces,
    "p6_ids": p6_ids,
    "p7_containers": p7_containers,
    "p7_fill": p7_fill,
    "p8_found": p8_found,
    "p8_quality": p8_quality,
}

SQL: dict[str, str] = {}
