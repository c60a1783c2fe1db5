"""Token totals of the chunks by source, file type, language and domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeflow.llm import tokens

UNKNOWN = "unknown"


def _stem(path: Column) -> Column:
    """A path with plain separators and without its extension: sources and scanned files may differ in both."""
    return F.regexp_replace(F.regexp_replace(path, r"[\\/]+", "/"), r"\.[A-Za-z0-9]{1,5}$", "")


def _language(lang: Column) -> Column:
    """The language without country, in small letters; null for none and for undetermined."""
    short = F.regexp_extract(F.lower(F.trim(lang)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(~short.isin("", "und", "mul", "zxx"), short)


def _counted(chunks: DataFrame, vocabulary: str | None) -> DataFrame:
    """One row a chunk: its tokens, place and whether it is the last one stored under its key."""
    counts = tokens.token_counts(chunks, "chunk_id", "text", vocabulary)
    latest = chunks.groupBy("source", "file_hash", "chunk_index").agg(F.max(F.struct("ingested_at", "chunk_id")).alias("m")).select(F.col("m.chunk_id").alias("chunk_id"), F.lit(True).alias("current"))
    slim = chunks.select("chunk_id", "source", "file_hash", F.coalesce(F.lower(F.trim("doc_type")), F.lit(UNKNOWN)).alias("doc_type"))
    rows = slim.join(counts, "chunk_id").join(latest, "chunk_id", "left")
    return rows.withColumn("current", F.coalesce("current", F.lit(False)))


def _placed(rows: DataFrame, files: DataFrame, spaces: DataFrame) -> DataFrame:
    """Rows (source, file_hash, ...) with the language and domain of their file."""
    rows = rows.withColumn("stem", _stem(F.col("source")))
    known = files.select(_stem(F.col("rel_path")).alias("stem"), F.col("sha256").alias("file_hash"), _language(F.col("lang")).alias("lang")).where("lang is not null")
    version = known.groupBy("stem", "file_hash").agg(F.min("lang").alias("own"))
    one = F.when(F.countDistinct("lang") == 1, F.min("lang")).alias("shared")
    file = known.groupBy("stem").agg(one)
    rows = rows.join(version, ["stem", "file_hash"], "left").join(file, "stem", "left")
    rows = rows.withColumn("space", F.split_part("stem", F.lit("/"), F.lit(1))).join(spaces.select("space", "domain"), "space", "left")
    rows = rows.withColumns({"source": F.coalesce("source", F.lit(UNKNOWN)), "lang": F.coalesce("own", "shared", F.lit(UNKNOWN)), "domain": F.coalesce("domain", F.lit(UNKNOWN))})
    return rows.drop("stem", "file_hash", "space", "own", "shared")


def budget_rows(chunks: DataFrame, files: DataFrame, spaces: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row a chunk: its tokens, slice and whether it is the last one stored under its key (``current``).

    The language is that of the file version the chunk came from; where it is not known, that of any version of
    the file if all agree, else "unknown". The domain is that of the first folder of the source. Null and empty
    texts have no tokens. ``chunk_id`` must identify a row; null keys are keys like others.
    """
    return _placed(_counted(chunks, vocabulary), files, spaces).select("chunk_id", "source", "doc_type", "lang", "domain", "n_tokens", "current")


_SUMS = ("n_chunks", "n_tokens", "n_current", "current_tokens")


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _SUMS])


def budget_totals(chunks: DataFrame, files: DataFrame, spaces: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Totals of all rows, and of only the current ones, by file version: what ``budget_rows`` says, summed up before files are
    joined, so that a file with a third of all chunks is one row of the joins."""
    rows = _counted(chunks, vocabulary)
    rows = rows.withColumns({"n_chunks": F.lit(1).cast("long"), "n_current": F.col("current").cast("long"), "current_tokens": F.when(F.col("current"), F.col("n_tokens")).otherwise(0)})
    return _placed(_summed(rows, "source", "file_hash", "doc_type"), files, spaces)


def token_budget(totals: DataFrame) -> DataFrame:
    """Totals of each slice: all rows, and only the current ones, so that what is stored again counts once."""
    return _summed(totals, "source", "doc_type", "lang", "domain")


def slices(totals: DataFrame) -> DataFrame:
    """The totals of each source, doc_type, language and domain by itself."""
    each = totals.select(F.inline(F.array(*[F.struct(F.lit(k).alias("by"), F.col(k).alias("slice")) for k in ("source", "doc_type", "lang", "domain")])), *_SUMS)
    return _summed(each, "by", "slice").drop("n_current")
