"""Pipeline state: what was converted and ingested, what must be done again, and reports on it.

A state is (rel_path, sha256, size, mtime, abs_source_path, conversion, ingestion), one row a file. The two stages
are structs with a status: ok, skip, garbled, empty, error or pending; a missing status counts as pending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("ok", "skip", "garbled", "empty", "error", "pending")
DONE, RETRY = ("ok", "skip"), ("garbled", "empty", "error", "pending")
CONVERSION = "struct<status:string,md_path:string,timestamp:timestamp,error:string>"
INGESTION = "struct<status:string,chunks:int,timestamp:timestamp,error:string>"
SCHEMA = f"rel_path string, sha256 string, size bigint, mtime timestamp, abs_source_path string, conversion {CONVERSION}, ingestion {INGESTION}"


def status(stage: str) -> Column:
    return F.coalesce(F.col(f"{stage}.status"), F.lit("pending"))


def is_done(stage: str) -> Column:
    return status(stage).isin(*DONE)


def latest(states: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key, the one recorded last; equal rows are one. Rows whose key holds a null are left out."""
    known = states.dropna(subset=key)
    best = F.max(F.struct(*order, F.struct(*[c for c in states.columns if c not in (*key, *order)]).alias("_rest"))).alias("_m")
    rows = known.groupBy(*key).agg(best)
    return rows.select(*[F.col(c) if c in key else F.col(f"_m.{c}") if c in order else F.col(f"_m._rest.{c}") for c in states.columns])


def first_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key, the first by ``order``, and ``n``, how many rows had it. Null keys are keys like others; nulls come first."""
    rest = [c for c in rows.columns if c not in (*key, *order)]
    first = F.min(F.struct(*order, F.struct(*rest).alias("_rest")) if rest else F.struct(*order)).alias("_m")
    found = rows.groupBy(*key).agg(first, F.count("*").alias("n"))
    return found.select(*[F.col(c) if c in key else F.col(f"_m.{c}") if c in order else F.col(f"_m._rest.{c}") for c in rows.columns], "n")


def plan(files: DataFrame, states: DataFrame) -> DataFrame:
    """(rel_path, sha256, action, reason) of every scanned file against the state.

    skip: unchanged and both stages done; ingest: converted but not ingested; convert: new, changed or to be retried.
    """
    old = states.select("rel_path", F.col("sha256").alias("_old"), is_done("conversion").alias("_converted"), is_done("ingestion").alias("_ingested"))
    both = files.select("rel_path", "sha256").join(old, "rel_path", "left")
    same = F.col("_old").eqNullSafe(F.col("sha256"))
    reason = (
        F.when(F.col("_converted").isNull(), "new").when(~same, "changed").when(F.col("_converted") & F.col("_ingested"), "skip").when(F.col("_converted"), "retry_ingest").otherwise("retry")
    )
    action = F.when(reason == "skip", "skip").when(reason == "retry_ingest", "ingest").otherwise("convert")
    return both.select("rel_path", "sha256", action.alias("action"), reason.alias("reason"))


def pending(kind: str) -> Column:
    return F.struct(F.lit("pending").alias("status")).cast("struct<status:string>") if not kind else F.lit(None).cast(kind)


def start(files: DataFrame, states: DataFrame) -> DataFrame:
    """The state after the scan: a file with the same hash keeps its stages, others begin as pending; files gone stay."""
    fresh = {"conversion": F.struct(F.lit("pending").alias("status"), F.lit(None).cast("string").alias("md_path"), F.lit(None).cast("timestamp").alias("timestamp"), F.lit(None).cast("string").alias("error")),
             "ingestion": F.struct(F.lit("pending").alias("status"), F.lit(0).alias("chunks"), F.lit(None).cast("timestamp").alias("timestamp"), F.lit(None).cast("string").alias("error"))}
    n, o = files.alias("n"), states.alias("o")
    both = n.join(o, F.col("n.rel_path") == F.col("o.rel_path"), "full")
    same = F.col("n.sha256").eqNullSafe(F.col("o.sha256"))
    gone = F.col("n.rel_path").isNull()
    return both.select(
        *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in ("rel_path", "sha256", "size", "mtime", "abs_source_path")],
        *[F.when(gone | same, F.col(f"o.{s}")).otherwise(F.lit(None)).alias(f"_{s}") for s in fresh],
    ).select("rel_path", "sha256", "size", "mtime", "abs_source_path", *[F.coalesce(F.col(f"_{s}").cast(CONVERSION if s == "conversion" else INGESTION), v).alias(s) for s, v in fresh.items()])


def record(states: DataFrame, results: DataFrame, stage: str) -> DataFrame:
    """The state with the results of a stage: conversion (rel_path, status, md_path, error) or ingestion (rel_path, status, chunks, error).

    An unknown status, and an ingestion that is ok without chunks, stop the job.
    """
    extra = "md_path" if stage == "conversion" else "chunks"
    good = F.col("status").isin(*STATUSES)
    if stage == "ingestion":
        good = good & ~((F.col("status") == "ok") & (F.coalesce("chunks", F.lit(0)) <= 0))
    checked = results.select("rel_path", F.when(good, F.col("status")).otherwise(F.raise_error(F.concat(F.lit("not a result: "), F.coalesce("status", F.lit("null"))))).alias("status"), extra, "error")
    new = checked.select("rel_path", F.struct("status", extra, F.current_timestamp().alias("timestamp"), "error").cast(CONVERSION if stage == "conversion" else INGESTION).alias("_new"))
    both = states.join(new, "rel_path", "left")
    return both.withColumn(stage, F.coalesce("_new", stage)).drop("_new").select(*states.columns)


def reset(states: DataFrame, stage: str = "all") -> DataFrame:
    """Stages that failed are pending again; done ones stay."""
    out = states
    for s in ("conversion", "ingestion") if stage == "all" else (stage,):
        again = F.col(s).withField("status", F.lit("pending")).withField("error", F.lit(None).cast("string"))
        out = out.withColumn(s, F.when(is_done(s) | F.col(s).isNull(), F.col(s)).otherwise(again))
    return out


def remove(states: DataFrame, gone: DataFrame) -> DataFrame:
    return states.join(gone.select("rel_path").distinct(), "rel_path", "left_anti").select(*states.columns)


def _stages(states: DataFrame) -> DataFrame:
    return states.select("rel_path", F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), status(s).alias("status"), F.col(f"{s}.error").alias("error")) for s in ("conversion", "ingestion")])))


def summary(states: DataFrame) -> DataFrame:
    """(stage, total and the number of files in each status), zeros kept; no rows for an empty state."""
    counts = [F.sum((F.col("status") == s).cast("long")).alias(s) for s in STATUSES]
    return _stages(states).groupBy("stage").agg(F.count("*").alias("total"), *counts)


def failed(states: DataFrame, stage: str = "all") -> DataFrame:
    """(rel_path, stage, status, error) of every failed stage: a file that failed in both has two rows."""
    rows = _stages(states).where(F.col("status").isin(*RETRY))
    return rows if stage == "all" else rows.where(F.col("stage") == stage)


def failures_by_error(states: DataFrame, width: int = 100, shown: int = 5) -> DataFrame:
    """(stage, reason, n, examples): failures grouped by the start of their error, else their status, with the first few paths.

    Paths are kept by rank in their group, so that no group is gathered whole.
    """
    rows = failed(states).withColumn("reason", F.substring(F.coalesce("error", "status"), 1, width))
    total = rows.groupBy("stage", "reason").agg(F.count("*").alias("n"))
    first = rows.select("stage", "reason", "rel_path").withColumn("_k", F.row_number().over(Window.partitionBy("stage", "reason").orderBy("rel_path"))).where(F.col("_k") <= shown)
    examples = first.groupBy("stage", "reason").agg(F.array_join(F.sort_array(F.collect_list("rel_path")), ", ").alias("examples"))
    return total.join(examples, ["stage", "reason"])
