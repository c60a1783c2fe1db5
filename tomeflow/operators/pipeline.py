"""The build: scan, compare with the state, convert, chunk, store, and record; as a batch or by micro-batch.

What a build costs goes with what changed: files whose size and time are those of the state aren't read, others are read
and hashed once, and only the buckets of the tables that hold a changed file are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored
from tomeflow.functions.text import is_blank
from tomeflow.operators import chunking, state
from tomeflow.operators.search import Embedder
from tomeflow.operators.store import KnowledgeBase, Snapshots
from tomeflow.sources.files import convert, decoded, listed, read_listed, scan
from tomeflow.sources.settings import Settings

MODES = ("incremental", "full", "convert", "ingest")
MARKDOWN = "rel_path string, ext string, doc_type string, status string, markdown string, error string, warning string, sha256 string, size bigint, mtime timestamp"


class Pipeline:
    """A source folder, the knowledge base made of it and the state of every file; all of them kept as tables."""

    def __init__(self, spark: SparkSession, source: str, target: str, settings: Settings | None = None, embed: Embedder | None = None, readers: dict[str, Callable[[bytes], str]] | None = None) -> None:
        self.spark, self.source, self.target, self.readers = spark, source, target.rstrip("/"), readers
        self.settings = settings or Settings()
        self.base = KnowledgeBase(spark, f"{self.target}/kb", embed)
        self.store = Snapshots(spark, f"{self.target}/state", "rel_path")

    def state(self, only: list[int] | None = None) -> DataFrame:
        return self.store.table("files", state.SCHEMA, only)

    def build(self, mode: str = "incremental") -> DataFrame:
        """Brings the knowledge base up to date and gives (rel_path, action, reason) of all scanned files."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}")
        found = stored(listed(self.spark, self.source), "listed")
        same = found.limit(0).select("rel_path")
        if mode == "incremental" and self.settings.trust_mtime:
            done = self.state().where(state.is_done("conversion") & state.is_done("ingestion"))
            same = stored(found.join(done.select("rel_path", "size", "mtime"), ["rel_path", "size", "mtime"], "left_semi").select("rel_path"), "unchanged")
        skipped = same.join(self.state().select("rel_path", "sha256"), "rel_path")
        skipped = skipped.select("rel_path", "sha256", F.lit("skip").alias("action"), F.lit("skip").alias("reason")).orderBy("rel_path")
        if mode == "incremental" and same.count() == found.count():
            return skipped
        todo = self.take(read_listed(self.spark, self.source, found.join(same, "rel_path", "left_anti")), mode)
        return todo.unionByName(skipped).orderBy("rel_path")

    def take(self, files: DataFrame, mode: str = "incremental") -> DataFrame:
        """The build over given files; those that the state knows besides stay as they are."""
        s, spark, whole = self.settings, self.spark, mode == "full"
        files = stored(files.withColumn("abs_source_path", F.concat(F.lit(self.source.rstrip("/") + "/"), "rel_path")), "files")
        only = None if whole else self.store.touched(files)
        old = spark.createDataFrame([], state.SCHEMA) if whole else self.state(only)
        slim = files.select("rel_path", "sha256", "size", "mtime", "abs_source_path")
        todo = stored(state.plan(slim, old), "plan")
        now = state.start(slim, old)
        kept = spark.createDataFrame([], MARKDOWN) if whole else self.store.table("markdown", MARKDOWN, only)
        markdown = kept
        if mode != "ingest":
            chosen = files.join(todo.where(F.col("action") == "convert").select("rel_path"), "rel_path", "left_semi")
            made = stored(convert(chosen, s.strip_boilerplate, s.garbled_marks, s.large_file_mb, s.max_markdown_kb, self.readers, s.file_timeout_s), "converted")
            now = state.record(now, made.select("rel_path", "status", F.lit(None).cast("string").alias("md_path"), "error"), "conversion")
            markdown = kept.join(made.select("rel_path"), "rel_path", "left_anti").unionByName(made)
        markdown = stored(markdown, "markdown")
        now = stored(now, "state")
        if mode != "convert":
            waiting = now.where(state.is_done("conversion") & ~state.is_done("ingestion")).select("rel_path", "sha256")
            ready = markdown.join(waiting, ["rel_path", "sha256"], "left_semi").where(F.col("status") == "ok")
            chunks = stored(chunking.chunk(ready.select(F.col("rel_path").alias("source"), F.col("sha256").alias("file_hash"), "doc_type", F.col("markdown").alias("text")), s.chunk_size, s.chunk_overlap), "chunks")
            if whole:
                self.base.put(chunks)
            else:
                # a file whose new version has no chunks, blank or no longer readable, loses those of the old one
                changed = todo.where(F.col("action") == "convert").select(F.col("rel_path").alias("source"))
                self.base.upsert(chunks, changed)
            n = chunks.groupBy(F.col("source").alias("rel_path")).agg(F.count("*").cast("int").alias("chunks"))
            skipped = markdown.join(waiting, ["rel_path", "sha256"], "left_semi").where(F.col("status") == "skip").select("rel_path", F.lit("skip").alias("status"), F.lit(0).alias("chunks"))
            done = ready.select("rel_path").join(n, "rel_path", "left").select("rel_path", F.when(F.col("chunks") > 0, "ok").otherwise("empty").alias("status"), F.coalesce("chunks", F.lit(0)).alias("chunks"))
            now = state.record(now, done.unionByName(skipped).withColumn("error", F.lit(None).cast("string")), "ingestion")
        self.store.commit({"files": now, "markdown": markdown}, only)
        return todo

    def import_markdown(self, folder: str) -> DataFrame:
        """Takes Markdown files that another run converted for the conversions of files of the same paths, brings them in and gives what was done with each."""
        files = stored(scan(self.spark, folder, ("md",)), "imported").withColumn("abs_source_path", F.concat(F.lit(folder.rstrip("/") + "/"), "rel_path"))
        only = self.store.touched(files)
        made = files.select("*", decoded("content")["text"].alias("markdown"))
        made = stored(made.withColumn("status", F.when(is_blank("markdown"), "empty").otherwise("ok")), "converted")
        nothing = F.lit(None).cast("string")
        now = state.start(files.select("rel_path", "sha256", "size", "mtime", "abs_source_path"), self.state(only))
        now = state.record(now, made.select("rel_path", "status", nothing.alias("md_path"), nothing.alias("error")), "conversion")
        rows = made.select("rel_path", "ext", F.lit("doc").alias("doc_type"), "status", "markdown", nothing.alias("error"), nothing.alias("warning"), "sha256", "size", "mtime")
        kept = self.store.table("markdown", MARKDOWN, only).join(made.select("rel_path"), "rel_path", "left_anti")
        self.store.commit({"files": now, "markdown": kept.unionByName(rows)}, only)
        return self.take(files.drop("abs_source_path"), "ingest").orderBy("rel_path")

    def retry(self, stage: str = "all") -> DataFrame:
        """Failed stages become pending again, and an incremental build does them."""
        self.store.commit({"files": state.reset(self.state(), stage)})
        return self.build("ingest" if stage == "ingestion" else "incremental")

    def delete(self, source: str | None = None, prefix: str | None = None, forget: bool = True) -> int:
        """Deletes chunks by source or by the start of it, and the files' states if they are to be forgotten."""
        from tomeflow.operators.store import doomed

        gone = self.base.table("chunks").where(doomed(source, prefix)).select(F.col("source").alias("rel_path"))
        gone = stored(gone.distinct(), "gone")
        v = self.base.delete(source, prefix)
        if forget:
            only = self.store.touched(gone)
            markdown = self.store.table("markdown", MARKDOWN, only).join(gone, "rel_path", "left_anti")
            self.store.commit({"files": state.remove(self.state(only), gone), "markdown": markdown}, only)
        return v

    def export(self, folder: str) -> None:
        """Writes the converted Markdown as one text file for each source, under a folder named after its path."""
        rows = self.store.table("markdown", MARKDOWN).where("markdown is not null").select(F.col("markdown").alias("value"), F.url_encode("rel_path").alias("file"))
        rows.repartition("file").write.mode("overwrite").partitionBy("file").text(folder)

    def status(self) -> DataFrame:
        return state.summary(self.state())
