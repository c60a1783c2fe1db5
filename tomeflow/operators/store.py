"""The knowledge base: chunks with their keyword index and vectors, as snapshots of Parquet tables.

The rows of every table lie in buckets by a hash of their source. A commit writes the buckets that changed and a
manifest that says, for every bucket, which version holds it; readers follow the last manifest, so they see either the
old or the new state. Data that none of the last manifests name is removed. Chunks are keyed by ``source``, the path of
the file with its extension.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tomeflow.functions.durable import stored
from tomeflow.functions.filesystem import Folder
from tomeflow.operators.search import Embedder, Index, index_tables

CHUNKS = "source string, file_hash string, chunk_index int, chunk_total int, doc_type string, text string"
#: Manifests whose data is kept, and buckets of a table.
KEPT, BUCKETS = 2, 64


def replaced(old: DataFrame, new: DataFrame, key: str = "source", gone: DataFrame | None = None) -> DataFrame:
    """``old`` without the sources of ``new`` and of ``gone``, and ``new``. Columns that one side lacks are null there."""
    leaving = new.select(key) if gone is None else new.select(key).unionByName(gone.select(key))
    return old.join(leaving.distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def doomed(source: str | None = None, prefix: str | None = None) -> Column:
    """The predicate of a delete: the given source and the given literal prefix, both if both are given; all rows if none is."""
    cond = F.lit(True)
    if source is not None:
        cond = cond & (F.col("source") == source)
    if prefix is not None:
        cond = cond & F.col("source").startswith(prefix)
    return F.coalesce(cond, F.lit(False))


def impact(chunks: DataFrame, cond: Column) -> DataFrame:
    """(sources, chunks) that a delete would take."""
    return chunks.where(cond).agg(F.countDistinct("source").alias("sources"), F.count("*").alias("chunks"))


def stats(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("total_chunks"), F.countDistinct("source").alias("file_count"))


def sources(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("source").agg(F.count("*").alias("chunks"))


def bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Snapshots:
    """Tables under one folder of a file system that the driver and the executors share, as they were at each commit."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.folder = Folder(spark, self.path)

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.folder.names("manifests") if n.endswith(".json"))

    def version(self) -> int:
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """``buckets`` and, of every ``tables`` entry, its schema and the version of each bucket."""
        v = self.version() if version is None else version
        return json.loads(self.folder.read(f"manifests/{v:012d}.json")) if v else {"buckets": self.buckets, "tables": {}}

    def table(self, name: str, schema: str = CHUNKS, only: list[int] | None = None) -> DataFrame:
        """A table of the current snapshot, or of the given buckets of it; an empty one before the first."""
        found = self.manifest()["tables"].get(name)
        if not found:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/{name}/v={v}/_bucket={b}" for b, v in found["buckets"].items() if only is None or int(b) in only]
        schema = StructType.fromJson(found["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of rows that have the key: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(bucket(self.key, self.manifest()["buckets"]).alias("b")).distinct().collect())

    def commit(self, tables: dict[str, DataFrame], only: list[int] | None = None) -> int:
        """Writes the tables, which have the key or its ``_bucket``, as the next snapshot. With ``only`` they hold these buckets alone, and the others stay."""
        old = self.manifest()
        v, n = self.version() + 1, old["buckets"]
        new = {"buckets": n, "tables": dict(old["tables"])}
        for name, df in tables.items():
            rows = df if "_bucket" in df.columns else df.withColumn("_bucket", bucket(self.key, n))
            rows.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/data/{name}/v={v}")
            kept = {b: k for b, k in old["tables"].get(name, {}).get("buckets", {}).items() if only is not None and int(b) not in only}
            written = {x.removeprefix("_bucket="): v for x in self.folder.names(f"data/{name}/v={v}") if x.startswith("_bucket=")}
            new["tables"][name] = {"schema": rows.drop("_bucket").schema.jsonValue(), "buckets": kept | written}
        self.folder.add(f"manifests/{v:012d}.json", json.dumps(new))
        self._forget()
        return v

    def _forget(self) -> None:
        """Removes older manifests than the last few, and the data that only they name."""
        versions = self.versions()
        kept = [self.manifest(v)["tables"] for v in versions[-KEPT:]]
        for v in versions[:-KEPT]:
            self.folder.remove(f"manifests/{v:012d}.json")
        for name in self.folder.names("data"):
            used = {(str(b), k) for m in kept for b, k in m.get(name, {}).get("buckets", {}).items()}
            for part in self.folder.names(f"data/{name}"):
                k = int(part.removeprefix("v="))
                if k > versions[-1]:
                    continue
                for b in (x.removeprefix("_bucket=") for x in self.folder.names(f"data/{name}/{part}") if x.startswith("_bucket=")):
                    if (b, k) not in used:
                        self.folder.remove(f"data/{name}/{part}/_bucket={b}")
                if not any(x.startswith("_bucket=") for x in self.folder.names(f"data/{name}/{part}")):
                    self.folder.remove(f"data/{name}/{part}")


class KnowledgeBase(Snapshots):
    """Chunks with their postings, lengths and vectors. ``embed`` makes the vectors; without it they are term frequencies by hash bucket."""

    def __init__(self, spark: SparkSession, path: str, embed: Embedder | None = None, buckets: int = BUCKETS) -> None:
        super().__init__(spark, path, "source", buckets)
        self.embed = embed

    def index(self) -> Index:
        """The index of the current snapshot: searches read it as it was written."""
        vectors = "chunk_id long, vector array<double>"
        return Index("chunk_id", self.table("postings", "chunk_id long, term string, tf long, dl long"), self.table("lengths", "chunk_id long, dl long"), self.table("vectors", vectors))

    def _indexed(self, chunks: DataFrame) -> dict[str, DataFrame]:
        rows = chunks.drop("chunk_id").withColumn("chunk_id", F.xxhash64("source", "file_hash", "chunk_index"))
        rows = stored(rows.withColumn("_bucket", bucket("source", self.manifest()["buckets"])), "chunks")
        place = rows.select("chunk_id", "_bucket").distinct()
        tables = index_tables(rows.select("chunk_id", "text"), "chunk_id", "text", self.embed)
        return {"chunks": rows} | {name: df.join(place, "chunk_id") for name, df in tables.items()}

    def put(self, chunks: DataFrame) -> int:
        """A snapshot of nothing but these chunks and their index."""
        return self.commit(self._indexed(chunks))

    def _change(self, only: list[int], leaving: DataFrame, new: DataFrame) -> int:
        """A snapshot in which, of the given buckets, the chunks of the sources in ``leaving`` are replaced by new ones. Only new texts are indexed."""
        chunks = self.table("chunks", only=only)
        if "chunk_id" not in chunks.columns:  # before the first snapshot
            return self.put(new)
        added = self._indexed(new)
        n = self.manifest()["buckets"]
        kept = stored(chunks.join(leaving.select("source").distinct(), "source", "left_anti").withColumn("_bucket", bucket("source", n)), "kept")
        place = kept.select("chunk_id", "_bucket").distinct()
        tables = {"chunks": kept.unionByName(added["chunks"], allowMissingColumns=True)}
        for name in ("postings", "lengths", "vectors"):
            tables[name] = self.table(name, only=only).join(place, "chunk_id").unionByName(added[name])
        return self.commit(tables, only)

    def upsert(self, chunks: DataFrame, gone: DataFrame | None = None) -> int:
        """A snapshot in which the chunks of their sources, and of those in ``gone``, are replaced by these. Other buckets aren't read or written."""
        leaving = chunks.select("source") if gone is None else chunks.select("source").unionByName(gone.select("source"))
        leaving = stored(leaving.distinct(), "leaving")
        return self._change(self.touched(leaving), leaving, chunks)

    def delete(self, source: str | None = None, prefix: str | None = None) -> int:
        leaving = stored(self.table("chunks").where(doomed(source, prefix)).select("source").distinct(), "leaving")
        return self._change(self.touched(leaving), leaving, self.spark.createDataFrame([], CHUNKS))
