"""Files as DataFrames: scan, hash, decoding, conversion to Markdown."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions.text import CODE_TYPES, DOC_EXTENSIONS, doc_type, extension, is_blank, is_readable, size_warning
from tomeflow.operators.clean import clean_markdown

#: Encodings tried in this order.
ENCODINGS = ("utf-8", "gbk", "gb2312", "gb18030", "latin-1")
SUPPORTED = (*DOC_EXTENSIONS, *CODE_TYPES)
SCANNED = "path string, modificationTime timestamp, length bigint, content binary"


def _relative(raw: DataFrame, folder: str) -> DataFrame:
    """(rel_path, ext, size, mtime, path) of a binary file scan, and its other columns."""
    base = F.regexp_replace(F.lit(folder.rstrip("/") + "/"), r"^(file:)?/*", "/")
    path = F.regexp_replace("path", r"^(file:)?/*", "/")
    rows = raw.withColumn("_p", path).withColumn("_b", base).withColumn("rel_path", F.expr("substring(_p, length(_b) + 1)"))
    return rows.withColumnsRenamed({"length": "size", "modificationTime": "mtime"}).withColumn("ext", extension("rel_path")).drop("_p", "_b")


def described(raw: DataFrame, folder: str) -> DataFrame:
    """(rel_path, ext, size, mtime, sha256, content) of a binary file scan. Paths are relative to ``folder``."""
    return _relative(raw, folder).select("rel_path", "ext", "size", "mtime", F.sha2("content", 256).alias("sha256"), "content")


def _binary(spark: SparkSession, extensions: tuple[str, ...]):  # noqa: ANN202
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(extensions) + "}")


def scan(spark: SparkSession, folder: str, extensions: tuple[str, ...] = SUPPORTED) -> DataFrame:
    """All files of the extensions (in small letters) under a folder."""
    return described(_binary(spark, extensions).load(folder), folder)


def listed(spark: SparkSession, folder: str, extensions: tuple[str, ...] = SUPPORTED) -> DataFrame:
    """(rel_path, ext, size, mtime, path) of all files of the extensions under a folder; nothing is read."""
    return _relative(_binary(spark, extensions).load(folder), folder).select("rel_path", "ext", "size", "mtime", "path")


#: Paths that one read is given.
AT_ONCE = 10_000


def read_listed(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The listed files with their content, as ``scan`` gives them. Spark lists paths on the driver, so they go through it, so many at a time."""
    found, paths = None, []

    def load() -> DataFrame:
        part = described(spark.read.format("binaryFile").load(paths), folder)
        return part if found is None else found.unionByName(part)

    for r in files.select("path").toLocalIterator():
        paths.append(r.path)
        if len(paths) == AT_ONCE:
            found, paths = load(), []
    if paths:
        found = load()
    return spark.createDataFrame([], "rel_path string, ext string, size bigint, mtime timestamp, sha256 string, content binary") if found is None else found


def decoded(content: Column | str) -> Column:
    """(text, encoding) of bytes: the first encoding that gives text that isn't blank. UTF-8 is decoded by Spark itself."""

    @F.pandas_udf("text string, encoding string")
    def other(raw: pd.Series) -> pd.DataFrame:
        rows = []
        for b in raw:
            found = (None, None)
            for e in ENCODINGS if b is not None else ():
                try:
                    text = bytes(b).decode(e)
                except UnicodeDecodeError:
                    continue
                if text.strip():
                    found = (text, e)
                    break
            rows.append(found)
        return pd.DataFrame(rows, columns=["text", "encoding"])

    c = F.col(content) if isinstance(content, str) else content
    text = c.cast("string")
    plain = F.is_valid_utf8(text) & ~is_blank(text)
    return F.when(plain, F.struct(text.alias("text"), F.lit("utf-8").alias("encoding"))).otherwise(other(F.when(~plain, c)))


def _office(readers: dict[str, Callable[[bytes], str]], seconds: int):  # noqa: ANN202
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tomeflow.sources.office import READERS, NoText, limited, sniff

        known = READERS | readers
        for pdf in batches:
            rows = []
            for ext, content in zip(pdf["ext"], pdf["content"], strict=True):
                try:
                    if problem := sniff(ext, bytes(content)):
                        raise ValueError(problem)
                    if ext not in known:
                        raise ValueError(f"no reader for .{ext}")
                    with limited(seconds):
                        rows.append((known[ext](bytes(content)), None))
                except NoText as e:
                    rows.append(("", str(e)))
                except Exception as e:  # noqa: BLE001 - a broken file is a row with an error
                    rows.append((None, f"{type(e).__name__}: {e}"))
            yield pdf.drop(columns=["content"]).assign(raw=[r[0] for r in rows], error=[r[1] for r in rows])

    return read


def convert(files: DataFrame, strip_boilerplate: bool = True, marks: int = 3, large_mb: int = 50, warn_kb: int = 500, readers: dict[str, Callable[[bytes], str]] | None = None, seconds: int = 600) -> DataFrame:
    """(rel_path, ext, doc_type, status, markdown, error, warning, sha256, size, mtime) of scanned files.

    Status: ok; empty (nothing but white space); garbled (not readable; not asked of plain .txt); error (not decodable,
    or the reader failed or took longer than ``seconds``); skip (unsupported extension, or above the size limit).
    ``readers``, by extension, come before the built-in ones of office files; they are sent to the tasks.
    """
    supported = F.col("ext").isin(*SUPPORTED)
    large = F.col("size") > large_mb * 1024 * 1024
    keys = ["rel_path", "ext", "sha256", "size", "mtime"]
    skipped = files.where(~supported | large).select(*keys, F.when(~supported, "unsupported format").otherwise("file too large").alias("error"), F.lit(None).cast("string").alias("markdown"), F.lit("skip").alias("status"))
    todo = files.where(supported & ~large)
    text = todo.where(~F.col("ext").isin("docx", "xlsx", "pptx", "pdf")).select(*keys, decoded("content").alias("d"), (F.length("content") == 0).alias("none"))
    text = text.select(*keys, F.col("d.text").alias("raw"), F.lit(None).cast("string").alias("error"))
    office = todo.where(F.col("ext").isin("docx", "xlsx", "pptx", "pdf")).select(*keys, "content")
    office = office.mapInPandas(_office(readers or {}, seconds), "rel_path string, ext string, sha256 string, size long, mtime timestamp, raw string, error string")
    code = F.col("ext").isin(*CODE_TYPES)
    rows = text.unionByName(office)
    status = F.when(F.col("raw").isNull() & F.col("error").isNotNull(), "error").when(is_blank("raw"), "empty").when((F.col("ext") != "txt") & ~is_readable("raw", marks), "garbled").otherwise("ok")
    rows = rows.withColumn("status", status).withColumn("markdown", F.when(F.col("status") == "ok", F.when(code, F.col("raw")).otherwise(clean_markdown(F.when(~code, F.col("raw")), strip_boilerplate))))
    rows = rows.drop("raw").unionByName(skipped)
    return rows.select("rel_path", "ext", doc_type(F.col("ext")).alias("doc_type"), "status", "markdown", "error", size_warning("markdown", warn_kb).alias("warning"), "sha256", "size", "mtime")


def problems(files: DataFrame) -> DataFrame:
    """(rel_path, problem) of the files that can't be what their extension says."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tomeflow.sources.office import sniff

        for pdf in batches:
            pdf["problem"] = [sniff(e, bytes(c)) for e, c in zip(pdf["ext"], pdf["content"], strict=True)]
            yield pdf[["rel_path", "problem"]]

    some = files.where(F.col("ext").isin("docx", "xlsx", "pdf", "txt")).select("rel_path", "ext", "content")
    return some.mapInPandas(look, "rel_path string, problem string").where("problem is not null")
