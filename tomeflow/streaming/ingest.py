"""The incremental build as a stream of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tomeflow.operators.pipeline import Pipeline
from tomeflow.sources.files import SCANNED, SUPPORTED, described


def build_stream(pipeline: Pipeline, checkpoint: str) -> StreamingQuery:
    """Starts a query that brings in all files that arrived, and ends when it has done so.

    Each micro-batch runs the incremental build over its files, so a batch that runs twice changes nothing. The
    source follows paths: files changed in place are found by the batch build, which compares hashes.
    """
    glob = "*.{" + ",".join(SUPPORTED) + "}"
    raw = pipeline.spark.readStream.format("binaryFile").schema(SCANNED).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(pipeline.source)

    def take(batch: DataFrame, _: int) -> None:
        pipeline.take(described(batch, pipeline.source))

    return raw.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
