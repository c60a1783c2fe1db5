"""Command line of the knowledge base: build, retry, status, list-failed, stats, sources, check, delete, search."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.operators import glossary, search, state, store
from tomeflow.operators.pipeline import Pipeline
from tomeflow.sources.files import problems, scan
from tomeflow.sources.glossary import load_glossary
from tomeflow.sources.settings import Settings


def ask(pipeline: Pipeline, questions: DataFrame) -> DataFrame:
    """Answers to (query_id, question) from the current snapshot."""
    s = pipeline.settings
    expanded = glossary.expand(questions, load_glossary(pipeline.spark, s.glossary_path))
    hits = search.hybrid_hits(expanded, pipeline.base.index(), s.top_k, s.threshold, pipeline.base.embed)
    return search.answers(expanded, hits, pipeline.base.table("chunks"), "chunk_id")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="tomeflow", description=__doc__)
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--settings", help="file of key=value lines")
    sub = p.add_subparsers(dest="do", required=True)
    sub.add_parser("build").add_argument("mode", nargs="?", default="incremental", choices=["incremental", "full", "convert", "ingest"])
    sub.add_parser("retry").add_argument("stage", nargs="?", default="all", choices=["all", "conversion", "ingestion"])
    for name in ("status", "list-failed", "stats", "sources", "check"):
        sub.add_parser(name)
    d = sub.add_parser("delete")
    d.add_argument("--source", dest="one")
    d.add_argument("--prefix")
    d.add_argument("--all", action="store_true")
    d.add_argument("--yes", action="store_true", help="delete; otherwise only say what would go")
    q = sub.add_parser("search")
    q.add_argument("question", nargs="+")
    q.add_argument("--format", choices=["json", "context"], default="json")
    a = p.parse_args(argv)

    spark = spark or SparkSession.builder.appName("tomeflow").getOrCreate()
    pipe = Pipeline(spark, a.source, a.target, Settings.from_env(file=a.settings))
    for warning in pipe.settings.warnings():
        print("warning:", warning, file=sys.stderr)

    def show(df: DataFrame) -> None:
        for row in df.toJSON().toLocalIterator():
            print(row)

    if a.do == "build":
        show(pipe.build(a.mode).groupBy("reason").agg(F.count("*").alias("files")))
    elif a.do == "retry":
        show(pipe.retry(a.stage).groupBy("reason").agg(F.count("*").alias("files")))
    elif a.do == "status":
        show(pipe.status())
    elif a.do == "list-failed":
        show(state.failures_by_error(pipe.state()))
    elif a.do == "stats":
        show(store.stats(pipe.base.table("chunks")))
    elif a.do == "sources":
        show(store.sources(pipe.base.table("chunks")).orderBy("source"))
    elif a.do == "check":
        show(problems(scan(spark, a.source)).orderBy("rel_path"))
    elif a.do == "delete":
        if a.one is None and a.prefix is None and not a.all:
            p.error("delete needs --source, --prefix or --all")
        show(store.impact(pipe.base.table("chunks"), store.doomed(a.one, a.prefix)))
        if a.yes:
            pipe.delete(a.one, a.prefix)
    else:
        asked = spark.createDataFrame(list(enumerate(a.question)), "query_id int, question string")
        found = ask(pipe, asked)
        if a.format == "context":
            for r in search.as_context(found).orderBy("query_id").toLocalIterator():
                print(r.context)
        else:
            for row in found.orderBy("query_id").toJSON().toLocalIterator():
                print(json.dumps(json.loads(row), ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
