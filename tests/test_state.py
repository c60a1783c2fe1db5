import pytest

from tomeflow.operators import state

CONV = "struct<status:string,md_path:string,timestamp:timestamp,error:string>"


def states(spark, rows):
    full = [(p, h, 1, None, None, c and (c, None, None, e), i and (i, n, None, None)) for p, h, c, e, i, n in rows]
    return spark.createDataFrame(full, state.SCHEMA)


def test_plan(spark):
    old = states(spark, [("a", "1", "ok", None, "ok", 2), ("b", "1", "ok", None, "error", 0), ("c", "1", "ok", None, "ok", 1), ("d", "1", "error", "x", None, 0)])
    files = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("d", "1"), ("e", "1")], "rel_path string, sha256 string")
    got = {r.rel_path: (r.action, r.reason) for r in state.plan(files, old).collect()}
    assert got == {"a": ("skip", "skip"), "b": ("ingest", "retry_ingest"), "c": ("convert", "changed"), "d": ("convert", "retry"), "e": ("convert", "new")}
    assert state.plan(files.limit(0), old).count() == 0
    assert state.plan(files, old.limit(0)).where("reason = 'new'").count() == 5


def test_reset_only_failed(spark):
    old = states(spark, [("a", "1", "ok", None, "error", 0)])
    r = state.reset(old).first()
    assert (r.conversion.status, r.ingestion.status) == ("ok", "pending")
    assert state.reset(old, "conversion").first().ingestion.status == "error"


def test_record_checks(spark):
    old = states(spark, [("a", "1", "ok", None, None, 0)])
    ok = spark.createDataFrame([("a", "ok", 3, None)], "rel_path string, status string, chunks int, error string")
    assert state.record(old, ok, "ingestion").first().ingestion.chunks == 3
    for bad in (("a", "ok", 0, None), ("a", "done", 1, None)):
        with pytest.raises(Exception, match="not a result"):
            state.record(old, spark.createDataFrame([bad], ok.schema), "ingestion").collect()


def test_reports(spark):
    old = states(spark, [("a", "1", "error", "boom", None, 0), ("b", "1", "ok", None, "ok", 2), ("c", "1", None, None, "ok", 1)])
    s = {r.stage: r for r in state.summary(old).collect()}
    assert (s["conversion"].total, s["conversion"].error, s["conversion"].pending, s["ingestion"].ok, s["ingestion"].garbled) == (3, 1, 1, 2, 0)
    assert state.failed(old).count() == 3 and state.failed(old, "ingestion").count() == 1
    got = {(r.stage, r.reason): (r.n, r.examples) for r in state.failures_by_error(old).collect()}
    assert got[("conversion", "boom")] == (1, "a")


def test_latest(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), (None, 3, "z")], "k string, at int, v string")
    assert [tuple(r) for r in state.latest(rows, ["k"], ["at"]).collect()] == [("a", 2, "y")]


def test_start(spark):
    old = states(spark, [("a", "1", "ok", None, "ok", 2), ("gone", "1", "ok", None, "ok", 2)])
    files = spark.createDataFrame([("a", "2", 1, None, None), ("n", "1", 1, None, None)], "rel_path string, sha256 string, size bigint, mtime timestamp, abs_source_path string")
    got = {r.rel_path: (r.sha256, r.conversion.status) for r in state.start(files, old).collect()}
    assert got == {"a": ("2", "pending"), "n": ("1", "pending"), "gone": ("1", "ok")}
