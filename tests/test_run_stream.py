"""Streamed run figures: lines once, half lines later, and the batch figures once a log has ended."""

import gzip
import io
import json
import os

import pytest
import zstandard

from sacctlens.operators import compare as CMP
from sacctlens.sources import logsource as LS
from sacctlens.sources import logstream as ST
from sacctlens.streaming import run_stream as RS


def events(start=None, end=None, stages=0, tasks=0):
    out = [{"Event": "SparkListenerApplicationStart", "App ID": "a", "Timestamp": start}] if start else []
    out += [{"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": k, "Number of Tasks": 3}} for k in range(stages)]
    for k in range(tasks):
        out.append({"Event": "SparkListenerTaskStart", "Stage ID": 0, "Task Info": {"Launch Time": 2000 + k}})
        out.append({"Event": "SparkListenerTaskEnd", "Stage ID": 0, "Task Info": {"Launch Time": 2000 + k, "Finish Time": 2500 + 10 * k},
                    "Task Metrics": {"Shuffle Read Metrics": {"Remote Bytes Read": 5 * k, "Local Bytes Read": 7},
                                     "Shuffle Write Metrics": {"Shuffle Bytes Written": 11 + k}}})
    out += [{"Event": "SparkListenerApplicationEnd", "Timestamp": end}] if end else []
    return "".join(json.dumps(e) + "\n" for e in out).encode()


def zst(body):
    return zstandard.ZstdCompressor().compress(body)


def run(spark, folder, table, ckpt, split=LS.SPLIT):
    query = RS.start_run_aggregates(spark, str(folder), "cfg", str(table), checkpoint=str(ckpt), split=split)
    query.awaitTermination(180)
    assert query.exception() is None
    got = {r.log_id: r.asDict() for r in RS.read_run_aggregates(spark, str(table)).collect()}
    return got, sum(p["numInputRows"] for p in query.recentProgress)


@pytest.mark.parametrize("split", [1 << 20, 300])
def test_streamed_runs_equal_the_batch_once_ended(spark, tmp_path, split):
    logs, table, ckpt = tmp_path / "logs", tmp_path / "table", tmp_path / "ckpt"
    logs.mkdir()
    plain = events(1000, 9000, 3, 40)
    cut = plain.index(b"Finish Time", len(plain) // 2)                  # in the middle of a line
    (logs / "a.inprogress").write_bytes(plain[:cut])
    rolled = logs / "run-b"
    rolled.mkdir()
    (rolled / "appstatus_b.inprogress").write_bytes(b"")
    (rolled / "events_1_b.zstd").write_bytes(zst(events(1500, None, 2, 6)))
    (rolled / "events_2_b.zstd").write_bytes(zst(events(None, None, 1, 9))[:-7])    # being written
    (logs / "c.gz").write_bytes(gzip.compress(events(100, 400, 1)))
    (logs / "d-cut.gz").write_bytes(gzip.compress(events(100, 400, 9, 30))[:-20])

    first, _ = run(spark, logs, table, ckpt, split)
    half = plain[:cut].count(b"\n")
    assert first["a"]["still_open"] and first["a"]["readable"] and first["a"]["app_end_ms"] == 0
    assert first["a"]["stages"] == 3 and first["a"]["bad_lines"] == 0 and first["a"]["write_bytes"] > 0
    assert first["run-b"]["stages"] == 2 and first["run-b"]["still_open"]
    assert (first["c"]["readable"], first["c"]["still_open"], first["c"]["app_end_ms"]) == (True, False, 400)
    assert (first["d-cut"]["readable"], first["d-cut"]["stages"]) == (False, 0)

    # Nothing new: nothing is read.
    again, rows = run(spark, logs, table, ckpt, split)
    assert again == first and rows == 0

    (logs / "a.inprogress").write_bytes(plain + b'{"half a line')
    os.rename(logs / "a.inprogress", logs / "a")
    (rolled / "events_2_b.zstd").write_bytes(zst(events(None, None, 1, 9)))
    (rolled / "events_3_b").write_bytes(events(None, 7000, 4, 2))
    os.rename(rolled / "appstatus_b.inprogress", rolled / "appstatus_b")
    (logs / "e-empty").write_bytes(b"")
    last, rows = run(spark, logs, table, ckpt, split)
    batch = {r.log_id: r.asDict() for r in CMP.log_run_aggregates(spark, str(logs), "cfg").collect()}
    assert last == batch
    assert last["a"]["bad_lines"] == 1 and last["a"]["app_end_ms"] == 9000 and not last["a"]["still_open"]
    # The rest of a (and its half line), two parts of b; status and end rows of a, e and b's files.
    lines = plain.count(b"\n") - half + 1 + events(None, None, 1, 9).count(b"\n") + events(None, 7000, 4, 2).count(b"\n")
    assert rows == lines + 4 + 5
    metrics = {r.log_id: r.asDict() for r in RS.read_run_metrics(spark, str(table)).collect()}
    assert metrics == {r.log_id: r.asDict() for r in CMP.log_run_metrics(spark, str(logs), "cfg").collect()}


@pytest.mark.parametrize("split", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("body", [b"", b"\n", b"ab\n\ncd", b"one\ntwo\nthree\n", b"x" * 20 + b"\nlast"])
def test_each_line_is_in_one_range(body, split):
    want = [x for x in body.split(b"\n") if x]
    got = []
    for lo in range(0, len(body) + 1, split):
        got += ST.lines_ending_in(io.BytesIO(body), len(body), lo, min(lo + split, len(body) + 1), None)
    assert [x for x in got if x] == want


def test_ranges_follow_the_offsets():
    end = {"/t/x": [50, ST.OPEN, 7], "/t/r/events_1_q.zstd": [11, ST.COMPLETE, 8], "/t/done": [5, ST.ENDED, 9]}
    found = ST.ranges_between({"/t/x": [20, ST.OPEN, 3]}, end, lambda p: p, 20)
    assert [(r.path, r.start, r.stop, r.closes) for r in found] == [
        ("/t/done", 0, 5, True), ("/t/r/events_1_q.zstd", 0, 11, True), ("/t/x", 20, 40, False), ("/t/x", 40, 50, False)]
    # Later the application of r ends: its part is not read again.
    later = {**end, "/t/r/events_1_q.zstd": [11, ST.ENDED, 8]}
    assert [(r.path, r.reads, r.closes) for r in ST.ranges_between(end, later, lambda p: p, 20)] == [("/t/r/events_1_q.zstd", False, True)]
    assert ST.ranges_between(later, later, lambda p: p, 20) == []
