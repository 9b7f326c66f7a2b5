"""Growing logs as a stream, and chained stateful windows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.operators import windows
from scanlens.sources import tail
from scanlens.streaming import dispatch, sources
from scanlens.streaming import windows as stream_windows


def _follow(spark, path, out, **options):
    """One run of the stream to the end of what is there now."""
    stream = sources.follow_lines(sources.stream_session(spark), str(path), **options)
    dispatch.start(stream, dispatch.to_folders(f"{out}/rows"), f"{out}/checkpoint", refresh_seconds=None).awaitTermination()
    if not os.path.exists(f"{out}/rows"):
        return []
    return sorted((os.path.basename(r.file), r.position, r.line) for r in spark.read.parquet(f"{out}/rows").collect())


def test_appended_lines_come_once_over_restarts(spark, tmp_path):
    live, out = tmp_path / "live", tmp_path / "out"
    assert _follow(spark, live, out) == []  # no such folder yet
    live.mkdir()
    (live / "a.log").write_bytes(b"one\ntwo\r\nhalf of ")
    (live / ".hidden.log").write_bytes(b"never\n")
    assert _follow(spark, live, out, suffix=".log") == [("a.log", 0, "one"), ("a.log", 4, "two")]
    with open(live / "a.log", "ab") as log:
        log.write("a líne\n\n  \nlast\n".encode())
    (live / "b.log").write_bytes(b"other\n")
    got = _follow(spark, live, out, suffix=".log")
    assert [x[2] for x in got] == ["one", "two", "half of a líne", "  ", "last", "other"]
    assert _follow(spark, live, out, suffix=".log") == got
    (live / "a.log").write_bytes(b"new\n")  # replaced by a shorter file
    assert sorted(x[2] for x in _follow(spark, live, out, suffix=".log")) == sorted([*(x[2] for x in got), "new"])


def test_long_files_are_cut_at_lines(spark, tmp_path):
    path = tmp_path / "log.json"
    lines = ["x" * (7 * i % 90) + f"|{i}" for i in range(2000)] + ["y" * 5000, "end"]
    path.write_text("\n".join(lines) + "\n")
    for split in (97, 1000, 1 << 20):
        got = _follow(spark, path, tmp_path / str(split), splitBytes=split) if split == 1000 else None
        reader = tail._TailReader({"path": str(path), "splitBytes": str(split)})
        parts = reader.partitions({}, reader.latestOffset())
        store, _ = tail.open_store(str(path))
        read = [(at, raw.decode()) for p in parts for at, raw in tail.lines_of(store, p)]
        assert [t for _, t in read] == lines and len({at for at, _ in read}) == len(lines)
        assert got is None or [x[2] for x in got] == lines


@pytest.mark.parametrize("block", [3, 64, 1 << 20])
def test_last_whole_line(tmp_path, monkeypatch, block):
    monkeypatch.setattr(tail, "BLOCK_BYTES", block)
    path = tmp_path / "a"
    for raw in (b"", b"no end", b"\n", b"a\nbb\nccc", b"a\n" + b"z" * 300):
        path.write_bytes(raw)
        store, root = tail.open_store(f"file://{path}")
        end = tail.whole_lines(store, root, len(raw))
        assert end == raw.rfind(b"\n") + 1
        part = tail.Stretch(root, 0, end, end, True)
        assert [x for _, x in tail.lines_of(store, part)] == raw[:end].split(b"\n")[:-1]


def test_reading_from_the_end(spark, tmp_path):
    path, out = tmp_path / "log", tmp_path / "out"
    path.write_text("old\n")
    assert _follow(spark, path, out, startingAt="end") == []
    with open(path, "a") as log:
        log.write("fresh\n")
    assert [x[2] for x in _follow(spark, path, out, startingAt="end")] == ["fresh"]


def test_followed_logs_skip_bad_lines(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text(
        '{"timestamp": "2024-01-01T00:00:00", "src_ip": "a", "prediction": 1, "label": 1, "action": "BLOCK"}\nbroken\n{}\n'
        '{"timestamp": "2024-01-01T00:00:02", "src_ip": "b", "prediction": 0, "label": 0, "action": "ALLOW"}\n'
    )
    session = sources.stream_session(spark)
    stats = dispatch.run_to_end(stream_windows.rolling_detection_stats(sources.follow_detection_log(session, str(path))), spark, "stats", "complete")
    row = stats.orderBy(F.col("batch").desc()).first()
    assert (row["total_events"], row["attacks"], row["benign"], row["blocked"]) == (2, 1, 1, 1)
    path.write_text('{"timestamp": "2024-01-01 00:00:00", "event": "REDIRECT", "ip": "a"}\n{"timestamp": "2024-01-01 00:00:00", "event_type": "X", "src_ip": "b"}\n')
    rows = dispatch.run_to_end(sources.follow_deception_log(session, str(path)).select("src_ip", "event_type"), spark, "deception")
    assert {tuple(r) for r in rows.select("src_ip", "event_type").collect()} == {("a", "REDIRECT"), ("b", "X")}


def _flow_stream(spark, root, rows, per_file):
    schema = "src_ip string, ts timestamp, dst_port double, syn_flag_count double, flow_iat_mean double"
    frame = spark.createDataFrame(rows, "src_ip string, second long, dst_port double, syn_flag_count double, flow_iat_mean double")
    frame = frame.select("src_ip", F.timestamp_seconds("second").alias("ts"), "dst_port", "syn_flag_count", "flow_iat_mean")
    for k in range(0, len(rows), per_file):
        spark.createDataFrame(frame.collect()[k : k + per_file], schema).coalesce(1).write.mode("append").parquet(f"{root}/{k:05d}")
    return sources.stream_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/*"), frame


def test_panes_equal_batch_windows(spark, tmp_path):
    base = 1_700_000_000
    rows = [(f"10.0.0.{i % 3}", base + i * 3 % 400, float([0, 65535, 32767, 32768, 22, i * 37 % 65536][i % 6]), float(i % 2), i / 7) for i in range(300)]
    rows += [("10.0.0.9", base + 5, None, None, None), ("10.0.0.9", base + 6, 80.0, None, None), ("10.0.0.1", base + 4000, 1.0, 0.0, 0.0)]
    stream, frame = _flow_stream(spark, str(tmp_path), rows, 101)
    got = dispatch.run_to_end(stream_windows.pane_windows(stream, "600 seconds"), spark, "panes")
    want = windows.slow_windows(frame).where(F.col("window_start") + K.SLOW_WINDOW_SECONDS <= base + 4000 - 600)
    names = ["src_ip", "window_start", "flows", "distinct_ports", F.round("syn_ratio", 9), F.round("iat_mean", 9)]
    assert sorted(map(repr, got.select(*names).collect())) == sorted(map(repr, want.select(*names).collect()))
    assert got.count() > 100


def test_a_pane_is_one_state_row(spark, tmp_path):
    """State rows: one per pane and window; none per port, and no copy per window of a flow."""
    base = 1_700_000_000
    rows = [("10.0.0.1", base + i % 10, float(i), 1.0, 1.0) for i in range(3000)]
    stream, _ = _flow_stream(spark, f"{tmp_path}/in", rows, 3000)
    query = dispatch.start(stream_windows.pane_windows(stream, "600 seconds"), dispatch.to_folders(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", refresh_seconds=None)
    query.awaitTermination()
    rows_held = [[s["numRowsTotal"] for s in p["stateOperators"]] for p in query.recentProgress if p["stateOperators"]][-1]
    assert sorted(rows_held) == [0, 1]  # no window before its panes are closed


def test_a_pane_with_one_port_is_a_small_state_row(spark, tmp_path):
    """State grows with the ports of a pane; sources with one flow each do not hold a bitmap each."""
    base = 1_700_000_000
    rows = [(f"10.1.{i // 256}.{i % 256}", base + i % 10, 22.0, 1.0, 1.0) for i in range(2000)]
    stream, _ = _flow_stream(spark, f"{tmp_path}/in", rows, 2000)
    query = dispatch.start(stream_windows.pane_windows(stream, "600 seconds"), dispatch.to_folders(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", refresh_seconds=None)
    query.awaitTermination()
    held = max(s["customMetrics"]["rocksdbTotalBytesWritten"] for p in query.recentProgress for s in p["stateOperators"])
    assert 0 < held < 2000 * 4096
