"""Streams over several micro-batches agree with the batch operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scanlens.operators import verdicts, windows
from scanlens.sources.flows_view import table, with_flow_columns
from scanlens.streaming import dispatch, sources, state
from scanlens.streaming import windows as stream_windows


@pytest.fixture(scope="module")
def parts(spark, folder, tmp_path_factory):
    """The events in four files, in time order, and the same events as a table."""
    root = str(tmp_path_factory.mktemp("events"))
    events = table(spark, folder, "events")
    for i in range(4):
        events.where(F.col("event_id") % 1_000 >= i * 250).where(F.col("event_id") % 1_000 < (i + 1) * 250).coalesce(1).write.parquet(
            f"{root}/{i}"
        )
    return root, events


def _stream(spark, parts):
    root, _ = parts
    session = sources.stream_session(spark)
    schema = session.read.parquet(f"{root}/0").schema
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")
    return with_flow_columns(stream.withColumn("ts", F.col("ts").cast("timestamp")))


def _rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


@pytest.mark.parametrize("kind", ["fast", "slow"])
def test_windows_equal_batch(spark, parts, kind):
    stream_op = {"fast": stream_windows.fast_windows, "slow": stream_windows.slow_windows}[kind]
    batch_op = {"fast": windows.fast_windows, "slow": windows.slow_windows}[kind]
    rows = dispatch.run_to_end(stream_op(_stream(spark, parts), watermark="60 days"), spark, kind, "update")
    last = dispatch.last_update(rows, ["src_ip", "window_start"])
    columns = ("src_ip", "window_start", "flows", "distinct_ports")
    assert rows.select("batch").distinct().count() > 1
    assert _rows(last, *columns) == _rows(batch_op(with_flow_columns(parts[1])), *columns)


def test_block_periods_equal_batch(spark, parts):
    blocks = _stream(spark, parts).where("event_type = 'error'")
    rows = dispatch.run_to_end(state.block_periods(blocks, "60 days"), spark, "blocks", "update")
    columns = ("src_ip", "blocked_from", "blocked_until", "block_events")
    expected = windows.block_periods(with_flow_columns(parts[1]).where("event_type = 'error'"))
    assert _rows(state.settled_periods(rows), *columns) == _rows(expected, *columns)


def test_block_table_equals_batch(spark, parts, tmp_path):
    """Over batches out of order, and with a batch that is repeated."""
    out = str(tmp_path)
    process = state.block_table(out)
    for number, k in enumerate((2, 0, 3, 1)):
        batch = with_flow_columns(spark.read.parquet(f"{parts[0]}/{k}")).where("event_type = 'error'")
        for _ in range(1 + (number == 2)):
            process(batch, number)
    columns = ("src_ip", "blocked_from", "blocked_until", "block_events")
    expected = windows.block_periods(with_flow_columns(parts[1]).where("event_type = 'error'"))
    found = state.newest_periods(spark, out)
    assert _rows(found, *columns) == _rows(expected, *columns) and found.count() == expected.count() > 0
    plan = state.merged_pieces(state.block_pieces(with_flow_columns(parts[1])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_expired_periods_are_closed(spark, parts):
    blocks = _stream(spark, parts).where("event_type = 'error'")
    rows = dispatch.run_to_end(state.block_periods(blocks, "60 days"), spark, "open", "update")
    assert rows.where("closed").count() == 0  # the watermark never passes an expiry
    session = sources.stream_session(spark)
    some = session.readStream.schema(parts[1].schema).parquet(f"{parts[0]}/0")
    one = with_flow_columns(some.withColumn("ts", F.col("ts").cast("timestamp"))).where("event_type = 'error'")
    closed = dispatch.run_to_end(state.block_periods(one, "10 minutes"), spark, "closed", "update").where("closed")
    assert closed.count() > 0


@pytest.mark.parametrize(
    "periods, merged",
    [
        ([(0, 10, 1), (1_809, 1_900, 2)], [(0, 1_900, 3)]),
        ([(0, 10, 1), (1_810, 1_900, 2)], [(0, 10, 1), (1_810, 1_900, 2)]),
        ([(5_000, 5_000, 1), (0, 0, 1), (1_000, 4_000, 1)], [(0, 5_000, 3)]),
    ],
)
def test_merging_periods(periods, merged):
    assert state.merge_periods(periods, 1_800) == merged


def test_honeypot_flag_over_batches(spark, parts, tmp_path):
    out = str(tmp_path)
    hit = (F.col("event_type") == "click") & (F.col("k") < 30)
    process = dispatch.sticky_honeypot_flag(hit, out)
    stream = _stream(spark, parts).select("flow_id", "src_ip", "ts", "event_type", "k")
    dispatch.start(stream, process, f"{out}/checkpoint", refresh_seconds=None).awaitTermination()
    flagged = spark.read.parquet(f"{out}/flagged")
    source = with_flow_columns(parts[1])
    assert flagged.count() == source.count()
    first = source.where(hit).groupBy("src_ip").agg(F.min("ts").alias("first"))
    expected = source.join(first, "src_ip", "left").select(
        "flow_id", F.coalesce((F.col("ts") >= F.col("first")).cast("int"), F.lit(0)).alias("honeypot_flag")
    )
    # Files are read in name order, which is time order, so later batches know all earlier hits.
    assert _rows(flagged, "flow_id", "honeypot_flag") == _rows(expected, "flow_id", "honeypot_flag")


def test_a_repeated_batch_changes_nothing(spark, parts, tmp_path):
    out = str(tmp_path)
    process = dispatch.graded_dispatch(verdicts.by_rule_score, out)
    batch = with_flow_columns(parts[1])
    process(batch, 0)
    before = spark.read.json(f"{out}/alerts").count()
    process(batch, 0)
    assert spark.read.json(f"{out}/alerts").count() == before > 0
    assert spark.read.json(f"{out}/detections").count() == batch.count()


def test_repeats_are_suppressed(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:05:00", "a"), (3, "2024-01-01 00:00:01", "b")]
    spark.createDataFrame(rows, "event_id int, t string, src_ip string").select(
        "event_id", F.to_timestamp("t").alias("ts"), "src_ip", F.lit(22).alias("dst_port"), F.lit("BLOCK").alias("action")
    ).coalesce(1).write.parquet(str(tmp_path / "in"))
    session = sources.stream_session(spark)
    stream = session.readStream.schema(session.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    kept = dispatch.run_to_end(stream_windows.without_repeats(stream), spark, "repeats", "update")
    assert _rows(kept, "src_ip") == {("a",), ("b",)} and kept.count() == 2


def test_sessions_equal_batch_where_closed(spark, parts):
    rows = dispatch.run_to_end(stream_windows.sessions(_stream(spark, parts), "60 days"), spark, "none")
    assert rows.count() == 0  # nothing is closed before the watermark passes
    session = sources.stream_session(spark)
    stream = session.readStream.schema(parts[1].schema).parquet(f"{parts[0]}/*")
    one = with_flow_columns(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    closed = dispatch.run_to_end(stream_windows.sessions(one), spark, "sessions")
    columns = ("src_ip", "session_start", "last_event", "events")
    batch = _rows(windows.sessions(with_flow_columns(parts[1])), *columns)
    stream = _rows(closed, *columns)
    assert stream and stream <= batch


def test_log_tail(spark, tmp_path):
    lines = [
        '{"timestamp": "2024-01-01T00:00:00", "src_ip": "a", "prediction": 1, "label": 1, "action": "BLOCK"}',
        "broken",
        '{"timestamp": "2024-01-01T00:00:02", "src_ip": "b", "prediction": 0, "label": 0, "action": "ALLOW"}',
    ]
    (tmp_path / "log.json").write_text("\n".join(lines))
    log = sources.tail_detection_log(sources.stream_session(spark), str(tmp_path))
    stats = dispatch.run_to_end(stream_windows.rolling_detection_stats(log), spark, "stats", "complete")
    row = stats.orderBy(F.col("batch").desc()).first()
    assert (row["total_events"], row["attacks"], row["benign"], row["blocked"]) == (2, 1, 1, 1)
