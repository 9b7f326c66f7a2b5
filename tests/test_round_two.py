"""Inputs on which earlier plans failed or gave other rows."""

from __future__ import annotations

import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from scanlens.operators import lookups, ranking, verdicts
from scanlens.session import scratch, shared_folder, written
from scanlens.sources import files
from scanlens.streaming import dispatch
from scanlens.streaming import windows as stream_windows


def test_swapped_headers_are_told_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Flow Duration, Total Fwd Packets,Label\n10,20,x\n")
    (tmp_path / "b.csv").write_text("Total Fwd Packets,Flow Duration,Label,More\n21,11,y,5\n")
    (tmp_path / "c.csv").write_text("Flow Duration, Total Fwd Packets,Label\n12,22,z\n")
    for source in (str(tmp_path), [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")], f"{tmp_path}/*.csv"):
        for mode in ("error", "skip", "quarantine"):
            rows = files.read_flows_csv(spark, source, bad_lines=mode)
            got = {(r["Label"], r["Flow Duration"], r["Total Fwd Packets"], r["More"]) for r in rows.collect()}
            assert got == {("x", 10.0, 20.0, None), ("y", 11.0, 21.0, 5.0), ("z", 12.0, 22.0, None)}


def test_short_lines_stay_and_long_lines_go(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("a,b,Label\n1,2,x\n3\n4,5,y,9\n6,7,z,\n,8,w\n")
    rows = {(r["a"], r["b"], r["Label"]) for r in files.read_flows_csv(spark, str(path), bad_lines="skip").collect()}
    assert rows == {(1.0, 2.0, "x"), (3.0, None, None), (6.0, 7.0, "z"), (None, 8.0, "w")}


def test_repeated_header_names_of_a_file(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('"x, y",a, A ,,Label\n1,2,3,4,l\n')
    row = files.read_flows_csv(spark, str(path)).first().asDict()
    assert sorted(v for v in row.values() if isinstance(v, float)) == [1.0, 2.0, 3.0, 4.0] and row["Label"] == "l"


def test_row_keys_follow_from_content(spark):
    rows = [(float(i % 7), None if i % 3 else float("nan"), "x") for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c string")
    one, two = (files.with_row_key(d) for d in (df.repartition(3), df.repartition(7, "a").orderBy("a")))
    first, second = ({r["flow_id"]: (r["a"], str(r["b"])) for r in d.collect()} for d in (one, two))
    assert first == second and len(first) == 200


def test_numbers_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(files, "_STEP", 4)
    df = spark.range(23).select(F.lit(1).alias("a"))
    keys = [r["flow_id"] for r in files.with_row_key(df).collect()]
    assert len(set(keys)) == 23 and {int(k.split("#")[1]) for k in keys} == set(range(23))


def test_infinite_order_values(spark):
    values = [float(i) for i in range(300)] + [math.inf] * 90 + [-math.inf] * 90 + [None, math.nan]
    df = spark.createDataFrame([(str(i), "s", v) for i, v in enumerate(values)], "flow_id string, src_ip string, v double")
    plain = ranking.rank_within(df, "src_ip", "v")
    cut = ranking.rank_within(df, "src_ip", "v", rows_per_bucket=40)
    assert {tuple(r) for r in plain.select("flow_id", "row_rank").collect()} == {tuple(r) for r in cut.select("flow_id", "row_rank").collect()}


def test_two_levels_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_LEVEL", 5)
    df = spark.range(900).select(F.col("id").cast("string").alias("flow_id"), F.lit("s").alias("src_ip"), (F.col("id") * 7 % 450).cast("double").alias("v"))
    assert len(ranking.split_points(df, "v", 900, 40)) > 10
    plain, cut = (ranking.rank_within(df, "src_ip", "v", rows_per_bucket=n) for n in (10_000, 40))
    assert {tuple(r) for r in plain.select("flow_id", "row_rank").collect()} == {tuple(r) for r in cut.select("flow_id", "row_rank").collect()}
    once = df.where("cast(flow_id as int) < 450")
    totals = [ranking.running_totals(once.withColumn("one", F.lit(1)), "v", ["one"], rows_per_bucket=n) for n in (10_000, 20)]
    assert len({tuple(sorted(map(tuple, t.select("v", "cum_one").collect()))) for t in totals}) == 1


def test_many_strata(spark):
    df = spark.range(4_000).select(F.col("id").cast("string").alias("flow_id"), (F.col("id") % 1_000).alias("s"))
    marked = ranking.mark_smallest_hashes(df, "s", lambda sizes: {s: 1 for s in sizes})
    counts = marked.where("chosen").groupBy("s").count().collect()
    assert len(counts) == 1_000 and {r["count"] for r in counts} == {1}
    with_null = df.withColumn("s", F.when(F.col("s") != 5, F.col("s")))
    marked = ranking.mark_smallest_hashes(with_null, "s", lambda sizes: dict.fromkeys(sizes, 2))
    assert {r["count"] for r in marked.where("chosen").groupBy("s").count().collect()} == {2}


def test_rows_without_a_key(spark):
    big = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("127.0.0.1", 5)], "src_ip string, n int")
    table = spark.createDataFrame([("a", "x"), (None, "never")], "src_ip string, v string")
    for limit in (1_000, 0):
        got = {r["n"]: r["v"] for r in lookups.attach_by_key(big, table, "src_ip", broadcast_rows=limit).collect()}
        assert got == {1: None, 2: None, 3: "x", 4: None, 5: None}
    kept = lookups.without_banned(big, table.select("src_ip"))
    assert {r["n"] for r in kept.collect()} == {1, 2, 4}


def test_severity_needs_a_vote(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0.3), (0.9, 0.1, 0.1), (0.95, 0.9, 0.8), (0.99, 0.97, 0.96)], "a double, b double, c double")
    rows = verdicts.with_severity(df, ["a", "b", "c"]).orderBy("a").collect()
    got = [(r["severity"], r["redirect"], r["blacklist"], r["mutate_port"]) for r in rows]
    assert got == [(None, False, False, False), ("LOW", True, False, False), ("MEDIUM", True, True, False), ("HIGH", True, True, True)]


@pytest.mark.parametrize("parts", [1, 3, 30])
def test_repeats_do_not_depend_on_batches(spark, tmp_path, parts):
    alerts = spark.range(600).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 37 % 5_000).alias("ts"),
        (F.col("id") % 5).cast("string").alias("src_ip"),
        F.lit(1.0).alias("dst_port"),
        F.lit("BLOCK").alias("action"),
    )
    for i in range(parts):
        alerts.where(F.col("event_id") % parts == i).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(alerts.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    rows = dispatch.run_to_end(stream_windows.without_repeats(stream, watermark="1 day"), spark, "repeats", "update")
    got = dispatch.last_update(rows, ["src_ip", "dst_port", "action", "slot"])
    slot = F.floor(F.unix_timestamp("ts") / 600)
    want = alerts.groupBy("src_ip", slot.alias("slot")).agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.count("*").alias("repeats"))
    columns = ["src_ip", "slot", "event_id", "repeats"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_scratch_tables_go(spark):
    with scratch(spark):
        kept = written(spark.range(3), "mine")
        path = kept.inputFiles()[0]
        assert kept.count() == 3
    assert not files.path_exists(spark, path) and shared_folder(spark, "x") != shared_folder(spark, "x")


def test_workers_get_the_package(tmp_path):
    """From another folder, without the repository on the workers' path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from scanlens.session import build_session\n"
        "import scanlens.streaming.state as s\n"
        "spark = build_session('away', master='local[1]', spark__ui__enabled='false')\n"
        "f = lambda it: ((__import__('scanlens.streaming.state').streaming.state.TTL_SECONDS, b)[1] for b in it)\n"
        "print('rows', spark.range(3).mapInArrow(f, 'id long').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 3" in out.stdout, out.stderr[-2000:]
