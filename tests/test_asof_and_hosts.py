"""As-of join against a plain version, large reports host by host, correlations against numpy."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlens.operators import asof, profile
from scanlens.sources import scans


def _plain(rows, events):
    out = []
    for i, key, at in rows:
        known = [(t, v) for k, t, v in events if k == key and t is not None and at is not None and key is not None and t <= at]
        out.append((i, max(known)[1] if known else None))
    return sorted(out)


@pytest.mark.parametrize("cell", [10, 10_000])
def test_as_of_join_equals_plain_version(spark, cell):
    """Irregular events, ties, one key with most rows, one instant with many, missing keys and times."""
    draw = random.Random(1)
    rows = [(i, draw.choice(["hot"] * 8 + ["a", "b", None]), draw.choice([None, 500] + list(range(1000)))) for i in range(600)]
    events = [(draw.choice(["hot", "hot", "a", None]), draw.choice([500, 500, None] + list(range(0, 1000, 37))), draw.randrange(10_000)) for _ in range(80)]
    left = spark.createDataFrame(rows, "id int, key string, at long").withColumn("ts", F.timestamp_seconds("at")).withColumn("v", F.lit("replaced"))
    right = spark.createDataFrame(events, "key string, at long, v long").withColumn("ts", F.timestamp_seconds("at"))
    got = asof.as_of_join(left, right, ["v"], by=["key"], rows_per_cell=cell)
    assert got.columns == ["id", "key", "at", "ts", "v"]
    assert sorted(map(tuple, got.select("id", "v").collect())) == _plain(rows, events)
    whole = asof.as_of_join(left.drop("v"), right, ["v"], rows_per_cell=cell).select("id", "v").collect()
    assert sorted(map(tuple, whole)) == _plain([(i, 0, t) for i, _, t in rows], [(0, t, v) for _, t, v in events])
    assert asof.as_of_join(left, right.limit(0), ["v"], by=["key"]).where("v is not null").count() == 0
    assert asof.as_of_join(left.limit(0), right, ["v"], by=["key"]).count() == 0


def test_reports_host_by_host_equal_whole_reports(spark, tmp_path):
    host = '<host><address addr="10.0.0.{0}" addrtype="ipv4"/>\n<ports><port protocol="tcp" portid="{0}"><state state="{1}"/></port><port protocol="tcp" portid="9"><state state="open"/></port></ports></host>'
    plain = '<nmaprun args="-sU"><host><address addr="00:01" addrtype="mac"/></host></nmaprun>'
    (tmp_path / "many.xml").write_text('<?xml version="1.0"?>\n<nmaprun\n start="1" args="-sS -p 1-9">' + "\n".join(host.format(i % 250, "open" if i % 3 else "closed") for i in range(4000)) + "</nmaprun>\n")
    (tmp_path / "none.xml").write_text(plain)
    (tmp_path / "cut.xml").write_text('<nmaprun args="-sX">' + host.format(7, "open"))
    (tmp_path / "broken.xml").write_text('<nmaprun args="-sX">' + host.format(7, "open") + "<host><address></host></nmaprun>")
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "noargs.xml").write_text("<nmaprun>" + host.format(8, "open") + "</nmaprun>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # the large report is split
    try:
        reports, hosts = scans.read_scan_hosts(spark, str(tmp_path))
        assert hosts.rdd.getNumPartitions() > 5
        found = scans.summaries_of_hosts(reports, hosts)
        by_host = {(r.path.rsplit("/", 1)[1], r.scan_type, r.target_ip) for r in found.collect()}
        ports = scans.open_ports_of_hosts(found, hosts).groupBy("path").agg(F.sort_array(F.collect_list("open_port")).alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = scans.scan_summaries(scans.read_scan_reports(spark, str(tmp_path))).where("path not like '%cut.xml' and path not like '%empty.xml' and path not like '%broken.xml'").collect()
    assert by_host == {(r.path.rsplit("/", 1)[1], r.scan_type, r.target_ip) for r in whole}
    assert {r.path.rsplit("/", 1)[1]: r.p for r in ports} == {r.path.rsplit("/", 1)[1]: sorted(r.open_ports) for r in whole if r.open_ports}
    assert {r.path.rsplit("/", 1)[1] for r in reports.where("malformed").collect()} == {"cut.xml", "broken.xml"}


def test_correlations_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4)) * [1, 1e6, 1e-6, 1] + [0, 1e9, 5, 0]
    x[:, 3] = 7.25
    rows = [[None if (i * 7 + k) % 11 == 0 else float(v) for k, v in enumerate(r)] for i, r in enumerate(x)]
    frame = spark.createDataFrame(rows, "a double, `b c` double, d double, e double").repartition(6)
    got = {(r.feature_a, r.feature_b): r.correlation for r in profile.correlation_matrix(frame, frame.columns).collect()}
    assert len(got) == 16
    for i, p in enumerate(frame.columns):
        for j, q in enumerate(frame.columns):
            both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
            want = None if "e" in (p, q) else 1.0 if i == j else np.corrcoef(both.T)[0, 1]
            assert got[p, q] == (None if want is None else pytest.approx(want, abs=1e-7)), (p, q)


def test_hosts_of_reports_are_parsed_once(spark, tmp_path):
    """What reads the hosts reads a written table; none of it parses the reports again."""
    (tmp_path / "a.xml").write_text('<nmaprun args="-sS"><host><address addr="10.0.0.1" addrtype="ipv4"/><ports><port protocol="tcp" portid="22"><state state="open"/></port></ports></host></nmaprun>')
    reports, hosts = scans.read_scan_hosts(spark, str(tmp_path))
    for frame in (reports, hosts):
        assert "from_xml" not in frame._jdf.queryExecution().optimizedPlan().toString()
    found = scans.summaries_of_hosts(reports, hosts)
    assert [(r.scan_type, r.target_ip) for r in found.collect()] == [("syn", "10.0.0.1")]
    assert [r.open_port for r in scans.open_ports_of_hosts(found, hosts).collect()] == [22]
