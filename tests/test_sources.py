"""Flow files, event logs and scan reports."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.operators import clean, soc
from scanlens.plans.replay import scans_to_csv
from scanlens.schemas import DETECTION_SCHEMA
from scanlens.sources import files, scans

HEADER = "Source IP, Destination Port, Flow Duration, Total Fwd Packets,SYN Flag Count,RST Flag Count,ACK Flag Count,Flow IAT Mean,Bwd Packet Length Mean,Init_Win_bytes_forward,Label"


@pytest.fixture()
def flow_file(tmp_path):
    path = tmp_path / "flows.csv"
    path.write_text(
        HEADER + "\n10.0.0.1, 22, 100,1,0,0,5,Infinity,1.5,1024,BENIGN\n10.0.0.2, 80, NaN,2,1,0,0,3.5,0,29200,PortScan\n"
    )
    return str(path)


def test_flow_file_names_and_types(spark, flow_file):
    df = files.to_short_names(files.read_flows_csv(spark, flow_file))
    assert df.columns == ["src_ip", *K.FEATURES, "label"]
    assert {t for n, t in df.dtypes if n in K.FEATURES} == {"double"}
    rows = clean.non_finite_to_null(df).orderBy("src_ip").collect()
    assert rows[0]["flow_iat_mean"] is None and rows[1]["flow_duration"] is None
    assert rows[0]["dst_port"] == 22.0


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,Label\n1,2,x\n3,oops,y\n5,6,z,7\n8,9,w\n")
    kept = files.read_flows_csv(spark, str(path), bad_lines="skip")
    assert kept.count() == 3 and kept.select("a").count() == 3
    assert {(r["a"], r["b"]) for r in kept.collect()} == {(1.0, 2.0), (3.0, None), (8.0, 9.0)}
    marked = files.read_flows_csv(spark, str(path), bad_lines="quarantine").cache()
    assert marked.count() == 4 and [r["_corrupt_record"] for r in marked.where("_corrupt_record is not null").collect()] == ["5,6,z,7"]
    with pytest.raises(Exception):
        files.read_flows_csv(spark, str(path)).collect()
    with pytest.raises(ValueError):
        files.read_flows_csv(spark, str(path), bad_lines="maybe")


def test_first_existing_and_many(spark, tmp_path, flow_file):
    df = files.read_first_existing(spark, [str(tmp_path / "none.csv"), flow_file])
    assert df.count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_first_existing(spark, [str(tmp_path / "none.csv")])
    other = tmp_path / "other.csv"
    other.write_text("Destination Port,Extra\n443,7\n")
    both = files.read_many_flows(spark, [flow_file, str(other)])
    assert both.count() == 3 and both.where("Extra is null").count() == 2


def test_repeated_header_names(spark):
    df = spark.createDataFrame([(1, 2)], ["x", "y"]).toDF(" a", "a ")
    assert clean.strip_names(df).columns == ["a", "a_1"]


def test_feature_contract_modes(spark, caplog):
    df = spark.createDataFrame([(1.0,)], "dst_port double")
    with pytest.raises(ValueError, match="flow_duration"):
        clean.require_features(df)
    assert clean.require_features(df, mode="warn").columns == ["dst_port"]
    assert clean.require_features(df, mode="default0").columns == K.FEATURES
    assert len(K.MODEL_FEATURES) == 11


def test_dropped_rows_are_observed(spark):
    from pyspark.sql import Observation

    seen = Observation("drop")
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, None)], "a double, b double")
    assert clean.drop_incomplete(df, observation=seen).count() == 1
    assert seen.get == {"rows": 3, "dropped": 2}


def _entry(i):
    return {"timestamp": f"2024-01-01T00:00:0{i}", "src_ip": "10.0.0.5", "prediction": i % 2, "label": i % 2, "action": "BLOCK"}


@pytest.mark.parametrize("shape", ["lines", "one_line_array", "pretty_array", "single", "blank_and_bad", "empty", "absent"])
def test_event_log_shapes(spark, tmp_path, shape):
    entries = [_entry(0), _entry(1)]
    text = {
        "lines": "\n".join(json.dumps(e) for e in entries) + "\n",
        "one_line_array": json.dumps(entries),
        "pretty_array": json.dumps(entries, indent=2),
        "single": json.dumps(entries[0]),
        "blank_and_bad": "\n" + json.dumps(entries[0]) + "\n\n{broken\n" + json.dumps(entries[1]) + "\n",
        "empty": "",
        "absent": None,
    }[shape]
    path = tmp_path / "log.json"
    if text is not None:
        path.write_text(text)
    log = files.read_detection_log(spark, str(path))
    assert log.schema.names == DETECTION_SCHEMA.names
    assert log.count() == {"single": 1, "empty": 0, "absent": 0}.get(shape, 2)


def test_append_and_read_back(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([_entry(1)], DETECTION_SCHEMA)
    files.append_log(row, path)
    files.append_log(row, path)
    log = files.read_detection_log(spark, path)
    assert log.count() == 2
    assert soc.detection_stats(log).first().asDict() == {
        "total_events": 2, "attacks": 2, "benign": 0, "blocked": 2, "attack_rate": 100.0,
    }


def test_stats_of_empty_log(spark, tmp_path):
    log = files.read_detection_log(spark, str(tmp_path / "absent"))
    assert soc.detection_stats(log).first()["attack_rate"] == 0.0


def test_both_deception_spellings(spark, tmp_path):
    path = tmp_path / "deception.json"
    lines = [
        {"timestamp": "2024-01-01 00:00:00", "event": "REDIRECT", "ip": "10.0.0.1", "details": "Port: 22 | Mutated TTL: 64"},
        {"timestamp": "2024-01-01T00:00:10", "event_type": "BLACKLIST", "src_ip": "10.0.0.2", "details": ["a", "b"]},
        {"timestamp": "not a time", "event_type": "MUTATE", "src_ip": "10.0.0.3", "details": ""},
    ]
    path.write_text("\n".join(map(json.dumps, lines)))
    log = soc.with_event_time(soc.normalise_deception(files.read_deception_log(spark, str(path)))).cache()
    assert {r["src_ip"] for r in log.collect()} == {"10.0.0.1", "10.0.0.2", "10.0.0.3"}
    assert log.where("ts is null").count() == 1
    stats = soc.deception_stats(log).first()
    assert (stats["redirects"], stats["blacklists"], stats["mutations"]) == (1, 1, 1)
    as_of = int(log.agg(F.max(F.unix_timestamp("ts")).alias("m")).first()["m"])
    assert soc.threat_level(log, as_of).first()["threat_level"] == "CRITICAL"
    assert soc.threat_level(log, as_of + 300).first()["threat_level"] == "LOW"  # exactly 300 s old is out
    assert soc.threat_level(log, as_of + 86_400 + 10).first()["threat_level"] == "LOW"  # a day later too
    parsed = log.where("src_ip = '10.0.0.1'").select(soc.parse_details(F.col("details")).alias("d")).first()["d"]
    assert parsed == {"Port": "22", "Mutated TTL": "64"}


def _report(args, hosts):
    def port(number, state):
        return f'<port protocol="tcp" portid="{number}"><state state="{state}"/><service name="x"/></port>'

    body = "".join(
        "<host><address addr='{}' addrtype='ipv4'/><address addr='08:00' addrtype='mac'/><ports>"
        "<extraports state='closed' count='9'/>{}</ports></host>".format(ip, "".join(port(*p) for p in ports))
        for ip, ports in hosts
    )
    return f'<?xml version="1.0"?><!DOCTYPE nmaprun><!-- note --><nmaprun scanner="x" args="{args}">{body}</nmaprun>'


OPEN = [(22, "open"), (80, "open"), (81, "closed")]
# file name, arguments, ports, expected type, expected rows
REPORTS = [
    ("01_syn", "-sS -p 1-1000", OPEN, "syn", 2),
    ("02_full", "-sS -p-", OPEN, "syn", 2),
    ("03_service", "-sV", OPEN, "very_fast", 2),
    ("04_os", "-O", OPEN, "unknown", 2),
    ("05_aggr", "-A 10.0.0.9", OPEN, "aggressive", 2),
    ("06_udp", "-sU", [(53, "closed")], "udp", 0),
    ("07_xmas", "-sX", [(22, "open|filtered"), (80, "open|filtered")], "xmas", 0),
    ("08_delay", "-sS &#45;-scan-delay 500ms", OPEN, "slow", 2),
    ("09_fast", "-sS -T4", OPEN, "fast", 2),
    ("10_very_fast", "-sS -T5", OPEN, "very_fast", 2),
]


@pytest.fixture()
def report_folder(tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()
    for name, args, ports, _, _ in REPORTS:
        (folder / f"{name}.xml").write_text(_report(args, [("10.0.0.1", []), ("10.0.0.2", ports)]))
    (folder / "11_broken.xml").write_text("<nmaprun args='x'><host>")
    (folder / "ignored.txt").write_text("not a report")
    return str(folder)


def test_scan_reports(spark, report_folder):
    reports = scans.read_scan_reports(spark, report_folder)
    found = {r["path"].rsplit("/", 1)[-1][:-4]: r for r in scans.scan_summaries(reports).collect()}
    assert {n: found[n]["scan_type"] for n, *_ in REPORTS} == {n: kind for n, _, _, kind, _ in REPORTS}
    assert {found[n]["target_ip"] for n, *_ in REPORTS} == {"10.0.0.2"}  # the last host wins
    rows = scans.scan_features(scans.scan_summaries(reports))
    assert rows.count() == 16
    unknown = rows.where("scan_type = 'unknown'").first()
    assert unknown["flow_duration"] == 5000.0 and unknown["src_ip"] == "192.168.100.10"
    assert sum(r["rows"] for r in scans.rows_per_report(scans.scan_summaries(reports)).collect()) == 16


def test_hosts_without_ports_are_kept(spark, report_folder):
    ports = scans.host_ports(scans.read_scan_reports(spark, report_folder))
    assert ports.where("address = '10.0.0.1' and port is null").count() == len(REPORTS)


def test_scans_to_csv(spark, report_folder, tmp_path):
    out = str(tmp_path / "features")
    scans_to_csv(spark, report_folder, out)
    df = files.read_flows_csv(spark, out)
    assert df.count() == 16 and df.columns == ["Source IP", *[long for _, long in K.FEATURE_COLUMNS]]


def test_manifest_and_names(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "source string")
    files.write_manifest(df, str(tmp_path / "manifest"))
    found = spark.read.json(str(tmp_path / "manifest"))
    assert {(r["source"], r["rows"]) for r in found.collect()} == {("a", 2), ("b", 1)}
    files.write_names(spark, K.MODEL_FEATURES, str(tmp_path / "names"))
    assert files.read_names(spark, str(tmp_path / "names")) == K.MODEL_FEATURES
