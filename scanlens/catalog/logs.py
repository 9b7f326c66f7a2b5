"""Scan reports, probe classes, decoys, block lists and log statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.catalog.registry import FLOWS_SQL, query, rounded
from scanlens.functions import labels as L
from scanlens.functions.scalars import epoch_seconds
from scanlens.operators import asof, lookups, soc, windows
from scanlens.session import spread
from scanlens.sources import scans
from scanlens.sources.flows_view import flows, table


def _scan_texts(spark, folder):
    """One scan report per line item: two hosts, three ports, arguments and path by order key."""
    item = spread(
        table(spark, folder, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"
        )
    )
    state = F.when(F.col("l_returnflag") == "R", "open").when(F.col("l_returnflag") == "A", "closed").otherwise("open|filtered")
    line = F.when(F.col("l_linestatus") == "O", "open").otherwise("closed")
    variant = F.col("l_orderkey") % 8
    args = (
        F.when(variant == 0, "scan -sS -p 1-1000").when(variant == 1, "scan -sV").when(variant == 2, "scan -O")
        .when(variant == 3, "scan -A 10.0.0.1").when(variant == 4, "scan -sU").when(variant == 5, "scan -sX")
        .when(variant == 6, "scan -sS --scan-delay 500ms").otherwise("scan -sS -T4")
    )
    path = F.when(variant != 7, "scans/report.xml").when(F.col("l_linenumber") % 2 == 0, "scans/fast.xml").otherwise("scans/very_fast.xml")
    xml = F.format_string(
        '<?xml version="1.0"?><nmaprun args="%s"><host><address addr="10.1.%d.%d" addrtype="ipv4"/>'
        '<address addr="00:00:00:00:00:01" addrtype="mac"/><ports>'
        '<port protocol="tcp" portid="%d"><state state="%s"/></port><port protocol="tcp" portid="%d"><state state="%s"/></port>'
        '</ports></host><host><address addr="10.2.0.1" addrtype="ipv4"/><ports>'
        '<port protocol="tcp" portid="22"><state state="%s"/></port></ports></host></nmaprun>',
        args, F.col("l_suppkey") % 256, F.col("l_partkey") % 256,
        F.col("l_partkey") % 65536, state, F.col("l_suppkey") % 65536, line, state,
    )
    return item.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", xml.alias("xml"), path.alias("path"))


_SCAN_SQL = """i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag = 'R' AS r, l_linestatus = 'O' AS o,
    CASE l_orderkey % 8 WHEN 0 THEN 'syn' WHEN 1 THEN 'very_fast' WHEN 2 THEN 'unknown' WHEN 3 THEN 'aggressive' WHEN 4 THEN 'udp'
      WHEN 5 THEN 'xmas' WHEN 6 THEN 'slow' ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'fast' ELSE 'very_fast' END END AS scan_type FROM lineitem),
    p AS (SELECT *, 1 AS pos, l_partkey % 65536 AS port, r AS is_open FROM i
      UNION ALL SELECT *, 2, l_suppkey % 65536, o FROM i UNION ALL SELECT *, 3, 22, r FROM i),
    prof(profile, flow_duration, total_fwd_packets, syn_flag_count, rst_flag_count, ack_flag_count, flow_iat_mean, bwd_packet_length_mean, init_win_bytes_forward) AS
      (VALUES """ + ", ".join(str(profile) for profile in K.SCAN_PROFILES) + ")"

_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    "scan_report_features",
    f"""WITH {_SCAN_SQL} SELECT {_KEYS}, scan_type, '192.168.100.10' AS src_ip, CAST(port AS DOUBLE) AS dst_port, """
    + ", ".join(f"CAST(prof.{c} AS DOUBLE) AS {c}" for c in K.FEATURES[1:])
    + " FROM p JOIN prof ON prof.profile = CASE scan_type WHEN 'unknown' THEN 'syn' ELSE scan_type END WHERE is_open",
)
def scan_report_features(spark, folder):
    reports = scans.parse_scan_reports(_scan_texts(spark, folder), "xml", "path")
    return scans.scan_features(scans.scan_summaries(reports)).drop("path")


@query(
    "scan_open_ports",
    f"""WITH {_SCAN_SQL} SELECT {_KEYS}, scan_type, '10.2.0.1' AS target_ip,
    coalesce(string_agg(CAST(port AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE is_open), '') AS open_ports,
    CAST(count(*) FILTER (WHERE is_open) AS INTEGER) AS rows FROM p
    GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, scan_type, r, o""",
)
def scan_open_ports(spark, folder):
    summaries = scans.scan_summaries(scans.parse_scan_reports(_scan_texts(spark, folder), "xml", "path"))
    return summaries.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "scan_type", "target_ip",
        F.array_join(F.col("open_ports").cast("array<string>"), ",").alias("open_ports"),
        F.size("open_ports").alias("rows"),
    )


@query(
    "scan_port_states",
    f"""WITH {_SCAN_SQL} SELECT CASE pos WHEN 3 THEN 'second' ELSE 'first' END AS host,
    CASE WHEN pos = 2 THEN CASE WHEN o THEN 'open' ELSE 'closed' END
      ELSE CASE l_returnflag WHEN 'R' THEN 'open' WHEN 'A' THEN 'closed' ELSE 'open|filtered' END END AS state,
    count(*) AS ports FROM (SELECT l_returnflag, l_linestatus = 'O' AS o, unnest([1, 2, 3]) AS pos FROM lineitem) GROUP BY 1, 2""",
)
def scan_port_states(spark, folder):
    ports = scans.host_ports(scans.parse_scan_reports(_scan_texts(spark, folder), "xml", "path"))
    host = F.when(F.col("address") == "10.2.0.1", "second").otherwise("first")
    return ports.groupBy(host.alias("host"), "state").agg(F.count("port").alias("ports"))


@query(
    "tcp_flag_class",
    f"""WITH {FLOWS_SQL}, t AS (SELECT CASE event_id % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'F' WHEN 2 THEN 'FPU' WHEN 3 THEN '' ELSE 'SA' END AS flags FROM flows)
    SELECT flags, CASE WHEN flags = 'S' THEN 'SYN' WHEN flags IN ('F', 'FPU', '') THEN 'STEALTH' END AS scan_class, count(*) AS packets FROM t GROUP BY 1, 2""",
)
def tcp_flag_class(spark, folder):
    names = F.array(*[F.lit(x) for x in ("S", "F", "FPU", "", "SA")])
    flags = F.element_at(names, (F.col("event_id") % 5 + 1).cast("int"))
    packets = flows(spark, folder).select(flags.alias("flags"))
    return packets.groupBy("flags", L.tcp_scan_class(F.col("flags")).alias("scan_class")).agg(
        F.count(F.lit(1)).alias("packets")
    )


@query(
    "decoy_profile",
    f"""WITH {FLOWS_SQL} SELECT CASE CAST(dst_port AS BIGINT) % 5 WHEN 0 THEN 'data_leak' WHEN 1 THEN 'shell_mimicry'
    WHEN 2 THEN 'credential_harvest' WHEN 3 THEN 'ssh_latency' ELSE 'tool_breaker' END AS profile, count(*) AS flows,
    count(DISTINCT src_ip) AS sources FROM flows GROUP BY 1""",
)
def decoy_profile(spark, folder):
    return (
        flows(spark, folder)
        .groupBy(L.decoy_profile(F.col("dst_port")).alias("profile"))
        .agg(F.count(F.lit(1)).alias("flows"), F.count_distinct("src_ip").alias("sources"))
    )


@query(
    "honeypot_flag",
    f"""WITH {FLOWS_SQL}, h AS (SELECT DISTINCT src_ip FROM flows WHERE event_type = 'click' AND k < 5)
    SELECT flow_id, src_ip, CAST(src_ip IN (SELECT src_ip FROM h) AS INTEGER) AS honeypot_flag FROM flows""",
)
def honeypot_flag(spark, folder):
    source = flows(spark, folder)
    hits = source.where((F.col("event_type") == "click") & (F.col("k") < 5))
    return lookups.with_honeypot_flag(source.select("flow_id", "src_ip"), hits).select(
        "flow_id", "src_ip", "honeypot_flag"
    )


@query(
    "skip_banned",
    f"""WITH {FLOWS_SQL}, b AS (SELECT DISTINCT src_ip FROM flows WHERE event_type = 'error' AND k < 10)
    SELECT flow_id, src_ip FROM flows WHERE src_ip NOT IN (SELECT src_ip FROM b)
    AND src_ip NOT IN ('127.0.0.1', '0.0.0.0', 'localhost')""",
)
def skip_banned(spark, folder):
    source = flows(spark, folder)
    bans = source.where((F.col("event_type") == "error") & (F.col("k") < 10))
    return lookups.without_banned(source.select("flow_id", "src_ip"), bans).select("flow_id", "src_ip")


def _instants(source) -> list[int]:
    """Twelve late seconds with an error each, a minute after it."""
    second = epoch_seconds(F.col("ts"))
    rows = source.where(F.col("event_type") == "error").groupBy(F.col("event_id") % 12).agg((F.max(second) + 60).alias("t"))
    return [r["t"] for r in rows.collect()]


INSTANTS_SQL = """i AS (SELECT DISTINCT t FROM (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) + 60 AS t FROM flows WHERE event_type = 'error' GROUP BY event_id % 12))"""


@query(
    "block_list_active",
    f"""WITH {FLOWS_SQL}, {INSTANTS_SQL}, b AS (SELECT src_ip, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM flows WHERE event_type = 'error')
    SELECT t AS as_of, src_ip, max(sec) AS blocked_at, max(sec) + 1800 AS expires_at, count(*) AS block_events
    FROM b JOIN i ON sec <= t AND sec + 1800 > t GROUP BY t, src_ip""",
)
def block_list_active(spark, folder):
    source = flows(spark, folder)
    blocks = source.where(F.col("event_type") == "error")
    return lookups.active_blocks_at(blocks, _instants(source)).select(
        "as_of", "src_ip", "blocked_at", "expires_at", "block_events"
    )


BLOCK_PERIODS_SQL = f"""WITH {FLOWS_SQL}, s AS (SELECT src_ip, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM flows WHERE event_type = 'error'),
    m AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY src_ip ORDER BY sec) < 1800 THEN 0 ELSE 1 END AS opens FROM s),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY src_ip ORDER BY sec RANGE UNBOUNDED PRECEDING) AS period FROM m)
    SELECT src_ip, min(sec) AS blocked_from, max(sec) + 1800 AS blocked_until, CAST(count(*) AS BIGINT) AS block_events
    FROM n GROUP BY src_ip, period"""


@query("block_periods", BLOCK_PERIODS_SQL)
def block_periods(spark, folder):
    return windows.block_periods(flows(spark, folder).where(F.col("event_type") == "error"))


@query(
    "reaction_time",
    f"""WITH {FLOWS_SQL}, s AS (SELECT src_ip, min(CAST(floor(epoch(ts)) AS BIGINT)) AS scan_start FROM flows WHERE label = 'PortScan' GROUP BY 1),
    a AS (SELECT src_ip, min(CAST(floor(epoch(ts)) AS BIGINT)) AS first_alert FROM flows WHERE label = 'PortScan' AND score_a >= 0.85 GROUP BY 1)
    SELECT src_ip, scan_start, first_alert, first_alert - scan_start AS reaction_seconds FROM s JOIN a USING (src_ip)""",
)
def reaction_time(spark, folder):
    scanned = flows(spark, folder).where(F.col("label") == K.ATTACK_LABEL)
    return lookups.reaction_times(scanned, scanned.where(F.col("score_a") >= K.BLOCK_THRESHOLD))


def detection_log(spark, folder):
    """The events as a detection log."""
    kind = F.col("event_type")
    action = F.when(kind == "error", "BLOCK").when(kind == "signup", "ALERT").when(kind == "view", "MONITOR").otherwise("ALLOW")
    prediction = F.when(kind.isin("error", "signup"), 1).otherwise(0)
    return flows(spark, folder).select(
        "event_id",
        "ts",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "src_ip",
        F.col("dst_port").cast("int").alias("dst_port"),
        prediction.alias("prediction"),
        prediction.alias("label"),
        action.alias("action"),
    )


DETECTION_LOG_SQL = f"""{FLOWS_SQL}, det AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, src_ip,
    CAST(event_type IN ('error', 'signup') AS INTEGER) AS prediction,
    CASE event_type WHEN 'error' THEN 'BLOCK' WHEN 'signup' THEN 'ALERT' WHEN 'view' THEN 'MONITOR' ELSE 'ALLOW' END AS action FROM flows)"""

_DECEPTION_NAMES = {
    "click": "REDIRECT", "error": "BLACKLIST", "purchase": "MUTATE", "view": "ROTATE_DONE", "signup": "GHOST_SHIP_DETECTION",
}


def deception_log(spark, folder):
    """The events as a deception log: odd rows in the (event, ip) spelling, normalised."""
    name = F.col("event_type")
    for kind, event in _DECEPTION_NAMES.items():
        name = F.when(F.col("event_type") == kind, event).otherwise(name)
    odd = F.col("event_id") % 2 == 1
    details = F.concat(F.lit("Port: "), F.col("dst_port").cast("int"), F.lit(" | Mutated TTL: "), F.col("k"))
    raw = flows(spark, folder).select(
        "event_id",
        "ts",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(odd, name).alias("event"),
        F.when(~odd, name).alias("event_type"),
        F.when(odd, F.col("src_ip")).alias("ip"),
        F.when(~odd, F.col("src_ip")).alias("src_ip"),
        details.alias("details"),
        "props",
    )
    return soc.normalise_deception(raw)


DECEPTION_LOG_SQL = (
    f"{FLOWS_SQL}, dec AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, src_ip, dst_port, k, CASE event_type "
    + " ".join(f"WHEN '{kind}' THEN '{event}'" for kind, event in _DECEPTION_NAMES.items())
    + " END AS event_type FROM flows)"
)


@query(
    "detection_stats",
    f"""WITH {DETECTION_LOG_SQL} SELECT count(*) AS total_events, CAST(sum(prediction) AS BIGINT) AS attacks,
    CAST(count(*) - sum(prediction) AS BIGINT) AS benign, count(*) FILTER (WHERE action = 'BLOCK') AS blocked,
    round_even(100 * sum(prediction) / count(*), 1) AS attack_rate FROM det""",
)
def detection_stats(spark, folder):
    return soc.detection_stats(detection_log(spark, folder))


@query(
    "deception_stats",
    f"""WITH {DECEPTION_LOG_SQL} SELECT count(*) AS total_events, count(*) FILTER (WHERE event_type = 'REDIRECT') AS redirects,
    count(*) FILTER (WHERE event_type = 'BLACKLIST') AS blacklists,
    count(*) FILTER (WHERE event_type IN ('MUTATE', 'ROTATE_DONE')) AS mutations FROM dec""",
)
def deception_stats(spark, folder):
    return soc.deception_stats(deception_log(spark, folder))


@query(
    "deception_breakdown",
    f"WITH {DECEPTION_LOG_SQL} SELECT event_type, count(*) AS events FROM dec GROUP BY event_type",
)
def deception_breakdown(spark, folder):
    return soc.event_breakdown(deception_log(spark, folder))


_GRADE = "CASE WHEN blacklists > 0 THEN 'CRITICAL' WHEN redirects > 5 THEN 'HIGH' WHEN redirects > 2 THEN 'MEDIUM' ELSE 'LOW' END"


@query(
    "threat_level",
    f"""WITH {DECEPTION_LOG_SQL}, {INSTANTS_SQL}, s AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS sec, event_type FROM dec),
    t AS (SELECT t AS as_of, count(*) FILTER (WHERE event_type = 'REDIRECT') AS redirects, count(*) FILTER (WHERE event_type = 'BLACKLIST') AS blacklists
      FROM i LEFT JOIN s ON t - sec >= 0 AND t - sec < 300 GROUP BY t)
    SELECT as_of, redirects, blacklists, {_GRADE} AS threat_level FROM t""",
)
def threat_level(spark, folder):
    return soc.threat_levels(deception_log(spark, folder), _instants(flows(spark, folder)))


@query(
    "threat_history",
    f"""WITH {DECEPTION_LOG_SQL}, t AS (SELECT CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS slot_start,
      count(*) FILTER (WHERE event_type = 'REDIRECT') AS redirects, count(*) FILTER (WHERE event_type = 'BLACKLIST') AS blacklists FROM dec GROUP BY 1)
    SELECT slot_start, redirects, blacklists, {_GRADE} AS threat_level FROM t""",
)
def threat_history(spark, folder):
    return soc.threat_history(deception_log(spark, folder))


@query(
    "recent_events",
    f"""WITH {DETECTION_LOG_SQL}, dec AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, src_ip, dst_port, k, CASE event_type """
    + " ".join(f"WHEN '{kind}' THEN '{event}'" for kind, event in _DECEPTION_NAMES.items())
    + """ END AS event_type FROM flows),
    a AS (SELECT timestamp, 'detection' AS type, NULL AS event_type, det.src_ip, CAST(dst_port AS INTEGER) AS dst_port, prediction, prediction AS label,
      CAST(NULL AS VARCHAR) AS details, event_id FROM det JOIN (SELECT event_id, dst_port FROM flows) USING (event_id) ORDER BY timestamp DESC, event_id DESC LIMIT 50),
    b AS (SELECT timestamp, 'deception' AS type, event_type, src_ip, CAST(NULL AS INTEGER) AS dst_port, CAST(NULL AS INTEGER) AS prediction, CAST(NULL AS INTEGER) AS label,
      'Port: ' || CAST(dst_port AS INTEGER) || ' | Mutated TTL: ' || k AS details, event_id FROM dec ORDER BY timestamp DESC, event_id DESC LIMIT 50)
    SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) ORDER BY timestamp DESC, event_id DESC, type LIMIT 100""",
)
def recent_events(spark, folder):
    return soc.recent_events(detection_log(spark, folder), deception_log(spark, folder))


@query(
    "latest_per_log",
    f"""WITH {DETECTION_LOG_SQL}, r AS (SELECT action, event_id, row_number() OVER (PARTITION BY action ORDER BY ts DESC, event_id DESC) AS i FROM det)
    SELECT action, event_id FROM r WHERE i <= 20""",
)
def latest_per_log(spark, folder):
    log = detection_log(spark, folder).select("action", "event_id", "ts")
    return lookups.latest_per(log, "action", 20, "ts", "event_id").select("action", "event_id")


@query(
    "log_details",
    f"""WITH {DECEPTION_LOG_SQL} SELECT d.event_id, CAST(CAST(dst_port AS INTEGER) AS VARCHAR) AS port, CAST(d.k AS VARCHAR) AS ttl,
    CAST(d.k AS VARCHAR) AS k_text, '{{"k":"' || d.k || '"}}' AS details_json FROM dec d""",
)
def log_details(spark, folder):
    log = deception_log(spark, folder)
    parsed = soc.parse_details(F.col("details"))
    whole = F.struct("timestamp", "event_type", F.get_json_object("props", "$.k").alias("k"))
    kept = soc.object_details(F.to_json(whole))  # the two named keys go
    return log.select(
        "event_id",
        parsed["Port"].alias("port"),
        parsed["Mutated TTL"].alias("ttl"),
        kept["k"].alias("k_text"),
        F.to_json(kept).alias("details_json"),
    )


_ROTATION_LOG_SQL = """r AS (SELECT ts, max(CAST(1024 + (event_id * 7919) % 64000 AS INTEGER)) AS active_port, count(*) AS n
    FROM flows WHERE event_type = 'purchase' AND event_id % 7 = 0 GROUP BY ts)"""


@query(
    "active_port",
    f"""WITH {FLOWS_SQL}, {_ROTATION_LOG_SQL} SELECT flow_id, r.active_port,
    CAST(coalesce(abs(CAST(dst_port AS INTEGER) - r.active_port), 0) AS INTEGER) AS mtd_port_delta
    FROM flows ASOF LEFT JOIN r ON flows.ts >= r.ts""",
)
def active_port(spark, folder):
    """Port active at every flow's time, out of rotations logged at irregular times."""
    source = flows(spark, folder)
    rotations = source.where("event_type = 'purchase' AND event_id % 7 = 0").select("ts", (F.lit(1024) + (F.col("event_id") * 7919) % 64000).cast("int").alias("active_port"))
    return asof.with_active_port(source, rotations).select("flow_id", "active_port", "mtd_port_delta")


@query(
    "last_block_before",
    f"""WITH {FLOWS_SQL}, s AS (SELECT *, CASE WHEN k < 60 THEN 'hot' ELSE src_ip END AS source FROM flows),
    b AS (SELECT source, ts, max(event_id) AS block FROM s WHERE event_type = 'error' GROUP BY source, ts)
    SELECT s.flow_id, b.block FROM s ASOF LEFT JOIN b ON s.source = b.source AND s.ts >= b.ts""",
)
def last_block_before(spark, folder):
    """Last block of a flow's source at its time; one source has most of the flows."""
    source = F.when(F.col("k") < 60, "hot").otherwise(F.col("src_ip"))
    named = flows(spark, folder).withColumn("source", source)
    blocks = named.where("event_type = 'error'").select("source", "ts", F.col("event_id").alias("block"))
    return asof.as_of_join(named, blocks, ["block"], by=["source"]).select("flow_id", "block")


_REPORTS = 16
_REPORT_SQL = f"""i AS (SELECT l_orderkey % {_REPORTS} AS report, l_orderkey, l_linenumber, l_partkey % 65536 AS port, l_returnflag = 'R' AS r FROM lineitem),
    t AS (SELECT report, CASE report % 4 WHEN 0 THEN 'syn' WHEN 1 THEN 'udp' WHEN 2 THEN 'xmas' ELSE 'unknown' END AS scan_type FROM i GROUP BY report)"""


def _scan_files(spark, folder):
    """Large scan reports as files, one host per line item; two of them are cut short or broken."""
    from scanlens.session import shared_folder

    report = F.col("l_orderkey") % _REPORTS
    state = F.when(F.col("l_returnflag") == "R", "open").otherwise("closed")
    host = F.format_string(
        '<host><address addr="00:00:00:00:00:01" addrtype="mac"/><address addr="10.1.%d.%d" addrtype="ipv4"/><ports>\n'
        '<port protocol="tcp" portid="%d"><state state="%s"/></port></ports></host>',
        F.col("l_suppkey") % 256, F.col("l_partkey") % 256, F.col("l_partkey") % 65536, state,
    )
    lines = table(spark, folder, "lineitem").select(report.alias("report"), F.col("l_orderkey").alias("a"), F.col("l_linenumber").alias("b"), host.alias("value"))
    args = F.when(F.col("id") % 4 == 0, "scan -sS -p 1-1000").when(F.col("id") % 4 == 1, "scan -sU").when(F.col("id") % 4 == 2, "scan -sX").otherwise("scan -O")
    ids = spark.range(_REPORTS)
    head = ids.select(F.col("id").alias("report"), F.lit(-1).alias("a"), F.lit(0).alias("b"), F.format_string('<?xml version="1.0"?>\n<nmaprun scanner="x"\n args="%s">', args).alias("value"))
    tail = ids.select(F.col("id").alias("report"), F.lit(2**62).alias("a"), F.lit(0).alias("b"), F.when(F.col("id") == 5, "").otherwise("</nmaprun>").alias("value"))
    bad = ids.where("id = 6").select(F.col("id").alias("report"), F.lit(2**61).alias("a"), F.lit(0).alias("b"), F.lit("<host><address></host>").alias("value"))
    root = shared_folder(spark, "scan-files")
    whole = head.unionByName(lines).unionByName(tail).unionByName(bad)
    whole.repartition("report").sortWithinPartitions("report", "a", "b").select("report", "value").write.partitionBy("report").text(root)
    return root


@query(
    "scan_file_features",
    f"""WITH {_REPORT_SQL} SELECT CAST(t.report AS BIGINT) AS report, t.scan_type, CAST(count(i.port) FILTER (WHERE r) AS BIGINT) AS open_ports,
    CAST(sum(i.port) FILTER (WHERE r) AS BIGINT) AS port_sum FROM t JOIN i USING (report) WHERE t.report NOT IN (5, 6) GROUP BY ALL""",
)
def scan_file_features(spark, folder):
    """Open ports of large report files, each split at its hosts; malformed files are set aside."""
    reports, hosts = scans.read_scan_hosts(spark, _scan_files(spark, folder), "*.txt")
    summaries = scans.summaries_of_hosts(reports, hosts)
    features = scans.port_features(scans.open_ports_of_hosts(summaries, hosts))
    counted = features.groupBy("path").agg(F.count(F.lit(1)).alias("open_ports"), F.sum(F.col("dst_port").cast("long")).alias("port_sum"))
    number = F.regexp_extract("path", r"report=(\d+)", 1).cast("long")
    found = summaries.join(counted, "path", "left")
    return found.select(number.alias("report"), "scan_type", F.coalesce("open_ports", F.lit(0).cast("long")).alias("open_ports"), "port_sum")
