"""Per-source aggregates, alignment, engineering, splits and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.catalog.registry import FLOWS_SQL, query, rounded
from scanlens.functions.scalars import epoch_seconds
from scanlens.operators import align, chunks, engineer, lookups, ranking, windows
from scanlens.sources.flows_view import flows, table


@query(
    "distinct_ports_per_source",
    f"""WITH {FLOWS_SQL}, d AS (SELECT src_ip, count(DISTINCT dst_port) AS distinct_ports FROM flows GROUP BY src_ip)
    SELECT flow_id, src_ip, dst_port, distinct_ports FROM flows JOIN d USING (src_ip)""",
)
def distinct_ports_per_source(spark, folder):
    slim = flows(spark, folder).select("flow_id", "src_ip", "dst_port")
    return lookups.with_distinct_ports(slim).select("flow_id", "src_ip", "dst_port", "distinct_ports")


def _chunk_sql(group: str) -> str:
    return f"""WITH {FLOWS_SQL}, g AS (SELECT *, {group} AS grp FROM flows),
    r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY flow_duration, md5(flow_id || '|42'), flow_id) - 1 AS i,
      count(*) OVER (PARTITION BY grp) AS n FROM g),
    c AS (SELECT *, CAST(floor(i / least(n, greatest(2, n // 3))) AS BIGINT) AS chunk FROM r WHERE n >= 2),
    lab AS (SELECT grp, chunk, label, row_number() OVER (PARTITION BY grp, chunk ORDER BY count(*) DESC, label) AS k
      FROM c GROUP BY grp, chunk, label)
    SELECT c.grp, c.chunk, round(avg(flow_iat_mean) + 1e-7, 4) AS iat_mean, count(*) AS flow_count,
      count(DISTINCT dst_port) AS distinct_ports,
      round(avg(CASE WHEN syn_flag_count > 0 THEN 1.0 ELSE 0.0 END), 6) AS syn_ratio,
      round(avg(flow_duration) + 1e-7, 4) AS avg_flow_duration, sum(total_fwd_packets) AS total_fwd_packets,
      max(bwd_packet_length_mean) AS max_packet_length, lab.label
    FROM c JOIN lab ON c.grp = lab.grp AND c.chunk = lab.chunk AND lab.k = 1
    GROUP BY c.grp, c.chunk, lab.label HAVING count(*) >= 2"""


def _chunk_report(source, group):
    report = chunks.chunk_statistics(source, group, max_length="bwd_packet_length_mean")
    return report.select(
        F.col(group).alias("grp"),
        "chunk",
        rounded("iat_mean", 4, 1e-7).alias("iat_mean"),
        "flow_count",
        "distinct_ports",
        rounded("syn_ratio").alias("syn_ratio"),
        rounded("avg_flow_duration", 4, 1e-7).alias("avg_flow_duration"),
        "total_fwd_packets",
        "max_packet_length",
        "label",
    )


@query("ordered_chunk_agg", _chunk_sql("src_ip"))
def ordered_chunk_agg(spark, folder):
    return _chunk_report(flows(spark, folder), "src_ip")


@query("port_bucket_fallback", _chunk_sql("CAST(dst_port AS BIGINT) % 50"))
def port_bucket_fallback(spark, folder):
    return _chunk_report(chunks.port_groups(flows(spark, folder)), "src_group")


# Two foreign sources: line items under flow-meter names, orders under Argus names.
# Most map targets have no source column there and take the 0.0 default.


def _flowmeter_source(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                    F.col("l_quantity").cast("bigint"), F.floor(F.col("l_extendedprice") * 100)).alias("flow_id"),
        (F.col("l_partkey") % 65536).alias("Dst Port"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("Flow Duration"),
        F.col("l_linenumber").alias("Tot Fwd Pkts"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("SYN Flag Cnt"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("RST Flag Cnt"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("Flow IAT Mean"),
        F.col("l_tax").alias("Bwd Pkt Len Mean"),
        F.when(F.col("l_linestatus") == "O", 1024).otherwise(29200).alias("Init Fwd Win Byts"),
        F.when(F.col("l_returnflag") == "A", "Bot PortScan").when(F.col("l_returnflag") == "R", "Infilteration")
        .otherwise("Benign").alias("Label"),
    )


_FLOWMETER_SQL = """lm AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT),
    CAST(floor(l_extendedprice * 100) AS BIGINT)) AS flow_id, CAST(l_partkey % 65536 AS DOUBLE) AS dst_port,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS flow_duration,
    CAST(l_linenumber AS DOUBLE) AS total_fwd_packets,
    CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS syn_flag_count,
    CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS rst_flag_count, 0.0::DOUBLE AS ack_flag_count,
    l_extendedprice / l_quantity AS flow_iat_mean, l_tax AS bwd_packet_length_mean,
    CASE WHEN l_linestatus = 'O' THEN 1024.0::DOUBLE ELSE 29200.0::DOUBLE END AS init_win_bytes_forward,
    CASE l_returnflag WHEN 'A' THEN 'Bot PortScan' WHEN 'R' THEN 'Infilteration' ELSE 'Benign' END AS label FROM lineitem)"""


def _argus_source(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("flow_id"),
        (F.col("o_custkey") % 100).alias("ct_dst_sport_ltm"),
        F.col("o_totalprice").alias("dur"),
        (F.col("o_orderkey") % 9).alias("spkts"),
        (F.col("o_totalprice") / 10).alias("sinpkt"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("-")).otherwise((F.col("o_custkey") % 7).cast("string")).alias("dmean"),
        F.lit("255").alias("swin"),
        F.when(F.col("o_orderstatus") == "P", "Reconnaissance").otherwise(F.lit(None).cast("string")).alias("attack_cat"),
        F.when(F.col("o_orderstatus") == "O", 0).otherwise(1).alias("label"),
    )


_ARGUS_SQL = """ar AS (SELECT CAST(o_orderkey AS VARCHAR) AS flow_id, CAST(o_custkey % 100 AS DOUBLE) AS dst_port,
    o_totalprice AS flow_duration, CAST(o_orderkey % 9 AS DOUBLE) AS total_fwd_packets, 0.0::DOUBLE AS syn_flag_count,
    0.0::DOUBLE AS rst_flag_count, 0.0::DOUBLE AS ack_flag_count, o_totalprice / 10 AS flow_iat_mean,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 7 AS DOUBLE) END AS bwd_packet_length_mean,
    255.0::DOUBLE AS init_win_bytes_forward, o_orderstatus FROM orders)"""

_ALIGNED = (
    "flow_id, dst_port, round(flow_duration + 1e-9, 6) AS flow_duration, total_fwd_packets, syn_flag_count, rst_flag_count, "
    "ack_flag_count, round(flow_iat_mean + 1e-9, 6) AS flow_iat_mean, bwd_packet_length_mean, init_win_bytes_forward, "
    "0.0::DOUBLE AS shadow_node_interaction, 0.0::DOUBLE AS mtd_port_delta"
)


def _rounded_contract(df, extra=()):
    return df.select(
        "flow_id", "source", *extra,
        *[rounded(c, 6, 1e-9).alias(c) if c in ("flow_duration", "flow_iat_mean") else F.col(c) for c in K.MODEL_FEATURES],
    )


@query(
    "align_schema",
    f"""WITH {_FLOWMETER_SQL}, {_ARGUS_SQL}
    SELECT 'flowmeter' AS source, {_ALIGNED} FROM lm WHERE flow_duration IS NOT NULL
    UNION ALL SELECT 'argus' AS source, {_ALIGNED} FROM ar WHERE bwd_packet_length_mean IS NOT NULL""",
)
def align_schema(spark, folder):
    parts = [
        align.to_contract(_flowmeter_source(spark, folder), K.FLOWMETER_V3_MAP, "flowmeter", ["flow_id"]),
        align.to_contract(_argus_source(spark, folder), K.ARGUS_MAP, "argus", ["flow_id"]),
    ]
    return _rounded_contract(align.combine(parts))


_RECON_SQL = f"""WITH {FLOWS_SQL}, t AS (SELECT flow_id, label,
    CASE WHEN regexp_matches(lower(label), 'recon|portscan|port scan|infilteration') THEN 'attack'
         WHEN regexp_matches(lower(label), 'benign') THEN 'benign' END AS kind FROM flows),
    n AS (SELECT count(*) AS attacks FROM t WHERE kind = 'attack'),
    r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5(flow_id || '|42'), flow_id) AS i FROM t)
    SELECT flow_id, label FROM r, n WHERE kind = 'attack' OR (kind = 'benign' AND i <= attacks)"""


@query("recon_filter_balance", _RECON_SQL)
def recon_filter_balance(spark, folder):
    return align.recon_subset(flows(spark, folder).select("flow_id", "label"), "label")


@query(
    "category_filter_balance",
    f"""WITH {_ARGUS_SQL}, n AS (SELECT count(*) AS attacks FROM ar WHERE o_orderstatus = 'P'),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(flow_id || '|42'), flow_id) AS i FROM ar)
    SELECT flow_id, CASE o_orderstatus WHEN 'P' THEN 'Reconnaissance' END AS attack_cat,
    CASE o_orderstatus WHEN 'O' THEN 0 ELSE 1 END AS label
    FROM r, n WHERE o_orderstatus = 'P' OR (o_orderstatus = 'O' AND i <= attacks)""",
)
def category_filter_balance(spark, folder):
    return align.category_subset(_argus_source(spark, folder)).select("flow_id", "attack_cat", "label")


@query(
    "alignment_manifest",
    f"""WITH {_FLOWMETER_SQL}, {_ARGUS_SQL},
    k AS (SELECT flow_id, flow_duration AS probe, CASE WHEN label = 'Benign' THEN 'benign' ELSE 'attack' END AS kind FROM lm),
    kn AS (SELECT count(*) AS attacks FROM k WHERE kind = 'attack'),
    kr AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5(flow_id || '|42'), flow_id) AS i FROM k),
    a AS (SELECT *, CASE o_orderstatus WHEN 'P' THEN 'attack' WHEN 'O' THEN 'benign' END AS kind FROM ar),
    an AS (SELECT count(*) AS attacks FROM a WHERE kind = 'attack'),
    ao AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5(flow_id || '|42'), flow_id) AS i FROM a)
    SELECT 'flowmeter' AS source, count(*) AS rows FROM kr, kn
      WHERE (kind = 'attack' OR i <= attacks) AND probe IS NOT NULL
    UNION ALL SELECT 'argus', count(*) FROM ao, an
      WHERE (kind = 'attack' OR (kind = 'benign' AND i <= attacks)) AND bwd_packet_length_mean IS NOT NULL""",
)
def alignment_manifest(spark, folder):
    from scanlens.plans.align import align_sources

    return align.source_counts(align_sources(_flowmeter_source(spark, folder), _argus_source(spark, folder)))


# Raw wide flow table: each source heading of the wide projection as a simple function of the flow.
_WIDE_SOURCES = sorted({origin for _, origin in K.WIDE_FEATURES if origin})
_CONTRACT_NAMES = {long: short for short, long in K.FEATURE_COLUMNS}


def _wide_raw(spark, folder):
    source = flows(spark, folder)
    columns = [
        F.col(_CONTRACT_NAMES[name]).alias(name)
        if name in _CONTRACT_NAMES
        else (F.col("event_id") % (i + 2) + F.col("k")).cast("double").alias(name)
        for i, name in enumerate(_WIDE_SOURCES)
    ]
    return source.select(
        "flow_id", F.col("src_ip").alias("Source IP"), (F.col("label") == K.ATTACK_LABEL).cast("int").alias("y"), *columns
    )


def _wide_sql() -> str:
    def raw(name: str) -> str:
        if name in _CONTRACT_NAMES:
            return _CONTRACT_NAMES[name]
        return f"CAST(event_id % {_WIDE_SOURCES.index(name) + 2} + k AS DOUBLE)"

    columns = ", ".join(
        f'{"CAST(distinct_ports AS DOUBLE)" if origin is None else raw(origin)} AS "{target}"'
        for target, origin in K.WIDE_FEATURES
    )
    draw = "CAST(CAST('0x' || substr(md5(flow_id || '|{0}|42'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"
    y = "(label = 'PortScan')"
    return f"""WITH {FLOWS_SQL}, d AS (SELECT src_ip, count(DISTINCT dst_port) AS distinct_ports FROM flows GROUP BY src_ip)
    SELECT flow_id, CAST({y} AS INTEGER) AS y, {columns},
    CAST({draw.format('shadow')} < CASE WHEN {y} THEN 0.15 ELSE 0.02 END AS INTEGER) AS "Shadow Node Interaction",
    CAST(floor({draw.format('delta')} * CASE WHEN {y} THEN 1024 ELSE 128 END) AS INTEGER) AS "MTD Port Delta"
    FROM flows JOIN d USING (src_ip)"""


@query("engineer_features", _wide_sql())
def engineer_features(spark, folder):
    wide = engineer.engineer_features(_wide_raw(spark, folder), keep=["flow_id", "y"])
    return engineer.inject_defence_features(wide)


@query(
    "stratified_split",
    f"""WITH {FLOWS_SQL}, r AS (SELECT flow_id, label,
      row_number() OVER (PARTITION BY label ORDER BY md5(flow_id || '|42'), flow_id) - 1 AS i,
      count(*) OVER (PARTITION BY label) AS n FROM flows)
    SELECT flow_id, label, i < floor(0.2 * n + 0.5) AS is_test FROM r""",
)
def stratified_split(spark, folder):
    from scanlens.operators.split import mark_test_rows

    return mark_test_rows(flows(spark, folder).select("flow_id", "label"), "label")


@query(
    "hash_split",
    f"""WITH {FLOWS_SQL} SELECT flow_id, label, substr(md5(flow_id || '|42'), 1, 8) < '33333333' AS is_test FROM flows""",
)
def hash_split(spark, folder):
    from scanlens.operators.split import mark_test_rows_by_threshold

    return mark_test_rows_by_threshold(flows(spark, folder).select("flow_id", "label"))


@query(
    "cv_fold_assignment",
    f"""WITH {FLOWS_SQL} SELECT flow_id, label, CAST((row_number() OVER (PARTITION BY label
      ORDER BY md5(flow_id || '|42'), flow_id) - 1) % 10 AS INTEGER) AS fold FROM flows""",
)
def cv_fold_assignment(spark, folder):
    ranked = ranking.rank_by_hash(flows(spark, folder).select("flow_id", "label"), "label")
    return ranked.select("flow_id", "label", (F.col("hash_rank") % K.CV_FOLDS).cast("int").alias("fold"))


_WINDOW_MEASURES = """CAST(count(*) AS BIGINT) AS flows, count(DISTINCT dst_port) AS distinct_ports,
    round(avg(CASE WHEN syn_flag_count > 0 THEN 1.0 ELSE 0.0 END), 6) AS syn_ratio, round(avg(flow_iat_mean) + 1e-7, 4) AS iat_mean"""


def _window_report(report):
    return report.select(
        "src_ip", "window_start", "flows", "distinct_ports",
        rounded("syn_ratio").alias("syn_ratio"), rounded("iat_mean", 4, 1e-7).alias("iat_mean"),
    )


FAST_WINDOW_SQL = f"""WITH {FLOWS_SQL} SELECT src_ip, CAST(floor(epoch(ts) / 10) * 10 AS BIGINT) AS window_start, {_WINDOW_MEASURES}
    FROM flows GROUP BY 1, 2"""


@query("fast_window", FAST_WINDOW_SQL)
def fast_window(spark, folder):
    return _window_report(windows.fast_windows(flows(spark, folder)))


SLOW_WINDOW_SQL = f"""WITH {FLOWS_SQL}, o AS (SELECT unnest(range(6)) AS j)
    SELECT src_ip, CAST(floor(epoch(ts) / 10) * 10 AS BIGINT) - 10 * j AS window_start, {_WINDOW_MEASURES}
    FROM flows, o GROUP BY 1, 2"""


@query("slow_window", SLOW_WINDOW_SQL)
def slow_window(spark, folder):
    return _window_report(windows.slow_windows(flows(spark, folder)))


@query(
    "scan_sessions",
    f"""WITH {FLOWS_SQL}, s AS (SELECT src_ip, label, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM flows),
    m AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY src_ip ORDER BY sec) < 300 THEN 0 ELSE 1 END AS opens FROM s),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY src_ip ORDER BY sec RANGE UNBOUNDED PRECEDING) AS session FROM m)
    SELECT src_ip, min(sec) AS session_start, max(sec) AS last_event, CAST(count(*) AS BIGINT) AS events,
    CAST(count(*) FILTER (WHERE label = 'PortScan') AS BIGINT) AS attacks FROM n GROUP BY src_ip, session""",
)
def scan_sessions(spark, folder):
    found = windows.sessions(flows(spark, folder), extra={"attacks": F.col("label") == K.ATTACK_LABEL})
    return found.drop("session")


DEDUP_SQL = f"""WITH {FLOWS_SQL}, a AS (SELECT src_ip, dst_port, CASE event_type WHEN 'error' THEN 'BLOCK' ELSE 'ALERT' END AS action,
      event_id, ts, CAST(floor(epoch(ts) / 600) AS BIGINT) AS slot FROM flows WHERE event_type IN ('error', 'signup'))
    SELECT src_ip, dst_port, action, slot, arg_min(event_id, ts) AS event_id, CAST(count(*) AS BIGINT) AS repeats
    FROM a GROUP BY src_ip, dst_port, action, slot"""


@query(
    "dedup_alerts",
    DEDUP_SQL,
)
def dedup_alerts(spark, folder):
    alerts = (
        flows(spark, folder)
        .where(F.col("event_type").isin("error", "signup"))
        .withColumn("action", F.when(F.col("event_type") == "error", "BLOCK").otherwise("ALERT"))
    )
    return windows.first_per_slot(alerts, ["src_ip", "dst_port", "action"], K.REPEAT_SECONDS).drop("ts")


@query(
    "mtd_port_delta",
    f"""WITH {FLOWS_SQL}, s AS (SELECT flow_id, dst_port, CAST(floor(epoch(ts) / 30) AS BIGINT) AS slot FROM flows)
    SELECT flow_id, slot, CAST(abs(dst_port - (8000 + slot % 1000)) AS INTEGER) AS mtd_port_delta FROM s""",
)
def mtd_port_delta(spark, folder):
    source = flows(spark, folder).select("flow_id", "dst_port", "ts")
    rotation = source.select(F.floor(epoch_seconds(F.col("ts")) / K.ROTATION_SECONDS).alias("slot")).distinct().withColumn(
        "active_port", 8000 + F.col("slot") % 1000
    )
    return lookups.with_port_delta(source, rotation).select("flow_id", "slot", "mtd_port_delta")
