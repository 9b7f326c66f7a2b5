"""Query registry and the shared SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name`` with an optional SQL twin."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(c: Column | str, digits: int = 6, lift: float = 0.0) -> Column:
    """Round and drop the sign of zero, so that equal values print equally.

    ``lift`` moves decimal ties (x.xx5) off the rounding edge, where the last bit of
    a sum decides; the SQL twin adds the same amount.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(lift) if lift else c, digits) + F.lit(0.0)


FLOWS_SQL = """
e AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
f AS (SELECT CAST(event_id AS VARCHAR) AS flow_id, event_id, ts, k, value, event_type,
  concat('10.0.', CAST(CAST(floor(user_id/256.0) AS INTEGER) AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR)) AS src_ip,
  CAST(1 + (k*641 + user_id*7) % 65535 AS DOUBLE) AS dst_port,
  CAST(value*1000 AS DOUBLE) AS flow_duration,
  CAST(1 + event_id % 4 + CASE WHEN k >= 90 THEN 40 ELSE 0 END AS DOUBLE) AS total_fwd_packets,
  CAST(CASE WHEN event_type IN ('signup','error') THEN 1 ELSE 0 END AS DOUBLE) AS syn_flag_count,
  CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS DOUBLE) AS rst_flag_count,
  CAST(CASE event_type WHEN 'purchase' THEN 9 WHEN 'view' THEN 3 ELSE 0 END AS DOUBLE) AS ack_flag_count,
  CAST(value*value AS DOUBLE) AS flow_iat_mean,
  CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE value/2 END AS DOUBLE) AS bwd_packet_length_mean,
  CAST(CASE WHEN event_id % 2 = 0 THEN 1024 ELSE 29200 END AS DOUBLE) AS init_win_bytes_forward,
  CASE WHEN event_type = 'error' OR (event_type = 'signup' AND value < 40) THEN 'PortScan' ELSE 'BENIGN' END AS label
 FROM e),
flows AS (SELECT *, (syn_flag_count*40 + rst_flag_count*45 + k % 16)/100 AS score_a,
  CAST((k % 20)*5 AS DOUBLE)/100 AS score_b, syn_flag_count AS score_c FROM f)
"""

DIRTY_SQL = (
    FLOWS_SQL
    + """,
dirty AS (SELECT * REPLACE (
 CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE flow_duration END AS flow_duration,
 CASE WHEN event_id % 101 = 0 THEN CAST('-Infinity' AS DOUBLE) WHEN event_id % 103 = 0 THEN CAST('NaN' AS DOUBLE) ELSE flow_iat_mean END AS flow_iat_mean,
 CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 5 = 0 AND label='PortScan' THEN ' PORTSCAN ' ELSE label END AS label
) FROM flows),
clean AS (SELECT * REPLACE (
 CASE WHEN isfinite(flow_duration) THEN flow_duration END AS flow_duration,
 CASE WHEN isfinite(flow_iat_mean) THEN flow_iat_mean END AS flow_iat_mean) FROM dirty)
"""
)


def per_feature(features: list[str], select: str, source: str) -> str:
    """UNION ALL of one SELECT per feature; ``{f}`` is the feature column."""
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, {select.replace('{f}', f)} FROM {source}" for f in features
    )
