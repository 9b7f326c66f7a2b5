"""Windows, sessions, duplicate suppression and rolling statistics over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions.scalars import epoch_seconds
from scanlens.operators.soc import grade_threat


def _windowed(flows: DataFrame, window, watermark: str, source: str, ts: str) -> DataFrame:
    # Exact distinct ports: a set of port numbers has at most 65,536 members.
    return (
        flows.withWatermark(ts, watermark)
        .groupBy(window.alias("w"), source)
        .agg(
            F.count(F.lit(1)).alias("flows"),
            F.size(F.collect_set("dst_port")).cast("long").alias("distinct_ports"),
            F.avg((F.col("syn_flag_count") > 0).cast("int")).alias("syn_ratio"),
            F.avg("flow_iat_mean").alias("iat_mean"),
        )
        .select(
            source, epoch_seconds(F.col("w.start")).alias("window_start"), "flows", "distinct_ports", "syn_ratio", "iat_mean"
        )
    )


def fast_windows(
    flows: DataFrame, watermark: str = K.WATERMARK, source: str = "src_ip", ts: str = "ts"
) -> DataFrame:
    """Tumbling 10-second window per source."""
    return _windowed(flows, F.window(ts, f"{K.FAST_WINDOW_SECONDS} seconds"), watermark, source, ts)


def slow_windows(
    flows: DataFrame, watermark: str = K.WATERMARK, source: str = "src_ip", ts: str = "ts"
) -> DataFrame:
    """60-second window per source, sliding by 10 seconds."""
    window = F.window(ts, f"{K.SLOW_WINDOW_SECONDS} seconds", f"{K.SLOW_WINDOW_SLIDE_SECONDS} seconds")
    return _windowed(flows, window, watermark, source, ts)


_PORTS = 1 << 16


def pane_windows(flows: DataFrame, watermark: str = K.WATERMARK, source: str = "src_ip", ts: str = "ts") -> DataFrame:
    """The sliding windows of ``slow_windows`` out of 10-second panes; closed windows only (append mode).

    A flow is aggregated once, into its pane; closed panes then go to the six windows they
    lie in.  Distinct ports are exact sets of port numbers: a pane is one state row that is as
    large as the ports it saw, 65,536 at most.  Values that are no port are not counted.
    """
    port = F.col("dst_port").cast("long")
    panes = (
        flows.withWatermark(ts, watermark)
        .groupBy(F.window(ts, f"{K.SLOW_WINDOW_SLIDE_SECONDS} seconds").alias("pane"), source)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.collect_set(F.when((port >= 0) & (port < _PORTS), port.cast("int"))).alias("ports"),
            F.count_if(F.col("syn_flag_count") > 0).alias("syn"),
            F.sum("flow_iat_mean").alias("iat"),
            F.count("flow_iat_mean").alias("iat_known"),
        )
        .withColumn("at", F.window_time("pane"))
    )
    window = F.window("at", f"{K.SLOW_WINDOW_SECONDS} seconds", f"{K.SLOW_WINDOW_SLIDE_SECONDS} seconds")
    ports = F.size(F.array_distinct(F.flatten(F.collect_list("ports")))).cast("long")  # of six panes at most
    return (
        panes.groupBy(window.alias("w"), source)
        .agg(
            F.sum("n").alias("flows"),
            ports.alias("distinct_ports"),
            (F.sum("syn") / F.sum("n")).alias("syn_ratio"),
            F.try_divide(F.sum("iat"), F.sum("iat_known")).alias("iat_mean"),
        )
        .select(
            source, epoch_seconds(F.col("w.start")).alias("window_start"), "flows", "distinct_ports", "syn_ratio", "iat_mean"
        )
    )


def sessions(flows: DataFrame, watermark: str = K.WATERMARK, source: str = "src_ip", ts: str = "ts") -> DataFrame:
    """Closed activity sessions per source with the time from their start to the first attack."""
    attack_at = F.min(F.when(F.col("label") == K.ATTACK_LABEL, F.col(ts)))
    return (
        flows.withWatermark(ts, watermark)
        .groupBy(F.session_window(ts, f"{K.SESSION_GAP_SECONDS} seconds").alias("w"), source)
        .agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("last"), attack_at.alias("attack_at"))
        .select(
            source,
            epoch_seconds(F.col("w.start")).alias("session_start"),
            epoch_seconds(F.col("last")).alias("last_event"),
            "events",
            (epoch_seconds(F.col("attack_at")) - epoch_seconds(F.col("w.start"))).alias("reaction_seconds"),
        )
    )


def without_repeats(
    alerts: DataFrame,
    keys: tuple[str, ...] = ("src_ip", "dst_port", "action"),
    seconds: int = K.REPEAT_SECONDS,
    watermark: str = K.WATERMARK,
    ts: str = "ts",
    order: str = "event_id",
) -> DataFrame:
    """The first alert of each key and event-time slot, with the number of alerts it stands for.

    Slots are fixed, so the answer does not depend on how alerts fall into micro-batches.
    Update mode: the last row of a key and slot holds (``dispatch.last_update``).
    """
    first = F.min(F.struct(F.col(ts).alias("ts"), F.col(order).alias(order))).alias("first")
    return (
        alerts.withWatermark(ts, watermark)
        .groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("w"))
        .agg(first, F.count(F.lit(1)).alias("repeats"))
        .select(*keys, F.floor(epoch_seconds(F.col("w.start")) / seconds).alias("slot"), f"first.{order}", "repeats")
    )


def rolling_detection_stats(log: DataFrame) -> DataFrame:
    """Running totals of the detection log (complete mode)."""
    attack = F.coalesce(F.col("label") == 1, F.lit(False)) | F.coalesce(F.col("prediction") == 1, F.lit(False))
    return log.groupBy().agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(attack).alias("attacks"),
        F.count_if(~attack).alias("benign"),
        F.count_if(F.col("action") == "BLOCK").alias("blocked"),
    )


def rolling_threat(log: DataFrame, watermark: str = K.WATERMARK, ts: str = "ts") -> DataFrame:
    """Threat grade of each 300-second slot as it fills."""
    kind = F.col("event_type")
    return (
        log.withWatermark(ts, watermark)
        .groupBy(F.window(ts, f"{K.THREAT_WINDOW_SECONDS} seconds").alias("w"))
        .agg(
            F.count_if(kind == K.REDIRECT_EVENT).alias("redirects"),
            F.count_if(kind == K.BLACKLIST_EVENT).alias("blacklists"),
        )
        .select(
            epoch_seconds(F.col("w.start")).alias("slot_start"),
            "redirects",
            "blacklists",
            grade_threat(F.col("redirects"), F.col("blacklists")).alias("threat_level"),
        )
    )
