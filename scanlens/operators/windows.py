"""Per-source time windows and sessions over stored flows (batch form)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions.scalars import epoch_seconds


def _panes(flows: DataFrame, seconds: int, source: str, ts: str) -> DataFrame:
    """Flows reduced to one row per (pane, source, port)."""
    pane = (F.floor(epoch_seconds(F.col(ts)) / seconds) * seconds).alias("pane")
    return flows.groupBy(source, pane, "dst_port").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("syn_flag_count") > 0).alias("syn"),
        F.sum("flow_iat_mean").alias("iat"),
        F.count("flow_iat_mean").alias("iat_n"),
    )


def fast_windows(
    flows: DataFrame, seconds: int = K.FAST_WINDOW_SECONDS, source: str = "src_ip", ts: str = "ts"
) -> DataFrame:
    """Tumbling window per source: flows, distinct ports, SYN ratio, mean IAT.

    The distinct count makes Spark reduce per (window, source, port) before the second shuffle.
    """
    start = (F.floor(epoch_seconds(F.col(ts)) / seconds) * seconds).alias("window_start")
    return flows.groupBy(source, start).agg(
        F.count(F.lit(1)).alias("flows"),
        F.count_distinct("dst_port").alias("distinct_ports"),
        F.avg((F.col("syn_flag_count") > 0).cast("int")).alias("syn_ratio"),
        F.avg("flow_iat_mean").alias("iat_mean"),
    )


def slow_windows(
    flows: DataFrame,
    seconds: int = K.SLOW_WINDOW_SECONDS,
    slide: int = K.SLOW_WINDOW_SLIDE_SECONDS,
    source: str = "src_ip",
    ts: str = "ts",
) -> DataFrame:
    """Sliding window per source.  Flows are reduced to slide-wide panes before each
    pane is copied into the windows that cover it."""
    if seconds % slide:
        raise ValueError("the window length must be a multiple of the slide")
    panes = _panes(flows, slide, source, ts)
    starts = F.sequence(F.col("pane") - (seconds - slide), F.col("pane"), F.lit(slide).cast("long"))
    copied = panes.withColumn("window_start", F.explode(starts))
    return copied.groupBy(source, "window_start").agg(
        F.sum("n").alias("flows"),
        F.count_distinct("dst_port").alias("distinct_ports"),
        (F.sum("syn") / F.sum("n")).alias("syn_ratio"),
        F.try_divide(F.sum("iat"), F.sum("iat_n")).alias("iat_mean"),
    )


def sessions(
    events: DataFrame,
    gap: int = K.SESSION_GAP_SECONDS,
    source: str = "src_ip",
    ts: str = "ts",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Activity sessions per source; a pause of ``gap`` seconds or more starts a new one.

    Events closer together than the gap share its time slot, so they are reduced to
    one row per (source, slot) first; the ordered group then grows with the observed
    time span only, however many events a source has.  ``extra`` adds conditional
    counts: {name: predicate}.
    """
    extra = extra or {}
    second = epoch_seconds(F.col(ts))
    slots = (
        events.withColumn("_s", second)
        .groupBy(source, F.floor(F.col("_s") / gap).alias("_slot"))
        .agg(
            F.min("_s").alias("first"),
            F.max("_s").alias("last"),
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(predicate).alias(f"_x_{name}") for name, predicate in extra.items()],
        )
    )
    ordered = Window.partitionBy(source).orderBy("_slot")
    opens = F.coalesce(F.col("first") - F.lag("last").over(ordered) >= gap, F.lit(True))
    numbered = slots.withColumn("_opens", opens.cast("int")).withColumn(
        "session", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(source, "session").agg(
        F.min("first").alias("session_start"),
        F.max("last").alias("last_event"),
        F.sum("n").alias("events"),
        *[F.sum(f"_x_{name}").alias(name) for name in extra],
    )


def block_periods(blocks: DataFrame, source: str = "src_ip", ts: str = "ts") -> DataFrame:
    """(source, blocked_from, blocked_until): blocks of one source within the block lifetime
    of each other extend one period."""
    ttl = K.BLOCK_TTL_MINUTES * 60
    outside = blocks.where(~F.col(source).isin(*K.LOOPBACK_SOURCES))
    return sessions(outside, ttl, source, ts).select(
        source,
        F.col("session_start").alias("blocked_from"),
        (F.col("last_event") + ttl).alias("blocked_until"),
        F.col("events").alias("block_events"),
    )


def first_per_slot(
    events: DataFrame, keys: list[str], seconds: int, ts: str = "ts", order: str = "event_id"
) -> DataFrame:
    """Repeated alerts reduced to the first of each key and time slot, with the repeat count."""
    slot = F.floor(epoch_seconds(F.col(ts)) / seconds)
    return events.groupBy(*keys, slot.alias("slot")).agg(
        F.min(F.struct(F.col(ts).alias("ts"), F.col(order).alias(order))).alias("first"),
        F.count(F.lit(1)).alias("repeats"),
    ).select(*keys, "slot", "first.ts", f"first.{order}", "repeats")
