"""Ordered chunks per source and their aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens.constants import FALLBACK_PORT_GROUPS
from scanlens.limits import IN_MEMORY_ROWS
from scanlens.operators.ranking import rank_within


def port_groups(flows: DataFrame, port: str = "dst_port", output: str = "src_group") -> DataFrame:
    """Grouping key for flows without a source address."""
    return flows.withColumn(output, F.pmod(F.col(port).cast("long"), F.lit(FALLBACK_PORT_GROUPS)))


def ordered_chunks(
    flows: DataFrame, group: str = "src_ip", order: str = "flow_duration", rows_per_bucket: int = IN_MEMORY_ROWS
) -> DataFrame:
    """Add ``chunk``: groups of n rows, ordered, cut into pieces of min(n, max(2, n div 3)) rows.

    Groups with a single row are dropped.
    """
    ranked = rank_within(flows, group, order, rows_per_bucket=rows_per_bucket)
    n = F.col("group_rows")
    size = F.least(n, F.greatest(F.lit(2).cast("long"), F.floor(n / 3)))
    return ranked.where(n >= 2).withColumn("chunk", F.floor(F.col("row_rank") / size))


def chunk_statistics(
    flows: DataFrame,
    group: str = "src_ip",
    label: str = "label",
    max_length: str | None = None,
    rows_per_bucket: int = IN_MEMORY_ROWS,
) -> DataFrame:
    """Statistics per chunk of at least two flows; ties of the most frequent label go to the smallest.

    The distinct count makes Spark reduce per (chunk, port) first, which spreads a
    hot source over its ports before anything is gathered by chunk.
    """
    needed = [
        group, "flow_id", "dst_port", "flow_duration", "total_fwd_packets", "syn_flag_count", "flow_iat_mean", label,
    ] + ([max_length] if max_length else [])
    chunked = ordered_chunks(flows.select(*needed), group, rows_per_bucket=rows_per_bucket)
    return (
        chunked.groupBy(group, "chunk")
        .agg(
            F.avg("flow_iat_mean").alias("iat_mean"),
            F.count(F.lit(1)).alias("flow_count"),
            F.count_distinct("dst_port").alias("distinct_ports"),
            F.avg((F.col("syn_flag_count") > 0).cast("int")).alias("syn_ratio"),
            F.avg("flow_duration").alias("avg_flow_duration"),
            F.sum("total_fwd_packets").alias("total_fwd_packets"),
            (F.max(max_length) if max_length else F.lit(0.0)).alias("max_packet_length"),
            F.mode(label, True).alias("label"),
        )
        .where(F.col("flow_count") >= 2)
    )
