"""Alignment job: filter, balance, map to the contract, combine, save with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scanlens import constants as K
from scanlens.operators import align
from scanlens.sources.files import write_manifest, write_parquet


def align_sources(flowmeter: DataFrame | None, argus: DataFrame | None, key: str = "flow_id") -> DataFrame:
    """Balanced reconnaissance subsets of both source families in one contract table."""
    parts = []
    if flowmeter is not None:
        chosen = align.recon_subset(flowmeter, "Label", key)
        parts.append(align.to_contract(chosen, K.FLOWMETER_V3_MAP, "flowmeter", [key, "Label"]))
    if argus is not None:
        chosen = align.category_subset(argus, "attack_cat", "label", key)
        parts.append(align.to_contract(chosen, K.ARGUS_MAP, "argus", [key, "label"]).withColumnRenamed("label", "class"))
    if not parts:
        raise ValueError("no source given")
    return align.combine(parts)


def run(flowmeter: DataFrame | None, argus: DataFrame | None, folder: str) -> DataFrame:
    """Write the combined table, partitioned by source, and its row counts."""
    combined = align_sources(flowmeter, argus)
    write_parquet(combined, f"{folder}/aligned", partition_by=["source"])
    written = combined.sparkSession.read.parquet(f"{folder}/aligned")
    write_manifest(written, f"{folder}/manifest")
    return written
