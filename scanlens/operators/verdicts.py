"""Scored flows to graded verdicts, alerts, blocks and log rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions import labels as L


def with_defaults(df: DataFrame, source: str = "src_ip", port: str = "dst_port") -> DataFrame:
    """Default source and port where a flow has none."""
    src = F.col(source) if source in df.columns else F.lit(None).cast("string")
    dst = F.col(port) if port in df.columns else F.lit(None).cast("double")
    return df.withColumns(
        {
            "src_ip": F.coalesce(src, F.lit(K.DEFAULT_SOURCE_IP)),
            "dst_port": F.coalesce(dst.cast("int"), F.lit(0)),
        }
    )


def grade(scored: DataFrame, prediction: str = "prediction", confidence: str = "confidence") -> DataFrame:
    """Label and action of every scored flow."""
    p, c = F.col(prediction), F.col(confidence)
    return scored.withColumns({"verdict": L.verdict_label(p), "action": L.graded_action(p, c)})


def by_rule_score(flows: DataFrame, score: str = "score_a", threshold: float = 0.5) -> DataFrame:
    """Prediction and confidence from a score column."""
    return flows.withColumns(
        {"prediction": (F.col(score) >= threshold).cast("int"), "confidence": F.col(score)}
    )


def detection_log(graded: DataFrame, at: Column) -> DataFrame:
    """Log rows of all graded flows, confidence rounded to three digits."""
    return graded.select(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "src_ip",
        F.col("dst_port").cast("int").alias("dst_port"),
        "prediction",
        F.bround("confidence", 3).alias("confidence"),
        F.col("prediction").alias("label"),
        "action",
        F.lit(None).cast("string").alias("scan_type"),
        F.lit(None).cast("int").alias("honeypot_flag"),
    )


def alerts(graded: DataFrame, at: Column) -> DataFrame:
    chosen = graded.where(L.raises_alert(F.col("prediction"), F.col("confidence")))
    return detection_log(chosen, at).withColumns(
        {"action": F.lit("ALERT"), "scan_type": F.lit(K.DEFAULT_SCAN_TYPE), "honeypot_flag": F.lit(0)}
    )


def blocks(graded: DataFrame, at: Column) -> DataFrame:
    chosen = graded.where(L.raises_block(F.col("prediction"), F.col("confidence")))
    return chosen.select(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "src_ip", "confidence"
    )


def with_severity(flows: DataFrame, scores: list[str]) -> DataFrame:
    """Votes of the models, mean score as confidence, severity and the three defences.

    A flow that no model flags has no severity and no defence; every severity redirects.
    """
    columns = [F.col(s) for s in scores]
    confidence = sum(columns[1:], columns[0]) / F.lit(float(len(columns)))
    voted = flows.withColumns({"votes": L.vote_count(columns), "confidence": confidence})
    graded = voted.withColumn("severity", L.severity(F.col("confidence"), F.col("votes"), len(columns)))
    level = F.col("severity")
    return graded.withColumns(
        {
            "redirect": level.isNotNull(),
            "blacklist": F.coalesce(level.isin("MEDIUM", "HIGH"), F.lit(False)),
            "mutate_port": F.coalesce(level == "HIGH", F.lit(False)),
        }
    )
