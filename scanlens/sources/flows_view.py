"""Flow, log and rotation views derived from the event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlens.constants import ATTACK_LABEL, BENIGN_LABEL
from scanlens.session import pin_utc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def with_flow_columns(events: DataFrame) -> DataFrame:
    """The flow features as expressions over the event columns."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    value, event_id, user_id = F.col("value"), F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")

    def number(c):
        return c.cast("double")

    return events.select(
        event_id.cast("string").alias("flow_id"),
        "event_id",
        "ts",
        k.alias("k"),
        "value",
        "event_type",
        "props",
        F.concat(
            F.lit("10.0."), F.floor(user_id / 256).cast("int").cast("string"), F.lit("."), (user_id % 256).cast("string")
        ).alias("src_ip"),
        number(F.lit(1) + (k * 641 + user_id * 7) % 65535).alias("dst_port"),
        number(value * 1000).alias("flow_duration"),
        number(F.lit(1) + event_id % 4 + F.when(k >= 90, 40).otherwise(0)).alias("total_fwd_packets"),
        number(F.when(kind.isin("signup", "error"), 1).otherwise(0)).alias("syn_flag_count"),
        number(F.when(kind == "error", 1).otherwise(0)).alias("rst_flag_count"),
        number(F.when(kind == "purchase", 9).when(kind == "view", 3).otherwise(0)).alias("ack_flag_count"),
        number(value * value).alias("flow_iat_mean"),
        number(F.when(event_id % 3 == 0, F.lit(0.0)).otherwise(value / 2)).alias("bwd_packet_length_mean"),
        number(F.when(event_id % 2 == 0, 1024).otherwise(29200)).alias("init_win_bytes_forward"),
        F.when((kind == "error") | ((kind == "signup") & (value < 40)), ATTACK_LABEL)
        .otherwise(BENIGN_LABEL)
        .alias("label"),
    ).withColumns(
        {
            "score_a": (F.col("syn_flag_count") * 40 + F.col("rst_flag_count") * 45 + F.col("k") % 16) / F.lit(100.0),
            "score_b": number((F.col("k") % 20) * 5) / F.lit(100.0),
            "score_c": F.col("syn_flag_count"),
        }
    )


def flows(spark: SparkSession, folder: str) -> DataFrame:
    return with_flow_columns(table(spark, folder, "events"))


def dirty_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flows with NULL, infinite and NaN values and with missing or mis-cased labels."""
    event_id, infinity = F.col("event_id"), float("inf")
    return flows(spark, folder).withColumns(
        {
            "flow_duration": F.when(event_id % 89 == 0, F.lit(None).cast("double"))
            .when(event_id % 97 == 0, F.lit(infinity))
            .otherwise(F.col("flow_duration")),
            "flow_iat_mean": F.when(event_id % 101 == 0, F.lit(-infinity))
            .when(event_id % 103 == 0, F.lit(float("nan")))
            .otherwise(F.col("flow_iat_mean")),
            "label": F.when(event_id % 211 == 0, F.lit(None).cast("string"))
            .when((event_id % 5 == 0) & (F.col("label") == ATTACK_LABEL), F.lit(" PORTSCAN "))
            .otherwise(F.col("label")),
        }
    )
