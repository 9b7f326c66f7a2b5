"""Canonical schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from scanlens.constants import FEATURE_COLUMNS, FEATURES

FLOW_FILE_SCHEMA = T.StructType(
    [T.StructField("Source IP", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for _, name in FEATURE_COLUMNS]
    + [T.StructField("Label", T.StringType())]
)

FLOW_SCHEMA = T.StructType(
    [
        T.StructField("flow_id", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in FEATURES]
    + [T.StructField("label", T.StringType())]
)

# Superset of what the writers of the detection log emit.
DETECTION_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("action", T.StringType()),
        T.StructField("scan_type", T.StringType()),
        T.StructField("honeypot_flag", T.IntegerType()),
    ]
)

# Two writers, two spellings: (event, ip) and (event_type, src_ip).
DECEPTION_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)

SCAN_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("_args", T.StringType()),
        T.StructField(
            "host",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "address",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("_addr", T.StringType()),
                                        T.StructField("_addrtype", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                        T.StructField(
                            "ports",
                            T.StructType(
                                [
                                    T.StructField(
                                        "port",
                                        T.ArrayType(
                                            T.StructType(
                                                [
                                                    T.StructField("_portid", T.IntegerType()),
                                                    T.StructField("_protocol", T.StringType()),
                                                    T.StructField(
                                                        "state",
                                                        T.StructType(
                                                            [T.StructField("_state", T.StringType())]
                                                        ),
                                                    ),
                                                ]
                                            )
                                        ),
                                    )
                                ]
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

PARAM_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("median", T.DoubleType()),
        T.StructField("lower", T.DoubleType()),
        T.StructField("upper", T.DoubleType()),
        T.StructField("skewness", T.DoubleType()),
        T.StructField("log", T.BooleanType()),
        T.StructField("shift", T.DoubleType()),
    ]
)
