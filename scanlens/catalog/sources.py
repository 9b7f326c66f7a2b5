"""Round trips through files: what readers and writers give back of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.catalog.logs import DETECTION_LOG_SQL, detection_log
from scanlens.catalog.registry import DIRTY_SQL, FLOWS_SQL, query
from scanlens.operators import clean, soc, verdicts
from scanlens.schemas import DETECTION_SCHEMA
from scanlens.session import shared_folder
from scanlens.sources import files
from scanlens.sources.flows_view import dirty_flows, flows

_FEATURES = ", ".join(K.FEATURES)


@query(
    "csv_round_trip",
    f"""WITH {DIRTY_SQL} SELECT flow_id, src_ip, {_FEATURES}, trim(label) AS label FROM clean
    UNION ALL SELECT 'short', '10.9.9.9', 443, {", ".join(["NULL"] * (len(K.FEATURES) - 1))}, NULL
    FROM (SELECT count(*) FROM events)""",
)
def csv_round_trip(spark, folder):
    """Dirty flows as CSV in two column orders with blank-led headings, a short and a long line, read back."""
    source = files.to_file_names(dirty_flows(spark, folder).select("flow_id", "src_ip", *K.FEATURES, "label"))
    root = shared_folder(spark, "csv")
    names = source.columns
    for part, order in enumerate([names, [*names[:2], *reversed(names[2:])]]):
        half = source.where(F.pmod(F.col("flow_id").cast("long"), F.lit(2)) == part).select(*order)
        spaced = half.toDF(*[f" {n}" if n in ("Destination Port", "Label") else n for n in half.columns])
        files.write_csv(spaced, f"{root}/{part}")
    heading = ",".join(names)
    lines = [heading, "short,10.9.9.9,443", ",".join(["long", "10.9.9.8", *["1"] * (len(names) - 3), "BENIGN", "1"])]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/2")
    read = files.read_flows_csv(spark, [f"{root}/{i}" for i in range(3)], bad_lines="skip")
    back = files.to_short_names(read)
    return clean.non_finite_to_null(back).select("flow_id", "src_ip", *K.FEATURES, "label")


@query(
    "log_round_trip",
    f"""WITH {DETECTION_LOG_SQL} SELECT CASE event_id % 3 WHEN 2 THEN 'array' ELSE 'lines' END AS layout, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at,
    src_ip, prediction, action, CAST(count(*) AS BIGINT) AS events FROM det GROUP BY ALL""",
)
def log_round_trip(spark, folder):
    """The detection log as lines and as arrays, with lines that hold no event and both time spellings, read back."""
    log = detection_log(spark, folder)
    short = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    log = log.withColumn("timestamp", F.when(F.col("event_id") % 3 == 0, short).otherwise(F.col("timestamp")))
    names = [f.name for f in DETECTION_SCHEMA if f.name in log.columns]
    root = shared_folder(spark, "logs")
    files.append_log(log.where("event_id % 3 <> 2").select(*names), f"{root}/lines")
    spark.createDataFrame([("",), ("{broken",), ("[]",), ('{"other": 1}',)], "value string").write.mode("append").text(f"{root}/lines")
    objects = log.where("event_id % 3 = 2").select((F.col("event_id") % 64).alias("part"), F.to_json(F.struct(*names)).alias("o"))
    arrays = objects.groupBy("part").agg(F.concat(F.lit("["), F.array_join(F.collect_list("o"), ","), F.lit("]")).alias("value"))
    arrays.select("value").write.text(f"{root}/array")
    both = [soc.with_event_time(files.read_detection_log(spark, f"{root}/{k}")).withColumn("layout", F.lit(k)) for k in ("lines", "array")]
    found = both[0].unionByName(both[1]).withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return found.groupBy("layout", "at", "src_ip", "prediction", "action").agg(F.count(F.lit(1)).alias("events"))


@query(
    "flow_defaults",
    f"""WITH {FLOWS_SQL} SELECT flow_id, CASE WHEN event_id % 7 = 0 THEN '{K.DEFAULT_SOURCE_IP}' ELSE src_ip END AS src_ip,
    CASE WHEN event_id % 5 = 0 THEN 0 ELSE CAST(dst_port AS INTEGER) END AS dst_port FROM flows""",
)
def flow_defaults(spark, folder):
    """Flows that lack their source or port get the defaults."""
    holes = flows(spark, folder).select(
        "flow_id",
        F.when(F.col("event_id") % 7 != 0, F.col("src_ip")).alias("src_ip"),
        F.when(F.col("event_id") % 5 != 0, F.col("dst_port")).alias("dst_port"),
    )
    return verdicts.with_defaults(holes)


@query(
    "saved_parameters",
    f"""WITH {FLOWS_SQL} SELECT """
    + ", ".join(f"count({f}) FILTER (WHERE {f} > (SELECT median({f}) FROM flows)) AS above_{f}" for f in K.FEATURES)
    + " FROM flows",
)
def saved_parameters(spark, folder):
    """Fitted parameters and feature names written, read back and applied: rows above the saved medians."""
    from scanlens.operators.preprocess import Preprocessing, fit_preprocessing

    source = flows(spark, folder)
    root = shared_folder(spark, "parameters")
    fit_preprocessing(source, K.FEATURES).write(spark, f"{root}/preprocessing")
    files.write_names(spark, K.FEATURES, f"{root}/features")
    medians = {p.feature: p.median for p in Preprocessing.read(spark, f"{root}/preprocessing").features}
    return source.agg(*[F.count_if(F.col(f) > medians[f]).alias(f"above_{f}") for f in files.read_names(spark, f"{root}/features")])


@query(
    "manifest_round_trip",
    f"""WITH {FLOWS_SQL} SELECT event_type AS source, CAST(count(*) AS BIGINT) AS rows FROM flows GROUP BY 1""",
)
def manifest_round_trip(spark, folder):
    """Flows in folders by type, with a manifest that is read back."""
    root = shared_folder(spark, "manifest")
    files.write_parquet(flows(spark, folder).select("flow_id", F.col("event_type").alias("source")), f"{root}/rows", partition_by=["source"])
    files.write_manifest(spark.read.parquet(f"{root}/rows"), f"{root}/manifest")
    return spark.read.schema("source string, rows long").json(f"{root}/manifest")
