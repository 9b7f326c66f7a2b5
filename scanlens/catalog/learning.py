"""Oversampling, models and their scores.  The models are trained once per session and table folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.catalog.registry import DIRTY_SQL, FLOWS_SQL, query, rounded
from scanlens.functions import labels as L
from scanlens.operators import smote as oversampling
from scanlens.operators import trees, verdicts
from scanlens.operators.neighbours import nearest_neighbours
from scanlens.operators.scale import fit_scaler
from scanlens.session import written
from scanlens.sources.flows_view import dirty_flows, flows

_TRAINED: dict[tuple[str, str], object] = {}


def _trained(spark, folder):
    from scanlens.plans.train import train_contract

    session = (spark.sparkContext.applicationId, folder)
    if session not in _TRAINED:
        _TRAINED[session] = train_contract(dirty_flows(spark, folder))
    return _TRAINED[session]


def _scaled(spark, folder):
    labelled = flows(spark, folder).select("flow_id", L.attack_exact(F.col("label")).alias("y"), *K.FEATURES)
    return fit_scaler(labelled, K.FEATURES).transform(labelled)


_SCALED_SQL = (
    f"{FLOWS_SQL}, z AS (SELECT flow_id, label, "
    + ", ".join(
        f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}" for c in K.FEATURES
    )
    + " FROM flows)"
)


@query(
    "minority_neighbours",
    f"WITH {_SCALED_SQL}, raw AS (SELECT min(flow_id) AS point, count(*) AS weight, {', '.join(K.FEATURES)} FROM flows "
    f"WHERE label = 'PortScan' GROUP BY {', '.join(K.FEATURES)}), "
    "p AS (SELECT raw.point, raw.weight, "
    + ", ".join(f"z.{c}" for c in K.FEATURES)
    + " FROM raw JOIN z ON z.flow_id = raw.point), d AS (SELECT a.point, b.weight, sqrt("
    + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in K.FEATURES)
    + """) AS distance, a.weight - 1 AS copies FROM p a JOIN p b ON a.point <> b.point),
    c AS (SELECT point, distance, copies, sum(weight) OVER (PARTITION BY point ORDER BY distance ROWS UNBOUNDED PRECEDING) AS reached FROM d)
    SELECT p.point, p.weight, round(CASE WHEN p.weight > 5 THEN 0 ELSE
      (SELECT min(distance) FROM c WHERE c.point = p.point AND reached + copies >= 5) END, 6) AS fifth_distance FROM p""",
)
def minority_neighbours(spark, folder):
    """Distance from each distinct attack row to its fifth neighbour, copies included."""
    vector = F.array(*[F.col(c) for c in K.FEATURES])
    points = written(
        _scaled(spark, folder)
        .where("y = 1")
        .groupBy(vector.alias("vector"))
        .agg(F.min("flow_id").alias("point"), F.count(F.lit(1)).alias("weight")),
        "points",
    )
    found = nearest_neighbours(points, K.SMOTE_NEIGHBOURS, len(K.FEATURES)).select("point", "distance", F.col("weight").alias("w"))
    steps = F.array_sort(F.collect_list(F.struct("distance", "w")))
    fifth = F.aggregate(
        steps,
        F.struct((F.col("weight") - 1).alias("n"), F.when(F.col("weight") > 5, F.lit(0.0)).alias("d")),
        lambda s, x: F.struct(
            (s["n"] + x["w"]).alias("n"), F.coalesce(s["d"], F.when(s["n"] + x["w"] >= 5, x["distance"])).alias("d")
        ),
    )
    return (
        points.select("point", "weight")
        .join(found, "point", "left")
        .groupBy("point", "weight")
        .agg(fifth["d"].alias("d"))
        .select("point", "weight", rounded("d").alias("fifth_distance"))
    )


def _draw_sql(key: str, salt: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({key} || '|{salt}|42'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"


_SMOTE_SQL = (
    f"WITH {_SCALED_SQL}, n AS (SELECT count(*) FILTER (WHERE label = 'PortScan') AS few, "
    "count(*) FILTER (WHERE label <> 'PortScan') AS many FROM flows), "
    "r AS (SELECT flows.*, row_number() OVER (ORDER BY md5(flow_id || '|42'), flow_id) AS i FROM flows WHERE label = 'PortScan'), "
    "raw AS (SELECT min(flow_id) AS point, count(*) AS weight, "
    "sum((many - few) // few + CASE WHEN i <= (many - few) % few THEN 1 ELSE 0 END) AS children "
    f"FROM r, n GROUP BY {', '.join(K.FEATURES)}), "
    "p AS (SELECT raw.*, "
    + ", ".join(f"z.{c}" for c in K.FEATURES)
    + " FROM raw JOIN z ON z.flow_id = raw.point), "
    "d AS (SELECT a.point, b.point AS other, b.weight, sqrt("
    + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in K.FEATURES)
    + """) AS distance FROM p a JOIN p b ON a.point <> b.point),
    near AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY point ORDER BY distance, other) <= 5),
    x AS (SELECT point, other, distance, unnest(range(least(weight, 5))) AS copy FROM near
      UNION ALL SELECT point, point, -1, unnest(range(least(weight - 1, 5))) FROM p),
    partners AS (SELECT point, other, row_number() OVER (PARTITION BY point ORDER BY distance, other, copy) AS pos FROM x QUALIFY pos <= 5),
    sizes AS (SELECT point, count(*) AS size FROM partners GROUP BY point),
    kids AS (SELECT point, point || '#' || unnest(range(CAST(children AS BIGINT))) AS k FROM p),
    drawn AS (SELECT kids.point, k, """
    + _draw_sql("k", "step")
    + " AS u, CAST(floor("
    + _draw_sql("k", "pick")
    + """ * size) AS BIGINT) + 1 AS pos FROM kids JOIN sizes USING (point))
    SELECT 'smote-' || md5(k || '|42') AS flow_id, """
    + ", ".join(f"round(p.{c} + u * (o.{c} - p.{c}) + 1e-9, 6) + 0.0 AS {c}" for c in K.FEATURES)
    + ", 1 AS y FROM drawn JOIN p USING (point) JOIN partners q ON q.point = drawn.point AND q.pos = drawn.pos JOIN p o ON o.point = q.other"
    " UNION ALL SELECT flow_id, "
    + ", ".join(f"round({c} + 1e-9, 6) + 0.0 AS {c}" for c in K.FEATURES)
    + ", CAST(label = 'PortScan' AS INTEGER) AS y FROM z"
)


@query("smote_balance", _SMOTE_SQL)
def smote_balance(spark, folder):
    scaled = written(_scaled(spark, folder), "scaled")
    balanced = oversampling.smote(scaled, K.FEATURES)
    return balanced.select("flow_id", *[rounded(c, 6, 1e-9).alias(c) for c in K.FEATURES], "y")


def _scores(spark, folder, model):
    trained = _trained(spark, folder)
    return trained.predict(trained.test, model).select("flow_id", "y", "prediction", rounded("confidence").alias("confidence"))


@query("rf_score")
def rf_score(spark, folder):
    return _scores(spark, folder, "Random Forest")


@query("gbt_score")
def gbt_score(spark, folder):
    return _scores(spark, folder, "Boosted Trees")


@query("iforest_score")
def iforest_score(spark, folder):
    trained = _trained(spark, folder)
    return trained.predict(trained.test, "Isolation Forest").select(
        "flow_id", "y", "prediction", rounded("anomaly_score").alias("anomaly_score")
    )


@query("model_comparison")
def model_comparison(spark, folder):
    return _trained(spark, folder).metrics


@query("feature_importances")
def feature_importances(spark, folder):
    trained = _trained(spark, folder)
    return trees.feature_importances(trained.models["Random Forest"], trained.features, spark)


@query("graded_detections")
def graded_detections(spark, folder):
    """Every flow scored by the forest and graded, counted per source and action."""
    from scanlens.plans.score import score_flows

    graded = score_flows(dirty_flows(spark, folder), _trained(spark, folder))
    return graded.groupBy("src_ip", "action").agg(F.count(F.lit(1)).alias("flows"))


@query("model_agreement")
def model_agreement(spark, folder):
    """Votes of the three models on the held-out flows, graded into severities."""
    trained = _trained(spark, folder)
    scored = trained.test
    for column, model in (("vote_a", "Random Forest"), ("vote_b", "Boosted Trees"), ("vote_c", "Isolation Forest")):
        extra = [c for c in ("vote_a", "vote_b", "vote_c") if c in scored.columns]
        scored = trained.predict(scored, model).withColumn(column, F.col("confidence")).select(
            "flow_id", "y", *[F.col(f"`{f}`") for f in trained.features], *extra, column
        )
    graded = verdicts.with_severity(scored, ["vote_a", "vote_b", "vote_c"])
    return graded.groupBy("severity", "votes", "y").agg(F.count(F.lit(1)).alias("flows"))


_HELD_OUT_SQL = f"""{DIRTY_SQL}, y AS (SELECT flow_id, CAST(coalesce(lower(label) LIKE '%portscan%', false) AS INTEGER) AS y FROM dirty),
    h AS (SELECT flow_id, y FROM y QUALIFY row_number() OVER (PARTITION BY y ORDER BY md5(flow_id || '|42'), flow_id) - 1 < floor(0.2 * count(*) OVER (PARTITION BY y) + 0.5))"""


@query(
    "held_out_contract",
    f"""WITH {_HELD_OUT_SQL} SELECT model, flow_id, y, true AS confidence_is_share, true AS prediction_follows
    FROM h, (VALUES ('Random Forest'), ('Boosted Trees'), ('Isolation Forest')) m(model)""",
)
def held_out_contract(spark, folder):
    """Held-out rows as each model scores them: confidence in [0, 1], and the prediction it implies."""
    trained = _trained(spark, folder)
    parts = []
    for model in (*trained.models, "Isolation Forest"):
        scored = trained.predict(trained.test, model)
        c, p = F.col("confidence"), F.col("prediction")
        follows = (p == (c > 0.5).cast("int")) | (c == 0.5) if model in trained.models else p.isin(0, 1)
        parts.append(scored.select(F.lit(model).alias("model"), "flow_id", "y", c.between(0, 1).alias("confidence_is_share"), follows.alias("prediction_follows")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "confusion_totals",
    f"""WITH {_HELD_OUT_SQL} SELECT model, CAST(count(*) FILTER (WHERE y = 1) AS BIGINT) AS attacks, CAST(count(*) FILTER (WHERE y = 0) AS BIGINT) AS benign, true AS flags_follow
    FROM h, (VALUES ('Random Forest'), ('Boosted Trees'), ('Isolation Forest')) m(model) GROUP BY model""",
)
def confusion_totals(spark, folder):
    """Class totals of every model's confusion row, and its acceptance flags recomputed from its rates."""
    metrics = _trained(spark, folder).metrics
    sup, uns, free = K.SUPERVISED_CRITERIA, K.UNSUPERVISED_CRITERIA, F.col("unsupervised")
    passed = F.when(
        free, (F.col("f1_score") >= uns["f1_score"]) & (F.col("accuracy") >= uns["accuracy"]) & (F.col("recall") >= uns["recall"])
    ).otherwise((F.col("f1_score") >= sup["f1_score"]) & (F.col("accuracy") >= sup["accuracy"]) & (F.col("fpr") < sup["fpr"]))
    follows = F.col("passed") == passed
    return metrics.select("model", (F.col("tp") + F.col("fn")).alias("attacks"), (F.col("tn") + F.col("fp")).alias("benign"), follows.alias("flags_follow"))


@query(
    "importance_contract",
    """SELECT CAST(1 AS DOUBLE) AS total, CAST(11 AS BIGINT) AS features, CAST(0 AS BIGINT) AS negative, CAST(0 AS DOUBLE) AS placeholders FROM (SELECT count(*) FROM events)""",
)
def importance_contract(spark, folder):
    """Importances of the forest sum to 1, none is negative, and placeholders have none."""
    trained = _trained(spark, folder)
    found = trees.feature_importances(trained.models["Random Forest"], trained.features, spark, top=len(trained.features))
    return found.agg(
        F.round(F.sum("importance"), 6).alias("total"),
        F.count(F.lit(1)).alias("features"),
        F.count_if(F.col("importance") < 0).alias("negative"),
        F.sum(F.when(F.col("feature").isin(*K.DEFENCE_FEATURES), F.col("importance")).otherwise(0.0)).alias("placeholders"),
    )


@query(
    "graded_totals",
    f"""WITH {DIRTY_SQL} SELECT src_ip, CAST(count(*) AS BIGINT) AS flows, true AS actions_follow FROM dirty GROUP BY src_ip""",
)
def graded_totals(spark, folder):
    """Every flow scored by the saved forest: flows per source, and actions as their confidence demands."""
    from scanlens.plans.score import score_flows
    from scanlens.plans.train import Trained
    from scanlens.session import shared_folder

    root = shared_folder(spark, "models")
    _trained(spark, folder).save(spark, root)
    graded = score_flows(dirty_flows(spark, folder), Trained.load(spark, root))
    follows = F.col("action") == L.graded_action(F.col("prediction"), F.col("confidence"))
    return graded.groupBy("src_ip").agg(F.count(F.lit(1)).alias("flows"), F.every(follows).alias("actions_follow"))


@query(
    "fold_totals",
    f"""WITH {FLOWS_SQL}, y AS (SELECT flow_id, CAST(label = 'PortScan' AS INTEGER) AS y FROM flows),
    folds AS (SELECT y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(flow_id || '|42'), flow_id) - 1) % 3 AS INTEGER) AS fold FROM y)
    SELECT fold, CAST(count(*) FILTER (WHERE y = 1) AS BIGINT) AS attacks, CAST(count(*) FILTER (WHERE y = 0) AS BIGINT) AS benign FROM folds GROUP BY fold""",
)
def fold_totals(spark, folder):
    """Three-fold cross-validation of a small forest, oversampled inside each training part."""
    from scanlens.operators.cv import cross_validate

    scaled = written(_scaled(spark, folder), "scaled")
    found = cross_validate(scaled, trees.random_forest(trees=5, max_depth=5), K.FEATURES, folds=3)
    return found.select("fold", (F.col("tp") + F.col("fn")).alias("attacks"), (F.col("tn") + F.col("fp")).alias("benign"))


@query(
    "replay_files",
    f"""WITH {DIRTY_SQL}, feed AS (SELECT count(*) AS n FROM dirty),
    ports AS (SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey % 16 NOT IN (5, 6))
    SELECT CAST(feed.n + ports.n AS BIGINT) AS events, true AS attacks_as_graded, true AS blocks_as_graded FROM feed, ports""",
)
def replay_files(spark, folder):
    """Scan report files and a flow file scored by saved models, logged, and the log summarised."""
    from scanlens.catalog.logs import _scan_files
    from scanlens.plans import replay
    from scanlens.session import shared_folder
    from scanlens.sources.files import to_file_names, write_csv

    root = shared_folder(spark, "replay")
    _trained(spark, folder).save(spark, f"{root}/models")
    write_csv(to_file_names(dirty_flows(spark, folder).select("src_ip", *K.FEATURES, "label")), f"{root}/attacks")
    summary = replay.run(spark, _scan_files(spark, folder), f"{root}/attacks", f"{root}/models", f"{root}/out", glob="*.txt")
    graded = spark.read.parquet(f"{root}/out/results").agg(F.count_if(F.col("prediction") == 1).alias("attacks"), F.count_if(F.col("action") == "BLOCK").alias("blocks"))
    blocked = spark.read.json(f"{root}/out/blocks").agg(F.count(F.lit(1)).alias("logged"))
    return summary.crossJoin(graded.withColumnRenamed("attacks", "g")).crossJoin(blocked).select(
        "events", (F.col("attacks") == F.col("g")).alias("attacks_as_graded"), (F.col("blocks") == F.col("logged")).alias("blocks_as_graded")
    )
