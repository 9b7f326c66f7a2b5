"""Verdicts, metrics, ROC, acceptance criteria, end-to-end summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.catalog.prep import apply_sql
from scanlens.catalog.registry import FLOWS_SQL, query, rounded
from scanlens.functions import labels as L
from scanlens.operators import evaluate, soc, verdicts
from scanlens.sources.flows_view import dirty_flows, flows, table


def _rule_scored(spark, folder, score="score_a"):
    scored = verdicts.by_rule_score(flows(spark, folder), score)
    return scored.withColumn("y", L.attack_exact(F.col("label")))


_SCORED_SQL = f"""{FLOWS_SQL}, s AS (SELECT *, CAST(score_a >= 0.5 AS INTEGER) AS prediction, score_a AS confidence,
    CAST(label = 'PortScan' AS INTEGER) AS y FROM flows)"""

_CONFUSION = """CAST(count(*) FILTER (WHERE y = 0 AND p = 0) AS BIGINT) AS tn, CAST(count(*) FILTER (WHERE y = 0 AND p = 1) AS BIGINT) AS fp,
    CAST(count(*) FILTER (WHERE y = 1 AND p = 0) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS BIGINT) AS tp"""

_RATES = """coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score,
    coalesce(fp / nullif(fp + tn, 0), 0) AS fpr"""

_MODELS_SQL = f"""WITH {_SCORED_SQL}, l AS (
    SELECT 'rule_a' AS model, y, CAST(score_a >= 0.5 AS INTEGER) AS p FROM s
    UNION ALL SELECT 'rule_b', y, CAST(score_b >= 0.5 AS INTEGER) FROM s
    UNION ALL SELECT 'rule_c', y, CAST(score_c >= 0.5 AS INTEGER) FROM s
    UNION ALL SELECT 'quality', quality, 1 - toxic FROM labels),
    m AS (SELECT model, {_CONFUSION} FROM l GROUP BY model), r AS (SELECT *, {_RATES} FROM m)"""


def _model_rates(spark, folder):
    """Rates of three rule scores on the flows and of the toxicity flag on the document labels."""
    source = flows(spark, folder).withColumn("y", L.attack_exact(F.col("label")))
    # All three rules are graded in one pass over the flows.
    outcomes = F.array(
        *[
            F.struct(F.lit(f"rule_{x}").alias("model"), (F.col(f"score_{x}") >= 0.5).cast("int").alias("prediction"))
            for x in "abc"
        ]
    )
    rules = source.select("y", F.inline(outcomes))
    quality = table(spark, folder, "labels").select(
        F.col("quality").alias("y"), F.lit("quality").alias("model"), (1 - F.col("toxic")).alias("prediction")
    )
    return evaluate.rates(evaluate.confusion(rules.unionByName(quality), by=["model"]))


_METRICS = ["accuracy", "precision", "recall", "f1_score", "fpr"]


@query(
    "confusion_metrics",
    _MODELS_SQL
    + " SELECT model, tn, fp, fn, tp, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in _METRICS)
    + " FROM r",
)
def confusion_metrics(spark, folder):
    return _model_rates(spark, folder).select(
        "model", "tn", "fp", "fn", "tp", *[rounded(m).alias(m) for m in _METRICS]
    )


@query(
    "class_report",
    f"""WITH {_SCORED_SQL}, m AS (SELECT {_CONFUSION.replace(' p = ', ' prediction = ')} FROM s),
    c AS (SELECT 'BENIGN' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1_score, tn + fp AS support FROM m
      UNION ALL SELECT 'PortScan', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM m),
    a AS (SELECT * FROM c
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM c
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1_score * support) / sum(support), sum(support) FROM c)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM a""",
)
def class_report(spark, folder):
    report = evaluate.class_report(evaluate.confusion(_rule_scored(spark, folder)))
    return report.select(
        "class", *[rounded(m).alias(m) for m in ("precision", "recall", "f1_score")], "support"
    )


@query(
    "roc_points",
    f"""WITH {_SCORED_SQL}, g AS (SELECT score_a AS threshold, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM s GROUP BY 1),
    c AS (SELECT threshold, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER () AS tp, sum(n) OVER () AS tn
      FROM g WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))
    SELECT round(threshold, 6) AS threshold, round(CAST(cn AS DOUBLE) / tn, 6) AS fpr, round(CAST(cp AS DOUBLE) / tp, 6) AS tpr FROM c""",
)
def roc_points(spark, folder):
    points = evaluate.roc_points(_rule_scored(spark, folder), "y", "score_a")
    return points.select(*[rounded(c).alias(c) for c in ("threshold", "fpr", "tpr")])


@query(
    "roc_auc",
    f"""WITH {_SCORED_SQL}, g AS (SELECT score_a, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM s GROUP BY 1),
    c AS (SELECT p, n, sum(n) OVER (ORDER BY score_a ROWS UNBOUNDED PRECEDING) - n AS below FROM g)
    SELECT round(CAST(sum(p * (below + n / 2.0)) AS DOUBLE) / sum(p) / sum(n), 6) AS auc_roc,
    CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives FROM c""",
)
def roc_auc(spark, folder):
    return evaluate.roc_auc(_rule_scored(spark, folder), "y", "score_a").withColumn("auc_roc", rounded("auc_roc"))


@query(
    "success_criteria",
    _MODELS_SQL
    + """, u AS (SELECT *, model = 'rule_b' AS unsupervised FROM r),
    k AS (SELECT model, unsupervised, f1_score >= CASE WHEN unsupervised THEN 0.60 ELSE 0.88 END AS f1_ok,
      accuracy >= CASE WHEN unsupervised THEN 0.60 ELSE 0.90 END AS accuracy_ok,
      CASE WHEN unsupervised THEN recall >= 0.70 ELSE fpr < 0.06 END AS third_ok, fpr FROM u)
    SELECT model, unsupervised, f1_ok, accuracy_ok, third_ok, f1_ok AND accuracy_ok AND third_ok AS passed FROM k""",
)
def success_criteria(spark, folder):
    metrics = _model_rates(spark, folder).withColumn("unsupervised", F.col("model") == "rule_b")
    return evaluate.criteria(metrics).select("model", "unsupervised", "f1_ok", "accuracy_ok", "third_ok", "passed")


@query(
    "cv_fold_summary",
    f"""WITH {_SCORED_SQL}, d AS (SELECT y, prediction AS p, (row_number() OVER (PARTITION BY y
      ORDER BY md5(flow_id || '|42'), flow_id) - 1) % 10 AS fold FROM s),
    m AS (SELECT fold, {_CONFUSION} FROM d GROUP BY fold),
    ff AS (SELECT coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM m)
    SELECT round(avg(f1), 6) AS mean_f1, round(2 * stddev_pop(f1), 6) AS spread FROM ff""",
)
def cv_fold_summary(spark, folder):
    from scanlens.operators.split import assign_folds

    scored = _rule_scored(spark, folder).select("flow_id", "y", "prediction")
    per_fold = evaluate.rates(evaluate.confusion(assign_folds(scored), by=["fold"]))
    return evaluate.cv_summary(per_fold).select(rounded("mean_f1").alias("mean_f1"), rounded("spread").alias("spread"))


@query(
    "anomaly_capture",
    f"""WITH {_SCORED_SQL} SELECT count(*) FILTER (WHERE score_b >= 0.5) AS flagged, count(*) FILTER (WHERE y = 1) AS actual,
    count(*) FILTER (WHERE score_b >= 0.5 AND y = 1) AS caught, count(*) AS rows,
    round(100 * count(*) FILTER (WHERE score_b >= 0.5 AND y = 1) / count(*) FILTER (WHERE y = 1), 6) AS caught_percent FROM s""",
)
def anomaly_capture(spark, folder):
    scored = _rule_scored(spark, folder, "score_b")
    return evaluate.anomaly_capture(scored).withColumn("caught_percent", rounded("caught_percent"))


_ACTION_SQL = """CASE WHEN prediction = 0 THEN 'ALLOW' WHEN confidence >= 0.85 THEN 'BLOCK'
    WHEN confidence >= 0.6 THEN 'ALERT' ELSE 'MONITOR' END"""


@query(
    "verdict_actions",
    f"""WITH {_SCORED_SQL} SELECT flow_id, src_ip, CAST(dst_port AS INTEGER) AS dst_port, prediction,
    round_even(confidence, 3) AS confidence, CASE prediction WHEN 1 THEN 'PortScan' ELSE 'BENIGN' END AS verdict, {_ACTION_SQL} AS action,
    prediction = 1 AND confidence >= 0.6 AS alert, prediction = 1 AND confidence >= 0.85 AS block FROM s""",
)
def verdict_actions(spark, folder):
    graded = verdicts.grade(verdicts.with_defaults(_rule_scored(spark, folder)))
    p, c = F.col("prediction"), F.col("confidence")
    return graded.select(
        "flow_id", "src_ip", "dst_port", "prediction", F.bround(c, 3).alias("confidence"), "verdict", "action",
        L.raises_alert(p, c).alias("alert"), L.raises_block(p, c).alias("block"),
    )


@query(
    "severity_vote",
    f"""WITH {FLOWS_SQL}, v AS (SELECT flow_id, CAST(score_a >= 0.5 AS INTEGER) + CAST(score_b >= 0.5 AS INTEGER) + CAST(score_c >= 0.5 AS INTEGER) AS votes,
      (score_a + score_b + score_c) / 3 AS confidence FROM flows),
    g AS (SELECT *, CASE WHEN votes = 0 THEN NULL WHEN confidence > 0.95 AND votes >= 3 THEN 'HIGH' WHEN confidence >= 0.85 AND votes >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM v)
    SELECT flow_id, votes, round(confidence, 6) AS confidence, severity, severity IS NOT NULL AS redirect,
    coalesce(severity IN ('MEDIUM', 'HIGH'), false) AS blacklist, coalesce(severity = 'HIGH', false) AS mutate_port FROM g""",
)
def severity_vote(spark, folder):
    graded = verdicts.with_severity(flows(spark, folder), ["score_a", "score_b", "score_c"])
    return graded.select(
        "flow_id", "votes", rounded("confidence").alias("confidence"), "severity", "redirect", "blacklist", "mutate_port"
    )


@query(
    "score_summary",
    f"""WITH {_SCORED_SQL}, t AS ({apply_sql("serve_ref")}),
    a AS (SELECT t.*, s.prediction, {_ACTION_SQL} AS action
      FROM t JOIN (SELECT flow_id, prediction, confidence FROM s) s USING (flow_id))
    SELECT action, count(*) AS flows, CAST(sum(prediction) AS BIGINT) AS attacks, """
    + ", ".join(f"round(avg({c}), 3) + 0.0 AS mean_{c}" for c in K.FEATURES)
    + " FROM a GROUP BY action",
)
def score_summary(spark, folder):
    """Dirty flows cleaned, imputed, capped and logged with fitted parameters, scored, graded and summarised."""
    from scanlens.operators.preprocess import apply_preprocessing, fit_preprocessing

    source = dirty_flows(spark, folder)
    params = fit_preprocessing(source, K.FEATURES, variant="serve_ref")
    graded = verdicts.grade(verdicts.by_rule_score(apply_preprocessing(source, params)))
    return graded.groupBy("action").agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum("prediction").alias("attacks"),
        *[rounded(F.avg(rounded(c)), 3).alias(f"mean_{c}") for c in K.FEATURES],
    )


@query(
    "replay_summary",
    f"""WITH {_SCORED_SQL}, x AS (SELECT prediction FROM s
      UNION ALL SELECT CAST((CASE WHEN l_returnflag = 'R' THEN 0.9 ELSE 0.1 END) >= 0.5 AS INTEGER) FROM lineitem)
    SELECT count(*) FILTER (WHERE prediction = 1) AS alerts, count(*) FILTER (WHERE prediction = 0) AS benign, count(*) AS total FROM x""",
)
def replay_summary(spark, folder):
    """Two feeds joined by name, scored by rule and summarised."""
    from scanlens.operators.align import combine

    scans = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 0.9).otherwise(0.1).alias("score_a")
    )
    feed = combine([flows(spark, folder).select("flow_id", "src_ip", "score_a"), scans])
    return soc.run_summary(verdicts.grade(verdicts.by_rule_score(feed)))
