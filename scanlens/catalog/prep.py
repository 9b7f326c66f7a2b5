"""Cleaning, fitting and applying the preprocessing parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanlens.catalog.registry import DIRTY_SQL, FLOWS_SQL, per_feature, query, rounded
from scanlens.constants import FEATURES
from scanlens.functions import labels as L
from scanlens.operators import clean, preprocess, profile, scale
from scanlens.sources.flows_view import dirty_flows, flows



def _rounded_features():
    return [rounded(c, 6).alias(c) for c in FEATURES]


_ROUNDED_SQL = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in FEATURES)


@query(
    "class_distribution",
    f"WITH {FLOWS_SQL} SELECT label, count(*) AS flows, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM flows GROUP BY label",
)
def class_distribution(spark, folder):
    return profile.class_distribution(flows(spark, folder)).withColumn("share", rounded("share"))


@query(
    "top_ports",
    f"WITH {FLOWS_SQL} SELECT dst_port, count(*) AS flows FROM flows GROUP BY dst_port ORDER BY flows DESC, dst_port LIMIT 10",
)
def top_ports(spark, folder):
    return profile.top_values(flows(spark, folder), "dst_port")


@query(
    "label_encode_variants",
    f"""WITH {DIRTY_SQL} SELECT label, count(*) AS flows,
    CAST(label = 'PortScan' AS INTEGER) AS exact_code,
    CAST(coalesce(trim(label) = 'PortScan', false) AS INTEGER) AS trimmed_code,
    CAST(coalesce(contains(lower(label), 'portscan'), false) AS INTEGER) AS contains_code
    FROM dirty GROUP BY label""",
)
def label_encode_variants(spark, folder):
    label = F.col("label")
    return (
        dirty_flows(spark, folder)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("flows"))
        .select(
            "label",
            "flows",
            L.attack_exact(label).alias("exact_code"),
            L.attack_trimmed(label).alias("trimmed_code"),
            L.attack_contains(label).alias("contains_code"),
        )
    )


@query(
    "clean_drop_nulls",
    f"""WITH {DIRTY_SQL} SELECT flow_id, round(flow_duration, 6) AS flow_duration,
    round(flow_iat_mean, 6) AS flow_iat_mean, label,
    CAST(label = 'PortScan' AS INTEGER) AS y
    FROM clean WHERE label IS NOT NULL AND flow_duration IS NOT NULL AND flow_iat_mean IS NOT NULL""",
)
def clean_drop_nulls(spark, folder):
    labelled = clean.drop_unlabelled(dirty_flows(spark, folder))
    complete = clean.drop_incomplete(clean.non_finite_to_null(labelled), FEATURES + ["label"])
    return complete.select(
        "flow_id",
        rounded("flow_duration").alias("flow_duration"),
        rounded("flow_iat_mean").alias("flow_iat_mean"),
        "label",
        L.attack_exact(F.col("label")).alias("y"),
    )


@query("feature_medians", f"WITH {DIRTY_SQL} " + per_feature(FEATURES, "round(median({f}), 6) AS median", "clean"))
def feature_medians(spark, folder):
    medians = preprocess.feature_medians(dirty_flows(spark, folder))
    return spark.createDataFrame(list(medians.items()), "feature string, median double").withColumn(
        "median", rounded("median")
    )


@query(
    "impute_median",
    f"""WITH {DIRTY_SQL}, m AS (SELECT median(flow_duration) AS d, median(flow_iat_mean) AS i FROM clean)
    SELECT flow_id, round(coalesce(flow_duration, d), 6) AS flow_duration,
    round(coalesce(flow_iat_mean, i), 6) AS flow_iat_mean FROM clean, m""",
)
def impute_median(spark, folder):
    imputed = preprocess.impute_median(dirty_flows(spark, folder))
    return imputed.select(
        "flow_id", rounded("flow_duration").alias("flow_duration"), rounded("flow_iat_mean").alias("flow_iat_mean")
    )


_FENCES = (
    "q AS ("
    + per_feature(
        FEATURES,
        "quantile_cont({f}, 0.25) AS q1, quantile_cont({f}, 0.5) AS q2, quantile_cont({f}, 0.75) AS q3",
        "flows",
    )
    + "), b AS (SELECT *, q1 - 1.5*(q3-q1) AS lower, q3 + 1.5*(q3-q1) AS upper FROM q)"
)
_LONG = "long AS (" + per_feature(FEATURES, "flow_id, {f} AS v", "flows") + ")"


@query(
    "iqr_fences",
    f"""WITH {FLOWS_SQL}, {_FENCES} SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3,
    round(q3 - q1, 6) AS iqr, round(lower, 6) AS lower, round(upper, 6) AS upper FROM b""",
)
def iqr_fences(spark, folder):
    report = profile.iqr_fences(flows(spark, folder))
    return report.select("feature", *[rounded(c).alias(c) for c in report.columns[1:]])


@query(
    "outlier_counts",
    f"""WITH {FLOWS_SQL}, {_FENCES}, {_LONG}
    SELECT feature, CAST(count(*) FILTER (WHERE v < lower OR v > upper) AS BIGINT) AS outliers
    FROM long JOIN b USING (feature) WHERE q1 <> q3 GROUP BY feature""",
)
def outlier_counts(spark, folder):
    return profile.outlier_counts(flows(spark, folder))


@query(
    "winsorize",
    f"""WITH {FLOWS_SQL}, {_FENCES}, w AS (SELECT flow_id, """
    + ", ".join(
        f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END AS {c}" for c in FEATURES
    )
    + " FROM flows, (SELECT "
    + ", ".join(
        f"max(lower) FILTER (WHERE feature='{c}' AND q1<>q3) AS {c}_lo, max(upper) FILTER (WHERE feature='{c}' AND q1<>q3) AS {c}_hi"
        for c in FEATURES
    )
    + f" FROM b)) SELECT flow_id, {_ROUNDED_SQL} FROM w",
)
def winsorize(spark, folder):
    from scanlens.functions.scalars import clip

    source = flows(spark, folder)
    found = profile.quartile_fences(source)
    bounds = {c: (lo, hi) if q1 != q3 else (None, None) for c, (q1, _, q3, lo, hi) in found.items()}
    capped = source.withColumns({c: clip(F.col(c), *bounds[c]) for c in FEATURES})
    return capped.select("flow_id", *_rounded_features())


@query(
    "skewness_report",
    f"""WITH {FLOWS_SQL}, r AS ({per_feature(FEATURES, "skewness({f}) AS s, min({f}) AS m", "flows")})
    SELECT feature, round(s, 6) + 0.0 AS skewness, round(m, 6) AS minimum, abs(s) > 1 AS log,
    CASE WHEN abs(s) > 1 AND m < 0 THEN round(-m, 6) ELSE 0.0::DOUBLE END AS shift FROM r""",
)
def skewness_report(spark, folder):
    report = profile.skewness_report(flows(spark, folder))
    return report.select(
        "feature",
        rounded("skewness").alias("skewness"),
        rounded("minimum").alias("minimum"),
        "log",
        rounded("shift").alias("shift"),
    )


def _params_sql(variant: str) -> str:
    """Medians, fences, skewness and shift of every feature, as CTEs ending in ``p``."""
    medians = "md AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in FEATURES) + " FROM clean)"
    imputed = (
        "imp AS (SELECT c.flow_id, c.label, "
        + ", ".join(f"coalesce(c.{c}, md.{c}) AS {c}" for c in FEATURES)
        + " FROM clean c, md)"
    )
    quartiles = (
        "qt AS ("
        + per_feature(FEATURES, "quantile_cont({f}, 0.25) AS q1, quantile_cont({f}, 0.75) AS q3", "imp")
        + ")"
    )
    guard = " AND q1 <> q3" if variant == "train" else ""
    bounds = (
        "bd AS (SELECT "
        + ", ".join(
            f"max(q1 - 1.5*(q3-q1)) FILTER (WHERE feature='{c}'{guard}) AS {c}_lo, "
            f"max(q3 + 1.5*(q3-q1)) FILTER (WHERE feature='{c}'{guard}) AS {c}_hi"
            for c in FEATURES
        )
        + " FROM qt)"
    )
    capped = (
        "cap AS (SELECT flow_id, label, "
        + ", ".join(
            f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END AS {c}" for c in FEATURES
        )
        + " FROM imp, bd)"
    )
    shaped = "cap" if variant == "train" else "imp"
    shape = "sh AS (" + per_feature(FEATURES, "skewness({f}) AS skew, min({f}) AS mn", shaped) + ")"
    params = (
        "p AS (SELECT sh.feature, skew, abs(skew) > 1 AS log, "
        "CASE WHEN abs(skew) > 1 AND mn < 0 THEN -mn ELSE 0.0::DOUBLE END AS shift FROM sh)"
    )
    return ", ".join([medians, imputed, quartiles, bounds, capped, shape, params])


def _param_rows_sql(variant: str) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, md.{c} AS median, bd.{c}_lo AS lower, bd.{c}_hi AS upper FROM md, bd"
        for c in FEATURES
    )
    return f"""WITH {DIRTY_SQL}, {_params_sql(variant)}, r AS ({rows})
    SELECT feature, round(median, 6) AS median, round(lower, 6) AS lower, round(upper, 6) AS upper,
    round(skew, 6) + 0.0 AS skewness, log, round(shift, 6) AS shift FROM r JOIN p USING (feature)"""


def apply_sql(variant: str) -> str:
    lifted = (
        "ls AS (SELECT "
        + ", ".join(
            f"bool_or(log) FILTER (WHERE feature='{c}') AS {c}_log, max(shift) FILTER (WHERE feature='{c}') AS {c}_sh"
            for c in FEATURES
        )
        + " FROM p)"
    )
    outputs = ", ".join(
        f"round(CASE WHEN {c}_log THEN ln(1 + greatest({c} + {c}_sh, 0)) ELSE {c} END, 6) + 0.0 AS {c}" for c in FEATURES
    )
    return f"WITH {DIRTY_SQL}, {_params_sql(variant)}, {lifted} SELECT flow_id, {outputs} FROM cap, ls"


def _param_frame(spark, params):
    frame = params.to_frame(spark)
    numeric = ["median", "lower", "upper", "skewness", "shift"]
    return frame.select("feature", "log", *[rounded(c).alias(c) for c in numeric])


@query("fit_preprocessing", _param_rows_sql("serve_ref"))
def fit_preprocessing(spark, folder):
    return _param_frame(spark, preprocess.fit_preprocessing(dirty_flows(spark, folder), variant="serve_ref"))


@query("fit_train_preprocessing", _param_rows_sql("train"))
def fit_train_preprocessing(spark, folder):
    return _param_frame(spark, preprocess.fit_preprocessing(dirty_flows(spark, folder), variant="train"))


@query("apply_preprocessing", apply_sql("serve_ref"))
def apply_preprocessing(spark, folder):
    source = dirty_flows(spark, folder)
    params = preprocess.fit_preprocessing(source, variant="serve_ref")
    return preprocess.apply_preprocessing(source, params).select("flow_id", *_rounded_features())


@query("train_preprocessing", apply_sql("train"))
def train_preprocessing(spark, folder):
    source = dirty_flows(spark, folder)
    params = preprocess.fit_preprocessing(source, variant="train")
    return preprocess.apply_preprocessing(source, params).select("flow_id", *_rounded_features())


@query(
    "standard_scale",
    f"WITH {FLOWS_SQL} SELECT flow_id, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) + 0.0 AS {c}"
        for c in FEATURES
    )
    + " FROM flows",
)
def standard_scale(spark, folder):
    source = flows(spark, folder)
    return scale.fit_scaler(source, FEATURES).transform(source).select("flow_id", *_rounded_features())


@query(
    "profile_table",
    f"WITH {DIRTY_SQL}, r AS ("
    + per_feature(
        FEATURES,
        "count(*) AS rows, count(*) - count({f}) AS nulls, avg({f}) AS mean, stddev_samp({f}) AS std, min({f}) AS min, "
        "quantile_cont({f}, 0.25) AS q1, median({f}) AS median, quantile_cont({f}, 0.75) AS q3, max({f}) AS max",
        "clean",
    )
    + """) SELECT feature, rows, nulls, round(mean, 4) AS mean, round(std, 4) AS std, round(min, 6) AS min,
    round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(max, 6) AS max FROM r""",
)
def profile_table(spark, folder):
    report = profile.profile_table(dirty_flows(spark, folder))
    digits = {"mean": 4, "std": 4}
    return report.select(
        "feature", "rows", "nulls", *[rounded(c, digits.get(c, 6)).alias(c) for c in report.columns[3:]]
    )


@query(
    "correlation_matrix",
    f"WITH {FLOWS_SQL} "
    + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) + 0.0 AS correlation FROM flows"
        for a in FEATURES
        for b in FEATURES
    ),
)
def correlation_matrix(spark, folder):
    return profile.correlation_matrix(flows(spark, folder)).withColumn("correlation", rounded("correlation"))


@query(
    "box_stats",
    f"""WITH {FLOWS_SQL}, {_FENCES}, {_LONG}
    SELECT feature, round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
    round(min(v) FILTER (WHERE v BETWEEN lower AND upper), 6) AS whisker_low,
    round(max(v) FILTER (WHERE v BETWEEN lower AND upper), 6) AS whisker_high,
    CAST(count(*) FILTER (WHERE v < lower OR v > upper) AS BIGINT) AS outliers
    FROM long JOIN b USING (feature) GROUP BY feature, q1, q2, q3""",
)
def box_stats(spark, folder):
    report = profile.box_stats(flows(spark, folder))
    numeric = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return report.select("feature", *[rounded(c).alias(c) for c in numeric], "outliers")
