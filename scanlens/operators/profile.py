"""Descriptive statistics; each report is one pass over all features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlens.constants import FEATURES
from scanlens.functions import scalars as S
from scanlens.operators.clean import non_finite_to_null
from scanlens.operators.preprocess import fences
from scanlens.operators.quantiles import exact_quantiles


def unpivot_aggregates(df: DataFrame, features: list[str], measures: dict) -> DataFrame:
    """One aggregate row for all features, turned into one row per feature.

    ``measures`` maps an output name to a function of the feature name.
    """
    wide = df.agg(
        *[
            F.struct(
                F.lit(f).alias("feature"), *[measure(f).alias(name) for name, measure in measures.items()]
            ).alias(f"s{i}")
            for i, f in enumerate(features)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(features))])))


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per label; the total comes from the handful of label rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("flows"))
    # Per-label rows only, so the single total is over as many rows as there are labels.
    total = F.sum("flows").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", F.col("flows") / total)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The most frequent values of a column; ties go to the smaller value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("flows"))
    return counts.orderBy(F.col("flows").desc(), column).limit(n)


def _literal(values: dict[str, float | None]):
    return lambda f: F.lit(values[f]).cast("double")


def quartile_fences(df: DataFrame, features: list[str] = FEATURES) -> dict[str, tuple]:
    """{feature: (q1, median, q3, lower, upper)}."""
    result = {}
    for c, (q1, q2, q3) in exact_quantiles(df, features, [0.25, 0.5, 0.75]).items():
        result[c] = (q1, q2, q3) + (fences(q1, q3) if q1 is not None else (None, None))
    return result


def iqr_fences(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    found = quartile_fences(df, features)
    rows = [(c, q1, q3, q3 - q1 if q1 is not None else None, lo, hi) for c, (q1, _, q3, lo, hi) in found.items()]
    return df.sparkSession.createDataFrame(
        rows, "feature string, q1 double, q3 double, iqr double, lower double, upper double"
    )


def outlier_counts(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Values strictly outside the fences; features without spread (zero IQR) are left out."""
    found = {c: v for c, v in quartile_fences(df, features).items() if v[0] is not None and v[0] != v[2]}

    def outliers(f: str) -> Column:
        return F.count_if((F.col(f) < F.lit(found[f][3])) | (F.col(f) > F.lit(found[f][4])))

    if not found:
        return df.sparkSession.createDataFrame([], "feature string, outliers bigint")
    return unpivot_aggregates(df, list(found), {"outliers": outliers})


def skewness_report(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    report = unpivot_aggregates(
        df,
        features,
        {"skewness": lambda f: S.g1_skewness(F.col(f)), "minimum": lambda f: F.min(f)},
    )
    log = F.coalesce(F.abs("skewness") > 1.0, F.lit(False))
    return report.withColumns(
        {"log": log, "shift": F.when(log & (F.col("minimum") < 0), -F.col("minimum")).otherwise(F.lit(0.0))}
    )


def profile_table(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Count, NULLs, mean, deviation, min, quartiles, max per feature."""
    cleaned = non_finite_to_null(df, features)
    quartiles = exact_quantiles(cleaned, features, [0.25, 0.5, 0.75])
    return unpivot_aggregates(
        cleaned,
        features,
        {
            "rows": lambda f: F.count(F.lit(1)),
            "nulls": lambda f: F.count_if(F.col(f).isNull()),
            "mean": lambda f: F.avg(f),
            "std": lambda f: F.stddev_samp(f),
            "min": lambda f: F.min(f),
            "q1": _literal({f: quartiles[f][0] for f in features}),
            "median": _literal({f: quartiles[f][1] for f in features}),
            "q3": _literal({f: quartiles[f][2] for f in features}),
            "max": lambda f: F.max(f),
        },
    )


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "name string, type string")


def correlation_matrix(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Pearson correlation of every pair; long form, both halves.

    Every task adds up the products of its blocks, shifted by the means, in one matrix; what
    is exchanged is one row per task and pair.  A pair counts the rows that have both
    values.  A pair with a constant feature, or with a NaN or infinite value, is NULL.
    """
    values = [F.col(f"`{f}`").cast("double") for f in features]
    means = df.agg(*[F.avg(S.finite(v)).alias(f"m{i}") for i, v in enumerate(values)]).first()
    shift, width = np.array([m or 0.0 for m in means]), len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, width, width))
        for b in batches:
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns]).astype(float)
            x = np.column_stack([c.fill_null(0.0).to_numpy() for c in b.columns]) - shift
            x[there == 0] = 0.0
            total += there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x
        a, z = (i.ravel() for i in np.indices((width, width)))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z), *(pa.array(t.ravel()) for t in total)], names=["a", "z", "n", "x", "xx", "xy"])

    sums = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).mapInArrow(run, "a long, z long, n double, x double, xx double, xy double")
    cells = sums.groupBy("a", "z").agg(*[F.sum(c).alias(c) for c in ("n", "x", "xx", "xy")])
    left, right = cells, cells.select(F.col("a").alias("z"), F.col("z").alias("a"), F.col("x").alias("y"), F.col("xx").alias("yy"))
    both = left.join(right, ["a", "z"])
    n = F.nullif(F.col("n"), F.lit(0.0))
    sxx, syy = F.col("xx") - F.col("x") * F.col("x") / n, F.col("yy") - F.col("y") * F.col("y") / n
    # rounding leaves a trace of the squares where all values are equal
    varies = (sxx > 1e-12 * F.col("xx")) & (syy > 1e-12 * F.col("yy")) & (F.col("n") > 1)
    found = F.when(varies, (F.col("xy") - F.col("x") * F.col("y") / n) / F.sqrt(sxx * syy))
    named = F.array(*map(F.lit, features))
    value = F.when(F.col("a") == F.col("z"), F.when(varies, F.lit(1.0))).otherwise(S.finite(found))
    return both.select(F.get(named, F.col("a").cast("int")).alias("feature_a"), F.get(named, F.col("z").cast("int")).alias("feature_b"), value.alias("correlation"))


def box_stats(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Quartiles, whiskers (extreme values within the fences) and outlier count."""
    found = quartile_fences(df, features)

    def within(f: str) -> Column:
        return F.when(F.col(f).between(F.lit(found[f][3]), F.lit(found[f][4])), F.col(f))

    return unpivot_aggregates(
        df,
        [f for f in features if found[f][0] is not None],
        {
            "q1": _literal({f: v[0] for f, v in found.items()}),
            "median": _literal({f: v[1] for f, v in found.items()}),
            "q3": _literal({f: v[2] for f, v in found.items()}),
            "whisker_low": lambda f: F.min(within(f)),
            "whisker_high": lambda f: F.max(within(f)),
            "outliers": lambda f: F.count_if(
                (F.col(f) < F.lit(found[f][3])) | (F.col(f) > F.lit(found[f][4]))
            ),
        },
    )
