"""Fit and apply the impute -> cap -> de-skew parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlens.constants import FEATURES
from scanlens.functions import scalars as S
from scanlens.limits import IN_MEMORY_ROWS
from scanlens.operators.clean import impute, non_finite_to_null
from scanlens.operators.quantiles import exact_quantiles
from scanlens.schemas import PARAM_SCHEMA

# serve_ref : fences and skewness from imputed, un-capped data; zero-IQR fences kept
# train     : zero-IQR features not capped; skewness and minimum taken after capping
VARIANTS = ("serve_ref", "train")


@dataclass
class FeatureParams:
    feature: str
    median: float
    lower: float | None
    upper: float | None
    skewness: float | None
    log: bool
    shift: float


@dataclass
class Preprocessing:
    """Fitted parameters, one entry per feature."""

    features: list[FeatureParams] = field(default_factory=list)

    @property
    def medians(self) -> dict[str, float]:
        return {p.feature: p.median for p in self.features}

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (p.feature, p.median, p.lower, p.upper, p.skewness, p.log, p.shift) for p in self.features
        ]
        return spark.createDataFrame(rows, PARAM_SCHEMA)

    @classmethod
    def from_frame(cls, frame: DataFrame) -> "Preprocessing":
        """One row per feature, so reading it back is bounded by the contract."""
        return cls([FeatureParams(**row.asDict()) for row in frame.select(*PARAM_SCHEMA.names).collect()])

    def write(self, spark: SparkSession, path: str) -> None:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "Preprocessing":
        return cls.from_frame(spark.read.schema(PARAM_SCHEMA).json(path))


def feature_medians(
    df: DataFrame, features: list[str] = FEATURES, in_memory_rows: int = IN_MEMORY_ROWS
) -> dict[str, float | None]:
    cleaned = non_finite_to_null(df.select(*features), features)
    return {c: q[0] for c, q in exact_quantiles(cleaned, features, [0.5], in_memory_rows).items()}


def impute_median(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Fallback path without fitted parameters: medians of the incoming batch."""
    return impute(non_finite_to_null(df, features), feature_medians(df, features))


def fences(q1: float, q3: float) -> tuple[float, float]:
    reach = 1.5 * (q3 - q1)
    return q1 - reach, q3 + reach


def fit_preprocessing(
    df: DataFrame,
    features: list[str] = FEATURES,
    variant: str = "train",
    in_memory_rows: int = IN_MEMORY_ROWS,
) -> Preprocessing:
    """Medians, fences, skewness and shifts; every pass covers all features at once."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    cleaned = non_finite_to_null(df.select(*features), features)
    medians = {c: q[0] for c, q in exact_quantiles(cleaned, features, [0.5], in_memory_rows).items()}
    imputed = impute(cleaned, medians)
    quartiles = exact_quantiles(imputed, features, [0.25, 0.75], in_memory_rows)
    bounds: dict[str, tuple[float | None, float | None]] = {}
    for c in features:
        q1, q3 = quartiles[c]
        if q1 is None or (variant == "train" and q3 == q1):
            bounds[c] = (None, None)
        else:
            bounds[c] = fences(q1, q3)

    shaped = imputed
    if variant == "train":
        shaped = imputed.select(*[S.clip(F.col(c), *bounds[c]).alias(c) for c in features])
    row = shaped.agg(
        *[S.g1_skewness(F.col(c)).alias(f"{c}__skew") for c in features],
        *[F.min(c).alias(f"{c}__min") for c in features],
    ).first()

    fitted = []
    for c in features:
        skewness, smallest = row[f"{c}__skew"], row[f"{c}__min"]
        log = skewness is not None and abs(skewness) > 1.0
        shift = -smallest if log and smallest < 0 else 0.0
        fitted.append(FeatureParams(c, medians[c], *bounds[c], skewness, log, shift))
    return Preprocessing(fitted)


def apply_preprocessing(df: DataFrame, params: Preprocessing) -> DataFrame:
    """One projection of built-in expressions; other columns pass through."""
    shaped = {}
    for p in params.features:
        c = S.finite(F.col(p.feature).cast("double"))
        if p.median is not None:
            c = F.coalesce(c, F.lit(p.median))
        c = S.clip(c, p.lower, p.upper)
        if p.log:
            c = S.log1p_shifted(c, p.shift)
        shaped[p.feature] = c
    return df.withColumns(shaped)


def below_fitted_minimum(df: DataFrame, params: Preprocessing) -> DataFrame:
    """Rows per logged feature that apply_preprocessing clamps at the fitted minimum."""
    counts = []
    for p in params.features:
        if p.log:
            c = S.clip(F.coalesce(S.finite(F.col(p.feature).cast("double")), F.lit(p.median)), p.lower, p.upper)
            counts.append(F.count_if(c + F.lit(p.shift) < 0).alias(p.feature))
    return df.agg(*counts) if counts else df.sparkSession.createDataFrame([], "feature string")
