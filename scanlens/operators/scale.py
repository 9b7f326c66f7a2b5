"""Standard scaler with population deviation (a constant column is only centred)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlens.functions import scalars as S


@dataclass
class Scaler:
    means: dict[str, float]
    deviations: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: S.z_score(F.col(f"`{c}`"), self.means[c], self.deviations[c]) for c in self.means}
        )

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.means[c], self.deviations[c]) for c in self.means]
        return spark.createDataFrame(rows, "feature string, mean double, deviation double")

    def write(self, spark: SparkSession, path: str) -> None:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "Scaler":
        rows = spark.read.schema("feature string, mean double, deviation double").json(path).collect()
        return cls({r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["deviation"] for r in rows})


def fit_scaler(df: DataFrame, features: list[str]) -> Scaler:
    row = df.agg(
        *[
            F.struct(F.avg(f"`{c}`").alias("m"), F.stddev_pop(f"`{c}`").alias("s")).alias(f"f{i}")
            for i, c in enumerate(features)
        ]
    ).first()
    return Scaler(
        {c: row[f"f{i}"]["m"] for i, c in enumerate(features)},
        {c: row[f"f{i}"]["s"] for i, c in enumerate(features)},
    )
