"""Column-name hygiene, feature contract, NULL handling."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scanlens.constants import FEATURES
from scanlens.functions import scalars as S

log = logging.getLogger(__name__)


def strip_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names; a repeated name gets its position appended."""
    seen: set[str] = set()
    names = []
    for i, name in enumerate(c.strip() for c in df.columns):
        unique = name if name not in seen else f"{name}.{i}".replace(".", "_")
        seen.add(unique)
        names.append(unique)
    return df.toDF(*names)


def require_features(df: DataFrame, features: list[str] = FEATURES, mode: str = "strict") -> DataFrame:
    """Check the contract: ``strict`` raises, ``warn`` logs, ``default0`` adds 0.0 columns."""
    missing = missing_columns(df, features)
    if not missing:
        return df
    if mode == "strict":
        raise ValueError(f"missing features: {missing}")
    if mode == "warn":
        log.warning("missing features: %s", missing)
        return df
    if mode == "default0":
        return df.withColumns({name: F.lit(0.0) for name in missing})
    raise ValueError(f"unknown mode {mode!r}")


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in wanted if name not in present]


def select_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Features in contract order."""
    return df.select(*[F.col(f"`{name}`") for name in features])


def keep_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{name}`") for name in wanted if name in present])


def add_placeholders(df: DataFrame, names: list[str], only_if_absent: bool = False) -> DataFrame:
    chosen = missing_columns(df, names) if only_if_absent else names
    return df.withColumns({name: F.lit(0.0) for name in chosen}) if chosen else df


def drop_unlabelled(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label).isNotNull())


def non_finite_to_null(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """All features in one projection; run before any aggregate, as NaN poisons sums."""
    return df.withColumns({name: S.finite(F.col(f"`{name}`").cast("double")) for name in features})


def drop_incomplete(
    df: DataFrame, columns: list[str] | None = None, observation: Observation | None = None
) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any column; an observation receives rows and dropped rows.

    One condition per column: the optimizer rewrites a single condition over all columns
    for every later alias of any of them, which doubles its work with each alias.
    """
    subset = columns or df.columns
    if observation is not None:
        incomplete = F.greatest(*[F.col(f"`{c}`").isNull() for c in subset], F.lit(False))
        df = df.observe(
            observation, F.count(F.lit(1)).alias("rows"), F.count_if(incomplete).alias("dropped")
        )
    kinds = dict(df.dtypes)
    for c in subset:
        column = F.col(f"`{c}`")
        df = df.where(column.isNotNull() & ~F.isnan(column) if kinds[c] in ("float", "double") else column.isNotNull())
    return df


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {name: F.coalesce(F.col(f"`{name}`"), F.lit(value)) for name, value in medians.items() if value is not None}
    )
