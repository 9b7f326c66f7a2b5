"""Wide feature projection and synthetic defence telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions.hashing import bernoulli, integer_below
from scanlens.operators.lookups import with_distinct_ports


def engineer_features(
    flows: DataFrame, source: str = "Source IP", keep: list[str] | None = None, **limits
) -> DataFrame:
    """The 46-column projection of a raw flow table, plus the columns named in ``keep``.

    Distinct ports per source are attached when the table has a source column;
    otherwise the raw port stands in.
    """
    derived = next(target for target, origin in K.WIDE_FEATURES if origin is None)
    counted = with_distinct_ports(flows, source, "Destination Port", "_distinct_ports", **limits)
    columns = [
        F.col("_distinct_ports").cast("double").alias(derived)
        if origin is None
        else F.col(f"`{origin}`").cast("double").alias(target)
        for target, origin in K.WIDE_FEATURES
    ]
    return counted.select(*[F.col(f"`{name}`") for name in keep or []], *columns)


def _by_class(attack: Column, values: dict[int, float]) -> Column:
    return F.when(attack == 1, F.lit(values[1])).otherwise(F.lit(values[0]))


def inject_defence_features(
    df: DataFrame,
    attack: str = "y",
    key: str = "flow_id",
    seed: int = K.SEED,
    names: list[str] = K.WIDE_DEFENCE_FEATURES,
) -> DataFrame:
    """Decoy contact and port distance drawn by class, from the row key only."""
    y, row_key = F.col(attack), F.col(key)
    shadow, delta = names
    return df.withColumns(
        {
            shadow: bernoulli(row_key, f"shadow|{seed}", _by_class(y, K.SHADOW_RATE)),
            delta: integer_below(row_key, f"delta|{seed}", _by_class(y, K.PORT_DELTA_RANGE)),
        }
    )
