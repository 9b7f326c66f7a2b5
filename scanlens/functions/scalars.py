"""Numeric, text and time expressions; every one stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def finite(c: Column) -> Column:
    """NaN and both infinities become NULL (NaN compares above +Infinity)."""
    return F.when(F.abs(c) < F.lit(_INF), c)


def to_double(c: Column) -> Column:
    """Numeric coercion: text that is no number becomes NULL."""
    return c.try_cast("double")


def clip(c: Column, lower: float | None, upper: float | None) -> Column:
    """Cap to the fences; NULL stays NULL (map NaN to NULL first, as it compares above every fence)."""
    if lower is None or upper is None:
        return c
    return F.when(c < F.lit(lower), F.lit(lower)).when(c > F.lit(upper), F.lit(upper)).otherwise(c)


def log1p_shifted(c: Column, shift: float) -> Column:
    """log(1 + x + shift); served values below the fitted minimum are clamped to 0."""
    moved = c + F.lit(shift) if shift > 0 else c
    return F.log1p(F.when(moved < 0, F.lit(0.0)).otherwise(moved))


def z_score(c: Column, mean: float, deviation: float) -> Column:
    """(x - mean) / population deviation; a constant column is only centred."""
    return (c - F.lit(mean)) / F.lit(deviation if deviation else 1.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """0 when the denominator is 0 or NULL."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def g1_skewness(c: Column) -> Column:
    """Bias-corrected skewness: the population value times sqrt(n(n-1))/(n-2).

    NULL below three values; a constant column has skewness 0.
    """
    n = F.count(c).cast("double")
    factor = F.sqrt(n * (n - 1)) / (n - 2)
    population = F.when(F.stddev_pop(c) == 0, F.lit(0.0)).otherwise(F.skewness(c))
    return F.when(n > 2, population * factor)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 UTC."""
    return F.unix_timestamp(ts.cast("timestamp"))


def parse_time(text: Column) -> Column:
    """ISO text with ``T`` or a blank between date and time; anything else is NULL."""
    return F.try_to_timestamp(text)
