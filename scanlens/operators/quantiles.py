"""Exact quantiles (linear interpolation, NULLs skipped) at any size.

Small inputs use the built-in exact ``percentile``.  Its buffer holds every
distinct value in one task, so larger inputs are narrowed instead: a bounded
sketch brackets each wanted rank, one counting pass checks the bracket, and only
the few rows inside it are ordered.  Each pass is a map-side aggregate over all
columns at once; nothing but counts and brackets returns to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlens.limits import IN_MEMORY_ROWS

_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY


@dataclass
class _Target:
    column: str
    rank: int  # 0-based rank among the non-NULL values
    low: float = math.nan
    high: float = math.nan
    below: int = 0  # rows smaller than every open candidate
    inside: int = 0  # rows strictly between low and high
    value: float | None = None


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    in_memory_rows: int = IN_MEMORY_ROWS,
) -> dict[str, list[float | None]]:
    """{column: [quantile per probability]}; None for a column without values."""
    df = df.select(*columns)
    if df.count() <= in_memory_rows:
        wanted = F.array(*[F.lit(p) for p in probabilities])
        row = df.agg(*[F.percentile(F.col(c), wanted).alias(c) for c in columns]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probabilities) for c in columns}
    return _narrowed_quantiles(df, columns, probabilities, in_memory_rows)


def _narrowed_quantiles(df, columns, probabilities, in_memory_rows):
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    targets: dict[tuple[str, int], _Target] = {}
    for c in columns:
        for p in probabilities:
            if counts[c]:
                position = p * (counts[c] - 1)
                for rank in {math.floor(position), math.ceil(position)}:
                    targets.setdefault((c, rank), _Target(c, rank))

    if not targets:
        return {c: [None] * len(probabilities) for c in columns}
    everything = {t: counts[t.column] for t in map(_key, targets.values())}
    _bracket(df, list(targets.values()), everything, first=True)
    while True:
        _count_brackets(df, [t for t in targets.values() if t.value is None])
        pending = [t for t in targets.values() if t.value is None]
        wide = [t for t in pending if t.inside > in_memory_rows]
        if not wide:
            break
        _bracket(df, wide, {_key(t): t.inside for t in wide}, first=False)
    if pending:
        _select_inside(df, pending)

    result: dict[str, list[float | None]] = {}
    for c in columns:
        values: list[float | None] = []
        for p in probabilities:
            if not counts[c]:
                values.append(None)
                continue
            position = p * (counts[c] - 1)
            left = targets[(c, math.floor(position))].value
            right = targets[(c, math.ceil(position))].value
            # The interpolation of the built-in percentile, so that both plans give the same bits.
            upper, lower = math.ceil(position) - position, position - math.floor(position)
            values.append(left if left == right else upper * left + lower * right)
        result[c] = values
    return result


@dataclass(frozen=True)
class _Key:
    column: str
    rank: int


def _key(t: _Target) -> _Key:
    return _Key(t.column, t.rank)


def _open_interval(t: _Target) -> Column:
    c = F.col(t.column)
    return F.when((c > F.lit(t.low)) & (c < F.lit(t.high)), c)


def _bracket(df, targets, sizes, first: bool) -> None:
    """Set low/high of each target from a sketch of its candidates.

    Targets with the same candidates (one column, or one open interval) share a sketch.
    """
    groups: dict[tuple, list[_Target]] = {}
    for t in targets:
        groups.setdefault((t.column,) if first else (t.column, t.low, t.high), []).append(t)

    def share(t: _Target) -> float:
        return (t.rank if first else t.rank - t.below) / max(sizes[_key(t)] - 1, 1)

    exprs = []
    for i, members in enumerate(groups.values()):
        candidates = F.col(members[0].column) if first else _open_interval(members[0])
        ends = [e for t in members for e in (max(0.0, share(t) - _MARGIN), min(1.0, share(t) + _MARGIN))]
        exprs.append(
            F.struct(
                F.percentile_approx(candidates, F.array(*[F.lit(e) for e in ends]), _ACCURACY).alias("ends"),
                F.min(candidates).alias("min"),
                F.max(candidates).alias("max"),
            ).alias(f"g{i}")
        )
    row = df.agg(*exprs).first()
    for i, members in enumerate(groups.values()):
        found = row[f"g{i}"]
        for j, t in enumerate(members):
            # A bracket that reaches an end of the data is widened to it, so that rank 0 and n-1 are inside.
            at = share(t)
            t.low = found["min"] if at - _MARGIN <= 0 else found["ends"][2 * j]
            t.high = found["max"] if at + _MARGIN >= 1 else found["ends"][2 * j + 1]


def _count_brackets(df, targets) -> None:
    """Place each rank: on an end of its bracket, inside it, or in the part the sketch missed."""
    if not targets:
        return
    bounds = sorted({(t.column, v) for t in targets for v in (t.low, t.high)})
    columns = sorted({t.column for t in targets})
    row = df.agg(
        *[F.count_if(F.col(c) < F.lit(v)).alias(f"lt{i}") for i, (c, v) in enumerate(bounds)],
        *[F.count_if(F.col(c) <= F.lit(v)).alias(f"le{i}") for i, (c, v) in enumerate(bounds)],
        *[
            F.struct(F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max")).alias(f"c{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    at = {bound: i for i, bound in enumerate(bounds)}
    for t in targets:
        low, high, whole = at[(t.column, t.low)], at[(t.column, t.high)], row[f"c{columns.index(t.column)}"]
        if t.rank < row[f"lt{low}"]:
            # The bracket lies too high: search below it (the new bounds are exclusive).
            t.low, t.high = math.nextafter(whole["min"], -math.inf), t.low
            t.below, t.inside = 0, row[f"lt{low}"]
        elif t.rank < row[f"le{low}"]:
            t.value = t.low
        elif t.rank < row[f"lt{high}"]:
            t.below, t.inside = row[f"le{low}"], row[f"lt{high}"] - row[f"le{low}"]
        elif t.rank < row[f"le{high}"]:
            t.value = t.high
        else:
            t.low, t.high = t.high, math.nextafter(whole["max"], math.inf)
            t.below, t.inside = row[f"le{high}"], whole["n"] - row[f"le{high}"]


def _select_inside(df, targets) -> None:
    """Order the candidates of each target; every set is within the in-memory limit."""
    candidates = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("t"), _open_interval(t).alias("v")) for i, t in enumerate(targets)])
        ).alias("c")
    ).select("c.t", "c.v").where("v IS NOT NULL")
    counted = candidates.groupBy("t", "v").count()
    reached = counted.withColumn(
        "upto", F.sum("count").over(Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    )
    is_hit = F.lit(False)
    for i, t in enumerate(targets):
        local = t.rank - t.below
        is_hit = is_hit | (
            (F.col("t") == i) & (F.col("upto") > local) & (F.col("upto") - F.col("count") <= local)
        )
    for row in reached.where(is_hit).collect():  # one row per target
        targets[row["t"]].value = row["v"]
