"""As-of join: to each row the last event at or before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlens.limits import IN_MEMORY_ROWS
from scanlens.operators.lookups import attach_by_key
from scanlens.operators.ranking import bucket_by_splits, split_points
from scanlens.session import written


def _named(by: list[str], last: str) -> Column:
    """One text for the key columns and a place in time; NULL if any of them is."""
    names = [F.col(c) for c in by]
    present = F.col(last).isNotNull()
    for c in names:
        present = present & c.isNotNull()
    return F.when(present, F.to_json(F.struct(*names, F.col(last).alias("_last"))))


def as_of_join(
    rows: DataFrame,
    events: DataFrame,
    values: list[str],
    by: list[str] | None = None,
    ts: str = "ts",
    tie: str | None = None,
    rows_per_cell: int = IN_MEMORY_ROWS,
) -> DataFrame:
    """Add to each row the ``values`` of the last event at or before its time, with equal ``by`` columns.

    Only instants travel: rows and events are reduced to one entry per key and microsecond,
    and those are ordered together within ranges of time.  So neither the only key, nor
    a key or an instant with most of the rows, fills a task.  The last event of each range is
    carried over to the following ranges by a table of one row per key and range.

    Of events at one instant the one with the largest ``tie`` (or values) counts.  Rows before
    the first event, and rows without a time or a key, get NULL.  Columns of ``rows``
    named like a value are replaced.
    """
    by = by or []
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in values])
    at = F.unix_micros(F.col(ts).cast("timestamp")).alias("_at")
    held = F.struct(*[F.col(v) for v in values])
    last = F.max_by(held, F.struct(F.col(tie)) if tie else held)
    marks = events.select(*by, at, *{*values, *([tie] if tie else [])}).groupBy(*by, "_at").agg(last.alias("_event"))
    asked = rows.select(*by, at).distinct()
    both = marks.unionByName(asked.withColumn("_event", F.lit(None).cast(marks.schema["_event"].dataType)))
    both = written(both.where(_named(by, "_at").isNotNull()).withColumn("_order", F.col("_at").cast("double")), "as-of")
    placed = bucket_by_splits(both, "_order", split_points(both, "_order", both.count(), rows_per_cell), "_cell")
    # at most one row per key and range: what each range hands on to the next ones
    ends = placed.groupBy(*by, "_cell").agg(F.max_by("_event", F.when(F.col("_event").isNotNull(), F.col("_at"))).alias("_end"))
    earlier = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).where("_before is not null")
    upto = Window.partitionBy(*by, "_cell").orderBy("_at", F.col("_event").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    seen = placed.withColumn("_seen", F.last("_event", ignorenulls=True).over(upto)).where("_event is null")
    handed = carried.select(_named(by, "_cell").alias("_key"), "_before")
    found = attach_by_key(seen.withColumn("_key", _named(by, "_cell")), handed, "_key").drop("_key")
    known = found.select(_named(by, "_at").alias("_key"), F.coalesce("_seen", "_before").alias("_event")).where("_event is not null")
    keyed = rows.withColumn("_at", at).withColumn("_key", _named(by, "_at")).drop("_at")
    joined = attach_by_key(keyed, known, "_key")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"_event.{v}").alias(v) for v in values])


def with_active_port(flows: DataFrame, rotations: DataFrame, port: str = "dst_port", ts: str = "ts") -> DataFrame:
    """Add the port active at each flow's time and its distance from the probed port.

    ``rotations(ts, active_port)`` may be logged at any time.  Before the first one
    the active port is NULL and the distance 0.
    """
    joined = as_of_join(flows, rotations, ["active_port"], ts=ts, tie="active_port")
    delta = F.abs(F.col(port) - F.col("active_port"))
    return joined.withColumn("mtd_port_delta", F.coalesce(delta, F.lit(0)).cast("int"))
