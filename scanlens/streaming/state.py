"""Block list with expiry: as a table of periods per micro-batch, or as stream state.

``block_table`` needs column expressions only.  ``block_periods`` keeps a Python state
processor for streams that must report a period when it closes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from scanlens import constants as K
from scanlens.functions.scalars import epoch_seconds
from scanlens.session import drop_path
from scanlens.sources.files import path_exists
from scanlens.streaming.dispatch import batch_folder

TTL_SECONDS = K.BLOCK_TTL_MINUTES * 60
_PIECE = "src_ip string, first long, last timestamp, last_second long, events long"
PERIOD = "src_ip string, blocked_from long, blocked_until long, block_events long, closed boolean"


def merge_periods(periods: list[tuple[int, int, int]], ttl: int) -> list[tuple[int, int, int]]:
    """Join (first, last, events) periods whose distance is below the lifetime."""
    merged: list[tuple[int, int, int]] = []
    for first, last, events in sorted(periods):
        if merged and first - merged[-1][1] < ttl:
            start, end, n = merged.pop()
            merged.append((start, max(end, last), n + events))
        else:
            merged.append((first, last, events))
    return merged


def block_pieces(blocks: DataFrame, source: str = "src_ip", ts: str = "ts") -> DataFrame:
    """``(src_ip, first, last, events)`` of the block events of each source and lifetime slot.

    Two blocks of one slot are closer than the lifetime, so a source with very many blocks is
    few pieces, and they are combined before the exchange.
    """
    second = epoch_seconds(F.col(ts))
    outside = blocks.where(~F.col(source).isin(*K.LOOPBACK_SOURCES) & F.col(ts).isNotNull())
    slim = outside.select(F.col(source).alias("src_ip"), second.alias("second"), F.floor(second / TTL_SECONDS).alias("slot"))
    return slim.groupBy("src_ip", "slot").agg(F.min("second").alias("first"), F.max("second").alias("last"), F.count(F.lit(1)).alias("events")).drop("slot")


def merged_pieces(pieces: DataFrame, ttl: int = TTL_SECONDS) -> DataFrame:
    """Pieces of one source whose distance is below the lifetime become one."""
    before = Window.partitionBy("src_ip").orderBy("first", "last")
    reach = F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col("first") - reach >= ttl)).cast("int")
    number = F.sum("_opens").over(before.rowsBetween(Window.unboundedPreceding, 0))
    grouped = pieces.withColumn("_opens", opens).withColumn("_n", number).groupBy("src_ip", "_n")
    return grouped.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events")).drop("_n")


def block_table(output: str, source: str = "src_ip", ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """Keep the block periods of a stream as one small table per micro-batch.

    Every batch merges its pieces with its predecessor's table.  Rows may come in any order:
    a late block joins the period it belongs to.  A repeated batch starts from the same
    predecessor and gives the same table; older ones are dropped.
    """
    folder = f"{output}/periods"

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        pieces, before = block_pieces(batch, source, ts), batch_folder(folder, number - 1)
        if path_exists(spark, before):
            pieces = pieces.unionByName(spark.read.parquet(before))
        merged_pieces(pieces).write.mode("overwrite").parquet(batch_folder(folder, number))
        drop_path(spark, batch_folder(folder, number - 2))

    return process


def newest_periods(spark: SparkSession, output: str) -> DataFrame:
    """Block periods as the last micro-batch left them."""
    table = spark.read.parquet(f"{output}/periods")
    rows = table.where(F.col("batch") == (table.agg(F.max("batch")).first()[0] or 0))
    until = (F.col("last") + TTL_SECONDS).alias("blocked_until")
    return rows.select("src_ip", F.col("first").alias("blocked_from"), until, F.col("events").alias("block_events"))


class BlockPeriods(StatefulProcessor):
    """Open block periods per source; an event-time timer closes a period at its expiry.

    Every change emits all open periods of the source; ``settled_periods`` reads them.
    Times come from the events only, so a replay gives the same periods.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first long, last long, events long")

    def _rows(self, source: str, periods: list[tuple[int, int, int]], closed: bool) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "src_ip": [source] * len(periods),
                "blocked_from": [p[0] for p in periods],
                "blocked_until": [p[1] + TTL_SECONDS for p in periods],
                "block_events": [p[2] for p in periods],
                "closed": [closed] * len(periods),
            }
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        periods = [tuple(p) for p in self.open.get()]
        for frame in rows:  # one frame at a time; only merged periods are kept
            fresh = list(zip(frame["first"].tolist(), frame["last_second"].tolist(), frame["events"].tolist()))
            periods = merge_periods(periods + fresh, TTL_SECONDS)
        self.open.put(periods)
        self._wake_at_next_expiry(periods)
        yield self._rows(key[0], periods, False)

    def _wake_at_next_expiry(self, periods: list[tuple[int, int, int]]) -> None:
        """One timer per source is enough: when it fires, the next one is set."""
        self.handle.registerTimer((min(last for _, last, _ in periods) + TTL_SECONDS) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() // 1000
        periods = [tuple(p) for p in self.open.get()]
        done = [p for p in periods if p[1] + TTL_SECONDS <= now]
        left = [p for p in periods if p[1] + TTL_SECONDS > now]
        if left:
            self.open.put(left)
            self._wake_at_next_expiry(left)
        else:
            self.open.clear()
        if done:
            yield self._rows(key[0], done, True)

    def close(self) -> None:
        pass


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reduce each batch to one row per source and lifetime slot before the shuffle.

    Two blocks of one slot are closer than the lifetime, so they are one piece; a
    source with very many blocks sends few rows.
    """
    for batch in batches:
        yield (
            batch.groupby(["src_ip", batch["second"] // TTL_SECONDS])
            .agg(first=("second", "min"), last=("ts", "max"), last_second=("second", "max"), events=("second", "size"))
            .reset_index()[["src_ip", "first", "last", "last_second", "events"]]
        )


def block_periods(blocks: DataFrame, watermark: str = K.WATERMARK, source: str = "src_ip", ts: str = "ts") -> DataFrame:
    """Block periods of a stream of block events (update mode)."""
    slim = blocks.where(~F.col(source).isin(*K.LOOPBACK_SOURCES)).select(
        F.col(source).alias("src_ip"), F.col(ts).alias("ts"), epoch_seconds(F.col(ts)).alias("second")
    )
    return (
        slim.mapInPandas(_combine, _PIECE)
        .withWatermark("last", watermark)
        .groupBy("src_ip")
        .transformWithStateInPandas(BlockPeriods(), PERIOD, "update", "eventtime")
    )


def settled_periods(rows: DataFrame) -> DataFrame:
    """Periods out of the emitted rows (with their batch number): closed ones, and the open
    ones of each source's last update.  A late event may have joined earlier open periods."""
    closed, opened = rows.where("closed"), rows.where(~F.col("closed"))
    newest = opened.groupBy("src_ip").agg(F.max("batch").alias("newest"))
    still_open = (
        opened.join(newest, "src_ip")
        .where(F.col("batch") == F.col("newest"))
        .join(closed.select("src_ip", "blocked_from"), ["src_ip", "blocked_from"], "left_anti")
    )
    columns = ["src_ip", "blocked_from", "blocked_until", "block_events"]
    return closed.select(*columns).unionByName(still_open.select(*columns))
