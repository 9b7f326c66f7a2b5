"""Rows that come after their window has closed: kept in a side table, and counted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from scanlens.sources.files import path_exists
from scanlens.streaming.dispatch import batch_folder


def split_late(output: str, delay_seconds: int, reach_seconds: int = 0, ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """Write each micro-batch below ``rows``, late rows apart from those on time.

    The watermark of a batch is the latest time of all earlier batches minus the delay, as
    for a stateful operator with that delay.  A row is late if what it could still
    change, which ends ``reach_seconds`` after it (a session's gap, a window's length),
    has closed.  A batch reads one mark, that of its predecessor, so a repeated batch
    splits alike.  Rows without a time are on time.
    """
    marks = f"{output}/marks"

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.parquet(batch_folder(marks, number - 1)).first()["mark"] if path_exists(spark, batch_folder(marks, number - 1)) else None
        second = F.unix_millis(F.col(ts)) / 1000
        late = F.lit(False) if before is None else F.coalesce(second + reach_seconds <= before / 1000 - delay_seconds, F.lit(False))
        here = batch_folder(f"{output}/rows", number)
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(here)
        top = None
        if path_exists(spark, f"{here}/late=false") or path_exists(spark, f"{here}/late=true"):
            top = spark.read.parquet(here).agg(F.max(F.unix_millis(F.col(ts))).alias("top")).first()["top"]
        mark = max((x for x in (before, top) if x is not None), default=None)
        spark.createDataFrame([(mark,)], "mark long").coalesce(1).write.mode("overwrite").parquet(batch_folder(marks, number))

    return process


def split_rows(spark: SparkSession, output: str) -> DataFrame:
    """What ``split_late`` wrote, with ``batch`` and ``late``."""
    return spark.read.parquet(f"{output}/rows")


def on_time_stream(spark: SparkSession, output: str, schema, batches_per_trigger: int = 1) -> DataFrame:
    """The rows on time as a stream; a stateful operator with the same delay drops none of them."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", batches_per_trigger)
        .option("recursiveFileLookup", "true")
        .parquet(f"{output}/rows/batch=*/late=false")
    )


class DroppedRows(StreamingQueryListener):
    """Rows that the stateful operators of each stream dropped behind their watermark."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        own = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + own

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
