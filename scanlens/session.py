"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "scanlens", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the engine defaults; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Give the workers this package, once per application; a local session has it on its path.

    The archive is served to the executors by Spark, so they need no shared folder for it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return spark
    _shipped.add(context.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(here)))
    own = tempfile.TemporaryDirectory(prefix="scanlens-ship-")  # the driver's; Spark serves the file to the end
    target = os.path.join(own.name, "scanlens.zip")
    with open(target, "wb") as out:
        out.write(packed.getvalue())
    context.addPyFile(target)
    atexit.register(own.cleanup)
    return spark


_shipped: set[str] = set()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are wall-clock UTC; keep every session on that zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_root: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder:
    on a cluster executors would not see it.  The folder is scratch space.
    """
    name = "spark.checkpoint.dir"
    root = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {name} to a folder all executors share")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="scanlens-"))
        root = _local_root[0]
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for owned in _owners:
        owned.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table this package made; nothing happens if it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


_owners: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop the scratch tables made inside the block when it ends; what it returns must be written elsewhere."""
    mine: list[str] = []
    _owners.append(mine)
    try:
        yield
    finally:
        _owners.remove(mine)
        for path in mine:
            drop_path(spark, path)


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a plain table scan out to all cores when it has fewer splits.

    For CPU-bound steps over one small file; a large scan has more splits than
    cores and passes through unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: short lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
