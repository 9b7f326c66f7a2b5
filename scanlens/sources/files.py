"""Flow files, event logs and saved artefacts."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlens.constants import FEATURE_COLUMNS
from scanlens.operators.clean import strip_names
from scanlens.operators.lookups import attach_by_key
from scanlens.schemas import DECEPTION_SCHEMA, DETECTION_SCHEMA

_CORRUPT, _EXTRA = "_corrupt_record", "_extra_field"
_CONTENT, _COPIES, _NUMBER = "_content", "_copies", "_number"
_STEP = 1 << 16


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the file system the path belongs to."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def csv_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files behind a path, folder or glob (a metadata listing; nothing is opened)."""
    listed = spark.read.format("binaryFile").load(path).select("path").collect()
    return sorted(r.path for r in listed)


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file of any file system and compression Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(conf).open(hadoop_path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hadoop_path)
        text = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def header_names(line: str) -> list[str]:
    """Column names of a header line: blank cells and repeated names are told apart by position."""
    cells = next(csv.reader([line.lstrip("\ufeff")]), [])
    lowered = [c.strip().lower() for c in cells]
    return [f"_c{i}" if not c.strip() else f"{c}{i}" if lowered.count(c.strip().lower()) > 1 else c for i, c in enumerate(cells)]


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header; each file is opened for its first line only, many at a time."""
    files = csv_files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if names := tuple(header_names(line)):
            groups.setdefault(names, []).append(file)
    return groups


def read_flows_csv(
    spark: SparkSession,
    path: str | list[str],
    bad_lines: str = "error",
    text_columns: tuple[str, ...] = ("Label", "Source IP", "label", "attack_cat", "src_ip", "flow_id"),
) -> DataFrame:
    """Flow files with a header: names stripped, measures DOUBLE, named columns text.

    Headers fix the schema, so nothing is inferred.  Files with one header are one read;
    files with other headers, or another order, are united by column name, and columns a
    file lacks are NULL.  ``bad_lines``: ``error`` fails on a line with the wrong number
    of fields or a measure that is no number; ``skip`` drops lines with too many fields
    (an empty one at the end does not count) and fills short ones with NULL; ``quarantine`` keeps lines with a wrong number of
    fields as text in ``_corrupt_record``.  The last two read a measure that is no
    number as NULL.
    """
    if bad_lines not in ("error", "skip", "quarantine"):
        raise ValueError("bad_lines must be one of ['error', 'quarantine', 'skip']")
    groups = files_by_header(spark, path)
    if not groups:
        raise FileNotFoundError(f"no file with a header in {path}")
    frames = [_read_one_header(spark, list(names), files, bad_lines, text_columns) for names, files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _read_one_header(spark: SparkSession, names: list[str], files: list[str], bad_lines: str, text_columns: tuple[str, ...]) -> DataFrame:
    lenient = bad_lines != "error"
    is_text = {n: n.strip() in text_columns for n in names}
    # Lenient reading splits every line whichever columns are wanted, and converts
    # afterwards: a line is then bad for its shape only, in every query alike.
    fields = [T.StructField(n, T.StringType() if lenient or is_text[n] else T.DoubleType()) for n in names]
    if bad_lines == "quarantine":
        fields.append(T.StructField(_CORRUPT, T.StringType()))
    if bad_lines == "skip":
        fields.append(T.StructField(_EXTRA, T.StringType()))  # a field beyond the header
    lines = (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE" if lenient else "FAILFAST")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("positiveInf", "Infinity")
        .option("negativeInf", "-Infinity")
        .option("nanValue", "NaN")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", not lenient)
        .schema(T.StructType(fields))
    )
    if bad_lines == "skip":
        lines = lines.csv(files).where(F.col(_EXTRA).isNull()).drop(_EXTRA)
    else:
        lines = lines.csv(files)
    if lenient:
        lines = lines.withColumns({n: F.col(f"`{n}`").try_cast("double") for n in names if not is_text[n]})
    return strip_names(lines)


def read_first_existing(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """The first of several flow files that exists (preprocessed first, raw as fallback)."""
    for path in paths:
        if path_exists(spark, path):
            return read_flows_csv(spark, path, **options)
    raise FileNotFoundError(f"none of {paths} exists")


def read_many_flows(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Several flow files as one table by column name; absent columns are NULL."""
    return read_flows_csv(spark, paths, **options)


def to_short_names(df: DataFrame) -> DataFrame:
    """File headings to the short feature names used by the operators."""
    names = {long: short for short, long in FEATURE_COLUMNS} | {"Source IP": "src_ip", "Label": "label"}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def to_file_names(df: DataFrame) -> DataFrame:
    names = dict(FEATURE_COLUMNS) | {"src_ip": "Source IP", "label": "Label"}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def with_row_key(df: DataFrame, key: str = "flow_id") -> DataFrame:
    """Give rows without a key a unique, repeatable one: hash of the content and number of the copy.

    Equal rows are interchangeable, so their numbers are made from their count instead of
    an order: keys depend on the content of the table only, not on files or partitions.
    Unique rows stay where they are; what is exchanged is one narrow hash per row.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.withColumn(_CONTENT, F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))
    copies = hashed.groupBy(_CONTENT).agg(F.count(F.lit(1)).alias(_COPIES)).where(F.col(_COPIES) > 1)
    joined = attach_by_key(hashed, copies, _CONTENT)
    single = joined.where(F.col(_COPIES).isNull()).withColumn(_NUMBER, F.lit(0).cast("long"))
    # in two steps, so that no row holds the numbers of millions of copies
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(_COPIES) - 1) / _STEP)))
    several = joined.where(F.col(_COPIES).isNotNull()).dropDuplicates([_CONTENT]).withColumn("_block", block)
    last = F.least(F.col(_COPIES) - 1, F.col("_block") * _STEP + _STEP - 1)
    several = several.withColumn(_NUMBER, F.explode(F.sequence(F.col("_block") * _STEP, last))).drop("_block")
    numbered = single.unionByName(several)
    return numbered.select(F.concat_ws("#", _CONTENT, _NUMBER).alias(key), *columns)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _read_log(spark: SparkSession, path: str, schema: T.StructType, layout: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    wide = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    if layout == "array":
        reader = reader.option("multiLine", True)
    # A line that holds no object of this schema gives a row of NULLs only.
    nothing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in schema.names])
    return reader.json(path).where(F.col(_CORRUPT).isNull() & ~nothing).drop(_CORRUPT)


def read_event_log(
    spark: SparkSession, path: str, schema: T.StructType = DETECTION_SCHEMA, layout: str = "auto"
) -> DataFrame:
    """Log of one object per line or of one array; bad lines are skipped.

    No such path or an empty file gives an empty table.  ``auto`` looks at the
    first non-blank line only: a line that is just ``[`` starts a pretty-printed
    array, everything else is read line by line (an array on one line included).
    """
    if layout == "auto":
        layout = "lines"
        if path_exists(spark, path):
            head = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
            if head and head[0]["value"].strip() == "[":
                layout = "array"
    return _read_log(spark, path, schema, layout)


def read_detection_log(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    return read_event_log(spark, path, DETECTION_SCHEMA, layout)


def read_deception_log(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    return read_event_log(spark, path, DECEPTION_SCHEMA, layout)


def append_log(df: DataFrame, path: str) -> None:
    """One JSON object per line, appended as new files of a folder."""
    df.write.mode("append").json(path)


def write_manifest(df: DataFrame, path: str, source: str = "source") -> None:
    """Row counts per source as one JSON file."""
    counts = df.groupBy(source).agg(F.count(F.lit(1)).alias("rows"))
    counts.coalesce(1).write.mode("overwrite").json(path)


def write_names(spark: SparkSession, names: list[str], path: str) -> None:
    rows = list(enumerate(names))
    spark.createDataFrame(rows, "position int, name string").coalesce(1).write.mode("overwrite").json(path)


def read_names(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("position int, name string").json(path).collect()
    return [row["name"] for row in sorted(rows, key=lambda r: r["position"])]
