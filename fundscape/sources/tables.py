"""Reading and writing tables. Paths go to Spark as they are, so any file system it
knows (``s3a://``, ``hdfs://``, ``file:``) works and a failed read raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscape.constants import MISSING_MARKERS
from fundscape.sources.records import read_csv_records
from fundscape.sources.schemas import DASHBOARD

# Quoted texts may hold line breaks, quotes and outer blanks; all must survive.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    missing_markers: Sequence[str] = (),
    multiline: bool = False,
) -> DataFrame:
    """Scan a Parquet, CSV or JSON-lines table.

    ``multiline`` lets quoted CSV fields hold line breaks; with a schema large files are then
    cut into records by many tasks, without one a file is read by one task. With
    ``missing_markers`` those texts are read as NULL."""
    if fmt == "csv" and multiline and schema is not None:
        df = read_csv_records(spark, path, schema, CSV_OPTIONS)
        return mark_missing(df, missing_markers) if missing_markers else df
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("multiLine", multiline)
    df = reader.format(fmt).load(path)
    return mark_missing(df, missing_markers) if missing_markers else df


def mark_missing(df: DataFrame, markers: Sequence[str] = MISSING_MARKERS) -> DataFrame:
    """Turn marker texts into NULL in every text column. Note that the country code
    NA is such a marker under the usual CSV rules."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(*markers), F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def write_artifact(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result: Parquet for tables between stages, JSON lines for nested
    results that other programs read, CSV for flat text."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.format(fmt).save(path)


def read_stage(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A stage's table under an output folder; dashboard tables are JSON lines with a
    declared schema, all others Parquet."""
    path = f"{base.rstrip('/')}/{name}"
    if name in DASHBOARD:
        return read_table(spark, path, DASHBOARD[name], "json")
    return read_table(spark, path)


def with_position(df: DataFrame, out: str = "_position") -> DataFrame:
    """A scan with the place of each row in its files, as a sortable struct. Use it on a scan as it
    comes from ``read_table``, before anything else.

    Files count in the order of their names. Parquet knows the number of a row in its file; in
    a text file the range a task reads counts, then the order in which the task sees its rows. So the
    order does not depend on how files are split, and survives a task's second try. Quoted CSV with
    line breaks has no such order left."""
    file, start = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    try:
        row = df.select("*", F.struct(file, F.lit(0).cast("long").alias("start"), F.col("_metadata.row_index").alias("row")).alias(out))
        row.schema  # only Parquet has the field
        return row
    except AnalysisException:
        return df.select("*", F.struct(file, start, F.monotonically_increasing_id().alias("row")).alias(out))


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store a table in ``buckets`` files' worth of rows by hash of ``key``, sorted by it, and read it back.

    Tables with the same key type and number of buckets join on it without a shuffle, run
    after run, and one of them is aggregated by the key without one. Rows are dealt to their buckets before
    writing, so each bucket is one file. ``name`` is the table's name in the session's catalog."""
    spark = df.sparkSession
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)
