"""JSON documents to rows. The caller states the shape; it is never guessed from the
data, where equally long lists would change the result's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscape.sources.records import read_json_elements

SHAPES = ("records", "columns", "map", "raw")


def _parsed(df: DataFrame, col: str, schema: T.DataType | str, keep: tuple[str, ...]) -> DataFrame:
    return df.select(*keep, F.from_json(F.col(col), schema).alias("_doc"))


def records_from_json(df: DataFrame, col: str, fields: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text holding a list of records: one row per record."""
    doc = _parsed(df, col, f"array<struct<{fields}>>", keep)
    return doc.select(*keep, F.inline("_doc"))


def rows_from_json_columns(
    df: DataFrame, col: str, fields: dict[str, str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Text holding an object of equally long lists: the lists become columns."""
    schema = ", ".join(f"`{n}` array<{t}>" for n, t in fields.items())
    doc = _parsed(df, col, f"struct<{schema.replace('` array', '`: array')}>", keep)
    zipped = F.arrays_zip(*[F.col(f"_doc.`{n}`").alias(n) for n in fields])
    return doc.select(*keep, F.inline(zipped)).toDF(*keep, *fields)


def rows_from_json_map(
    df: DataFrame,
    col: str,
    key: str = "project_id",
    value: str = "term",
    value_type: str = "string",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Text holding an object of lists of any length: one row per key and element."""
    doc = _parsed(df, col, f"map<string, array<{value_type}>>", keep)
    lists = doc.select(*keep, F.explode("_doc").alias(key, "_list"))
    return lists.select(*keep, key, F.explode("_list").alias(value))


def read_json_shape(
    spark: SparkSession, path: str, shape: str, fields: dict[str, str] | None = None, lines: bool = True
) -> DataFrame:
    """Read JSON files of a stated shape.

    ``records`` and ``columns`` need ``fields`` (name -> type); ``map`` gives
    ``(project_id, term)``; ``raw`` gives the text as it is. Every line is a document,
    and a large file is split among tasks. With ``lines=False`` a file is one document, whose
    elements are cut by many tasks; only ``columns`` and ``raw`` documents are read by one task."""
    if shape not in SHAPES:
        raise ValueError(f"shape must be one of {SHAPES}")
    if not lines and shape in ("records", "map"):
        left, right = "[]" if shape == "records" else "{}"
        docs = read_json_elements(spark, path).select(F.concat(F.lit(left), "value", F.lit(right)).alias("value"))
    else:
        docs = spark.read.text(path, wholetext=not lines)
    if shape == "records":
        return records_from_json(docs, "value", ", ".join(f"`{n}`: {t}" for n, t in fields.items()))
    if shape == "columns":
        return rows_from_json_columns(docs, "value", fields)
    if shape == "map":
        return rows_from_json_map(docs, "value")
    return docs
