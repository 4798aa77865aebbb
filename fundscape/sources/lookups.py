"""Parameters and code lists as small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Up to so many rows a table given as a Python collection is broadcast.
SMALL_ROWS = 10_000


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A parameter table. Its size is that of the Python collection; up to SMALL_ROWS it
    gets the broadcast hint, above that it is joined as Spark sees fit, with the same result."""
    table = spark.createDataFrame(list(rows), schema)
    return F.broadcast(table) if len(rows) <= SMALL_ROWS else table


def parameter_table(
    spark: SparkSession, values: Mapping | DataFrame, schema: str
) -> DataFrame:
    """A mapping as a two-column table; a DataFrame passes through."""
    if isinstance(values, DataFrame):
        return values
    return small_table(spark, list(values.items()), schema)


def value_list(spark: SparkSession, values: Sequence[str] | DataFrame, name: str) -> DataFrame:
    """A list as a one-column table; a DataFrame passes through under that name."""
    if isinstance(values, DataFrame):
        return values.toDF(name)
    return small_table(spark, [(v,) for v in values], f"`{name}` string")


def iso_codes(spark: SparkSession) -> DataFrame:
    """ISO 3166 countries ``(iso3, iso2, country_name)`` as the Java runtime lists
    them: a few hundred rows, fixed by the standard."""
    locale = spark._jvm.java.util.Locale
    rows = []
    for iso2 in locale.getISOCountries():
        place = locale("", iso2)
        rows.append((place.getISO3Country(), iso2, place.getDisplayCountry(locale.ENGLISH)))
    return small_table(spark, rows, "iso3 string, iso2 string, country_name string")
