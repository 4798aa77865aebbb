"""Per-country features and their denominators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscape.functions import to_number
from fundscape.sources.lookups import parameter_table, value_list


def _share(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def group_totals(
    df: DataFrame,
    group_col: str = "country",
    project_col: str = "projectID",
    org_col: str = "organisationID",
    amount_col: str = "ecContribution",
) -> DataFrame:
    """Total amount, distinct projects and distinct organisations per group."""
    return df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(
        *_totals(project_col, org_col, amount_col)
    )


def group_ratios(
    df: DataFrame, group_col: str = "country", status_col: str = "status", flag_col: str = "is_collab"
) -> DataFrame:
    """Shares of participation rows per group: collaborative, signed, closed and
    terminated, and the success ratio made of them."""
    grouped = df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(*_ratios(status_col, flag_col))
    return with_success_ratio(grouped)


def group_features(
    df: DataFrame,
    group_col: str = "country",
    project_col: str = "projectID",
    org_col: str = "organisationID",
    amount_col: str = "ecContribution",
    status_col: str = "status",
    flag_col: str = "is_collab",
) -> DataFrame:
    """All totals and ratios in one aggregation.

    Distinct counts shuffle on (group, value), so one group with a third of all rows
    is spread over all tasks; the plain aggregates are combined before the shuffle."""
    grouped = df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(
        *_totals(project_col, org_col, amount_col), *_ratios(status_col, flag_col)
    )
    return with_success_ratio(grouped)


def _totals(project_col: str, org_col: str, amount_col: str) -> list[Column]:
    return [
        F.coalesce(F.sum(amount_col), F.lit(0.0)).alias("total_ec_contribution"),
        F.countDistinct(project_col).alias("total_projects"),
        F.countDistinct(org_col).alias("unique_orgs"),
    ]


def _ratios(status_col: str, flag_col: str) -> list[Column]:
    status = F.upper(status_col)
    return [
        F.avg(F.col(flag_col).cast("double")).alias("collab_project_ratio"),
        _share(status == "SIGNED").alias("signed_pct"),
        _share(status == "CLOSED").alias("closed_pct"),
        _share(status == "TERMINATED").alias("terminated_pct"),
    ]


def with_success_ratio(df: DataFrame, out: str = "success_ratio") -> DataFrame:
    return df.withColumn(out, F.col("signed_pct") + F.col("closed_pct") - F.col("terminated_pct"))


def preprocess_gdp(gdp: DataFrame, codes: DataFrame, value_col: str = "2023", code_col: str = "Country Code") -> DataFrame:
    """GDP table with a numeric value and the two-letter code, NULL where unknown."""
    numeric = gdp.withColumn(value_col, to_number(F.col(f"`{value_col}`")))
    return map_codes(numeric, code_col, codes.select("iso3", "iso2"), "iso2")


def map_codes(df: DataFrame, col: str, codes: DataFrame, out: str, fallback: bool = False) -> DataFrame:
    """Look a code up in a two-column table (code, value). Unknown codes give NULL, or
    the code itself with ``fallback``."""
    table = codes.toDF("_code", out)
    joined = df.join(table, F.col(f"`{col}`") == F.col("_code"), "left").drop("_code")
    return joined.withColumn(out, F.coalesce(out, F.col(f"`{col}`"))) if fallback else joined


def alias_codes(df: DataFrame, aliases: Mapping[str, str] | DataFrame, col: str = "country") -> DataFrame:
    """Replace codes that have an alias (EL by GR, say); none are replaced by default."""
    table = parameter_table(df.sparkSession, aliases, "code string, alias string")
    mapped = map_codes(df, col, table, "_alias", fallback=True)
    return mapped.withColumn(col, F.col("_alias")).drop("_alias")


def keep_members(df: DataFrame, members: Sequence[str] | DataFrame, key: str = "country") -> DataFrame:
    """Rows whose key is in the member list."""
    return df.join(value_list(df.sparkSession, members, key), key, "left_semi")


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Fill NULL in every numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.fillna(value, numeric)


def join_denominator(
    features: DataFrame,
    denom: DataFrame,
    key: str = "iso2",
    value: str = "2023",
    on: str = "country",
    numerator: str = "total_ec_contribution",
    out: str = "gdp_2023",
    ratio: str = "ec_per_gdp",
) -> DataFrame:
    """Left join a denominator by key and divide by it; a missing or zero denominator
    gives 0, as do all other missing numbers."""
    side = denom.select(F.col(f"`{key}`").alias(on), F.col(f"`{value}`").alias(out)).filter(F.col(on).isNotNull())
    joined = features.join(side, on, "left")
    return fill_numeric(joined.withColumn(ratio, F.try_divide(numerator, out)))


def with_totals(df: DataFrame, source: DataFrame, totals: Mapping[str, Column], columns: Mapping[str, Callable]) -> DataFrame:
    """Add columns made from aggregates over ``source``.

    All aggregates are found together, in one scalar subquery that gives a struct: one
    partial aggregation per task, no shuffle of the rows and no join. Each entry of
    ``columns`` is a function of the struct. ``source`` is read once more, so give this
    a stored or persisted table where it is costly."""
    struct = source.agg(F.struct(*[c.alias(n) for n, c in totals.items()]).alias("t")).scalar()
    added = df.withColumn("_totals", struct)
    return added.withColumns({n: f(F.col("_totals")) for n, f in columns.items()}).drop("_totals")


def share_of_total(df: DataFrame, col: str, out: str, scale: float = 1.0) -> DataFrame:
    """Each value over the column's sum."""
    return with_totals(
        df, df, {"total": F.sum(col)}, {out: lambda t: F.try_divide(F.col(col) * F.lit(scale), t["total"])}
    )


def ratio_to_max(df: DataFrame, col: str, out: str) -> DataFrame:
    """Each value over the column's maximum."""
    return with_totals(df, df, {"most": F.max(col)}, {out: lambda t: F.try_divide(F.col(col), t["most"])})


def participation_shares(df: DataFrame) -> DataFrame:
    """Funding as a share of the total, projects and organisations over their maximum,
    from one aggregation."""
    totals = {
        "amount": F.sum("total_ec_contribution"),
        "projects": F.max("total_projects"),
        "orgs": F.max("unique_orgs"),
    }
    shares = {
        "funding_share": lambda t: F.try_divide(F.col("total_ec_contribution"), t["amount"]),
        "project_share": lambda t: F.try_divide(F.col("total_projects"), t["projects"]),
        "org_share": lambda t: F.try_divide(F.col("unique_orgs"), t["orgs"]),
    }
    return with_totals(df, df, totals, shares)
